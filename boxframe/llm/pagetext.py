"""HTML extraction by template deduction with equivalence classes.

1. A page is a sequence of tokens: tags named by their path of open elements (with class and id), and
   whole text runs by path and content.  Per host, a token's occurrence vector says how often it is on
   each page; here it is kept as two sums of hashes of (page, count), which Spark adds up map-side, so
   a host with a third of all pages is a few partial sums.
2. Tokens of a host with equal vectors are an equivalence class.  A class is valid if it is large enough
   and on at least ``SUPPORT`` of the host's pages, and its tokens occur once on each of those.  The
   tokens of the valid classes are the host's template, as one set.  Hosts of too few pages use the
   template of all pages.
3. Slots are what lies between template tokens.  A slot holds main text unless the path there leads
   through page furniture (by element, or by the words of class and id); if the template has an article
   or main element, only slots inside it do.  The words of class and id say nothing about html, body,
   article and main, nor about an element around blocks that hold most of the page's text.  Text of the template itself (the same on most pages) is
   furniture outside such an element.

The templates are a small table keyed by host; the join leaves broadcasting to its measured size, and
pages of a hot host are salted.

Defined cases: null or empty html gives empty text; repeated rows give equal rows; a page whose
template names no slot that holds text is read by paths alone; pages cut off in the middle are read as
far as they go; an url without host belongs to the host ``''``; null ids stay null."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.textkit import small_batches, written

SUPPORT = 0.5
MIN_PAGES = 3
MIN_CLASS = 3
SALTS = 16
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot "
                  "th thead title tr ul".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
FURNITURE = frozenset("nav header footer aside form script style noscript template iframe button select option textarea head title "
                      "menu dialog svg canvas object noembed noframes xmp input label".split())
_MAIN = frozenset(("article", "main"))
#: Elements whose class and id do not make them furniture.
_FRAME = _MAIN | {"html", "body"}
_NAMES = re.compile(r"(?:^|[^a-z])(?:ad|ads|advert\w*|banner\w*|breadcrumb\w*|comment\w*|cookie\w*|consent|disqus|footer|header|"
                    r"menu\w*|modal|nav\w*|newsletter|notice\w*|popup|promo\w*|related|repl(?:y|ies)|share|sharing|sidebar\w*|social|"
                    r"sponsor\w*|subscribe|toolbar|widget\w*)(?:$|[^a-z])")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: A new one of these closes an open one of the same group.
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}


def events(page: str) -> Iterator[tuple[str, str, list]]:
    """("open" | "close" | "text", name or text, stack of (tag, label, number)) in page order; the stack is
    the one around a text, and with the element for its own tags.  Elements are numbered as they open;
    those that another tag closes have a close event, too."""
    stack: list[tuple[str, str, int]] = []
    count = 0

    def close(depth: int) -> Iterator[tuple[str, str, list]]:
        while len(stack) > depth:
            yield "close", stack[-1][0], stack
            stack.pop()

    at = 0
    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            yield "text", page[at:stop], stack
        if m is None:
            return
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            deep = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if deep is not None:
                yield from close(deep)
            continue
        if tag in BLOCK or tag in _CLOSES:
            group = _CLOSES.get(tag, ("p",))
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in group or stack[i][0] == "p" and tag in BLOCK:
                    yield from close(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        label = " ".join(sorted((a[1] or a[2] or a[3] or "").lower() for a in ((x[0], x[1], x[2], x[3]) for x in _ATTRIBUTE.findall(m[3] or ""))))
        stack.append((tag, label, count))
        count += 1
        yield "open", tag, stack
        if tag in VOID or (m[3] or "").endswith("/"):
            stack.pop()
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            stop = end.start() if end else size
            if stop > at:
                yield "text", page[at:stop], stack
            at = end.end() if end else size
            yield "close", tag, stack
            stack.pop()


def _path(stack: list) -> str:
    return "/".join(f"{t}.{c}" if c else t for t, c, _ in stack)


def token_id(kind: str, name: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{name}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def squeeze(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def page_tokens(page: str) -> Iterator[tuple[int, str]]:
    """(token id, readable name) of every token of a page, in order."""
    for kind, name, stack in events(page):
        if kind == "text":
            text = squeeze(name)
            if text and stack and stack[-1][0] not in ("script", "style"):
                yield token_id("text", _path(stack) + "\n" + text), ""
        else:
            path = _path(stack)
            yield token_id(kind, path), path


@lru_cache(maxsize=1 << 16)
def _named(label: str) -> bool:
    return bool(label) and _NAMES.search(label) is not None


def _wrappers(page: str) -> set[int]:
    """Numbers of the elements named like furniture that are none: blocks in them hold most of the text."""
    total, amount, around = 0, Counter(), set()
    for kind, name, stack in events(page):
        if kind == "open" and name in BLOCK:
            around.update(n for _, c, n in stack[:-1] if _named(c))
        elif kind == "text" and not any(t in FURNITURE for t, _, _ in stack):
            size = len(name.strip())
            total += size
            for _, c, n in stack:
                if _named(c):
                    amount[n] += size
    return {n for n in around if 2 * amount[n] > total}


def _is_furniture(stack: list, wrappers: set[int]) -> bool:
    return any(t in FURNITURE or _named(c) and t not in _FRAME and n not in wrappers for t, c, n in stack)


def _in_main(stack: list) -> bool:
    return any(t in _MAIN for t, _, _ in stack)


def extract(page: str | None, template: frozenset[int], has_main: bool) -> str:
    """Main text of a page: the blocks in its content slots."""
    if not page:
        return ""
    wrappers = _wrappers(page)

    def read(use_slots: bool) -> list[str]:
        blocks: list[str] = []
        run: list[str] = []
        content = not use_slots

        def flush() -> None:
            text = squeeze("".join(run))
            run.clear()
            if text:
                blocks.append(text)

        main = has_main if use_slots else any(k == "open" and n in _MAIN for k, n, _ in events(page))
        for kind, name, stack in events(page):
            inside = stack if kind != "close" else stack[:-1]
            if kind == "text":
                if stack and content and (not main or _in_main(stack)) and not _is_furniture(stack, wrappers):
                    if use_slots and not _in_main(stack) and token_id("text", _path(stack) + "\n" + squeeze(name)) in template:
                        continue
                    run.append(name)
                continue
            if name in BLOCK:
                flush()
            elif name == "br":
                run.append(" ")
            if use_slots and token_id(kind, _path(stack)) in template:
                # a template token opens the next slot; the path there says whether it holds main text
                content = (not main or _in_main(inside)) and not _is_furniture(inside, wrappers)
        flush()
        return blocks

    blocks = read(True) if template else []
    return "\n".join(blocks or read(False))


def host_of(url) -> "F.Column":
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def token_vectors(pages: DataFrame) -> DataFrame:
    """(host, token, name, n_pages, total, v1, v2): tokens with the signature of their vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for host, key, page in zip(b["host"], b["key"], b["html"]):
                if not page:
                    continue
                names, counts = {}, Counter()
                for token, name in page_tokens(page):
                    counts[token] += 1
                    names.setdefault(token, name)
                rows.extend((host, t, names[t], int(key), c) for t, c in counts.items())
            yield pd.DataFrame(rows, columns=["host", "token", "name", "key", "c"])

    tokens = (pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("key"), "html")
              .mapInPandas(run, "host string, token bigint, name string, key bigint, c int")
              .withColumn("h", F.xxhash64("key", "c")))
    return tokens.groupBy("host", "token").agg(
        F.any_value("name").alias("name"), F.count(F.lit(1)).alias("n_pages"), F.sum("c").alias("total"),
        F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("v1"), F.sum(F.shiftrightunsigned("h", 32)).alias("v2"))


def _templates(vectors: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, tokens, has_main): the tokens of the valid classes of every host with enough pages."""
    # tokens of single pages, which are most, cannot reach the support and stay out of the join
    often = vectors.filter((F.col("n_pages") >= MIN_PAGES * SUPPORT) & (F.col("total") == F.col("n_pages")))
    near = often.join(sizes, "host").filter((F.col("pages") >= MIN_PAGES) & (F.col("n_pages") >= F.col("pages") * SUPPORT))
    classes = (near.groupBy("host", "n_pages", "v1", "v2")
               .agg(F.collect_list("token").alias("tokens"), F.max(F.col("name").rlike(r"(^|/)(article|main)(\.[^/]*)?$")).alias("m"))
               .filter(F.size("tokens") >= MIN_CLASS))
    return classes.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"), F.max("m").alias("has_main"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    small_batches(pages.sparkSession, rows=256)
    vectors = written(token_vectors(pages))
    sizes = pages.filter("html <> ''").groupBy(host_of(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    templates = written(_templates(vectors, sizes))
    # the template of all pages: tokens on most pages, so a bounded list
    everywhere = vectors.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("n_pages", "total", "v1", "v2")), F.any_value("name").alias("name"))
    common = _templates(everywhere.withColumn("host", F.lit("*")), sizes.agg(F.sum("pages").alias("pages")).withColumn("host", F.lit("*"))).first()
    shared = (frozenset(common.tokens), bool(common.has_main)) if common else (frozenset(), False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[frozenset, bool]] = {}
        for b in batches:
            texts = []
            for host, tokens, main, page in zip(b["host"], b["tokens"], b["has_main"], b["html"]):
                if tokens is None or isinstance(tokens, float):
                    template = shared
                else:
                    template = known.get(host)
                    if template is None:
                        if len(known) > 4096:
                            known.clear()
                        template = known[host] = (frozenset(np.asarray(tokens).tolist()), bool(main))
                texts.append(extract(page, *template))
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts})

    salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = (pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
             .withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")))
    return (keyed.join(salted, ["host", "salt"], "left").select("page_id", "url", "html", "host", "tokens", "has_main")
            .mapInPandas(run, "page_id bigint, url string, text string")
            .withColumn("n_chars", F.length("text").cast("bigint")))
