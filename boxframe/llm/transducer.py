"""Finite-state transducers that count the tokens of byte-level BPE.

``Splitter`` cuts texts into pre-tokens.  Its states are what the open pre-token is; a transition is
annotated with the cuts it emits, before the current or the previous character.  A chunk of text maps
every state to a state; the maps of all chunks are made at once, composed by a parallel prefix scan, and
give each chunk the state it starts in, so that a second look marks all cuts.

``Merger`` counts the tokens of a pre-token, byte by byte.  After each byte the tokens of the prefix
are known; what matters of them is the last token at each start of a possible longer token, and how
many tokens lie behind it.  That is the state; the transition for a byte is annotated with the change
of the count.  States are found from the vocabulary when first met and numbered, at most
``MAX_STATES`` at a time; starting over when full changes no count."""

from __future__ import annotations

import json
import unicodedata

import numpy as np

MAX_STATES = 150_000
MAX_WORDS = 400_000
CHUNK = 64

# Character classes of the splitter.
_LETTER, _NUMBER, _OTHER, _QUOTE, _SPACE, _BLANK, _END = range(7)
_ENDING = 7  # s t m d: a quote and one of them are a token
_R_OR_V, _E, _ELL = 8, 9, 10  # 're 've 'll
_CLASSES = 11
_LETTERS = {_LETTER, _ENDING, _R_OR_V, _E, _ELL}
# States of the splitter.
_FRESH, _IN_LETTERS, _IN_NUMBER, _IN_OTHER, _AFTER_QUOTE, _WANTS_E, _WANTS_L, _ONE_SPACE, _ONE_BLANK, _RUN_SPACE, _RUN_BLANK = range(11)
_STATES = 11
_CUT_HERE, _CUT_BEFORE = 1, 2
#: White space of Unicode.
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _begin(c: int) -> int:
    if c in _LETTERS:
        return _IN_LETTERS
    return {_NUMBER: _IN_NUMBER, _OTHER: _IN_OTHER, _QUOTE: _AFTER_QUOTE, _SPACE: _ONE_SPACE, _BLANK: _ONE_BLANK}[c]


def _step(state: int, c: int) -> tuple[int, int]:
    """(next state, cuts) on character class ``c``."""
    letter, white = c in _LETTERS, c in (_SPACE, _BLANK)
    if c == _END:
        return _FRESH, _CUT_HERE | (_CUT_BEFORE if state in (_WANTS_E, _WANTS_L) else 0)
    if state == _WANTS_E and c == _E or state == _WANTS_L and c == _ELL:
        return _FRESH, 0
    if state in (_WANTS_E, _WANTS_L):  # the letter after the quote begins a word after all
        return (_IN_LETTERS, _CUT_BEFORE) if letter else (_begin(c), _CUT_BEFORE | _CUT_HERE)
    if state == _AFTER_QUOTE and c in (_ENDING, _R_OR_V, _ELL):
        return {_ENDING: _FRESH, _R_OR_V: _WANTS_E, _ELL: _WANTS_L}[c], 0
    if state in (_ONE_SPACE, _ONE_BLANK, _RUN_SPACE, _RUN_BLANK):
        if white:
            return (_RUN_SPACE if c == _SPACE else _RUN_BLANK), 0
        cut = _CUT_BEFORE if state in (_RUN_SPACE, _RUN_BLANK) else 0
        if state in (_ONE_BLANK, _RUN_BLANK):
            return _begin(c), cut | _CUT_HERE
        return (_IN_OTHER if c == _QUOTE else _begin(c)), cut  # a space belongs to what follows it
    goes_on = (state == _IN_LETTERS and letter or state == _IN_NUMBER and c == _NUMBER
               or state in (_IN_OTHER, _AFTER_QUOTE) and c in (_OTHER, _QUOTE))
    if goes_on:
        return (_IN_OTHER if state == _AFTER_QUOTE else state), 0
    return _begin(c), _CUT_HERE


def _class_table() -> np.ndarray:
    table = np.full(0x110000, _OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = _LETTER
        elif kind == "N":
            table[cp] = _NUMBER
    table[_WHITE] = _BLANK
    table[0x20], table[ord("'")] = _SPACE, _QUOTE
    for letters, c in (("stmd", _ENDING), ("rv", _R_OR_V), ("e", _E), ("l", _ELL)):
        table[[ord(x) for x in letters]] = c
    return table


class Splitter:
    """Pre-token cuts of joined texts."""

    def __init__(self) -> None:
        self.classes = _class_table()
        steps = [[_step(s, c) for c in range(_CLASSES)] for s in range(_STATES)]
        self.next = np.array([[x[0] for x in row] for row in steps], np.uint8).ravel()
        self.cuts = np.array([[x[1] for x in row] for row in steps], np.uint8).ravel()

    def starts(self, text: str, ends: np.ndarray) -> np.ndarray:
        """Offsets of ``text`` where a pre-token begins; the characters at ``ends`` close a text
        and are offsets of their own."""
        cls = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cls[ends] = _END
        n = len(cls)
        rows = -(-n // CHUNK)
        padded = np.full(rows * CHUNK, _END, np.uint8)
        padded[:n] = cls
        by_step = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
        maps = np.tile(np.arange(_STATES, dtype=np.uint8), (rows, 1))
        for c in by_step:
            maps = self.next[maps * np.uint8(_CLASSES) + c[:, None]]
        reach = 1  # prefix scan: after each round, row i maps the state 2 * reach chunks back
        flat = np.arange(rows)[:, None]
        while reach < rows:
            joined = maps.copy()
            joined[reach:] = maps[flat[reach:], maps[:-reach]]
            maps = joined
            reach *= 2
        state = np.empty(rows, np.uint8)
        state[0] = _FRESH
        state[1:] = maps[:-1, _FRESH]
        out = np.empty((CHUNK, rows), np.uint8)
        for j, c in enumerate(by_step):
            at = state * np.uint8(_CLASSES) + c
            out[j] = self.cuts[at]
            state = self.next[at]
        out = out.T.ravel()[:n]
        cut = (out & _CUT_HERE) > 0
        cut[:-1] |= (out[1:] & _CUT_BEFORE) > 0
        return np.flatnonzero(cut)


class Merger:
    """Token counts of pre-tokens under a byte-level BPE vocabulary file (tokenizers JSON)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        alphabet = {chr(b): b for b in shown}
        alphabet |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.ids = {raw(t): i for t, i in vocab.items()}
        self.text = {i: b for b, i in self.ids.items()}
        self.rank = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[raw(a), raw(b)] = r
        self.opens = {b[:k] for b in self.ids for k in range(1, len(b))}  # of longer tokens
        self._pairs: dict[tuple[int, int], bool] = {}
        self._spines: tuple[dict, dict] = ({}, {})
        self._halves: dict[bytes, tuple[bytes, bytes]] = {}
        self.words: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        start = (b"", ((-1, 0),))
        self._states = [start]
        self._numbers = {start: 0}
        self._next: list[dict[int, tuple[int, int]]] = [{}]

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """Pieces of a token at its right (or left) edge from one byte to the whole, each with the rank
        of the merge that absorbs it; the whole is never absorbed."""
        known = self._spines[right].get(token)
        if known is None:
            raw, out, merged = self.text[token], [], 1 << 30
            while True:
                out.append((raw, merged))
                if len(raw) == 1:
                    break
                x, y = self._last_merge(raw)
                merged = self.rank[x, y]
                raw = y if right else x
            known = self._spines[right][token] = out[::-1]
        return known

    def _last_merge(self, raw: bytes) -> tuple[bytes, bytes]:
        pair = self._halves.get(raw)
        if pair is None:
            parts = [raw[i:i + 1] for i in range(len(raw))]
            while len(parts) > 2:
                i = min((self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:])))[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            pair = self._halves[raw] = (parts[0], parts[1])
        return pair

    def _adjacent(self, a: int, b: int) -> bool:
        """Whether tokens a and b stay apart when they meet: in the order of ranks, no merge across
        the border comes before the pieces at the border are absorbed by their own tokens (a merge
        further left goes first among equals)."""
        known = self._pairs.get((a, b))
        if known is not None:
            return known
        if len(self._pairs) > MAX_WORDS:
            self._pairs.clear()
        left, right = self._spine(a, True), self._spine(b, False)
        i = j = 0
        while True:
            (x, into_a), (y, into_b) = left[i], right[j]
            across = self.rank.get((x, y), 1 << 30)
            if across < into_a and across <= into_b and across < 1 << 30:
                known = False
                break
            if into_a == into_b == 1 << 30:
                known = True
                break
            if into_a <= into_b:
                i += 1
            else:
                j += 1
        self._pairs[a, b] = known
        return known

    def _transition(self, number: int, byte: int) -> tuple[int, int]:
        open_text, past = self._states[number]
        text = open_text + bytes((byte,))
        ids = self.ids
        for k, seen in enumerate(past):
            if seen is not None:
                token = ids.get(text[k:])
                if token is not None and (seen[0] < 0 or self._adjacent(seen[0], token)):
                    break
        else:
            raise ValueError("a byte has no token")
        emitted = 1 - past[k][1]
        # what is kept: the past at each start from which a longer token could still end later
        opens, kept, keep = self.opens, [], -1
        for k in range(len(text)):
            if past[k] is not None and text[k:] in opens:
                if keep < 0:
                    keep = k
                kept.append((past[k][0], past[k][1] + emitted))
            elif keep >= 0:
                kept.append(None)
        kept.append((token, 0))
        state = (text[keep:] if keep >= 0 else b"", tuple(kept))
        to = self._numbers.get(state)
        if to is None:
            to = self._numbers[state] = len(self._states)
            self._states.append(state)
            self._next.append({})
        self._next[number][byte] = (to, emitted)
        return to, emitted

    def count(self, word: str) -> int:
        n = self.words.get(word)
        if n is not None:
            return n
        if len(self._states) > MAX_STATES:
            self._reset()
        n = at = 0
        table = self._next
        for byte in word.encode("utf-8", "surrogatepass"):
            step = table[at].get(byte)
            if step is None:
                step = self._transition(at, byte)
            at = step[0]
            n += step[1]
        if len(word) <= 64:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            self.words[word] = n
        return n
