"""Adaptive context-mixing range coder for blocks of token ids.

A block is coded on its own: models start fresh, and a checksum covers header and data.  For every id
the model has an order-2 and an order-1 prediction (the id that last followed the previous two ids, and
the previous one, in hashed slots with a confidence) and an order-0 distribution (adaptive counts of id
ranges, ids of a range alike).  How likely each prediction is right is learned per pair of confidences;
the mixed distribution has the interval [order 2 | order 1 | rest], and ids that neither predicts
are coded by order 0.  Intervals drive a range coder with 48-bit state and 16-bit words; carries are
kept beside the words and settled at the end.

All blocks of a batch advance together, one id a step: every step is a few dozen numpy calls over all
blocks, for coding as well as for decoding."""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
#: Blocks that advance together.
LANES = 2048
SLOT_BITS = 9
SLOTS = 1 << SLOT_BITS
TOTAL_BITS = 12
TOTAL = 1 << TOTAL_BITS
CLASSES = 64
STEP = 24  # how much one occurrence adds to the count of its range
MAGIC = b"CMR1"
_U = np.uint64
_TOP = _U(1 << 32)
_MASK = _U((1 << 48) - 1)
_HEAD = struct.Struct("<4sIIIB")  # magic, ids, first word count, checksum of all that follows, bits of an id


class _Model:
    """State of the predictions of ``n`` blocks; every method works on the first ``k`` of them."""

    def __init__(self, n: int, id_bits: int) -> None:
        self.low_bits = max(0, id_bits - CLASSES.bit_length() + 1)
        lane = np.arange(n)
        self.slot0, self.ctx0 = lane * SLOTS, lane * 32
        self.one = np.zeros(n * SLOTS, np.uint32)  # id + 1 in the upper bits, confidence in the lower two
        self.two = np.zeros(n * SLOTS, np.uint32)
        # per (confidence 2, confidence 1, agreement): chance out of TOTAL that order 2, else order 1, is right
        start = np.tile((np.arange(32) // 8 * 700 + 300).astype(np.int32), n)
        self.hit2, self.hit1 = start, start.copy()
        self.counts = np.full((n, CLASSES), 4, np.int32)
        self.prev = np.zeros(n, np.uint32)
        self.prev2 = np.zeros(n, np.uint32)

    def predict(self, k: int) -> None:
        prev = self.prev[:k]
        h1 = prev * np.uint32(2654435761)
        h2 = ((prev * np.uint32(2246822519)) ^ (self.prev2[:k] * np.uint32(3266489917))) * np.uint32(668265263)
        self.at1 = (h1 >> np.uint32(32 - SLOT_BITS)) + self.slot0[:k]
        self.at2 = (h2 >> np.uint32(32 - SLOT_BITS)) + self.slot0[:k]
        e1, e2 = self.one.take(self.at1), self.two.take(self.at2)
        self.p1, self.p2 = e1 >> np.uint32(2), e2 >> np.uint32(2)  # id + 1, or 0 without a prediction
        self.c1, self.c2 = e1 & np.uint32(3), e2 & np.uint32(3)
        same = self.p1 == self.p2
        self.ctx = ((self.c2 << np.uint32(3)) | (self.c1 << np.uint32(1)) | same) + self.ctx0[:k]
        self.q2, self.q1 = self.hit2.take(self.ctx), self.hit1.take(self.ctx)
        self.f2 = self.q2 * (self.p2 > 0)
        self.f12 = self.f2 + ((TOTAL - self.f2) * self.q1 >> TOTAL_BITS) * ((self.p1 > 0) & ~same)

    def update(self, k: int, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        name = ids + np.uint32(1)
        for table, at, p, c in ((self.one, self.at1, self.p1, self.c1), (self.two, self.at2, self.p2, self.c2)):
            right = p == name
            # up to 3 when right, one less when wrong; a confident prediction survives one miss
            conf = np.minimum(c + right, np.uint32(3)) - (~right & (c > 0))
            table[at] = (np.where(right | (c > 1), p, name) << np.uint32(2)) | conf
        self.hit2[self.ctx] = np.clip(self.q2 + ((hit2 * np.int32(TOTAL - 64) - self.q2) >> 4), 32, TOTAL - 64)
        step = (hit1 * np.int32(TOTAL - 64) - self.q1) >> 4
        self.hit1[self.ctx] = np.clip(self.q1 + step * ~hit2, 32, TOTAL - 64)
        self.prev2[:k] = self.prev[:k]
        self.prev[:k] = ids


def _encode(ids: np.ndarray, lengths: np.ndarray, id_bits: int) -> list[bytes]:
    """Words of each block; ``ids`` is (steps, blocks), longest block first."""
    steps, n = ids.shape
    m = _Model(n, id_bits)
    low, rng = np.zeros(n, _U), np.full(n, _MASK, _U)
    width = 3 * steps + 8
    words = np.zeros(n * width, np.uint32)
    pos = np.arange(n) * width + 1  # word 0 takes a first carry

    def shift(thin: np.ndarray) -> None:
        x = low.take(thin)
        at = pos.take(thin)
        words[at] = x >> _U(32)  # bit 16 of a word is a carry, settled at the end
        pos[thin] = at + 1
        low[thin] = (x & _U(0xFFFFFFFF)) << _U(16)
        rng[thin] = rng.take(thin) << _U(16)

    bits = m.low_bits
    live = (lengths[None, :] > np.arange(steps)[:, None]).sum(1)
    for t in range(steps):
        k = int(live[t])
        m.predict(k)
        x = ids[t, :k]
        name = x + np.uint32(1)
        hit2 = m.p2 == name
        hit1 = (m.p1 == name) & ~hit2
        start = np.where(hit2, 0, np.where(hit1, m.f2, m.f12))
        size = np.where(hit2, m.f2, np.where(hit1, m.f12 - m.f2, TOTAL - m.f12))
        r = rng[:k] >> _U(TOTAL_BITS)
        low[:k] += r * start.astype(_U)
        rng[:k] = r * size.astype(_U)
        shift(np.flatnonzero(rng[:k] < _TOP))
        esc = np.flatnonzero(~(hit2 | hit1))
        if len(esc):
            v = x.take(esc).astype(np.int64)
            cls, rest = v >> bits, v & ((1 << bits) - 1)
            cum = m.counts.take(esc, axis=0).cumsum(1, dtype=np.int32)
            row = np.arange(len(esc))
            count = m.counts[esc, cls].astype(np.int64)
            r = rng.take(esc) // (cum[:, -1].astype(_U) << _U(bits))
            low[esc] += r * (((cum[row, cls] - count) << bits) + rest * count).astype(_U)
            rng[esc] = r * count.astype(_U)
            for _ in range(2):
                shift(esc[rng.take(esc) < _TOP])
            m.counts[esc, cls] += STEP
        m.update(k, x, hit2, hit1)
    every = np.arange(n)
    for _ in range(3):
        shift(every)
    words = words.reshape(n, width)
    for j in range(width - 1, 0, -1):  # settle carries from the end
        over = words[:, j] >> np.uint32(16)
        if over.any():
            words[:, j - 1] += over
    packed = (words & np.uint32(0xFFFF)).astype("<u2")
    return [packed[i, 1:pos[i] - i * width].tobytes() for i in range(n)]


def _decode(data: list[bytes], lengths: np.ndarray, id_bits: int) -> np.ndarray:
    """Ids (steps, blocks) of words made by ``_encode``, longest block first."""
    n, steps = len(data), int(lengths.max())
    m = _Model(n, id_bits)
    width = max(map(len, data)) // 2 + 8
    words = np.zeros((n, width), _U)
    for i, d in enumerate(data):
        words[i, : len(d) // 2] = np.frombuffer(d, "<u2")
    code = (words[:, 0] << _U(32)) | (words[:, 1] << _U(16)) | words[:, 2]
    words = words.ravel()
    rng = np.full(n, _MASK, _U)
    pos = np.arange(n) * width + 3

    def shift(thin: np.ndarray) -> None:
        at = pos.take(thin)
        code[thin] = (code.take(thin) << _U(16)) | words.take(at)
        pos[thin] = at + 1
        rng[thin] = rng.take(thin) << _U(16)

    bits = m.low_bits
    live = (lengths[None, :] > np.arange(steps)[:, None]).sum(1)
    out = np.zeros((steps, n), np.uint32)
    for t in range(steps):
        k = int(live[t])
        m.predict(k)
        r = rng[:k] >> _U(TOTAL_BITS)
        c = code[:k]
        end2, end1 = r * m.f2.astype(_U), r * m.f12.astype(_U)
        hit2 = c < end2
        hit1 = ~hit2 & (c < end1)
        x = np.where(hit2, m.p2, m.p1) - np.uint32(1)
        code[:k] -= np.where(hit2, _U(0), np.where(hit1, end2, end1))
        rng[:k] = np.where(hit2, end2, np.where(hit1, end1 - end2, r * (TOTAL - m.f12).astype(_U)))
        shift(np.flatnonzero(rng[:k] < _TOP))
        esc = np.flatnonzero(~(hit2 | hit1))
        if len(esc):
            cum = m.counts.take(esc, axis=0).cumsum(1, dtype=np.int32)
            row = np.arange(len(esc))
            r = rng.take(esc) // (cum[:, -1].astype(_U) << _U(bits))
            v = (code.take(esc) // r).astype(np.int64)
            cls = (cum <= (v >> bits).astype(np.int32)[:, None]).sum(1)
            count = m.counts[esc, cls].astype(np.int64)
            base = (cum[row, cls] - count) << bits
            rest = (v - base) // count
            code[esc] -= r * (base + rest * count).astype(_U)
            rng[esc] = r * count.astype(_U)
            for _ in range(2):
                shift(esc[rng.take(esc) < _TOP])
            m.counts[esc, cls] += STEP
            x[esc] = (cls << bits) + rest
        out[t, :k] = x
        m.update(k, x, hit2, hit1)
    return out


def encode_blocks(blocks: list[np.ndarray], id_bits: int) -> list[bytes]:
    """One container per block of ids (uint32, each under 2^id_bits; at most BLOCK of them, at least one)."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    for at in range(0, len(order), LANES):
        part = order[at:at + LANES]
        lengths = np.array([len(blocks[i]) for i in part])
        ids = np.zeros((len(part), int(lengths[0])), np.uint32)
        for row, i in enumerate(part):
            ids[row, : len(blocks[i])] = blocks[i]
        coded = _encode(np.ascontiguousarray(ids.T), lengths, id_bits)
        for i, size, data in zip(part, lengths.tolist(), coded):
            body = struct.pack("<IB", size, id_bits) + data
            out[i] = _HEAD.pack(MAGIC, size, len(data) // 2, zlib.crc32(body), id_bits) + data
    return out


def decode_blocks(containers: list[bytes]) -> list[np.ndarray]:
    """The ids of containers; raises ValueError for a damaged one."""
    parsed = []
    for c in containers:
        magic, size, n_words, check, bits = _HEAD.unpack_from(c)
        body = c[_HEAD.size:]
        if magic != MAGIC or len(body) != 2 * n_words or zlib.crc32(struct.pack("<IB", size, bits) + body) != check:
            raise ValueError("damaged block")
        parsed.append((size, bits, body))
    out: list = [None] * len(parsed)
    order = sorted(range(len(parsed)), key=lambda i: (parsed[i][1], -parsed[i][0]))
    at = 0
    while at < len(order):
        part = [i for i in order[at:at + LANES] if parsed[i][1] == parsed[order[at]][1]]
        at += len(part)
        lengths = np.array([parsed[i][0] for i in part])
        ids = np.ascontiguousarray(_decode([parsed[i][2] for i in part], lengths, parsed[part[0]][1]).T)
        for row, i in enumerate(part):
            out[i] = ids[row, : parsed[i][0]]
    return out
