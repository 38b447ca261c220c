"""Document fingerprints from closed syncmers.

A k-mer of bytes is an anchor if the smallest hash among its s-mers is that of its first or its last one. Whether a k-mer is an anchor depends
on its own bytes alone, so an edit moves only the anchors that overlap it, and common passages have anchors at the same places.

* ``anchors``: hash and byte position of every anchor of a text. A text without anchors has one: the hash of all of it, at 0; the empty text has none.
  From one anchor to the next it is at most K - S bytes, less than an anchor's length, so anchors leave no byte between them uncovered.
* The fingerprint holds all anchors in order, none left out: a digest of the length and of what lies before the first and after the last anchor
  (8 hex digits), then 8 digits of the hash of each anchor and 2 of its distance from the one before. An edit anywhere changes it; it is about half as long as the text.
* Likeness: anchors of two texts are matched by position. The i-th occurrence of a hash in one stands for the i-th in the other; of these matches
  the longest chain that ascends in both texts counts, so passages in another order do not match. Counted from the front and from the
  back, the longer chain is taken, as a share of the anchors of both: chain / (anchors + anchors - chain). 1 if both are empty.
* Equal texts have equal fingerprints. Null text: empty.

``edited`` compares each row with its edited text and with the next row by descending id. Null ids come last, equal ids are ordered by text, repeated
rows are kept, one row alone is its own successor, an empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelflift.llm.common import chunks_of, small_batches, with_computed
from shelflift.llm.neighbours import descending

K, S = 48, 8  # K is a multiple of S and K - S is below 256
_CHUNK = 1 << 20
_STEP = np.dtype([("hash", ">u4"), ("gap", "u1")])
_PRIMES = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _PRIMES[1]
    x = (x ^ (x >> np.uint64(27))) * _PRIMES[2]
    return x ^ (x >> np.uint64(31))


def _words(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one number."""
    n = len(b) - S + 1
    out = np.empty(n, np.uint64)
    for o in range(min(S, n)):
        part = b[o:o + (len(b) - o) // S * S].view("<u8")
        out[o::S] = part
    return out


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    size, low = 1, x
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:len(x) - width + 1], low[width - size:]) if size < width else low


def anchors(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of the closed syncmers of each text; long texts are taken in pieces that overlap by less than a k-mer."""
    pieces = [(row, at, t[at:at + _CHUNK + K - 1]) for row, t in enumerate(texts) for at in range(0, max(len(t) - K + 1, 1), _CHUNK)]
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
    for lo, hi in chunks_of([len(p) for _, _, p in pieces], _CHUNK):
        for (row, at, _), (hashes, places) in zip(pieces[lo:hi], _anchors([p for _, _, p in pieces[lo:hi]])):
            found[row].append((hashes, places + at))
    out = []
    for text, parts in zip(texts, found):
        hashes, places = (np.concatenate(x) for x in zip(*parts))
        if text and not len(hashes):
            whole = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")
            hashes, places = np.array([whole], np.uint64), np.zeros(1, np.int64)
        out.append((hashes, places))
    return out


def _anchors(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    at = np.empty(0, np.int64)
    hashes = np.empty(0, np.uint64)
    if len(buffer) >= K:
        words = _words(buffer)
        order = _mix(words)
        low = _smallest(order, K - S + 1)
        at = np.flatnonzero((low == order[:len(low)]) | (low == order[K - S:]))
        at = at[at + K <= ends[np.searchsorted(ends, at, "right")]]
        hashes = order[at]
        for inner in range(S, K, S):
            hashes = _mix(hashes + words[at + inner] * _PRIMES[0])
    cut = np.searchsorted(at, ends)
    return [(hashes[a:b], at[a:b] - begin) for a, b, begin in zip(np.r_[0, cut[:-1]].tolist(), cut.tolist(), (ends - sizes).tolist())]


def fingerprint(text: bytes, hashes: np.ndarray, places: np.ndarray) -> str:
    """All anchors of ``text`` with their distances, in hex."""
    last = int(places[-1]) + K if len(places) else 0
    rest = b"%d:" % len(text) + (text[:places[0]] + b"|" + text[last:] if len(places) else b"")
    steps = np.empty(len(places), _STEP)
    steps["hash"], steps["gap"] = hashes >> np.uint64(32), np.diff(places, prepend=0)
    return hashlib.blake2b(rest, digest_size=4).hexdigest() + steps.tobytes().hex()


def _chain(places: list[int]) -> int:
    """Length of the longest ascending subsequence."""
    ends: list[int] = []
    for x in places:
        at = bisect_left(ends, x)
        ends[at:at + 1] = [x]
    return len(ends)


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Of each pair of anchor sequences (hashes in the order of the text), the share of anchors that match by position."""
    sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
    keys = [np.concatenate([h >> np.uint64(32) for h in side] or [np.empty(0, np.uint64)]) | (np.repeat(np.arange(len(n)), n).astype(np.uint64) << np.uint64(32))
            for side, n in zip((left, right), sizes)]
    orders = [np.argsort(k, kind="stable") for k in keys]
    a, b = (k[o] for k, o in zip(keys, orders))
    here = np.arange(len(b))
    best = np.zeros(len(left), np.int64)
    for partner in (np.searchsorted(a, b) + here - np.searchsorted(b, b), np.searchsorted(a, b, "right") + here - np.searchsorted(b, b, "right")):
        known = (partner >= 0) & (partner < len(a))
        known[known] = a[partner[known]] == b[known]
        at = orders[0][partner[known]]
        by_left = np.argsort(at)
        to, row = orders[1][known][by_left], (b[known] >> np.uint64(32)).astype(np.int64)[by_left]
        chains = np.bincount(row, minlength=len(left))
        cut = np.r_[0, np.cumsum(chains)]
        for r in np.unique(row[1:][to[1:] < to[:-1]]).tolist():
            chains[r] = _chain(to[cut[r]:cut[r + 1]].tolist())
        best = np.maximum(best, chains)
    total = sizes[0] + sizes[1] - best
    return np.where(total > 0, best / np.maximum(total, 1), 1.0)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fingerprints(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with fingerprint, anchor_hash and anchor_at (byte positions of the anchors)."""
    def compute(texts: list[str | None]) -> list[pa.Array]:
        read = [_bytes(t) for t in texts]
        found = anchors(read)
        return [pa.array([fingerprint(t, *f) for t, f in zip(read, found)]), pa.array([h.view(np.int64) for h, _ in found], pa.list_(pa.int64())),
                pa.array([p for _, p in found], pa.list_(pa.int64()))]

    return with_computed(df, text_col, "fingerprint string, anchor_hash array<long>, anchor_at array<long>", compute)


_EDITED = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row, its fingerprint and that of its text after its last third is replaced by the beginning of the next row's text."""
    small_batches(df.sparkSession)
    return descending(df, id_col, text_col).mapInArrow(_compare, _EDITED)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the last row, whose successor is not read yet
    for batch in batches:
        bucket, look, ids, texts = [batch.column(i).to_pylist() for i in range(4)]
        texts = [t or "" for t in texts]
        rows = list(zip(bucket, look, ids, texts, anchors([_bytes(t) for t in texts])))
        pairs = [(a, b) for a, b in zip(([held] if held else []) + rows[:-1], rows if held else rows[1:]) if a[0] == b[0] and not a[1]]
        held = rows[-1] if rows else held
        if pairs:
            yield _compared(pairs)


def _compared(pairs: list) -> pa.RecordBatch:
    new = []
    for a, b in pairs:
        cut = len(a[3]) // 3
        new.append(_bytes(a[3][:len(a[3]) - cut] + b[3][:cut]))
    marks = anchors(new)
    own = [a[4][0] for a, _ in pairs]
    return pa.RecordBatch.from_arrays([
        pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in new]), pa.array([fingerprint(_bytes(a[3]), *a[4]) for a, _ in pairs]),
        pa.array([fingerprint(t, *m) for t, m in zip(new, marks)]),
        pa.array(likeness(own, [h for h, _ in marks])), pa.array(likeness(own, [b[4][0] for _, b in pairs])),
    ], [f.split()[0] for f in _EDITED.split(", ")])
