"""Benchmark items in documents: SimHash of item-sized windows, multi-index Hamming search, exact verification.

* Words are runs of letters, digits and underscores, lower-cased; shingles are five words (of an item with fewer words: all of them).
* For every size that an item has, the windows of a document with that many words get a SimHash of their shingles, weighted by how often they occur.
  A text with fewer words than an item is one window, of all its words. With v shingles in the window and w in the item, a similarity of 0.8 takes at least
  0.8 * (v + w) / 1.8 common ones. Windows with fewer shingles that belong to any item of that size are passed over; this loses nothing.
* Index: 4 blocks of 16 bits. If two fingerprints differ in at most ``RADIUS`` = 15 bits, some block differs in at most 3, and the index
  holds every item under all values within 3 bits of each of its blocks, so all items within the radius are found. Texts shorter than an item are few
  once the bound holds, and are compared with all items of that size, whatever their fingerprints.
* Candidates are verified with the words themselves: weighted Jaccard similarity (sum of smaller over sum of larger counts) of at least 0.8.
  Per document and item, the best window is reported, the first of equals.

The benchmark is the query set. It goes to the tasks in blocks of some ``BLOCK_ITEMS`` items or ``BLOCK_BYTES``, each searched against all rows; documents are
not shuffled. Null or wordless texts and items: no match. An item without an id is found like any other, its matches have a null item_id and come last. Repeated rows are
each judged, repeated items count once, null ids and further columns are kept (one named matches or _found is replaced), and an empty table on either side gives no matches.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelflift.llm.common import chunks_of, with_computed

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 15
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4 << 20
MATCHES = "array<struct<item_id:bigint,start:int,end:int,similarity:double>>"
_WORD = re.compile(r"\w+")
_SEPARATOR = re.compile(rb"[ \n]")
_CHUNK = 1 << 20
_SEGMENT = 8192
_FILTER_BITS = 20
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))
_A_INVERSE = np.uint64(pow(int(_A), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def line_of(text: str | None) -> str:
    return " ".join(_WORD.findall(text or "")).lower()


def word_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and line number of each word; long lines are taken in parts between words."""
    data, at, line, found = "\n".join(lines).encode("utf-8", "surrogatepass"), 0, 0, []
    while at <= len(data):
        end = _SEPARATOR.search(data, at + 2 * _CHUNK) if len(data) - at > 2 * _CHUNK else None
        part = data[at:end.start() if end else len(data)]
        hashes, lines_of = _word_hashes(part)
        found.append((hashes, lines_of + line))
        line += part.count(b"\n") + (end is not None and end[0] == b"\n")
        at += len(part) + 1
    return tuple(np.concatenate(x) for x in zip(*found))


def _word_hashes(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    """From sums of bytes times powers, of which a word's is a difference."""
    b = np.frombuffer(part, np.uint8)
    cut = np.flatnonzero((b == 32) | (b == 10))
    start, end = np.r_[0, cut + 1], np.r_[cut, len(b)]
    line = np.r_[0, np.cumsum(b[cut] == 10)]
    powers, back = np.cumprod(np.full(len(b) + 1, _A)), np.cumprod(np.full(len(b) + 1, _A_INVERSE))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum((b + np.uint64(1)) * powers[:-1])]
    h = _mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    full = end > start
    return h[full], line[full]


def shingle_hashes(words: np.ndarray, q: int) -> np.ndarray:
    n = len(words) - q + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(q if n > 0 else 0):
        total = total * _A + words[k:k + n]
    return _mix(total)


def simhashes(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of the windows of ``width`` shingles at ``starts`` (ascending)."""
    out = []
    for lo in range(0, len(starts), _SEGMENT):
        some = starts[lo:lo + _SEGMENT]
        for run in np.split(some, np.flatnonzero(np.diff(some) > _SEGMENT) + 1):
            part = shingles[run[0]:run[-1] + width]
            ones = np.zeros((len(part) + 1, 64), np.int32)
            np.cumsum(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, out=ones[1:])
            most = 2 * (ones[run - run[0] + width] - ones[run - run[0]]) > width
            out.append(np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Index:
    """Items by the blocks of their fingerprints, and their shingles by item size."""

    def __init__(self, items: list[tuple[int | None, str]]):
        kept = [(i, line.split(" ")) for i, line in ((i, line_of(t)) for i, t in items) if line]
        self.ids = [i for i, _ in kept]
        self.sizes = np.array([len(w) for _, w in kept], np.int64)
        self.counts = [_shingles(w, min(SHINGLE, len(w))) for _, w in kept]
        self.fps = np.zeros(len(kept), np.uint64)
        by_q: dict[int, list[tuple[np.ndarray, int]]] = {}
        for n, (_, words) in enumerate(kept):
            q = min(SHINGLE, len(words))
            hashes = shingle_hashes(word_hashes([" ".join(words)])[0], q)
            self.fps[n] = simhashes(hashes, np.zeros(1, np.int64), len(hashes))[0]
            by_q.setdefault(q, []).append((hashes, len(words)))
        self.known = {}
        for q, found in by_q.items():
            pairs = np.unique(np.rec.fromarrays([
                np.concatenate([h for h, _ in found]), np.concatenate([np.full(len(h), size) for h, size in found])], names="key,size"))
            sieve = np.zeros(1 << _FILTER_BITS, bool)
            sieve[pairs["key"] >> np.uint64(64 - _FILTER_BITS)] = True
            self.known[q] = (sieve, pairs["key"].copy(), pairs["size"].astype(np.int64))
        near = np.array([sum(1 << b for b in bits) for r in range(RADIUS // 4 + 1) for bits in combinations(range(16), r)], np.uint16)
        self.blocks = []
        for j in range(4):
            values = (self.fps >> np.uint64(16 * j)).astype(np.uint16)
            probes = (values[:, None] ^ near[None, :]).ravel()
            order = np.argsort(probes, kind="stable")
            self.blocks.append((probes[order], np.repeat(np.arange(len(kept)), len(near))[order]))

    def near(self, fps: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) of one size within the radius."""
        pairs = []
        for j, (values, items) in enumerate(self.blocks):
            block = (fps >> np.uint64(16 * j)).astype(np.uint16)
            lo, hi = np.searchsorted(values, block, "left"), np.searchsorted(values, block, "right")
            window = np.repeat(np.arange(len(fps)), hi - lo)
            at = np.arange(len(window)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
            item = items[at]
            good = (self.sizes[item] == size) & (np.bitwise_count(fps[window] ^ self.fps[item]) <= RADIUS)
            pairs.append(window[good] * len(self.ids) + item[good])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.ids), both % len(self.ids)

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        found = []
        for lo, hi in chunks_of([len(t or "") for t in texts], _CHUNK):
            lines = [line_of(t) for t in texts[lo:hi]]
            words, line = word_hashes(lines)
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for q in self.known:
                self._search(q, words, line, lines, best)
            found += [self._report(texts[lo + i], [(k, v) for k, v in best.items() if k[0] == i]) for i in range(hi - lo)] if best else [
                [] for _ in range(lo, hi)]
        return found

    def _search(self, q: int, words: np.ndarray, line: np.ndarray, lines: list[str], best: dict) -> None:
        shingles = shingle_hashes(words, q)
        sieve, keys, sizes = self.known[q]
        hit = np.flatnonzero(sieve[shingles >> np.uint64(64 - _FILTER_BITS)])
        hit = hit[line[hit] == line[hit + q - 1]]
        lo, hi = np.searchsorted(keys, shingles[hit], "left"), np.searchsorted(keys, shingles[hit], "right")
        for doc in np.unique(line[hit[hi > lo]]).tolist():
            first, last = np.searchsorted(line, [doc, doc + 1])
            own = shingles[first:last - q + 1]
            inside = (line[hit] == doc) & (hi > lo)
            at = np.repeat(hit[inside] - first, (hi - lo)[inside])
            n = (hi - lo)[inside]
            size_of = sizes[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[inside], n)]
            text = None
            for size in np.unique(size_of).tolist():
                taken = min(size, int(last - first))
                width = taken - q + 1
                member = np.zeros(len(own) + 1, np.int64)
                member[at[size_of == size] + 1] = 1
                total = np.cumsum(member)
                least = SIMILARITY * (width + size - q + 1) / (1 + SIMILARITY)
                starts = np.flatnonzero(total[width:] - total[:len(total) - width] >= least - 1e-9)
                if not len(starts):
                    continue
                if taken < size:
                    items = np.flatnonzero(self.sizes == size)
                    windows = np.zeros(len(items), np.int64)
                else:
                    windows, items = self.near(simhashes(own, starts, width), size)
                text = lines[doc].split(" ") if text is None and len(windows) else text
                for start, item in zip(starts[windows].tolist(), items.tolist()):
                    s = similarity(_shingles(text[start:start + taken], q), self.counts[item])
                    if s >= SIMILARITY and s > best.get((doc, item), (0.0,))[0]:
                        best[doc, item] = (s, start, taken)

    def _report(self, text: str, best: list) -> list[dict]:
        if not best:
            return []
        places = [m.span() for m in _WORD.finditer(text)]
        return sorted(({"item_id": self.ids[item], "start": places[start][0], "end": places[start + size - 1][1], "similarity": s}
                       for (_, item), (s, start, size) in best), key=lambda m: (m["item_id"] is None, m["item_id"] or 0, m["start"]))


def _shingles(words: list[str], q: int) -> Counter:
    return Counter(tuple(words[i:i + q]) for i in range(len(words) - q + 1))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags."""
    common = sum((a & b).values())
    return common / max(1, sum(a.values()) + sum(b.values()) - common)


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` with ``matches``: item_id, start and end (code points, end exclusive) and similarity of each item found."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).dropna(subset=["text"]).distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    out = docs.withColumn("matches", F.array().cast(MATCHES))
    for block in range(blocks):
        some = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()]
        found = with_computed(out, text_col, f"_found {MATCHES}", _searcher(some))
        out = found.withColumn("matches", F.concat("matches", "_found")).drop("_found")
    return out


def _searcher(items: list[tuple[int | None, str]]):
    built: list[Index] = []

    def compute(texts: list[str | None]) -> list[pa.Array]:
        if not built:
            built.append(Index(items))
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("similarity", pa.float64())]))
        return [pa.array(built[0].search(texts), kind)]

    return compute
