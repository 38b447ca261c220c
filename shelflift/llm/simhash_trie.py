"""SimHash fingerprints and their self-join by simultaneous traversal of a binary trie.

* Fingerprint: A-Z lower-cased, words split at space and tab to carriage return, shingles of ``words`` words with repeats, XXH64 with seed 42;
  a bit is 1 if more than half of the shingles have it. Fewer words: the whole sequence is one shingle. Null, empty and blank texts: fingerprint 0,
  linked like any other.
* Equal fingerprints are one class, so copies never meet pairwise. Of two fingerprints with at most ``bits`` differing bits, at least one of
  ``bits + 1`` blocks is equal: the classes are dealt by block value, each of which is the top of a trie whose leading levels are that block.
  A bucket above ``limit`` classes is dealt again by blocks of the bits that are still free, up to ``MAX_LEVEL`` times.
* In a bucket, the sorted fingerprints are the trie. Pairs of nodes are traversed together; the bits in which their prefixes differ are counted and a pair
  above the budget is dropped. Small pairs of nodes are compared in full. What leaves a bucket is a star per linked group, not its pairs.
* Component ids are the smallest doc_id that can be reached; null ids are larger than any other. Repeated rows are kept. An empty table gives an
  empty result; columns that are not named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelflift.llm.common import pin, small_batches, with_computed
from shelflift.llm.components import components

MAX_LEVEL = 4
_CHUNK = 1 << 15
_LEAF = 64 * 64


def fingerprint(text: str | None, words: int = 4) -> int:
    """The unsigned 64-bit SimHash of one text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    begin, end = starts[:n].tolist(), ends[min(words, len(tokens)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(line[a:b], 42) for a, b in zip(begin[at:at + _CHUNK], end[at:at + _CHUNK])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 4) -> DataFrame:
    """(doc_id, fp) per row of ``df``; fp holds the 64 bits in a signed long."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    small_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        hashed, "doc_id long, fp long")


def _masks(bits: int) -> list[dict[int, int]]:
    """Per level, the bits that are equal in a bucket by its path of block numbers."""
    levels = [{0: 0}]
    for _ in range(MAX_LEVEL):
        deeper = {}
        for path, fixed in levels[-1].items():
            free = [i for i in range(64) if not fixed >> i & 1]
            for c, block in enumerate(np.array_split(free, bits + 1)):
                deeper[path * (bits + 1) + c + 1] = fixed | sum(1 << int(i) for i in block)
        levels.append(deeper)
    return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(rows: DataFrame, bits: int, masks: dict[int, int]) -> DataFrame:
    """Each row of (path, fp) in the buckets of its child blocks."""
    fixed = F.create_map(*[F.lit(x) for path, mask in masks.items() for x in (path, _signed(mask))])
    return rows.select("fp", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(bits + 1)), lambda c: F.col("path") * (bits + 1) + c)).alias("path")).select(
        "path", F.col("fp").bitwiseAND(fixed[F.col("path")]).alias("key"), "fp")


def _common(x: int, y: int) -> int:
    """Length of the common prefix of two 64-bit numbers."""
    return 64 - (x ^ y).bit_length()


def linked(sorted_fps: np.ndarray, bits: int) -> np.ndarray:
    """For ascending distinct fingerprints, the index of the representative of each one's linked group."""
    label = np.arange(len(sorted_fps))
    values = sorted_fps.tolist()

    def join_leaf(a: int, b: int, c: int, d: int) -> None:
        left, right = np.nonzero(np.bitwise_count(sorted_fps[a:b, None] ^ sorted_fps[None, c:d]) <= bits)
        x, y = left + a, right + c
        x, y = x[x != y], y[x != y]
        while len(x):
            p, q = label[x], label[y]
            apart = p != q
            if not apart.any():
                break
            x, y, p, q = x[apart], y[apart], p[apart], q[apart]
            high, low = np.maximum(p, q), np.minimum(p, q)
            target = label.copy() if len(x) > len(label) else label
            np.minimum.at(target, high, low)
            label[:] = target
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    stack = [(0, len(values), 0, len(values))] if len(values) > 1 else []
    while stack:
        a, b, c, d = stack.pop()
        if (b - a) * (d - c) <= _LEAF:
            join_leaf(a, b, c, d)
            continue
        near, far = _common(values[a], values[b - 1]), _common(values[c], values[d - 1])
        depth = min(near, far)
        if depth and ((values[a] ^ values[c]) >> (64 - depth)).bit_count() > bits:
            continue
        if b - a > 1 and d - c > 1 and label[a] == label[c] and (label[a:b] == label[a]).all() and (label[c:d] == label[a]).all():
            continue
        if (a, b) == (c, d):
            m = a + _split(sorted_fps[a:b], values[a], depth)
            stack += [(a, m, m, b), (m, b, m, b), (a, m, a, m)]
        elif near <= far:
            m = a + _split(sorted_fps[a:b], values[a], depth)
            stack += [(m, b, c, d), (a, m, c, d)]
        else:
            m = c + _split(sorted_fps[c:d], values[c], depth)
            stack += [(a, b, m, d), (a, b, c, m)]
    return label


def _split(node: np.ndarray, first: int, depth: int) -> int:
    """Where the bit at ``depth`` turns to 1 in a node whose earlier bits are equal."""
    keep = 64 - depth
    pivot = ((first >> keep << keep) if depth else 0) | 1 << (keep - 1)
    return int(np.searchsorted(node, np.uint64(pivot)))


def _join_buckets(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
            yield from buckets(rows[:, :_last_start(rows)])
            rest = rows[:, _last_start(rows):]
        if rest is not None:
            yield from buckets(rest)

    def buckets(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.shape[1]:
            return
        edges = np.flatnonzero(np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(0), True])
        out_u, out_v = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a < 2:
                continue
            fps = np.sort(rows[2, a:b].view(np.uint64))
            label = linked(fps, bits)
            moved = label != np.arange(len(fps))
            if moved.any():
                out_u.append(fps[moved])
                out_v.append(fps[label[moved]])
        if out_u:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (out_u, out_v)], ["u", "v"])

    return run


def _last_start(rows: np.ndarray) -> int:
    """Where the last bucket begins, which may go on in the next batch."""
    same = (rows[:2] == rows[:2, -1:]).all(0)
    return int(len(same) - np.argmin(same[::-1])) if not same.all() else 0


def links(classes: DataFrame, bits: int = 4, limit: int = 50_000) -> DataFrame:
    """(u, v): stars that connect all fingerprints of ``classes`` (fp, distinct) within ``bits`` differing bits."""
    levels = _masks(bits)
    rows, found = classes.select(F.lit(0).alias("path"), "fp"), None
    for level in range(1, MAX_LEVEL + 1):
        dealt = _deal(rows, bits, levels[level])
        heavy = None
        if level < MAX_LEVEL:
            heavy = pin(dealt.groupBy("path", "key").count().filter(F.col("count") > limit).select("path", "key"), "heavy")
            if heavy.isEmpty():
                heavy = None
        light = dealt if heavy is None else dealt.join(heavy, ["path", "key"], "left_anti")
        joined = light.repartition("path", "key").sortWithinPartitions("path", "key").mapInArrow(_join_buckets(bits), "u long, v long")
        found = joined if found is None else found.unionByName(joined)
        if heavy is None:
            break
        rows = dealt.join(heavy, ["path", "key"]).select("path", "fp")
    return found


def near_duplicates(fps: DataFrame, bits: int = 4, limit: int = 50_000) -> DataFrame:
    """``fps`` (doc_id, fp) with component_id and root (a fingerprint that names the component). ``fps`` is read several times, so it should be stored."""
    return fps.join(_named(fps, bits, limit), "fp", "left")


def _named(fps: DataFrame, bits: int, limit: int) -> DataFrame:
    """(fp, root, component_id) for every fingerprint."""
    classes = pin(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes, bits, limit))
    named = pin(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "named")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(smallest, "root").select("fp", "root", "component_id")


def keep_first(docs: DataFrame, words: int = 4, bits: int = 4, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with one row per component: that with the smallest id; of rows that share it, any one.

    Rows with an id of their own are dropped by id. Null and repeated ids, where an id does not say which row is meant, are settled by fingerprint.
    """
    fps = pin(fingerprints(docs, text_col, id_col, words), "fingerprints")
    named = pin(_named(fps, bits, 50_000), "components")
    found = fps.join(named, "fp")
    later = found.filter("doc_id <> component_id").select("doc_id").distinct()
    shared = pin(fps.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select("doc_id"), "shared_ids")
    same = lambda other: docs[id_col].cast("long").eqNullSafe(other["doc_id"])
    first = docs.join(later, docs[id_col].cast("long") == later["doc_id"], "left_anti")
    if shared.isEmpty():
        return first
    computed = with_computed(docs.join(shared, same(shared), "left_semi"), text_col, "_fp long", lambda texts: [
        pa.array(np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts)).view(np.int64))])
    rows = computed.select(F.col("_fp").alias("fp"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(named, "fp")
    one = rows.filter(F.col("row")[id_col].cast("long").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.first("row").alias("row"))
    return first.join(shared, same(shared), "left_anti").unionByName(one.select("row.*"))
