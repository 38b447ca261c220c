"""Removal of repeated byte strings by deep-shallow suffix sorting.

A byte goes if some string of ``LENGTH`` = 200 bytes that covers it starts at another place too, in any text or the same one. Every such string (window)
is judged on the input; the texts that are left are not looked at again.

* Anchors. The anchor of a window is its leftmost 32-gram with the smallest hash, so equal windows have equal anchors at equal distances. Windows in a row with the
  same anchor make up a stretch; there is about one per 85 bytes. What is shuffled is one small row per stretch: hash of the anchor (unequal anchors with
  equal hashes only cost work), a 128-bit BLAKE2 digest of the stretch's bytes, which stands for them, and the place. Anchors that occur once cannot be in a
  repeated window.
* Equal stretches repeat as a whole. That settles everything but the ends of repeats: of stretches that differ but have the same anchor, one
  each is kept, with its bytes.
* Deep-shallow sorting of these: their suffixes from the anchor on are sorted by multikey quicksort to a shallow depth, and groups that agree
  so far by blind tries. The order of the suffixes one byte to the left follows from that order by a stable sort on that byte, and their common prefixes from
  minima over the old ones; so all windows are sorted, byte by byte to the left. A window is repeated if it shares 200 bytes with a neighbour in its order.
* Hot groups. Anchors that are frequent in a sample (at most ``HEAVY`` of them) are spread by salts, as many as their size asks for, and their counts are summed in two
  steps. An anchor with more than ``limit`` different stretches is dealt again by halves of the distance to the anchor. The windows of a half share
  a core of bytes around the anchor: a part of a stretch whose core is its own alone is dropped, parts that are equal are settled and go on as one, and groups of at
  most ``limit`` are sorted. A half of one distance has its windows as cores, so nothing is left there. No task holds more than ``limit`` stretches of one group.

Null text: empty. Texts below 200 bytes stay as they are. Repeated rows are occurrences of their own. Ids that are null or repeated are replaced by row numbers in
a stored copy. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelflift.llm.common import chunks_of, pin, small_batches

LENGTH, GRAM = 200, 32
REACH = LENGTH - GRAM              # the largest distance from a window's start to its anchor
SHALLOW = 48                       # bytes that multikey quicksort looks at
HEAVY, SAMPLE = 100_000, 64
_CHUNK = 1 << 17
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_A_INVERSE = np.uint64(pow(int(_A), -1, 1 << 64))
_PLACE = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    size, low = 1, x
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:len(x) - width + 1], low[width - size:]) if size < width else low


# ---- stretches ------------------------------------------------------------------------------------


class Stretches:
    """Finds the stretches of texts."""

    def __init__(self):
        self.powers = self.back = np.ones(1, np.uint64)

    def _room(self, n: int) -> None:
        if len(self.powers) <= n:
            n = max(n, 2 * _CHUNK)
            self.powers, self.back = np.cumprod(np.full(n + 1, _A)), np.cumprod(np.full(n + 1, _A_INVERSE))

    def find(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, anchor hash, stretch digests, start, windows, distance of the anchor), in chunks; long texts in pieces of windows."""
        pieces = [(row, at) for row, t in enumerate(texts) for at in range(0, len(t) - LENGTH + 1, _CHUNK)]
        size = lambda p: min(len(texts[p[0]]) - p[1], _CHUNK + LENGTH - 1)
        for lo, hi in chunks_of([size(p) for p in pieces], _CHUNK):
            some = pieces[lo:hi]
            yield self._chunk([row for row, _ in some], [at for _, at in some], [
                texts[row][at:at + _CHUNK + LENGTH - 1] for row, at in some])

    def _chunk(self, rows: list[int], offsets: list[int], parts: list[bytes]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(p) for p in parts])
        begin = np.cumsum(sizes) - sizes
        data = b"".join(parts)
        b = np.frombuffer(data, np.uint8)
        self._room(len(b) + 1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b + np.uint64(1)) * self.powers[:len(b)], out=sums[1:])
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * self.back[:len(b) - GRAM + 1])
        anchor = (_smallest((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), REACH + 1) & _PLACE).astype(np.int64)
        new = np.r_[True, anchor[1:] != anchor[:-1]]
        new[begin] = True
        stop = begin + sizes - LENGTH + 1  # after the last window of each part
        new[stop[stop < len(new)]] = True
        start = np.flatnonzero(new)
        part = np.searchsorted(begin, start, "right") - 1
        end = np.r_[start[1:], len(new)]
        inside = start < stop[part]
        start, end, part = start[inside], end[inside], part[inside]
        at = anchor[start] - start
        whole = [blake2b(data[i:j], digest_size=16).digest() for i, j in zip(start.tolist(), (end + LENGTH - 1).tolist())]
        return (np.array(rows)[part], grams[anchor[start]], whole, start - begin[part] + np.array(offsets)[part], end - start, at)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    finder = Stretches()
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for row, gram, whole, start, n, at in finder.find(batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays([
                pa.array(gram.view(np.int64)), pa.array(whole, pa.binary()), pa.array(keys[row]), pa.array(start << 16 | n << 8 | at)],
                ["gram", "whole", "key", "place"])


def stretches(docs: DataFrame) -> DataFrame:
    """(gram, whole, key, place) of every stretch of ``docs`` (key, bytes); ``place`` holds start, windows and distance in one number."""
    small_batches(docs.sparkSession)
    return docs.select("key", "bytes").mapInArrow(_find, "gram long, whole binary, key long, place long")


def _start() -> Column:
    return F.shiftright("place", 16)


def _windows() -> Column:
    return F.shiftright("place", 8).bitwiseAND(F.lit(255)).cast("int")


def _distance() -> Column:
    return F.col("place").bitwiseAND(F.lit(255)).cast("int")


def _ranges(rows: DataFrame) -> DataFrame:
    """(key, start, end) of whole stretches."""
    return rows.select("key", _start().alias("start"), (_start() + _windows() + LENGTH - 1).alias("end"))


# ---- sorting ------------------------------------------------------------------------------------


def multikey(rows: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes sorted within groups by their first ``depth`` bytes, and the number of each one's group of equals.

    Eight bytes are one key of the multikey quicksort; only groups of several rows go on to the next.
    """
    words = np.ascontiguousarray(rows[:, :depth]).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    same = group[order]
    tied = np.arange(len(order))
    for word in words.T:
        if not len(tied):
            break
        value = word[order[tied]]
        by = np.lexsort((value, same[tied]))
        order[tied], value = order[tied][by], value[by]
        left = same[tied]
        new = np.r_[True, (left[1:] != left[:-1]) | (value[1:] != value[:-1])]
        # Group numbers stay ascending along the order: the place of a group's first row.
        same[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        one = new & np.r_[new[1:], True]
        tied = tied[~one]
    return order, same


class BlindTrie:
    """Sorts strings by a trie that holds branching places and bytes only; strings are compared once per insertion."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray):
        self.width = rows.shape[1]
        self.text = [r.tobytes() for r in rows]
        self.number = [int.from_bytes(t, "big") for t in self.text]
        self.length = lengths.tolist()

    def _byte(self, i: int, depth: int) -> int:
        return self.text[i][depth] if depth < self.length[i] else -1

    def _common(self, i: int, j: int) -> int:
        apart = self.number[i] ^ self.number[j]
        return min(self.width - (apart.bit_length() + 7) // 8, self.length[i], self.length[j])

    def order(self) -> list[int]:
        root: list | tuple = [0]  # a leaf: the strings that are equal; a node: (depth, children by byte)
        for i in range(1, len(self.text)):
            node = root
            while type(node) is tuple:
                child = node[1].get(self._byte(i, node[0]))
                node = next(iter(node[1].values())) if child is None else child
            j = node[0]
            depth = self._common(i, j)
            if depth == self.length[i] == self.length[j]:
                node.append(i)
                continue
            above, node = None, root
            while type(node) is tuple and node[0] < depth:
                above, node = node, node[1][self._byte(i, node[0])]
            if type(node) is tuple and node[0] == depth:
                node[1][self._byte(i, depth)] = [i]
                continue
            fork = (depth, {self._byte(j, depth): node, self._byte(i, depth): [i]})
            if above is None:
                root = fork
            else:
                above[1][self._byte(i, above[0])] = fork
        out, stack = [], [root]
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack += [node[1][byte] for byte in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order of ``rows`` (bytes, padded with zeros) within groups: multikey quicksort, then blind tries where rows agree in all it saw."""
    order, same = multikey(rows, group, SHALLOW)
    edges = np.flatnonzero(np.r_[True, same[1:] != same[:-1], True])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a > 1:
            some = order[a:b]
            order[a:b] = some[BlindTrie(rows[some, SHALLOW:], np.maximum(lengths[some] - SHALLOW, 0)).order()]
    return order


def repeated_windows(group: np.ndarray, right: np.ndarray, right_n: np.ndarray, left: np.ndarray, left_n: np.ndarray,
                     low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which windows, by distance of their anchor, occur in several stretches of a group.

    ``right`` has the bytes from the anchor on, ``left`` those before it, the nearest first; ``low`` and ``high`` bound the distances asked for.
    """
    found = np.zeros((len(group), REACH + 1), bool)
    order = deep_shallow(right, right_n, group)
    a, b = order[:-1], order[1:]
    differ = right[a] != right[b]
    common = np.where(differ.any(1), differ.argmax(1), right.shape[1])
    common = np.minimum(common, np.minimum(right_n[a], right_n[b]))
    lcp = np.r_[-1, np.where(group[a] == group[b], common, -1), -1]  # lcp[i] is of rows i - 1 and i
    for distance in range(REACH + 1):
        hit = (np.maximum(lcp[:-1], lcp[1:]) >= LENGTH) & (low[order] <= distance) & (distance <= high[order])
        found[order[hit], distance] = True
        stay = np.flatnonzero((left_n[order] > distance) & (high[order] > distance))
        if len(stay) < 2 or distance == REACH:
            break
        rows = order[stay]
        key = group[rows].astype(np.int64) << 8 | left[rows, distance]
        by = np.argsort(key, kind="stable")
        at, key = stay[by], key[by]
        alike = np.flatnonzero(key[1:] == key[:-1])
        low_of = np.minimum.reduceat(np.r_[lcp, -1], np.c_[at[alike] + 1, at[alike + 1] + 1].ravel())[::2] if len(alike) else lcp[:0]
        new = np.full(len(at) + 1, -1, np.int64)
        new[alike + 1] = np.where(low_of >= 0, low_of + 1, -1)
        order, lcp = rows[by], new
    return found


_ROWS = 4096


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated ranges (key, start, end) from rows sorted by group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < _ROWS:
            continue
        table = pa.Table.from_batches(held)
        groups = table.column(0).to_numpy()
        cut = int(np.searchsorted(groups, groups[-1]))  # the last group may go on
        if cut:
            yield _sort_rows(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield _sort_rows(pa.Table.from_batches(held))


def _sort_rows(table: pa.Table) -> pa.RecordBatch:
    bucket, key, place, low, high, counted = [table.column(i).to_numpy() for i in range(6)]
    texts = table.column(6).to_pylist()
    anchor, at = (place >> 16) + (place & 255), high
    m = len(texts)
    right, left = np.zeros((m, LENGTH), np.uint8), np.zeros((m, REACH), np.uint8)
    for i, (t, d) in enumerate(zip(texts, at.tolist())):
        b = np.frombuffer(t, np.uint8)
        after = b[d:d + LENGTH]
        right[i, :len(after)] = after
        left[i, :d] = b[:d][::-1]
    right_n = LENGTH - low
    group = np.cumsum(np.r_[0, bucket[1:] != bucket[:-1]])
    found = repeated_windows(group, right, right_n, left, at, low, high)
    found[counted > 1] = False  # settled as a whole
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1  # distances first to last, so windows from at - last on
    return pa.RecordBatch.from_arrays(
        [pa.array(key[row]), pa.array(anchor[row] - last), pa.array(anchor[row] - first + LENGTH)], ["key", "start", "end"])


# ---- the whole table -------------------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, bytes) with keys that name one row each."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8").alias("bytes"))
    ids = rows.select("id")
    if ids.filter("id is null").isEmpty() and ids.groupBy("id").count().filter("count > 1").isEmpty():
        return rows.select(F.col("id").alias("key"), "id", "bytes")
    return pin(rows.select(F.monotonically_increasing_id().alias("key"), "id", "bytes"), "keyed")


def _heavy(docs: DataFrame) -> DataFrame | None:
    """(heavy_gram, salts): at most ``HEAVY`` anchors, those with more than a ``HEAVY``-th of a sample's stretches, and into how many parts of that size each is cut."""
    counts = pin(stretches(docs.filter(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0)).groupBy("gram").count(), "sample")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    most = max(16, total // HEAVY)
    some = [(r["gram"], -(-r["count"] // most)) for r in counts.filter(F.col("count") > most).collect()]
    return docs.sparkSession.createDataFrame(some, "heavy_gram long, salts long") if some else None


def _settle(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges that repeat as whole stretches, and one each of the different stretches with a common anchor: (gram, key, place, n)."""
    rows, heavy = stretches(docs), _heavy(docs)
    salt = F.lit(0)
    if heavy is not None:
        rows = rows.join(F.broadcast(heavy), F.col("gram") == F.col("heavy_gram"), "left")
        salt = F.when(F.col("heavy_gram").isNotNull(), F.pmod(F.xxhash64("key", "place"), F.col("salts")).cast("int") + 1).otherwise(0)
    rows = rows.select("gram", "whole", "key", "place", salt.alias("salt")).repartition("gram", "salt")
    same = Window.partitionBy("gram", "salt", "whole")
    counted = (
        rows.withColumn("i", F.row_number().over(same.orderBy("key", "place"))).withColumn("n", F.count("*").over(same))
        .withColumn("total", F.count("*").over(Window.partitionBy("gram", "salt")))
    )
    kept = pin(counted.filter("total > 1 or salt > 0").select(
        "gram", "whole", "key", "place", "salt", "n", (F.col("i") == 1).alias("first"), (F.col("n") < F.col("total")).alias("mixed")), "repeats")
    light = kept.filter("salt = 0")
    settled, open_ = _ranges(light.filter("n > 1")), light.filter("mixed and first").select("gram", "key", "place", "n")
    if heavy is not None:
        spread = kept.filter("salt > 0")
        each = pin(spread.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one")), "heavy")
        mixed = pin(each.groupBy("gram").count().filter("count > 1").select("gram"), "mixed")
        # What repeats under its own salt is settled; only the others ask whether it repeats elsewhere.
        single = spread.filter("n = 1").select("gram", "whole", "key", "place")
        settled = settled.unionByName(_ranges(spread.filter("n > 1"))).unionByName(_ranges(single.join(
            each.filter("n > 1").select("gram", "whole"), ["gram", "whole"])))
        open_ = open_.unionByName(each.join(mixed, "gram").select("gram", "one.key", "one.place", "n"))
    return settled, open_


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with its bytes compressed, for the way through a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([pack(b) for b in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _unpack():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each open stretch of a text with its bytes."""
    unpack = _unpack()
    for batch in batches:
        out = []
        for key, packed, items in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            text = unpack(packed)
            for x in items:
                start = x["place"] >> 16
                out.append((x["gram"], key, x["place"], x["n"], text[start:start + (x["place"] >> 8 & 255) + LENGTH - 1]))
        columns = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())], ["gram", "key", "place", "n", "bytes"])


def _with_bytes(docs: DataFrame, open_: DataFrame) -> DataFrame:
    items = open_.groupBy("key").agg(F.collect_list(F.struct("gram", "place", "n")).alias("items"))
    joined = _packed(docs.select("key", "bytes")).join(items, "key").select("key", "bytes", "items")
    return joined.mapInArrow(_cut, "gram long, key long, place long, n long, bytes binary")


def _halved(rows: DataFrame, span: int) -> DataFrame:
    """``rows`` cut into parts, one for each range of ``span`` distances in which a row has windows; its bucket names the bytes that all windows of the range share.

    ``bytes`` always begin with the window at distance ``high`` and end with that at ``low``.
    """
    first, last = F.expr(f"low div {span}"), F.expr(f"high div {span}")
    parts = rows.withColumn("r", F.explode(F.sequence(first, last))).withColumn("r", (F.col("r") * span).cast("int"))
    low, high, end = F.greatest("r", "low"), F.least(F.col("r") + (span - 1), "high"), F.least(F.col("r") + (span - 1), F.lit(REACH))
    core = F.substr("bytes", F.col("high") - F.col("r") + 1, F.lit(LENGTH) - end + F.col("r"))
    own = F.substr("bytes", F.col("high") - high + 1, F.lit(LENGTH) + high - low)
    return parts.select("gram", F.xxhash64("gram", "r", core).alias("bucket"), "key", "place", "n", low.alias("low"), high.alias("high"), own.alias("bytes"))


def _sorted_ranges(rows: DataFrame) -> DataFrame:
    columns = ["bucket", "key", "place", "low", "high", "n", "bytes"]
    return rows.select(*[F.col(c).cast("long") if c != "bytes" else c for c in columns]).repartition("bucket").sortWithinPartitions(
        "bucket").mapInArrow(_sort_groups, "key long, start long, end long")


def _ends(rows: DataFrame, limit: int) -> DataFrame:
    """Repeated ranges among different stretches (gram, key, place, n, bytes) with a common anchor."""
    rows = rows.withColumns({"bucket": F.col("gram"), "low": (_distance() - _windows() + 1).cast("int"), "high": _distance()})
    span, found = 1 << REACH.bit_length(), None
    while True:
        sizes = rows.groupBy("bucket").count()
        crowded = pin(sizes.filter(F.col("count") > limit).select("bucket"), "crowded")
        last = crowded.isEmpty()
        ready = rows if last else rows.join(crowded, "bucket", "left_anti")
        found = _sorted_ranges(ready) if found is None else found.unionByName(_sorted_ranges(ready))
        if last:
            return found
        span //= 2
        parts = pin(_halved(rows.join(crowded, "bucket").drop("bucket"), span).withColumn("whole", F.substring(F.unhex(F.sha2("bytes", 256)), 1, 16)), "parts")
        # Equal parts repeat; one of each goes on, as what the others may share windows with.
        same = ["bucket", "whole", "low", "high"]
        each = pin(parts.groupBy(*same).agg(F.count("*").alias("times"), F.sum("n").alias("n"), F.min(F.struct("key", "place", "gram", "bytes")).alias("one")), "each")
        begin = _start() + _distance() - F.col("high")
        equal = parts.filter("n = 1").join(pin(each.filter("times > 1").select(*same), "equal"), same)
        found = found.unionByName(equal.select("key", begin.alias("start"), (begin + F.col("high") - F.col("low") + LENGTH).alias("end")))
        shared = pin(each.groupBy("bucket").count().filter("count > 1").select("bucket"), "shared")
        rows = pin(each.join(shared, "bucket").select("one.gram", "bucket", "one.key", "one.place", "n", "low", "high", "one.bytes"), "going")


_KEPT = "key long, id long, kept binary, removed array<struct<start:bigint,end:bigint>>, n_bytes long"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack, kind = _unpack(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        kept, removed, sizes = [], [], []
        for packed, ranges in zip(batch.column(2).to_pylist(), batch.column(3)):
            text, runs = unpack(packed), []
            if ranges.is_valid and len(ranges.values):
                start, end = [ranges.values.field(i).to_numpy() for i in range(2)]
                by = np.argsort(start, kind="stable")
                start, reach = start[by], np.maximum.accumulate(end[by])
                new = np.r_[True, start[1:] > reach[:-1]]
                runs = list(zip(start[new].tolist(), reach[np.r_[new[1:], True]].tolist()))
            parts, at = [], 0
            for a, b in runs:
                parts.append(text[at:a])
                at = b
            parts.append(text[at:])
            kept.append(b"".join(parts)), removed.append([{"start": a, "end": b} for a, b in runs]), sizes.append(len(text))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(kept, pa.binary()), pa.array(removed, kind), pa.array(sizes, pa.int64())],
            ["key", "id", "kept", "removed", "n_bytes"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(id, kept, removed, n_bytes) per row: the bytes that stay, and the maximal runs of bytes that go."""
    keyed = _keyed(docs, id_col, text_col)
    settled, open_ = _settle(keyed)
    open_ = pin(_with_bytes(keyed, open_), "open")
    ranges = settled.unionByName(_ends(open_, limit)).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = _packed(keyed.select("key", "id", "bytes")).join(ranges, "key", "left").select("key", "id", "bytes", "ranges")
    return joined.mapInArrow(_remove, _KEPT).drop("key")
