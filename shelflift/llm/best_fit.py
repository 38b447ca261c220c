"""Best-fit packing of token sequences, in rounds over the whole corpus.

* Tokens: byte-level BPE, then an end id. Longer documents than the capacity are cut into whole pieces; the first piece takes what is over.
* Pieces are sorted by range of length, so that no length, however common, ends up in one task, and get a rank within their length.
* One round per length, longest first: all pieces of that length look up their successor, the smallest gap that holds them. Claims to the same gap
  are settled by rank: gap ``i`` of a class takes the next ``gap // length`` ranks. The gaps are updated, and pieces that find none open sequences.
  This gives what best-fit decreasing gives, piece by piece.
* Lengths and gaps are at most the capacity, so a round works on classes: counts per length (at most ``capacity`` numbers) are all that reaches
  the driver. What comes back are blocks of ranks, which are expanded on the executors to one slot per piece and joined on (length, rank).

Null text: empty, which is one piece with the end id alone. Repeated rows and null ids are packed like any other row. An empty table
gives an empty result. Columns of the input are carried along; those named like an added column are replaced.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelflift.llm.common import pin, small_batches

CAPACITY = 2048
END_ID = 0
RANKS, VOCABULARY, ENDING = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "<|endoftext|>"
# Characters on which the two libraries' classes of letters, digits and blanks are the same beyond doubt.
_COMMON = re.compile("[\t\n\r\x20-\x7e¡-¬®-ɏ]*")
_SLOTS = 4096


def encoder():
    """A function from text to an array of ids.

    The ids are those of ``tokenizers``; common characters go through ``tiktoken`` with the same vocabulary, which is five times as fast.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = []

    def encode(text: str) -> np.ndarray:
        if ENDING not in text and _COMMON.fullmatch(text):
            return fast.encode_to_numpy(text, disallowed_special=())
        if not whole:
            whole.append(Tokenizer.from_file(public_tokenizers.path(VOCABULARY)))
        return np.asarray(whole[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def pieces(df: DataFrame, text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the columns of ``df`` but the text, and piece, start, length, ids (unsigned 32 bit, little-endian)."""
    added = ["piece", "start", "length", "ids"]
    kept = [c for c in df.columns if c not in (*added, text_col)]
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            rows, number, start, length, ids = [], [], [], [], []
            for row, text in enumerate(batch.column(len(kept)).to_pylist()):
                tokens = np.append(encode(text or ""), np.uint32(END_ID))
                at, i = 0, 0
                while at < len(tokens):
                    to = at + (len(tokens) - at - 1) % capacity + 1
                    rows.append(row), number.append(i), start.append(at), length.append(to - at)
                    ids.append(tokens[at:to].astype("<u4").tobytes())
                    at, i = to, i + 1
            carried = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:len(kept)]]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                [*kept, *added])

    from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

    schema = StructType([f for f in df.schema.fields if f.name in kept] + [
        StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType())])
    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).cast("string").alias("_text_to_read")).mapInArrow(run, schema)


def rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Blocks (length, first rank, pieces, first sequence, pieces per sequence, offset) from the number of pieces of each length."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, sequences) with that much room
    order: list[int] = []
    blocks, opened = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            i = bisect_left(order, length)
            if i < len(order):
                gap = order[i]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(i)
            else:
                gap = capacity
                first, n = opened, -(-(total - rank) // (capacity // length))
                opened += n
            each = gap // length
            used = min(n, -(-(total - rank) // each))
            placed = min(total - rank, used * each)
            add(gap, first + used, n - used)
            blocks.append((length, rank, placed, first, each, capacity - gap))
            full, rest = divmod(placed, each)
            add(gap - each * length, first, full)
            if rest:
                add(gap - rest * length, first + full, 1)
            rank += placed
    return blocks


def _slots(spark: SparkSession, blocks: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """One row (length, rank, sequence_id, offset) per piece; large blocks are spread before they are expanded."""
    names = ["length", "first_rank", "n", "first", "each", "base"]
    columns = np.array(blocks, np.int64).reshape(-1, len(names)).T
    table = spark.createDataFrame(pa.table({name: pa.array(c) for name, c in zip(names, columns)}))
    parts = table.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_SLOTS}"))))
    each = parts.repartition("length", "first_rank", "part").withColumn("j", F.explode(F.sequence(
        F.col("part") * _SLOTS, F.least("n", (F.col("part") + 1) * _SLOTS) - 1)))
    return each.select(
        "length", (F.col("first_rank") + F.col("j")).alias("rank"), (F.col("first") + F.expr("j div each")).alias("sequence_id"),
        (F.col("base") + F.col("j") % F.col("each") * F.col("length")).alias("offset"))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with sequence_id and offset. It has a column length (1 to ``capacity``), and is read more than once, so it should be stored."""
    keyed = cut.drop("sequence_id", "offset")
    ranged = pin(keyed.withColumn("_key", F.monotonically_increasing_id()).repartitionByRange("length", "_key")
                 .withColumn("_part", F.spark_partition_id()), "ranged")
    parts = pin(ranged.groupBy("_part", "length").agg(F.count("*").alias("_n")), "lengths")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("_part", "length").orderBy("_key")
    ranked = ranged.withColumn("_place", F.row_number().over(within) - 1).join(first, ["_part", "length"])
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = _slots(cut.sparkSession, rounds(counts, capacity))
    # There are as many slots as pieces, though what Spark sees of them is the size of the blocks: merge, never broadcast.
    placed = ranked.withColumn("rank", F.col("_first") + F.col("_place")).join(slots.hint("merge"), ["length", "rank"])
    return placed.select(*keyed.columns, "sequence_id", "offset")
