"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelflift.sources.tables import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pin(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 256, mb: int = 16) -> None:
    """Bound what one Arrow batch holds, so that long texts do not fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def chunks_of(sizes: Sequence[int], limit: int):
    """Consecutive index ranges whose sizes add up to at most ``limit``; a larger item stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


# ---- spans of regular expressions, as DataFrame functions ---------------------------------------------

# Matches are numbered in blocks, so that running positions cost no more than this many copies of each match.
_BLOCK = 128
SPAN = "struct<start:int,end:int,hit:string>"


def match_spans(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<start,end,hit>>, in code points.

    The pieces between matches and the matches themselves alternate, so running lengths are positions.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(
        F.length(g).alias("gap"), F.length(h).alias("len"), h.alias("hit")))
    empty = F.lit(None).cast(f"array<{SPAN}>")
    found = _running(parts)
    return F.when(text.rlike(pattern), found).otherwise(F.coalesce(empty, F.array().cast(f"array<{SPAN}>")))


def _running(parts: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["len"]
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), x["hit"].alias("hit")))).alias("out"))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(parts, b * _BLOCK + 1, F.lit(_BLOCK)), start, step),
    )

    def shifted(blocks: Column) -> Column:
        bases = F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        )["out"]
        return F.flatten(F.zip_with(blocks, bases, lambda b, base: F.transform(b["out"], lambda s: F.struct(
            (s["start"] + base).alias("start"), (s["end"] + base).alias("end"), s["hit"].alias("hit")))))

    return let(blocks, shifted)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


# ---- columns computed by a function of whole texts, in Arrow batches ---------------------------------


def with_computed(df: DataFrame, text_col: str, fields: str, compute: Callable) -> DataFrame:
    """``df`` with the columns ``fields`` (DDL) that ``compute(texts) -> list of pyarrow arrays`` yields for a batch.

    A column of ``df`` with one of these names is replaced. Rows stay where they are: no shuffle, one batch in memory.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(fields)
    kept = [c for c in df.columns if c not in added.names]
    schema = StructType([f for f in df.schema.fields if f.name in kept] + added.fields)
    small_batches(df.sparkSession)
    n_kept, names = len(kept), [*kept, *added.names]
    own = text_col in kept and dict(df.dtypes)[text_col] == "string"
    text_at = kept.index(text_col) if own else n_kept

    def run(batches):
        for batch in batches:
            new = compute(batch.column(text_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *new], names)

    read = [] if own else [F.col(text_col).cast("string").alias("_text_to_read")]
    return df.select(*[F.col(f"`{c}`") for c in kept], *read).mapInArrow(run, schema)
