"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``. Columns beyond those of ``documents`` are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelflift.llm import best_fit, decontaminate, lang_kernel, pii_votes, simhash_trie
from shelflift.llm.common import pin, table

# A text whose best language gets less than this share of its reach (less than 1 for short texts of known n-grams) is like none of those learnt.
MIN_LANGUAGE_SCORE = 0.1
WORDS, BITS = 4, 4


def _beside(docs: DataFrame, names: list[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` applied to ``docs`` while its own columns with one of ``names`` are set aside."""
    moved = {c: f"_aside_{c}" for c in docs.columns if c in names}
    return step(docs.withColumnsRenamed(moved)).select(*[F.col(f"`{moved.get(c, c)}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts that are like no learnt language."""
    model = lang_kernel.fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return _beside(docs, ["lang_pred", "score", "reach"], lambda d: lang_kernel.predict(d, model, reach_below=MIN_LANGUAGE_SCORE).filter(
        (F.col("lang_pred") != lang_kernel.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE * F.col("reach"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component."""
    return _beside(docs, ["_fp"], lambda d: simhash_trie.keep_first(d, WORDS, BITS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _beside(docs, ["matches", "_found"], lambda d: decontaminate.matches(d, benchmark).filter(F.size("matches") == 0))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets."""
    def step(d: DataFrame) -> DataFrame:
        found = pii_votes.personal_data(d)
        clean = found.withColumn("text", pii_votes.redacted(F.col("text"), F.concat("base", "added")))
        return clean.withColumn("n_chars", F.length("text").cast(dict(d.dtypes)["n_chars"])) if "n_chars" in d.columns else clean

    return _beside(docs, ["base", "added", "candidates"], step)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    cut = best_fit.pieces(docs.select("doc_id", "text"))
    stored = pin(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return best_fit.pack(stored).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# SimHash, string kernels and tokens are not expressible in SQL; the tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = pin(docs, name)
    return docs
