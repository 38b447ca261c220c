"""Language identification with string kernels: blended-spectrum presence kernels, Nystroem landmarks, kernel ridge regression.

* A text's features are the n-grams of 1 to 3 bytes of its lower-cased UTF-8 form that occur in some landmark, present or not, however often.
  The kernel is the number of common n-grams over the root of the product of both numbers.
* Training rows are drawn by hash of the id within each language: all rows of a language up to a number that the languages share, the largest with which
  they take ``max_train`` in all, and one row at least. So every language of the labelled rows is learnt, however large or skewed the table is (an id
  counts once, with the smallest of its languages). Rows are never drawn where their id is held out.
* Landmarks are the first of these rows, equally many per language, or as many as it has. They span the feature space (Nystroem); one-versus-rest
  ridge regression is fitted there on all drawn rows. A language's rows weigh together what its labelled rows are, but no less than ``floor`` of all
  (or an equal part, if there are more languages than that allows), as the ridge would wipe out a smaller share.
* Scoring multiplies the presence matrix of a batch with the matrix of all landmarks, then with the weights.

There is no constant term, so a text that shares nothing with the landmarks scores 0 for every language; the score is the best
language's regression value, cut to 0 to 1.

``lang`` is read for training only. Null text or no letter: ``und``, score 0. Without labelled rows every text is ``und``. Rows are kept as they
come, with repeated and null ids (never held out, never trained on) and further columns; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from shelflift.llm.common import with_computed

MAX_N = 3
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_STARTS = (0, 1 << 8, (1 << 8) + (1 << 16))  # where the codes of n-grams of each length begin
_PIECE = 1 << 20
_CODES = (1 << 8) + (1 << 16) + (1 << 24)


@dataclass(frozen=True)
class Params:
    max_train: int = 4096
    landmarks: int = 64
    ridge: float = 1e-3
    floor: float = 1e-2


@dataclass
class Model:
    langs: list[str]
    vocabulary: np.ndarray  # codes of n-grams
    landmarks: np.ndarray   # (n-grams, landmarks), each column divided by the root of its sum
    weights: np.ndarray     # (landmarks, langs)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def codes(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text as numbers, piece by piece."""
    data = text.lower().encode("utf-8", "surrogatepass")
    for at in range(0, max(len(data), 1), _PIECE):
        b = np.frombuffer(data[at:at + _PIECE + MAX_N - 1], np.uint8).astype(np.int32)
        two = b[:-1] << 8 | b[1:]
        yield from (b, two + _STARTS[1], (two[:-1] << 8 | b[2:]) + _STARTS[2])


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _places(vocabulary: np.ndarray) -> np.ndarray:
    """Where each n-gram stands in the vocabulary; those outside go to one more place, which is dropped."""
    places = np.full(_CODES, len(vocabulary), np.int32)
    places[vocabulary] = np.arange(len(vocabulary), dtype=np.int32)
    return places


def kernels(texts: list[str], places: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Kernel values of texts (rows) and landmarks (columns)."""
    present = np.zeros((len(texts), len(landmarks) + 1), np.float32)
    for row, text in zip(present, texts):
        for grams in codes(text):
            row[places[grams]] = 1
    present = present[:, :-1]
    norm = np.sqrt(present.sum(1, keepdims=True))
    return present @ landmarks / np.maximum(norm, 1)


def _known_share(text: str, places: np.ndarray, size: int) -> float:
    """The share of a text's distinct n-grams that are in the vocabulary of that size."""
    grams = np.unique(np.concatenate([np.unique(c) for c in codes(text)]))
    return float((places[grams] < size).mean())


def _grams(texts: list[str | None]) -> list[pa.Array]:
    found = [np.unique(np.concatenate([np.unique(c) for c in codes(t or "")])).astype("<i4").tobytes() for t in texts]
    return [pa.array(found, pa.binary())]


def rows_each(counts: list[int], total: int) -> int:
    """The largest number of rows a language may have so that all have at most ``total``; 1 at least."""
    left = total
    for i, n in enumerate(sorted(counts)):
        most = left // (len(counts) - i)
        if n > most:
            return max(1, most)
        left -= n
    return max(counts)


def fit(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model, or None if no row may be learnt from. What reaches the driver is bounded by ``params`` and the number of languages."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    usable = docs.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out("id") & F.col("text").rlike(r"\p{L}"))
    ids = usable.select("id", "lang", F.xxhash64(F.col("id")).alias("draw"))
    counts = ids.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("first")).collect()
    if not counts:
        return None
    spark = docs.sparkSession
    most = rows_each([r["n"] for r in counts], params.max_train)
    # One row per language; about 2 to 4 times the rows needed pass, and always one.
    shares = spark.createDataFrame([(r["lang"], max(1, r["n"] // (2 * most + 32)), r["first"]) for r in counts], "_lang string, _share long, _first long")
    passed = ids.join(F.broadcast(shares), ids["lang"] == shares["_lang"]).filter(
        (F.pmod("draw", "_share") == 0) | (F.col("draw") == F.col("_first")))
    drawn = passed.groupBy("id", "draw").agg(F.min("lang").alias("lang")).select("id", "lang", F.shiftrightunsigned("draw", 16).alias("draw"))
    sample = drawn.toPandas().sort_values(["draw", "id"]).groupby("lang", sort=False).head(most)
    langs = sorted(sample["lang"].unique())
    each = -(-params.landmarks // len(langs))
    marks = sample.groupby("lang", sort=True).head(each)["id"]

    def rows_of(chosen) -> DataFrame:
        # At most max_train ids, or one per language, so this broadcast is bounded.
        return docs.join(F.broadcast(spark.createDataFrame([(int(i),) for i in chosen], "id long")), "id").groupBy("id").agg(
            F.min("text").alias("text"))

    grams = with_computed(rows_of(marks), "text", "grams binary", _grams).select("id", "grams").orderBy("id").collect()
    sets = [np.frombuffer(r["grams"], "<i4") for r in grams]
    vocabulary = np.unique(np.concatenate(sets))
    matrix = np.zeros((len(vocabulary), len(sets)), np.float32)
    for j, found in enumerate(sets):
        matrix[np.searchsorted(vocabulary, found), j] = 1 / np.sqrt(len(found))

    def scored(texts: list[str | None]) -> list[pa.Array]:
        values = kernels([t or "" for t in texts], _places(vocabulary), matrix)
        return [pa.array([v.astype("<f4").tobytes() for v in values], pa.binary())]

    fitted = with_computed(rows_of(sample["id"]), "text", "k binary", scored).select("id", "k").collect()
    lang_of = dict(zip(sample["id"], sample["lang"]))
    k = np.stack([np.frombuffer(r["k"], "<f4") for r in fitted]).astype(np.float64)
    target = np.array([[float(lang_of[r["id"]] == x) for x in langs] for r in fitted])
    gram = ((matrix > 0).T.astype(np.float64) @ (matrix > 0)) / np.outer(*[np.sqrt([len(s) for s in sets])] * 2)
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = k @ root
    n = np.array([{r["lang"]: r["n"] for r in counts}[x] for x in langs], np.float64)
    weight = target @ (np.maximum(n, n.sum() * min(params.floor, 1 / len(langs))) / target.sum(0))
    heavy = phi * (weight * len(k) / weight.sum())[:, None]
    w = np.linalg.solve(heavy.T @ phi + params.ridge * len(k) * np.eye(phi.shape[1]), heavy.T @ target)
    return Model(langs, vocabulary, matrix, (root @ w).astype(np.float32))


def predict(df: DataFrame, model: Model | None, text_col: str = "text", reach_below: float | None = None) -> DataFrame:
    """``df`` with lang_pred and score (0 to 1).

    With ``reach_below`` also ``reach``, by which a low score is to be measured, as a score grows with the length of the text: for texts that score less
    and have at least half of their n-grams among the landmarks', the largest kernel value with a landmark; 1 for all others.
    """
    extra = [] if reach_below is None else ["reach"]
    if model is None:
        return df.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), **{c: F.lit(1.0) for c in extra}})
    cache: list[np.ndarray] = []

    def compute(texts: list[str | None]) -> list[pa.Array]:
        if not cache:
            cache.append(_places(model.vocabulary))
        lang, score, reach = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.ones(len(texts))
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for at in range(0, len(known), 128):
            some = known[at:at + 128]
            near = kernels([texts[i] for i in some], cache[0], model.landmarks)
            values = near @ model.weights
            best = values.argmax(1)
            lang[some] = [model.langs[b] for b in best]
            score[some] = np.clip(values[np.arange(len(some)), best], 0, 1)
            for i, most in zip(some, near.max(1)):
                if extra and score[i] < reach_below and _known_share(texts[i], cache[0], len(model.vocabulary)) >= 0.5:
                    reach[i] = most
        return [pa.array(lang.tolist(), pa.string()), pa.array(score), *([pa.array(reach)] if extra else [])]

    return with_computed(df, text_col, ", ".join(["lang_pred string, score double", *(f"{c} double" for c in extra)]), compute)
