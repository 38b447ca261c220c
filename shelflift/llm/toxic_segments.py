"""Toxicity by maximum-scoring segments of token log-odds.

* Tokens are words (runs of letters and digits of any script, lower-cased). A token's log-odds compare its share in toxic and in other training documents, with a Dirichlet
  prior whose pseudo-counts follow its share among all documents; from them go ``caution`` standard errors, towards zero, and a constant drift. Tokens whose
  log-odds stay positive are kept with their first bytes as a second, weaker token for words not met in training; all others have the drift alone.
* Training rows vote by presence of a token, and documents that share their smallest hash of word triples share one vote, so copies do not count as evidence.
* A word that repeats the one before it counts as the drift: the calibration takes words as independent, which such rows are not.
* Ruzzo and Tompa's scan finds every maximal scoring segment of a text in linear time; only positive tokens are visited one by one.
* Segments are calibrated by extreme values: Karlin and Altschul's lambda is solved from the scores of non-toxic documents, K fitted to their largest segments. The
  evidence of a document is the smallest probability, over r, that a non-toxic text of its length has r segments this high. A logistic curve on evidence, fitted to
  training rows that the weights of that fit have not seen, turns it into a probability; the final weights then learn from all training rows.

Bounds: ``max_train`` training rows, drawn by hash of the id, evenly from both labels (each label has its weight in the curve); ``max_tokens`` scored tokens, those with the
largest scores. Pseudo-counts come from all documents. Rows are never drawn where their id is held out or null, or where the label is.

Null or empty text: no tokens, no evidence, the lowest score that the curve gives. An id with several labels has the largest; an id that several documents share is not learnt
from. Rows to score are kept as they come, with further columns; those named score, predicted or segments are replaced. Without rows of both labels every score is the share of toxic ones (0 without any).
A word beyond 1 MB counts as several.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelflift.llm.common import chunks_of, pin, small_batches, with_computed

_PIECE = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_A_INVERSE = np.uint64(pow(int(_A), -1, 1 << 64))
_BEGINNING = np.uint64(0x5851F42D4C957F2D)  # added to the hash of a word's first bytes


@dataclass(frozen=True)
class Params:
    max_train: int = 16_384
    max_tokens: int = 100_000
    prior: float = 1.0       # pseudo-count of a token of mean frequency
    caution: float = 1.5     # standard errors taken off
    drift: float = 0.3
    beginning: int = 4       # bytes
    threshold: float = 0.3


@dataclass
class Model:
    tokens: np.ndarray       # sorted hashes
    scores: np.ndarray
    drift: float
    beginning: int
    lam: float
    k: float
    curve: tuple[float, float]


# ---- tokens -----------------------------------------------------------------------------------------


def _is_word() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
    table[128:] = True
    return table


class Tokens:
    """Finds the words of texts as hashes, many texts at a time."""

    def __init__(self, beginning: int):
        self.beginning, self.word = beginning, _is_word()
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(_PIECE + 2, _A)])
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(_PIECE + 2, _A_INVERSE)])

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, hash, hash of the first bytes) of all words in order, in chunks; the second is 0 where the word has no more bytes than that."""
        pieces = []
        for row, text in enumerate(texts):
            data = (text or "").lower().encode("utf-8", "surrogatepass")
            at = 0
            while len(data) - at > _PIECE:
                near = np.frombuffer(data[at:at + _PIECE], np.uint8)
                gaps = np.flatnonzero(~self.word[near])
                end = at + (int(gaps[-1]) + 1 if len(gaps) else _PIECE)
                pieces.append((row, data[at:end]))
                at = end
            pieces.append((row, data[at:]))
        for lo, hi in chunks_of([len(d) + 1 for _, d in pieces], _PIECE + 1):
            yield self._chunk([r for r, _ in pieces[lo:hi]], [d for _, d in pieces[lo:hi]])

    def _chunk(self, rows: list[int], parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        inside = self.word[b]
        edges = np.flatnonzero(np.diff(np.r_[False, inside].view(np.int8)))
        start, end = edges[::2], edges[1::2]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b + np.uint64(1)) * self.powers[:len(b)], out=sums[1:])
        head = np.minimum(end, start + self.beginning)
        whole = _mixed((sums[end] - sums[start]) * self.back[start])
        first = np.where(head < end, _mixed((sums[head] - sums[start]) * self.back[start] + _BEGINNING), np.uint64(0))
        after = np.cumsum([len(p) + 1 for p in parts])
        return np.array(rows)[np.searchsorted(after, start, "right")], whole, first


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _by_row(chunks: Iterator[tuple[np.ndarray, ...]], n: int) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """The words of each row; rows come in order and may go on from one chunk to the next."""
    held: list[tuple[np.ndarray, ...]] = []
    at = 0
    for chunk in chunks:
        row = chunk[0]
        bounds = np.searchsorted(row, np.arange(at, n + 1))
        last = int(row[-1]) if len(row) else at
        for r in range(at, last):
            part = tuple(x[bounds[r - at]:bounds[r - at + 1]] for x in chunk[1:])
            yield r, tuple(np.concatenate(x) for x in zip(*held, part)) if held else part
            held = []
        held.append(tuple(x[bounds[last - at]:] for x in chunk[1:]))
        at = last
    for r in range(at, n):
        yield r, tuple(np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.uint64),) * 2
        held = []


# ---- segments ---------------------------------------------------------------------------------------


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa: all maximal scoring segments (start, end, score) in order, in time linear in the number of scores.

    Runs of one sign are summed first, so the scan visits a run of positive scores at a time. Each candidate keeps the sums before and after it; a new
    one joins all candidates back to the nearest with a smaller sum before it, if that one's sum after is smaller than its own.
    """
    positive = scores > 0
    edge = np.flatnonzero(np.diff(np.r_[False, positive, False].view(np.int8)))
    if not len(edge):
        return []
    begin, end = edge[::2], edge[1::2]
    total = np.r_[0.0, np.cumsum(scores, dtype=np.float64)]
    found: list[list] = []  # start, end, sum before, sum after, index of the nearest candidate with a smaller sum before
    for a, b, low, high in zip(begin.tolist(), end.tolist(), total[begin].tolist(), total[end].tolist()):
        start, before = a, low
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append([start, b, before, high, j])
                break
            start, before = found[j][0], found[j][2]
            back = found[j][4]
            del found[j:]
            j = back
    return [(s, e, high - low) for s, e, low, high, _ in found]


def evidence(segments: list[float], n: int, lam: float, k: float) -> float:
    """Minus the log of the smallest probability, over r, that a text of ``n`` tokens has r segments as high as its r highest by chance."""
    best = total = logs = 0.0
    for r, s in enumerate(sorted(segments, reverse=True), 1):
        x = lam * s - np.log(max(k * n, 1e-300))
        if x <= 0:
            break
        total += x
        logs += np.log(r)
        best = max(best, total - (r - 1) * np.log(total) + 2 * logs - np.log(r))  # -log of e^-T T^(r-1) / (r! (r-1)!)
    return float(best)


class Scorer:
    def __init__(self, tokens: np.ndarray, scores: np.ndarray, drift: float, beginning: int):
        self.tokens, self.beginning, self.find = tokens, beginning, None  # the finder's tables are made where it runs, not sent there
        self.scores = np.r_[scores, -drift].astype(np.float32)

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.tokens, hashes)
        at[at == len(self.tokens)] = 0
        return np.where(self.tokens[at] == hashes, at, len(self.tokens)) if len(self.tokens) else np.zeros(len(hashes), np.int64)

    def of(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """The score of each word of each text: that of the word, else of its first bytes, else the drift, as for a word that repeats the one before it."""
        self.find = self.find or Tokens(self.beginning)

        def scored():
            last = (-1, np.uint64(0))
            for row, whole, first in self.find.of(texts):
                at = self._place(whole)
                other = np.flatnonzero(at == len(self.tokens))
                at[other] = self._place(first[other])
                if len(row):
                    again = (np.r_[last[0], row[:-1]] == row) & (np.r_[last[1], whole[:-1]] == whole)
                    at[again] = len(self.tokens)
                    last = (row[-1], whole[-1])
                yield row, self.scores[at]

        for row, (scores, *_) in _by_row(scored(), len(texts)):
            yield row, scores


# ---- training ---------------------------------------------------------------------------------------


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _drawn(docs: DataFrame, labels: DataFrame, max_train: int) -> tuple[DataFrame, dict[int, int]]:
    """(id, toxic, half) of the documents to learn from, and the number of ids of each label there are. Half 1 is kept for the curve."""
    usable = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id"))
    said = pin(usable.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("id")), "labels")
    counts = {r["toxic"]: r["count"] for r in said.groupBy("toxic").count().collect()}
    small = min(counts.values(), default=0)
    each = {t: min(n, max(max_train // 2, max_train - small)) for t, n in counts.items()}
    spark = docs.sparkSession
    picked = None
    for t, n in each.items():
        # About twice the rows that are needed pass by their hash; the first of these are taken.
        share = max(1, counts[t] // (2 * n + 32))
        part = said.filter((F.col("toxic") == t) & (F.pmod("draw", F.lit(share)) == 0)).orderBy("draw", "id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        return spark.createDataFrame([], "id long, toxic int, half int"), counts
    half = (F.pmod(F.shiftrightunsigned("draw", 20), F.lit(3)) == 0).cast("int")
    picked = pin(picked.select("id", "toxic", half.alias("half")), "picked")
    alone = _texts(docs, picked).groupBy("id", "toxic", "half").agg(F.count("*").alias("rows")).filter("rows = 1").drop("rows")
    return pin(alone, "train"), counts


def _texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """``picked`` with the texts, which are read again each time rather than stored. At most ``max_train`` ids, so this broadcast is bounded."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(picked), "id")


def _context(texts: list[str | None]) -> list[pa.Array]:
    """The smallest hash of three words in a row of each text."""
    out = []
    for _, (whole, _) in _by_row(Tokens(1).of(texts), len(texts)):
        if len(whole) < 3:
            whole = np.r_[np.zeros(3 - len(whole), np.uint64), whole]
        out.append(int(_mixed(whole[:-2] * _A + whole[1:-1] * _B + whole[2:]).min().astype(np.int64)))
    return [pa.array(out, pa.int64())]


def _present(whole: np.ndarray, first: np.ndarray) -> np.ndarray:
    found = np.unique(np.r_[whole, first])
    return found[found != 0]


def _votes(docs: DataFrame, train: DataFrame, beginning: int) -> DataFrame:
    """(token, toxic, half, votes, docs) summed over training documents; each context has one vote in all."""
    seen = pin(with_computed(_texts(docs, train), "text", "context long", _context).drop("text"), "contexts")
    sizes = seen.groupBy("context").agg(F.count("*").alias("size"))
    voters = pin(seen.join(sizes, "context").select("id", "toxic", "half", (1 / F.col("size")).alias("vote")), "voters")
    shared = _texts(docs, voters).select("text", "toxic", "half", "vote")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Tokens(beginning)
        for batch in batches:
            toxic, half, vote = [batch.column(i).to_numpy() for i in (1, 2, 3)]
            token, of = [], []
            for row, (whole, first) in _by_row(find.of(batch.column(0).to_pylist()), batch.num_rows):
                here = _present(whole, first)
                token.append(here), of.append(np.full(len(here), row))
            of = np.concatenate(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(token).view(np.int64)), pa.array(toxic[of]), pa.array(half[of]), pa.array(vote[of])], ["token", "toxic", "half", "vote"])

    rows = shared.mapInArrow(run, "token long, toxic int, half int, vote double")
    return rows.groupBy("token", "toxic", "half").agg(F.sum("vote").alias("votes"), F.count("*").alias("docs"))


def _shares(docs: DataFrame, tokens: np.ndarray, beginning: int) -> tuple[np.ndarray, int]:
    """How many of all documents hold each of ``tokens``, and how many different tokens documents hold in sum."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts, total = Tokens(beginning), np.zeros(len(tokens) + 1, np.int64), 0
        for batch in batches:
            for _, (whole, first) in _by_row(find.of(batch.column(0).to_pylist()), batch.num_rows):
                here = _present(whole, first)
                at = np.searchsorted(tokens, here)
                at[at == len(tokens)] = 0
                counts[at[tokens[at] == here]] += 1
                total += len(here)
        counts[-1] = total
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(tokens) + 1)
    counts[found["at"]] = found["n"]
    return counts[:-1], int(counts[-1])


def shrunk_log_odds(toxic: np.ndarray, n_toxic: float, other: np.ndarray, n_other: float, share: np.ndarray, total: int, params: Params) -> np.ndarray:
    """Scores of tokens from their votes in toxic and other documents; ``share`` of ``total`` is a token's part of all documents' tokens.

    The prior of both classes follows the shares, in proportion to the size of each class, so a token without votes has log-odds 0.
    """
    mean = max(float(share.mean()), 1.0) if len(share) else 1.0
    alpha = params.prior * np.clip(share / mean, 0.5, 50)
    alpha0 = max(params.prior * total / mean, 2 * float(alpha.max(initial=1.0)))

    def side(y: np.ndarray, n: float) -> tuple[np.ndarray, np.ndarray]:
        part = n / (n_toxic + n_other)
        up = y + alpha * part
        return np.log(up / np.maximum(n + alpha0 * part - up, 1e-9)), 1 / up

    (a, var_a), (b, var_b) = side(toxic, n_toxic), side(other, n_other)
    delta, off = a - b, params.caution * np.sqrt(var_a + var_b)
    return np.sign(delta) * np.maximum(np.abs(delta) - off, 0) - params.drift


_BIN, _LOWEST, _BINS = 0.1, -12.0, 256


def _largest(scorer: Scorer) -> Callable:
    def compute(texts: list[str | None]) -> list[pa.Array]:
        n, top, bins = [], [], []
        for _, scores in scorer.of(texts):
            n.append(len(scores))
            top.append(max([s for *_, s in maximal_segments(scores)], default=0.0))
            at = np.clip((scores - _LOWEST) / _BIN, 0, _BINS - 1).astype(np.int64)
            bins.append(np.bincount(at, minlength=_BINS).astype("<i4").tobytes())
        return [pa.array(n, pa.int64()), pa.array(top, pa.float64()), pa.array(bins, pa.binary())]

    return compute


def decay(counts: np.ndarray, values: np.ndarray) -> float:
    """Karlin and Altschul's lambda: the positive root of sum p e^(lambda s) = 1, with one more token spread over the positive scores."""
    p = counts + (values > 0) / max(int((values > 0).sum()), 1)
    p = p / p.sum()
    if (p * values).sum() >= 0 or not (values > 0).any():
        return 1.0
    low, high = 0.0, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * values, 700))).sum() < 1 else (low, mid)
    return max(high, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Constant and slope, by Newton steps; the slope is not negative."""
    design, beta = np.c_[np.ones(len(x)), x], np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        penalty = ridge * np.array([1e-3, 1.0])
        step = np.linalg.solve((design * (weight * q * (1 - q))[:, None]).T @ design + np.diag(penalty), design.T @ (weight * (y - q)) - penalty * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    if beta[1] < 0:
        rate = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        return float(np.log(rate / (1 - rate))), 0.0
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """The model; ``docs`` has doc_id and text, ``labels`` doc_id and toxic. What reaches the driver is bounded by ``params``."""
    train, counts = _drawn(docs, labels, params.max_train)
    none = Model(np.zeros(0, np.uint64), np.zeros(0), params.drift, params.beginning, 1.0, 1.0, (0.0, 0.0))
    if len(counts) < 2:
        none.curve = (20.0 if counts.get(1) else -20.0, 0.0)
        return none
    votes = pin(_votes(docs, train, params.beginning), "votes")
    sums = {(r["toxic"], r["half"]): r["v"] for r in votes.groupBy("toxic", "half").agg(F.sum("votes").alias("v")).collect()}
    by_class = [F.sum(F.when((F.col("toxic") == t) & (F.col("half") == h), F.col("votes")).otherwise(0.0)).alias(f"v{t}{h}") for t in (0, 1) for h in (0, 1)]
    in_toxic = F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0))
    table = votes.groupBy("token").agg(*by_class, in_toxic.alias("docs")).filter("docs > 1").orderBy(
        F.desc(F.col("v10") + F.col("v11")), "token").limit(params.max_tokens).toPandas()
    tokens = table["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    tokens, table = tokens[order], table.iloc[order]
    share, total = _shares(docs, tokens, params.beginning)

    def scores(halves: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        y = [sum(table[f"v{t}{h}"].to_numpy() for h in halves) for t in (0, 1)]
        n = [max(sum(sums.get((t, h), 0.0) for h in halves), 1e-9) for t in (0, 1)]
        found = shrunk_log_odds(y[1], n[1], y[0], n[0], share, total, params)
        kept = found != -params.drift
        return tokens[kept], found[kept]

    first = scores((0,))
    scorer = Scorer(*first, params.drift, params.beginning)
    curve_rows = _texts(docs, train.filter("half = 1"))
    seen = with_computed(curve_rows.filter("toxic = 0").select("text"), "text", "n long, top double, bins binary", _largest(scorer)).drop("text").toPandas()
    bins = sum((np.frombuffer(b, "<i4").astype(np.float64) for b in seen["bins"]), np.zeros(_BINS))
    values = _LOWEST + _BIN * (np.arange(_BINS) + 0.5)
    known = np.bincount(np.clip((scorer.scores - _LOWEST) / _BIN, 0, _BINS - 1).astype(int), minlength=_BINS) > 0
    lam = decay(bins[known | (bins > 0)], values[known | (bins > 0)])
    n, top = seen["n"].to_numpy(float), seen["top"].to_numpy(float)
    long = n > 0
    k = float(min(max(long.sum() / max((n * np.exp(-lam * top))[long].sum(), 1e-300), 1e-6), 1.0)) if long.any() else 1.0
    model = Model(*first, params.drift, params.beginning, lam, k, (0.0, 1.0))
    got = with_computed(curve_rows.select("id", "toxic", "text"), "text", "x double", _evidence_only(model)).select("id", "toxic", "x").toPandas().sort_values("id")
    y = got["toxic"].to_numpy(float)
    each = {t: max(float((y == t).sum()), 1.0) for t in (0, 1)}
    weight = np.where(y == 1, counts[1] / each[1], counts[0] / each[0])
    weight *= len(y) / max(weight.sum(), 1e-9)
    model.curve = logistic(np.log1p(got["x"].to_numpy(float)), y, weight) if len(y) else (0.0, 0.0)
    model.tokens, model.scores = scores((0, 1))
    return model


def _evidence_only(model: Model) -> Callable:
    scorer = Scorer(model.tokens, model.scores, model.drift, model.beginning)

    def compute(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([evidence([x for *_, x in maximal_segments(s)], len(s), model.lam, model.k) for _, s in scorer.of(texts)], pa.float64())]

    return compute


SEGMENTS = "array<struct<start:bigint,end:bigint,score:double,expected:double>>"


def score(df: DataFrame, model: Model, params: Params = Params(), text_col: str = "text", significant: float = 0.05) -> DataFrame:
    """``df`` with score (0 to 1), predicted (score at least the threshold) and segments: the passages, in words, of which a non-toxic text of its length is
    expected to hold at most ``significant``, with their scores and these numbers."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
    made: list[Scorer] = []

    def compute(texts: list[str | None]) -> list[pa.Array]:
        if not made:
            made.append(Scorer(model.tokens, model.scores, model.drift, model.beginning))
        out, found = [], []
        for _, s in made[0].of(texts):
            segments = maximal_segments(s)
            x = np.log1p(evidence([v for *_, v in segments], len(s), model.lam, model.k))
            out.append(1 / (1 + np.exp(-np.clip(model.curve[0] + model.curve[1] * x, -30, 30))))
            odds = [(a, b, v, model.k * len(s) * float(np.exp(-model.lam * v))) for a, b, v in segments]
            found.append([dict(zip(("start", "end", "score", "expected"), o)) for o in odds if o[3] <= significant])
        return [pa.array(out, pa.float64()), pa.array([int(p >= params.threshold) for p in out], pa.int32()), pa.array(found, kind)]

    return with_computed(df, text_col, f"score double, predicted int, segments {SEGMENTS}", compute)
