"""Merkle manifest, filter audit and toxicity, against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflift.llm import filter_audit as fa, merkle, toxic_segments as ts

SF = "/root/testdata/sf0.01"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, idx int, grp string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    texts = [None if v is None else str(v) for v in row]
    return h(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(nodes, fanout):
    """The root, and per leaf its siblings by level as (before, after)."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // fanout * fanout:][:fanout]
            proofs[i].append((run[:place % fanout], run[place % fanout + 1:]))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [p // fanout for p in at]
    return level[0], proofs


def brute_manifest(rows, fanout, tampered):
    groups = {}
    for row in rows:
        groups.setdefault("" if row[2] is None else "+" + row[2], []).append(row)
    names = sorted(groups, key=lambda g: g.encode())
    out, subroots, inner = [], [], {}
    for g in names:
        placed = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        root, proofs = tree([leaf_of(r) for r in placed], fanout)
        subroots.append(root)
        inner[g] = (placed, proofs)
    root, over = tree(subroots, fanout)
    for g, top in zip(names, over):
        for row, proof in zip(*inner[g]):
            path = proof + top
            changed = tampered(row[0]) and row[3] is not None
            now = leaf_of((*row[:3], row[3] + 1, row[4])) if changed else leaf_of(row)
            for before, after in path:
                now = h(*before, now, *after)
            out.append((row[0], leaf_of(row), subroots[names.index(g)], root, h(*[d for b, a in path for d in (*b, *a)]), now, now == root))
    return Counter(out)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_is_that_of_a_plain_tree(frame, fanout):
    rnd = random.Random(fanout)
    rows = [(i if i % 13 else None, rnd.choice(["a", None, "é"]), rnd.choice(["en", "en", "en", "de", "", None, "é"]), rnd.choice([None, i]), rnd.choice([None, "", "é" * i, "x"]))
            for i in range(90)]
    rows += [(5, "a", "en", 1, "x")] * 7 + [(200, "a", "alone", 1, "x" * 5000)]
    tampered = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 0
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got, height = merkle.manifest(frame(SCHEMA, [(*r, "own", 1, "own") for r in rows]), "doc_id", "lang", FIELDS, {
        "n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, fanout)
    start = F.when(hit, F.col("changed")).otherwise(F.col("leaf"))
    again = merkle.folded(start, F.col("proof"), [(F.col("idx"), F.col("n")), (F.col("top_idx"), F.col("top_n"))], fanout, height)
    text = lambda c: F.lower(F.hex(c))
    found = got.withColumn("again", again).select("doc_id", text("leaf"), text("subroot"), text("root"), F.sha2(text("proof"), 256), text("again"), F.col("again") == F.col("root"))
    assert Counter(tuple(r) for r in found.collect()) == brute_manifest(rows, fanout, tampered)


def test_manifest_of_one_row_and_of_none(frame):
    one, height = merkle.manifest(frame(SCHEMA, [(1, None, None, None, None, "", 0, "")]), "doc_id", "lang", FIELDS)
    row = one.first()
    assert height == 0 and bytes(row.leaf) == bytes(row.root) and bytes(row.proof) == b"" and bytes(row.leaf).hex() == h("1:1----")
    assert merkle.manifest(frame(SCHEMA, []), "doc_id", "lang", FIELDS)[0].isEmpty()


def failures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text)}


def test_audit_counts_every_order(frame):
    rnd = random.Random(1)
    docs, labels = [], []
    for i in range(120):
        text = " ".join(rnd.choice(["ab", "cd", "Éf", "QX", "a#", "zz\x0b", "w%d" % rnd.randrange(300)]) for _ in range(rnd.choice([0, 1, 40, 80, 300])))
        docs.append((None if i % 31 == 0 else i % 100, None if i % 11 == 0 else text if i % 3 else "same text", rnd.choice(["s", "t", "", None]), i, "x"))
        if i % 2:
            labels += [(i % 100 if i % 9 else None, rnd.choice([0, 1, None]), rnd.choice([0, 1]))] * rnd.choice([1, 2])
    docs.append((7, "long " * 100_000, "s", 1, "x"))
    d = frame("doc_id long, text string, source string, mask int, part string", docs)
    got = fa.audit(fa.cells(fa.facts(d), frame("doc_id long, quality int, toxic int", labels))).collect()
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest, seen = {}, []
    for i, text, *_ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    for i, text, part, *_ in docs:
        fails = failures(text or "") | {"E": i is not None and i > smallest[text or ""]}
        seen.append((part or "", frozenset(f for f, bad in fails.items() if bad), i in good, i in toxic))
    want, shapley = {}, Counter()
    for part in {s[0] for s in seen}:
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [s for s in seen if s[0] == part]
                removed = [s for s in here if f in s[1] and not s[1] & before]
                want[part, order, step] = (
                    sum(not s[1] & (before | {f}) for s in here), len(removed), sum(f in s[1] and bool(s[1] & before) for s in here),
                    sum(s[1] == {f} for s in here), sum(s[2] for s in removed), sum(s[3] for s in removed))
                shapley[part, f] += len(removed)
    assert len(got) == len(want) == 3 * 600
    for r in got:
        assert tuple(r)[3:9] == want[r.part, r.filter_order, r.step] and r.shapley == shapley[r.part, r.filter_order[r.step - 1]]
    assert {s for _, fails, *_ in seen for s in fails} == set("ABCDE")


def test_audit_of_an_empty_table_and_of_other_filters(frame, spark):
    none = fa.facts(frame("doc_id long, text string, source string", []))
    assert fa.audit(fa.cells(none, frame("doc_id long, quality int, toxic int", []))).isEmpty()
    assert fa.walk(spark, "xy").count() == 4 * 4
    with pytest.raises(ValueError):
        fa.walk(spark, "ABCDEFG")


def test_maximal_segments_are_those_of_the_definition():
    """Recursively: the segment of the largest sum (the shortest, then the first), then the same left and right of it."""
    def plain(scores, at=0):
        best = None
        for i in range(len(scores)):
            for j in range(i + 1, len(scores) + 1):
                key = (sum(scores[i:j]), -(j - i), -i)
                if key[0] > 0 and (best is None or key > best[0]):
                    best = (key, i, j)
        if best is None:
            return []
        _, i, j = best
        return plain(scores[:i], at) + [(at + i, at + j, best[0][0])] + plain(scores[j:], at + j)

    rnd = random.Random(5)
    for _ in range(400):
        scores = [rnd.randrange(-64, 65) + rnd.random() for _ in range(rnd.randrange(14))]
        got = ts.maximal_segments(np.array(scores))
        want = plain(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])


def test_calibration():
    values, counts = np.array([-1.0, 1.0]), np.array([3e9, 1e9])
    assert abs(ts.decay(counts, values) - np.log(3)) < 1e-6  # sum p e^(lambda s) = 1 at log(q / p)
    assert ts.evidence([], 10, 1.0, 0.1) == 0 and ts.evidence([0.5], 1000, 1.0, 0.1) == 0
    one = ts.evidence([20.0], 100, 1.0, 0.1)
    assert abs(one - (20 - np.log(10))) < 1e-9 and ts.evidence([20.0, 20.0], 100, 1.0, 0.1) > one
    x = np.r_[np.zeros(90), np.full(10, 3.0)]
    a, b = ts.logistic(x, (x > 0).astype(float), np.ones(100))
    assert b > 0 and 1 / (1 + np.exp(-a)) < 0.1 < 0.9 < 1 / (1 + np.exp(-a - 3 * b))


def test_words_and_their_scores(monkeypatch):
    def name(word):
        return next(ts.Tokens(4).of([word]))[1][0]

    scorer = lambda: ts.Scorer(np.sort(np.array([name("idiot"), name("çä")], np.uint64)), np.array([3.0, 3.0]), 0.5, 4)
    texts = ["An IDIOT, idiot! an idiot_çä", None, "", "..", "idiots " * 3 + "x" * 50]
    want = [[-0.5, 3, -0.5, -0.5, 3, 3], [], [], [], [-0.5] * 4]
    for piece in (1 << 20, 40):
        monkeypatch.setattr(ts, "_PIECE", piece)
        got = [s.tolist() for _, s in scorer().of(texts)]
        assert got[:4] == want[:4] and (piece < 100 or got[4] == want[4])


def test_held_out_toxic_documents_are_found(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = ts.fit(docs, labels)
    rows = ts.score(docs.withColumn("score", F.lit("own")), model).withColumn("out", ts.held_out()).join(labels, "doc_id").filter("out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic) and sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert sum(bool(r.segments) for r in toxic) >= 0.7 * len(toxic)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    edge = spark.createDataFrame([(1, None), (1, ""), (None, "!"), (2, "idiot")], "doc_id long, text string")
    got = {(r.doc_id, r.text): r.score for r in ts.score(edge, model).collect()}
    assert len(got) == 4 and got[1, None] == got[1, ""] == got[None, "!"] == min(got.values()) < 0.3


def test_toxicity_without_labels_or_documents(frame):
    docs, none = frame("doc_id long, text string", [(1, "a b"), (5, "c")]), frame("doc_id long, toxic int", [])
    assert {r.predicted for r in ts.score(docs, ts.fit(docs, none)).collect()} == {0}
    only = frame("doc_id long, toxic int", [(i, 1) for i in range(20)])
    assert {r.predicted for r in ts.score(docs, ts.fit(docs, only)).collect()} == {1}
    assert ts.score(docs.filter("doc_id < 0"), ts.fit(docs.filter("doc_id < 0"), only)).isEmpty()
