"""Language identification, decontamination and syncmers."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflift.llm import decontaminate as dc, lang_kernel as lk, syncmers as sy

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_documents(spark, docs):
    extra = spark.createDataFrame([(-1, None, "en"), (-2, "123 ... 45", "en"), (-3, "", None), (None, "the and of ingthe", None), (-4, "漢字仮名", None)],
                                  "doc_id long, text string, lang string")
    rows = docs.select("doc_id", "text", "lang").unionByName(extra).withColumn("score", F.lit("own column"))
    got = lk.predict(rows, lk.fit(rows)).withColumn("held_out", lk.held_out()).collect()
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id >= 0]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    odd = {r.doc_id: (r.lang_pred, r.score) for r in got if (r.doc_id or -9) < 0}
    assert odd[-1] == odd[-2] == odd[-3] == ("und", 0.0)
    assert odd[-4][1] < 0.1 and odd[None][0] == "en" and all(0 <= r.score <= 1 for r in got)


def test_language_is_no_input_of_a_prediction(docs):
    model = lk.fit(docs)
    some = docs.limit(40)
    a = lk.predict(some, model).select("doc_id", "lang_pred", "score").collect()
    b = lk.predict(some.withColumn("lang", F.lit("xx")), model).select("doc_id", "lang_pred", "score").collect()
    assert sorted(a) == sorted(b)


def test_kernel_is_share_of_common_grams(docs):
    texts = [r.text for r in docs.limit(6).collect()]
    sets = [set(np.concatenate(list(lk.codes(t))).tolist()) for t in texts]
    vocabulary = np.array(sorted(set().union(*sets)))
    marks = np.stack([np.isin(vocabulary, list(s)) / np.sqrt(len(s)) for s in sets], 1).astype(np.float32)
    got = lk.kernels(texts, lk._places(vocabulary), marks)
    want = [[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets]
    assert np.allclose(got, want, atol=1e-5)


def test_language_without_labels(frame):
    rows = frame("doc_id long, text string, lang string", [(1, "hello", None)])
    assert lk.fit(rows) is None
    assert [tuple(r) for r in lk.predict(rows, None).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert lk.fit(frame("doc_id long, text string, lang string", [])) is None


def test_rows_each():
    assert [lk.rows_each(c, 100) for c in ([5], [500], [3, 400, 400], [1] * 200, [50, 50], [90, 20, 1])] == [5, 100, 48, 1, 50, 79]


def test_rare_languages_are_learnt(docs):
    usable = docs.filter(~lk.held_out() & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    rare = usable.filter("lang = 'es'").orderBy("doc_id").limit(4)
    rows = usable.filter("lang <> 'es'").unionByName(rare)
    held = docs.filter(lk.held_out() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    for params in (lk.Params(max_train=40), lk.Params()):
        model = lk.fit(rows, params)
        assert "es" in model.langs and len(model.langs) == usable.select("lang").distinct().count()
        got = lk.predict(held, model).select("lang", "lang_pred").collect()
        assert sum(r.lang == r.lang_pred for r in got if r.lang == "es") / sum(r.lang == "es" for r in got) > 0.8
        assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95


def windows(text, items):
    """Best similarity of every item, over all windows of its size."""
    words, best = dc.line_of(text).split(), {}
    for i, t in items:
        own = dc.line_of(t).split()
        q = min(5, len(own))
        scores = [dc.similarity(dc._shingles(words[a:a + len(own)], q), dc._shingles(own, q)) for a in range(len(words) - len(own) + 1)] if own else []
        if scores and max(scores) >= 0.8:
            best[i] = max(scores)
    return best


def test_decontamination_equals_all_windows(spark, docs):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rnd = random.Random(4)
    probes = []
    for n, (_, text) in enumerate(items[:12]):
        words = text.split()
        for k in range(4):  # words changed near the ends, where few shingles go
            changed = list(words)
            for j in range(k):
                changed[-1 - j if n % 2 else j] = f"zz{rnd.random()}"
            probes.append("Before it. " * n + " ".join(changed).upper() + "; after -- it")
    probes += [" ".join(t.split()[:8]) for _, t in items[:12]]  # texts shorter than the item they come from
    probes += [None, "", "...", "one two", items[3][1] * 2, items[4][1] + "\n" + items[5][1]]
    extra = items[:12] + [(900, "two words"), (901, None), (902, "!!"), (903, items[0][1])]
    probes.append("here are two words, and Two  Words again")
    rows = spark.createDataFrame([(n, t, "x") for n, t in enumerate(probes)], "doc_id long, text string, matches string")
    table = spark.createDataFrame(extra + extra[:3], "item_id long, text string")
    got = {r.doc_id: {m.item_id: m.similarity for m in r.matches} for r in dc.matches(rows, table).collect()}
    for n, t in enumerate(probes):
        assert got[n] == windows(t, extra), t


def test_texts_shorter_than_the_item_are_compared_as_a_whole(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [(900, "only four words here"), (901, "six words are in this item")]
    probes = ["only four words", "six words are in this", "six words are in", "words"]
    for _, t in items:
        words, middle = t.split(), len(t.split()) // 2
        probes += [" ".join(words[:-k]) for k in (1, 2, 3, 5, 7, 9)] + [". " + " ".join(words[2:]), " ".join(words[:middle] + words[middle + 1:])]
    want = []
    for t in probes:
        words, best = dc.line_of(t).split(), windows(t, items)
        for i, x in items:
            own = dc.line_of(x).split()
            q = min(5, len(own))
            s = dc.similarity(dc._shingles(words, q), dc._shingles(own, q))
            if len(words) < len(own) and s >= 0.8:
                best[i] = s
        want.append(best)
    rows = spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string")
    got = {r.doc_id: r.matches for r in dc.matches(rows, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert [{m.item_id: m.similarity for m in got[n]} for n in range(len(probes))] == want and sum(map(len, want)) > 200
    assert all(dc.line_of(t[m.start:m.end]) == dc.line_of(t) for n, t in enumerate(probes) for m in got[n] if not windows(t, items))


def test_decontamination_finds_planted_passages_with_their_place(spark, docs):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    planted = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    got = dc.matches(docs, benchmark).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*").collect()
    assert planted and planted <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        if (r.doc_id, r.item_id) in planted:
            assert dc.line_of(texts[r.doc_id][r.start:r.end]) == dc.line_of(items[r.item_id])


def test_benchmark_in_blocks(spark, docs, monkeypatch):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = dc.matches(docs.limit(200), benchmark).select("doc_id", F.array_sort("matches.item_id")).collect()
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 15)
    assert sorted(dc.matches(docs.limit(200), benchmark).select("doc_id", F.array_sort("matches.item_id")).collect()) == sorted(one)


def test_index_finds_all_within_the_radius():
    rnd = random.Random(9)
    index = dc.Index([(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(20))) for i in range(300)])
    probes = []
    for n in range(400):
        x = int(index.fps[n % 300])
        for bit in rnd.sample(range(64), n % 20):
            x ^= 1 << bit
        probes.append(x)
    fps = np.array(probes, np.uint64)
    want = {(i, j) for i in range(400) for j in np.flatnonzero(np.bitwise_count(index.fps ^ fps[i]) <= dc.RADIUS).tolist()}
    assert set(zip(*[x.tolist() for x in index.near(fps, 20)])) == want


def test_items_without_an_id_are_found(frame):
    one, two = "a passage of the benchmark that has no id of its own", "another passage of some words which lacks an id as well"
    items = frame("item_id long, text string", [(None, one), (None, two), (None, one), (None, None), (7, two)])
    got = dc.matches(frame("doc_id long, text string", [(1, f"{two} - {one}"), (2, "nothing")]), items).orderBy("doc_id").collect()
    at = len(two) + 3
    assert [[(m.item_id, m.start, m.end, m.similarity) for m in r.matches] for r in got] == [
        [(7, 0, len(two), 1.0), (None, 0, len(two), 1.0), (None, at, at + len(one), 1.0)], []]


def test_no_benchmark(frame):
    rows = frame("doc_id long, text string", [(1, "some text")])
    assert dc.matches(rows, frame("item_id long, text string", [])).first().matches == []
    assert dc.matches(rows.limit(0), frame("item_id long, text string", [(1, "some text")])).isEmpty()


def closed(text):
    """Positions of closed syncmers, straight from the definition."""
    def order(s):
        return int(sy._mix(np.frombuffer(s, "<u8").copy())[0])

    out = set()
    for i in range(len(text) - sy.K + 1):
        inner = [order(text[i + j:i + j + sy.S]) for j in range(sy.K - sy.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.add(i)
    return out


def test_syncmers_follow_the_definition(docs):
    texts = [r.text.encode()[:400] for r in docs.limit(4).collect()] + ["é".encode() * 40, b"a" * 90, b"short", b""]
    for text, (_, at) in zip(texts, sy.anchors(texts)):
        assert set(at.tolist()) == (closed(text) or ({0} if text else set()))


def test_long_texts_in_pieces_give_the_same(docs, monkeypatch):
    text = " ".join(r.text for r in docs.limit(40).collect())
    want = [a.tolist() for a in sy.anchors([text.encode()])[0]], [a.tolist() for a in dc.word_hashes([text, "x y", text])]
    grams = np.unique(np.concatenate(list(lk.codes(text)))).tolist()
    monkeypatch.setattr(sy, "_CHUNK", 777)
    monkeypatch.setattr(dc, "_CHUNK", 777)
    monkeypatch.setattr(lk, "_PIECE", 777)
    assert ([a.tolist() for a in sy.anchors([text.encode()])[0]], [a.tolist() for a in dc.word_hashes([text, "x y", text])]) == want
    assert np.unique(np.concatenate(list(lk.codes(text)))).tolist() == grams


def test_syncmers_do_not_depend_on_context(docs):
    a, b = [r.text.encode() for r in docs.limit(2).collect()]
    passage = a[:600]
    (h1, p1), (h2, p2) = sy.anchors([passage, b[:333] + passage + b[:50]])
    inside = {(int(h), int(p)) for h, p in zip(h2, p2 - 333) if 0 <= p <= 600 - sy.K}
    assert inside == {(int(h), int(p)) for h, p in zip(h1, p1)}


def test_edited_documents(spark, docs):
    extra = spark.createDataFrame([(None, "last one"), (5000, None), (5001, ""), (5001, "two of one id"), (5002, "é😀x"), (5002, "é😀x")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    got = sorted((r.id is not None, r.id or 0, r.n_chars, r.edited_sha256, r.fingerprint) for r in sy.edited(rows).collect())
    order = sorted(((r.doc_id is not None, -(r.doc_id or 0), r.text or "") for r in rows.collect()), key=lambda r: (not r[0], r[1], r[2]))
    want, near = [], {}
    for n, (known, minus, text) in enumerate(order):
        after = order[(n + 1) % len(order)][2]
        cut = len(text) // 3
        new = text[:len(text) - cut] + after[:cut]
        want.append((known, -minus, len(text), hashlib.sha256(new.encode()).hexdigest(), sy.fingerprint(text.encode(), *sy.anchors([text.encode()])[0])))
        near[known, -minus, want[-1][3]] = (like(text, new), like(text, after))
    assert got == sorted(want)
    for r in sy.edited(rows).collect():
        assert (r.near_edited, r.near_next) == pytest.approx(near[r.id is not None, r.id or 0, r.edited_sha256])
    scores = [(r.near_edited, r.near_next) for r in sy.edited(docs).collect()]
    assert np.mean([a for a, _ in scores]) > 0.4 > 0.05 > np.mean([b for _, b in scores]) and all(0 <= x <= 1 for s in scores for x in s)


def like(one, two):
    """Likeness from the definition: matches by occurrence, from the front and from the back, longest chain by comparing all pairs of matches."""
    def chain(a, b):
        seen, places = {}, {}
        for i, h in enumerate(b):
            places.setdefault(h, []).append(i)
        to = []
        for h in a:
            n = seen[h] = seen.get(h, -1) + 1
            to += places.get(h, [])[n:n + 1]
        best = []
        for i, x in enumerate(to):
            best.append(1 + max((best[j] for j in range(i) if to[j] < x), default=0))
        return max(best, default=0)

    a, b = [[int(h) >> 32 for h in sy.anchors([t.encode()])[0][0]] for t in (one, two)]
    longest = max(chain(a, b), chain(a[::-1], b[::-1]))
    return longest / (len(a) + len(b) - longest) if a or b else 1.0


def test_anchors_are_matched_by_position(docs):
    some = [r.text for r in docs.limit(60).collect()]
    half = " ".join(some[:30]), " ".join(some[30:])
    texts = [(half[0] + half[1], half[1] + half[0]), ("ab" * 500, "ab" * 400 + "x"), (half[0], half[0]), ("", ""), ("", "x"), ("short", "short!"),
             (some[0] * 3 + some[1], some[0] + some[1] + some[0]), (some[2] + some[3] + some[2] + some[4], some[3] + some[2] + some[4])]
    one, two = [[sy.anchors([t[i].encode()])[0][0] for t in texts] for i in (0, 1)]
    got = sy.likeness(one, two)
    assert got.tolist() == pytest.approx([like(*t) for t in texts])
    assert got[0] < 0.55 and got[2:6].tolist() == [1, 1, 0, 0] and len(sy.likeness([], [])) == 0


def test_every_edit_changes_the_fingerprint(docs):
    words = " ".join(r.text for r in docs.limit(100).collect()).split()[:20_000]
    rnd = random.Random(6)

    def mark(words):
        text = " ".join(words).encode()
        return sy.fingerprint(text, *sy.anchors([text])[0])

    own = mark(words)
    for at in [0, 1, len(words) - 1, *rnd.sample(range(len(words)), 30)]:
        assert mark(words[:at] + ["".join(rnd.sample("bcdfgh", 5))] + words[at + 1:]) != own
    text = " ".join(words).encode()
    places = sy.anchors([text])[0][1]
    assert np.diff(places).max() <= sy.K - sy.S and len(own) == 8 + 10 * len(places) < 0.7 * len(text)


def test_buckets_count_bounds(spark):
    from shelflift.llm.neighbours import _bucket

    rnd = random.Random(8)
    for n in (0, 1, 2, 3, 10, 99, 100):
        bounds = sorted(rnd.sample(range(-500, 500), n))
        rows = spark.range(-510, 510).select("id", _bucket(bounds, F.col("id")).alias("b")).collect()
        assert all(r.b == sum(b <= r.id for b in bounds) for r in rows)


def test_edited_single_and_empty(frame):
    r = sy.edited(frame("doc_id long, text string", [(1, "alone in the table")])).first()
    assert (r.near_edited, r.near_next) != (None, None) and r.near_next == 1.0
    assert sy.edited(frame("doc_id long, text string", [])).isEmpty()


def test_letters_are_those_of_unicode(spark):
    """The rule of the fit (Java) and that of the prediction (Python) agree."""
    some = ["12²", "½", "Ⅷ", "①", "_9", "a", "é", "漢", "ª", "ǅ", "ʰ", "٣", "👍", ""]
    java = {r.text: r.x for r in spark.createDataFrame([(t,) for t in some], "text string").selectExpr("text", r"text RLIKE '\\p{L}' AS x").collect()}
    assert {t: lk.has_letter(t) for t in some} == java and not any(lk.has_letter(t) for t in some[:5])
