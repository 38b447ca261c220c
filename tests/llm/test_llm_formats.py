"""Chat tree, packing, web archive and the pipeline."""

import hashlib
import os
import sys
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from parity import compare, duck
from shelflift.llm import best_fit as bf, chat_tree as ct, lang_kernel, queries, warc_store as ws
from shelflift.llm.common import pin

SF = "/root/testdata/sf0.01"


# ---- chat ----

HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\n<s>", "<\\s>", "[\\INST]", "<<SYS>>\n\n<</SYS>>", "", "é😀", "<s>user\nx</s>\n", "<<s>s>", "[[INST]INST]"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "", "a\nb", "<s>", "\\"])
def test_turns_can_be_read_back(role):
    for text in HOSTILE:
        parts = ct.turn_parts(role, text)
        assert ct.read_turn("".join(parts)) == (role, text)
        assert ct.unescape(parts[1]) == text and not any(c in parts[1] for c in ct.CONTROLS)


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), sum(len("".join(ct.turn_parts(r, t))) for r, t in turns))


TALKS = [
    (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "d"), (3, 0, "user", "a"),
    (4, 0, "user", "x"), (5, 0, "user", "a"), (5, 1, "assistant", "b"), (5, 2, "user", "c"), (6, 0, "user", "a"), (6, 1, "assistant", "q\\<s>"),
    (7, 0, "user", "a"), (7, 1, "assistant", "b"), (7, 2, "user", "d"), (7, 3, "assistant", "e"), (None, 0, None, None), (None, 1, "user", "x"), (8, None, "ro\nle", "t"),
    (9, 0, "user", "z"), (9, 0, "user", "z"),
]


def test_tree_layout(frame):
    tree = ct.layout(frame("conv_id long, turn int, role string, text string", TALKS).withColumn("ids", F.lit(1)))
    nodes = tree.nodes.collect()
    by_talk = defaultdict(list)
    for c, _, r, t in sorted(TALKS, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0)):
        by_talk[c].append((r or "", t or ""))
    prefixes = {tuple(turns[:i + 1]) for turns in by_talk.values() for i in range(len(turns))}
    assert len(nodes) == len(prefixes)
    # Every token has one place, without gaps.
    at = 0
    for n in sorted(nodes, key=lambda n: n.place):
        assert n.place == at and len(n.ids) == 4 * n.n_tokens
        at += n.n_tokens
    # Each conversation attends to its own turns before, in order, and to nothing else.
    named = {n.node: n for n in nodes}
    talks = defaultdict(list)
    for m in tree.members.collect():
        talks[m.conv_id].append((m.depth, named[m.node]))
    for turns in talks.values():
        seen, position = set(), 0
        for _, n in sorted(turns, key=lambda x: x[0]):
            assert n.position == position
            assert {p for a in n.attends for p in range(a.start, a.end)} == seen
            seen |= set(range(n.place, n.place + n.n_tokens))
            position += n.n_tokens
    # Depth first: a tree is one interval of places.
    trees = defaultdict(list)
    for n in sorted(nodes, key=lambda n: n.place):
        trees[n.tree].append(n.place)
    starts = sorted((p[0], p[-1]) for p in trees.values())
    assert all(a[1] < b[0] for a, b in zip(starts, starts[1:]))
    got = {r.conv_id: tuple(r)[1:] for r in ct.read_back(tree).collect()}
    assert got == {c: digests(turns) for c, turns in by_talk.items()}


def test_conversations_read_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + queries.CONTROL_TALK
    talks = defaultdict(list)
    for c, _, r, t in sorted(rows, key=lambda x: x[:2]):
        talks[c].append((r, t or ""))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in queries.op1_chat_tree(spark, SF).collect()}
    assert got == {c: digests(turns) for c, turns in talks.items()}


def test_no_conversations(frame):
    empty = frame("conv_id long, turn int, role string, text string", [])
    assert ct.layout(empty).nodes.isEmpty() and ct.read_back(ct.layout(empty)).isEmpty()


# ---- packing ----


def best_fit_decreasing(lengths, capacity):
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect_left(gaps, length)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        n += gap == capacity
        if gap > length:
            insort(gaps, gap - length)
    return n


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for some in by.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_packing_of_documents(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op3_best_fit(spark, "/root/testdata/sf0.001").collect()
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    for doc, text in docs.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        some, at = sorted(of[doc], key=lambda r: r.piece), 0
        for i, r in enumerate(some):
            assert (r.piece, r.start) == (i, at) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert i == 0 or r.length == bf.CAPACITY
            at += r.length
        assert at == len(ids)
    assert check_places(rows, bf.CAPACITY) == best_fit_decreasing([r.length for r in rows], bf.CAPACITY)


@pytest.mark.parametrize("capacity", [10, 64])
def test_packing_equals_best_fit_decreasing(frame, capacity):
    rng = np.random.default_rng(capacity)
    lengths = [*rng.integers(1, capacity + 1, 400).tolist(), *[capacity // 3] * 300, *[1] * 50]
    cut = pin(frame("length long, rank int", [(x, 7) for x in lengths]).repartition(3), "lengths")
    rows = bf.pack(cut, capacity).collect()
    assert Counter(r.length for r in rows) == Counter(lengths)
    assert check_places(rows, capacity) == best_fit_decreasing(lengths, capacity)


def test_ids_equal_those_of_the_other_library():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole, encode = Tokenizer.from_file(path("byte_bpe_50k.json")), bf.encoder()
    for text in ["", " ", "a" * 3000, "Ünïcode  ſ   x\x85", "don't  I'LL 12½ ²", "漢字\n\n\t x", "<|endoftext|>", "x<|endoftext|>y", "😀é\r\n",
                 "".join(map(chr, range(32, 0x250)))]:
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_of_odd_rows(frame):
    rows = frame("doc_id long, text string, start string", [(1, None, "s"), (1, "", "s"), (None, "word" + " word" * 4999, "s")])
    got = sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in bf.pieces(rows).collect())
    assert got[0] == (0, 0, 0, 5001 % 2048) and [g[3] for g in got] == [905, 2048, 2048, 1, 1]
    assert bf.pack(pin(bf.pieces(rows.limit(0)), "none")).isEmpty()


# ---- web archive ----


def test_archive_against_sql(spark):
    assert compare(spark, duck(SF), "op5", queries.op5_warc_store, queries.SQL["op5_warc_store"], SF)[0] == "ok"


def test_archive_of_copies(frame):
    rows = [(4, "http://a/ü?x=1 2\r\nX: y", "same"), (2, None, "same"), (7, "u", "same"), (7, "u", "same"), (3, "u", None), (1, "u", ""), (None, "n", "same"), (9, "v", "é\r\n\r\nWARC/1.1")]
    table = frame("page_id long, url string, html string", rows).withColumn("sha256", F.lit("own"))
    archive = ws.store(table, "page_id", "url", "html")
    got = sorted((r.id or 0, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload)) for r in ws.parse(ws.records(archive)).collect())
    assert archive.payloads.count() == 3
    assert got == [(0, "revisit", 2, 4, b"same"), (1, "response", None, 0, b""), (2, "response", None, 4, b"same"), (3, "revisit", 1, 0, b""),
                   (4, "revisit", 2, 4, b"same"), (7, "revisit", 2, 4, b"same"), (7, "revisit", 2, 4, b"same"), (9, "response", None, 14, "é\r\n\r\nWARC/1.1".encode())]
    larger = ws.parse(ws.records(ws.store(table, "page_id", "url", "html", min_bytes=5)))
    assert {r.record_type for r in larger.collect()} == {"response"}


def test_changed_payload_ends_the_read(frame):
    archive = ws.store(frame("page_id long, url string, html string", [(1, "u", "x")]), "page_id", "url", "html")
    archive.payloads = archive.payloads.withColumn("payload", F.lit(b"y"))
    with pytest.raises(Exception, match="differs from its digest"):
        ws.records(archive).collect()


def test_empty_archive(frame):
    assert ws.parse(ws.records(ws.store(frame("page_id long, url string, html string", []), "page_id", "url", "html"))).isEmpty()


# ---- pipeline ----


def stages(spark, docs, sf_dir=SF):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = pin(stage(spark, docs, sf_dir), name)
    return out


def test_pipeline_decisions(spark):
    from test_llm_dedup import groups, simhash
    from test_llm_spans import pii_base

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = stages(spark, docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in got["language"].collect()} == set(texts)
    ids = sorted(texts)
    root = groups(ids, [simhash(texts[i]) for i in ids], 4)
    first = {ids[r] for r in root}
    assert {r.doc_id for r in got["near_duplicates"].collect()} == first
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in first if not any(x in texts[i] for x in items)}
    assert {r.doc_id for r in got["decontamination"].collect()} == clean
    for r in got["personal_data"].collect():
        assert r.n_chars == len(r.text) and not pii_base(r.text)
        assert pii_base(texts[r.doc_id]) or r.text == texts[r.doc_id]
    assert {r.doc_id for r in got["packing"].collect()} == clean
    check_places(got["packing"].collect(), bf.CAPACITY)


def test_pipeline_of_odd_rows(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    none = lambda df, c: df.withColumn(c, F.lit(None).cast(dict(df.dtypes)[c]))
    odd = base.unionByName(base.limit(10)).unionByName(none(base.limit(5), "doc_id")).unionByName(none(base.limit(3), "text")).unionByName(none(base, "lang"))
    odd = odd.withColumns({c: F.lit("own column") for c in ("score", "matches", "base", "_fp", "start", "candidates")})
    got = stages(spark, odd)
    assert all(got[n].columns == odd.columns for n, _ in corpus_pipeline.STAGES[:-1])
    assert got["near_duplicates"].groupBy("doc_id").count().filter("count > 1").isEmpty()
    assert all(df.isEmpty() for df in stages(spark, odd.limit(0)).values())


def test_short_texts_of_learnt_languages_are_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = lang_kernel.fit(docs)
    first = docs.filter(lang_kernel.held_out()).withColumn("text", F.split_part(F.trim("text"), F.lit(" "), F.lit(1))).filter(F.col("text").rlike(r"\p{L}"))
    low = lang_kernel.predict(first, model).filter(F.col("score") < corpus_pipeline.MIN_LANGUAGE_SCORE)
    assert not low.isEmpty()
    strange = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(["漢字仮名", "漢字", "привет", "Привет мир", "漢", "ж"])], docs.schema)
    kept = corpus_pipeline.language(spark, docs.unionByName(first.withColumn("doc_id", -10 - F.col("doc_id")).withColumn("lang", F.lit(None).cast("string"))).unionByName(strange), SF)
    assert kept.filter("doc_id <= -10").count() == first.count()
    assert kept.filter("doc_id between -9 and -1").isEmpty()
