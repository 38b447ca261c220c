"""Near duplicates by SimHash and repeated byte strings, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from shelflift.llm import simhash_trie as st, suffix_dedup as sd
from shelflift.llm.common import pin
from shelflift.llm.components import components

SF = "/root/testdata/sf0.001"


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, fps, bits):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(ids))]


def test_fingerprints_and_components(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000, None), (10_001, ""), (10_002, " \t\n"), (10_003, "One two"), (10_004, "one TWO"), (10_005, "É é\x0bx")],
                                  "doc_id long, text string")
    docs = docs.unionByName(extra)
    fps = pin(st.fingerprints(docs), "fps")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = [simhash(t) for _, t in rows]
    got = {r.doc_id: r.fp % (1 << 64) for r in fps.collect()}
    assert [got[i] for i, _ in rows] == want
    root = groups([i for i, _ in rows], want, 4)
    for limit in (50_000, 2):  # the small limit deals buckets again
        found = {r.doc_id: r.component_id for r in st.near_duplicates(fps, 4, limit).collect()}
        assert [found[i] for i, _ in rows] == [rows[r][0] for r in root]


@pytest.mark.parametrize("n,spread", [(5, 3), (700, 6), (3000, 40)])
def test_trie_links_what_brute_force_links(n, spread):
    rnd = random.Random(n)
    fps = set()
    while len(fps) < n:
        x = rnd.getrandbits(64) if not fps or rnd.random() < 0.1 else rnd.choice(list(fps)[-50:])
        for _ in range(rnd.randrange(spread)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps = np.sort(np.array(list(fps), np.uint64))
    label = st.linked(fps, 4)
    near = [np.flatnonzero(np.bitwise_count(fps ^ f) <= 4) for f in fps]
    want = np.arange(n)
    while True:
        new = np.array([want[x].min() for x in near])
        if (new == want).all():
            break
        want = new
    assert len(set(zip(label.tolist(), want.tolist()))) == len(set(label.tolist())) == len(set(want.tolist()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{x: 100 for x in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).isEmpty()


def test_one_row_per_component_is_kept(frame):
    text = "the same long text of many words that is repeated here and there again"
    rows = [(5, text), (3, text), (3, "quite another text with its own words in it"), (None, text), (None, "only here with a null id and more"), (9, None), (8, "")]
    kept = st.keep_first(frame("doc_id long, text string", rows).withColumnRenamed("x", "y"))
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted(
        [(3, text), (3, rows[2][1]), (-1, rows[4][1]), (8, "")])
    assert st.keep_first(frame("doc_id long, text string", [])).isEmpty()


def repeated(texts):
    """(n_bytes, n_removed, n_spans, digest of what stays) per text."""
    seen = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def kept(frame_, **kwargs):
    return Counter((r.id, r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest())
                   for r in sd.remove_repeats(frame_, **kwargs).collect())


def test_repeats_in_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("source", "key")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert kept(docs) == Counter((i, *w) for (i, _), w in zip(rows, repeated([t for _, t in rows])))


@pytest.mark.parametrize("limit", [1024, 3])  # the small limit goes through all levels of dealing
def test_repeats_with_shared_passages(frame, limit, monkeypatch):
    monkeypatch.setattr(sd, "SAMPLE", 1)
    monkeypatch.setattr(sd, "HEAVY", 20 if limit == 3 else 1000)  # some anchors count as heavy
    rnd = random.Random(limit)
    passages = ["".join(rnd.choice("ab c") for _ in range(rnd.randrange(150, 500))) for _ in range(6)]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rnd.randrange(4)):
            text += rnd.choice(passages)[rnd.randrange(60):] + "".join(rnd.choice("xyzé") for _ in range(rnd.randrange(60)))
        rows.append((None if i % 17 == 0 else 5 if i % 19 == 0 else i, None if i % 23 == 0 else text))
    rows += [(1000, "a" * 700), (1001, "a" * 199), (1002, "a" * 200), (1003, ""), (1004, "ab" * 300), (1004, "ab" * 300)]
    want = Counter((i, *w) for (i, _), w in zip(rows, repeated([(t or "").encode() for _, t in rows])))
    assert kept(frame("doc_id long, text string", rows), limit=limit) == want


def test_long_text_in_pieces(frame, monkeypatch):
    rnd = random.Random(1)
    block = "".join(rnd.choice("abcdefgh") for _ in range(3000))
    rows = [(1, block + "".join(rnd.choice("xyz") for _ in range(sd._CHUNK)) + block[100:2500] + "q" * 10), (2, "short")]
    assert kept(frame("doc_id long, text string", rows)) == Counter(
        (i, *w) for (i, _), w in zip(rows, repeated([t.encode() for _, t in rows])))


def test_texts_whose_polynomial_sums_agree_differ(frame):
    """Differences that vanish modulo 2^64 under any odd base: the product of x^e - 1."""
    apart = np.ones(1, int)
    for e in (1, 2, 4, 8, 16, 32, 2, 4, 8, 16, 32, 4, 8, 2):
        apart = np.convolve(apart, [-1, *[0] * (e - 1), 1])
    rnd, rows = random.Random(3), []
    for i in range(8):
        letters = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
        before, after = letters(20), letters(230)
        low = np.array([rnd.randrange(max(32, 32 - d), min(126, 126 - d) + 1) for d in apart.tolist()])
        rows += [(2 * i, before + bytes(low.tolist()).decode() + after), (2 * i + 1, before + bytes((low + apart).tolist()).decode() + after)]
    want = Counter((i, *w) for (i, _), w in zip(rows, repeated([t.encode() for _, t in rows])))
    assert kept(frame("doc_id long, text string", rows)) == want


def test_crowded_anchor_is_halved(frame, monkeypatch):
    """One passage with a change at another place in each of many copies: all levels of dealing, against counting."""
    rnd = random.Random(4)
    passage = [rnd.choice("abcdefghijkl") for _ in range(700)]
    rows = []
    for i in range(150):
        text = passage.copy()
        for _ in range(i % 4):
            text[rnd.randrange(700)] = rnd.choice("XYZ")
        rows.append((i, "".join(text)))
    want = Counter((i, *w) for (i, _), w in zip(rows, repeated([t.encode() for _, t in rows])))
    for limit in (1024, 20, 2):
        assert kept(frame("doc_id long, text string", rows), limit=limit) == want


def test_deep_shallow_sorts(monkeypatch):
    rnd = random.Random(2)
    for _ in range(100):
        base = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(200))) for _ in range(4)]
        some = [(rnd.choice(base)[:rnd.randrange(201)] + bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(30))))[:200] for _ in range(40)]
        rows, group = np.zeros((40, 200), np.uint8), np.arange(40) % 3
        for row, s in zip(rows, some):
            row[:len(s)] = np.frombuffer(s, np.uint8)
        order = sd.deep_shallow(rows, np.array([len(s) for s in some]), group)
        assert [(group[i], some[i]) for i in order] == sorted((group[i], some[i]) for i in range(40))


def test_empty_table(frame):
    assert sd.remove_repeats(frame("doc_id long, text string", [])).isEmpty()
    assert st.near_duplicates(pin(st.fingerprints(frame("doc_id long, text string", [])), "none")).isEmpty()
