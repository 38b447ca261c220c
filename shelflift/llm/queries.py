"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelflift.llm import (
    best_fit, chat_tree, decontaminate, filter_audit, lang_kernel, merkle, pii_votes, secret_entropy, simhash_trie, suffix_dedup, syncmers, toxic_segments,
    warc_store,
)
from shelflift.llm.common import pin, span_text, table


# Its texts consist of another template's control strings.
CONTROL_TALK = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TALK, "conv_id long, turn long, role string, text string").select(
        *[F.col(c).cast(t) for c, t in talks.dtypes])
    return chat_tree.read_back(chat_tree.layout(talks.unionByName(extra)))


def op2_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    candidates = pin(pii_votes.candidates(docs).drop("text"), "candidates")
    found = pii_votes.decide(candidates, *pii_votes.fit(candidates))
    ordered = lambda spans: secret_entropy.in_order(spans, pii_votes.KINDS, by_kind_first=True)
    return found.select(
        "doc_id",
        *[F.size(F.filter(F.col("base")["kind"], lambda x: x == k)).cast("long").alias(f"n_{k}") for k in pii_votes.KINDS],
        F.sha2(span_text(ordered(F.col("base"))), 256).alias("base_sha256"),
        span_text(ordered(F.concat("base", "added"))).alias("spans"),
    )


def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = best_fit.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    stored = pin(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return best_fit.pack(stored).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op5_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc_store.store(table(spark, sf_dir, "pages"), "page_id", "url", "html", min_bytes=0)
    back = warc_store.parse(warc_store.records(archive))
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op8_lang_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lang_kernel.predict(docs.select("doc_id", "text"), lang_kernel.fit(docs))
    return scored.select("doc_id", lang_kernel.held_out().alias("held_out"), "lang_pred", "score")


def op9_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_entropy.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secret_entropy.in_order(F.concat("assign", "access", "hex"))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(secret_entropy.in_order(F.concat("assign", "access", "hex", "added"))).alias("spans"),
    )


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = pin(simhash_trie.fingerprints(table(spark, sf_dir, "documents"), words=4), "fingerprints")
    return simhash_trie.near_duplicates(fps, bits=4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, binary = table(spark, sf_dir, "documents"), 2
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows, height = merkle.manifest(
        docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"], {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, binary)
    start = F.when(tampered, F.col("changed")).otherwise(F.col("leaf"))
    again = merkle.folded(start, F.col("proof"), [(F.col("idx"), F.col("n")), (F.col("top_idx"), F.col("top_n"))], binary, height)
    text = lambda c: F.lower(F.hex(c))
    return rows.withColumn("again", again).select(
        "doc_id", *[text(c).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(text("proof"), 256).alias("proof_sha256"),
        text("again").alias("folded_root"), (F.col("again") == F.col("root")).alias("verified"))


def op12_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxic_segments.fit(docs, table(spark, sf_dir, "labels"))
    return toxic_segments.score(docs, model).select("doc_id", toxic_segments.held_out().alias("held_out"), "score", "predicted")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.facts(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.cells(found, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_tree": op1_chat_tree,
    "op2_pii_votes": op2_pii_votes,
    "op3_best_fit": op3_best_fit,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc_store": op5_warc_store,
    "op6_syncmers": op6_syncmers,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_lang_kernel": op8_lang_kernel,
    "op9_secret_entropy": op9_secret_entropy,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_merkle": op11_merkle,
    "op12_toxic_segments": op12_toxic_segments,
    "op13_filter_audit": op13_filter_audit,
}

# CRC-32 of a text in ASCII: each character's bits go in at the low end, then eight steps of the polynomial.
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda c: "
          "[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) "
          "ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295::BIGINT)")
_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")) + ")"


_LETTER = "substr('" + warc_store.BASE32 + "', 1 + ((('0x' || substr(sha1(html), 5*i + 1, 5))::INT >> s) & 31), 1)"

SQL: dict[str, str] = {
    "op5_warc_store": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        f AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
        SELECT page_id, strlen(html) AS payload_bytes,
          array_to_string(flatten(list_transform(range(8), lambda i: list_transform([15, 10, 5, 0], lambda s: {_LETTER}))), '') AS payload_digest,
          CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM f""",
    # Trees are built upwards and leaves folded upwards, both by recursion; group '' holds the tree over the languages' roots.
    "op11_merkle": f"""
        WITH RECURSIVE leaves AS (
          SELECT doc_id, coalesce('+' || lang, '') AS g, {_leaf_sql("n_chars")} AS leaf,
            CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} END AS changed
          FROM documents),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
        nodes (g, level, i, n, digest) AS (
          SELECT g, 0, i, n, leaf FROM placed
          UNION ALL
          SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY g, level, i // 2, n),
        subroots AS (SELECT g, digest, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
        top (level, i, n, digest) AS (
          SELECT 0, i, n, digest FROM subroots
          UNION ALL
          SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n),
        steps AS (
          SELECT g, level, i, n, digest FROM nodes
          UNION ALL SELECT NULL, level, i, n, digest FROM top),
        folded (doc_id, row_id, g, level, i, n, digest, proof) AS (
          SELECT doc_id, (g, i), g, 0, i, n, coalesce(changed, leaf), '' FROM placed
          UNION ALL
          SELECT f.doc_id, f.row_id, CASE WHEN f.n > 1 THEN f.g END, CASE WHEN f.n > 1 THEN f.level + 1 ELSE 0 END,
            CASE WHEN f.n > 1 THEN f.i // 2 ELSE r.i END, CASE WHEN f.n > 1 THEN (f.n + 1) // 2 ELSE r.n END,
            CASE WHEN f.n = 1 THEN f.digest WHEN f.i % 2 = 0 THEN sha256(f.digest || coalesce(s.digest, '')) ELSE sha256(s.digest || f.digest) END,
            f.proof || coalesce(s.digest, '')
          FROM folded f
          LEFT JOIN steps s ON f.n > 1 AND s.g IS NOT DISTINCT FROM f.g AND s.level = f.level AND s.i = xor(f.i, 1)
          LEFT JOIN subroots r ON f.n = 1 AND r.g = f.g
          WHERE f.n > 1 OR f.g IS NOT NULL)
        SELECT p.doc_id, p.leaf, r.digest AS subroot, t.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root,
          f.digest = t.digest AS verified
        FROM placed p JOIN subroots r USING (g) JOIN folded f ON f.row_id = (p.g, p.i) AND f.g IS NULL AND f.n = 1, top t WHERE t.n = 1""",
    "op13_filter_audit": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
            min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
          FROM documents),
        said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        f AS (
          SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
            len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
            regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS fails
          FROM d LEFT JOIN said USING (doc_id)),
        m AS (
          SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[ascii(x) - 64]) AS failed FROM f),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
        orders (filter_order) AS (
          SELECT '' UNION ALL SELECT filter_order || letter FROM orders JOIN letters ON NOT contains(filter_order, letter)),
        steps AS (
          SELECT filter_order, step, substr(filter_order, step::INT, 1) AS letter, string_split(left(filter_order, step - 1), '') AS earlier
          FROM orders, range(1, 6) r (step) WHERE length(filter_order) = 5),
        met AS (
          SELECT part, filter_order, letter, step::INT AS step, count(*) FILTER (NOT fails AND NOT gone) AS kept, count(*) FILTER (fails AND NOT gone) AS removed,
            count(*) FILTER (fails AND gone) AS redundant, count(*) FILTER (fails AND len(failed) = 1) AS unique_fails,
            count(*) FILTER (fails AND NOT gone AND good = 1) AS good_lost, count(*) FILTER (fails AND NOT gone AND toxic = 1) AS toxic_lost
          FROM (SELECT *, list_contains(failed, letter) AS fails, list_has_any(failed, earlier) AS gone FROM m, steps) GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
          (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM met""",
}
