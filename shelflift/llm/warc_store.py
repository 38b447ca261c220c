"""Content-addressed web archive: payload bytes once, exact record headers apart, records rebuilt by joins.

* A capture is one row (id, url, payload). Its payload is stored once under its SHA-256; every read computes the digest
  again and ends with an error where it differs.
* Of captures with equal payloads of at least ``min_bytes`` bytes, the one with the smallest id is the response and the others
  are revisits; smaller payloads are always responses. Repeated ids: one of the rows is the response. Null ids come last.
* Null payload: empty. Null url: empty. A url with anything but visible ASCII is percent-encoded, so no header can be injected.
  An empty table gives an empty archive. Further columns of the input are ignored.

The header of a record, up to the blank line before its payload, is kept as it stands in a WARC file, HTTP header included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.llm.common import pin

# RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Archive:
    headers: DataFrame   # record, sha256, header
    payloads: DataFrame  # sha256, payload


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 digest in base 32: 160 bits are 8 groups of 5 hexadecimal digits, i.e. 4 letters each."""
    digest = F.sha1(payload)
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _lines(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def store(captures: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0,
          date: str = "1970-01-01T00:00:00Z") -> Archive:
    """Write the captures as two tables in the scratch folder."""
    url, payload = F.coalesce(F.col(url_col).cast("string"), F.lit("")), F.col(payload_col)
    payload = F.coalesce(payload if dict(captures.dtypes)[payload_col] == "binary" else F.encode(payload, "UTF-8"), F.lit(b""))
    rows = captures.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(url.rlike(r"[^\x21-\x7E]"), F.url_encode(url)).otherwise(url).alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("sha256"),
    )
    described = pin(rows.select(
        F.monotonically_increasing_id().alias("record"), "id", "url", "sha256",
        F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("sha1"),
    ), "captures")
    # Stored, so that the join has an exchange of its own on both sides, of which Spark can split a frequent payload's part.
    first = pin(described.groupBy("sha256").agg(F.min(F.struct(
        F.col("id").isNull().alias("no_id"), "id", "record", "url")).alias("first")), "first")
    joined = described.join(first, "sha256")
    revisit = (F.col("n") >= min_bytes) & (F.col("record") != F.col("first.record"))
    urn = lambda c: F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws(" ", c, "sha256"), 256), F.lit(">"))
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    http = _lines("HTTP/1.1 200 OK", CRLF, "Content-Type: text/html; charset=utf-8", CRLF,
                  "Content-Length: ", F.col("n").cast("string"), CRLF, CRLF)
    header = _lines(
        "WARC/1.1", CRLF, "WARC-Type: ", F.when(revisit, "revisit").otherwise("response"), CRLF,
        "WARC-Record-ID: ", urn(F.col("record").cast("string")), CRLF, "WARC-Date: ", date, CRLF,
        "WARC-Target-URI: ", F.col("url"), CRLF, "WARC-Payload-Digest: sha1:", F.col("sha1"), CRLF,
        "Capture-ID: ", number(F.col("id")), CRLF,
        F.when(revisit, _lines(
            "WARC-Profile: ", REVISIT_PROFILE, CRLF, "WARC-Refers-To: ", urn(F.col("first.record").cast("string")), CRLF,
            "WARC-Refers-To-Target-URI: ", F.col("first.url"), CRLF, "Refers-To-Capture-ID: ", number(F.col("first.id")), CRLF,
        )).otherwise(""),
        "Content-Type: application/http; msgtype=response", CRLF,
        "Content-Length: ", (F.length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string"), CRLF, CRLF, http,
    )
    # Payloads that occur once are stored where they are read; only repeated ones meet by digest.
    repeated = pin(described.groupBy("sha256").agg(F.count("*").alias("times")).filter("times > 1").select("sha256"), "repeated")
    contents = rows.select("sha256", "payload")
    payloads = contents.join(repeated, "sha256", "left_anti").unionByName(
        contents.join(repeated, "sha256", "left_semi").dropDuplicates(["sha256"]))
    return Archive(pin(joined.select("record", "sha256", header.alias("header")), "headers"), pin(payloads, "payloads"))


def records(archive: Archive) -> DataFrame:
    """record, warc (the bytes of the record in a WARC file), payload (also of a revisit), its digest checked."""
    payload = F.col("payload")
    checked = F.when(F.sha2(payload, 256) == F.col("sha256"), payload).otherwise(
        F.raise_error(F.concat(F.lit("payload is missing or differs from its digest "), F.col("sha256"))).cast("binary"))
    is_response = F.substring_index(F.substring_index("header", CRLF, 2), CRLF, -1) == "WARC-Type: response"
    return (
        archive.headers.join(archive.payloads, "sha256", "left")
        .select("record", "header", checked.alias("payload"))
        .select("record", F.concat(
            F.encode("header", "UTF-8"), F.when(is_response, F.col("payload")).otherwise(F.lit(b"")), F.lit(b"\r\n\r\n"),
        ).alias("warc"), "payload")
    )


def parse(archived: DataFrame) -> DataFrame:
    """The fields of records: id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    Lengths and digests that the headers state are compared with the bytes; a difference ends the job.
    """
    text = F.col("warc").cast("string")
    field = lambda name: F.nullif(F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))
    split = archived.select("record", "payload", "warc", F.substring_index(text, CRLF * 2, 1).alias("head"))
    block = split.withColumn("block", F.substr("warc", F.octet_length("head") + 5, field("Content-Length").cast("int")))
    inner = F.substring_index(F.col("block").cast("string"), CRLF * 2, 1)
    fields = block.select(
        "record", "payload", field("Capture-ID").cast("long").alias("id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"), field("Refers-To-Capture-ID").cast("long").alias("refers_to"),
        F.regexp_extract("head", r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]*)", 1).alias("payload_digest"),
        F.regexp_extract(inner, r"\r\nContent-Length: ([0-9]+)", 1).cast("long").alias("payload_bytes"),
        F.substr("block", F.octet_length(inner) + 5).alias("body"), F.octet_length("warc").alias("_whole"),
        (F.octet_length("head") + 4 + F.octet_length("block") + 4).alias("_parts"),
    )
    body = F.when(F.col("record_type") == "response", F.col("body")).otherwise(F.col("payload"))
    good = ((F.octet_length(body) == F.col("payload_bytes")) & (base32_sha1(body) == F.col("payload_digest"))
            & (F.col("_whole") == F.col("_parts")))
    return fields.select(
        "record", "id", "url", "record_type", "refers_to",
        F.when(good, F.col("payload_bytes")).otherwise(F.raise_error(F.lit("a record differs from its header")).cast("long"))
        .alias("payload_bytes"), "payload_digest", body.alias("payload"),
    )
