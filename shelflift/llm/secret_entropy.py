"""Secrets: patterns, and sliding-window Shannon entropy per character class with allow-list suppression.

Base spans: ``assign``, ``access`` and ``hex`` by pattern. Added spans, kind ``entropy``: candidate strings are runs of key characters with
letters and digits; each is of the narrowest class that holds all its characters, and a window of the class's width slides over it. The counts of
the characters in the window, and with them the sum of c*log2(c), change by one character in and one out; windows at or above the class's entropy
are joined to spans. A candidate shorter than its class's width is one window, with the entropy asked for in proportion to the logarithm of its length. Candidates
that the allow-list knows as a whole, windows that touch an allowed part (a placeholder's name, a run, a sequence), and entropy spans inside a base span are dropped.

Everything is a column expression: no shuffle, one row per text, whatever its length. Null text: empty. Empty text: no spans. Rows are kept as
they come, with repeated and null ids and further columns, except that columns named assign, access, hex or added are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.llm.common import let, match_spans

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
# Runs shorter than the least length fail as a whole, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"


@dataclass(frozen=True)
class CharClass:
    name: str
    alphabet: str
    width: int
    bits: float


# From narrow to wide; the entropy in bits is below the mean of random windows by about two deviations.
CLASSES = (
    CharClass("hex", "0123456789abcdef", 20, 2.8),
    CharClass("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 3.3),
    CharClass("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 20, 3.7),
)
# What windows must not touch: placeholders, runs of one character, counting sequences.
ALLOW_PART = r"(?i:example|sample|placeholder|changeme|your[_-]?key|dummy|redacted)|(.)\1{7,}|0123456789|abcdefghij|ABCDEFGHIJ|1234567890"
# What a candidate must not be: words joined by separators, UUIDs.
ALLOW_WHOLE = (
    r"^[A-Za-z]++(?:[_/=-]++(?:[A-Za-z]++|[0-9]{1,4}+))*+$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
)
SPAN = "struct<kind:string,start:int,end:int>"


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _kind(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(0.0)


def hot_windows(hit: Column, cls: CharClass) -> Column:
    """The joined windows of ``hit`` with enough entropy and without an allowed part, as array<struct<start,end>> from its start."""
    width = F.least(F.length(hit), F.lit(cls.width))
    log_width = F.log2(width.cast("double"))
    needed = log_width * (cls.bits / math.log2(cls.width)) - 1e-9
    places = F.transform(F.split(hit, ""), lambda ch: F.instr(F.lit(cls.alphabet), ch) - 1)
    run = "array<struct<start:int,end:int>>"
    start = F.struct(
        F.lit(0).alias("i"), F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
        F.array().cast(run).alias("out"), F.lit(-1).alias("a"), F.lit(-1).alias("b"),
    )

    def scan(places: Column, spare: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            gone = F.coalesce(F.get(places, acc["i"] - width), F.lit(-1))
            come_n, gone_n = F.get(acc["counts"], x), F.coalesce(F.get(acc["counts"], gone), F.lit(0))
            total = F.when(x == gone, acc["sum"]).otherwise(
                acc["sum"] + _weight(come_n + 1) - _weight(come_n)
                + F.when(gone >= 0, _weight(gone_n - 1) - _weight(gone_n)).otherwise(0.0))
            counts = F.when(x == gone, acc["counts"]).otherwise(F.transform(
                acc["counts"], lambda c, k: c + (k == x).cast("int") - (k == gone).cast("int")))
            end = acc["i"] + 1
            hot = (end >= width) & (log_width - total / width >= needed) & ~F.exists(spare, lambda s: (s["start"] < end) & (s["end"] > end - width))
            fresh = hot & (end - width > acc["b"])
            closed = F.when(fresh & (acc["b"] >= 0), F.concat(acc["out"], F.array(F.struct(
                acc["a"].alias("start"), acc["b"].alias("end"))))).otherwise(acc["out"])
            return F.struct(
                end.alias("i"), counts.alias("counts"), total.alias("sum"), closed.alias("out"),
                F.when(fresh, end - width).otherwise(acc["a"]).alias("a"), F.when(hot, end).otherwise(acc["b"]).alias("b"))

        return F.aggregate(places, start, step, lambda acc: F.when(acc["b"] >= 0, F.concat(acc["out"], F.array(F.struct(
            acc["a"].alias("start"), acc["b"].alias("end"))))).otherwise(acc["out"]))

    return let(places, lambda p: let(match_spans(hit, ALLOW_PART), lambda spare: scan(p, spare)))


def entropy_spans(text: Column) -> Column:
    def of_candidate(s: Column) -> Column:
        hit = s["hit"]
        allowed = hit.rlike(ALLOW_WHOLE[0]) | hit.rlike(ALLOW_WHOLE[1])
        windows = F.lit(None).cast("array<struct<start:int,end:int>>")
        for cls in reversed(CLASSES):
            inside = hit.rlike("^[" + cls.alphabet.replace("-", r"\-") + "]+$")
            windows = F.when(inside, hot_windows(hit, cls)).otherwise(windows)
        keyed = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & ~allowed
        return F.when(keyed, F.transform(windows, lambda w: F.struct(
            F.lit("entropy").alias("kind"), (s["start"] + w["start"]).alias("start"), (s["start"] + w["end"]).alias("end"),
        ))).otherwise(_none())

    return F.flatten(F.transform(match_spans(text, CANDIDATE), of_candidate))


def secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with arrays ``assign``, ``access``, ``hex``, ``added`` of spans (kind, start, end; code points, end exclusive)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(match_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], f"^{ASSIGN}", 2)) >= 6)
    base = df.withColumns({
        "assign": _kind("assign", assign), "access": _kind("access", match_spans(text, ACCESS)),
        "hex": _kind("hex", match_spans(text, HEX)), "added": entropy_spans(text),
    })
    known = F.concat("assign", "access", "hex")
    return base.withColumn("added", F.when(F.size("added") > 0, F.filter("added", lambda a: ~F.exists(known, lambda b: (
        b["start"] <= a["start"]) & (a["end"] <= b["end"])))).otherwise(_none()))


def in_order(spans: Column, kinds: tuple[str, ...] = KINDS, by_kind_first: bool = False) -> Column:
    """Spans sorted by start, then kind as listed (or the other way round)."""
    place = F.lit(None).cast("int")
    ranked = lambda s: F.coalesce(*[F.when(s["kind"] == k, F.lit(i)) for i, k in enumerate(kinds)], place)
    keyed = F.transform(spans, lambda s: F.struct(
        (ranked(s) if by_kind_first else s["start"]).alias("x"), (s["start"] if by_kind_first else ranked(s)).alias("y"),
        s["end"].alias("z"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.array_sort(keyed)
