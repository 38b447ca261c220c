"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a span classifier decides.

* Base spans by pattern and check: email, ip, card, phone. They always stay.
* Candidates are the base spans and looser matches of the same kinds: obfuscated addresses, digit groups that miss a base rule.
* Labelers vote yes, no or nothing on each candidate: the base pattern (regex), lists of domain endings, country codes, card issuers and
  reserved networks (gazetteer), words before the span (context), its neighbours, and its shape.
* EM on the counts of vote patterns (at most ``3 ** LABELERS`` per kind) estimates each labeler's rates of yes votes on true and false candidates.
  It runs as one array expression over that bounded table.
* The classifier is a naive Bayes model on the span's own features, trained on the posteriors of all candidates; a candidate
  that is no base span is added if its probability, posterior included, is at least ``Params.add_at``.

All of it is DataFrame functions. Candidates stay in one array per row, so nothing is shuffled but the counts of patterns and features, which are summed before
the shuffle. Null text: empty. Empty text or table: no spans, and the model keeps its priors. Rows are kept as they come, with repeated and null ids and
further columns, except that those named base, added or candidates are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelflift.llm.common import let, match_spans, pin

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the base patterns: time in proportion to the text, no recursion, whatever stands in it.
# A match can only begin where a run of its first class begins or the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
IP_VALID = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
# Looser forms, for candidates only.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+ ?[\[(](?:at|@)[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .-][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}

# Gazetteers.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "eu", "ch", "at", "us", "ca", "mx", "ar")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55",
                 "57", "61", "64", "65", "81", "82", "86", "90", "91")
ISSUERS = r"^(3[47]|4|5[1-5]|6(011|5)|2[2-7])"
RESERVED = r"^(0|127|255)\."
# Words before a span that speak for its kind.
CONTEXT = {
    "email": r"(?i)(e-?mail|mailto|contact|write to|correo|courriel|kontakt)\W*$",
    "ip": r"(?i)\b(ip|host|server|address|client|from)\W*$",
    "card": r"(?i)(card|visa|mastercard|payment|tarjeta|carte|karte)( (no|number|nr))?\W*$",
    "phone": r"(?i)(phone|tel|telephone|call|fax|mobile|cell|telefon|tél)\W*$",
}
AGAINST = r"(?i)(version|build|release|isbn|order|invoice|article|section)( (no|number|nr))?\W*$"
LABELERS = ("regex", "gazetteer", "context", "neighbours", "shape")
SPAN = "struct<kind:string,start:int,end:int>"
_MODEL = "struct<prior:array<double>,yes:array<double>,no:array<double>>"


@dataclass(frozen=True)
class Params:
    add_at: float = 0.9
    em_rounds: int = 25
    before: int = 24


def _flag(yes: Column, no: Column) -> Column:
    """1 for yes, 0 for no, -1 for no vote."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    digits = F.length(_digits(hit))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: hit.rlike(IP_VALID),
        "card": lambda: digits.between(16, 19) & F.call_function("luhn_check", _digits(hit)),
        "phone": lambda: digits.between(8, 15),
    }[kind]()


def _gazetteer(kind: str, hit: Column) -> Column:
    digits = _digits(hit)
    if kind == "email":
        known = F.lower(F.regexp_extract(hit, r"(?<![A-Za-z0-9-])([A-Za-z0-9-]++)$", 1)).isin(*ENDINGS)
        return _flag(known, ~known)
    if kind == "ip":
        return _flag(~hit.rlike(RESERVED), hit.rlike(RESERVED))
    if kind == "card":
        return _flag(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS))
    known = digits.rlike(f"^({'|'.join(COUNTRY_CODES)})")
    return F.when(hit.startswith("+"), _flag(known, ~known)).otherwise(-1)


def _shape(kind: str, hit: Column) -> Column:
    digits = _digits(hit)
    same = digits.rlike(r"^(.)\1*$")
    if kind == "email":
        ending = F.length(F.regexp_extract(hit, r"(?<![A-Za-z])([A-Za-z]*+)$", 1))
        return _flag(ending.between(2, 12) & (F.length(hit) <= 254), ending < 2)
    if kind == "ip":
        return _flag(hit.rlike(IP_VALID) & ~hit.rlike(r"(^|\.)0[0-9]"), ~hit.rlike(IP_VALID))
    if kind == "card":
        return _flag(F.length(digits).between(16, 19) & F.call_function("luhn_check", digits) & ~same, ~F.call_function("luhn_check", digits) | same)
    return _flag(F.length(digits).between(10, 13) & ~same, ~F.length(digits).between(8, 15) | same)


def _candidates(text: Column, kind: str, p: Params) -> Column:
    """array<struct<kind,start,end,base,votes,features>> of one kind."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]

    def voted(base: bool):
        def one(s: Column) -> Column:
            hit = s["hit"]
            before = F.substr(text, F.greatest(s["start"] - p.before, F.lit(0)) + 1, F.least(s["start"], F.lit(p.before)))
            last = F.when(s["start"] > 0, F.substr(text, s["start"], F.lit(1))).otherwise(" ")
            after = F.substr(text, s["end"] + 1, F.lit(1))
            glued = last.rlike(r"[\p{L}0-9_/]") | after.rlike(r"[\p{L}0-9_/]")
            votes = F.array(
                F.lit(int(base)), _gazetteer(kind, hit), _flag(before.rlike(CONTEXT[kind]), before.rlike(AGAINST)),
                _flag(~glued & last.rlike(r"[\s(<\[:,;]"), glued), _shape(kind, hit))
            shape = F.concat_ws(
                ";", F.lit(kind), F.least(F.floor(F.length(hit) / 4), F.lit(15)).cast("string"),
                F.least(F.length(_digits(hit)), F.lit(20)).cast("string"))
            features = F.array(
                F.concat(F.lit("s;"), shape), F.concat(F.lit(f"a;{kind};"), _char_class(last)), F.concat(F.lit(f"b;{kind};"), _char_class(after)),
                F.concat(F.lit(f"c;{kind};"), votes[2].cast("string")), F.concat(F.lit(f"f;{kind};"), _char_class(F.substring(hit, 1, 1))))
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"),
                            votes.alias("votes"), features.alias("features"))
        return one

    sure = F.filter(match_spans(text, pattern), lambda s: _valid(kind, s["hit"]))
    if kind not in LOOSE:
        return F.transform(sure, voted(True))
    return let(sure, lambda sure: F.concat(F.transform(sure, voted(True)), F.transform(F.filter(
        match_spans(text, LOOSE[kind]), lambda s: ~F.exists(sure, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))), voted(False))))


def _char_class(ch: Column) -> Column:
    return (F.when(ch == "", "end").when(ch.rlike(r"\s"), "space").when(ch.rlike("[0-9]"), "digit").when(ch.rlike(r"\p{Lu}"), "upper")
            .when(ch.rlike(r"\p{L}"), "lower").otherwise(F.when(ch.rlike(r"^[\x21-\x7E]$"), ch).otherwise("other")))


def candidates(df: DataFrame, text_col: str = "text", params: Params = Params()) -> DataFrame:
    """``df`` with the array ``candidates``; each has its kind, place, whether it is a base span, votes and features."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.withColumn("candidates", F.concat(*[_candidates(text, k, params) for k in KINDS]))


def patterns(found: DataFrame) -> DataFrame:
    """How often each kind has each pattern of votes."""
    return (found.select(F.explode("candidates").alias("c")).groupBy(F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"))
            .agg(F.count("*").alias("n")))


def _logit(x: Column) -> Column:
    return F.log(x / (1 - x))


def _place(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int") - 1


def posterior(model: Column, kind: Column, votes: Column) -> Column:
    """P(personal data | votes) under ``model`` (struct of prior per kind, rates of yes votes per kind and labeler)."""
    k = _place(kind)

    def add(acc: Column, j: Column) -> Column:
        vote, yes, no = F.get(votes, j), F.get(model["yes"], k * len(LABELERS) + j), F.get(model["no"], k * len(LABELERS) + j)
        return acc + F.when(vote == 1, F.log(yes / no)).when(vote == 0, F.log((1 - yes) / (1 - no))).otherwise(0.0)

    score = F.aggregate(F.sequence(F.lit(0), F.lit(len(LABELERS) - 1)), _logit(F.get(model["prior"], k)), add)
    return 1 / (1 + F.exp(-score))


def fit_reliabilities(counts: DataFrame, params: Params = Params()) -> DataFrame:
    """One row with ``model``: EM over the table of vote patterns, which is at most 3^5 rows per kind.

    Starts from labelers that are right in four of five cases, with as much weight as ten candidates, so that a kind without
    candidates keeps these values.
    """
    size, weight = len(KINDS) * len(LABELERS), 10.0
    start = F.struct(F.array_repeat(F.lit(0.5), len(KINDS)).alias("prior"), F.array_repeat(F.lit(0.8), size).alias("yes"),
                     F.array_repeat(F.lit(0.2), size).alias("no"))
    table = counts.agg(F.collect_list(F.struct("kind", "votes", "n")).alias("rows"))

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + value(r))

    def round_(model: Column, _: Column) -> Column:
        judged = F.transform(F.col("rows"), lambda r: F.struct(
            _place(r["kind"]).alias("k"), r["votes"].alias("votes"), r["n"].cast("double").alias("n"),
            posterior(model, r["kind"], r["votes"]).alias("p")))

        def updated(rows: Column) -> Column:
            def rate(i: Column, wanted: Column, truth, start_rate: float) -> Column:
                k, j = F.floor(i / len(LABELERS)).cast("int"), i % len(LABELERS)
                mass = lambda r: F.when((r["k"] == k) & (F.get(r["votes"], j) >= 0), r["n"] * truth(r["p"])).otherwise(0.0)
                hits = lambda r: F.when(F.get(r["votes"], j) == 1, mass(r)).otherwise(0.0)
                return (total(rows, hits) + weight * start_rate) / (total(rows, mass) + weight)

            places = F.sequence(F.lit(0), F.lit(size - 1))
            return F.struct(
                F.transform(F.sequence(F.lit(0), F.lit(len(KINDS) - 1)), lambda k: (
                    total(rows, lambda r: F.when(r["k"] == k, r["n"] * r["p"]).otherwise(0.0)) + weight / 2)
                    / (total(rows, lambda r: F.when(r["k"] == k, r["n"]).otherwise(0.0)) + weight)).alias("prior"),
                F.transform(places, lambda i: rate(i, i, lambda p: p, 0.8)).alias("yes"),
                F.transform(places, lambda i: rate(i, i, lambda p: 1 - p, 0.2)).alias("no"),
            )

        return let(judged, updated)

    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(params.em_rounds)), start, round_).alias("model"))


def fit_classifier(found: DataFrame, model: Column) -> DataFrame:
    """One row with ``weights``: feature -> log odds, from the posteriors of all candidates."""
    judged = found.select(F.explode("candidates").alias("c")).select(
        F.explode("c.features").alias("feature"), posterior(model, F.col("c.kind"), F.col("c.votes")).alias("p"))
    odds = judged.groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    return odds.agg(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.log((F.col("yes") + 1) / (F.col("no") + 1))))).alias("weights"))


def decide(found: DataFrame, model: Column, weights: Column, params: Params = Params()) -> DataFrame:
    """``found`` with ``base`` and ``added`` arrays of spans, each by kind as listed, then start."""
    def spans(keep) -> Column:
        return F.transform(F.filter("candidates", keep), lambda c: F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))

    def probable(c: Column) -> Column:
        own = F.aggregate(c["features"], F.lit(0.0), lambda acc, f: acc + F.coalesce(F.element_at(weights, f), F.lit(0.0)))
        score = own / F.size(c["features"]) + _logit(F.least(F.greatest(posterior(model, c["kind"], c["votes"]), F.lit(1e-9)), F.lit(1 - 1e-9)))
        return 1 / (1 + F.exp(-score)) >= params.add_at

    return found.withColumns({"base": spans(lambda c: c["base"]), "added": spans(lambda c: ~c["base"] & probable(c))})


def fit(found: DataFrame, params: Params = Params()) -> tuple[Column, Column]:
    """The labelers' model and the classifier's weights, both of bounded size, as constants. ``found`` is read twice."""
    model = _literal(fit_reliabilities(patterns(found), params), "model", _MODEL)
    return model, _literal(fit_classifier(found, model), "weights", "map<string,double>")


def personal_data(df: DataFrame, text_col: str = "text", params: Params = Params()) -> DataFrame:
    """``df`` with ``base`` and ``added``. Only the candidates are stored between the passes; the last finds them anew beside the texts."""
    found = candidates(df, text_col, params)
    return decide(found, *fit(pin(found.select("candidates"), "candidates"), params), params).drop("candidates")


def _literal(row: DataFrame, name: str, kind: str) -> Column:
    """The one value of a one-row table of bounded size, as a constant."""
    return F.from_json(F.lit(row.select(F.to_json(F.struct(name)).alias("j")).first()["j"]), f"{name} {kind}")[name]


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by the kind of its first, in square brackets."""
    start = F.struct(F.array().cast(f"array<{SPAN}>").alias("out"), F.lit(None).cast(SPAN).alias("open"))

    def merge(acc: Column, s: Column) -> Column:
        meets = acc["open"].isNotNull() & (s["start"] < acc["open"]["end"])
        joined = F.struct(acc["open"]["kind"].alias("kind"), acc["open"]["start"].alias("start"),
                          F.greatest(acc["open"]["end"], s["end"]).alias("end"))
        span = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        return F.struct(
            F.when(acc["open"].isNull() | meets, acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["open"]))).alias("out"),
            F.when(meets, joined).otherwise(span).alias("open"))

    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    runs = F.aggregate(by_start, start, merge, lambda acc: F.concat(acc["out"], F.array(acc["open"])))

    def cut(runs: Column) -> Column:
        pieces = F.transform(runs, lambda r, i: F.concat(
            F.substr(text, F.coalesce(F.get(runs, i - 1)["end"], F.lit(0)) + 1, r["start"] - F.coalesce(F.get(runs, i - 1)["end"], F.lit(0))),
            F.lit("["), F.upper(r["kind"]), F.lit("]")))
        return F.concat(F.array_join(pieces, ""), F.substr(text, F.element_at(runs, -1)["end"] + 1))

    return F.when(F.size(spans) > 0, let(runs, cut)).otherwise(text)
