"""Merkle manifest of a dataset: one tree per group and one over the groups' roots, a proof for every row.

* A leaf is the digest of a row's fields, each with its length, so that no two rows share a text by moving a border.
* Every level is an equijoin of its nodes with themselves on computed indices: each node is sent to the index of a sibling, ``index XOR 1`` in binary trees, one join
  per slot offset inside the run otherwise. The row in slot zero of a run then holds all of the run and emits the parent. Levels shrink by the fanout.
* Each row carries the number of nodes of its tree, so trees of any height share the levels, and a tree's last node is done where that number is 1.
* Proofs are handed down: from the top level to the leaves, a node's proof is its own siblings followed by its parent's proof, one join per level on
  ``index / fanout``. Proofs are the siblings' digests alone; which side each one stands on follows from a leaf's index and the size of its tree.

Leaves are numbered without a window over a group: rows are range-sorted, numbered inside each range, and the ranges' sizes are summed per group. So a group may
hold all rows. Every level is a stored table; nothing but the largest tree's size reaches the driver.

A null field is ``-``. Null groups are a group of their own, the first one. Rows of a group are ordered by id, null ids first, repeated ids by leaf; rows that are equal
in all fields get leaves next to one another. An empty table gives an empty result. Columns that are not named as fields do not count and are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelflift.llm.common import pin

SIZE = 32  # bytes of a digest


def _nothing() -> Column:
    return F.lit("").cast("binary")


def digest_of_hex(parts: Column) -> Column:
    """SHA-256 of digests, which are hashed as hexadecimal text; binary."""
    return F.unhex(F.sha2(F.lower(F.hex(parts)), 256))


def leaf(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields' texts, each after its number of UTF-8 bytes and a colon; binary."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(f) for f in fields]).cast("binary"), 256))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx`` (from 0, within ``grp``, in the order of ``order``) and ``n``, the rows of the group.

    Rows alike in ``order`` are spread by where they stand in the input, so that many of them do not meet in one range.
    """
    keys = ["grp", *order, "_at"]
    ranged = pin(rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys).withColumn(
        "_range", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("grp", "_range").agg(F.count("*").alias("_size"))
    group = Window.partitionBy("grp")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("grp", "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(group).alias("n"))
    inside = Window.partitionBy("grp", "_range").orderBy(*order, "_at")
    placed = ranged.withColumn("_place", F.row_number().over(inside)).join(offsets, ["grp", "_range"])
    return placed.withColumn("idx", F.col("_before") + F.col("_place") - 1).drop("_at", "_range", "_before", "_place", "_size")


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (grp, idx, n, digest, ...) with ``left`` and ``right``: the digests before and after each in its run, one after the other."""
    slot = F.pmod("idx", F.lit(fanout))
    out, own = nodes, F.pmod(F.col("idx"), F.lit(fanout))
    for offset in range(1, fanout):
        # The node in this slot is what stands ``offset`` slots on, around the run, from the node it is sent to.
        to = F.col("idx").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("idx") - slot + F.pmod(slot + (fanout - offset), F.lit(fanout))
        out = out.join(nodes.filter("n > 1").select("grp", to.cast("long").alias("idx"), F.col("digest").alias(f"_s{offset}")), ["grp", "idx"], "left")
    by_slot = [F.when(own == s, F.lit(None)).otherwise(
        reduce(lambda found, o: F.when(F.pmod(own + o, F.lit(fanout)) == s, F.col(f"_s{o}")).otherwise(found), range(1, fanout), F.lit(None).cast("binary")))
        for s in range(fanout)]
    side = lambda keep: F.concat(_nothing(), *[F.coalesce(F.when(keep(F.lit(s)), d), _nothing()) for s, d in enumerate(by_slot)])
    return out.withColumns({"left": side(lambda s: s < own), "right": side(lambda s: s > own)}).drop(*[f"_s{o}" for o in range(1, fanout)])


def parents(level: DataFrame, fanout: int) -> DataFrame:
    """The next level: what the rows in slot zero of ``level`` emit."""
    first = level.filter((F.col("n") > 1) & (F.pmod("idx", F.lit(fanout)) == 0))
    return first.select("grp", F.expr(f"idx div {fanout}").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                        digest_of_hex(F.concat("digest", "right")).alias("digest"))


def levels(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The levels of all trees, leaves first, each with its siblings; the last holds roots only."""
    nodes = pin(nodes, name)
    most = nodes.agg(F.max("n")).first()[0] or 1
    out = []
    while most > 1:
        out.append(pin(with_siblings(nodes, fanout), name))
        nodes, most = parents(out[-1], fanout), -(-most // fanout)
    return [*out, pin(nodes.withColumns({"left": _nothing(), "right": _nothing()}), name)]


def roots(tree: list[DataFrame]) -> DataFrame:
    """(grp, digest): each tree's root, at whatever level it lies."""
    return reduce(DataFrame.unionByName, [level.filter("n = 1").select("grp", "digest") for level in tree])


def handed_down(tree: list[DataFrame], start: Callable[[DataFrame], DataFrame], carried: Sequence[str], fanout: int) -> DataFrame:
    """The leaves of ``tree`` with ``proof`` and ``carried``, which ``start`` adds to roots."""
    above = None
    for level in reversed(tree):
        here = start(level.filter("n = 1"))
        if above is not None:
            up = above.select("grp", F.col("idx").alias("_up"), F.col("proof").alias("_proof"), *carried)
            below = level.filter("n > 1").withColumn("_up", F.expr(f"idx div {fanout}")).join(up, ["grp", "_up"])
            below = below.withColumn("proof", F.concat("left", "right", "_proof")).drop("_up", "_proof")
            here = below.unionByName(here)
        above = here
    return above


def folded(start: Column, proof: Column, trees: Sequence[tuple[Column, Column]], fanout: int, height: int) -> Column:
    """The root that ``start`` and ``proof`` lead to, through trees given by (index, size), the lowest first, of at most ``height`` levels each."""
    state = F.struct(start.alias("digest"), F.lit(0).alias("at"))
    for idx, n in trees:
        def step(acc: Column, _: Column) -> Column:
            left = F.pmod(acc["idx"], F.lit(fanout)).cast("int")
            run = F.least(F.lit(fanout).cast("long"), acc["n"] - acc["idx"] + left).cast("int")
            taken = lambda begin, count: F.substring(proof, acc["at"] + begin * SIZE + 1, count * SIZE)
            up = digest_of_hex(F.concat(taken(F.lit(0), left), acc["digest"], taken(left, run - 1 - left)))
            size = F.floor((acc["n"] + (fanout - 1)) / fanout).cast("long")
            return F.when(acc["n"] <= 1, acc).otherwise(F.struct(
                up.alias("digest"), (acc["at"] + (run - 1) * SIZE).alias("at"), F.floor(acc["idx"] / fanout).cast("long").alias("idx"), size.alias("n")))

        begun = F.struct(state["digest"].alias("digest"), state["at"].alias("at"), idx.cast("long").alias("idx"), n.cast("long").alias("n"))
        state = F.aggregate(F.array_repeat(F.lit(0), height), begun, step) if height else begun
    return state["digest"]


def manifest(rows: DataFrame, id_col: str, group_col: str, fields: Sequence[str], changed: dict[str, Column] | None = None,
             fanout: int = 2) -> tuple[DataFrame, int]:
    """Every row's leaf, place and proof, and the height of the tallest tree, for ``folded``.

    The columns are ``id_col``, grp, idx, n (place and leaves of its group), top_idx, top_n (those of its group's root), leaf, proof, subroot and root, all digests
    binary, and ``changed``: the leaf with the columns that the argument replaces, null if none is.
    """
    text = F.col(group_col).cast("string")
    group = F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), text))
    own = leaf([F.col(f"`{c}`") for c in fields])
    other = leaf([(changed or {}).get(c, F.col(f"`{c}`")) for c in fields]) if changed else F.lit(None).cast("binary")
    leaves = rows.select(group.alias("grp"), F.col(id_col).alias("id"), own.alias("digest"), other.alias("changed"))
    tree = levels(numbered(leaves, ["id", "digest"]), fanout, "level")
    subroots = roots(tree).select(F.lit("").alias("grp"), F.col("grp").alias("below"), "digest")
    top = levels(numbered(subroots, ["below"]), fanout, "top")
    over = handed_down(top, lambda r: r.withColumns({"proof": _nothing(), "root": F.col("digest")}), ["root"], fanout)
    over = over.select(F.col("below").alias("grp"), F.col("idx").alias("top_idx"), F.col("n").alias("top_n"), F.col("digest").alias("subroot"),
                       F.col("proof"), "root")
    over = pin(over, "groups")
    down = handed_down(tree, lambda r: r.join(over, "grp"), ["top_idx", "top_n", "subroot", "root"], fanout)
    out = down.select(F.col("id").alias(id_col), "grp", "idx", "n", "top_idx", "top_n", F.col("digest").alias("leaf"), "changed", "proof", "subroot", "root")
    return out, max(len(tree), len(top)) - 1
