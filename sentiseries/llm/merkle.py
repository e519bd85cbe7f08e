"""Merkle manifest of a table, with proofs regenerated from a few stored levels.

Every row is a leaf, and every group of rows a tree: its leaves in key order, each run
of ``arity`` consecutive nodes hashed into one node of the next level (the last run may
be shorter, even one node) until one is left, the group's subroot. The subroots, in the
order of their groups, are the leaves of one more tree, whose last node is the root.

Only every ``every``-th level is stored: the leaves, the nodes ``every`` levels up, and
so on. A proof needs nodes of all levels, so the missing ones are made again: the nodes
of a stored level fall into aligned blocks, each with exactly the nodes below one node
of the next stored level. A block's levels are hashed again from its stored nodes, the
siblings of each node are emitted in front of those of the block's top, and the levels
are dropped. A block holds at most ``arity ** every`` nodes, so memory does not depend
on the size of a group, and blocks of one group are spread over all tasks.

A leaf is the hash of its columns, each ``-`` if null and else its UTF-8 byte count,
``:`` and its value. Rows are read once; what follows moves digests only. A null key
comes first, and rows with the same key are ordered by their leaf; equal rows are
leaves of their own. A group of one row has its leaf as subroot, with an empty proof.
A null group is a group like any other and comes first. An empty table has no leaves,
no subroots and no root. Columns that are not listed play no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentiseries.sources.storage import stored

ARITY, EVERY = 2, 8


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """The hash of a row's values, in their order."""
    return hashed(F.concat(*map(field, values)))


@dataclass
class Manifest:
    """``levels[s]``: (grp, at, total, digest) of the nodes ``s * every`` levels up; ``levels[0]`` also carries the rows' columns.

    ``subroots`` is (grp, subroot), ``top`` the manifest of the tree over them, or None for that tree itself.
    """

    levels: list[DataFrame]
    subroots: DataFrame
    top: Manifest | None
    arity: int
    every: int


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``at``, the row's place in its ``grp`` from 0, and ``total``, the group's size.

    Rows are range-partitioned by group and ``order`` with a row number as the last key, so
    a large group, and even one key with very many rows, fills several partitions. The
    rows of a group in a partition are numbered there, after those of earlier partitions.
    """
    keys = [F.col("grp").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("tie")]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        stored(nodes.withColumn("tie", F.monotonically_increasing_id()), "nodes")
        .repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()), "placed",
    )
    sizes = ranged.groupBy("grp", "part").agg(F.count("*").alias("here"))
    whole = Window.partitionBy("grp")
    sizes = sizes.select(
        F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("here").over(whole).alias("total"),
        (F.sum("here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")).alias("before"),
    )
    inside = Window.partitionBy("grp", "part").orderBy(*keys[1:])
    return (
        ranged.withColumn("at", F.row_number().over(inside) - 1)
        .join(sizes, F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
        .withColumn("at", F.col("at") + F.col("before")).drop("g", "p", "part", "tie", "before")
    )


def _level_above(level: Column, arity: int) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / arity).cast("int"))
    return F.transform(runs, lambda j: hashed(F.array_join(F.slice(level, j * arity + 1, F.lit(arity)), "")))


def _blocks(level: DataFrame, arity: int, every: int) -> DataFrame:
    """(grp, block, total, nodes, grown): a block's stored nodes, and all its levels from them up to its top.

    A block has ``every`` levels above its nodes; one that is its group's whole level ends
    where one node is left.
    """
    span = arity**every
    nodes = F.struct("at", *(c for c in level.columns if c not in ("grp", "at", "total")))
    blocks = level.groupBy("grp", F.floor(F.col("at") / span).alias("block")).agg(
        F.first("total").alias("total"), F.sort_array(F.collect_list(nodes)).alias("nodes")
    )
    steps = F.when(F.col("total") > span, every).otherwise(sum((F.col("total") > arity**k).cast("int") for k in range(every)))
    grown = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.array(F.col("nodes.digest")), lambda built, k: F.concat(built, F.array(_level_above(F.element_at(built, -1), arity))),
    )
    return blocks.withColumn("grown", grown)


def _siblings(place: Column, grown: Column, arity: int) -> Column:
    """What stands before and after a block's node, and each node over it, in its run, up to the block's top."""

    def of(level: Column, k: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(arity), k)).cast("int")
        first = at - at % arity
        return F.struct(
            F.array_join(F.slice(level, first + 1, at - first), "").alias("before"),
            F.array_join(F.slice(level, at + 2, arity - 1 - (at - first)), "").alias("after"),
        )

    return F.transform(F.slice(grown, F.lit(1), F.size(grown) - 1), of)


def grow(leaves: DataFrame, order: list[str], arity: int, every: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of each group's tree, and (grp, subroot, stage): its subroot and the stored level under it."""
    span, levels, roots = arity**every, [], []
    level = stored(placed(leaves, order), "level")
    while True:
        tops = stored(_blocks(level, arity, every).select("grp", "block", "total", F.col("grown")[F.size("grown") - 1][0].alias("digest")), "tops")
        roots.append(tops.filter(F.col("total") <= span).select("grp", F.col("digest").alias("subroot"), F.lit(len(levels)).alias("stage")))
        levels.append(level)
        level = tops.filter(F.col("total") > span).select("grp", F.col("block").alias("at"), F.ceil(F.col("total") / span).alias("total"), "digest")
        if level.isEmpty():
            break
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.union(more)
    return levels, subroots


def manifest(df: DataFrame, key: str, group: str, columns: list[str], keep: dict[str, Column] | None = None, arity: int = ARITY, every: int = EVERY) -> Manifest:
    """The manifest of ``df``: one tree for each ``group``, leaves over ``columns`` in the order of ``key``.

    ``keep`` names further columns to be stored with the leaves, in a struct ``kept``.
    """
    if arity < 2 or every < 1:
        raise ValueError("arity must be 2 or more, every 1 or more")
    kept = F.struct(F.lit(None).cast("boolean").alias("none"), *(value.alias(name) for name, value in (keep or {}).items()))
    leaves = df.select(
        F.col(group).alias("grp"), F.col(key).alias("key"), leaf_of(*map(F.col, columns)).alias("digest"), kept.alias("kept")
    )
    levels, subroots = grow(leaves, ["key", "digest"], arity, every)
    over, root = grow(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("key"), F.col("subroot").alias("digest")), ["key"], arity, every)
    return Manifest(levels, subroots, Manifest(over, root, None, arity, every), arity, every)


def _extracted(made: Manifest, above: DataFrame) -> DataFrame:
    """The first level's rows with ``proof`` and the columns of ``above``, which holds each group's subroot, stage and the proof over it."""
    names = [c for c in above.columns if c not in ("grp", "stage", "proof")]
    paths = None
    for stage in range(len(made.levels) - 1, -1, -1):
        ends = above.filter(F.col("stage") == stage).select(F.col("grp").alias("g"), F.lit(0).cast("long").alias("b"), "proof", *names)
        if paths is not None:
            ends = ends.union(paths.select(F.col("grp").alias("g"), F.col("at").alias("b"), "proof", *names))
        blocks = _blocks(made.levels[stage], made.arity, made.every)
        joined = blocks.join(ends, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b")))
        each = joined.select("grp", "grown", "proof", *names, F.posexplode("nodes").alias("place", "node"))
        inner = [c for c in made.levels[stage].columns if c not in ("grp", "total")]
        paths = each.select(
            "grp", *(F.col("node")[c].alias(c) for c in inner), *names,
            F.concat(_siblings(F.col("place"), F.col("grown"), made.arity), "proof").alias("proof"),
        )
    return paths


def proofs(made: Manifest) -> DataFrame:
    """(grp, key, leaf, kept, subroot, root, proof): each leaf with its proof up to the root.

    ``proof`` has a (before, after) for each level, lowest first: the digests of the run's
    earlier and later nodes as one string each, empty where there are none.
    """
    none = F.expr("cast(array() as array<struct<before: string, after: string>>)")
    top = _extracted(made.top, made.top.subroots.select("grp", "stage", F.col("subroot").alias("root"), none.alias("proof")))
    over = top.select(F.col("key").alias("g"), "root", "proof")
    above = made.subroots.join(over, F.col("grp").eqNullSafe(F.col("g"))).select("grp", "stage", "subroot", "root", "proof")
    return _extracted(made, above).select("grp", "key", F.col("digest").alias("leaf"), "kept", "subroot", "root", "proof")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: hashed(F.concat(s["before"], node, s["after"])))


def siblings(proof: Column) -> Column:
    """A proof's digests as one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")
