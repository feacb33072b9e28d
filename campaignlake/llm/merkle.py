"""Merkle manifest of a dataset, kept as a content-addressed graph.

Every row is a leaf: the SHA-256 of its columns.  The leaves of a group, in
order, form a tree of fan-out ``FAN_OUT``; the groups' roots form the tree over
them.  What is stored are records digest -> children, one for each distinct
digest.  A proof is found by descent: leaf requests start together at the root,
a digit of the rank (base ``FAN_OUT``) picks the child at every level, the other
children are collected, and the collected segments are reversed at the end.
Requests that share a path prefix are one row until their digits part, so a
level costs as many rows as it has nodes.  All leaves are proved by default.

Ranks come from a range partitioning by (group, order, digest): position in the
partition plus what earlier partitions hold of the group.  Neither a group with
a third of all rows nor a row repeated that often is one task (equal rows are
told apart by their place).  Leaves and the nodes of every level are written tables.

Defined cases: a null column enters a leaf as ``-``, any other value as its
UTF-8 byte count, ``:`` and the value; a null group is a group of its own, the
first one; null order values come first; rows of equal order stand by digest,
repeated rows are leaves of their own; a group with one row has that leaf as its
root, one group's root is the dataset's root; an empty table has no group, no
leaf and a null root; columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import MAX_ONE_ROW_PER_PARTITION, bounded_broadcast, written

FAN_OUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PLACE_BITS = 33  # monotonically_increasing_id: partition number above, position below


@dataclass
class Manifest:
    """``leaves``: group, tree, rank, digest and the carried columns;
    ``groups``: group, tree (its number), n, height, digest (its root);
    ``levels``/``top``: records (digest, children) by height above the leaves or
    above the groups' roots; ``root``: digest, None for an empty table."""
    leaves: DataFrame
    groups: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None


def sha(*binaries: Column) -> Column:
    """SHA-256 of the digests' (or any bytes') lower-case hexadecimal text, in turn."""
    return F.unhex(F.sha2(hex_text(F.concat(*binaries)), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: ``-`` for null, else byte count, colon and value."""
    def entry(v: Column) -> Column:
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(entry, values)), 256))


def height_of(n: Column) -> Column:
    """Levels above ``n`` nodes until one is left."""
    powers = [FAN_OUT ** k for k in range(21)]  # FAN_OUT ** 21 is beyond a long
    return sum((F.when(n > p, 1).otherwise(0) for p in powers), F.lit(0)).cast("int")


def _ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with __part and __at (place after sorting), and one row per
    (group, partition): where the group begins there and how many of its rows
    earlier partitions hold (``base``)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order, "digest")] + [F.col("__row").asc()]
    placed = (rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys).withColumn("__row", F.monotonically_increasing_id()))
    placed = written(placed.withColumn("__part", F.shiftright("__row", _PLACE_BITS))
                     .withColumn("__at", F.col("__row").bitwiseAND((1 << _PLACE_BITS) - 1)).drop("__row"), "placed")
    starts = placed.groupBy(*group, "__part").agg(F.count("*").alias("here"), F.min("__at").alias("begin"))
    # a window holds at most one row per partition
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, starts.withColumn("base", F.coalesce(F.sum("here").over(before), F.lit(0)))


def _rank() -> Column:
    return F.col("__at") - F.col("begin") + F.col("base")


def _levels(nodes: DataFrame, highest: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of every level above ``nodes`` (tree, rank, digest, height), and
    the trees' roots (tree, digest)."""
    records, roots, now = [], nodes.where("height = 0").select("tree", "digest"), nodes
    for level in range(1, highest + 1):
        # a group holds FAN_OUT rows at most
        now = (now.where(F.col("height") >= level)
               .groupBy("tree", F.expr(f"rank div {FAN_OUT}").alias("rank"))
               .agg(F.array_sort(F.collect_list(F.struct("rank", "digest")))["digest"].alias("children"),
                    F.first("height").alias("height")))
        digest = F.unhex(F.sha2(hex_text(F.aggregate("children", F.lit(b""), lambda a, d: F.concat(a, d))), 256))
        now = written(now.withColumn("digest", digest), "nodes")
        records.append(now.groupBy("digest").agg(F.first("children").alias("children")))
        roots = roots.union(now.where(F.col("height") == level).select("tree", "digest"))
    return records, roots


def build(rows: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", order: str = "doc_id",
          **carried: Column) -> Manifest:
    """The manifest of ``rows``.  ``carried``: further columns, computed in the
    same pass, that stand beside a leaf (under names of their own)."""
    leaves = rows.select(F.col(group).alias("group"), F.col(order).alias("order"),
                         leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
                         *[c.alias(name) for name, c in carried.items()])
    placed, starts = _ranked(written(leaves, "leaves"), ["group"], ["order"])
    # the groups are numbered as the leaves are ranked
    sizes = starts.groupBy("group").agg(F.sum("here").alias("n")).withColumn("digest", F.lit(None).cast("binary"))
    numbered, first = _ranked(sizes.withColumn("all", F.lit(0)), ["all"], ["group"])
    groups = numbered.join(bounded_broadcast(first, MAX_ONE_ROW_PER_PARTITION), ["all", "__part"])
    groups = written(groups.select("group", _rank().alias("tree"), "n", height_of(F.col("n")).alias("height")), "groups")
    g = groups.withColumnRenamed("group", "_group")
    starts = written(starts.join(g, starts["group"].eqNullSafe(g["_group"]))
                     .select(F.col("group").alias("_group"), F.col("__part").alias("_part"), "begin", "base", "tree", "height"),
                     "starts")
    known = bounded_broadcast(starts, MAX_ONE_ROW_PER_PARTITION)
    leaves = placed.join(known, (F.col("__part") == F.col("_part")) & F.col("group").eqNullSafe(F.col("_group")))
    leaves = leaves.select("group", "tree", _rank().alias("rank"), "height", F.col("order"), "digest", *carried)
    most, trees = groups.agg(F.max("height"), F.count("*")).first()
    records, roots = _levels(leaves.select("tree", "rank", "digest", "height"), most or 0)
    groups = written(groups.join(roots, "tree"), "groups")
    highest = sum(trees > FAN_OUT ** k for k in range(21))
    top, root = _levels(groups.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), "digest",
                                      F.lit(highest).alias("height")), highest)
    found = root.first()
    return Manifest(leaves, groups, records, top, bytes(found["digest"]) if found else None)


def _join(a: Column) -> Column:
    return F.aggregate(a, F.lit(b""), lambda x, d: F.concat(x, d))


def _segment(children: Column, digit: Column) -> Column:
    """The children that a digit leaves out, before and after the chosen one."""
    digit = digit.cast("int")
    return F.struct(_join(F.slice(children, F.lit(1), digit)).alias("left"),
                    _join(F.slice(children, digit + 2, F.lit(FAN_OUT))).alias("right"))


_PATH = "array<struct<left:binary,right:binary>>"


def _descend(frontier: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """One level down: every row (tree, rank, digest, path and others) becomes
    its children, the left-out ones at the end of their path."""
    below = (frontier.join(records, "digest").select("*", F.posexplode("children").alias("digit", "child"))
             .withColumn("path", F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))))
             .withColumn("rank", F.col("rank") * FAN_OUT + F.col("digit")).withColumn("digest", F.col("child"))
             .drop("digit", "child", "children"))
    return below if wanted is None else below.join(wanted, ["tree", "rank"], "left_semi")


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Leaves with their proofs: the columns of ``manifest.leaves``, ``subroot``
    and ``proof``, an array of (left, right) digests beside the path, from the
    leaf's level up to the root.  ``requests`` (tree, rank) names the leaves to
    prove (default: all; repeated requests count once)."""
    leaves = manifest.leaves
    spark = leaves.sparkSession
    if requests is not None:
        requests = written(requests.select("tree", "rank").distinct(), "requests")
        leaves = leaves.join(requests, ["tree", "rank"], "left_semi")

    def wanted(column: str, level: int) -> DataFrame | None:
        if requests is None:
            return None
        rank = F.expr(f"{column} div {FAN_OUT ** level}L")
        return requests.select(F.col("tree") if column == "rank" else F.lit(0).alias("tree"), rank.alias("rank")).distinct()

    now = spark.range(1 if manifest.root else 0).select(
        F.col("id").alias("tree"), F.col("id").alias("rank"), F.lit(manifest.root).cast("binary").alias("digest"),
        F.array().cast(_PATH).alias("path"))
    for level in range(len(manifest.top), 0, -1):
        now = _descend(now, manifest.top[level - 1], wanted("tree", level - 1))
    trees = manifest.groups.select("tree", "height", F.col("digest").alias("subroot"))
    roots = now.select(F.col("rank").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", "path").join(trees, "tree")
    roots = written(roots, "frontier")
    now = roots.where(F.col("height") == len(manifest.levels))
    for level in range(len(manifest.levels), 1, -1):
        now = _descend(now, manifest.levels[level - 1], wanted("rank", level - 1))
        now = now.unionByName(roots.where(F.col("height") == level - 1))
    # last level: requests meet the node above them; a lone leaf has none
    if manifest.levels:
        last = now.where("height > 0").join(manifest.levels[0], "digest")
        last = last.unionByName(roots.where("height = 0"), allowMissingColumns=True)
    else:
        last = roots.withColumn("children", F.lit(None).cast("array<binary>"))
    last = last.select("tree", F.col("rank").alias("above"), "path", "children", "subroot")
    keyed = leaves.withColumn("above", F.expr(f"rank div {FAN_OUT}"))
    lowest = F.when(F.col("children").isNull(), F.array().cast(_PATH)).otherwise(
        F.array(_segment(F.col("children"), F.col("rank") % FAN_OUT)))
    return (keyed.join(last, ["tree", "above"])
            .withColumn("proof", F.reverse(F.concat("path", lowest))).drop("above", "path", "children"))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda d, s: sha(s["left"], d, s["right"]))


def proof_digest(proof: Column) -> Column:
    """SHA-256 (text) of all left-out digests, level by level, left to right."""
    return F.sha2(hex_text(F.aggregate(proof, F.lit(b""), lambda a, s: F.concat(a, s["left"], s["right"]))), 256)
