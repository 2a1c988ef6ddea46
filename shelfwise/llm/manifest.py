"""Merkle manifest of a dataset, with nested-interval labels.

Each row is a leaf: the digest of its fields.  Within a group (the language)
leaves are ranked, and every node carries the interval of leaf ranks it covers;
a level's nodes are grouped eight by eight until one is left, the group's
subroot.  The subroots are the leaves of one more tree, whose top is the root.

Labels alone say how nodes relate.  Ancestors are attached level by level by a
containment join: the child's interval lies inside the parent's, both in the
same bucket of their level.  A node's siblings are what covers the difference
of the parent's interval and its own: what ends where it begins or before, and
what begins where it ends or after.  So a node's proof is its siblings and then
its parent's proof, and each level joins with a table of an eighth of its size.

Ranks are counted by range partition of (group, key, digest, row number), so
neither a large group nor many equal rows meet in one task.

Defined results: null fields count as ``-``, which no value is written as; rows
equal in group, key and digest are ranked in any order; an empty table has no
rows and no root; a lone leaf is its own subroot and has an empty proof within
its group; columns that aren't named as fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

FANOUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
MAX_BROADCAST_ROWS = 100_000
STEPS = "array<struct<before: string, after: string>>"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def tampered(doc_id: Column) -> Column:
    """Rows whose text the check lower-cases: a third, by checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


# --- ranks -------------------------------------------------------------------------
def ranked(rows: DataFrame, group: str, key: list[str]) -> DataFrame:
    """``rows`` with lo, the rank within ``group`` in the order of ``key``, hi =
    lo + 1 and n, the group's number of rows.  Stored."""
    numbered = common.stored(rows.withColumn("_row", F.monotonically_increasing_id()), "manifest-rows")
    order = [group, *key, "_row"]
    placed = (numbered.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    placed = common.stored(placed.drop("_row"), "manifest-order")
    runs = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_run")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_count"))
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = common.stored(runs.withColumns({"_before": F.coalesce(F.sum("_count").over(before), F.lit(0)),
                                           "n": F.sum("_count").over(whole)}), "manifest-runs")
    runs = common.broadcast_if_small(runs, MAX_BROADCAST_ROWS)
    lo = F.col("_at") - F.col("_first") + F.col("_before")
    joined = placed.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_run")))
    return joined.select(*rows.columns, lo.alias("lo"), (lo + 1).alias("hi"), "n")


# --- tree --------------------------------------------------------------------------
def width(level: int) -> int:
    return FANOUT ** level


def bucket(level: int) -> Column:
    """The bucket of a level that an interval lies in."""
    return F.expr(f"lo DIV {width(level)}L")


def levels(leaves: DataFrame, group: str) -> list[DataFrame]:
    """Nodes (group, lo, hi, n, digest, children) level by level above
    ``leaves`` (group, lo, hi, n, digest), as long as any group has more than
    one node.  Each level is stored and has an eighth of the one below."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    below, out, level = leaves, [], 0
    while most > width(level):
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
        nodes = (below.where(F.col("n") > width(level)).groupBy(group, bucket(level + 1).alias("b"))
                 .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"), kids.alias("children"))
                 .select(group, "lo", "hi", "n", F.sha2(F.array_join("children.digest", ""), 256).alias("digest"), "children"))
        below = common.stored(nodes, f"manifest-level{level + 1}")
        out.append(below)
        level += 1
    return out


def tops(leaves: DataFrame, nodes: list[DataFrame], group: str) -> DataFrame:
    """(group, digest): the one node of each group that covers all its leaves."""
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("n"))
    # levels above a group's top don't hold it: its top is its only whole node
    lone = leaves.where((F.col("n") == 1))
    out = lone.select(group, "digest")
    for level in nodes:
        out = out.unionByName(level.where(whole).select(group, "digest"))
    return out


def climb(children: DataFrame, parents: DataFrame, group: str, level: int) -> DataFrame:
    """``children`` (of ``level``) with ``path``, the siblings before and after
    them at each level up to their group's top: a containment join with the
    parents, which carry their own path."""
    up = parents.select(F.col(group).alias("_group"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                        F.expr(f"lo DIV {width(level + 1)}L").alias("_bucket"), F.col("children").alias("_children"),
                        F.col("path").alias("_path"))
    contained = (F.col(group).eqNullSafe(F.col("_group")) & (bucket(level + 1) == F.col("_bucket"))
                 & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
    rows = children.join(up, contained, "left")
    lo, hi = F.col("lo"), F.col("hi")
    before = F.array_join(F.transform(F.filter("_children", lambda x: x.hi <= lo), lambda x: x.digest), "")
    after = F.array_join(F.transform(F.filter("_children", lambda x: x.lo >= hi), lambda x: x.digest), "")
    own = F.array(F.struct(before.alias("before"), after.alias("after")))
    none = F.array().cast(STEPS)
    path = F.when(F.col("_path").isNull(), none).otherwise(F.concat(own, F.col("_path")))
    return rows.select(*children.columns, path.alias("path"))


def paths(leaves: DataFrame, nodes: list[DataFrame], group: str) -> DataFrame:
    """``leaves`` with ``path``; nothing but the leaves' level is as large as
    they are."""
    above = None
    for level in range(len(nodes), 0, -1):
        rows = nodes[level - 1]
        rows = climb(rows, above, group, level) if above is not None else rows.withColumn("path", F.array().cast(STEPS))
        above = common.stored(rows, f"manifest-paths{level}")
    return climb(leaves, above, group, 0) if above is not None else leaves.withColumn("path", F.array().cast(STEPS))


def fold(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda node, x: F.sha2(F.concat(x.before, node, x.after), 256))


def proof(path: Column) -> Column:
    """All siblings in a row: level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x.before, x.after)), "")


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: list[str] | None = None,
             carried: dict[str, Column] | None = None) -> tuple[DataFrame, str | None]:
    """Leaves (group, key, ``carried``, leaf, path, subroot) and the root."""
    leaf = leaf_digest([F.col(c) for c in fields or FIELDS])
    rows = docs.select(F.col(group).cast("string").alias("group"), F.col(key).alias("key"), leaf.alias("digest"),
                       *[c.alias(n) for n, c in (carried or {}).items()])
    leaves = common.stored(ranked(rows, "group", ["key", "digest"]), "manifest-leaves")
    nodes = levels(leaves, "group")
    subroots = tops(leaves, nodes, "group").withColumn("all", F.lit(0))
    subroots = common.stored(ranked(subroots, "all", ["group"]), "manifest-subroots")
    above = levels(subroots, "all")
    root = tops(subroots, above, "all").first()
    over = common.stored(paths(subroots, above, "all").select(
        F.col("group").alias("_of"), F.col("digest").alias("subroot"), F.col("path").alias("_over")), "manifest-over")
    found = paths(leaves, nodes, "group").join(
        common.broadcast_if_small(over, MAX_BROADCAST_ROWS), F.col("group").eqNullSafe(F.col("_of")))
    found = found.withColumn("path", F.concat("path", "_over")).withColumnRenamed("digest", "leaf")
    return found.drop("_of", "_over", "lo", "hi", "n"), root["digest"] if root else None


def manifest_table(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, its group's top, the root, the digest of
    its proof, and the root as folded from the (for some rows tampered) leaf."""
    text = F.when(tampered(F.col("doc_id")), F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    now = leaf_digest([text if c == "text" else F.col(c) for c in FIELDS])
    found, root = manifest(docs, carried={"now": now})
    root = F.lit(root).cast("string")
    out = found.select(F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"),
                       F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), fold(F.col("now"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
