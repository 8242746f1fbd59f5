"""Merkle dataset manifest: one hash for a table, and for each row a proof that it is part of it.

Rows are leaves, ordered within their lang by doc_id; every eight nodes in a row become one, until
one is left for each lang, and these, in order of lang, become the root in the same way. Proofs
are made by pointer jumping: a node holds the siblings on its way to an ancestor; a join of the
nodes with themselves doubles the distance to that ancestor and puts the two ways together, so
after a number of joins that is logarithmic in the depth all ways end at the root. Leaves, which are most
of the nodes, follow the same joins but are nobody's ancestors and are written once.

Nulls are ``-`` in a leaf, lang null is a group of its own and the first one, doc_id null comes
first in its group, and rows of one lang and doc_id are ordered by their leaf. Repeated rows are leaves of
their own. An empty table has no rows and no root. Other columns than the five take no part.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Nodes in a run; so many bits of a place are gone a level higher.
FAN, BITS = 8, 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(columns: tuple[Column, ...]) -> Column:
    """The hash of values, each with its length in bytes, or ``-`` for a null."""
    return digest(*[F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns])


def numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``pos``, from 0, and ``size`` of their group.

    Rows are dealt by range and sorted in their task, whatever their group; the number of
    rows of a group in earlier tasks comes from one count for each group and task.
    """
    keys = [group, *order]
    s = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie")
    s = scratch.save(s.withColumns({"task": F.spark_partition_id(), "at": F.monotonically_increasing_id()}))
    tasks = s.groupBy(group, "task").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    sizes = tasks.groupBy(group).agg(F.sum("n").alias("size"))
    # As many rows as a group has tasks.
    before = F.expr(f"coalesce(sum(n) over (partition by {group} order by task rows between unbounded preceding and 1 preceding), 0)")
    tasks = tasks.select(group, "task", (before - F.col("first")).alias("shift")).join(sizes, group)
    return s.join(tasks, [group, "task"]).withColumn("pos", F.col("at") + F.col("shift")).drop("task", "at", "shift")


def _levels(nodes: DataFrame, largest: int, carried: list[str], scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level, and the last node of each tree, from (tree, pos, size, digest).

    A run is (tree, pos, size, nodes, digest): up to eight nodes in order, with what is carried by the lowest.
    """
    levels, tops = [], nodes.where("size = 1").select("tree", "digest", F.lit(0).alias("level"))
    for k in itertools.count():
        if largest <= 1:
            return levels, tops
        largest = -(-largest // FAN)
        members = F.sort_array(F.collect_list(F.struct("pos", "digest", *(carried if not k else []))))
        runs = nodes.where("size > 1").groupBy("tree", F.call_function("shiftright", F.col("pos"), F.lit(BITS)).alias("pos"), F.call_function("shiftright", F.col("size") + FAN - 1, F.lit(BITS)).alias("size")).agg(members.alias("nodes"))
        runs = scratch.save(runs.withColumn("digest", digest(F.array_join("nodes.digest", ""))))
        levels.append(runs)
        nodes = runs.select("tree", "pos", "size", "digest")
        tops = tops.unionByName(nodes.where("size = 1").select("tree", "digest", F.lit(k + 1).alias("level")))


def _members(runs: DataFrame) -> DataFrame:
    """(tree, parent, node, left, right): the nodes of runs with their siblings on both sides."""
    m = runs.select("tree", F.col("pos").alias("parent"), "nodes", F.posexplode("nodes").alias("i", "node"))
    side = lambda of: F.array_join(F.transform(of, lambda x: x["digest"]), "")
    return m.select("tree", "parent", "node", side(F.slice("nodes", F.lit(1), F.col("i"))).alias("left"), side(F.slice("nodes", F.col("i") + 2, F.lit(FAN))).alias("right"))


def _id(stage: str, level: Column | int, pos: Column, tree: Column) -> Column:
    return F.concat_ws("/", F.lit(stage), F.lit(level) if isinstance(level, int) else level, pos, tree)


_WAY = "array<struct<left:string,right:string>>"


def proofs(docs: DataFrame, scratch: Scratch, claimed: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, claimed, subroot, root, way) of every row; ``way`` has the siblings of each level, left and right.

    ``claimed`` is a text in place of ``text`` for which a leaf is made that the tree does not know; by default the text itself.
    """
    kinds = {c: "long" if c in ("doc_id", "n_chars") else "string" for c in COLUMNS}
    values = {c: F.col(c).cast(k) for c, k in kinds.items()}
    other = leaf_hash(tuple((values | {"text": claimed}).values())) if claimed is not None else None
    own = leaf_hash(tuple(values.values()))
    tree = F.coalesce(F.concat(F.lit("="), values["lang"]), F.lit(""))
    leaves = docs.select(values["doc_id"].alias("doc_id"), values["lang"].alias("lang"), tree.alias("tree"), own.alias("digest"), (other if other is not None else own).alias("claimed"))
    # The text is read and hashed once: ranges are sampled from this table.
    leaves = numbered(scratch.save(leaves), "tree", ["doc_id", "digest"], scratch)
    largest = leaves.agg(F.max("size")).first()[0] or 0
    below, tops = _levels(leaves, largest, ["doc_id", "claimed"], scratch)
    tops = numbered(scratch.save(tops.withColumn("whole", F.lit(0))), "whole", ["tree"], scratch)
    trees = tops.agg(F.max("size")).first()[0] or 0
    above, root = _levels(tops.select(F.lit("").alias("tree"), "pos", "size", "digest"), trees, [], scratch)

    way = F.array(F.struct("left", "right")).cast(_WAY)
    up = lambda stage, k: _id(stage, k + 1, F.col("parent"), F.col("tree"))
    first = None
    for stage, levels in (("a", below), ("b", above)):
        for k, runs in enumerate(levels):
            if stage == "a" and not k:
                continue
            m = _members(runs).select(_id(stage, k, F.col("node.pos"), F.col("tree")).alias("id"), up(stage, k).alias("above"), way.alias("way"), F.lit(k if stage == "a" else -1).alias("level"))
            first = m if first is None else first.unionByName(m)
    # A tree's last node goes on as a node of the upper tree.
    joint = tops.select(_id("a", F.col("level"), F.lit(0), F.col("tree")).alias("id"), _id("b", 0, F.col("pos"), F.lit("")).alias("above"), F.array().cast(_WAY).alias("way"), F.when(F.col("level") > 0, F.col("level")).otherwise(-1).cast("int").alias("level"))
    nodes = scratch.save(joint if first is None else first.unionByName(joint))

    lone = leaves.where("size = 1").select("doc_id", "tree", F.col("digest").alias("leaf"), "claimed", _id("a", 0, F.lit(0), F.col("tree")).alias("above"), F.array().cast(_WAY).alias("way"))
    if below:
        m = _members(below[0]).select("node.doc_id", "tree", F.col("node.digest").alias("leaf"), "node.claimed", up("a", 0).alias("above"), way.alias("way"))
        lone = m.unionByName(lone)
    out, done, depth = lone, 1, len(below) + 1 + len(above)
    while done <= depth:
        # Ancestors of leaves are of one level, or of the upper tree.
        ancestors = nodes.where(F.col("level").isin(done, -1)).select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("way").alias("more"))
        out = out.join(ancestors, "above", "left").withColumn("way", F.concat("way", F.coalesce("more", F.array().cast(_WAY)))).withColumn("above", F.col("next")).drop("next", "more")
        done *= 2
        if done <= depth:
            further = nodes.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("way").alias("more"))
            nodes = scratch.save(nodes.join(further, "above", "left").select("id", F.col("next").alias("above"), F.concat("way", F.coalesce("more", F.array().cast(_WAY))).alias("way"), "level"))
    subroots = tops.select("tree", F.col("digest").alias("subroot"))
    one = root.select(F.col("digest").alias("root"))  # one row
    out = out.join(subroots, "tree").crossJoin(F.broadcast(one))
    return out.select("doc_id", F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("lang"), "leaf", "claimed", "subroot", "root", "way")


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(way, leaf, lambda a, x: digest(x["left"], a, x["right"]))


def proof_digest(way: Column) -> Column:
    """The hash of all siblings, level by level and from left to right."""
    return F.sha2(F.array_join(F.transform(way, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def manifest_digests(docs: DataFrame, scratch: Scratch, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Where ``tampered`` holds, the root is recomputed from a leaf whose text has A-Z in lower case.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.col("text").cast("string")
    claimed = F.when(F.coalesce(tampered, F.lit(False)), F.translate(text, upper, lower)).otherwise(text) if tampered is not None else None
    p = proofs(docs, scratch, claimed).withColumn("folded_root", folded(F.col("claimed"), F.col("way")))
    return p.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("way")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
