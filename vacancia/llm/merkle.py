"""Merkle manifest of a dataset: a tree of digests per source, a tree of sources above them.

Leaves are numbered within their source in order of doc_id. Every level is a self-join: a node
asks for the nodes of its run by their computed indices (its slot shifted by 0 to 15 within the
run of 16), so the join is by equal indices. It is dealt by run, so each level moves its nodes
once and no more. The row of slot zero then emits the parent. A source is done when one node is
left; the subroots, ordered by source, go through the same levels. On the way back down a node
adds its siblings to the path of its parent: the path of a leaf is its proof.

Defined cases: a null field is ``-``; rows of one doc_id stand in order of their leaves, null ids
first; equal rows are leaves of their own; a row without an id is never tampered with; an empty
table has no rows and no root. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import saved
from vacancia.llm.running import running
from vacancia.session import configured

ARITY = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# a join by (group, run, index) takes the partitions that are dealt by (group, run)
DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def _field(value: Column) -> Column:
    written = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written))


def digest(text: Column) -> Column:
    """The digest as 32 bytes; it is hashed further as lowercase hex."""
    return F.unhex(F.sha2(text, 256))


def written(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(text: Column) -> Column:
    return digest(F.concat(*[_field(F.col(c) if c != "text" else text) for c in FIELDS]))


def tampered() -> Column:
    """The leaf after a change: where 5 divides the crc32 of the id, A-Z of the text are lower-cased."""
    changed = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf(changed)).otherwise(F.col("digest"))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``node``: the place within the group from 0 on, and ``size``: how many the group has."""
    placed = running(nodes.withColumn("one", F.lit(1).cast("bigint")), "group", order, ["one"], "nodes")
    sizes = saved(nodes.groupBy("group").agg(F.count(F.lit(1)).alias("size")), "sizes")
    return placed.join(sizes, "group").withColumn("node", F.col("run_one") - 1).drop("one", "run_one")


def level(nodes: DataFrame) -> DataFrame:
    """Each node with the nodes of its run: ``siblings`` (index, digest), itself among them, left to right."""
    dealt = nodes.withColumn("run", F.expr(f"node div {ARITY}")).repartition("group", "run")
    asked = dealt.select("group", "run", "node", "size", "rest", F.explode(F.sequence(F.lit(0), F.lit(ARITY - 1))).alias("shift"))
    asked = asked.withColumn("sibling", F.col("run") * ARITY + (F.col("node") + F.col("shift")) % ARITY).where(F.col("sibling") < F.col("size"))
    held = dealt.select("group", "run", F.col("node").alias("sibling"), "digest")
    met = asked.join(held, ["group", "run", "sibling"])
    return met.groupBy("group", "run", "node", "size").agg(
        F.first("rest").alias("rest"), F.sort_array(F.collect_list(F.struct("sibling", "digest"))).alias("siblings")
    )


def _beside(test) -> Column:
    return F.aggregate(F.filter("siblings", test), F.lit(b""), lambda out, x: F.concat(out, x["digest"]))


def levels(nodes: DataFrame, order: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The levels of the trees of all groups, each written, and the root of every group.

    ``nodes``: group (not null), digest and ``rest``, a column that stays with the node. Roots have
    their height, and the digest; a group of one node is its own root.
    """
    nodes = saved(numbered(nodes, order), "level")
    out, roots, height = [], [], 0
    while (largest := nodes.agg(F.max("size")).first()[0]) is not None:
        roots.append(nodes.where("size = 1").select("group", F.lit(height).alias("height"), "digest", "rest"))
        if largest == 1:
            break
        with configured(nodes.sparkSession, DEALT):
            found = saved(level(nodes.where("size > 1")), "level")
        out.append(
            found.select("group", "run", "node", "rest", F.struct(_beside(lambda x: x["sibling"] < F.col("node")).alias("before"), _beside(lambda x: x["sibling"] > F.col("node")).alias("after")).alias("step"))
        )
        parents = found.where(F.col("node") % ARITY == 0)
        nodes = saved(
            parents.select(
                "group",
                F.col("run").alias("node"),
                F.ceil(F.col("size") / ARITY).alias("size"),
                digest(F.concat_ws("", F.transform("siblings", lambda x: written(x["digest"])))).alias("digest"),
                F.lit(None).cast(nodes.schema["rest"].dataType).alias("rest"),
            ),
            "level",
        )
        height += 1
    found = roots[0] if roots else nodes.select("group", F.lit(0).alias("height"), "digest", "rest")
    for more in roots[1:]:
        found = found.unionByName(more)
    return out, found


def paths(found: list[DataFrame], roots: DataFrame, tops: DataFrame) -> DataFrame:
    """Each leaf's ``rest`` with its steps from the bottom up, and what ``tops`` (group, above, top) has of its group.

    ``above`` are the steps from the group's root on.
    """
    kept = roots.join(tops, "group")
    below = None
    for height in range(len(found), -1, -1):
        here = kept.where(F.col("height") == height).select("group", F.lit(0).cast("bigint").alias("node"), F.col("above").alias("path"), "top", "rest")
        if height < len(found):
            nodes = found[height]
            parent = below.select("group", F.col("node").alias("run"), "path", "top")
            joined = nodes.join(parent, ["group", "run"])
            here = here.unionByName(joined.select("group", "node", F.concat(F.array("step"), "path").alias("path"), "top", "rest"))
        below = here
    return below


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, changed (the leaf after the change), subroot, root, and the path of every row.

    Digests are 32 bytes. ``path`` holds a step for every level from the leaf to the root, also
    where a node stands alone: the siblings ``before`` and ``after`` it, one after the other.
    """
    group = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    leaves = docs.select(*FIELDS).withColumn("digest", leaf(F.col("text"))).select(
        group.alias("group"), "digest", "doc_id", F.struct("doc_id", F.col("digest").alias("leaf"), tampered().alias("changed")).alias("rest")
    )
    by_source, subroots = levels(leaves, ["doc_id", "digest"])
    subroots = saved(subroots, "subroots")
    above, roots = levels(subroots.select(F.lit("").alias("group"), "digest", F.struct(F.col("group").alias("source"), F.col("digest").alias("subroot")).alias("rest"), F.col("group").alias("source")), ["source"])
    root = roots.select("digest").first()  # one digest
    tops = paths(above, roots, roots.select("group", F.array().cast("array<struct<before:binary,after:binary>>").alias("above"), F.lit(None).cast("binary").alias("top")))
    tops = saved(tops.select(F.col("rest.source").alias("group"), F.col("path").alias("above"), F.col("rest.subroot").alias("top")), "tops")
    found = paths(by_source, subroots, tops)
    return found.select("rest.doc_id", "rest.leaf", "rest.changed", F.col("top").alias("subroot"), F.lit(bytes(root[0]) if root else None).cast("binary").alias("root"), "path")


def folded(start: Column) -> Column:
    """The root that a leaf and its path lead to (hex)."""
    return F.aggregate("path", written(start), lambda own, step: F.sha2(F.concat(written(step["before"]), own, written(step["after"])), 256))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest with each row's proof as a digest, and whether its tampered self still leads to the root."""
    proof = F.aggregate("path", F.lit(""), lambda out, step: F.concat(out, written(step["before"]), written(step["after"])))
    found = manifest(docs).select("doc_id", *[written(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(proof, 256).alias("proof_sha256"), folded(F.col("changed")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
