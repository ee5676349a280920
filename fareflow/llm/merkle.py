"""Merkle manifest of a table: a digest of every row, a tree of digests per group, one root over all groups.

A level of a tree is kept as a string of 64 hex digits for each node. Nodes are cut into aligned
blocks of ``FANOUT ** LEVELS``, so that a block's upper levels follow from its own string alone:
fixed-width substrings give the parents, and what flanks a node within its run gives its siblings.
The blocks' roots are the nodes of the next tier, and so on until one node is left for each group.
All of it is Spark SQL expressions; a group of rows that meet in one task is never larger than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.llm.columns import only
from fareflow.operators import ordered
from fareflow.operators.joins import small_side
from fareflow.session import materialise

#: Children of a node, and the levels that one block of nodes holds.
FANOUT, LEVELS = 2, 8
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for a null, else the byte count of the value as text, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def depth_of(size: Column) -> Column:
    """Levels above ``size`` nodes until one is left: the powers of the fan-out below ``size``."""
    powers = [FANOUT ** i for i in range(64) if FANOUT ** i < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < size))


def _parents(level: Column) -> Column:
    width = HEX * FANOUT
    runs = F.ceil(F.octet_length(level) / width).cast("int")
    hashed = F.transform(F.sequence(F.lit(0), runs - 1), lambda r: F.sha2(F.substring(level, r * width + 1, F.lit(width)), 256))
    return F.array_join(hashed, "").cast("binary")


def _first(n: Column) -> Column:
    """The numbers 0, 1 and so on, ``n`` of at most ``LEVELS``."""
    return F.slice(F.array(*[F.lit(i) for i in range(LEVELS)]), F.lit(1), n)


def _blocks(nodes: DataFrame) -> DataFrame:
    """A row for each block: its nodes in order, the levels it has, and these as strings from the nodes to the root."""
    grouped = (nodes.groupBy("tree", "size", F.floor(F.col("pos") / FANOUT ** LEVELS).alias("block"))
               .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "rest"))).alias("nodes"))
               .withColumn("depth", F.least(F.lit(LEVELS), depth_of(F.col("size")))))
    strings = F.aggregate(_first(F.col("depth")), F.array(F.array_join("nodes.digest", "").cast("binary")),
                          lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1)))))
    return materialise(grouped.withColumn("levels", strings), "blocks")


def _siblings(index: Column) -> Column:
    """What stands before and after the node of this index, or its ancestor, in its run on each level."""
    def beside(level: Column) -> Column:
        string = F.element_at("levels", level + 1)
        node = F.floor(index / F.pow(F.lit(FANOUT), level)).cast("int")
        run = node - node % FANOUT
        return F.struct(F.substring(string, run * HEX + 1, (node - run) * HEX).cast("string").alias("before"),
                        F.substring(string, (node + 1) * HEX + 1, (run + FANOUT - 1 - node) * HEX).cast("string").alias("after"))
    return F.transform(_first(F.col("depth")), beside)


def _tiers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each tier, and (tree, digest) of the roots.

    ``nodes``: tree, size (its nodes), pos (from 0), digest, rest (a struct that is carried along).
    """
    most, tiers = nodes.agg(F.max("size")).first()[0] or 1, []
    while True:
        blocks = _blocks(nodes)
        tiers.append(blocks)
        root = F.element_at("levels", -1).cast("string").alias("digest")
        if most <= FANOUT ** LEVELS:
            return tiers, blocks.select("tree", root)
        most = -(-most // FANOUT ** LEVELS)
        nodes = blocks.select("tree", F.ceil(F.col("size") / FANOUT ** LEVELS).alias("size"), F.col("block").alias("pos"),
                              root, F.lit(None).cast("struct<none:int>").alias("rest"))


def _with_paths(tiers: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first tier with all siblings up to the top, tier by tier downwards.

    ``above`` has a row for each tree: tree, path (what stands beside its root) and further columns.
    """
    more = [c for c in above.columns if c not in ("tree", "path")]
    keys = ["tree"]
    for i, blocks in reversed(list(enumerate(tiers))):
        joined = blocks.join(small_side(above), keys)
        nodes = joined.select("tree", *more, F.explode(F.transform("nodes", lambda node, j: F.struct(
            node.alias("node"), F.concat(_siblings(j), F.col("path")).alias("path")))).alias("found"))
        nodes = nodes.select("tree", *more, "found.node.*", "found.path")
        if not i:
            return nodes
        above = materialise(nodes.select("tree", F.col("pos").alias("block"), "path", *more), "paths")
        keys = ["tree", "block"]


def manifest(rows: DataFrame, group: str, order: str, digest: str) -> DataFrame:
    """``rows`` with ``path`` (before and after on each level, from the leaf to the root), ``subroot`` and ``root``.

    Leaves are the column ``digest``; those of a group ascend by ``order`` (nulls last), then by digest, and
    the groups' roots ascend by ``group`` (null first, else by bytes). A group of one leaf has it as its
    subroot, a table of one group has its subroot as root. Equal rows are leaves of their own. An empty
    table has no rows, so no root.
    """
    numbered = ordered.number_rows(rows.withColumn("_digest", F.col(digest)), [group], [order, "_digest"], "_pos")
    groups = numbered.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    trees = materialise(ordered.number_rows(groups, [], [F.col(group).asc_nulls_first()], "tree"), "groups")
    leaves = numbered.join(small_side(trees.withColumnRenamed(group, "_group")), F.col(group).eqNullSafe(F.col("_group"))).select(
        "tree", "size", (F.col("_pos") - 1).alias("pos"), F.col("_digest").alias("digest"), F.struct(*rows.columns).alias("rest"))

    tiers, subroots = _tiers(leaves)
    top = subroots.select(F.lit(0).alias("tree"), F.lit(trees.count()).alias("size"), (F.col("tree") - 1).alias("pos"), "digest",
                          F.struct("tree").alias("rest"))
    top_tiers, root = _tiers(top)
    above = root.select("tree", F.array().cast("array<struct<before:string,after:string>>").alias("path"), F.col("digest").alias("root"))
    tops = _with_paths(top_tiers, above).select(F.col("rest.tree").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return _with_paths(tiers, materialise(tops, "subroots")).select("rest.*", "path", "subroot", "root")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof(path: Column) -> Column:
    """One digest of all siblings, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def report(docs: DataFrame, every: int = 7) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    ``folded_root`` starts from the leaf as it would be with 1 added to ``n_chars`` where ``every`` divides
    the checksum of the id; it then differs from ``root``. A null id has no checksum and is left as it is,
    and so is a null ``n_chars``. Null and empty texts have different leaves. Repeated rows have equal
    leaves at neighbouring places. Other columns, whatever their names, take no part.
    """
    rows = only(docs, *COLUMNS)
    columns = {c: F.col(c) for c in COLUMNS}
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % every == 0, F.lit(False))
    changed = leaf(*(columns | {"n_chars": F.col("n_chars") + 1}).values())
    rows = rows.select("doc_id", "lang", leaf(*columns.values()).alias("leaf"), F.when(touched, changed).alias("changed"))
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    return manifest(rows, "lang", "doc_id", "leaf").select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
