"""Merkle dataset manifest: content-addressed records, and proofs by descent from the root.

Every row is a leaf.  Each group (source) is a tree over its leaves by id, the
groups' subroots are the leaves of one tree above them, and every node stands
for up to ``FANOUT`` consecutive nodes below it.  What is stored of a tree are
records (digest, children), found by digest alone, so equal subtrees are one
record.  Proofs start at the root: each requested leaf has a number, the digits
of which (base ``FANOUT``) say which child to take; the digests of the children
not taken are collected, and the segments of the path are reversed at the end,
from the leaf up.  Requests walk together: at every level there is one row for
each node that any of them passes, so the hot records near the root are read
once, and paths are shuffled once for each lowest node, not for each leaf.

A digest is the lower-case hexadecimal SHA-256 of its inputs, concatenated; a
field of a leaf goes in as its UTF-8 byte count, ``:`` and its value (integers
decimal), a null one as ``-``.

Edge cases: empty and very long texts are values like any other; null ids come
first in their group, a null group before all others; rows with one id are
separate leaves in the order of their digests, and wholly equal rows are equal
leaves with a proof each; a single leaf is its own subroot, a single subroot
the root; an empty table has no root and gives no proofs; columns other than
the fields are not part of a leaf, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored
from salescope.llm.ordered import numbered

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(content: Column) -> Column:
    return F.sha2(content, 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row of these fields."""
    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(F.concat(*(part(f) for f in fields)))


@dataclass
class Manifest:
    """A built manifest.

    ``leaves``: one row a leaf with ``_tree`` (the group), ``_rank`` and ``_n`` in
    it, ``leaf`` and ``carried``.  ``subroots``: ``_tree``, ``height``, ``digest``
    and the subroot's ``_rank``.  ``records`` and ``top_records`` hold (``digest``,
    ``children``) of the nodes of each height from 1, in the groups' trees and in
    the tree above them.  ``root``: (``digest``), one row, or none for no leaves.
    """

    leaves: DataFrame
    subroots: DataFrame
    records: list[DataFrame]
    top_records: list[DataFrame]
    root: DataFrame


def _height(nodes: DataFrame) -> int:
    """Levels above the leaves of the tallest tree."""
    most, height = nodes.agg(F.max("_n")).first()[0] or 1, 0
    while most > 1:
        most, height = -(-most // FANOUT), height + 1
    return height


def _grow(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of each height of the trees over ``nodes`` (``_tree``, ``_rank``, ``_n``, ``digest``), and the trees' tops."""
    records = []
    tops = nodes.where("_n = 1").select("_tree", F.lit(0).alias("height"), "digest")
    for height in range(1, _height(nodes) + 1):
        nodes = stored(
            nodes.where("_n > 1")
            .groupBy("_tree", F.expr(f"_rank div {FANOUT}").alias("_rank"),
                     F.expr(f"(_n + {FANOUT - 1}) div {FANOUT}").alias("_n"))
            .agg(F.sort_array(F.collect_list(F.struct("_rank", "digest")))["digest"].alias("children"))
            .withColumn("digest", digest(F.array_join("children", ""))), f"{name}-{height}")
        records.append(nodes.select("digest", "children").dropDuplicates(["digest"]))
        tops = tops.unionByName(nodes.where("_n = 1").select("_tree", F.lit(height).alias("height"), "digest"))
    return records, tops


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
          fields: tuple[str, ...] = FIELDS, carried: Column | None = None) -> Manifest:
    """The manifest of ``docs``; ``carried`` is kept beside each leaf, for requests."""
    leaves = stored(docs.select(F.col(group_col).alias("_tree"), F.col(id_col).alias("_id"),
                                leaf_digest(*(F.col(c) for c in fields)).alias("leaf"),
                                (F.lit(None).cast("string") if carried is None else carried).alias("carried")), "leaves")
    leaves = stored(numbered(leaves, ["_tree"], ["_id", "leaf"], "leaves-by-rank"), "leaves-ranked")
    records, tops = _grow(leaves.select("_tree", "_rank", "_n", F.col("leaf").alias("digest")), "records")
    ranked = stored(numbered(stored(tops, "subroots"), [], ["_tree"], "subroots-by-rank"), "subroots-ranked")
    top_records, root = _grow(ranked.select(F.lit(0).alias("_tree"), "_rank", "_n", "digest"), "top-records")
    return Manifest(leaves, ranked.select("_tree", "height", "digest", "_rank"), records, top_records,
                    root.select("digest"))


def _descend(nodes: DataFrame, records: DataFrame, asked: DataFrame) -> DataFrame:
    """One level down: ``nodes`` (``_tree``, ``_rank``, ``digest``, ``path``, others) to their asked children.

    ``asked`` has ``_tree``, ``_rank`` and ``asks``, an array of (``digit``, ``of``).
    """
    asked = asked.select(F.col("_tree").alias("_asked_tree"), F.col("_rank").alias("_asked_rank"), "asks")
    rest = [c for c in nodes.columns if c not in ("_tree", "_rank", "digest", "path", "of")]
    found = (nodes.join(records, "digest")
             .join(asked, F.col("_tree").eqNullSafe(F.col("_asked_tree")) & (F.col("_rank") == F.col("_asked_rank")))
             .select("_tree", "_rank", "children", "path", *rest, F.explode("asks").alias("_ask")))
    digit = F.col("_ask")["digit"]
    segment = F.struct(F.array_join(F.slice("children", 1, digit), "").alias("before"),
                       F.array_join(F.slice("children", digit + 2, FANOUT), "").alias("after"))
    return found.select("_tree", (F.col("_rank") * FANOUT + digit).alias("_rank"),
                        F.get("children", digit).alias("digest"),
                        F.concat("path", F.array(segment)).alias("path"), *rest, F.col("_ask")["of"].alias("of"))


def _asked(requests: DataFrame, up: int) -> DataFrame:
    """The nodes ``up`` levels above the requested ones, with the digits of the next step."""
    child, node = (f"_rank div {FANOUT ** k}L" for k in (up - 1, up))
    return (requests.select("_tree", F.expr(node).alias("_rank"), F.expr(f"cast({child} % {FANOUT} as int)").alias("digit"))
            .groupBy("_tree", "_rank").agg(F.collect_set("digit").alias("digits"))
            .select("_tree", "_rank", F.transform("digits", lambda d: F.struct(
                d.alias("digit"), F.lit(None).cast("string").alias("of"))).alias("asks")))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(``leaf``, ``carried``, ``subroot``, ``root``, ``path``) of each requested leaf.

    ``requests`` are rows of ``manifest.leaves`` (all of them if None).  ``path``
    has a segment (``before``, ``after``) a level, from the leaf up: the digests
    of the run's other nodes, concatenated.
    """
    requests = manifest.leaves if requests is None else requests
    by_node = stored(requests.groupBy("_tree", F.expr(f"_rank div {FANOUT}").alias("_rank"), "_n")
                     .agg(F.collect_list(F.struct(F.expr(f"cast(_rank % {FANOUT} as int)").alias("digit"),
                                                  F.struct("leaf", "carried").alias("of"))).alias("asks")), "asked")
    trees = manifest.subroots.join(by_node.select(F.col("_tree").alias("_t")).distinct(),
                                   F.col("_tree").eqNullSafe(F.col("_t")), "left_semi")
    # Through the tree above: from the root to the subroots of the requested groups.
    tops = trees.select(F.lit(0).alias("_tree"), "_rank")
    path = F.array().cast("array<struct<before:string,after:string>>")
    nodes = manifest.root.select(F.lit(0).alias("_tree"), F.lit(0).cast("long").alias("_rank"), "digest",
                                 F.col("digest").alias("root"), path.alias("path"))
    for height in range(len(manifest.top_records), 0, -1):
        nodes = _descend(nodes, manifest.top_records[height - 1], _asked(tops, height)).drop("of")
    starts = stored(trees.select("_tree", "height", F.col("_rank").alias("_top"))
                    .join(nodes.select(F.col("_rank").alias("_top"), F.col("digest"), "path", "root"), "_top")
                    .select("_tree", F.lit(0).cast("long").alias("_rank"), "digest", "path", "root",
                            F.col("digest").alias("subroot"), "height"), "subroot-paths")
    # Through the groups' own trees; a group joins at the height of its subroot.
    nodes = None
    for height in range(len(manifest.records), 0, -1):
        here = starts.where(F.col("height") == height).drop("height")
        here = here if nodes is None else nodes.unionByName(here)
        asked = (by_node.where("_n > 1") if height == 1 else
                 _asked(by_node.where("_n > 1").select("_tree", "_rank"), height - 1))
        nodes = _descend(here, manifest.records[height - 1], asked)
        nodes = nodes if height == 1 else nodes.drop("of")
    single = (starts.where("height = 0")
              .join(by_node.where("_n = 1").select(F.col("_tree").alias("_t"), F.explode("asks").alias("_ask")),
                    F.col("_tree").eqNullSafe(F.col("_t")))
              .withColumn("of", F.col("_ask")["of"]))
    columns = ["of", "subroot", "root", "path"]
    found = single.select(*columns) if nodes is None else nodes.select(*columns).unionByName(single.select(*columns))
    return found.select("of.leaf", "of.carried", "subroot", "root", F.reverse("path").alias("path"))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["before"], node, s["after"])))
