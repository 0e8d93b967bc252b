"""Sharding: best-fit-decreasing bin packing of indivisible groups.

Groups (rows of equal text) are packed by their bytes.  Sorted by size, largest
first, each enters the bin with the tightest remaining capacity that still
holds it, found as the successor in a balanced tree; a new bin opens where none
fits.  Two levels make that a Spark job of any size:

1. The groups are dealt by hash over cells.  Each task packs the groups of a
   cell into small bins (crates) of a fixed capacity, a small part of a shard.
   Groups larger than a crate are crates of their own.
2. The crates, whose number is bounded by ``shards * CRATES + cells``, are
   packed by the same rule into the shards; the capacity is the smallest for
   which the given number of shards is enough, found by bisection.

A group larger than a shard's mean size cannot stay whole in shards of equal
size: it alone is split, by the rows' number in the group, into pieces of up to a
crate.

Edge cases: a null text has no bytes, and equals the empty text; rows repeated
with one id are rows like any other; ties of size are broken by the group's
digest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import stored

#: Crates of one shard, of which its size is made up.
CRATES = 400
#: Groups that a cell holds, and the most cells.
CELL_GROUPS, MAX_CELLS = 100_000, 4096
#: Rows numbered together, and the fewest parts of a shard that are numbered apart.
SLOT_ROWS, SLOT_PARTS = 500_000, 16
ROW_OVERHEAD = 8


class FreeSpace:
    """The free space of bins as a balanced tree (a treap): insert, and take the tightest fit."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]; key = (free, bin)

    @staticmethod
    def _merge(a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = FreeSpace._merge(a[3], b)
            return a
        b[2] = FreeSpace._merge(a, b[2])
        return b

    @staticmethod
    def _split(node: list | None, key: tuple) -> tuple:
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = FreeSpace._split(node[3], key)
            return node, right
        left, node[2] = FreeSpace._split(node[2], key)
        return left, node

    def insert(self, free: int, bin_no: int) -> None:
        key = (free, bin_no)
        left, right = self._split(self.root, key)
        priority = (bin_no * 0x9E3779B97F4A7C15 ^ free * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
        node = [key, priority * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF, None, None]
        self.root = self._merge(self._merge(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the (free, bin) of least free space of at least ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        first = right
        while first[2] is not None:
            first = first[2]
        _, rest = self._split(right, (first[0][0], first[0][1] + 1))
        self.root = self._merge(left, rest)
        return first[0]


def best_fit_decreasing(sizes: Iterable[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin number for each of ``sizes`` (in decreasing order); None if it takes over ``most`` bins.

    An item larger than the capacity has a bin of its own.
    """
    tree, bins, out = FreeSpace(), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            if bins == most:
                return None
            found, bins = (capacity, bins), bins + 1
        if found[0] - size > 0:
            tree.insert(found[0] - size, found[1])
        out.append(found[1])
    return out


def pack_into(sizes: list[int], bins: int) -> list[int]:
    """Best-fit decreasing into ``bins`` bins of the smallest capacity that is enough."""
    if not sizes:
        return []
    low = max(sizes[0], -(-sum(sizes) // bins))
    high, best = low, best_fit_decreasing(sizes, low, bins)
    step = max(1, low // 1000)
    while best is None:
        low, high, step = high + 1, high + step, step * 2
        best = best_fit_decreasing(sizes, high, bins)
    while high - low > high // 10_000:
        mid = (low + high) // 2
        found = best_fit_decreasing(sizes, mid, bins)
        if found is None:
            low = mid + 1
        else:
            high, best = mid, found
    return best


def _pack_cell(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_bytes", "_g"], ascending=[False, True], kind="stable")
        bins = best_fit_decreasing(pdf["_bytes"].tolist(), capacity)
        return pd.DataFrame({"_g": pdf["_g"], "_crate": [f"c{c}-{b}" for c, b in zip(pdf["_cell"], bins, strict=True)],
                             "_bytes": pdf["_bytes"]})
    return pack


def _crate_rows(crates: list, shards: int) -> Iterator[tuple[str, int]]:
    """The driver's part: (crate, shard) for the bounded list of (crate, bytes)."""
    crates = sorted(((r["_crate"], r["_bytes"]) for r in crates), key=lambda r: (-r[1], r[0]))
    return zip((c for c, _ in crates), pack_into([b for _, b in crates], shards), strict=True)


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``group_digest``, ``shard``, ``slot``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(F.col(id_col).alias("_id"),
                              (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("_size"),
                              F.crc32(text.cast("binary")).alias("_crc"),
                              F.unhex(F.md5(text)).alias("_g")), "shard-rows")
    groups = stored(rows.groupBy("_g").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_n")),
                    "shard-groups")
    total, n_groups = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.count(F.lit(1))).first()
    crate = max(1, total // (shards * CRATES))
    cells = min(MAX_CELLS, max(1, -(-n_groups // CELL_GROUPS)) * 8)
    # Level 1: at most shards * CRATES groups are larger than a crate.
    big = F.col("_bytes") > crate
    cell = F.pmod(F.xxhash64("_g"), F.lit(cells))
    small = (groups.where(~big).withColumn("_cell", cell).groupBy("_cell")
             .applyInPandas(_pack_cell(crate), "_g binary, _crate string, _bytes long"))
    # Of a group too large for a shard, a piece takes the rows that fit into a crate, one at least.
    piece_rows = F.greatest(F.lit(1), F.floor(F.lit(crate) * F.col("_n") / F.col("_bytes")))
    pieces = F.when(F.col("_bytes") > total // shards, F.ceil(F.col("_n") / piece_rows)).otherwise(F.lit(1))
    large = (groups.where(big)
             .select("_g", F.explode(F.sequence(F.lit(0), pieces.cast("int") - 1)).alias("_piece"),
                     (F.col("_bytes") / pieces).cast("long").alias("_bytes"))
             .select("_g", F.concat(F.lit("g"), F.hex("_g"), F.lit("-"), F.col("_piece")).alias("_crate"), "_bytes"))
    packed = stored(small.unionByName(large), "shard-crates")
    # Level 2: bounded, on the driver.
    crates = packed.groupBy("_crate").agg(F.sum("_bytes").alias("_bytes")).collect()
    placed = spark.createDataFrame(list(_crate_rows(crates, shards)), "_crate string, shard int")
    # A split group has a list of shards; its rows are dealt to it by their number in the group.
    homes = stored(packed.join(F.broadcast(placed), "_crate")
                   .groupBy("_g").agg(F.sort_array(F.collect_list("shard")).alias("_shards")), "shard-homes")
    at_home = stored(rows.join(homes, "_g"), "shard-rows-homes")
    whole = at_home.where(F.size("_shards") == 1).withColumn("shard", F.get("_shards", F.lit(0)))
    parts = max(SLOT_PARTS, at_home.count() // (shards * SLOT_ROWS))
    split = _numbered(at_home.where(F.size("_shards") > 1), ["_g"], parts * shards)
    split = split.withColumn("shard", F.get("_shards", (F.col("_number") % F.size("_shards")).cast("int")))
    columns = ["_id", "_size", "_crc", "_g", "shard"]
    dealt = stored(whole.select(*columns).unionByName(split.select(*columns)), "shard-dealt")
    return _numbered(dealt, ["shard"], parts).select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lower(F.hex("_g")).alias("group_digest"), "shard", F.col("_number").alias("slot"))


def _numbered(rows: DataFrame, key: list[str], n_parts: int) -> DataFrame:
    """``_number``: gapless from 0 within each key, numbered in ``n_parts`` parts of it."""
    parts = rows.withColumn("_part", F.pmod(F.xxhash64("_id", "_g"), F.lit(n_parts)).cast("int"))
    counts = parts.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_in_part"))
    before = F.sum("_in_part").over(Window.partitionBy(*key).orderBy("_part")
                                    .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*key, "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(*key, "_part").orderBy("_id", "_g"))
    # Keys are shards, or groups larger than a shard: at most as many as shards.
    return (parts.withColumn("_local", local).join(F.broadcast(offsets), [*key, "_part"])
            .withColumn("_number", (F.col("_before") + F.col("_local") - 1).cast("long")))
