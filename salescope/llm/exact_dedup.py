"""Exact dedup: a two-pass Bloom filter lets unique rows pass without a shuffle.

Pass one counts, per bit of a Bloom filter, how many rows set it; the bits set
by at least two rows are packed into bitmaps of 4 KB.  Pass two tests every row
against those bitmaps: a row one of whose bits nobody else set is unique and
passes straight through.  Only the others (repeated texts and a few false
positives) are grouped by their full digest.

Equality is that of the SHA-256 of the normalised text (A-Z lower-cased; a null
text counts as the empty text).  All steps are DataFrame functions.

Edge cases: null and empty texts are equal to each other; of equal texts the
largest id stays (a null id only if no other is there); rows repeated with the
same id all carry that id as ``keep_id`` and are all marked kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import ascii_lower, stored

#: Bits of one bitmap (4 KB), as built by ``bitmap_construct_agg``.
BITMAP_BITS = 32768
#: Largest filter: 2**30 bits, that is 128 MB to broadcast.  Beyond
#: ``MAX_BITS / BITS_PER_ROW`` rows it fills up and more unique rows take the
#: shuffle; the result is the same.
MAX_BITS = 1 << 30
BITS_PER_ROW = 16
HASHES = 2


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def filter_bits(n_rows: int) -> int:
    """Power of two with ``BITS_PER_ROW`` bits a row, within the broadcast bound."""
    bits = BITMAP_BITS
    while bits < min(MAX_BITS, n_rows * BITS_PER_ROW):
        bits *= 2
    return bits


def _positions(digest: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), digest), F.lit(bits)) for k in range(HASHES)]


def repeated_bits(digests: DataFrame, bits: int) -> DataFrame:
    """Pass one: bitmaps (``_bucket``, ``_bits``) of the positions that at least two rows set."""
    return (digests.select(F.explode(F.array(*_positions(F.col("_h"), bits))).alias("_p"))
            .groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            .groupBy(F.expr(f"_p div {BITMAP_BITS}").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.col("_p") % BITMAP_BITS).alias("_bits")))


def possibly_repeated(digests: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Pass two: adds ``_maybe``, false only for digests that no other row has.

    The bitmaps are at most ``bits / 8`` bytes, so they are broadcast.
    """
    out, every = digests, F.lit(True)
    for k, p in enumerate(_positions(F.col("_h"), bits)):
        side = F.broadcast(bitmaps.select(F.col("_bucket").alias(f"_bucket{k}"),
                                          F.col("_bits").alias(f"_bits{k}")))
        out = (out.withColumn(f"_p{k}", p)
               .withColumn(f"_bucket{k}", F.expr(f"_p{k} div {BITMAP_BITS}"))
               .join(side, f"_bucket{k}", "left"))
        byte = F.expr(f"cast(conv(hex(substring(_bits{k}, cast(_p{k} % {BITMAP_BITS} div 8 as int) + 1, 1)), 16, 10) as int)")
        is_set = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(_p{k} % 8 as int))")) != 0
        every = every & F.coalesce(is_set, F.lit(False))
    return out.select(*digests.columns, every.alias("_maybe"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    digests = stored(docs.select(F.col(id_col).alias("_id"),
                                 F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("_h")),
                     "digests")
    bits = filter_bits(digests.count())
    bitmaps = stored(repeated_bits(digests, bits), "repeated-bits")
    tested = possibly_repeated(digests, bitmaps, bits)
    shuffled = tested.where("_maybe").select("_id", "_h")
    # Written, so that both sides of the join are plain exchanges and a digest
    # with a third of all rows is split by the skew rule.
    groups = stored(shuffled.groupBy("_h").agg(F.max("_id").alias("_keep"),
                                               F.count(F.lit(1)).alias("_size")),
                    "digest-groups")
    out = (shuffled.join(groups, "_h").select("_id", "_keep", "_size", "_h")
           .unionByName(tested.where(~F.col("_maybe"))
                        .select("_id", F.col("_id").alias("_keep"),
                                F.lit(1).cast("long").alias("_size"), "_h")))
    return out.select(F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
                      F.col("_size").alias("group_size"),
                      F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
                      F.lower(F.hex("_h")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text no row with a larger id has; columns unchanged."""
    dropped = (exact_duplicates(docs, id_col, text_col).where(~F.col("kept"))
               .select(F.col(id_col).alias("_dropped"), F.col("text_sha256").alias("_digest")))
    # By id and text: an id may have another row that stays.
    same = docs[id_col].eqNullSafe(F.col("_dropped")) & (F.sha2(normalised(docs[text_col]), 256) == F.col("_digest"))
    return docs.join(dropped, same, "left_anti")
