"""Line dedup: levelled sorted runs of line hashes, merged as batches arrive.

The index of known lines is a set of runs: tables bucketed and sorted by line
hash, in levels.  Each new batch of documents is reduced to one row per line
hash, merge-anti-joined with the runs, and what is new becomes a run of level
0.  Whenever a level holds ``fanout`` runs they are compacted into one run of
the next level, so a batch meets a logarithmic number of runs.  Runs and batch
have the same buckets, so these joins need no shuffle of the runs.

A line's key is the line without leading and trailing ASCII white space, A-Z
lower-cased; lines are compared by the 128-bit MD5 of the key.  A key of at
least ``min_chars`` code points found in at least ``min_docs`` documents loses
all its lines, but for those of the largest id holding it.

All steps are DataFrame functions.  Edge cases: a null or empty text is one
empty line; very long texts are split whole; an id with several rows counts as
one document, of which each row loses its own repeated lines; a line repeated
inside one document counts once there, and stays or goes as a whole; a null id
never is the largest; an empty table gives an empty result; other columns pass
through, but for those called ``n_lines`` or ``n_dropped``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ASCII_SPACE, ascii_lower, shared_path, stored

MIN_CHARS = 20
MIN_DOCS = 3
#: Batches in which a whole table is fed to the index, and runs a level holds.
BATCHES = 4
FANOUT = 2


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def text_digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(``_id``, ``_digest`` of the text, ``_pos``, ``_h``) of every line long enough to be compared."""
    return (docs.select(F.col(id_col).alias("_id"), text_digest(F.col(text_col)).alias("_digest"),
                        F.posexplode(text_lines(F.col(text_col))))
            .select("_id", "_digest", F.col("pos").alias("_pos"), line_key(F.col("col")).alias("_key"))
            .where(F.char_length("_key") >= min_chars)
            .select("_id", "_digest", "_pos", F.unhex(F.md5(F.col("_key"))).alias("_h")))


class LineRuns:
    """The levelled runs: rows (``_h``, ``_n`` documents, ``_top`` largest id) by first sight."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.batches: list[tuple[str, str]] = []
        self.tables: list[str] = []

    def _sorted_run(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.bucketBy(self.buckets, "_h").sortBy("_h").format("parquet")
         .option("path", shared_path(self.spark, "line-run")).saveAsTable(name))
        self.tables.append(name)
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def ingest(self, hashes: DataFrame) -> None:
        """Adds a batch of (``_id``, ``_h``) whose ids are in no other batch."""
        keys = (hashes.select("_h", "_id").distinct()
                .groupBy("_h").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_top")))
        batch = self._sorted_run(keys)
        fresh = self.spark.table(batch)
        for run in self.runs():
            fresh = fresh.join(self.spark.table(run).select("_h"), "_h", "left_anti")
        own = self._sorted_run(fresh) if self.runs() else batch
        self.batches.append((batch, own))
        self._add(own, 0)

    def _add(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.spark.table(self.levels[level][0])
            for name in self.levels[level][1:]:
                merged = merged.unionByName(self.spark.table(name))
            compacted = self._sorted_run(merged.repartition(self.buckets, "_h"))
            self.levels[level] = []
            self._add(compacted, level + 1)

    def repeated(self, min_docs: int) -> DataFrame:
        """(``_h``, ``_top``) of the keys found in at least ``min_docs`` documents."""
        again = None  # what later batches found of keys that a run already had
        for batch, own in self.batches:
            if batch != own:
                rows = self.spark.table(batch).join(self.spark.table(own).select("_h"), "_h", "left_anti")
                again = rows if again is None else again.unionByName(rows)
        first = None
        for run in self.runs():
            first = self.spark.table(run) if first is None else first.unionByName(self.spark.table(run))
        if again is not None:
            more = again.groupBy("_h").agg(F.sum("_n").alias("_more"), F.max("_top").alias("_later"))
            first = (first.join(more, "_h", "left")
                     .select("_h", (F.col("_n") + F.coalesce("_more", F.lit(0))).alias("_n"),
                             F.greatest("_top", "_later").alias("_top")))
        return first.where(F.col("_n") >= min_docs).select("_h", "_top")

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with the text without the dropped lines, ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    lines = stored(line_hashes(docs, id_col, text_col, min_chars)
                   .withColumn("_batch", F.pmod(F.xxhash64("_id"), F.lit(batches)).cast("int")),
                   "lines", partition_by="_batch")
    index = LineRuns(spark, fanout)
    try:
        for batch in range(batches):
            index.ingest(lines.where(F.col("_batch") == batch))
        repeated = stored(index.repeated(min_docs), "repeated-lines")
    finally:
        index.close()
    # By id and text: of two rows with one id, each loses its own repeated lines.
    drops = (lines.join(repeated, "_h")
             .where(~F.col("_id").eqNullSafe(F.col("_top")))
             .groupBy("_id", "_digest").agg(F.collect_set("_pos").alias("_drops")))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    text = F.coalesce(F.col("_row")[text_col], F.lit(""))
    own_row = F.col("_row")[id_col].eqNullSafe(F.col("_id")) & (text_digest(F.col("_row")[text_col]) == F.col("_digest"))
    out = (rows.join(drops, own_row, "left")
           .select("_row", "_drops", text.alias("_text"), text_lines(text).alias("_lines")))
    # The outer lambda binds lines and kept numbers once, the inner one picks.
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))
    kept = F.transform(F.array(F.struct(F.col("_lines").alias("l"), stay.alias("k"))),
                       lambda s: F.array_join(F.transform(s["k"], lambda i: F.get(s["l"], i)), "\n"))
    own = [F.col("_row")[c].alias(c) for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    return out.select(*own,
                      F.when(F.col("_drops").isNull(), F.col("_text")).otherwise(F.get(kept, 0)).alias(text_col),
                      F.size("_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("n_dropped"))
