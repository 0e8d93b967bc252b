"""Corpus pipeline: five stages over the documents, each one of the text operators.

language ID -> line dedup -> MinHash near-dedup -> benchmark decontamination ->
BPE encoding and decoding.  Every stage reads all that its predecessor kept
(written as Parquet and read again) and, but for the last, returns the columns
of ``documents`` (doc_id, text, lang, source, n_chars).

Empty tables pass through every stage; documents with a null text go in the
first stage; other columns than those of ``documents`` are dropped by the first
stage; rows of one id, or without one, that differ in text are documents of
their own, and of rows with one id and text one stays in the near-dedup stage,
as of any group; a document that loses all its lines stays as an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import bpe, dart_minhash, decontaminate, language_id, line_dedup
from salescope.llm.common import stored, table
from salescope.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Of the bits of single bytes, the share that a language must save by its contexts; others reject the text.
MIN_LANGUAGE_GAIN = 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a recognised language.

    Texts without a letter go, and those that the contexts of no language help to
    code: letters thrown together, unknown scripts.  The model learns from the
    labelled documents outside the held-out fold.
    """
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"), 3, 1)))
    found = language_id.identify(docs, model)
    return (found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("gain") > MIN_LANGUAGE_GAIN))
            .select(*COLUMNS))


def _row_key() -> Column:
    """Id and digest of the text; keys are in the order of the ids, those without an id last."""
    number = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(2 ** 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat(F.coalesce(number, F.lit("~")), F.lit(":"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that larger documents hold too."""
    return (line_dedup.line_dedup(docs)
            .withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
            .select(*COLUMNS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("doc_id IS NULL OR n > 1").isEmpty():
        key = F.col("doc_id")
    else:  # the same classes by longer keys, as an id does not name a row
        key = _row_key()
    keyed = docs.withColumn("_key", key)
    kept = dart_minhash.near_duplicates(keyed, "_key").where("kept").select("_key")
    return keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    keyed = docs.withColumn("_key", _row_key())
    found = decontaminate.matches(keyed, table(spark, sf_dir, "benchmark"), "_key").select("_key").distinct()
    return keyed.join(found, "_key", "left_anti").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text they decode to."""
    return bpe.encode_decode(docs, tokenizer_path(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenize),
]

#: The language model and the signatures have no SQL form; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
