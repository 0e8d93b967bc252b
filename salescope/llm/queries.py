"""Registered queries ``opN_<name>`` of the text operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import (bpe, chat_format, dart_minhash, decontaminate, exact_dedup, language_id, license_scan,
                           line_dedup, merkle, prefix_trie, quality, sharding, sql, substring_dedup)
from salescope.llm.common import ascii_lower, stored, table

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


SHARDS = 24
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, equal texts together."""
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences that stand in an earlier place too."""
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the labels of one fold of four are never read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~language_id.held_out(F.col("doc_id"), 4, 2)))
    return (quality.score(docs, model)
            .select("doc_id", language_id.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; one fold of three is never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"), 3, 1)))
    return (language_id.identify(docs.drop("lang"), model)
            .select("doc_id", language_id.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, then read back from the examples."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                 "conv_id long, turn long, role string, text string")
    examples = chat_format.chat_examples(turns.unionByName(more))
    loss = chat_format.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    convs = (examples.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("_whole"),
        F.sort_array(F.collect_list(F.struct("example", loss.alias("text")))).alias("_loss"),
        F.sum(F.char_length("formatted")).alias("formatted_chars"))
        .withColumn("_turns", chat_format.parse_formatted(F.col("_whole")))
        .withColumn("_text", F.array_join(F.col("_loss.text"), "")))
    read = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return convs.select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                        F.sha2(read, 256).alias("turns_sha256"),
                        F.char_length("_text").cast("long").alias("loss_chars"),
                        F.sha2("_text", 256).alias("loss_sha256"), "formatted_chars")


def _esc(c: str) -> str:
    out = rf"replace({c}, '\', '\\')"
    for w in chat_format.CONTROL:
        out = rf"replace({out}, '{w}', '{w[0]}\{w[1:]}')"
    return out


_OP5 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
        sum(length({_esc('role')}) + length({_esc('text')}) + {len(chat_format.OPEN + chat_format.MID + chat_format.CLOSE)}) OVER w AS upto
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all documents, with the digest of the text that stays."""
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_OP6 = f"""
WITH l AS (
  SELECT doc_id, line, pos,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
r AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= {line_dedup.MIN_CHARS}
      GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
m AS (SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.top AS dropped FROM l LEFT JOIN r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents: who stays, size of the group, digest."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


_OP7 = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), {_AZ})) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds, as it is or edited."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded from its ids."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(),
                             ("n_tokens", "ids_sha256", "decoded_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, folded from the document or, for one id in five by its CRC, a tampered copy."""
    docs = table(spark, sf_dir, "documents")
    tampered = merkle.leaf_digest(*(ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS))
    leaf = merkle.leaf_digest(*(F.col(c) for c in merkle.FIELDS))
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, tampered).otherwise(leaf)
    proofs = merkle.prove(merkle.build(docs, carried=F.struct("doc_id", claim.alias("claim"))))
    folded = proofs.withColumn("folded_root", merkle.fold(F.col("carried.claim"), F.col("path")))
    return folded.select("carried.doc_id", "leaf", "subroot", "root",
                         merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))



def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that every document names or quotes."""
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    starts, base = F.col("places.start"), F.array_distinct("places.label")
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        F.array_join(F.array_sort(base), ",").alias("base_labels"),
                        F.array_join(F.array_sort(F.array_union(base, "detections.label")), ",").alias("labels"), "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, each rebuilt on the first turns of its hundred's first one."""
    own = stored(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations")), "own-turns")
    heads = own.where("_rank = 0").select("conv", F.col("_n").alias("n"))
    # A base has a hundred conversations at most, and each takes fewer than six of its turns.
    base = (F.col("conv") - F.col("conv") % 100).alias("base")
    convs = heads.select("conv", base, (F.crc32(F.col("conv").cast("string")) % 6).alias("h"))
    convs = stored(convs.join(heads.select(F.col("conv").alias("base"), F.col("n").alias("of_base")), "base", "left")
                   .withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0)))), "rebuilt-conversations")
    first = own.where("_rank < 5").select(F.col("conv").alias("base"), "_rank", "digest", "chars")
    turns = (convs.join(first, "base").where(F.col("_rank") < F.col("h")).select("conv", "_rank", "digest", "chars")
             .unionByName(own.join(convs, "conv").where(F.col("_rank") >= F.col("h"))
                          .select("conv", (F.col("_rank") - F.col("h") + F.col("taken")).alias("_rank"), "digest", "chars")))
    return prefix_trie.prefix_trie(turns, convs.select("conv"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality": op3_quality,
    "op4_language_id": op4_language_id,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_bpe": op10_bpe,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_license_scan": op12_license_scan,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = {
    "op5_chat_formatting": _OP5,
    "op6_line_dedup": _OP6,
    "op7_exact_dedup": _OP7,
    "op11_merkle_manifest": sql.OP11,
    "op13_prefix_trie": sql.OP13,
}
