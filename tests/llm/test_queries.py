"""The registered queries, and the pipeline, against brute force on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from salescope.llm import decontaminate, language_id
from salescope.llm.queries import ORACLE, QUERIES
from tests.llm.test_corpus import brute_classes, brute_substrings
from tests.llm.test_exact_and_lines import brute_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    key = list(want.columns[:2])
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True),
                                  want.sort_values(key).reset_index(drop=True), check_dtype=False)


def test_op1(spark, docs):
    out = QUERIES["op1_sharding"](spark, SF).toPandas().merge(docs, on="doc_id")
    assert len(out) == len(docs) and out["size"].tolist() == [len(t.encode()) + 8 for t in out.text]
    assert out.text_crc32.tolist() == [zlib.crc32(t.encode()) for t in out.text]
    assert set(out.shard) <= set(range(24)) and set(out.law) == {"bytes"} and out.grown_shard.isna().all()
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    mean = out["size"].sum() / 24
    for _, part in out.groupby("text"):
        assert part.shard.nunique() == 1 or part["size"].sum() > mean


def test_op2(spark, docs):
    out = QUERIES["op2_substring_dedup"](spark, SF).toPandas()
    want = brute_substrings(list(zip(docs.doc_id, docs.text, strict=True)))
    assert {r.doc_id: (r.text, r.n_removed) for r in out.itertuples()} == want


@pytest.mark.parametrize("name,parts,fold", [("op3_quality", 4, 2), ("op4_language_id", 3, 1)])
def test_op3_and_op4(spark, docs, name, parts, fold):
    out = QUERIES[name](spark, SF).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert out.held_out.tolist() == [zlib.crc32(str(i).encode()) % parts == fold for i in docs.doc_id]
    assert out.score.between(0, 1).all()
    if name == "op3_quality":
        assert (out.predicted == (out.score >= 0.7)).all()
    else:
        assert (out.lang_pred.to_numpy() == docs.lang.to_numpy())[out.held_out].mean() > 0.95


def brute_matches(rows, items):
    """Pairs by the full alignment of every item to every document that has enough of its words, in whatever order."""
    found, goals = set(), []
    for k, item in items:
        goal = re.findall(r"\w+", item.lower())
        number = {w: n for n, w in enumerate(dict.fromkeys(goal), 1)}
        goals.append((k, goal, number, np.array([number[w] for w in goal])))
    for i, text in rows:
        words = re.findall(r"\w+", text.lower())
        there = set(words)
        for k, goal, number, numbers in goals:
            if sum(w in there for w in goal) >= decontaminate.THRESHOLD * len(goal):  # two for each at most
                score, _, _ = decontaminate.align(np.array([number.get(w, 0) for w in words]), numbers)
                if score / (2 * len(goal)) >= decontaminate.THRESHOLD:
                    found.add((i, k))
    return found


def test_op8(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    out = QUERIES["op8_decontamination"](spark, SF).toPandas()
    want = brute_matches(zip(docs.doc_id, docs.text, strict=True), list(zip(items.item_id, items.text, strict=True)))
    assert set(zip(out.doc_id, out.item_id, strict=True)) == want and want


def test_op9(spark, docs):
    out = QUERIES["op9_minhash_dedup"](spark, SF).toPandas()
    assert dict(zip(out.doc_id, out.class_id, strict=True)) == brute_classes(list(zip(docs.doc_id, docs.text, strict=True)))


def encoded(texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    return [(len(x), hashlib.sha256(np.array(x, dtype="<u4").tobytes()).hexdigest(),
             hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()) for x in ids]


def test_op10(spark, docs):
    out = QUERIES["op10_bpe"](spark, SF).toPandas().set_index("doc_id").loc[docs.doc_id]
    assert list(zip(out.n_tokens, out.ids_sha256, out.decoded_sha256, strict=True)) == encoded(docs.text)


def brute_pipeline(docs, items):
    train = [(t, lang) for i, t, lang in zip(docs.doc_id, docs.text, docs.lang, strict=True)
             if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    grams = Counter()
    for text, lang in train:
        raw = language_id.START + text.encode()
        grams.update((lang, int.from_bytes(raw[k - 3:k + 1], "big")) for k in range(3, len(raw)))
    model = language_id.build_model(pd.DataFrame([(lang, g, n) for (lang, g), n in grams.items()],
                                                 columns=["lang", "gram", "n"]))
    langs, _, gains = language_id.predict(model, list(docs.text))
    rows = [(i, t) for i, t, lang, gain in zip(docs.doc_id, docs.text, langs, gains, strict=True)
            if lang != "und" and gain > 0]
    rows = [(i, kept) for i, (kept, _, _) in brute_lines(rows).items()]
    classes = brute_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    leaked = {i for i, _ in brute_matches(rows, items)}
    rows = [(i, t) for i, t in rows if i not in leaked]
    return {i: e for (i, _), e in zip(rows, encoded([t for _, t in rows]), strict=True)}


def test_pipeline_against_brute_force(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    out = corpus_pipeline.run(spark, SF).toPandas()
    want = brute_pipeline(docs, list(zip(items.item_id, items.text, strict=True)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.itertuples()} == want


def test_stages_on_odd_rows(spark, odd, nothing):
    # Ids of which the fourth and the sixth are not in the held-out fold.
    more = next(m for m in range(100) if all(zlib.crc32(str(k + m).encode()) % 3 != 1 for k in (4, 6)))
    odd = odd.withColumn("doc_id", odd.doc_id + more).select(odd.columns)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text.replace("'", "")
    for i, text in ((None, "Equal words here without an id"), (None, f"Equal words here {item}"),
                    (4 + more, "Equal words here of them but another text")):
        odd = odd.unionByName(odd.limit(1).selectExpr(f"CAST({i or 'NULL'} AS BIGINT) AS doc_id", f"'{text}' AS text", "'en' AS lang",
                                                      "source", "n_chars", "_id", "score", "kept"))
    for start in (odd, nothing):
        frame = start
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert tuple(frame.columns) == corpus_pipeline.COLUMNS
            frame = spark.createDataFrame(frame.collect(), frame.schema)
        got = sorted(r.doc_id or -1 for r in frame.collect())
        assert got == ([-1, 4 + more, 4 + more, 6 + more] if start is odd else [])
