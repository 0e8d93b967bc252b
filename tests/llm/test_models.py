import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from salescope.llm import language_id, quality

SF = "/root/testdata/sf0.01"


def brute_lengths(texts, grams, text):
    """Code lengths straight from the definition, context by context."""
    counts = {}
    for (lang, gram), n in grams.items():
        for k in range(4):
            counts.setdefault((lang, gram[3 - k:3]), {}).setdefault(gram[3], 0)
            counts[lang, gram[3 - k:3]][gram[3]] += n
    totals = {}
    for (_, gram), n in grams.items():
        totals[gram[:3]] = totals.get(gram[:3], 0) + n

    def p(lang, context, byte):
        if len(context) == 3 and totals.get(context, 0) < language_id.MIN_SEEN:
            return p(lang, context[1:], byte)
        seen = counts.get((lang, context), {})
        total, distinct = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (total + distinct)

        def shorter(b):
            return p(lang, context[1:], b) if context else 1 / 256

        if not seen:
            return shorter(byte)
        return distinct / (total + distinct) * shorter(byte) / sum(shorter(b) for b in range(256) if b not in seen)

    raw = language_id.START + text
    langs = sorted({lang for lang, _ in grams})
    return [sum(-np.log2(p(lang, raw[k - 3:k], raw[k])) for k in range(3, len(raw))) for lang in langs]


def test_code_lengths_against_the_definition():
    texts = {"aa": b"the cat and the hat and the bat", "bb": b"der hut und die katze und der ball"}
    grams = {}
    for lang, t in texts.items():
        raw = language_id.START + t
        for k in range(3, len(raw)):
            grams[lang, raw[k - 3:k + 1]] = grams.get((lang, raw[k - 3:k + 1]), 0) + 1
    frame = pd.DataFrame([(lang, int.from_bytes(g, "big"), n) for (lang, g), n in grams.items()],
                         columns=["lang", "gram", "n"])
    model = language_id.build_model(frame)
    for text in (b"the hut", b"and", b"zz \xc3\xa9"):
        np.testing.assert_allclose(language_id.code_lengths(model, [text])[0], brute_lengths(texts, grams, text), rtol=1e-5)
    whole = b"the katze and " * 30
    want = language_id.code_lengths(model, [whole])[0]
    language_id.CHUNK, chunk = 17, language_id.CHUNK
    try:  # a text over many chunks, between others
        np.testing.assert_allclose(language_id.code_lengths(model, [b"x", b"", whole, b"y"])[2], want, rtol=1e-6)
    finally:
        language_id.CHUNK = chunk


def test_every_language_keeps_its_contexts():
    large, small = [(97 + k // 26, 97 + k % 26, 122) for k in range(100)], [(65 + k, 65, 66) for k in range(20)]
    frame = pd.DataFrame([(lang, int.from_bytes(bytes([*c, 120]), "big"), n)
                          for lang, contexts, n in (("aa", large, 100), ("bb", small, 10)) for c in contexts],
                         columns=["lang", "gram", "n"])
    model = language_id.build_model(frame)

    def own(context):
        last = model.two[context[1] << 8 | context[2]]
        return model.three[last << 8 | context[0]] != last

    assert all(map(own, small)) and all(map(own, large))


def test_model_grows_with_the_counts_of_its_languages():
    rng = np.random.default_rng(5)
    words = [[bytes(rng.integers(97, 123, rng.integers(2, 7)).tolist()) for _ in range(60)] for _ in range(50)]
    texts = [b" ".join(own[k] for k in rng.integers(0, 60, 400)) for own in words]
    frame = pd.concat([pd.DataFrame({"lang": f"l{k:02}", "gram": grams.astype(np.int64), "n": n}) for k, t in enumerate(texts)
                       for grams, n in [np.unique(language_id._grams(np.frombuffer(language_id.START + t, np.uint8)),
                                                  return_counts=True)]])
    model = language_id.build_model(frame)
    assert len(model.keys) <= 3 * len(frame)
    langs, _, gains = language_id.predict(model, [b" ".join(own[::-1]).decode() for own in words])
    assert langs == [f"l{k:02}" for k in range(50)] and (gains > 0).all()


def test_gain_tells_texts_of_no_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = language_id.held_out(F.col("doc_id"), 3, 1)
    model = language_id.train(docs.where(~fold))
    texts = ["qzx vjw kqx zzxq", "xkcd wqrt zzz pqx jjv", "Это русский текст, которого никто не учил.", "これは日本語の文章です。"]
    assert (language_id.predict(model, texts)[2] <= 0).all()
    clean = docs.where(fold).toPandas()
    assert (language_id.predict(model, list(clean.text))[2] > 0).mean() == 1


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = language_id.held_out(F.col("doc_id"), 3, 1)
    model = language_id.train(docs.where(~fold), sample_docs=100)
    out = language_id.identify(docs, model).withColumn("held_out", fold).toPandas()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert (out.lang_pred == out.lang)[out.held_out].mean() > 0.99
    assert out.score.between(0, 1).all()


def test_language_odd_rows(odd, nothing):
    model = language_id.train(odd)
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(odd, model).collect()}
    wide = odd.withColumnRenamed("kept", "Lang_Pred").withColumnRenamed("_id", "_found")
    clash = language_id.identify(wide, model)
    assert clash.columns == ["doc_id", "text", "lang", "source", "n_chars", "_found", "lang_pred", "score", "gain"]
    assert {(r._found, r.lang_pred) for r in clash.where("doc_id = 4").collect()} == {("clash", "en")}
    assert out[1] == out[2] == out[3] == ("und", 0.0)
    assert out[4] == out[6] == ("en", 1.0)
    assert language_id.identify(nothing, language_id.train(nothing)).count() == 0
    assert language_id.identify(odd, None).where("lang_pred <> 'und'").count() == 0


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.01', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    fold = language_id.held_out(F.col("doc_id"), 4, 2)
    model = quality.train(docs, labels.where(~fold))
    out = quality.score(docs.join(labels, "doc_id").where(fold), model).toPandas()
    rank, good = out.score.rank(), out.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.98 and (out.predicted == out.quality).mean() > 0.97


def test_trees_equal_a_walk_through_them():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.fit(x, y, trees=80, depth=3, bins=64)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    for row, s in zip(x[:50], model.score(x[:50]), strict=True):
        raw = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            raw += value[node - len(feature)]
        assert abs(1 / (1 + np.exp(-raw)) - s) < 1e-12


def test_class_counts_over_chunks(monkeypatch):
    texts = [b"", b"Ab1 .", b"x" * 50, b"", b"!|\xc3\xa9", b""]
    whole = quality.class_counts(texts)
    monkeypatch.setattr(quality, "CHUNK", 7)
    np.testing.assert_array_equal(quality.class_counts(texts), whole)
    assert whole.sum(1).tolist() == [len(t) for t in texts]


def test_quality_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1, None), (4, 1, 1), (5, 0, 1), (6, None, 0), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = odd.withColumnRenamed("kept", "Predicted").withColumnRenamed("_id", "_score")
    out = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 and r._score == "clash" and r.predicted in (0, 1) for r in out)
    one_class = quality.train(docs, labels.where("quality = 1"))
    assert {round(r.score, 6) for r in quality.score(docs, one_class).collect()} == {0.75}
    assert quality.score(nothing, quality.train(nothing, labels.limit(0))).count() == 0
