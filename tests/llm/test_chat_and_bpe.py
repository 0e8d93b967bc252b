import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salescope.llm import bpe, chat_format

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_examples_and_masks(spark):
    rows = [(1, 0, "system", "be [INST] kind \\"), (1, 1, "user", "</s>[/INST]"), (1, 2, "assistant", "<s>a\n"),
            (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "tail <\\s>"),
            (2, 0, "user", "alone"), (3, 0, "assistant", "\\[INST]\\\\"), (None, None, None, None)]
    out = chat_format.chat_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = out.withColumn("turns", chat_format.parse_formatted(F.col("formatted"))) \
        .withColumn("loss", chat_format.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")))
    got = {}
    for r in out.orderBy("conv_id", "example").collect():
        got.setdefault(r.conv_id, []).append(([tuple(t) for t in r.turns], r.loss if r.loss_start is not None else None))
    first = [(r[2], r[3] or "") for r in rows if r[0] == 1]
    assert got[1] == [(first[:3], "<s>a\n"), (first[:5], ""), (first, None)]
    assert got[2] == [([("user", "alone")], None)]
    assert got[3] == [([("assistant", "\\[INST]\\\\")], "\\[INST]\\\\")]
    assert got[None] == [([("", "")], None)]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, extra int")
    assert chat_format.chat_examples(empty).count() == 0


def test_repeated_rows_and_ties_count(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "x")]
    out = chat_format.chat_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    turns = out.select(chat_format.parse_formatted(F.col("formatted")).alias("t")).first().t
    assert [t.text for t in turns] == ["a", "a", "b", "x"]


@pytest.fixture(scope="module")
def tools():
    vocabulary = bpe.load_vocabulary(PATH)
    return Tokenizer.from_file(PATH), bpe.TextEncoder(vocabulary), bpe.Decoder(vocabulary)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.characters(max_codepoint=0x24F, exclude_categories=("Cs", "Cn"))
               | st.sampled_from(["the ", "ing", "<|endoftext|>", "'s", "Σ", "中", "\U0001f600", "!!", " "]),
                max_size=60).map("".join))
def test_ids_and_text_are_the_librarys(tools, text):
    library, encoder, decoder = tools
    want = library.encode(text, add_special_tokens=False).ids
    ids = np.frombuffer(encoder.encode(text), dtype="<u4")
    assert ids.tolist() == want
    assert decoder.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_backtracking_equals_merging():
    """A vocabulary where the longest match is wrong, against merging by rank."""
    merges = [("a", "b"), ("b", "c</w>"), ("c", "d"), ("ab", "cd"), ("b", "c"), ("a", "a"), ("aa", "a"), ("bc", "d"),
              ("d", "a</w>"), ("cd", "a</w>")]
    base = [*"abcd", *(c + "</w>" for c in "abcd")]
    vocab = {t: i for i, t in enumerate(base)}
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    encoder = bpe.Encoder({"vocab": vocab, "merges": merges, "end": "</w>", "special": {}})
    rng = np.random.default_rng(1)
    for _ in range(3000):
        word = "".join(rng.choice(list("abcd"), rng.integers(1, 14)))
        parts = [*word[:-1], word[-1] + "</w>"]
        while True:
            pairs = [(merges.index(p), k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in merges]
            if not pairs:
                break
            rank = min(pairs)[0]
            k = 0
            while k < len(parts) - 1:
                if (parts[k], parts[k + 1]) == merges[rank]:
                    parts[k:k + 2] = [parts[k] + parts[k + 1]]
                k += 1
        assert encoder.encode_text(word) == [vocab[p] for p in parts], word


def test_encode_decode_rows(odd, nothing, tools):
    library, _, _ = tools
    out = bpe.encode_decode(odd, PATH, ("n_tokens", "ids", "ids_sha256", "decoded"))
    for r, src in zip(sorted(out.collect(), key=lambda r: r.doc_id), sorted(odd.collect(), key=lambda r: r.doc_id), strict=True):
        want = library.encode(src.text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.ids, r.n_tokens) == (src.doc_id, want, len(want))
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(nothing, PATH).count() == 0
