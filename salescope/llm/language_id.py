"""Language ID: prediction by partial matching with frozen byte statistics.

For every language a context tree of bytes holds how often each byte followed
each context of up to three bytes.  The probability of a byte comes from the
longest context that the tree knows; what the context has not seen escapes,
with probability ``distinct / (total + distinct)`` (method C), to the next
shorter context, without the bytes already excluded, and at last to a uniform
byte.  The code length of a text is the sum of ``-log2 p`` over all its bytes;
the language with the shortest code wins and ``score`` is its share of
``2 ** -length`` over all languages.

Frozen statistics make every code length a table entry: the trees of all
languages are joined into one automaton of contexts.  It is sparse: a context
has an entry for each byte that followed it in some language, with its bits in
every language, and the bits of the escape to the next shorter context for all
others, so its size is that of the counts times the languages.  A batch of
texts is scored by a search per byte.  The n-gram counts are a Spark aggregation.

``gain`` tells whether a text is in the language at all: the share of bits that
the contexts save against the frequencies of single bytes in the language found.
It is 0 or less where contexts do not help: letters thrown together, unknown scripts.

The model is learned from a bounded sample of the labelled rows: about
``TRAIN_DOCS`` documents a language, chosen by a hash of the id, each read
whole.  Languages are tags, so their number is bounded.

Edge cases: a null text and a text without a letter is ``und`` with score and
gain 0; with no labelled row at all every text is ``und``; ties go to the language
first in order; texts of any length are scored whole; other columns, the
label's and the id's included, are never inputs; input columns named as an
output column give way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import others, slices

UNKNOWN = "und"
TRAIN_DOCS = 3000
#: A three-byte context must have been seen so often to be a node of its own.
MIN_SEEN = 4
#: Text before the first byte, and bytes that are scored at a time.
START = b"\n\n\n"
CHUNK = 1 << 20
#: Contexts whose probabilities are worked out at a time.
ROWS = 2048
_LETTER = re.compile(r"[^\W\d_]")
_SAMPLE = 1 << 20


@dataclass
class LanguageModel:
    langs: list[str]
    two: np.ndarray     # (byte before, last byte) -> state of the two-byte context, or of the last byte
    three: np.ndarray   # (two-byte state, byte two before) -> state
    keys: np.ndarray    # state * 256 + byte, in order: the bytes that some language has in the state
    cost: np.ndarray    # key -> bits in each language
    escape: np.ndarray  # state -> bits in each language before any other byte
    parent: np.ndarray  # state -> state of the next shorter context, -1 for none
    base: np.ndarray    # byte -> bits in each language without a context


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n): how often each run of four bytes occurs in the texts of each language."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                for raw in _chunks(texts):
                    grams, n = np.unique(_grams(raw), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n.astype(np.int64)})

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return (rows.mapInPandas(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _chunks(texts: pd.Series) -> Iterator[np.ndarray]:
    held, size = [], 0
    for text in texts:
        held.append(START + text.encode("utf-8"))
        size += len(held[-1])
        if size >= CHUNK:
            yield np.frombuffer(b"".join(held), dtype=np.uint8)
            held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), dtype=np.uint8)


def _grams(raw: np.ndarray) -> np.ndarray:
    if len(raw) < 4:
        return np.zeros(0, dtype=np.uint32)
    x = raw.astype(np.uint32)
    return x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:]


def _mixed(counts: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Method C with exclusion: seen bytes by their counts, the others by the escape; and the factor of those."""
    total, seen = counts.sum(1, keepdims=True), counts > 0
    distinct = seen.sum(1, keepdims=True)
    escape = np.where(total > 0, distinct / np.maximum(total + distinct, 1), 1.0)
    left = np.where(seen, 0.0, parent)
    factor = escape / np.maximum(left.sum(1, keepdims=True), 1e-300)
    return np.where(seen, counts / np.maximum(total + distinct, 1), factor * left), factor[:, 0]


def _bits(p: np.ndarray) -> np.ndarray:
    return -np.log2(np.maximum(p, 1e-300))


def build_model(grams: pd.DataFrame) -> LanguageModel | None:
    """The joined context automaton of the counts of all languages."""
    if grams.empty:
        return None
    langs = sorted(grams["lang"].unique())
    gram, n = grams["gram"].to_numpy(), grams["n"].to_numpy(dtype=np.float64)
    lang = np.searchsorted(langs, grams["lang"].to_numpy())
    byte = gram & 0xFF
    pairs = np.unique(gram >> 8 & 0xFFFF)
    triples, at = np.unique(gram >> 8, return_inverse=True)
    triples = triples[np.bincount(at, weights=n) >= MIN_SEEN]
    # States: 256 last bytes, then pairs, then triples; the automaton leads to the longest.
    two = np.tile(np.arange(256, dtype=np.int32), 256)
    two[pairs] = 256 + np.arange(len(pairs))
    n_two = 256 + len(pairs)
    three = np.repeat(np.arange(n_two, dtype=np.int32), 256)
    inside = two[triples & 0xFFFF]
    three[inside * 256 + (triples >> 16)] = n_two + np.arange(len(triples))
    # The state of each order in which a gram's last byte is seen.
    where = np.minimum(np.searchsorted(triples, gram >> 8), max(len(triples) - 1, 0))
    at_three = np.where(triples[where] == gram >> 8, where, -1) if len(triples) else np.full(len(gram), -1)
    at_one, at_two = gram >> 8 & 0xFF, two[gram >> 8 & 0xFFFF].astype(np.int64) - 256
    keys = np.unique(np.concatenate([at_one, at_two + 256, at_three[at_three >= 0] + n_two]) << 8
                     | np.concatenate([byte, byte, byte[at_three >= 0]]))
    states = n_two + len(triples)
    parent = np.concatenate([np.full(256, -1), pairs & 0xFF, inside]).astype(np.int32)
    cost = np.empty((len(keys), len(langs)), dtype=np.float32)
    escape = np.empty((states, len(langs)), dtype=np.float32)
    base = np.empty((256, len(langs)), dtype=np.float32)
    for k in range(len(langs)):
        mine = lang == k
        w, b = n[mine], byte[mine]

        def table(size: int, node: np.ndarray) -> np.ndarray:
            ok = node >= 0
            return np.bincount(node[ok] * 256 + b[ok], weights=w[ok], minlength=size * 256).reshape(size, 256)

        def keep(low: int, p: np.ndarray, factor: np.ndarray) -> None:
            start, end = np.searchsorted(keys, [low << 8, low + len(p) << 8])
            cost[start:end, k] = _bits(p.ravel()[keys[start:end] - (low << 8)])
            escape[low:low + len(p), k] = _bits(factor)

        p0, _ = _mixed(table(1, np.zeros_like(b)), np.full((1, 256), 1 / 256))
        base[:, k] = _bits(p0[0])
        p1, factor = _mixed(table(256, at_one[mine]), np.repeat(p0, 256, 0))
        keep(0, p1, factor)
        p2, factor = _mixed(table(len(pairs), at_two[mine]), p1[pairs & 0xFF])
        keep(256, p2, factor)
        node = at_three[mine]
        for low in range(0, len(triples), ROWS):  # the largest table, a part at a time
            part = triples[low:low + ROWS]
            own = np.where((node >= low) & (node < low + ROWS), node - low, -1)
            keep(n_two + low, *_mixed(table(len(part), own), p2[two[part & 0xFFFF] - 256]))
    return LanguageModel([str(x) for x in langs], two, three, keys, cost, escape, parent, base)


def _byte_bits(model: LanguageModel, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Bits of each byte (rows) after its context in every language (columns)."""
    key = state.astype(np.int64) << 8 | byte
    at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
    bits = model.cost[at]
    rest = np.flatnonzero(model.keys[at] != key)
    bits[rest] = 0
    state = state[rest]
    while len(rest):  # escapes, at most one for each order
        bits[rest] += model.escape[state]
        state = model.parent[state]
        top = state < 0
        bits[rest[top]] += model.base[byte[rest[top]]]
        rest, state = rest[~top], state[~top]
        key = state.astype(np.int64) << 8 | byte[rest]
        at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
        hit = model.keys[at] == key
        bits[rest[hit]] += model.cost[at[hit]]
        rest, state = rest[~hit], state[~hit]
    return bits


def code_lengths(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Bits of every text (rows) in every language (columns)."""
    out = np.zeros((len(texts), len(model.langs)))
    raw = np.frombuffer(b"".join([START + t for t in texts]), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + len(START))
    starts = ends - sizes
    for at in range(len(START), len(raw), CHUNK):
        to = min(at + CHUNK, len(raw))
        x = raw[at - 3:to].astype(np.int32)
        state = model.three[model.two[x[1:-2] << 8 | x[2:-1]] << 8 | x[:-3]]
        bits = _byte_bits(model, state, x[3:])
        # Documents with bytes in this chunk: a sum over each one's part.
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(starts, to, "left")
        docs = np.arange(first, last)
        docs = docs[sizes[docs] > 0]
        lows, highs = np.maximum(starts[docs], at) - at, np.minimum(ends[docs], to) - at
        keep = highs > lows
        docs, lows, highs = docs[keep], lows[keep], highs[keep]
        if len(docs):
            cuts = np.stack([lows, highs], 1).ravel()
            padded = np.concatenate([bits, np.zeros((1, bits.shape[1]), bits.dtype)])
            out[docs] += np.add.reduceat(padded, cuts, axis=0, dtype=np.float64)[::2]
    return out


def predict(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and gain of each text."""
    langs, scores, gains = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if model is not None else []
    for start, end in slices(np.array([len(texts[k]) for k in known])):
        part = known[start:end]
        raw = [texts[k].encode("utf-8") for k in part]
        bits = code_lengths(model, raw)
        best = bits.argmin(1)
        share = np.exp2(-(bits - bits.min(1, keepdims=True))).sum(1)
        for row, (k, b) in enumerate(zip(part, best.tolist(), strict=True)):
            single = np.bincount(np.frombuffer(raw[row], dtype=np.uint8), minlength=256) @ model.base[:, b].astype(float)
            langs[k], scores[k], gains[k] = model.langs[b], 1.0 / share[row], 1 - bits[row, b] / single
    return langs, scores, gains


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = TRAIN_DOCS) -> LanguageModel | None:
    """Model of the rows with a language and a text; about ``sample_docs`` of each language are read."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = rows.groupBy(lang_col).count().collect()  # one row a language
    take = F.lit(0)
    for r in sizes:
        take = F.when(F.col(lang_col) == r[lang_col],
                      F.lit(min(_SAMPLE, -(-_SAMPLE * sample_docs // r["count"])))).otherwise(take)
    sample = rows.where(F.pmod(F.xxhash64(F.lit("language"), F.col(id_col)), F.lit(_SAMPLE)) < take)
    return build_model(gram_counts(sample, text_col, lang_col).toPandas())


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``gain`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, gain double")
    def scored(text: pd.Series) -> pd.DataFrame:
        found = predict(shared.value, [t if isinstance(t, str) else None for t in text])
        return pd.DataFrame(dict(zip(("lang_pred", "score", "gain"), found, strict=True)))

    own = others(docs, "lang_pred", "score", "gain")
    found = docs.select(*own, scored(docs[text_col]).alias("lang_pred"))
    return found.select(*own, "lang_pred.*")


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls on the fold that training leaves out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))
