"""Substring dedup: sliding sentence spans, joined globally.

Every text is cut into sentences; a sentence of more than ``LONG`` words is cut
further after the word with the smallest hash of each ``WINDOW`` words in a row
(the last of equal ones; a single word repeated gives no cut), so that a passage
inside run-on text is cut alike wherever it stands: at most ``LONG`` words at
either end of it (``WINDOW`` within run-on text) depend on its neighbours, and
50 words hold at least ``MIN_WORDS`` words of whole pieces.  A span is a run of at least ``MIN_SENTENCES``
consecutive pieces with at least ``MIN_WORDS`` words: for each piece the
shortest such run that starts with it and the shortest that ends with it.  All
spans of all documents are hashed and joined; a sentence covered by any span
that stands in an earlier place too (a smaller document id, or further up in
the same document) is removed.

Words are hashed once: the pieces' hashes and lengths are stored, and spans are
made from them.  Only spans that may be repeated are shuffled with their places.
A first pass counts filter positions of all spans; the bits set at least twice
form a bitmap of a bounded size (``MAX_BITS``; a fuller bitmap only lets more
spans through), which the second pass tests before it emits a span.

Edge cases: null and empty texts, and those with fewer than two pieces or
``MIN_WORDS`` words, stay as they are (null becomes empty); a document is a pair
of id and text: rows of one id with other texts (null ids too) are judged each on
its own text, and rows equal in both are one document, none of them the copy of
another; ties do not arise, places are ordered by (id, digest of the text,
piece), null ids first; white space before a removed
sentence's successor goes with it; texts of any length are read whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.llm.common import map_texts, stored

MIN_SENTENCES, MIN_WORDS = 2, 20
#: Words of a sentence that stays whole, and most words of a piece of a longer one.
LONG, WINDOW = 15, 6
#: Bytes that are stored of a piece's hash; a span has two pieces at least.
HASH_BYTES = 5
#: Bytes of hashes that a task works on at a time; its arrays take about a hundred times as much.
HASH_SLICE = 1 << 18
#: More than the pieces of a span.
PLACE = 64
BITMAP_BITS = 32768
#: At most 2**29 bits (64 MB) are broadcast.
MAX_BITS = 1 << 29
_ENDS = (".", "!", "?")
_TOKEN = re.compile(r"\S+")
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


class Words(dict):
    """Hash of a word, its lowest bit set where a sentence ends with it; remembers a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.lower()) & ~1 | word.endswith(_ENDS)
        return h


_WORDS = Words()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_INVERSE ** k`` and ``_BASE ** k`` for k up to ``n``."""
    down, up = np.full((2, n + 1), [[_INVERSE], [_BASE]], dtype=np.uint64)
    down[0] = up[0] = 1
    return np.cumprod(down), np.cumprod(up)


_KNOWN = _powers(1 << 15)


def runs(hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of ``hashes``: the sum of h[k] * BASE**(k - first), mixed."""
    n = len(hashes)
    down, up = _KNOWN if n < len(_KNOWN[0]) else _powers(n)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * down[:n])])
    h = (total[end] - total[first]) * up[first]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def cuts(ranks: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Whether a cut comes after each word: the last smallest rank of a window inside one sentence."""
    n = len(ranks) - WINDOW + 1
    at = np.arange(n)
    low, high, best = ranks[:n].copy(), ranks[:n].copy(), at.copy()
    for k in range(1, WINDOW):
        new = ranks[k:k + n]
        best = np.where(new <= low, at + k, best)
        np.minimum(low, new, out=low)
        np.maximum(high, new, out=high)
    cut = np.zeros(len(ranks), dtype=bool)
    cut[best[(sentence[:n] == sentence[WINDOW - 1:]) & (low < high)]] = True
    return cut


def pieces(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start offset, words and 64-bit hash of each piece of ``text``."""
    words, hashes = hashed_pieces(text)
    at = np.array([m.start() for m in _TOKEN.finditer(text)], dtype=np.int64)
    return at[np.cumsum(words) - words], words, hashes


def hashed_pieces(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Words and 64-bit hash of each piece of ``text``."""
    known, found, lines = _WORDS.__getitem__, [], []
    for line in text.split("\n"):
        found.extend(map(known, line.split()))
        lines.append(len(found))
    word = np.array(found, dtype=np.uint64)
    n = len(word)
    if not n:
        return np.zeros(0, dtype=np.int64), word
    stop = (word & np.uint64(1)).astype(bool)
    stop[np.array(lines)[np.array(lines) > 0] - 1] = True
    ends = np.flatnonzero(stop) + 1
    sizes = np.diff(ends, prepend=0)
    long = sizes > LONG
    if long.any():
        sentence = np.repeat(np.arange(len(sizes)), sizes)
        stop |= cuts((word >> np.uint64(34)).astype(np.int64), sentence) & long[sentence]
        ends = np.flatnonzero(stop) + 1
    first = np.concatenate([[0], ends[:-1]])
    return ends - first, runs(word, first, ends)


def spans(words: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First piece, end (exclusive) and hash of every span."""
    n = len(words)
    none = np.zeros(0, dtype=np.int64)
    if n < MIN_SENTENCES:
        return none, none, none
    upto = np.concatenate([[0], np.cumsum(words)])
    i = np.arange(n)
    ends = np.maximum(np.searchsorted(upto, upto[:-1] + MIN_WORDS, "left"), i + MIN_SENTENCES)
    ahead = ends <= n
    j = np.arange(1, n + 1)
    starts = np.minimum(np.searchsorted(upto, upto[1:] - MIN_WORDS, "right") - 1, j - MIN_SENTENCES)
    back = starts >= 0
    pair = np.unique(np.concatenate([i[ahead] * (n + 1) + ends[ahead], starts[back] * (n + 1) + j[back]]))
    first, end = pair // (n + 1), pair % (n + 1)
    return first, end, runs(hashes, first, end).view(np.int64)


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    return (h.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)


def stored_pieces(rows: DataFrame) -> DataFrame:
    """(``_id``, ``_digest``, ``_text``, ``words``): the hashes (as ``_text``) and the words of the pieces of each row, as bytes.

    ``_id`` is (id, mark): the mark tells the rows of one id apart by the digest
    of their text, and is 0 where an id has one row, as spans carry it along.
    """
    def make():
        def work(texts: list[str], _) -> dict:
            found = [hashed_pieces(t) for t in texts]
            # More words than a span needs are as good as 255.
            return {"_text": [h.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes() for _, h in found],
                    "words": [np.minimum(w, 255).astype(np.uint8).tobytes() for w, _ in found]}

        return work

    pieces = stored(map_texts(rows, make, {"_text": T.BinaryType(), "words": T.BinaryType()}), "pieces")
    again = stored(pieces.groupBy(F.col("_id.id").alias("_again")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"),
                   "repeated-ids")
    mark = F.lit(0).cast("long")
    if not again.isEmpty():  # mostly no id is repeated, and there is nothing to join
        pieces = pieces.join(again, F.col("_id.id").eqNullSafe(F.col("_again")), "left")
        mark = F.when(F.col("_n").isNotNull(), F.col("_id.digest")).otherwise(mark)
    return (pieces
            .select(F.struct("_id.id", mark.alias("mark")).alias("_id"), F.col("_id.digest").alias("_digest"), "_text", "words"))


def _spans_of(hashes: bytes, words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = np.zeros((len(words), 8), dtype=np.uint8)
    whole[:, :HASH_BYTES] = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, HASH_BYTES)
    return spans(np.frombuffer(words, dtype=np.uint8).astype(np.int64), whole.view(np.uint64).ravel())


def _repeated_bits(pieces: DataFrame, bits: int) -> Broadcast:
    """Pass one: the filter positions that at least two spans set, as one bitmap."""
    def make():
        def work(hashes: list[bytes], part) -> dict:
            found = [_positions(_spans_of(h, w)[2], bits) for h, w in zip(hashes, part.column("words").to_pylist(), strict=True)]
            at, n = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *found]), return_counts=True)
            return {"p": at, "n": np.minimum(n, 2)}

        return work

    bitmaps = (map_texts(pieces, make, {"p": T.LongType(), "n": T.IntegerType()}, with_id=False, most=HASH_SLICE)
               .groupBy("p").agg(F.sum("n").alias("n")).where("n > 1")
               .groupBy(F.expr(f"p div {BITMAP_BITS}").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.col("p") % BITMAP_BITS).alias("bits")))
    bitmap = np.zeros((bits // BITMAP_BITS, BITMAP_BITS // 8), dtype=np.uint8)
    for r in bitmaps.toLocalIterator():  # bits / 8 bytes in all
        bitmap[r["bucket"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return pieces.sparkSession.sparkContext.broadcast(bitmap.ravel())


def repeated_spans(pieces: DataFrame, size: int) -> DataFrame:
    """(``_id``, ``place``) of every span that stands in an earlier place too, for texts of ``size`` bytes in all.

    A place is the first piece and the number of pieces (at most ``MIN_WORDS``), as one number.
    """
    bits = BITMAP_BITS
    while bits < min(MAX_BITS, size // 2):
        bits *= 2
    shared = _repeated_bits(pieces, bits)

    def make():
        bitmap = shared.value

        def work(hashes: list[bytes], part) -> dict:
            none = np.zeros(0, dtype=np.int64)
            out = [(none, none, none)]
            for k, (of, words) in enumerate(zip(hashes, part.column("words").to_pylist(), strict=True)):
                first, end, h = _spans_of(of, words)
                p = _positions(h, bits)
                maybe = (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0
                out.append((np.full(int(maybe.sum()), k), h[maybe], (first * PLACE + end - first)[maybe]))
            return dict(zip(("_row", "h", "place"), map(np.concatenate, zip(*out, strict=True)), strict=True))

        return work

    maybe = stored(map_texts(pieces, make, dict.fromkeys(("h", "place"), T.LongType()), most=HASH_SLICE), "spans")
    # Written, so that a span of a third of all documents is split by the skew rule.
    groups = stored(maybe.groupBy("h").agg(F.min(F.struct("_id", "place")).alias("_origin"),
                                           F.count(F.lit(1)).alias("_n"))
                    .where("_n > 1").drop("_n"), "span-groups")
    return (maybe.join(groups, "h")
            .where(~F.struct("_id", "place").eqNullSafe(F.col("_origin")))
            .select("_id", "place"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``text`` without repeated sentences, ``n_removed``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest")).alias("_id"), text.alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    pieces = stored_pieces(rows)
    removed = repeated_spans(pieces, size).groupBy("_id").agg(F.collect_set("place").alias("_spans"))
    # From the mark back to the digest, which every row has.
    ids = pieces.select(F.col("_id").alias("_of"), "_digest").distinct()
    removed = (removed.join(ids, F.col("_id").eqNullSafe(F.col("_of")))
               .select(F.struct("_id.id", F.col("_digest").alias("digest")).alias("_of"), "_spans"))
    both = rows.join(removed, F.col("_id").eqNullSafe(F.col("_of")), "left").select("_id", "_text", "_spans")

    def make():
        def work(texts: list[str], part) -> dict:
            out = [_cut(t, s) for t, s in zip(texts, part.column("_spans").to_pylist(), strict=True)]
            return {"text": [o[0] for o in out], "n_removed": [o[1] for o in out]}

        return work

    return (map_texts(both, make, {"text": T.StringType(), "n_removed": T.LongType()})
            .select(F.col("_id.id").alias(id_col), "text", "n_removed"))


def _cut(text: str, found) -> tuple[str, int]:
    if found is None or not len(found):
        return text, 0
    starts, _, _ = pieces(text)
    drop = np.zeros(len(starts) + 1, dtype=np.int64)
    for place in found:
        first, n = divmod(place, PLACE)
        drop[first] += 1
        drop[first + n] -= 1
    drop = np.cumsum(drop)[:-1] > 0
    edges = [0, *starts[1:], len(text)]  # what comes before the first piece is its own
    kept = [text[a:b] for a, b, d in zip(edges, edges[1:], drop, strict=False) if not d]
    return "".join(kept), int(drop.sum())
