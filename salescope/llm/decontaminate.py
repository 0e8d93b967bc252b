"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are three words of a test item in order, out of three or four in a row
(``SHAPES``), so that an item with every third word replaced still has two ninths
of them.  A first pass over all documents counts in how many of them each seed
occurs; the commonest seeds of an item, fewer than that share, are put aside, and
the rest (with all ties) are its rare seeds: the share is relative, so an item
copied into a third of the corpus keeps its seeds.  A second pass joins every
document's seeds to the rare ones; around each hit the document's words are
aligned to the item by Smith-Waterman (``MATCH``, ``MISMATCH``, ``GAP`` a word),
and the score is the best local alignment over that of the whole item.  Windows
that lack too many of the item's words to reach the threshold are not aligned.
Pairs that reach ``THRESHOLD`` are matches: copies, edited copies and paraphrases.

The items are a stated query set: they are sent to the tasks in blocks of at
most about ``BLOCK_BYTES``, one pair of passes a block, so the size of the
benchmark is bounded only by time.  Documents never shuffle.

Edge cases: null and empty documents and items match nothing; items of fewer
than three words are not searched for; equal items match one by one; several
rows of a document each give their rows; a document that holds an item several
times gives its best place, the first of equals; texts of any length are
searched whole; empty tables give no matches; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.llm.common import map_texts

#: Words of a seed, from its first.
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
#: Share of an item's seeds that are looked for; an item with every third word replaced keeps 2 / 9.
RARE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
BLOCK_BYTES = 16 << 20
_WORD = re.compile(r"\w+")
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass
class Items:
    """A block of items as word numbers, and where their seeds stand."""
    ids: list
    words: list[np.ndarray]
    vocab: dict[str, int]
    seeds: np.ndarray   # in order
    starts: np.ndarray  # seed -> its first place; one more at the end
    item: np.ndarray    # place -> item
    offset: np.ndarray  # place -> first word


def _codes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and 64-bit codes of the seeds that have words of items only."""
    known, x = numbers > 0, numbers.astype(np.uint64)
    at, codes = [], []
    for _, second, third in SHAPES:
        n = max(len(numbers) - third, 0)
        here = np.flatnonzero(known[:n] & known[second:second + n] & known[third:third + n])
        code = (x[here] * _ODD[0] + x[here + second]) * _ODD[1] + x[here + third]
        at.append(here)
        codes.append((code ^ code >> np.uint64(29)).view(np.int64))
    return np.concatenate(at), np.concatenate(codes)


def _seeded(ids: list, words: list, vocab: dict, code: np.ndarray, item: np.ndarray, offset: np.ndarray) -> Items:
    order = np.argsort(code, kind="stable")
    seeds, starts = np.unique(code[order], return_index=True)
    return Items(ids, words, vocab, seeds, np.append(starts, len(code)), item[order], offset[order])


def _items(rows: list) -> Items:
    vocab: dict[str, int] = {}
    ids, words, codes, items, offsets = [], [], [], [], []
    for item_id, text in rows:
        tokens = _WORD.findall((text or "").lower())
        if len(tokens) < len(SHAPES[0]):
            continue
        numbers = np.array([vocab.setdefault(w, len(vocab) + 1) for w in tokens], dtype=np.int64)
        at, code = _codes(numbers)
        codes.append(code)
        items.append(np.full(len(at), len(ids), dtype=np.int32))
        offsets.append(at.astype(np.int32))
        ids.append(item_id)
        words.append(numbers)
    code, item, offset = (np.concatenate([*x, np.zeros(0, t)])
                          for x, t in ((codes, np.int64), (items, np.int32), (offsets, np.int32)))
    return _seeded(ids, words, vocab, code, item, offset)


def _numbers(text: str, vocab: dict[str, int]) -> np.ndarray:
    get = vocab.get
    return np.array([get(w, 0) for w in _WORD.findall(text.lower())], dtype=np.int64)


def _hits(numbers: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of seeds in a document, and which."""
    at, codes = _codes(numbers)
    if not len(at) or not len(seeds):
        return at[:0], at[:0]
    k = np.searchsorted(seeds, codes)
    k[k == len(seeds)] = 0
    ok = seeds[k] == codes
    return at[ok], k[ok]


def align(words: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of ``item`` in ``words``: score, end in words, end in item (exclusive)."""
    m = len(item)
    before = np.zeros(m + 1, dtype=np.int64)
    ramp = -GAP * np.arange(m + 1)
    best = (0, 0, 0)
    for i, w in enumerate(words.tolist()):
        row = np.zeros(m + 1, dtype=np.int64)
        np.maximum(before[:-1] + np.where(item == w, MATCH, MISMATCH), before[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        # Gaps along the item: a running maximum of what each cell is worth further on.
        before = np.maximum.accumulate(row + ramp) - ramp
        top = int(before.argmax())
        if before[top] > best[0]:
            best = (int(before[top]), i + 1, top)
    return best


def best_alignment(numbers: np.ndarray, item: np.ndarray, hits: list[int],
                   threshold: float = 0.0) -> tuple[float, int, int]:
    """Score (share of a perfect one) and words [start, end) of the item's best place of ``threshold`` or more.

    ``hits`` are places in the document at which the item would start.
    """
    m = len(item)
    slack = m // 2 + 1
    found = (0.0, 0, 0)
    low = high = None
    windows = []
    for start in sorted(set(hits)):
        if high is not None and start - slack <= high:
            high = start + m + slack
            continue
        if high is not None:
            windows.append((low, high))
        low, high = start - slack, start + m + slack
    windows.append((low, high))
    for low, high in windows:
        low = max(low, 0)
        part = numbers[low:high]
        if np.isin(item, part).sum() < threshold * m:  # a match for each of these words at most
            continue
        score, end, item_end = align(part, item)
        if score / (MATCH * m) > found[0]:
            back = align(part[:end][::-1], item[:item_end][::-1])
            found = (score / (MATCH * m), low + end - back[1], low + end)
    return found


def _rare(items: Items, counts: dict[int, int]) -> Items:
    """With the rarest seeds of each item only."""
    n = np.zeros(len(items.seeds), dtype=np.int64)
    n[np.fromiter(counts, np.int64, len(counts))] = np.fromiter(counts.values(), np.int64, len(counts))
    seed = np.repeat(np.arange(len(items.seeds)), np.diff(items.starts))
    own = np.unique(np.stack([items.item.astype(np.int64), n[seed], seed]), axis=1)  # each seed of an item once
    first, size = np.unique(own[0], return_index=True, return_counts=True)[1:]
    most = np.zeros(len(items.ids), dtype=np.int64)
    most[own[0][first]] = own[1][first + np.ceil(RARE * size).astype(np.int64) - 1]
    keep = n[seed] <= most[items.item]
    return _seeded(items.ids, items.words, items.vocab, items.seeds[seed[keep]], items.item[keep], items.offset[keep])


def _matches_of(rows: DataFrame, items: Items, item_type: T.DataType, item_col: str, threshold: float) -> DataFrame:
    context = rows.sparkSession.sparkContext
    every = context.broadcast(items)

    def make_count():
        block = every.value

        def work(texts: list[str | None], _) -> dict:
            seen: dict[int, int] = defaultdict(int)
            for text in texts:
                for code in set(_hits(_numbers(text or "", block.vocab), block.seeds)[1].tolist()):
                    seen[code] += 1
            return {"seed": list(seen), "n": list(seen.values())}

        return work

    counts = (map_texts(rows, make_count, {"seed": T.LongType(), "n": T.LongType()}, with_id=False)
              .groupBy("seed").agg(F.sum("n").alias("n")).collect())  # a row for each seed of the block
    rare = context.broadcast(_rare(items, {r["seed"]: r["n"] for r in counts}))
    columns = {item_col: item_type, "score": T.DoubleType(), "start": T.LongType(), "end": T.LongType(),
               "passage": T.StringType()}

    def make_search():
        block = rare.value

        def work(texts: list[str | None], _) -> dict:
            out = []
            for row, text in enumerate(texts):
                if not text:
                    continue
                numbers = _numbers(text, block.vocab)
                at: dict[int, list[int]] = defaultdict(list)
                for place, seed in zip(*(x.tolist() for x in _hits(numbers, block.seeds)), strict=True):
                    for k in range(block.starts[seed], block.starts[seed + 1]):
                        at[int(block.item[k])].append(place - int(block.offset[k]))
                tokens = None
                for item, hits in at.items():
                    score, start, end = best_alignment(numbers, block.words[item], hits, threshold)
                    if score >= threshold:
                        tokens = tokens or list(_WORD.finditer(text.lower()))
                        a, b = tokens[start].start(), tokens[end - 1].end()
                        out.append((row, block.ids[item], score, a, b, text[a:b]))
            return dict(zip(("_row", *columns), map(list, zip(*out, strict=True)) if out else [[]] * 6, strict=True))

        return work

    return map_texts(rows, make_search, columns)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document and item that match: ids, ``score`` (to 1), code points [``start``, ``end``), ``passage``."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    queries = benchmark.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_query"))
    size = queries.agg(F.coalesce(F.sum(F.octet_length("_query") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for k in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("_item", "_query"), F.lit(blocks)) == k)
        block = _items(sorted(((r["_item"], r["_query"]) for r in part.collect()),
                              key=lambda r: (str(r[0]), r[1] or "")))
        found = _matches_of(rows, block, queries.schema["_item"].dataType, item_col, threshold)
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("_id", id_col)
