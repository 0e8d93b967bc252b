"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text becomes a row of statistics (shares of character classes, word
and line lengths, repetition).  Training bins each statistic into quantile
histograms and grows trees of fixed depth on logistic loss; each split is the
best cut of the summed gradients and hessians per bin.  The trees are flattened
into arrays (feature, threshold, value by heap position), so scoring a batch is
a few numpy gathers a tree.

The statistics are computed by Spark tasks for the labelled sample and for all
documents.  The model is fitted on a bounded sample of the labelled rows, about
``TRAIN_ROWS`` chosen by a hash of the id; only their statistics reach the
driver.

Edge cases: null and empty texts have all statistics 0 and get a score like any
other row; a document with several label rows counts once per label row, a
document that is there twice is two rows; null labels are left out; without
labelled rows, or with one class only, every score is the (smoothed) share of
good labels; texts of any length are read whole; an empty table gives an empty
result; labels, ids and other columns are never inputs of a score; input columns
named ``score`` or ``predicted`` give way to the operator's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.llm.common import others, slices

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS = 120, 4, 64
RATE, L2, MIN_HESSIAN = 0.1, 1.0, 5.0
GOOD = 0.7
_SAMPLE = 1 << 20
#: Bytes whose classes are counted at a time.
CHUNK = 1 << 20

_CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "comma", "quote", "bracket", "mark", "bar",
            "symbol", "high", "control")
FEATURES = ("log_bytes", "log_words", "log_lines", *(f"share_{c}" for c in _CLASSES), "word_bytes", "line_bytes",
            "words_per_stop", "distinct_words", "top_word", "distinct_lines", "title_words", "longest_word",
            "same_pairs")


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("symbol"), dtype=np.uint8)
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                        ("blank", b" \t"), ("newline", b"\n\r"), ("stop", b".?"), ("mark", b"!"), ("comma", b",;:"),
                        ("quote", b"'\"`"), ("bracket", b"()[]{}<>"), ("bar", b"|"), ("high", range(128, 256)),
                        ("control", [*range(9), *range(11, 13), *range(14, 32), 127])):
        table[list(chars)] = _CLASSES.index(name)
    return table


_TABLE = _class_table()


def class_counts(texts: list[bytes]) -> np.ndarray:
    """Bytes of each class in every text."""
    k = len(_CLASSES)
    out = np.zeros((len(texts), k))
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    for at in range(0, len(raw), CHUNK):
        part = _TABLE[raw[at:at + CHUNK]]
        first = int(np.searchsorted(ends, at, "right"))
        last = int(np.searchsorted(ends, at + len(part) - 1, "right"))
        sizes = np.diff(np.clip(ends[first:last + 1], at, at + len(part)), prepend=at)
        doc = np.repeat(np.arange(last - first + 1) * k, sizes)
        out[first:last + 1] += np.bincount(doc + part, minlength=(last - first + 1) * k).reshape(-1, k)
    return out


def _word_features(text: str) -> tuple[float, ...]:
    words = text.split()
    if not words:
        return 0, 0, 0, 0, 0, 0, 0, 0
    lines = text.split("\n")
    n = len(words)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    title = sum(map(str.istitle, words))
    return (n, len(lines), len(counts) / n, max(counts.values()) / n, len(set(lines)) / len(lines), title / n,
            max(map(len, words)), 1 - pairs / (n - 1) if n > 1 else 0)


def features(texts: list[str | None]) -> np.ndarray:
    """Statistics of every whole text, in the order of ``FEATURES``."""
    parts = [_features(texts[a:b]) for a, b in slices(np.array([len(t or "") for t in texts]))]
    return np.vstack(parts) if parts else np.zeros((0, len(FEATURES)))


def _features(texts: list[str | None]) -> np.ndarray:
    raw = [(t or "").encode("utf-8") for t in texts]
    size = np.array([len(t) for t in raw], dtype=np.float64)
    counts = class_counts(raw)
    words = np.array([_word_features(t or "") for t in texts], dtype=np.float64)
    n, lines = words[:, 0], words[:, 1]
    some = np.maximum(size, 1)
    stops = counts[:, _CLASSES.index("stop")]
    return np.column_stack([
        np.log1p(size), np.log1p(n), np.log1p(lines), counts / some[:, None], size / np.maximum(n, 1),
        size / np.maximum(lines, 1), n / np.maximum(stops, 1), words[:, 2], words[:, 3], words[:, 4], words[:, 5],
        words[:, 6], words[:, 7]])


@dataclass
class BoostedTrees:
    """Trees flattened by heap position: node i has the children 2i + 1 and 2i + 2."""
    base: float
    feature: np.ndarray    # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); right if the value is larger
    value: np.ndarray      # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            raw += value[node - (len(value) - 1)]
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> BoostedTrees:
    """Boosted trees on logistic loss from histograms of ``bins`` quantile bins."""
    good = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(good / (1 - good)))
    empty = BoostedTrees(base, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1)))
    if len(y) == 0 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    width, k = bins, x.shape[1]
    offset = binned + np.arange(k) * width
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature, threshold = np.zeros((trees, inner), int), np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (k * width) + offset).ravel()
            shape = (nodes, k, width)
            g = np.bincount(at, np.repeat(grad, k), nodes * k * width).reshape(shape).cumsum(2)
            h = np.bincount(at, np.repeat(hess, k), nodes * k * width).reshape(shape).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + L2) + (gt - g) ** 2 / (ht - h + L2) - gt ** 2 / (ht + L2)
            gain[(h < MIN_HESSIAN) | (ht - h < MIN_HESSIAN)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            split = gain.reshape(nodes, -1).max(1) > 1e-9
            bf, bb = best // width, best % width
            feature[t, first:first + nodes] = np.where(split, bf, 0)
            for j in np.flatnonzero(split):
                threshold[t, first + j] = cuts[bf[j]][bb[j]]
            mine = node - first
            node = 2 * node + 1 + (split[mine] & (binned[np.arange(len(y)), bf[mine]] > bb[mine]))
        leaf = node - inner
        value[t] = -RATE * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + L2)
        raw += value[t][leaf]
    return BoostedTrees(base, feature, threshold, value)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = TRAIN_ROWS) -> BoostedTrees:
    """Model of the label rows (0 or 1); about ``sample_rows`` of them are used."""
    spark = docs.sparkSession
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    n = marked.count()
    share = min(_SAMPLE, -(-_SAMPLE * sample_rows // max(n, 1)))
    sample = marked.where(F.pmod(F.xxhash64(F.lit("quality"), F.col("_id")), F.lit(_SAMPLE)) < share)
    # The sample is bounded by its share: about sample_rows ids and labels.
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(sample), "_id"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = features(list(pdf["_text"]))
            yield pd.DataFrame({"id": pdf["_id"], "y": pdf["_y"], "x": list(x)})

    schema = T.StructType([T.StructField("id", rows.schema["_id"].dataType), T.StructField("y", T.IntegerType()),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])
    found = rows.mapInPandas(measure, schema).toPandas()
    found = found.sort_values(["id", "y"], kind="stable")  # one order, whatever the partitions
    x = np.vstack(found["x"].tolist()) if len(found) else np.zeros((0, len(FEATURES)))
    return fit(x, found["y"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: BoostedTrees, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``GOOD`` on) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(features([t if isinstance(t, str) else None for t in text])))

    out = docs.select(*others(docs, "score", "predicted"), scored(docs[text_col]).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
