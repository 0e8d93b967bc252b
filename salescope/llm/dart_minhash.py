"""MinHash near-dedup with DartMinHash signatures.

A document is the weighted set of its five-word shingles, weighted by how often
each occurs; two documents are linked if their weighted Jaccard similarity is
at least ``SIMILARITY``, and a class is a connected component of links.

**Signatures.**  Darts are thrown at the plane weight x rank of every shingle:
the plane is cut into regions, and a hash of shingle and region says how many
darts (Poisson, by the region's area) hit it, and where.  A dart counts for a
document if its weight lies below the shingle's weight there.  Every dart
belongs to one of ``COORDINATES`` coordinates; the signature holds, for each,
the dart of lowest rank.  Ranks are looked at in bands, each twice as wide as the
one before, until every coordinate has been hit: about ``k ln k`` darts a
document, whatever its length.  Two documents agree in a coordinate with a probability
equal to their weighted Jaccard similarity.

**Links.**  Equal texts are one node.  Signatures are cut into ``BANDS`` bands
of ``ROWS`` coordinates; nodes that share a band meet in a bucket, and buckets
that share a node form a group.  No bucket is expanded into its pairs: a group
is cut into blocks of ``BLOCK_BYTES``, a task takes two blocks, and compares
only nodes that share a band, whose signatures may reach the similarity and
that are not yet connected in the task; it verifies them by the exact
similarity of their shingles and emits the links that connect, at most one a
node.  So every two nodes that share a band are connected, or have been
compared.  Components are found by label propagation with jumps.

Edge cases: null texts and texts without a word are equal to each other; a text
of fewer than five words is one shingle of what it has; texts are compared by
their words, in lower case; repeated rows are copies of each other; very long
texts are read whole; the class id is the smallest document id of the class (a
null id comes after all others); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.llm.common import map_texts, stored

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Standard deviations of the signature's estimate under the threshold from which a pair is verified.
DEVIATIONS = 4
#: Lowest rank band: [0, 2 ** LOWEST).
LOWEST = -6
#: Signatures and shingles of a block of a group.
BLOCK_BYTES = 2 << 20
#: Nodes that are broadcast to find their sketches; more are joined by a shuffle.
MAX_BROADCAST = 1_000_000
#: Keys a task remembers to sketch equal texts once.
SEEN = 500_000
#: Shingles whose darts are thrown at a time.
CHUNK = 1 << 16
_WORD = re.compile(r"\w+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


class Words(dict):
    """Word -> 64-bit hash, for as many words as a worker likes to remember."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(text: str | None, words: Words) -> np.ndarray:
    found = _WORD.findall((text or "").lower())
    return np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))


def shingles(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (sorted) and how often each occurs."""
    n = max(1, len(hashes) - SHINGLE + 1) if len(hashes) else 0
    h = np.full(n, len(hashes[:SHINGLE]), dtype=np.uint64)
    for k in range(min(SHINGLE, len(hashes))):
        h = _mix(h * _GOLDEN + hashes[k:k + n])
    return np.unique(h, return_counts=True)


def _region(element: np.ndarray, weight_band: int, rank_band: int, cell: np.ndarray) -> np.ndarray:
    name = ((weight_band + 1) << 40 | (rank_band + 64)) * int(_GOLDEN) % (1 << 64)
    return _mix(_mix(element + np.uint64(name)) + cell.astype(np.uint64) * _GOLDEN)


def _throw(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, rank_band: int):
    """Darts of one rank band: document, coordinate, rank and dart id of each."""
    low, high = (0.0, 2.0 ** LOWEST) if rank_band == LOWEST else (2.0 ** (rank_band - 1), 2.0 ** rank_band)
    out = []
    weight_band = 0
    while len(element):
        base, width = 2.0 ** weight_band - 1, 2.0 ** weight_band
        area = width * (high - low)
        cells = max(1, int(area))  # cells of area 1 along the rank, if it is larger
        step, mean = (high - low) / cells, area / cells
        limits = np.cumsum([np.exp(-mean) * mean ** k / float(np.prod(np.arange(1, k + 1))) for k in range(16)])
        which = np.arange(len(element)) if cells == 1 else np.repeat(np.arange(len(element)), cells)
        cell = np.zeros(len(which), dtype=np.int64) if cells == 1 else np.tile(np.arange(cells), len(element))
        seed = _region(element[which], weight_band, rank_band, cell)
        u = _unit(seed)
        hit = np.flatnonzero(u >= limits[0])
        if len(hit):
            darts = np.searchsorted(limits, u[hit], "right")
            hit = np.repeat(hit, darts)
            number = np.arange(len(hit)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = _mix(seed[hit] + (number + 1).astype(np.uint64) * _GOLDEN)
            at = base + width * _unit(_mix(dart + np.uint64(1)))
            keep = at < weight[which[hit]]
            hit, dart = hit[keep], dart[keep]
            rank = low + step * (cell[hit] + _unit(_mix(dart + np.uint64(2))))
            coordinate = (_mix(dart + np.uint64(3)) % np.uint64(COORDINATES)).astype(np.int64)
            out.append((doc[which[hit]], coordinate, rank, dart))
        weight_band += 1
        more = weight > 2.0 ** weight_band - 1
        element, weight, doc = element[more], weight[more], doc[more]
    return out


def signatures(docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Signature (32 bits a coordinate) of every (shingles, weights) with at least one shingle."""
    n, k = len(docs), COORDINATES
    element = np.concatenate([e for e, _ in docs])
    weight = np.concatenate([w for _, w in docs]).astype(np.float64)
    doc = np.repeat(np.arange(n), [len(e) for e, _ in docs])
    best_rank, best = np.full(n * k, np.inf), np.zeros(n * k, dtype=np.uint64)
    band, open_docs = LOWEST, np.ones(n, dtype=bool)
    while open_docs.any():
        mine = open_docs[doc]
        for d, coordinate, rank, dart in _throw(element[mine], weight[mine], doc[mine], band):
            at = d * k + coordinate
            order = np.lexsort((rank, at))
            at, rank, dart = at[order], rank[order], dart[order]
            first = np.ones(len(at), dtype=bool)
            first[1:] = at[1:] != at[:-1]
            at, rank, dart = at[first], rank[first], dart[first]
            better = rank < best_rank[at]
            best_rank[at[better]], best[at[better]] = rank[better], dart[better]
        # All ranks of the bands so far were looked at, so a coordinate that was hit has its earliest dart.
        open_docs &= ~np.isfinite(best_rank).reshape(n, k).all(1)
        band += 1
    return (best >> np.uint64(32)).astype(np.uint32).reshape(n, k)


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``_id``, ``_key``, ``_sig``, ``_set``): the key names the words; a task sketches a key it remembers once."""
    def make():
        words, seen = Words(), set()

        def work(texts: list[str | None], part) -> dict:
            keys, sigs, sets = [], [None] * len(texts), [None] * len(texts)
            held: list[tuple[int, tuple]] = []
            size, named = 0, part.column("_id").is_valid().to_pylist()

            def flush() -> None:
                if held:
                    for (row, _), sig in zip(held, signatures([d for _, d in held]), strict=True):
                        sigs[row] = sig.tobytes()
                    held.clear()

            for row, text in enumerate(texts):
                hashes = word_hashes(text, words)
                key = xxhash.xxh3_128_digest(hashes.tobytes())
                keys.append(key)
                if named[row] and len(hashes) and key not in seen:
                    if len(seen) < SEEN:
                        seen.add(key)
                    element, count = shingles(hashes)
                    # As a plain set: the k-th occurrence of a shingle is an element of its own.
                    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    own = _mix(np.repeat(element, count) + number.astype(np.uint64) * _GOLDEN)
                    sets[row] = np.sort((own >> np.uint64(32)).astype(np.uint32)).tobytes()
                    held.append((row, (element, count)))
                    size += len(element)
                    if size >= CHUNK:
                        flush()
                        size = 0
            flush()
            return {"_key": keys, "_sig": sigs, "_set": sets}

        return work

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return map_texts(rows, make, dict.fromkeys(("_key", "_sig", "_set"), T.BinaryType()))


def _band_keys(sketches: DataFrame) -> DataFrame:
    """(``_band``, ``_node``) of every band of every node."""
    width = 4 * ROWS
    bands = F.array(*(F.xxhash64(F.lit(b), F.substring("_sig", b * width + 1, width)) for b in range(BANDS)))
    return sketches.select(F.explode(bands).alias("_band"), "_node")


def components(links: DataFrame) -> DataFrame:
    """(``_node``, ``_class``) of every node with a link: the smallest node it is connected to."""
    both = stored(links.select("_a", "_b").unionByName(links.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
                  .where("_a <> _b").distinct(), "links")
    labels = stored(both.groupBy(F.col("_a").alias("_node"))
                    .agg(F.min("_b").alias("_l")).select("_node", F.least("_node", "_l").alias("_class")), "labels")
    while True:
        near = (both.join(labels.select(F.col("_node").alias("_b"), "_class"), "_b")
                .groupBy(F.col("_a").alias("_node")).agg(F.min("_class").alias("_near")))
        lower = stored(labels.join(near, "_node")
                       .select("_node", F.least("_class", "_near").alias("_low"),
                               F.col("_class").alias("_old")), "labels-lower")
        jump = lower.select(F.col("_node").alias("_low"), F.col("_low").alias("_next"))
        after = stored(lower.join(jump, "_low")
                       .select("_node", F.least("_low", "_next").alias("_class"), "_old"), "labels")
        if after.where("_class <> _old").isEmpty():
            return after.select("_node", "_class")
        labels = after.select("_node", "_class")


class _Classes:
    """Union-find over positions, as an array of class numbers."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: int, b: int) -> None:
        self.of[self.of == self.of[b]] = self.of[a]


def _linked(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= similarity * (len(a) + len(b) - shared)


def _compare(similarity: float):
    least = similarity - DEVIATIONS * (similarity * (1 - similarity) / COORDINATES) ** 0.5

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links that connect the nodes of two blocks (or of one)."""
        sig = np.vstack([np.frombuffer(s, dtype=np.uint32) for s in pdf["_sig"]])
        sets = [np.frombuffer(s, dtype=np.uint32) for s in pdf["_set"]]
        size = np.array([len(s) for s in sets])
        block, node = pdf["_block"].to_numpy(), pdf["_node"].to_numpy()
        left = np.flatnonzero(block == pdf["_p"].iloc[0])
        right = np.flatnonzero(block == pdf["_q"].iloc[0])
        same_block = pdf["_p"].iloc[0] == pdf["_q"].iloc[0]
        classes, links = _Classes(len(pdf)), []
        for i in left:
            rest = right[right > i] if same_block else right
            rest = rest[(classes.of[rest] != classes.of[i])
                        & (np.minimum(size[rest], size[i]) >= similarity * np.maximum(size[rest], size[i]))]
            if not len(rest):
                continue
            same = sig[rest] == sig[i]
            share = same.mean(1)
            good = np.flatnonzero((share >= least) & same.reshape(-1, BANDS, ROWS).all(2).any(1))
            for j in rest[good[np.argsort(-share[good], kind="stable")]]:
                if classes.of[i] != classes.of[j] and _linked(sets[i], sets[j], similarity):
                    classes.join(i, j)
                    links.append((node[i], node[j]))
        return pd.DataFrame(links, columns=["_a", "_b"])

    return compare


def _links(sketches: DataFrame, similarity: float) -> DataFrame:
    """Verified links that connect every class."""
    bands = _band_keys(sketches)
    first = stored(bands.groupBy("_band").agg(F.min("_node").alias("_b"), F.max("_node").alias("_top"))
                   .where("_b <> _top").drop("_top"), "buckets")
    met = bands.join(first, "_band").select(F.col("_node").alias("_a"), "_b").where("_a <> _b").distinct()
    groups = components(met).withColumnRenamed("_class", "_group")
    few = F.broadcast(groups) if groups.count() <= MAX_BROADCAST else groups
    members = stored(sketches.join(few, "_node"), "group-members")
    weight = F.octet_length("_sig") + F.octet_length("_set")
    blocks = (members.groupBy("_group").agg(F.ceil(F.sum(weight) / BLOCK_BYTES).cast("int").alias("_blocks")))
    # Written, so that a group with very many members is split by the skew rule.
    sized = members.join(stored(blocks, "group-blocks"), "_group")
    placed = (sized.withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks").cast("long")).cast("int"))
              .select("_group", "_node", "_sig", "_set", "_block",
                      F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
              .select("_group", F.least("_block", "_other").alias("_p"), F.greatest("_block", "_other").alias("_q"),
                      "_node", "_sig", "_set", "_block"))
    node = sketches.schema["_node"].dataType
    schema = T.StructType([T.StructField("_a", node), T.StructField("_b", node)])
    return stored(placed.groupBy("_group", "_p", "_q").applyInPandas(_compare(similarity), schema), "near-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: id, ``class_id``, ``copy_of`` (smallest id of equal words), ``kept``.

    ``kept`` marks the document whose id is the class id.
    """
    sketches = stored(sketch(docs, id_col, text_col), "sketches")
    # Equal words are one node, named by the smallest id.
    keys = stored(sketches.groupBy("_key").agg(F.min("_id").alias("_rep")), "keys")
    named = stored(sketches.select("_id", "_key").join(keys, "_key").select("_id", "_rep"), "copies")
    nodes = sketches.where(F.col("_sig").isNotNull() & F.col("_id").isNotNull()) \
        .select(F.col("_id").alias("_node"), "_sig", "_set")
    # A row repeated with one id may be sketched by two tasks; that makes it a bucket member twice, no more.
    links = _links(nodes, similarity)
    rep = named.select("_id", "_rep").distinct()
    by_rep = (links.join(rep.select(F.col("_id").alias("_a"), F.col("_rep").alias("_ra")), "_a")
              .join(rep.select(F.col("_id").alias("_b"), F.col("_rep").alias("_rb")), "_b")
              .select(F.col("_ra").alias("_a"), F.col("_rb").alias("_b")).distinct())
    classes = components(by_rep)
    return (named.join(classes.withColumnRenamed("_node", "_rep"), "_rep", "left")
            .select(F.col("_id").alias(id_col), F.coalesce("_class", "_rep").alias("class_id"),
                    F.col("_rep").alias("copy_of"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("class_id"))))
