"""Histogram gradient boosting with trees grown leaf by leaf.

The training rows are cut into blocks: each feature becomes its quantile bin and
the target a whole number, so that a pass over them is cheap.  Features of few
bins share a two-byte code (``Packing``): sums by code give those by bin.  One
pass adds up, for every open leaf, feature and bin, the residuals and the rows;
only these sums (leaves x features x bins) leave the executors.  The driver
splits the leaf of the largest gain first, up to ``leaves``; as the gain of a
leaf depends on its own rows only, one pass fetches the sums below all leaves
that may still be split, so a tree takes as many passes as it is deep.  Of a leaf
of at most ``GATHER`` rows the rows themselves are fetched, and the tree below it
is grown from them in the same way without further passes.

Residuals are summed as integers (``SCALE``), which makes the sums exact: the
model does not depend on how the rows are partitioned, and the sums of all rows
behind a tree, with their loss, follow from those of its leaves without a pass.
Losses are squared errors.  All training rows are used; boosting ends after
``rounds``, or when ``patience`` rounds in a row have not lowered the loss by
``tol`` (relative).

The blocks with their residuals are kept in memory and on disk as an RDD, the
one place where passes of arrays over arrays need it (a pass as a DataFrame
query takes five times as long to plan as to run); every ``CUT`` rounds they are
checkpointed in the shared folder, so a lost executor costs a few rounds over
its blocks.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Callable, Container, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators.ranks import cumulative_counts
from salescope.session import written

SCALE = float(1 << 24)
#: Rows of training data that make it worth another task, until all cores have one.
ROWS_PER_TASK = 100_000
#: Rows that a task has at most where there are more of them than cores.
MOST_ROWS = 4_000_000
#: Rows of a leaf that are brought together; all leaves of a tree hold at most ``leaves`` times as many.
GATHER = 1 << 16
#: Rows of a block, about.
BLOCK_ROWS = 1 << 14
#: Values of the code that features of few bins share.
CODES = 1 << 12
#: Partitions whose sums the driver adds up itself.
DIRECT = 32
#: Rounds between two checkpoints of the residuals.
CUT = 30
_BLOCK = "rows int, codes binary, resid binary"


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1 and a value."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)      # the last bin that goes left
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for part, x in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.value, value)):
            part.append(x)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, left: int, right: int) -> None:
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, left, right


@dataclass
class BoostedTrees:
    """``features``, the upper ``bounds`` of each one's bins, the mean target ``base``, and the trees."""

    features: list[str]
    bounds: list[np.ndarray]
    base: float
    trees: list[Tree]
    losses: list[float]


def leaf_of(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """Leaf of each column of ``bins`` (features x rows): all rows go a level down at a time, those at a leaf drop out."""
    feature, cut, left, right = (np.array(x, dtype=np.int64) for x in (tree.feature, tree.cut, tree.left, tree.right))
    node = np.zeros(bins.shape[1], dtype=np.int64)
    rows = np.arange(bins.shape[1] if feature[0] >= 0 else 0)
    while len(rows):
        at = node[rows]
        node[rows] = at = np.where(bins[feature[at], rows] <= cut[at], left[at], right[at])
        rows = rows[feature[at] >= 0]
    return node


def binned(bounds: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: the number of bounds below it (values beyond the last bound share the last bin)."""
    return np.stack([np.minimum(np.searchsorted(b, c, "left"), max(len(b) - 1, 0)).astype(np.uint8)
                     for b, c in zip(bounds, columns, strict=True)])


def bin_bounds(train: DataFrame, features: Sequence[str], bins: int = 255) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature: all values where there are at most ``bins``, else equal shares of the rows."""
    stack = ", ".join(f"{k}, CAST(`{c}` AS DOUBLE)" for k, c in enumerate(features))
    long = train.selectExpr(f"stack({len(features)}, {stack}) AS (feature, value)").where("value IS NOT NULL AND NOT isnan(value)")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    counts = written(cumulative_counts(counts, "value", ["feature"]), "feature-values")
    distinct = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("values"))
    full = F.expr(f"((cum_lo + cnt) * {bins}) div n > (cum_lo * {bins}) div n")
    found = (counts.join(F.broadcast(distinct), "feature").where((F.col("values") <= bins) | full)
             .select("feature", "value").toPandas())  # at most bins + 1 values a feature
    return [np.sort(found.value[found.feature == k].to_numpy(dtype=np.float64)) for k in range(len(features))]


class Packing:
    """Features, of ``sizes`` bins each, as columns of codes: features whose sizes multiply to at most ``CODES`` share one."""

    def __init__(self, sizes: Sequence[int]) -> None:
        self.sizes, self.groups, self.values = list(sizes), [], []
        for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
            c = next((c for c, n in enumerate(self.values) if n * sizes[j] <= CODES), len(self.values))
            if c == len(self.values):
                self.groups.append([])
                self.values.append(1)
            self.groups[c].append(j)
            self.values[c] *= sizes[j]
        self.column = {j: c for c, group in enumerate(self.groups) for j in group}

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """Codes (columns x rows) of ``bins`` (features x rows)."""
        out = np.zeros((len(self.groups), bins.shape[1]), dtype=np.uint16)
        for c, group in enumerate(self.groups):
            for j in group:
                out[c] = out[c] * np.uint16(self.sizes[j]) + bins[j]
        return out

    def bins(self, feature: int) -> np.ndarray:
        """Bin of ``feature`` for each code of its column."""
        group = self.groups[c := self.column[feature]]
        behind = int(np.prod([self.sizes[j] for j in group[group.index(feature) + 1:]], dtype=np.int64))
        return np.arange(self.values[c]) // behind % self.sizes[feature]

    def sums(self, by_code: list[np.ndarray]) -> np.ndarray:
        """Sums by bin, feature after feature, of sums by code for each column."""
        out: list[np.ndarray] = [None] * len(self.sizes)
        for group, sums in zip(self.groups, by_code, strict=True):
            cube = sums.reshape([self.sizes[j] for j in group])
            for at, j in enumerate(group):
                out[j] = cube.sum(axis=tuple(i for i in range(len(group)) if i != at))
        return np.concatenate(out)

    def table(self, sums: np.ndarray) -> np.ndarray:
        """The same as features x bins, zero beyond a feature's last bin."""
        out = np.zeros((len(self.sizes), max(self.sizes)))
        out[np.arange(max(self.sizes)) < np.array(self.sizes)[:, None]] = sums
        return out

    def counted(self, codes: np.ndarray, resid: np.ndarray, rows: np.ndarray | None = None) -> tuple[list, list]:
        """Sums of the residuals, and the rows, by code for each column; of ``rows`` (default: all)."""
        whole = (resid if rows is None else resid[rows]).astype(np.float64)
        g, n = [], []
        for column, values in zip(codes, self.values, strict=True):
            code = (column if rows is None else column[rows]).astype(np.intp)
            g.append(np.bincount(code, whole, values))
            n.append(np.bincount(code, minlength=values))
        return g, n


def _narrow(resid: np.ndarray) -> np.ndarray:
    """The residuals in four bytes each, if they fit."""
    small = np.iinfo(np.int32)
    return resid.astype(np.int32) if not len(resid) or (resid.min() >= small.min and resid.max() <= small.max) else resid


def _blocks(train: DataFrame, features: Sequence[str], target: Column, bounds: list[np.ndarray], base: float,
            packing: Packing) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, resid, held = [], [], 0
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]
            codes.append(packing.codes(binned(bounds, columns[:-1])))
            resid.append(np.rint((columns[-1] - base) * SCALE).astype(np.int64))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield packed(codes, resid, held)
                codes, resid, held = [], [], 0
        if held:
            yield packed(codes, resid, held)

    def packed(codes: list, resid: list, rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([rows], pa.int32()), pa.array([np.concatenate(codes, axis=1).tobytes()], pa.binary()),
            pa.array([np.concatenate(resid).tobytes()], pa.binary())], names=["rows", "codes", "resid"])

    rows = train.select(*(F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)), target.alias("y"))
    return rows.mapInArrow(run, _BLOCK)


def _unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["codes"], dtype=np.uint16).reshape(-1, row["rows"]), _narrow(np.frombuffer(row["resid"], dtype=np.int64))


def _rows_at(tree: Tree, nodes: Sequence[int], packing: Packing) -> Callable[[np.ndarray], Iterator[tuple]]:
    """Function that gives, of a block's codes, each of the ``nodes`` with its rows (None: all)."""
    above = {child: node for node, feature in enumerate(tree.feature) if feature >= 0 for child in (tree.left[node], tree.right[node])}
    wanted, leads = set(nodes), set()
    for node in nodes:
        while node not in leads:
            leads.add(node)
            node = above.get(node, node)
    down = {node: (packing.column[tree.feature[node]], packing.bins(tree.feature[node]) <= tree.cut[node]) for node in leads - wanted}

    def parts(codes: np.ndarray) -> Iterator[tuple]:
        open_ = [(0, None)] if leads else []
        while open_:
            node, rows = open_.pop()
            if node in wanted:
                yield node, rows
                continue
            column, goes = down[node]
            left = goes[codes[column] if rows is None else codes[column][rows]]
            for child, side in ((tree.left[node], left), (tree.right[node], ~left)):
                if child in leads:
                    open_.append((child, np.flatnonzero(side) if rows is None else rows[side]))

    return parts


def _steps(tree: Tree) -> np.ndarray:
    """What the tree's nodes take off the residuals."""
    return np.rint(np.array(tree.value) * SCALE).astype(np.int64)


def _stepped(blocks: RDD, tree: Tree, packing: Packing) -> RDD:
    """The blocks with the tree's values taken off the residuals."""
    steps, leaves = _steps(tree), [node for node, feature in enumerate(tree.feature) if feature < 0]

    def run(part: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rows_at = _rows_at(tree, leaves, packing)
        for codes, resid in part:
            resid = resid.astype(np.int64)
            for node, rows in rows_at(codes):
                resid[slice(None) if rows is None else rows] -= steps[node]
            yield codes, _narrow(resid)

    return blocks.mapPartitions(run)


def _squares(blocks: RDD) -> int:
    """Sum of all squared residuals, exact."""
    return blocks.map(lambda block: sum(int(r) ** 2 for r in block[1].tolist())).sum()


@dataclass
class Leaf:
    """What is known of a leaf: residual sums and rows by (feature, bin) and, of a small one, its rows themselves."""

    g: np.ndarray
    n: np.ndarray
    codes: np.ndarray | None = None
    resid: np.ndarray | None = None

    @staticmethod
    def of_sums(packing: Packing, g: np.ndarray, n: np.ndarray, *rows: np.ndarray) -> Leaf:
        return Leaf(packing.table(g) / SCALE, packing.table(n), *rows)

    @staticmethod
    def of_rows(packing: Packing, codes: np.ndarray, resid: np.ndarray) -> Leaf:
        return Leaf.of_sums(packing, *map(packing.sums, packing.counted(codes, resid)), codes, resid)

    def children(self, packing: Packing, feature: int, cut: int) -> tuple[Leaf, Leaf]:
        """Both sides of a split; of the larger one the sums are what the smaller one leaves."""
        down = (packing.bins(feature) <= cut)[self.codes[packing.column[feature]]]
        sides = [(self.codes[:, side], self.resid[side]) for side in (down, ~down)]
        less = int(len(sides[1][1]) < len(sides[0][1]))
        out: list[Leaf] = [None, None]
        out[less] = Leaf.of_rows(packing, *sides[less])
        out[1 - less] = Leaf(self.g - out[less].g, self.n - out[less].n, *sides[1 - less])
        return out[0], out[1]


def _fetched(blocks: RDD, tree: Tree, wanted: list[int], small: list[int], packing: Packing) -> dict[int, Leaf]:
    """Sums of the ``wanted`` leaves and rows of the ``small`` ones."""
    def sums(part: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple]:
        rows_at, few = _rows_at(tree, [*wanted, *small], packing), set(small)
        found = {node: [[np.zeros(v) for v in packing.values] for _ in range(2)] for node in wanted}
        kept = {node: [] for node in small}
        for codes, resid in part:
            for node, rows in rows_at(codes):
                if node in few:
                    kept[node].append((codes, resid) if rows is None else (codes[:, rows], resid[rows]))
                else:
                    for mine, more in zip(found[node], packing.counted(codes, resid, rows), strict=True):
                        for column, add in zip(mine, more, strict=True):
                            column += add
        yield {node: np.stack([packing.sums(x) for x in mine]) for node, mine in found.items()}, kept

    def add(a: tuple, b: tuple) -> tuple:
        return {node: a[0][node] + b[0][node] for node in wanted}, {node: a[1][node] + b[1][node] for node in small}

    # Whole numbers below 2**53: their sums are exact in any order.
    parts = blocks.mapPartitions(sums)
    totals, rows = functools.reduce(add, parts.collect()) if blocks.getNumPartitions() <= DIRECT else parts.treeReduce(add)
    found = {node: Leaf.of_sums(packing, *totals[node]) for node in wanted}
    none = (np.zeros((len(packing.groups), 0), dtype=np.uint16), np.zeros(0, dtype=np.int64))
    for node in small:
        found[node] = Leaf.of_rows(packing, *(np.concatenate(x, axis=-1) for x in zip(none, *rows[node], strict=True)))
    return found


def best_split(g: np.ndarray, n: np.ndarray, l2: float, min_leaf: int) -> tuple[float, int, int] | None:
    """(gain, feature, last left bin) of the best split of a leaf; the first of equal ones; None if there is none."""
    gl, nl = np.cumsum(g, axis=1), np.cumsum(n, axis=1)
    gr, nr = gl[:, -1:] - gl, nl[:, -1:] - nl
    gain = gl ** 2 / (nl + l2) + gr ** 2 / (nr + l2) - (gl[:, -1:]) ** 2 / (nl[:, -1:] + l2) if l2 > 0 else (
        gl ** 2 / np.maximum(nl, 1) + gr ** 2 / np.maximum(nr, 1) - gl[:, -1:] ** 2 / np.maximum(nl[:, -1:], 1))
    gain = np.where((nl >= max(min_leaf, 1)) & (nr >= max(min_leaf, 1)), np.round(gain, 9), 0.0)
    best = int(np.argmax(gain))
    feature, cut = divmod(best, g.shape[1])
    return (float(gain[feature, cut]), feature, cut) if gain[feature, cut] > 0 else None


def grow(fetch, root: Leaf, rate: float, leaves: int, l2: float, min_leaf: int, packing: Packing) -> tuple[Tree, dict[int, Leaf]]:
    """One tree below ``root``, and what is known of the leaves that it ends in.

    ``fetch(tree, wanted, small)`` gives the leaves ``wanted`` with their sums and the ``small`` ones with their rows.
    """
    tree = Tree()
    known = {tree.add(0.0): root}
    open_, below = [], {}  # a heap of (-gain, node, feature, cut); the children of the nodes that are split

    def consider(node: int) -> None:
        total, n = float(known[node].g[0].sum()), float(known[node].n[0].sum())
        tree.value[node] = rate * total / (n + l2) if n + l2 > 0 else 0.0
        found = best_split(known[node].g, known[node].n, l2, min_leaf)
        if found:
            heapq.heappush(open_, (-found[0], node, found[1], found[2]))

    def divide(node: int, feature: int, cut: int) -> list[int]:
        below[node] = [tree.add(0.0), tree.add(0.0)]
        tree.split(node, feature, cut, *below[node])
        return below[node]

    consider(0)
    final = {0}
    while open_ and len(final) < leaves:
        top = open_[0]
        if top[1] not in below and known[top[1]].codes is not None:
            known.update(zip(divide(*top[1:]), known[top[1]].children(packing, *top[2:]), strict=True))
        elif top[1] not in below:
            # One pass for all leaves that can still be split, were nothing better found below them.
            wanted, small, rest = [], [], []
            for _, node, feature, cut in heapq.nsmallest(leaves - len(final), open_):
                if node not in below and known[node].codes is None:
                    n = known[node].n[feature]
                    children = sorted(zip((n[:cut + 1].sum(), n[cut + 1:].sum()), divide(node, feature, cut), strict=True))
                    if children[0][0] > GATHER:
                        # Sums are exact, so those of the larger child are what its sibling leaves of its parent's.
                        rest.append((node, children[0][1], children.pop()[1]))
                    for size, child in children:
                        (small if size <= GATHER else wanted).append(child)
            known.update(fetch(tree, wanted, small))
            for node, lesser, larger in rest:
                known[larger] = Leaf(known[node].g - known[lesser].g, known[node].n - known[lesser].n)
        heapq.heappop(open_)
        final.remove(top[1])
        final.update(below[top[1]])
        for child in below[top[1]]:
            consider(child)
    return tree, {node: known[node] for node in final}


def pruned(tree: Tree, final: Container[int]) -> Tree:
    """The tree down to the leaves in ``final``."""
    out = Tree()

    def copy(node: int) -> int:
        new = out.add(tree.value[node])
        if node not in final:
            left = copy(tree.left[node])
            out.split(new, tree.feature[node], tree.cut[node], left, copy(tree.right[node]))
        return new

    copy(0)
    return out


def fit(train: DataFrame, features: Sequence[str], target: Column, rounds: int = 180, rate: float = 0.08,
        leaves: int = 31, l2: float = 0.05, min_leaf: int = 20, bins: int = 255,
        patience: int = 10, tol: float = 1e-7) -> BoostedTrees:
    """Boosted trees for ``target`` on the rows of ``train``; rows with a null target are left out.

    A null feature counts as beyond all bounds.  Without rows the model is the constant 0.
    """
    train = train.where(target.isNotNull())
    first = train.agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("base")).first()
    model = BoostedTrees(list(features), [], float(first["base"] or 0.0), [], [])
    model.bounds = bin_bounds(train, features, bins) if features else []
    if not first["n"] or not features or not any(len(b) > 1 for b in model.bounds):
        return model
    packing = Packing([max(len(b), 1) for b in model.bounds])
    packed = written(_blocks(train, features, target, model.bounds, model.base, packing), "training-blocks")
    tasks = _tasks(first["n"], packed.sparkSession.sparkContext.defaultParallelism)
    held = (packed.coalesce(1) if tasks == 1 else packed.repartition(tasks)).rdd.map(_unpacked).persist(StorageLevel.MEMORY_AND_DISK)
    loss, root = _squares(held), None
    best, since, old = np.inf, 0, None
    for done in range(rounds):
        model.losses.append(loss / SCALE ** 2 / first["n"])
        since = 0 if loss < best * (1 - tol) else since + 1
        best = min(best, loss)
        if since >= patience:
            break
        fetch = lambda *ask, h=held: _fetched(h, *ask, packing)
        if root is None:
            root = fetch(Tree([-1]), *([], [0]) if first["n"] <= GATHER else ([0], []))[0]
        whole, final = grow(fetch, root, rate, leaves, l2, min_leaf, packing)
        if old is not None:
            old.unpersist()
            old = None
        if len(final) == 1:
            break
        tree = pruned(whole, final)
        model.trees.append(tree)
        steps = _steps(whole)
        for node, leaf in final.items():
            step, n, total = int(steps[node]), int(leaf.n[0].sum()), int(leaf.g[0].sum() * SCALE)
            loss += step * (n * step - 2 * total)
        # Behind the tree, every leaf's residuals are less by its step.
        root = None if root.codes is not None else Leaf(
            sum(leaf.g - steps[node] / SCALE * leaf.n for node, leaf in final.items()), root.n)
        old, held = held, _stepped(held, tree, packing).persist(StorageLevel.MEMORY_AND_DISK)
        if (done + 1) % CUT == 0:
            held.checkpoint()
    for blocks in (old, held):
        if blocks is not None:
            blocks.unpersist()
    return model


def _tasks(rows: int, cores: int) -> int:
    """Tasks for the training rows: few rows go to one, more to as many as there are cores, many to a multiple of them."""
    return max(1, min(rows // ROWS_PER_TASK, cores * -(-rows // (cores * MOST_ROWS))))


def predict(df: DataFrame, model: BoostedTrees, out: str = "prediction") -> DataFrame:
    """``df`` with the model's value of each row."""
    if not model.trees:
        return df.withColumn(out, F.lit(model.base))

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        bins = binned(model.bounds, [x[c].to_numpy(dtype=np.float64) for c in x.columns])
        total = np.full(len(x), model.base)
        for tree in model.trees:
            total += np.array(tree.value)[leaf_of(tree, bins)]
        return pd.Series(total)

    return df.withColumn(out, score(F.struct(*(F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(model.features)))))
