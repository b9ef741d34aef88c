"""Histogram gradient-boosted trees for a binary target (M5) as Spark aggregations.

Feature values become at most 255 quantile bins (sketches of all training
rows, one pass). A tree grows level by level: every task adds up gradients,
hessians and rows per open node, feature and bin of its rows, Spark sums these
tables, running sums over the bins of a (node, feature) give the gain of every
cut, and the best cut per node is all that reaches the driver. What a task sends
is bounded by nodes x features x bins, whatever the number of rows.

Leaves are -G / (H + l2), times the learning rate. Of the cuts of all levels
the best gains are kept until the tree has ``max_leaves`` leaves, which is the
tree that best-first growth would have made. A tree is a few hundred numbers;
the trees so far are applied to the binned rows inside the tasks, and every
``REWRITE`` trees the raw scores are written to the shared folder, so a lost
executor repeats little.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearcast.session import materialize

#: The reference's tree parameters; leaves and bins are its library's defaults.
DEFAULTS = {"max_depth": 8, "learning_rate": 0.1, "max_iter": 200, "min_rows": 50, "l2": 1.0, "max_leaves": 31}
BINS, REWRITE = 255, 10


@dataclass
class Tree:
    """Node i: feature (-1: leaf), bin (at most: left), children and the leaf's value."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, x in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(x)
        return len(self.feature) - 1

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``bins`` (rows, features)."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(bins), dtype=np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = np.where(bins[inner, feature[node]] <= cut[node], left[node], right[node])

    def raw(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.node_of(bins)]


@dataclass
class Boosted:
    """A fitted model: bin edges per feature, the first raw score, trees."""

    edges: list[list[float]]
    start: float
    trees: list[Tree]

    def binned(self, values: np.ndarray) -> np.ndarray:
        """Number of edges below each value; a missing value counts as smallest."""
        out = np.zeros(values.shape, dtype=np.uint8)
        for j, e in enumerate(self.edges):
            out[:, j] = np.searchsorted(np.array(e), np.nan_to_num(values[:, j], nan=-np.inf), side="left")
        return out

    def probability(self, values: np.ndarray) -> np.ndarray:
        bins = self.binned(values)
        return 1 / (1 + np.exp(-(self.start + sum((t.raw(bins) for t in self.trees), np.zeros(len(bins))))))

    def to_json(self) -> str:
        return json.dumps({"edges": self.edges, "start": self.start, "trees": [vars(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        d = json.loads(text)
        return Boosted(d["edges"], d["start"], [Tree(**t) for t in d["trees"]])


def quantile_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins - 1`` increasing edges per feature, values themselves; nulls left out."""
    fractions = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), fractions, 10_000).alias(f"e{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(row[f"e{i}"] or [])) for i in range(len(features))]


def _matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns])


def _bins(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """(rows, features) of the bytes as they lie in the batch."""
    column = batch.column("bins")
    if not len(column):
        return np.zeros((0, width), dtype=np.uint8)
    start = int(np.frombuffer(column.buffers()[1], dtype=np.int32, count=1, offset=4 * column.offset)[0])
    return np.frombuffer(column.buffers()[2], dtype=np.uint8, count=len(column) * width, offset=start).reshape(-1, width)


def _packed(bins: np.ndarray) -> pa.Array:
    """The other way round."""
    ends = np.arange(len(bins) + 1, dtype=np.int32) * bins.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(bins))])


def _binned_rows(df: DataFrame, model: Boosted, features: list[str], label: str) -> DataFrame:
    """bins (a byte per feature), y, raw of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = model.binned(_matrix(batch, features))
            yield pa.RecordBatch.from_pydict({"bins": _packed(b), "y": batch.column("__y"),
                                              "raw": pa.array(np.full(len(b), model.start))})
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("__y"))
    return rows.mapInArrow(run, "bins binary, y double, raw double")


def _histograms(rows: DataFrame, trees: list[Tree], growing: Tree, open_nodes: list[int], width: int) -> DataFrame:
    """node, feature, bin, g, h, n: sums over all rows of the open nodes."""
    slot = np.full(len(growing.feature), -1)
    slot[open_nodes] = np.arange(len(open_nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(open_nodes) * 256
        sums = np.zeros((3, width, size))  # by feature, then node and bin
        for batch in batches:
            bins = _bins(batch, width)
            raw = batch.column("raw").to_numpy() + sum((t.raw(bins) for t in trees), np.zeros(len(bins)))
            p = 1 / (1 + np.exp(-raw))
            at = slot[growing.node_of(bins)]
            g, h = p - batch.column("y").to_numpy(), p * (1 - p)
            inside = at >= 0
            if not inside.all():
                bins, at, g, h = bins[inside], at[inside], g[inside], h[inside]
            at, columns = at * 256, np.ascontiguousarray(bins.T)
            for j in range(width):
                cell = at + columns[j]
                for k, w in enumerate((g, h, None)):
                    sums[k, j] += np.bincount(cell, weights=w, minlength=size)
        sums = sums.reshape(3, -1)
        cell = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(np.array(open_nodes, dtype=np.int64)[cell % size // 256]), "feature": pa.array((cell // size).astype(np.int64)),
            "bin": pa.array((cell % 256).astype(np.int64)), "g": pa.array(sums[0][cell]), "h": pa.array(sums[1][cell]), "n": pa.array(sums[2][cell])})
    part = rows.mapInArrow(run, "node long, feature long, bin long, g double, h double, n double")
    return part.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])


def best_cuts(histograms: DataFrame, l2: float, min_rows: int) -> DataFrame:
    """node, gain, feature, bin and the sums of both sides of each node's best cut (ties: first feature, lowest bin)."""
    one = Window.partitionBy("node", "feature")
    below = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    d = histograms.select("node", "feature", "bin", *[F.sum(c).over(below).alias(f"{c}l") for c in ("g", "h", "n")],
                          *[F.sum(c).over(one).alias(f"{c}t") for c in ("g", "h", "n")])
    d = d.select("*", *[(F.col(f"{c}t") - F.col(f"{c}l")).alias(f"{c}r") for c in ("g", "h", "n")])

    def score(side: str):
        return F.col(f"g{side}") * F.col(f"g{side}") / (F.col(f"h{side}") + l2)
    d = d.where((F.col("nl") >= min_rows) & (F.col("nr") >= min_rows)).withColumn("gain", F.round(score("l") + score("r") - score("t"), 9))
    best = F.max_by(F.struct("feature", "bin", "gl", "hl", "gr", "hr"), F.struct("gain", -F.col("feature"), -F.col("bin")))
    return d.where("gain > 0").groupBy("node").agg(F.max("gain").alias("gain"), best.alias("cut")).select("node", "gain", "cut.*")


def pruned(full: Tree, gains: dict[int, float], max_leaves: int) -> Tree:
    """The tree with the best gains first, up to ``max_leaves`` leaves."""
    kept: set[int] = set()
    queue = [(-gains[0], 0)] if full.feature[0] >= 0 else []
    while queue and len(kept) + 1 < max_leaves:
        _, node = heapq.heappop(queue)
        kept.add(node)
        for child in (full.left[node], full.right[node]):
            if full.feature[child] >= 0:
                heapq.heappush(queue, (-gains[child], child))
    out = Tree()

    def copy(node: int) -> int:
        new = out.add(full.value[node])
        if node in kept:
            out.feature[new], out.bin[new] = full.feature[node], full.bin[node]
            out.left[new] = copy(full.left[node])
            out.right[new] = copy(full.right[node])
        return new
    copy(0)  # as deep as the tree, at most max_depth
    return out


def grow(rows: DataFrame, trees: list[Tree], width: int, p: dict) -> Tree:
    """One more tree on ``rows``, whose raw scores lack those of ``trees``."""
    full, gains = Tree(), {}
    full.add(0.0)
    level = [0]
    for depth in range(p["max_depth"]):
        cuts = best_cuts(_histograms(rows, trees, full, level, width), p["l2"], p["min_rows"]).collect()  # one row a node
        level = []
        for c in sorted(cuts, key=lambda c: c.node):
            node = c.node
            gains[node] = c.gain
            full.feature[node], full.bin[node] = c.feature, c.bin
            full.left[node] = full.add(-p["learning_rate"] * c.gl / (c.hl + p["l2"]))
            full.right[node] = full.add(-p["learning_rate"] * c.gr / (c.hr + p["l2"]))
            level += [full.left[node], full.right[node]]
        if not level:
            break
    return pruned(full, gains, p["max_leaves"])


def with_raw(rows: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """``rows`` with the scores of ``trees`` added to ``raw``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _bins(batch, width)
            raw = batch.column("raw").to_numpy() + sum((t.raw(bins) for t in trees), np.zeros(len(bins)))
            yield pa.RecordBatch.from_pydict({"bins": batch.column("bins"), "y": batch.column("y"), "raw": pa.array(raw)})
    return rows.mapInArrow(run, rows.schema)


def fit(df: DataFrame, features: list[str], label: str, **params) -> Boosted:
    """A model of numeric ``features`` for a 0/1 label; rows without a label are left out, null features count as smallest."""
    p = DEFAULTS | params
    df = df.where(F.col(label).isNotNull())
    rate = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if rate is None:
        raise ValueError("no labelled rows")
    rate = min(max(rate, 1e-9), 1 - 1e-9)
    model = Boosted(quantile_edges(df, features), float(np.log(rate / (1 - rate))), [])
    rows, pending = materialize(_binned_rows(df, model, features, label)), []
    for i in range(p["max_iter"]):
        tree = grow(rows, pending, len(features), p)
        model.trees.append(tree)
        pending.append(tree)
        if tree.feature[0] < 0:  # nothing left to split
            break
        if len(pending) == REWRITE and i + 1 < p["max_iter"]:
            rows, pending = materialize(with_raw(rows, pending, len(features))), []
    return model


def scored(df: DataFrame, model: Boosted, features: list[str], out: str = "score") -> DataFrame:
    """``df`` with the model's probability."""
    @F.pandas_udf("double")
    def probability(*columns):
        import pandas as pd
        return pd.Series(model.probability(np.column_stack([c.to_numpy(dtype=float) for c in columns])))
    return df.withColumn(out, probability(*[F.col(c).cast("double") for c in features]))
