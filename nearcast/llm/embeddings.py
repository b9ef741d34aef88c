"""Embedding near-dedup by spherical-cap filters.

A filter is a direction; a vector passes it if their inner product exceeds a
threshold, that is, if it lies in a spherical cap. Directions form a random
product code: after a random rotation the space is cut into two halves, each
with its own list of random directions, and every pair of one from either is a
filter. List decoding finds all filters that a vector passes from the scores
against the two short lists. Vectors meet in the filters they share and are
verified there. The cap is chosen from the number of vectors, so that a filter
holds a fixed expected number of unrelated vectors at every size.

Counting links does not expand groups of copies. Equal vectors are one node.
In every filter all vectors are compared with one hub; those within half the
linking angle of a common centre form a ball, all of whose members are linked
with each other. Only pairs from different balls are compared one by one, on
8-bit codes first, in double precision after that. A filter in a dense cone may
hold a large share of all vectors; it is dealt into blocks, and a task holds two.

Defined cases: null vectors, zero vectors and vectors with null or non-finite
components link with nothing; neither do vectors of different dimension; null
ids are vectors like others (the smallest id of a component ignores them);
repeated rows are other vectors and link; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

from .components import connected_components

COSINE = 0.9
#: Expected unrelated vectors in a filter, and filters that a pair at the threshold is expected to share.
PER_FILTER, SHARED = 20, 16
#: Independent rotations, each with a product code of its own; directions of one code are not independent.
ROTATIONS = 3
#: Most that an inner product of two 8-bit codes is off (tested); pairs closer to the threshold are verified too.
CODE_ERROR = 0.02
#: A filter with more vectors than this is compared in blocks of about as many, two to a task.
BLOCK = 10_000


def nodes(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows with their node (null if they cannot link), and one row per distinct vector that can."""
    v = F.col(vector_col)
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    all_rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"),
                           F.coalesce(usable, F.lit(False)).alias("usable"))
    keyed = all_rows.select("vec_id", F.when(F.col("usable"), F.xxhash64("v")).alias("node"), "v")
    grouped = keyed.where("node is not null").groupBy("node").agg(F.first("v").alias("v"), F.count("*").alias("weight"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column(1).to_pylist():
                x = np.array(x)
                x = x / np.abs(x).max()  # squares of very large or small components stay in range
                out.append((x / math.sqrt(float(x @ x))).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)], names=["node", "unit", "weight"])
    return keyed.select("vec_id", "node"), materialize(grouped.select("node", "v", "weight").mapInArrow(
        scale, "node long, unit binary, weight long"))


class Filters:
    """One product code for one dimension and one cap."""

    def __init__(self, dimension: int, height: float, lists: int, seed: int):
        rng = np.random.default_rng([seed, dimension])
        self.cut = dimension // 2
        self.rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
        self.codes = []
        for d in (self.cut, dimension - self.cut):
            c = rng.normal(size=(lists if d else 1, max(d, 1)))
            c /= np.linalg.norm(c, axis=1, keepdims=True)
            self.codes.append(c if d else np.zeros((1, 0)))
        #: of the sum of the two halves' scores
        self.least = math.sqrt(2) * height

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a row of unit vectors passes."""
        x = x @ self.rotation
        left, right = x[:, :self.cut] @ self.codes[0].T, x[:, self.cut:] @ self.codes[1].T
        rows, found = [], []
        for k, (a, b) in enumerate(zip(left, right, strict=True)):
            i, j = np.flatnonzero(a >= self.least - b.max()), np.flatnonzero(b >= self.least - a.max())
            p, q = np.nonzero(a[i, None] + b[j] >= self.least)
            rows.append(np.full(len(p), k))
            found.append(i[p] * len(self.codes[1]) + j[q])
        return np.concatenate(rows), np.concatenate(found)


def above(height: np.ndarray, dimension: int, grid: int = 4000) -> np.ndarray:
    """Share of the unit sphere whose inner product with a fixed direction exceeds each height."""
    u = np.linspace(-1, 1, grid)
    density = np.maximum(1 - u * u, 0) ** ((dimension - 3) / 2)
    tail = np.cumsum(density[::-1])[::-1]
    return np.interp(height, u, tail / tail[0])


@lru_cache(maxsize=64)
def cap(n: int, dimension: int, cosine: float) -> tuple[float, int]:
    """Height of the cap and directions per half of a code for ``n`` vectors.

    The cap holds ``PER_FILTER`` of n unrelated vectors. If x passes a filter
    with inner product u, a y at the linking angle passes with the probability
    that its random part makes up for h - cosine * u; averaged over u, that is
    the share of x's filters that y is expected to have.
    """
    d = max(dimension, 4)
    share = min(0.05, PER_FILTER / max(n, 1))
    h = np.linspace(0, 1, 4000)
    height = float(h[np.searchsorted(-above(h, d), -share)])
    u = np.linspace(height, 0.999, 500)
    weight = (1 - u * u) ** ((d - 3) / 2)
    partner = above((height - cosine * u) / (math.sqrt(1 - cosine * cosine) * np.sqrt(1 - u * u)), d - 1)
    both = float((weight * partner).sum() / weight.sum())
    return round(height, 6), math.ceil(math.sqrt(SHARED / both / ROTATIONS / share))


@lru_cache(maxsize=4)
def filters(dimension: int, n: int, cosine: float) -> list[Filters]:
    return [Filters(dimension, *cap(n, dimension, cosine), seed=k) for k in range(ROTATIONS)]


def passed(units: DataFrame, n: int, cosine: float) -> DataFrame:
    """filter, node, code: a row for every filter that a vector passes; the code holds 8 bits a component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_size: dict[int, list[int]] = {}
            raw = b.column(1).to_pylist()
            for k, u in enumerate(raw):
                by_size.setdefault(len(u) // 8, []).append(k)
            for d, at in by_size.items():
                node = b.column(0).to_numpy()[at]
                x = np.frombuffer(b"".join(raw[k] for k in at)).reshape(-1, d)
                code = coded(x)
                for r, code_of in enumerate(filters(d, n, cosine)):
                    for i in range(0, len(x), 500):
                        row, found = code_of.decode(x[i:i + 500])
                        number = (found * ROTATIONS + r) * 4096 + d % 4096
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(number), pa.array(node[i + row]), pa.array([code[i + k] for k in row], pa.binary())],
                            names=["filter", "node", "code"])
    return units.select("node", "unit").mapInArrow(run, "filter long, node long, code binary")


def coded(x: np.ndarray) -> list[bytes]:
    """Four bytes with the scale, then one signed byte per component."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    q = np.rint(x / scale[:, None].astype(np.float64)).astype(np.int8)
    return [s.tobytes() + r.tobytes() for s, r in zip(scale, q, strict=True)]


def decoded(codes: list[bytes]) -> np.ndarray:
    a = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return a[:, 4:].view(np.int8).astype(np.float32) * a[:, :4].copy().view(np.float32)


def whole_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Columns of blocks of rows sorted by filter, cut so that no filter is in two blocks."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        kept.append(b)
        f = b.column(0).to_numpy()
        if f[0] == f[-1] and len(kept) and (len(kept) == 1 or kept[0].column(0)[0].as_py() == f[0]):
            continue
        at = int(np.searchsorted(f, f[-1]))
        kept[-1] = b.slice(0, at)
        yield pa.Table.from_batches(kept).to_pydict()
        kept = [b.slice(at)]
    if kept:
        yield pa.Table.from_batches(kept).to_pydict()


def groups(values: list) -> Iterator[tuple[int, int]]:
    f = np.array(values)
    edges = np.flatnonzero(np.r_[True, f[1:] != f[:-1], True])
    for i in np.flatnonzero(np.diff(edges) > 1):
        yield int(edges[i]), int(edges[i + 1])


def pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def exact(candidates: DataFrame, units: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose cosine in double precision is at least ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            x, y = (c.to_pylist() for c in t.columns[2:])
            keep = [len(p) == len(q) and float(np.frombuffer(p) @ np.frombuffer(q)) >= least for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    a = units.select(F.col("node").alias("a"), F.col("unit").alias("ua"))
    b = units.select(F.col("node").alias("b"), F.col("unit").alias("ub"))
    return candidates.distinct().join(a, "a").join(b, "b").select("a", "b", "ua", "ub").mapInArrow(run, "a long, b long")


def hub_pairs(rows: DataFrame, least: float) -> DataFrame:
    """(hub, member) in every filter whose codes are at least that similar; the hub differs by filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None  # of the filter that the last batch ended in; a filter of any size streams past its hub
        for b in batches:
            f, node, code = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist()
            edges = np.flatnonzero(np.r_[True, f[1:] != f[:-1], True]) if len(f) else []
            left, right = [], []
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if hub is None or hub[0] != f[i]:
                    hub = f[i], node[i], decoded(code[i:i + 1])[0]
                    i += 1
                same = [k for k in range(i, j) if len(code[k]) == len(hub[2]) + 4]
                if same:
                    near = np.flatnonzero(decoded([code[k] for k in same]) @ hub[2] >= least)
                    left += [hub[1]] * len(near)
                    right += [node[same[k]] for k in near]
            yield pairs(left, right)
    ordered = rows.repartition("filter").sortWithinPartitions("filter", F.xxhash64("node", "filter"))
    return ordered.mapInArrow(run, "a long, b long").where("a <> b")


def near_in(node: np.ndarray, code: list[bytes], ball: np.ndarray, least: float, block: np.ndarray | None = None) -> np.ndarray:
    """Pairs (smaller node first, each once) of one dimension, from different balls and blocks, with codes that similar."""
    found = [np.zeros((2, 0), dtype=np.int64)]
    length = np.fromiter(map(len, code), dtype=np.int64, count=len(code))
    # vectors of two dimensions may meet in a filter number
    for at in [np.arange(len(code))] if (length == length[0]).all() else [np.flatnonzero(length == d) for d in np.unique(length)]:
        x, b, n = decoded([code[k] for k in at]), ball[at], node[at]
        _, of, size = np.unique(b, return_inverse=True, return_counts=True)
        is_rest = of != size.argmax()
        rest = np.flatnonzero(is_rest)
        for k in range(0, len(rest), 1000):
            part = rest[k:k + 1000]
            near = (x[part] @ x.T >= least) & (b[part, None] != b)
            if block is not None:
                near &= block[at[part], None] != block[at]
            p, q = np.nonzero(near)
            p = part[p]
            once = ~is_rest[q] | (q > p)
            p, q = n[p[once]], n[q[once]]
            found.append(np.stack([np.minimum(p, q), np.maximum(p, q)]))
    return np.concatenate(found, axis=1)


def distinct_pairs(found: list[np.ndarray]) -> np.ndarray:
    """Both rows of the pairs, each pair once."""
    both = np.concatenate(found, axis=1)
    both = both[:, np.lexsort(both)]
    return both[:, np.r_[True, (both[:, 1:] != both[:, :-1]).any(axis=0)][:both.shape[1]]]


def cross_pairs(rows: DataFrame, least: float) -> DataFrame:
    """Pairs from different balls in the same filter whose codes are at least that similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_filters(batches):
            ball, node = np.array(t["ball"], dtype=np.int64), np.array(t["node"], dtype=np.int64)
            found = [near_in(node[i:j], t["code"][i:j], ball[i:j], least) for i, j in groups(t["filter"])]
            if found:
                yield pairs(*distinct_pairs(found))
    ordered = rows.repartition("filter").sortWithinPartitions("filter")
    return ordered.select("filter", "node", "code", "ball").mapInArrow(run, "a long, b long")


def hot_pairs(rows: DataFrame, hot: DataFrame, least: float) -> DataFrame:
    """The same for filters with many vectors: dealt into blocks, a task compares one block with itself or another."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = None if pdf["low"].iat[0] == pdf["high"].iat[0] else pdf["block"].to_numpy()
        a, b = near_in(pdf["node"].to_numpy(), pdf["code"].tolist(), pdf["ball"].to_numpy(), least, block)
        return pd.DataFrame({"a": a, "b": b})
    dealt = rows.join(hot, "filter").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cells = dealt.select("filter", "node", "code", "ball", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).drop("other")
    return cells.groupBy("filter", "low", "high").applyInPandas(run, "a long, b long")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                 block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    keyed, units = nodes(rows, id_col, vector_col)
    keyed = materialize(keyed)
    n = units.count()
    found = materialize(passed(units, n, cosine))
    # members within half the linking angle of a centre are linked with each other; the margin covers rounding
    half = math.cos(math.acos(cosine) / 2) + 1e-9
    tight = materialize(exact(hub_pairs(found, half - CODE_ERROR), units, half))
    rank = F.struct(F.xxhash64("centre"), F.col("centre"))
    wish = tight.select(F.col("b").alias("node"), F.col("a").alias("centre")) \
        .unionByName(tight.select(F.col("a").alias("node"), F.col("b").alias("centre"))) \
        .unionByName(tight.select(F.col("a").alias("node"), F.col("a").alias("centre"))) \
        .unionByName(tight.select(F.col("b").alias("node"), F.col("b").alias("centre")))
    wish = materialize(wish.distinct())
    # a centre ranks first among all that it is near to; a member takes the first of the centres it is near to
    centres = wish.groupBy("node").agg(F.min_by("centre", rank).alias("centre")).where("node = centre").select("centre")
    balls = materialize(wish.join(materialize(centres), "centre").groupBy("node").agg(F.min_by("centre", rank).alias("ball")))

    labelled = found.join(balls, "node", "left").withColumn("ball", F.coalesce("ball", "node"))
    hot = materialize(found.groupBy("filter").agg(F.count("*").alias("n")).where(F.col("n") > block)
                      .select("filter", F.ceil(F.col("n") / block).alias("blocks")))
    candidates = cross_pairs(labelled.join(hot, "filter", "left_anti"), cosine - CODE_ERROR)
    links = materialize(exact(candidates.unionByName(hot_pairs(labelled, hot, cosine - CODE_ERROR)), units, cosine))

    weights = units.select("node", "weight").join(balls, "node", "left").withColumn("ball", F.coalesce("ball", "node"))
    inside = weights.groupBy("ball").agg(F.sum("weight").alias("ball_weight"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = (both.join(units.select(F.col("node").alias("b"), "weight"), "b")
              .groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("across")))
    # a ball is connected, so components are those of balls that some link joins
    a, b = (weights.select(F.col("node").alias(x), F.col("ball").alias(f"ball_{x}")) for x in ("a", "b"))
    joined = links.join(a, "a").join(b, "b").select(F.col("ball_a").alias("a"), F.col("ball_b").alias("b")).distinct()
    parts = connected_components(joined).withColumnRenamed("node", "ball")
    of_node = weights.join(inside, "ball").join(across, "node", "left").join(parts, "ball", "left").select(
        "node", (F.col("ball_weight") + F.coalesce("across", F.lit(0)) - 1).alias("n_links"),
        F.coalesce("component", "ball").alias("component"))
    of_node = materialize(of_node)
    smallest = (keyed.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("vec_id"))
                .join(of_node.select("node", "component"), "node")
                .groupBy("component").agg(F.min("vec_id").alias("component_id")))
    labels = materialize(of_node.join(smallest, "component").select("node", "n_links", "component_id"))
    out = keyed.join(labels, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
