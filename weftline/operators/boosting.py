"""Boosted regression trees with Poisson loss over feature histograms, and their exact additive explanations.

Features become codes of at most ``BINS`` quantile bins: numbers by approximate quantiles, categories by the
smoothed mean of the target in ``BUCKETS`` hashed buckets, so nothing grows with the number of categories.
A tree is grown level by level from sums of gradients and curvatures by (node, feature, bin). Rows of up to
``LOCAL_CELLS`` codes (a size that is checked) are summed in the driver's process; more stay where they are:
each level is one job whose tasks send their sums, and only the sums meet. Both ways grow the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 64
BUCKETS = 1 << 12
SMOOTH = 20.0
LOCAL_CELLS = 1 << 24
#: Trees between two writings of the rows' margins.
REFRESH = 16

#: Defaults; the names are those of the public gradient-boosting libraries.
DEFAULTS = {"rounds": 500, "stop": 30, "max_depth": 6, "eta": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 1.0, "max_delta_step": 0.0, "reg_alpha": 0.0, "reg_lambda": 1.0}


@dataclass
class Coding:
    """How columns become codes: quantile edges of each feature, and the buckets' target means of categories."""

    features: list[str]
    kinds: list[str]
    edges: list[list[float]]
    means: dict[str, list[float]]

    def columns(self) -> list:
        """The features as doubles: a category as its bucket's number, a missing number as 0."""
        number = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0))
        return [_bucket(c).cast("double") if c in self.kinds else number(c) for c in self.features]

    def codes(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(columns[0]) if columns else 0, len(self.features)), np.uint8)
        for i, (c, x) in enumerate(zip(self.features, columns, strict=True)):
            x = np.array(self.means[c])[x.astype(np.int64)] if c in self.kinds else x
            out[:, i] = np.searchsorted(self.edges[i], x, side="left")
        return out


def _bucket(c: str):
    return F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("unknown"))), F.lit(BUCKETS))


def coding(df: DataFrame, features: list[str], kinds: list[str], target: str) -> Coding:
    """One job for the categories (a row a bucket that occurs) and one for the numbers' quantiles."""
    kinds, numbers = [c for c in features if c in kinds], [c for c in features if c not in kinds]
    means, edges = {}, {}
    if kinds:
        pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), _bucket(c).alias("b")) for c in kinds)))
        rows = df.select(pairs.alias("x"), F.col(target).cast("double").alias("y")).groupBy("x.c", "x.b").agg(F.sum("y").alias("y"), F.count("y").alias("n")).collect()
        for c in kinds:
            own = sorted((r.b, r.y or 0.0, r.n) for r in rows if r.c == c)
            n = np.array([r[2] for r in own], float)
            overall = sum(r[1] for r in own) / max(n.sum(), 1)
            table = np.full(BUCKETS, overall)
            table[[r[0] for r in own]] = (np.array([r[1] for r in own]) + SMOOTH * overall) / (n + SMOOTH)
            means[c] = table.tolist()
            edges[c] = sorted({float(x) for x in np.quantile(np.repeat(table[[r[0] for r in own]], np.maximum(1, n * 1000 / max(n.sum(), 1)).astype(int)), np.linspace(0, 1, BINS)[1:-1])}) if own else []
    if numbers:
        plain = Coding(numbers, [], [], {})
        shares = [i / BINS for i in range(1, BINS)]
        found = df.select(*(x.alias(f"c{i}") for i, x in enumerate(plain.columns()))).agg(*(F.percentile_approx(f"c{i}", shares, 10_000) for i in range(len(numbers)))).first()
        edges |= {c: sorted(set(found[i] or [])) for i, c in enumerate(numbers)}
    return Coding(list(features), kinds, [edges[c] for c in features], means)


@dataclass
class Tree:
    """By heap position: the feature and the last code that goes left; each node's cover; and the leaves."""

    feature: list[int]
    cut: list[int]
    cover: list[float]
    leaves: list[float]
    gain: list[float]

    def nodes(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row at a level, from 0."""
        at, rows, feature, cut = np.zeros(len(codes), np.int64), np.arange(len(codes)), np.array(self.feature, np.int64), np.array(self.cut, np.int64)
        for _ in range(depth):
            at = 2 * at + 1 + (codes[rows, feature[at]] > cut[at])
        return at - (2**depth - 1)


@dataclass
class Trees:
    coding: Coding
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)

    def margin(self, codes: np.ndarray) -> np.ndarray:
        return self.base + sum((np.array(t.leaves)[t.nodes(codes, self.depth)] for t in self.trees), np.zeros(len(codes)))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with a positive prediction."""
        model = self

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            return pd.Series(np.exp(model.margin(model.coding.codes([c.to_numpy() for c in columns]))))

        return df.withColumn(name, score(*self.coding.columns()))

    def shap(self, codes: np.ndarray) -> np.ndarray:
        """(rows x features): exact path-dependent Shapley values of the margin; with ``expected`` they add up to it."""
        out = np.zeros((len(codes), len(self.coding.features)))
        for tree in self.trees:
            for path, ratio, value in _paths(tree, self.depth):
                weights = _shares(tuple(ratio))
                hot = np.stack([np.logical_and.reduce([(codes[:, f] > cut) == right for cut, right in tests]) for f, tests in path], axis=1)
                out[:, [f for f, _ in path]] += value * weights[hot @ (1 << np.arange(len(path)))]
        return out

    def expected(self) -> float:
        """The mean margin by the trees' covers."""
        total = lambda t: sum(v * t.cover[2**self.depth - 1 + i] for i, v in enumerate(t.leaves)) / max(t.cover[0], 1e-300)
        return self.base + sum(map(total, self.trees))

    def shap_values(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """(keys, feature, shap): the local explanation, a row for each row and feature."""
        model = self

        @F.pandas_udf("array<double>")
        def explained(*columns: pd.Series) -> pd.Series:
            return pd.Series(list(model.shap(model.coding.codes([c.to_numpy() for c in columns]))))

        names = F.array(*(F.lit(c) for c in self.coding.features))
        rows = df.select(*keys, F.explode(F.arrays_zip(names.alias("feature"), explained(*self.coding.columns()).alias("shap"))).alias("_s"))
        return rows.select(*keys, F.col("_s.feature").alias("feature"), F.col("_s.shap").alias("shap"))

    def shap_summary(self, df: DataFrame) -> DataFrame:
        """(feature, mean_abs_shap, mean_shap): the global explanation."""
        return self.shap_values(df, []).groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"), F.avg("shap").alias("mean_shap"))

    def importances(self) -> list[tuple[str, float]]:
        """Each feature's share of the gains."""
        gains = np.zeros(len(self.coding.features))
        for t in self.trees:
            np.add.at(gains, np.array(t.feature, np.int64), np.array(t.gain))
        return list(zip(self.coding.features, (gains / max(gains.sum(), 1e-300)).tolist(), strict=True))

    def to_json(self) -> str:
        return json.dumps({"coding": vars(self.coding), "base": self.base, "depth": self.depth, "trees": [vars(t) for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Trees:
        held = json.loads(text)
        return cls(Coding(**held["coding"]), held["base"], held["depth"], [Tree(**t) for t in held["trees"]])


def _paths(tree: Tree, depth: int) -> Iterator[tuple[list[tuple[int, list[tuple[int, bool]]]], list[float], float]]:
    """For each leaf that is reached: its features with their tests, each feature's product of cover ratios, and the value."""
    for leaf, value in enumerate(tree.leaves):
        node, tests, ratio = 2**depth - 1 + leaf, {}, {}
        if not tree.cover[node] or not value:
            continue
        while node:
            up = (node - 1) // 2
            f = tree.feature[up]
            tests.setdefault(f, []).append((tree.cut[up], node == 2 * up + 2))
            ratio[f] = ratio.get(f, 1.0) * tree.cover[node] / tree.cover[up]
            node = up
        yield list(tests.items()), [ratio[f] for f in tests], value


@lru_cache(maxsize=1 << 14)
def _shares(ratio: tuple[float, ...]) -> np.ndarray:
    """(2^m x m): each feature's Shapley value of a leaf of value 1, by which features' tests a row passes."""
    m = len(ratio)
    hot = (np.arange(2**m)[:, None] >> np.arange(m) & 1).astype(float)
    weight = np.array([1 / (m * _choose(m - 1, k)) for k in range(m)])
    out = np.empty((2**m, m))
    for i in range(m):
        # The sum over the sets of other features, by their size: a feature outside the set counts by its ratio.
        sizes = np.zeros((2**m, m))
        sizes[:, 0] = 1
        for j in range(m):
            if j != i:
                sizes[:, 1:], sizes[:, 0] = sizes[:, 1:] * ratio[j] + sizes[:, :-1] * hot[:, j : j + 1], sizes[:, 0] * ratio[j]
        out[:, i] = (sizes @ weight) * (hot[:, i] - ratio[i])
    return out


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _drawn(keys: np.ndarray, number: int, share: float) -> np.ndarray:
    """Which rows a tree is grown from, by a hash of row and tree."""
    x = keys.astype(np.uint64) ^ np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(11)).astype(float) / (1 << 53) < share


def _sums(codes: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, active: np.ndarray) -> np.ndarray:
    """(2 x active nodes x features x BINS): sums of gradients and curvatures of the level's nodes that may be split."""
    place = np.full(2**level, -1)
    place[active] = np.arange(len(active))
    node, nodes = place[node], len(active)
    codes, node, g, h = (x[node >= 0] for x in (codes, node, g, h))
    f = codes.shape[1]
    key = (node[:, None] * (f * BINS) + np.arange(f) * BINS + codes).ravel()
    return np.stack([np.bincount(key, np.repeat(x, f), nodes * f * BINS) for x in (g, h)]).reshape(2, nodes, f, BINS)


def _poisson(y: np.ndarray, margin: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    mean = np.exp(np.clip(margin, -30, 30))
    return mean - y, mean * np.exp(step)


def _loss(y: np.ndarray, margin: np.ndarray) -> float:
    return float((np.exp(np.clip(margin, -30, 30)) - y * margin).sum())


class LocalRows:
    """Rows at hand: codes, targets, row keys, and which rows only tell when to stop."""

    def __init__(self, codes: np.ndarray, y: np.ndarray, keys: np.ndarray, stop: np.ndarray, base: float):
        self.codes, self.y, self.keys = codes[~stop], y[~stop], keys[~stop]
        self.stop_codes, self.stop_y = codes[stop], y[stop]
        self.margin, self.stop_margin = np.full(len(self.y), base), np.full(len(self.stop_y), base)

    def level(self, tree: Tree, level: int, active: np.ndarray, number: int, share: float, step: float) -> np.ndarray:
        if level == 0:
            self.at = np.flatnonzero(_drawn(self.keys, number, share))
            self.g, self.h = (x[self.at] for x in _poisson(self.y, self.margin, step))
            self.drawn = self.codes[self.at]
        return _sums(self.drawn, tree.nodes(self.drawn, level), self.g, self.h, level, active)

    def add(self, tree: Tree, depth: int) -> float | None:
        """Takes the tree in; the loss of the rows that tell when to stop."""
        self.margin = self.margin + np.array(tree.leaves)[tree.nodes(self.codes, depth)]
        if not len(self.stop_y):
            return None
        self.stop_margin = self.stop_margin + np.array(tree.leaves)[tree.nodes(self.stop_codes, depth)]
        return _loss(self.stop_y, self.stop_margin)


class SparkRows:
    """Rows where they are: (codes, y, key, stop); a level is one job, and margins are written every ``REFRESH`` trees."""

    def __init__(self, rows: DataFrame, features: int, base: float):
        self.rows, self.features, self.fresh = rows.withColumn("margin", F.lit(base)).checkpoint(), features, []

    def _batches(self, batch: pa.RecordBatch, fresh: list[Tree], depth: int) -> tuple[np.ndarray, ...]:
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, self.features)
        margin = batch.column("margin").to_numpy() + sum((np.array(t.leaves)[t.nodes(codes, depth)] for t in fresh), np.zeros(len(codes)))
        return codes, batch.column("y").to_numpy(), batch.column("key").to_numpy().view(np.uint64), batch.column("stop").to_numpy(zero_copy_only=False).astype(bool), margin

    def level(self, tree: Tree, level: int, active: np.ndarray, number: int, share: float, step: float) -> np.ndarray:
        fresh, read, f = list(self.fresh), self._plain(), self.features
        depth = self.depth

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, len(active), f, BINS))
            for batch in batches:
                codes, y, keys, stop, margin = read(batch, fresh, depth)
                at = np.flatnonzero(~stop & _drawn(keys, number, share))
                if len(at):
                    g, h = _poisson(y[at], margin[at], step)
                    total += _sums(codes[at], tree.nodes(codes[at], level), g, h, level, active)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(active)), pa.int32()), pa.array([total[:, i].tobytes() for i in range(len(active))], pa.binary())], ["node", "sums"])

        def add(group: pa.Table) -> pa.Table:
            return pa.table({"node": group.column("node").slice(0, 1), "sums": pa.array([sum(np.frombuffer(x) for x in group.column("sums").to_pylist()).tobytes()], pa.binary())})

        out = np.zeros((2, len(active), f, BINS))
        for r in self.rows.mapInArrow(part, "node int, sums binary").groupBy("node").applyInArrow(add, "node int, sums binary").collect():
            out[:, r["node"]] = np.frombuffer(r["sums"]).reshape(2, f, BINS)
        return out

    def _plain(self):
        """The reader without the DataFrame, for the workers."""
        held = object.__new__(SparkRows)
        held.features = self.features
        return held._batches

    def add(self, tree: Tree, depth: int) -> float | None:
        self.depth = depth
        self.fresh.append(tree)
        fresh, read = list(self.fresh), self._plain()

        def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, y, _, stop, margin = read(batch, fresh, depth)
                yield pa.RecordBatch.from_arrays([pa.array([_loss(y[stop], margin[stop])]), pa.array([int(stop.sum())], pa.int64())], ["loss", "n"])

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(read(batch, fresh, depth)[4])], batch.schema.names)

        found = self.rows.mapInArrow(losses, "loss double, n bigint").agg(F.sum("loss"), F.sum("n")).first()
        if len(self.fresh) >= REFRESH:
            self.rows, self.fresh = self.rows.mapInArrow(moved, self.rows.schema).checkpoint(), []
        return found[0] if found[1] else None

    depth = 0


def boost(rows: LocalRows | SparkRows, coding_: Coding, base: float, params: dict, seed: int = 42) -> Trees:
    """Trees until ``stop`` rounds in a row don't help the rows that tell, ``rounds`` at most; the best number is kept."""
    p = DEFAULTS | params
    depth, f, rng = int(p["max_depth"]), len(coding_.features), np.random.default_rng(seed)
    step = p["max_delta_step"] or 0.7
    model, best, best_at = Trees(coding_, base, depth), None, 0
    soft = lambda x: np.sign(x) * np.maximum(np.abs(x) - p["reg_alpha"], 0)
    if isinstance(rows, SparkRows):
        rows.depth = depth
    for number in range(int(p["rounds"])):
        used = np.zeros(f, bool)
        used[rng.choice(f, max(1, round(f * p["colsample_bytree"])), replace=False)] = True
        inner = 2**depth - 1
        tree = Tree([0] * inner, [BINS] * inner, [0.0] * (2 * inner + 1), [0.0] * (inner + 1), [0.0] * inner)
        grads = [0.0] * (2 * inner + 1)
        active = np.zeros(1, np.int64)
        for level in range(depth):
            sums = rows.level(tree, level, active, number, p["subsample"], step)
            left = sums.cumsum(axis=3)
            total = left[:, :, :1, -1:]
            gl, hl = left[0, :, :, :-1], left[1, :, :, :-1]
            gr, hr = total[0] - gl, total[1] - hl
            gain = soft(gl) ** 2 / (hl + p["reg_lambda"]) + soft(gr) ** 2 / (hr + p["reg_lambda"]) - soft(total[0]) ** 2 / (total[1] + p["reg_lambda"])
            gain = np.where((hl >= p["min_child_weight"]) & (hr >= p["min_child_weight"]) & used[None, :, None], gain, -1.0).reshape(len(active), -1)
            if level == 0:
                grads[0], tree.cover[0] = float(total[0, 0, 0, 0]), float(total[1, 0, 0, 0])
            for k, top in enumerate(gain.argmax(axis=1).tolist()):
                at = 2**level - 1 + int(active[k])
                if gain[k, top] > 1e-9:
                    tree.feature[at], tree.cut[at], tree.gain[at] = top // (BINS - 1), top % (BINS - 1), float(gain[k, top])
                    g, h = float(gl.reshape(len(active), -1)[k, top]), float(hl.reshape(len(active), -1)[k, top])
                    for child, x, c in ((2 * at + 1, g, h), (2 * at + 2, grads[at] - g, max(tree.cover[at] - h, 0.0))):
                        grads[child], tree.cover[child] = x, c
            # A node that isn't split sends all its rows left, down to a leaf.
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                if tree.cut[at] == BINS:
                    grads[2 * at + 1], tree.cover[2 * at + 1] = grads[at], tree.cover[at]
            split = [k for k in active if tree.cut[2**level - 1 + k] < BINS]
            active = np.array([2 * k + side for k in split for side in (0, 1) if tree.cover[2 ** (level + 1) - 1 + 2 * k + side] >= 2 * p["min_child_weight"]], np.int64)
            if not len(active):
                # The rest of the levels hand down what is there.
                for at in range(2 ** (level + 1) - 1, inner):
                    grads[2 * at + 1], tree.cover[2 * at + 1] = grads[at], tree.cover[at]
                break
        values = [float(np.clip(-soft(grads[inner + i]) / (tree.cover[inner + i] + p["reg_lambda"]), -step, step)) if tree.cover[inner + i] else 0.0 for i in range(inner + 1)]
        tree.leaves = [p["eta"] * v for v in values]
        model.trees.append(tree)
        loss = rows.add(tree, depth)
        if loss is not None:
            if best is None or loss < best:
                best, best_at = loss, number + 1
            elif number + 1 - best_at >= p["stop"]:
                break
    if best is not None:
        model.trees = model.trees[:best_at]
    return model


def coded(df: DataFrame, how: Coding, target: str, validation: str | None) -> DataFrame:
    """(codes, y, key, stop) of the rows with a target."""
    stop = F.coalesce(F.col(validation).cast("boolean"), F.lit(False)) if validation else F.lit(False)
    rows = df.where(F.col(target).isNotNull()).select(F.array(*how.columns()).alias("x"), F.greatest(F.col(target).cast("double"), F.lit(0.0)).alias("y"), F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")]).alias("key"), stop.alias("stop"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = how.codes(list(x.T))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in codes], pa.binary()), *batch.columns[1:]], ["codes", "y", "key", "stop"])

    return rows.mapInArrow(code, "codes binary, y double, key bigint, stop boolean")


def gathered(rows: DataFrame, features: int) -> tuple[np.ndarray, ...]:
    """Coded rows as arrays, in the order of their keys."""
    held = rows.toArrow()
    keys = held.column("key").to_numpy().view(np.uint64)
    y, stop = held.column("y").to_numpy(), held.column("stop").to_numpy().astype(bool)
    codes = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(-1, features)
    order = np.lexsort((y, keys))
    return codes[order], y[order], keys[order], stop[order]


def fit(df: DataFrame, features: list[str], kinds: list[str], target: str = "units", params: dict | None = None, validation: str | None = None, seed: int = 42) -> Trees:
    """Poisson trees of the rows with a target; rows that ``validation`` marks only tell when to stop."""
    train = df.where(~F.coalesce(F.col(validation).cast("boolean"), F.lit(False))) if validation else df
    how = coding(train, features, kinds, target)
    rows = coded(df, how, target, validation).persist()
    try:
        found = rows.where("NOT stop").agg(F.avg("y").alias("mean")).first()
        base = float(np.log(max(found["mean"] or 0.0, 1e-6)))
        source = LocalRows(*gathered(rows, len(features)), base) if rows.count() * len(features) <= LOCAL_CELLS else SparkRows(rows, len(features), base)
        return boost(source, how, base, params or {}, seed)
    finally:
        rows.unpersist()
