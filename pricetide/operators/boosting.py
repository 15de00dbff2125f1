"""Second-order gradient boosting of trees on binned features, several models side by side.

Values become bins once, by cut points from one aggregate, and rows are stored in blocks of bytes.  One job grows one
level of the current tree of every model: tasks drop their rows down the tree, add gradients and row counts per
(open node, feature, bin), and emit the cells that have rows, as one array per model and feature.  These are summed where they meet, and only
the best cut of each node and feature reaches the driver: nodes x features rows, whatever the size of the table.
Margins are written with the blocks every few rounds, so a job applies few trees and a lost executor costs little.
Up to ``TASK_ROWS`` rows a job per level would cost more than the level; there one task per model takes the same steps alone.

Squared error: the gradient of a row is its margin less its target and the second derivative is one, so a node's value
is its gradient sum, drawn towards nought by ``l1``, over its rows plus ``l2``.

Defined results: a row without target or role is left out.  A missing value (null or NaN) counts as greater than all others.
Equal gains (as 32-bit numbers) go to the first feature, then the lowest cut.  No rows to train on give the mean alone.
"""

from __future__ import annotations

import heapq
import json
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import drop_folder, shared_folder

BINS = 255
# Rounds between two writings of the margins: each job of a level applies all trees since the last one.
KEPT_ROUNDS = 4
# Rows of a block, at least, where a task has them.
BLOCK_ROWS = 1 << 16
# Models that share the jobs of one run; the arrays of a task grow with it.
SIDE_BY_SIDE = 8
# Rows up to which one task grows all trees of a model: some 45 bytes a row are broadcast and held, and there is no job per level.
TASK_ROWS = 1 << 20
PATIENCE = 50
_HISTOGRAM = "model int, feature int, cells binary, grad binary, rows binary"
_BEST = ("model int, feature int, slot int, bin int, gain double, left_grad double, left_rows bigint, grad double, "
         "rows bigint")
_BLOCK = "codes binary, target binary, role binary, hash binary, margins binary"
_ERRORS = -1


@dataclass(frozen=True)
class Boosting:
    """How a model grows.  ``growth``: "level" splits all nodes of a level, "leaf" the node of the greatest gain until
    there are ``max_leaves``, "same" all nodes of a level by one common cut."""

    rounds: int
    learning_rate: float
    growth: str = "level"
    max_depth: int | None = 6
    max_leaves: int | None = None
    least_rows: int = 1
    l1: float = 0.0
    l2: float = 1.0
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; node 0 is the root, a leaf has feature -1.  Bins up to ``bin`` go left."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each column of ``codes`` (features x rows)."""
        n = codes.shape[1]
        inner, itself = self.feature >= 0, np.arange(len(self.feature))
        # all rows go down together; a leaf leads to itself
        start = np.where(inner, self.feature, 0).astype(np.intp) * n
        to = np.stack([np.where(inner, self.left, itself), np.where(inner, self.right, itself)], 1).ravel().astype(np.intp)
        flat, place, node = codes.ravel(), np.arange(n), np.zeros(n, np.intp)
        while inner.take(node).any():
            node = to.take(2 * node + (flat.take(start.take(node) + place) > self.bin.take(node)))
        return node


@dataclass(frozen=True)
class BoostedModel:
    features: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree]
    # (mean absolute error, root of the mean squared error) on the validation rows after each round trained.
    errors: list[tuple[float, float]] = field(default_factory=list)

    def cut(self, rounds: int) -> BoostedModel:
        return replace(self, trees=self.trees[:rounds])

    def codes(self, values: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, values)]).astype(np.uint8)

    def margins(self, values: list[np.ndarray]) -> np.ndarray:
        codes = self.codes(values)
        out = np.full(codes.shape[1], self.base)
        for tree in self.trees:
            out += tree.value[tree.leaves(codes)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``."""
        model = self

        @F.pandas_udf("double")
        def predicted(*columns: pd.Series) -> pd.Series:
            return pd.Series(model.margins([c.to_numpy(np.float64, na_value=np.nan) for c in columns]))

        return df.withColumn("prediction", predicted(*[F.col(f).cast("double") for f in self.features]))

    def of_array(self, values: Column) -> Column:
        """The prediction for an array of the feature values."""
        model = self

        @F.pandas_udf("double")
        def predicted(rows: pd.Series) -> pd.Series:
            return pd.Series(model.margins(list(np.stack(rows.to_numpy()).astype(np.float64).T)) if len(rows) else [],
                             dtype=np.float64)

        return predicted(values)

    def importances(self) -> np.ndarray:
        """Mean gain of a feature's cuts, as shares of their sum."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(count, tree.feature[inner], 1)
        mean = total / np.maximum(count, 1)
        return mean / mean.sum() if mean.sum() else mean

    def round_errors(self, df: DataFrame, target: str) -> DataFrame:
        """(round, mae, rmse) of the model cut after each round, in one pass over the rows."""
        model = self

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                codes, gap = model.codes(values[:-1]), model.base - values[-1]
                out = []
                for tree in model.trees:
                    gap = gap + tree.value[tree.leaves(codes)]
                    out.append((np.abs(gap).sum(), (gap * gap).sum()))
                absolute, squared = (np.array(x) for x in zip(*out)) if out else (np.zeros(0), np.zeros(0))
                yield pa.record_batch({
                    "round": pa.array(np.arange(1, len(out) + 1, dtype=np.int32)), "absolute": absolute,
                    "squared": squared, "n": pa.array(np.full(len(out), batch.num_rows, np.int64))})

        wanted = df.filter(F.col(target).isNotNull()).select(*[F.col(c).cast("double") for c in [*self.features, target]])
        each = wanted.mapInArrow(sums, "round int, absolute double, squared double, n bigint")
        return each.groupBy("round").agg((F.sum("absolute") / F.sum("n")).alias("mae"),
                                         F.sqrt(F.sum("squared") / F.sum("n")).alias("rmse")).orderBy("round")

    def tree_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: (tree, node, feature, threshold, left, right, value, rows, gain)."""
        out = []
        for k, t in enumerate(self.trees):
            for i, f in enumerate(t.feature.tolist()):
                cut = float(self.cuts[f][t.bin[i]]) if f >= 0 else None
                out.append((k, i, self.features[f] if f >= 0 else None, cut, int(t.bin[i]), int(t.left[i]), int(t.right[i]),
                            float(t.value[i]), int(t.rows[i]), float(t.gain[i])))
        return spark.createDataFrame(out, "tree int, node int, feature string, threshold double, bin int, left int, "
                                          "right int, value double, rows bigint, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        head = json.dumps({"features": self.features, "cuts": [c.tolist() for c in self.cuts], "base": self.base,
                           "errors": self.errors})
        self.tree_table(spark).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(head,)], "head string").write.mode("overwrite").parquet(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        head = json.loads(spark.read.parquet(f"{path}/head").first()["head"])
        nodes = spark.read.parquet(f"{path}/trees").orderBy("tree", "node").toPandas()
        place = {f: i for i, f in enumerate(head["features"])}
        trees = [Tree(t["feature"].map(lambda f: place.get(f, -1)).to_numpy(np.int16), t["bin"].to_numpy(np.int16),
                      *(t[c].to_numpy(np.int32) for c in ("left", "right")), t["value"].to_numpy(), t["rows"].to_numpy(),
                      t["gain"].to_numpy()) for _, t in nodes.groupby("tree")]
        return BoostedModel(head["features"], [np.array(c) for c in head["cuts"]], head["base"], trees,
                            [tuple(e) for e in head["errors"]])


# ---- cuts of one feature

def _pull(grad, l1: float):
    """The gradient sum drawn towards nought by ``l1``."""
    if not l1:
        return grad
    return np.sign(grad) * np.maximum(np.abs(grad) - l1, 0.0)


def _score(grad, rows, p: Boosting):
    return _pull(grad, p.l1) ** 2 / np.maximum(rows + p.l2, 1e-300)


def _value(grad: float, rows: int, p: Boosting) -> float:
    return float(-p.learning_rate * _pull(grad, p.l1) / max(rows + p.l2, 1e-300))


def gains(grad: np.ndarray, rows: np.ndarray, p: Boosting) -> np.ndarray:
    """Gain of cutting each node (first axis) behind each bin but the last; 0 where a side has too few rows."""
    left, below = grad.cumsum(axis=1), rows.cumsum(axis=1)
    total, n = left[:, -1:], below[:, -1:]
    left, below = left[:, :-1], below[:, :-1]
    gain = _score(left, below, p) + _score(total - left, n - below, p) - _score(total, n, p)
    return np.where(np.minimum(below, n - below) >= p.least_rows, np.maximum(gain, 0.0), 0.0)


def _best_cuts(model: int, feature: int, grad: np.ndarray, rows: np.ndarray, p: Boosting) -> pa.RecordBatch:
    gain = gains(grad, rows, p)
    slots = np.arange(len(grad))
    if p.growth == "same":
        gain = gain.sum(axis=0)
        at = np.full(len(grad), gain.astype(np.float32).argmax())
        top = gain[at]
    else:
        at = gain.astype(np.float32).argmax(axis=1)
        top = gain[slots, at]
    left, below = grad.cumsum(axis=1), rows.cumsum(axis=1)
    return pa.record_batch({
        "model": pa.array(np.full(len(grad), model, np.int32)), "feature": pa.array(np.full(len(grad), feature, np.int32)),
        "slot": pa.array(slots.astype(np.int32)), "bin": pa.array(at.astype(np.int32)), "gain": top,
        "left_grad": left[slots, at], "left_rows": below[slots, at], "grad": left[:, -1], "rows": below[:, -1]})


# ---- rows

def cut_points(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins`` - 1 cut points per feature, near its quantiles, from one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    found = df.agg(*[F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), shares, 10_000)
                     .alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(c if c is not None else [], np.float64)) for c in found]


def _packed(df: DataFrame, features: list[str], target: str, role: str, cuts: list[np.ndarray], bases: list[float],
            starts: list[list[Tree]]) -> DataFrame:
    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        values = [c.to_numpy() for c in pa.Table.from_batches(batches).columns]
        n = len(features)
        codes = np.stack([np.searchsorted(c, v, side="left").astype(np.uint8) for c, v in zip(cuts, values[:n])])
        margins = np.repeat(np.array(bases)[:, None], codes.shape[1], axis=1)
        for m, trees in enumerate(starts):
            for tree in trees:
                margins[m] += tree.value[tree.leaves(codes)]
        return pa.record_batch({
            name: pa.array([a.tobytes()], pa.binary()) for name, a in (
                ("codes", codes), ("target", values[n]), ("role", values[n + 1].astype(np.int16)),
                ("hash", values[n + 2].astype(np.int64)), ("margins", margins))})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield block(held)
                held, rows = [], 0
        if rows:
            yield block(held)

    wanted = df.filter(F.col(target).isNotNull() & F.col(role).isNotNull()).select(
        *[F.col(f).cast("double") for f in features], F.col(target).cast("double").alias("_target"),
        F.col(role).cast("int").alias("_role"), F.xxhash64(*features, target).alias("_hash"))
    return wanted.mapInArrow(pack, _BLOCK)


def _unpacked(batch: pa.RecordBatch, n_features: int) -> Iterator[tuple]:
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i].as_buffer() for name in batch.schema.names}
        target = np.frombuffer(row["target"], np.float64)
        yield (np.frombuffer(row["codes"], np.uint8).reshape(n_features, len(target)), target,
               np.frombuffer(row["role"], np.int16), np.frombuffer(row["hash"], np.int64).view(np.uint64),
               np.frombuffer(row["margins"], np.float64).reshape(-1, len(target)))


def _chosen(hashes: np.ndarray, share: float, seed: int, round_: int) -> np.ndarray:
    """A share of the rows by a hash of row and round, so that a repeated task takes the same ones."""
    if share >= 1.0:
        return np.ones(len(hashes), bool)
    x = hashes ^ np.uint64((seed * 1_000_003 + round_) * 0x9E3779B97F4A7C15 % (1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x >> np.uint64(11)).astype(np.float64) < share * (1 << 53)


# ---- one tree

class _Growing:
    """A tree while it grows.  The best cut of a node depends on its own rows only, so nodes are also opened ahead of
    the order in which "leaf" growth takes them: the result is that of taking them one by one."""

    def __init__(self, preset: Boosting, columns: np.ndarray, round_: int):
        self.preset, self.columns, self.round = preset, columns, round_
        self.feature, self.bin, self.left, self.right = [-1], [0], [-1], [-1]
        self.grad, self.rows, self.gain, self.depth = [0.0], [0], [0.0], [0]
        self.seen: set[int] = set()
        self.open = [0]

    def _split(self, node: int, feature: int, bin_: int, gain: float, left_grad: float, left_rows: int) -> None:
        self.feature[node], self.bin[node], self.gain[node] = feature, bin_, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for grad, rows in ((left_grad, left_rows), (self.grad[node] - left_grad, self.rows[node] - left_rows)):
            for held, value in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.grad, grad),
                                (self.rows, rows), (self.gain, 0.0), (self.depth, self.depth[node] + 1)):
                held.append(value)

    def take(self, found: list) -> None:
        """Split the open nodes by the best of the cuts found, and name the nodes to open next."""
        best: dict[int, tuple] = {}
        for r in sorted(found, key=lambda r: (-float(np.float32(r["gain"])), r["feature"])):
            best.setdefault(r["slot"], r)
        last = len(self.feature)
        for slot, node in enumerate(self.open):
            self.seen.add(node)
            r = best.get(slot)
            if r is None:
                continue
            self.grad[node], self.rows[node] = (r["grad"], r["rows"]) if node == 0 else (self.grad[node], self.rows[node])
            if r["gain"] > 0:
                self._split(node, r["feature"], r["bin"], r["gain"], r["left_grad"], r["left_rows"])
        fresh = [k for k in range(last, len(self.feature)) if self._may_split(k)]
        self.seen.update(k for k in range(last, len(self.feature)) if not self._may_split(k))
        self.open = self._missing() if self.preset.growth == "leaf" else fresh

    def _may_split(self, node: int) -> bool:
        limit = self.preset.max_depth
        return limit is None or self.depth[node] < limit

    def _replay(self) -> tuple[set[int], list[int], bool]:
        """(nodes split so far in the order of their gains, the others that could be, whether more must be known)."""
        taken: set[int] = set()
        heap: list = []

        def push(node):
            if self.left[node] >= 0:
                heapq.heappush(heap, (-float(np.float32(self.gain[node])), node))

        push(0)
        while heap and len(taken) + 1 < (self.preset.max_leaves or 1 << 30):
            if any(c not in self.seen for n in taken for c in (self.left[n], self.right[n])):
                return taken, [n for _, n in heap], True
            node = heapq.heappop(heap)[1]
            taken.add(node)
            for child in (self.left[node], self.right[node]):
                push(child)
        return taken, [n for _, n in heap], bool(len(taken) + 1 < (self.preset.max_leaves or 1 << 30) and any(
            c not in self.seen for n in taken for c in (self.left[n], self.right[n])))

    def _missing(self) -> list[int]:
        taken, waiting, more = self._replay()
        if not more:
            return []
        return sorted({c for n in [*taken, *waiting] for c in (self.left[n], self.right[n]) if c not in self.seen})

    def arrays(self) -> Tree:
        return Tree(np.array(self.feature, np.int16), np.array(self.bin, np.int16), np.array(self.left, np.int32),
                    np.array(self.right, np.int32), np.zeros(len(self.feature)), np.array(self.rows), np.array(self.gain))

    def finished(self) -> Tree:
        kept = self._replay()[0] if self.preset.growth == "leaf" else {n for n, c in enumerate(self.left) if c >= 0}
        order, k = [0], 0
        while k < len(order):
            if order[k] in kept:
                order += [self.left[order[k]], self.right[order[k]]]
            k += 1
        place = {n: i for i, n in enumerate(order)}

        def of(held, kind, rest):
            return np.array([held[n] if n in kept else rest for n in order], kind)

        return Tree(of(self.feature, np.int16, -1), of(self.bin, np.int16, 0),
                    np.array([place[self.left[n]] if n in kept else -1 for n in order], np.int32),
                    np.array([place[self.right[n]] if n in kept else -1 for n in order], np.int32),
                    np.array([0.0 if n in kept else _value(self.grad[n], self.rows[n], self.preset) for n in order]),
                    np.array([self.rows[n] for n in order], np.int64), of(self.gain, np.float64, 0.0))


# ---- jobs

def _level(blocks: DataFrame, n_features: int, tasks: list[Task], pending: list[list[Tree]],
           growing: dict[int, _Growing], errors: set[int]) -> list:
    """Best cuts of all open nodes, and error sums of the models in ``errors``: nodes x features rows."""
    shapes = {m: (g.arrays(), g.open, g.columns, g.round) for m, g in growing.items()}

    def gaps(m: int, rows: np.ndarray, own: np.ndarray, target: np.ndarray, margins: np.ndarray) -> np.ndarray:
        """Margin less target of the rows, whose codes are ``own``."""
        gap = margins[m].take(rows) - target.take(rows)
        for tree in pending[m]:
            gap += tree.value.take(tree.leaves(own))
        return gap

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grads = {m: np.zeros((len(c), len(o), BINS + 1)) for m, (_, o, c, _) in shapes.items()}
        counts = {m: np.zeros(g.shape, np.int64) for m, g in grads.items()}
        missed = {m: np.zeros(3) for m in errors}
        for batch in batches:
            for codes, target, role, hashes, margins in _unpacked(batch, n_features):
                for m in {*shapes, *errors}:
                    if m in errors:
                        rows = np.flatnonzero(role == tasks[m].valid_at)
                        held = gaps(m, rows, codes.take(rows, axis=1), target, margins)
                        missed[m] += np.abs(held).sum(), (held * held).sum(), len(held)
                    if m in shapes:
                        tree, opened, columns, round_ = shapes[m]
                        p = tasks[m].preset
                        rows = np.flatnonzero((role < tasks[m].train_below) & _chosen(hashes, p.row_share, p.seed, round_))
                        own = codes.take(rows, axis=1)
                        slot_of = np.full(len(tree.feature), -1)
                        slot_of[opened] = np.arange(len(opened))
                        slot = slot_of.take(tree.leaves(own))
                        within = np.flatnonzero(slot >= 0)
                        if len(within) < len(rows):
                            rows, own, slot = rows.take(within), own.take(within, axis=1), slot.take(within)
                        gap = gaps(m, rows, own, target, margins)
                        first, size = slot * (BINS + 1), len(opened) * (BINS + 1)
                        for k, column in enumerate(columns):
                            cell = first + own[column]
                            grads[m][k] += np.bincount(cell, gap, size).reshape(len(opened), -1)
                            counts[m][k] += np.bincount(cell, minlength=size).reshape(len(opened), -1)
        for m, sums in missed.items():
            yield _rows(m, [_ERRORS], [(np.arange(3), sums, np.zeros(3, np.int64))])
        for m, grad in grads.items():
            used = [np.flatnonzero(c) for c in counts[m]]
            yield _rows(m, shapes[m][2], [(u, g.ravel()[u], c.ravel()[u]) for u, g, c in zip(used, grad, counts[m])])

    presets = [t.preset for t in tasks]
    opened_by = {m: len(g.open) for m, g in growing.items()}

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, feature = key[0].as_py(), key[1].as_py()
        size = 3 if feature == _ERRORS else opened_by[model] * (BINS + 1)
        grad, rows = np.zeros(size), np.zeros(size, np.int64)
        for batch in batches:
            for u, g, n in zip(batch.column("cells"), batch.column("grad"), batch.column("rows")):
                at = np.frombuffer(u.as_buffer(), np.int32)
                grad[at] += np.frombuffer(g.as_buffer(), np.float64)
                rows[at] += np.frombuffer(n.as_buffer(), np.int64)
        if feature == _ERRORS:
            yield pa.record_batch({
                **{c: pa.array([v], pa.int32()) for c, v in (("model", model), ("feature", feature), ("slot", 0), ("bin", 0))},
                "gain": [0.0], "left_grad": [float(grad[0])], "left_rows": pa.array([0], pa.int64()),
                "grad": [float(grad[1])], "rows": pa.array([int(grad[2])], pa.int64())})
        else:
            yield _best_cuts(model, feature, grad.reshape(-1, BINS + 1), rows.reshape(-1, BINS + 1), presets[model])

    sums = blocks.mapInArrow(histograms, _HISTOGRAM)
    return sums.groupBy("model", "feature").applyInArrow(merge, _BEST).collect()


def _rows(model: int, features, arrays: list[tuple]) -> pa.RecordBatch:
    """One row per feature: places, gradient sums and row counts of its cells."""
    return pa.record_batch({
        "model": pa.array([model] * len(arrays), pa.int32()), "feature": pa.array([int(f) for f in features], pa.int32()),
        "cells": pa.array([a.astype(np.int32).tobytes() for a, _, _ in arrays], pa.binary()),
        "grad": pa.array([g.tobytes() for _, g, _ in arrays], pa.binary()),
        "rows": pa.array([n.tobytes() for _, _, n in arrays], pa.binary())})


def _advanced(blocks: DataFrame, n_features: int, pending: list[list[Tree]]) -> DataFrame:
    """The blocks with the margins after the pending trees."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes, *_, margins in _unpacked(batch, n_features):
                margins = margins.copy()
                for m, trees in enumerate(pending):
                    for tree in trees:
                        margins[m] += tree.value[tree.leaves(codes)]
                out.append(margins.tobytes())
            yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array(out, pa.binary()))

    return blocks.mapInArrow(move, _BLOCK)


# ---- training

@dataclass(frozen=True)
class Task:
    """One model: it learns from rows whose role is below ``train_below`` and is watched on those of ``valid_at``."""

    preset: Boosting
    train_below: int = 1
    valid_at: int | None = None


def best_round(errors: list[float], patience: int = PATIENCE) -> int:
    """The 1-based round with the lowest error before ``patience`` rounds pass without a lower one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_side_by_side(df: DataFrame, features: list[str], target: str, role: str, tasks: list[Task],
                     patience: int = PATIENCE, cuts: list[np.ndarray] | None = None,
                     start: list[BoostedModel] | None = None, cut: bool = True, keep_trees: bool = True) -> list[BoostedModel]:
    """One model per task, all on the same blocks; SIDE_BY_SIDE of them share each job, or each has a task of its own.

    A watched model ends when its mean absolute error has not fallen for ``patience`` rounds and is cut after its best
    round (not with ``cut`` False); without ``valid_at`` it runs through.  ``start`` resumes models of the same task: their rounds count, and the
    result equals that of an uninterrupted run.  Without ``keep_trees`` the models hold only their errors.
    """
    cuts = start[0].cuts if start else cut_points(df, features) if cuts is None else cuts
    sums = {r["role"]: (r["total"], r["n"]) for r in df.filter(F.col(target).isNotNull()).groupBy(
        F.col(role).cast("int").alias("role")).agg(F.sum(F.col(target).cast("double")).alias("total"),
                                                   F.count(F.lit(1)).alias("n")).collect() if r["role"] is not None}
    step = len(tasks) if sum(n for _, n in sums.values()) <= TASK_ROWS else SIDE_BY_SIDE
    out: list[BoostedModel] = []
    for i in range(0, len(tasks), step):
        out += _fit(df, features, target, role, tasks[i:i + step], patience, cuts, start[i:i + step] if start else None,
                    sums, keep_trees)
    return [m.cut(best_round([e for e, _ in m.errors], patience)) if cut and m.errors else m for m in out]


def _fit(df, features, target, role, tasks, patience, cuts, start, sums, keep_trees) -> list[BoostedModel]:
    spark = df.sparkSession
    if start:
        bases = [s.base for s in start]
    else:
        own = [[v for r, v in sums.items() if r < t.train_below] for t in tasks]
        bases = [sum(t for t, _ in v) / sum(n for _, n in v) if v else 0.0 for v in own]
    trees: list[list[Tree | None]] = [list(s.trees) for s in start] if start else [[] for _ in tasks]
    errors: list[list[tuple[float, float]]] = [list(s.errors[:len(s.trees)]) for s in start] if start else [[] for _ in tasks]
    running = {m for m, t in enumerate(tasks) if any(n for r, (_, n) in sums.items() if r < t.train_below)}
    watched = {m for m, t in enumerate(tasks) if t.valid_at is not None and sums.get(t.valid_at)}
    alone = sum(n for _, n in sums.values()) <= TASK_ROWS
    path = shared_folder(spark, "boosting")
    # a task that grows a model alone works its margins out
    _packed(df, features, target, role, cuts, [] if alone else bases, [] if alone else trees).write.parquet(path)
    blocks = spark.read.schema(_BLOCK).parquet(path)
    if alone:
        _grow_in_tasks(blocks, len(features), tasks, bases, trees, errors, running, watched, patience, keep_trees)
    else:
        pending: list[list[Tree]] = [[] for _ in tasks]

        def level(live: dict[int, _Growing], watch: set[int]) -> list:
            return _level(blocks, len(features), tasks, pending, live, watch)

        def grown(fresh: dict[int, Tree], more: bool) -> None:
            nonlocal path, blocks, pending
            for m, tree in fresh.items():
                pending[m].append(tree)
            if more and max(len(p) for p in pending) >= KEPT_ROUNDS:
                newer = shared_folder(spark, "boosting")
                _advanced(blocks, len(features), pending).write.parquet(newer)
                drop_folder(spark, path)
                path, blocks, pending = newer, spark.read.schema(_BLOCK).parquet(newer), [[] for _ in tasks]

        _grow(len(features), tasks, trees, errors, running, watched, patience, keep_trees, level, grown)
    drop_folder(spark, path)
    return [BoostedModel(list(features), cuts, float(bases[m]), [t for t in trees[m] if t is not None], errors[m])
            for m in range(len(tasks))]


def _grow(n_features: int, tasks: list[Task], trees: list[list[Tree | None]], errors: list[list[tuple[float, float]]],
          running: set[int], watched: set[int], patience: int, keep_trees: bool,
          level: Callable[[dict[int, _Growing], set[int]], list], grown: Callable[[dict[int, Tree], bool], None]) -> None:
    """Add rounds to ``trees`` and ``errors`` until no model runs.  ``level`` finds the best cuts of all open nodes and
    the error sums of models; ``grown`` takes in the trees of a round, and hears whether more follow."""
    while running:
        # a model that has all its rounds still wants the error of the last one
        watch = {m for m in running & watched if len(errors[m]) < len(trees[m])}
        growing = {m: _Growing(tasks[m].preset, _columns(tasks[m].preset, n_features, len(trees[m])), len(trees[m]))
                   for m in running if len(trees[m]) < tasks[m].preset.rounds}
        while watch or any(g.open for g in growing.values()):
            live = {m: g for m, g in growing.items() if g.open}
            found = level(live, watch)
            for r in found:
                if r["feature"] == _ERRORS:
                    errors[r["model"]].append((r["left_grad"] / r["rows"], (r["grad"] / r["rows"]) ** 0.5))
            for m in watch:
                if len(errors[m]) - best_round([e for e, _ in errors[m]], len(errors[m])) >= patience:
                    running.discard(m)
                    growing.pop(m, None)
                    live.pop(m, None)
            watch = set()
            for m, g in live.items():
                g.take([r for r in found if r["model"] == m and r["feature"] != _ERRORS])
        fresh: dict[int, Tree] = {}
        for m in list(running):
            if m not in growing:
                running.discard(m)
                continue
            fresh[m] = growing[m].finished()
            trees[m].append(fresh[m] if keep_trees else None)
            if len(trees[m]) >= tasks[m].preset.rounds and tasks[m].valid_at is None:
                running.discard(m)
        grown(fresh, bool(running))


class _Held:
    """The rows of one model in one task: what jobs over all blocks do, without jobs."""

    def __init__(self, blocks: list[tuple], task: Task, base: float, trees: list[Tree]):
        used = [np.flatnonzero((b[2] < task.train_below) | (b[2] == task.valid_at)) for b in blocks]

        def of(i: int) -> np.ndarray:
            return np.concatenate([b[i].take(u) for b, u in zip(blocks, used)])

        self.codes = np.concatenate([b[0].take(u, axis=1) for b, u in zip(blocks, used)], axis=1)
        role, self.hashes, self.preset = of(2), of(3), task.preset
        self.gap = base - of(1)
        self.train, self.valid = np.flatnonzero(role < task.train_below), np.flatnonzero(role == task.valid_at)
        for tree in trees:
            self._move(tree)

    def _slices(self, n: int) -> Iterator[slice]:
        return (slice(at, at + BLOCK_ROWS) for at in range(0, n, BLOCK_ROWS))

    def _move(self, tree: Tree) -> None:
        for s in self._slices(len(self.gap)):
            self.gap[s] += tree.value.take(tree.leaves(np.ascontiguousarray(self.codes[:, s])))

    def grown(self, fresh: dict[int, Tree], more: bool) -> None:
        for tree in fresh.values():
            self._move(tree)

    def level(self, live: dict[int, _Growing], watch: set[int]) -> list:
        out = []
        if watch:
            held = self.gap.take(self.valid)
            out.append({"model": 0, "feature": _ERRORS, "left_grad": float(np.abs(held).sum()),
                        "grad": float((held * held).sum()), "rows": len(held)})
        return out + self._best(live[0]) if live else out

    def _best(self, g: _Growing) -> list:
        """The best cut of each open node."""
        tree, p = g.arrays(), g.preset
        if len(tree.feature) == 1:
            rows = self.train[_chosen(self.hashes.take(self.train), p.row_share, p.seed, g.round)]
            self.own, self.own_gap = self.codes[g.columns].take(rows, axis=1), self.gap.take(rows)
            self.node = np.zeros(len(rows), np.intp)
        n, place = len(self.node), np.zeros(self.codes.shape[0] + 1, np.intp)
        place[g.columns] = np.arange(len(g.columns))
        slot_of = np.full(len(tree.feature), -1)
        slot_of[g.open] = np.arange(len(g.open))
        inner, column = tree.feature >= 0, place[tree.feature]
        grad = np.zeros((len(g.columns), len(g.open), BINS + 1))
        rows = np.zeros(grad.shape, np.int64)
        size = len(g.open) * (BINS + 1)
        for s in self._slices(n):
            node, own = self.node[s], np.ascontiguousarray(self.own[:, s])
            # cuts are one level deep since the rows were moved last
            down = np.flatnonzero(inner.take(node))
            at = node.take(down)
            code = own.ravel().take(column.take(at) * own.shape[1] + down)
            node[down] = np.where(code > tree.bin.take(at), tree.right.take(at), tree.left.take(at))
            slot, gap = slot_of.take(node), self.own_gap[s]
            within = np.flatnonzero(slot >= 0)
            if len(within) < len(slot):
                own, slot, gap = own.take(within, axis=1), slot.take(within), gap.take(within)
            first = slot * (BINS + 1)
            for k in range(len(own)):
                cell = first + own[k]
                grad[k] += np.bincount(cell, gap, size).reshape(len(g.open), -1)
                rows[k] += np.bincount(cell, minlength=size).reshape(len(g.open), -1)
        found = [_best_cuts(0, int(f), grad[k], rows[k], p) for k, f in enumerate(g.columns)]
        best = np.stack([b.column("gain").to_numpy() for b in found]).astype(np.float32).argmax(axis=0)
        return [found[k].slice(i, 1).to_pylist()[0] for i, k in enumerate(best.tolist())]


def _grow_in_tasks(blocks: DataFrame, n_features: int, tasks: list[Task], bases: list[float], trees: list[list[Tree | None]],
                   errors: list[list[tuple[float, float]]], running: set[int], watched: set[int], patience: int,
                   keep_trees: bool) -> None:
    """``_grow``, each model in one task that holds all blocks."""
    models = sorted(running)
    if not models:
        return

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition has one model
        held, model = [], None
        for batch in batches:
            model = models[batch.column("id")[0].as_py()]
            held += _unpacked(batch.drop_columns(["id"]), n_features)
        if model is None:
            return
        task, own, missed = tasks[model], list(trees[model]), list(errors[model])
        rows = _Held(held, task, bases[model], own)
        del held
        _grow(n_features, [task], [own], [missed], {0}, {0} if model in watched else set(), patience, keep_trees, rows.level,
              rows.grown)
        yield pa.record_batch({"model": pa.array([model], pa.int32()), "grown": pa.array([pickle.dumps((own, missed))], pa.binary())})

    every = blocks.sparkSession.range(0, len(models), 1, len(models)).join(F.broadcast(blocks), how="cross")
    for r in every.mapInArrow(fit, "model int, grown binary").collect():
        trees[r["model"]], errors[r["model"]] = pickle.loads(r["grown"])


def _columns(p: Boosting, n: int, round_: int) -> np.ndarray:
    """The features a tree may cut by."""
    if p.column_share >= 1.0:
        return np.arange(n)
    return np.sort(np.random.default_rng([p.seed, round_]).permutation(n)[:max(1, round(n * p.column_share))])


def split_table(df: DataFrame, feature: str, target: str, cuts: list[float], p: Boosting) -> DataFrame:
    """(threshold, left_rows, left_grad, gain) of every cut of one feature at the root, before any round."""
    edges = np.unique(np.array(cuts, np.float64))
    values = df.filter(F.col(target).isNotNull()).select(F.col(feature).cast("double").alias("x"),
                                                         F.col(target).cast("double").alias("y"))
    mean = values.agg(F.avg("y")).scalar()
    bin_ = sum([F.when(F.col("x") > float(e), 1).otherwise(0) for e in edges], F.lit(0))
    cells = values.withColumn("g", mean - F.col("y")).groupBy(
        F.when(F.col("x").isNull(), len(edges)).otherwise(bin_).alias("bin")).agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n"))
    grad, rows = np.zeros((1, len(edges) + 1)), np.zeros((1, len(edges) + 1), np.int64)
    for r in cells.collect():  # one row per bin
        grad[0, r["bin"]], rows[0, r["bin"]] = r["g"], r["n"]
    out = zip(edges.tolist(), rows.cumsum(axis=1)[0].tolist(), grad.cumsum(axis=1)[0].tolist(), gains(grad, rows, p)[0].tolist())
    return df.sparkSession.createDataFrame(list(out), "threshold double, left_rows bigint, left_grad double, gain double")
