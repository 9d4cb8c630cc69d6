"""Gradient boosted regression trees, many models at once: folds, candidates, robust losses, level-wise and leaf-wise growth.

Rows become blocks of bin numbers, staged once for all models. Models that are trained together share every pass over the blocks: one
aggregation a level over (model, feature, node, bin) in which tasks add up their blocks, the sums of a model's feature meet in one
task, and that task finds the best split of each node; the driver sees one line for each model and feature. Predictions of finished trees are
staged with the blocks every few trees, so a lost executor costs one pass.

A table of at most ``LOCAL_ROWS`` rows needs no passes: its bins are broadcast, a few dozen megabytes at most, and each model is one task's
work by the same functions. Larger ones never leave their blocks. Candidates that differ in the number of trees are one model, scored at
several numbers, and those whose settings cannot tell their trees apart are trained once.

Under the squared loss rows that lie in the same bins, a cell, are told apart by nothing but their sums. If a larger table has no more than ``CELLS`` of
them, its rows are dealt out by ranges of (cell, digest) once, tasks sum the sample of every tree by cell, and the sums of all trees of a model stream
through the task that grows them: one exchange for a whole model, whatever the number of rows. Models under the other losses that hold nothing out take two passes
a tree there. Otherwise there is a pass a level.

Bins end at exact quantiles of the training rows. Gaps are filled with the mean. Rows are drawn for a tree by a hash of their key.
"""

from __future__ import annotations

import functools
import json
import math
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tallyward.operators import tree_growth as growth
from tallyward.operators.order_stats import column_quantiles, quantile_rows
from tallyward.operators.staging import released, stage
from tallyward.operators.tree_growth import SUMS, LocalCells, LocalRows, Settings, Stacked, Tree

MAX_BINS = 32
#: Rows that one task can train on: 40 bytes or so each are broadcast.
LOCAL_ROWS = 1 << 20
BLOCK_ROWS = 1 << 16
#: Cells that one task can train on, and rows that one task sums by cell.
CELLS, CELL_ROWS = 1 << 17, 1 << 18
#: Models that share the passes over larger tables, and trees after which their predictions are staged.
TOGETHER = 64
STAGED_TREES = 10
#: Rows that walk down the trees together, so that what they need stays close to the processor.
_WALKED = 1 << 14
#: Sums of a pass that go to the driver as they are; larger ones meet in tasks first.
DIRECT_BYTES = 1 << 24
#: Rows that tell the driver about where quantiles lie, and how many standard errors around them are looked at first.
KNOWN_ROWS, _ERRORS = 1 << 17, 3.0
#: What is known of held-out rows: number, loss, and the sums that r2 needs.
STATS = 5


@dataclass
class Binning:
    """Bins of all features: ends of the bins (a value up to the end lies inside), and what fills gaps."""

    features: list[str]
    edges: list[list[float]]
    means: list[float]

    @property
    def starts(self) -> np.ndarray:
        """The first code of each feature."""
        sizes = [len(e) + 1 for e in self.edges]
        return np.cumsum([0, *sizes[:-1]])

    @property
    def total(self) -> int:
        return sum(len(e) + 1 for e in self.edges)

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bin numbers, a line a feature."""
        out = np.empty((len(columns), len(columns[0]) if columns else 0), np.uint8)
        for i, x in enumerate(columns):
            x = np.asarray(x, np.float64)
            out[i] = np.searchsorted(np.array(self.edges[i]), np.where(np.isnan(x), self.means[i], x))
        return out

    def codes(self, bins: np.ndarray) -> np.ndarray:
        return bins.astype(np.int32) + self.starts[:, None].astype(np.int32)


def find_bins(rows: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> Binning:
    """Bins that hold about as many rows each, by exact quantiles; a column without values has one bin."""
    if not 2 <= max_bins <= 256:
        raise ValueError("there are between 2 and 256 bins")
    found = column_quantiles(rows, features, [i / max_bins for i in range(1, max_bins)], cheap=True)
    means = rows.agg(*[F.avg(F.when(F.col(c) <= float("inf"), F.col(c))).alias(c) for c in features]).first()
    return Binning(list(features), [sorted({float(v) for v in found[c] if v is not None}) for c in features],
                   [0.0 if means[c] is None else float(means[c]) for c in features])


@dataclass
class Blocks:
    """Binned rows in a staged table."""

    df: DataFrame
    binning: Binning
    rows: int
    weighted: bool


def make_blocks(rows: DataFrame, features: list[str], key: str, label: str = "label", fold: Column | None = None,
                weight: str | None = None, max_bins: int = MAX_BINS, binning: Binning | None = None, bins_of: Column | None = None) -> Blocks:
    """Stage ``rows`` as blocks. ``fold`` numbers the parts that models hold out; bins come from the rows of ``bins_of``.

    Rows whose label is NULL or NaN are left out, and so are rows of weight NULL, NaN, 0 or less.
    """
    rows = rows.where(F.col(label) <= float("inf"))
    if weight:
        rows = rows.where((F.col(weight) > 0) & (F.col(weight) <= float("inf")))
    binning = binning or find_bins(rows if bins_of is None else rows.where(bins_of), features, max_bins)
    names = [f"f{i}" for i in range(len(features))]
    flat = rows.select(
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)], F.col(label).cast("double").alias("label"),
        (F.lit(0) if fold is None else F.coalesce(fold, F.lit(-1))).cast("int").alias("fold"), F.xxhash64(key).alias("digest"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"))

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    def packed(batches):
        table = pa.Table.from_batches(batches)
        columns = {c: table.column(c).to_numpy() for c in table.column_names}
        bins = binning.bins([columns[n] for n in names])
        values = [np.ascontiguousarray(columns[c]).tobytes() for c in ("label", "fold", "digest", "weight")]
        return pa.RecordBatch.from_arrays(
            [pa.array([table.num_rows], pa.int32()), *[pa.array([v], pa.binary()) for v in (bins.tobytes(), *values)]],
            ["n", "bins", "label", "fold", "digest", "weight"])

    schema = "n int, bins binary, label binary, fold binary, digest binary, weight binary"
    df = released(flat.mapInArrow(pack, schema), "blocks")
    return Blocks(df, binning, int(df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]), weight is not None)


def _arrays(row: dict, binning: Binning, weighted: bool):
    n = row["n"]
    bins = np.frombuffer(row["bins"], np.uint8).reshape(len(binning.features), n)
    rows = LocalRows(binning.codes(bins), binning.starts, binning.total, np.frombuffer(row["label"], np.float64),
                     np.frombuffer(row["weight"], np.float64) if weighted else None, np.frombuffer(row["digest"], np.uint64))
    return rows, np.frombuffer(row["fold"], np.int32)


@dataclass(frozen=True)
class Unit:
    """One model to train: its settings, the part it holds out (None for none) and the numbers of trees at which it is scored on that."""

    settings: Settings
    held: int | None = None
    points: tuple[int, ...] = ()


@dataclass
class Fitted:
    """What became of a unit: begin, trees, and per number of trees (rows, loss, sum, sum of squares, squared error) of the held-out part."""

    begin: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    stats: dict[int, np.ndarray] = field(default_factory=dict)


def _stats(label: np.ndarray, margin: np.ndarray, settings: Settings, delta: float) -> np.ndarray:
    residual = label - margin
    return np.array([len(label), growth.loss_of(residual, settings, delta).sum(), label.sum(), (label * label).sum(), (residual * residual).sum()])


def r2_of(stats: np.ndarray) -> float | None:
    n, _, total, squares, error = stats.tolist()
    if n < 2:
        return None
    variance = squares - total * total / n
    return (1.0 if error == 0 else 0.0) if variance <= 1e-12 * max(squares, 1e-300) else 1 - error / variance


class _Stopper:
    """Ends a training whose held-out loss has not fallen by ``tol`` for some trees."""

    def __init__(self, settings: Settings):
        self.patience, self.tol, self.best, self.since = settings.n_iter_no_change, settings.tol, np.inf, 0

    def ends(self, stats: np.ndarray) -> bool:
        if self.patience is None or not stats[0]:
            return False
        loss = stats[1] / stats[0]
        if loss < self.best - self.tol:
            self.best, self.since = loss, 0
        else:
            self.since += 1
        return self.since >= self.patience


def _train_locally(rows: LocalRows, fold: np.ndarray, unit: Unit, keep: bool) -> Fitted:
    settings = unit.settings
    held = np.zeros(len(fold), bool) if unit.held is None else fold == unit.held
    used = ~held
    if not used.any():
        return Fitted()
    out = Fitted(rows.begin(settings, used))
    margin = np.full(len(fold), out.begin)
    stopper, watched = _Stopper(settings), settings.n_iter_no_change is not None
    for t in range(settings.n_estimators):
        tree, delta = rows.add_tree(settings, t, margin, used)
        if keep:
            out.trees.append(tree)
        if t + 1 in unit.points or watched:
            out.stats[t + 1] = _stats(rows.label[held], margin[held], settings, delta)
            if watched and stopper.ends(out.stats[t + 1]):
                break
    return out


_TREE = {"feature": np.int32, "code": np.int32, "left": np.int32, "value": np.float64, "gain": np.float64, "rows": np.float64}


def _to_json(out: Fitted) -> str:
    return json.dumps({"begin": out.begin, "stats": {k: v.tolist() for k, v in out.stats.items()},
                       "trees": [{c: getattr(t, c).tolist() for c in _TREE} for t in out.trees]})


def _from_json(text: str) -> Fitted:
    found = json.loads(text)
    return Fitted(found["begin"], [Tree(**{c: np.array(t[c], k) for c, k in _TREE.items()}) for t in found["trees"]],
                  {int(k): np.array(v) for k, v in found["stats"].items()})


_HELD: dict[str, tuple] = {}


def _fit_locally(blocks: Blocks, units: list[Unit], keep: bool) -> list[Fitted]:
    """A task for each unit. The driver and the tasks hold the bins of at most ``LOCAL_ROWS`` rows."""
    spark = blocks.df.sparkSession
    parts = [r.asDict() for r in blocks.df.collect()]
    joined = {"n": sum(p["n"] for p in parts), **{c: b"".join(p[c] for p in parts) for c in ("label", "fold", "digest", "weight")}}
    features = len(blocks.binning.features)
    joined["bins"] = b"".join(bytes(p["bins"][f * p["n"] : (f + 1) * p["n"]]) for f in range(features) for p in parts)
    sent, binning, weighted = spark.sparkContext.broadcast(joined), blocks.binning, blocks.weighted
    # The longest ones first.
    order = sorted(range(len(units)), key=lambda i: -units[i].settings.n_estimators * min(units[i].settings.max_depth or 99, units[i].settings.max_leaves or 99))
    name = uuid.uuid4().hex

    def run(batches):
        if name not in _HELD:
            _HELD.clear()
            _HELD[name] = _arrays(sent.value, binning, weighted)
        rows, fold = _HELD[name]
        for batch in batches:
            for place in batch.column(0).to_pylist():
                out = _train_locally(rows, fold, units[order[place]], keep)
                yield pa.RecordBatch.from_arrays([pa.array([order[place]], pa.int64()), pa.array([_to_json(out)], pa.large_string())], ["unit", "fitted"])

    found = spark.range(0, len(units), 1, max(1, len(units))).mapInArrow(run, "unit long, fitted string").collect()
    sent.unpersist()
    return [_from_json(text) for _, text in sorted(found)]


class _Training:
    """A unit on its way through the passes."""

    def __init__(self, model: int, unit: Unit, starts: np.ndarray):
        self.model, self.unit, self.starts = model, unit, starts
        self.out, self.recent = Fitted(), []
        self.stopper, self.number, self.delta, self.done = _Stopper(unit.settings), 0, 0.0, unit.settings.n_estimators == 0
        self.growth = self.ahead = None

    def task(self) -> dict:
        """What the tasks of a pass need to know of it."""
        place, partial = None, None
        if self.growth is not None:
            source = self.growth if self.ahead is None else self.ahead
            place, partial = np.full(len(source.feature), -1, np.int32), source.partial()
            place[source.wanted] = np.arange(len(source.wanted))
        return {"model": self.model, "settings": self.unit.settings, "held": self.unit.held, "begin": self.out.begin, "recent": self.recent, "number": self.number,
                "delta": self.delta, "partial": partial, "place": place}

    def start(self) -> None:
        self.growth = None if self.done else growth.Growth(self.unit.settings, self.number, self.starts)
        self.ahead = None if self.done or self.unit.settings.max_leaves is None else growth.Ahead()

    def close(self) -> None:
        """The tree is grown: what leaves are worth is asked of the tree itself."""
        self.ahead = None


def _margins(row: dict, task: dict, codes: np.ndarray) -> np.ndarray:
    n, m = row["n"], task["model"]
    margin = np.full(n, task["begin"]) if row.get("margins") is None else np.frombuffer(row["margins"], np.float64)[m * n : (m + 1) * n].copy()
    for tree in task["recent"]:
        margin += tree.value[tree.leaves(codes)]
    return margin


def _rows_of(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _each(blocks: Blocks, tasks: list[dict]):
    """For the tasks of a pass: calls ``fn`` with each model and block, its predictions and its held-out and used rows."""
    binning, weighted = blocks.binning, blocks.weighted

    def walk(batches, fn):
        for row in _rows_of(batches):
            rows, fold = _arrays(row, binning, weighted)
            for task in tasks:
                margin = _margins(row, task, rows.codes)
                held = np.zeros(len(fold), bool) if task["held"] is None else fold == task["held"]
                sample = growth.in_sample(rows.digests, task["settings"], task["number"])
                fn(task, rows, margin, held, ~held if sample is None else ~held & sample)

    return walk


def _summed(parts: DataFrame, finish, schema: str) -> DataFrame:
    """The sums of the payloads of each (model, feature), in one task each, handed to ``finish``."""

    def run(batches):
        key, total = None, None
        for row in _rows_of(batches):
            here, payload = (row["model"], row["feature"]), np.frombuffer(row["payload"], np.float64)
            if here != key:
                if key is not None:
                    yield finish(*key, total)
                key, total = here, payload.copy()
            else:
                total += payload
        if key is not None:
            yield finish(*key, total)

    dealt = parts.repartition("model", "feature").sortWithinPartitions("model", "feature", "part")
    return dealt.mapInArrow(run, schema)


_PART = "model int, feature int, part int, payload binary"


def _payloads(found: dict) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    keys = sorted(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([part] * len(keys), pa.int32()),
         pa.array([np.ascontiguousarray(found[k], np.float64).tobytes() for k in keys], pa.binary())], ["model", "feature", "part", "payload"])


def _add(found: dict, key: tuple, value: np.ndarray) -> None:
    found[key] = found[key] + value if key in found else value


def _sampled(blocks: Blocks, trainings: list[_Training]) -> DataFrame:
    """What a tree is grown from: a line for each block and model, with the bins, gradients and weights of its rows and what is known of held-out ones.

    It is kept in the executors for the passes over one tree, so that predictions, samples and gradients are worked out once a tree.
    """
    walk, weighted = _each(blocks, [t.task() for t in trainings if t.growth is not None]), blocks.weighted
    starts = blocks.binning.starts.astype(np.int32)[:, None]

    def run(batches):
        out = []

        def one(task, rows, margin, held, used):
            at = np.flatnonzero(used)
            gradient = growth.downhill((rows.label - margin)[at], task["settings"], task["delta"])
            weight = rows.weight[at] if weighted else None
            values = [(rows.codes[:, at] - starts).astype(np.uint8), gradient * weight if weighted else gradient, weight,
                      _stats(rows.label[held], margin[held], task["settings"], task["delta"])]
            out.append(pa.RecordBatch.from_arrays(
                [pa.array([task["model"]], pa.int32()), pa.array([len(at)], pa.int32()), *[pa.array([None if v is None else v.tobytes()], pa.binary()) for v in values]],
                ["model", "n", "bins", "gradient", "weight", "stats"]))

        for batch in batches:
            for i in range(batch.num_rows):
                walk([batch.slice(i, 1)], one)
                yield from out
                out.clear()

    return blocks.df.mapInArrow(run, "model int, n int, bins binary, gradient binary, weight binary, stats binary").persist(StorageLevel.MEMORY_AND_DISK)


def _level(sampled: DataFrame, binning: Binning, parts: int, trainings: list[_Training]) -> dict[int, list]:
    """One aggregation: for each model the best splits of its wanted nodes by feature, and at the root what is known of held-out rows."""
    tasks = {t.model: t.task() for t in trainings if t.growth is not None and len(t.growth.wanted)}
    settings = {t.model: t.unit.settings for t in trainings}
    starts = binning.starts
    sizes = np.diff(np.append(starts, binning.total)).tolist()
    cells = 0
    for task in tasks.values():
        # Bins are compared here, not codes.
        tree = task["partial"]
        task["partial"] = replace(tree, code=tree.code - np.where(tree.feature >= 0, starts[tree.feature], 0))
        cells += (int(task["place"].max()) + 1) * binning.total * SUMS * 8

    def run(batches):
        found = {}
        for batch in batches:
            for i in range(batch.num_rows):
                m = batch.column("model")[i].as_py()
                if m not in tasks:
                    continue
                task, n = tasks[m], batch.column("n")[i].as_py()
                bins, gradient, weight, stats = (
                    None if batch.column(c)[i].as_buffer() is None else np.frombuffer(batch.column(c)[i].as_buffer(), k)
                    for c, k in (("bins", np.uint8), ("gradient", np.float64), ("weight", np.float64), ("stats", np.float64)))
                bins = bins.reshape(len(sizes), n)
                if len(task["place"]) == 1:
                    _add(found, (m, -1), stats)
                slot = task["place"][task["partial"].leaves(bins)].astype(np.int64)
                inside, slots = slot >= 0, int(task["place"].max()) + 1
                if not inside.all():
                    at = np.flatnonzero(inside)
                    slot, gradient, bins, weight = slot[at], gradient[at], bins[:, at], None if weight is None else weight[at]
                for f, size in enumerate(sizes):
                    keys = slot * size + bins[f]
                    count = np.bincount(keys, minlength=slots * size).astype(np.float64)
                    hessian = count if weight is None else np.bincount(keys, weight, slots * size)
                    _add(found, (m, f), np.stack([np.bincount(keys, gradient, slots * size), hessian, count], axis=1).ravel())
        yield _payloads(found)

    def best(model, feature, sums):
        if feature < 0:
            return sums
        gain, code, left, whole = growth.best_splits(sums.reshape(-1, sizes[feature], SUMS), np.zeros(1, np.int64), settings[model])
        return np.concatenate([gain[:, None], code[:, None], left, whole], axis=1)

    def finish(model, feature, sums):
        sums = best(model, feature, sums)
        return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([feature], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["model", "feature", "payload"])

    out: dict[int, list] = {}
    added = sampled.mapInArrow(run, _PART)
    if cells * parts <= DIRECT_BYTES:
        # The sums of all tasks are small enough to be added up at once, without an exchange.
        total: dict[tuple, np.ndarray] = {}
        for row in sorted(added.toArrow().to_pylist(), key=lambda r: r["part"]):
            _add(total, (row["model"], row["feature"]), np.frombuffer(row["payload"], np.float64))
        for (m, f), sums in total.items():
            out.setdefault(m, []).append((f, best(m, f, sums).ravel()))
        return out
    for row in _summed(added, finish, "model int, feature int, payload binary").toArrow().to_pylist():
        out.setdefault(row["model"], []).append((row["feature"], np.frombuffer(row["payload"], np.float64)))
    return out


def _take(training: _Training, found: list) -> np.ndarray | None:
    """Give a growth the best split of each node over its features; returns what is known of held-out rows."""
    stats = next((v for f, v in found if f == -1), None)
    by_feature = dict(found)
    features = len(training.starts)
    cells = np.stack([by_feature[f].reshape(-1, 2 + 2 * SUMS) for f in range(features)])
    if training.ahead is None:
        _split(training, cells)
    else:
        training.ahead.serve(training.growth, cells, lambda known: _split(training, known))
    return stats


def _split(training: _Training, cells: np.ndarray) -> None:
    gain = cells[..., 0].copy()
    allowed = training.growth.allowed()
    if allowed is not None:
        gain[~allowed.T] = -np.inf
    best, nodes = np.argmax(gain, axis=0), np.arange(gain.shape[1])
    chosen = cells[best, nodes]
    training.growth.take(gain[best, nodes], chosen[:, 1].astype(np.int64) + training.starts[best], chosen[:, 2 : 2 + SUMS], chosen[:, 2 + SUMS :])


def _values(blocks: Blocks, tasks: list[dict], fn) -> DataFrame:
    """Rows (model, leaf, value) of used rows, the values as ``fn(task, residual, leaf)`` gives them."""
    walk = _each(blocks, tasks)

    def run(batches):
        out = []

        def one(task, rows, margin, held, used):
            leaf = np.zeros(len(margin), np.int32) if task["partial"] is None else task["partial"].leaves(rows.codes)
            model = pa.array(np.full(int(used.sum()), task["model"], np.int32))
            out.append(pa.RecordBatch.from_arrays([model, pa.array(leaf[used]), pa.array(fn(task, rows.label - margin, leaf)[used])], ["model", "leaf", "value"]))

        for batch in batches:
            walk([batch], one)
            yield from out
            out.clear()

    return blocks.df.mapInArrow(run, "model int, leaf int, value double")


def _residual(task: dict, residual: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    return residual


def _size(task: dict, residual: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    return np.abs(residual)


def _quantile_by(values: DataFrame, shares: dict[int, float]) -> dict[tuple[int, int], float]:
    """The exact quantile of each (model, leaf), by order statistics keyed by leaf."""
    out = {}
    for share in sorted(set(shares.values())):
        models = [m for m, s in shares.items() if s == share]
        for row in quantile_rows(values.where(F.col("model").isin(models)), "value", [share], ["model", "leaf"]).collect():
            out[row["model"], row["leaf"]] = row["quantile"]
    return out


def _leaf_values(blocks: Blocks, trainings: list[_Training]) -> dict[int, np.ndarray]:
    """Leaf values of the losses that need order statistics: medians or quantiles of each leaf, for Huber's loss with the clipped rest."""
    robust = [t for t in trainings if t.growth is not None and t.unit.settings.loss != "squared_error"]
    if not robust:
        return {}
    shares = {t.model: t.unit.settings.alpha if t.unit.settings.loss == "quantile" else 0.5 for t in robust}
    values = {t.model: np.zeros(len(t.growth.feature)) for t in robust}
    for (m, leaf), v in _quantile_by(_values(blocks, [t.task() for t in robust], _residual), shares).items():
        values[m][leaf] = v
    huber = [t for t in robust if t.unit.settings.loss == "huber"]
    if huber:
        middle = {t.model: values[t.model].copy() for t in huber}

        def clipped(task, residual, leaf):
            return np.clip(residual - middle[task["model"]][leaf], -task["delta"], task["delta"])

        rest = _values(blocks, [t.task() for t in huber], clipped).groupBy("model", "leaf").agg(F.avg("value").alias("rest"))
        for row in rest.collect():
            values[row["model"]][row["leaf"]] += row["rest"]
    return values


def _begin(blocks: Blocks, trainings: list[_Training]) -> None:
    """What each model predicts without a tree: the mean or a quantile of its rows' labels."""
    tasks = [{**t.task(), "settings": replace(t.unit.settings, subsample=1.0)} for t in trainings]
    walk = _each(blocks, tasks)

    def means(batches):
        found = {}

        def one(task, rows, margin, held, used):
            weight = np.ones(int(used.sum())) if rows.weight is None else rows.weight[used]
            _add(found, (task["model"], 0), np.array([weight.sum(), (weight * rows.label[used]).sum()]))

        walk(batches, one)
        yield _payloads(found)

    def finish(model, feature, sums):
        return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([sums[1] / sums[0] if sums[0] else 0.0])], ["model", "mean"])

    for model, mean in _summed(blocks.df.mapInArrow(means, _PART), finish, "model int, mean double").collect():
        trainings[model].out.begin = mean
    shares = {t.model: growth.start_share(t.unit.settings) for t in trainings if growth.start_share(t.unit.settings) is not None}
    if shares:
        for (m, _), v in _quantile_by(_values(blocks, [{**tasks[m], "begin": 0.0} for m in shares], _residual), shares).items():
            trainings[m].out.begin = v


def _restaged(blocks: Blocks, trainings: list[_Training]) -> Blocks:
    """The blocks with every model's predictions so far."""
    tasks, binning, weighted = [t.task() for t in trainings], blocks.binning, blocks.weighted
    names = ["n", "bins", "label", "fold", "digest", "weight"]

    def run(batches):
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                rows, _ = _arrays(row, binning, weighted)
                margins = b"".join(_margins(row, task, rows.codes).tobytes() for task in tasks)
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in names], pa.array([margins], pa.binary())], [*names, "margins"])

    schema = "n int, bins binary, label binary, fold binary, digest binary, weight binary, margins binary"
    for t in trainings:
        t.recent = []
    return Blocks(stage(blocks.df.mapInArrow(run, schema), "blocks"), binning, blocks.rows, weighted)


def _fit_in_passes(blocks: Blocks, units: list[Unit]) -> list[Fitted]:
    """Models that grow together, tree by tree, one aggregation a level for all of them."""
    starts = blocks.binning.starts
    trainings = [_Training(m, u, starts) for m, u in enumerate(units)]
    parts = len(blocks.df.inputFiles())
    _begin(blocks, trainings)
    while not all(t.done for t in trainings):
        huber = {t.model: t.unit.settings.alpha for t in trainings if not t.done and t.unit.settings.loss == "huber"}
        if huber:
            for (m, _), v in _quantile_by(_values(blocks, [{**trainings[m].task(), "partial": None} for m in huber], _size), huber).items():
                trainings[m].delta = v
        for t in trainings:
            t.start()
        sampled = _sampled(blocks, trainings)
        while any(t.growth is not None and len(t.growth.wanted) for t in trainings):
            found = _level(sampled, blocks.binning, parts, trainings)
            for m, lines in found.items():
                t = trainings[m]
                root = len(t.growth.feature) == 1
                stats = _take(t, lines)
                if root and _known(t, stats):
                    t.done, t.growth = True, None
        sampled.unpersist()
        for t in trainings:
            t.close()
        values = _leaf_values(blocks, trainings)
        for t in trainings:
            if t.growth is not None:
                tree = t.growth.tree(values.get(t.model))
                t.out.trees.append(tree)
                t.recent = [*t.recent, tree]
                t.number += 1
                t.done = t.number >= t.unit.settings.n_estimators
                t.growth = None
        if max(len(t.recent) for t in trainings) >= STAGED_TREES:
            blocks = _restaged(blocks, trainings)
    _last_stats(blocks, trainings)
    return [t.out for t in trainings]


def _known(t: _Training, stats: np.ndarray | None) -> bool:
    """Keep what is known of held-out rows after the trees so far; true if that ends the training."""
    if stats is None or not t.number:
        return False
    if t.number in t.unit.points or t.unit.settings.n_iter_no_change is not None:
        t.out.stats[t.number] = stats
    return t.unit.settings.n_iter_no_change is not None and t.stopper.ends(stats)


def _last_stats(blocks: Blocks, trainings: list[_Training]) -> None:
    walk = _each(blocks, [t.task() for t in trainings])

    def run(batches):
        found = {}
        walk(batches, lambda task, rows, margin, held, used: _add(
            found, (task["model"], 0), _stats(rows.label[held], margin[held], task["settings"], task["delta"])))
        yield _payloads(found)

    def finish(model, feature, sums):
        return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["model", "payload"])

    for model, payload in _summed(blocks.df.mapInArrow(run, _PART), finish, "model int, payload binary").collect():
        t = trainings[model]
        if t.number in t.unit.points:
            t.out.stats[t.number] = np.frombuffer(payload, np.float64)


def _radix(binning: Binning) -> list[int] | None:
    """What a bin of each feature counts in the number of a cell; None if such numbers are too large."""
    sizes = [len(e) + 1 for e in binning.edges]
    return None if math.prod(sizes) >= 1 << 62 else [math.prod(sizes[i + 1 :]) for i in range(len(sizes))]


def _cell_numbers(row: dict, radix: list[int]) -> np.ndarray:
    bins = np.frombuffer(row["bins"], np.uint8).reshape(len(radix), row["n"])
    return sum((line.astype(np.int64) * step for line, step in zip(bins, radix)), np.zeros(row["n"], np.int64))


def _cells_of(blocks: Blocks) -> np.ndarray | None:
    """The numbers of all cells that have rows, in rising order; None if there are more than ``CELLS`` or rows have weights."""
    radix = None if blocks.weighted else _radix(blocks.binning)
    if radix is None:
        return None

    def run(batches):
        for row in _rows_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_cell_numbers(row, radix)))], ["cell"])

    found = blocks.df.mapInArrow(run, "cell long").distinct().limit(CELLS + 1).toArrow().column(0).to_numpy()
    return np.sort(found) if len(found) <= CELLS else None


#: What a line of sums by cell is about, besides trees from 0 on: held-out rows (rows, labels, squares) and all used ones (rows, labels).
_HELD_OUT, _USED = -2, -1


class _CellTraining:
    """Models that share their samples, grown together as the sums of these come in."""

    def __init__(self, units: list[Unit], cells: LocalCells, keep: bool):
        self.units, self.cells, self.keep = units, cells, keep
        self.out = [Fitted() for _ in units]
        self.stoppers, self.done = [_Stopper(u.settings) for u in units], [False] * len(units)
        self.held, self.margins = np.zeros((3, cells.codes.shape[1])), []

    def take(self, tree: int, sums: np.ndarray) -> None:
        if tree == _HELD_OUT:
            self.held = sums
        elif tree == _USED:
            rows, label = sums.sum(axis=1)
            self.done = [rows == 0 or u.settings.n_estimators == 0 for u in self.units]
            for out in self.out:
                out.begin = label / rows if rows else 0.0
            self.margins = [np.full(sums.shape[1], out.begin) for out in self.out]
            if self.units[0].settings.subsample >= 1 and not self.units[0].settings.bootstrap:
                for number in range(max(u.settings.n_estimators for u in self.units)):
                    self._grow(number, sums)
        else:
            self._grow(tree, sums)

    def _grow(self, number: int, sums: np.ndarray) -> None:
        for i, (unit, out, margin) in enumerate(zip(self.units, self.out, self.margins)):
            if self.done[i]:
                continue
            tree = self.cells.add_summed_tree(unit.settings, number, margin, *sums)
            if self.keep:
                out.trees.append(tree)
            watched = unit.settings.n_iter_no_change is not None
            if number + 1 in unit.points or watched:
                rows, label, squares = self.held
                error = float((squares - 2 * margin * label + rows * margin * margin).sum())
                out.stats[number + 1] = np.array([rows.sum(), error, label.sum(), squares.sum(), error])
                self.done[i] = watched and self.stoppers[i].ends(out.stats[number + 1])
            self.done[i] = self.done[i] or number + 1 >= unit.settings.n_estimators


def _sums_by_cell(cell: np.ndarray, label: np.ndarray, fold: np.ndarray, digest: np.ndarray, groups: list[tuple[Unit, int]]) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Lines (group, tree, sums by cell) of rows for groups of models that share their samples, each with its greatest number of trees.

    A row is drawn once for a tree, whatever the number of groups: it is counted by held-out part and by the least ``subsample`` that takes it, and the sums of a
    group are those of the other parts and of all lesser samples.
    """
    width = int(cell.max()) + 1
    helds = np.array(sorted({u.held for u, _ in groups if u.held is not None}), np.int64)
    part = np.full(len(cell), len(helds))
    if len(helds):
        place = np.minimum(np.searchsorted(helds, fold), len(helds) - 1)
        part = np.where(helds[place] == fold, place, len(helds))
    parts = len(helds) + 1

    def others(sums: np.ndarray, held: int | None) -> np.ndarray:
        return (sums if held is None else np.delete(sums, np.searchsorted(helds, held), axis=0)).sum(axis=0)

    key = part * width + cell
    whole = [np.bincount(key, w, parts * width).reshape(parts, width) for w in (np.ones(len(cell)), label, label * label)]
    seeds: dict[int, list[int]] = {}
    for g, (unit, _) in enumerate(groups):
        if unit.held is not None:
            held = int(np.searchsorted(helds, unit.held))
            if whole[0][held].any():
                yield g, _HELD_OUT, [w[held] for w in whole]
        yield g, _USED, [others(w, unit.held) for w in whole[:2]]
        if unit.settings.bootstrap:
            used = np.ones(len(cell), bool) if unit.held is None else fold != unit.held
            for t in range(groups[g][1]):
                times = growth.times_drawn(digest, unit.settings, t) * used
                yield g, t, [np.bincount(cell, w, width) for w in (times, times * label)]
        elif unit.settings.subsample < 1:
            seeds.setdefault(unit.settings.random_state, []).append(g)
    for seed, members in seeds.items():
        limits = np.array(sorted({groups[g][0].settings.subsample for g in members}))
        first = key * (len(limits) + 1)
        for t in range(max(groups[g][1] for g in members)):
            drawn = growth.draws(digest, seed, t)
            place = first + (np.searchsorted(limits, drawn, "right") if len(limits) > 1 else drawn >= limits[0])
            shape = parts, width, len(limits) + 1
            counts, labels = (np.bincount(place, w, math.prod(shape)).reshape(shape)[..., :-1].cumsum(axis=2) for w in (None, label))
            summed = {}
            for g in members:
                unit, trees = groups[g]
                if t >= trees:
                    continue
                if unit.held not in summed:
                    summed[unit.held] = [np.ascontiguousarray(others(w, unit.held).T, np.float64) for w in (counts, labels)]
                at = int(np.searchsorted(limits, unit.settings.subsample))
                yield g, t, [w[at] for w in summed[unit.held]]


def _fit_by_cells(blocks: Blocks, units: list[Unit], keep: bool, numbers: np.ndarray) -> list[Fitted]:
    """Models under the squared loss: rows are summed by cell where they are, models that share their samples are a task's work."""
    spark, binning, radix = blocks.df.sparkSession, blocks.binning, _radix(blocks.binning)
    alike: dict[tuple, list[list[int]]] = {}
    for i, u in enumerate(units):
        s = u.settings
        lists = alike.setdefault((u.held, s.subsample if s.bootstrap else min(s.subsample, 1.0), s.bootstrap, s.random_state), [[]])
        if len(lists[-1]) == TOGETHER:
            lists.append([])
        lists[-1].append(i)
    groups = [members for lists in alike.values() for members in lists]
    shared = [(units[m[0]], max(units[i].settings.n_estimators for i in m)) for m in groups]

    def rows(batches):
        for row in _rows_of(batches):
            cell = np.searchsorted(numbers, _cell_numbers(row, radix)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *[pa.array(np.frombuffer(row[c], k)) for c, k in (
                ("label", np.float64), ("fold", np.int32), ("digest", np.int64))]], ["cell", "label", "fold", "digest"])

    def sums(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        cell, label, fold, digest = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        low, lines = int(cell.min()), []
        for line in _sums_by_cell(cell - low, label, fold, digest.view(np.uint64), shared):
            lines.append(line)
            if len(lines) == STAGED_TREES:
                yield staged(low, lines)
                lines = []
        if lines:
            yield staged(low, lines)

    def staged(low, lines):
        return pa.RecordBatch.from_arrays(
            [*[pa.array([line[i] for line in lines], pa.int32()) for i in (0, 1)], pa.array([low] * len(lines), pa.int32()),
             pa.array([np.stack(v).tobytes() for _, _, v in lines], pa.binary())], ["model", "tree", "low", "payload"])

    def train(batches):
        bins = np.stack([numbers // step % (len(e) + 1) for step, e in zip(radix, binning.edges)])
        cells = LocalCells(binning.codes(bins), binning.starts, binning.total)
        key, total, training = None, None, None

        def done(group):
            return pa.RecordBatch.from_arrays([pa.array(groups[group], pa.int64()), pa.array([_to_json(o) for o in training.out], pa.large_string())], ["unit", "fitted"])

        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            group, tree, low = (row.column(c)[0].as_py() for c in ("model", "tree", "low"))
            if (group, tree) != key:
                if key is not None:
                    training.take(key[1], total)
                if key is None or group != key[0]:
                    if key is not None:
                        yield done(key[0])
                    training = _CellTraining([units[i] for i in groups[group]], cells, keep)
                key, total = (group, tree), np.zeros((3 if tree == _HELD_OUT else 2, len(numbers)))
            found = np.frombuffer(row.column("payload")[0].as_buffer(), np.float64).reshape(len(total), -1)
            total[:, low : low + found.shape[1]] += found
        if key is not None:
            training.take(key[1], total)
            yield done(key[0])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.rows // CELL_ROWS))
    dealt = blocks.df.mapInArrow(rows, "cell int, label double, fold int, digest long").repartitionByRange(tasks, "cell", "digest")
    lines = dealt.mapInArrow(sums, "model int, tree int, low int, payload binary")
    ordered = lines.repartition(len(groups), "model").sortWithinPartitions("model", "tree", "low")
    found = released(ordered.mapInArrow(train, "unit long, fitted string"), "fitted").collect()
    return [_from_json(text) for _, text in sorted(found)]


def _by_leaf(leaf: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The order by leaf and value."""
    order = np.argsort(values)
    places = leaf[order]
    return order[np.argsort(places.astype(np.int16) if len(places) and places.max() < 1 << 15 else places, kind="stable")]


class _Bounds:
    """Values between which a quantile of each leaf surely lies nearly always; what a pass counts and returns makes it exact.

    ``known`` are some rows' leaves and values. Leaves whose bounds missed are given wider ones, at last all values.
    """

    def __init__(self, leaf: np.ndarray, values: np.ndarray, share: float, leaves: int):
        order = _by_leaf(leaf, values)
        self.values, self.share = np.append(values[order], np.nan), share
        self.n = np.bincount(leaf, minlength=leaves)
        self.first, self.errors = np.cumsum(self.n) - self.n, np.full(leaves, _ERRORS)

    def both(self) -> tuple[np.ndarray, np.ndarray]:
        at, width = self.share * (self.n - 1), self.errors * (np.sqrt(self.n) / 2 + 1)
        low, high = np.floor(at - width), np.ceil(at + width)
        value = lambda place: self.values[np.clip(self.first + place, 0, len(self.values) - 1).astype(np.int64)]
        return np.where(low >= 0, value(np.maximum(low, 0)), -np.inf), np.where(high < self.n, value(np.minimum(high, self.n)), np.inf)

    def exact(self, counts: np.ndarray, below: np.ndarray, leaf: np.ndarray, values: np.ndarray) -> np.ndarray | None:
        """The quantile of each leaf (0 for none) of ``counts`` rows; None if bounds missed, which are wider from then on."""
        order = _by_leaf(leaf, values)
        values, n = np.append(values[order], 0.0), np.bincount(leaf, minlength=len(counts))
        at = np.maximum(counts - 1, 0) * self.share
        low, high = np.floor(at).astype(np.int64) - below, np.ceil(at).astype(np.int64) - below
        missed = (counts > 0) & ((low < 0) | (high >= n))
        if missed.any():
            self.errors[missed] *= 8
            return None
        first = np.cumsum(n) - n
        a, b = (values[np.where(counts > 0, first + place, len(values) - 1)] for place in (low, high))
        return a + (b - a) * (at - np.floor(at))


class _RobustTraining:
    """A model under a loss other than the squares on its way, as the driver knows it: what it predicts for each cell."""

    def __init__(self, unit: Unit, cells: LocalCells, known: tuple[np.ndarray, np.ndarray]):
        self.settings, self.cells, self.known = unit.settings, cells, known
        self.out, self.margin = Fitted(), np.zeros(cells.codes.shape[1])
        self.growth = self.leaf = None
        self.delta = 0.0

    def residual(self) -> np.ndarray:
        cell, label = self.known
        return label - self.margin[cell]

    def grow(self, counts: np.ndarray, gradient: np.ndarray) -> None:
        self.cells.counts = counts
        self.growth, node = self.cells.grow(self.settings, len(self.out.trees), gradient, np.ones(len(counts), bool))
        # A leaf-wise growth need not have moved every cell to its leaf.
        self.leaf = node if self.settings.max_leaves is None else self.growth.partial().leaves(self.cells.codes)

    def close(self, values: np.ndarray) -> None:
        tree = self.growth.tree(values)
        self.out.trees.append(tree)
        self.margin = self.margin + tree.value[self.leaf]


_CELL_ROWS = "n int, cell binary, label binary, digest binary"


def _rows_by_cell(blocks: Blocks, numbers: np.ndarray) -> DataFrame:
    """Blocks of rows (number of the cell, label, digest), dealt out by ranges of cells."""
    radix = _radix(blocks.binning)

    def rows(batches):
        for row in _rows_of(batches):
            cell = np.searchsorted(numbers, _cell_numbers(row, radix)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *[pa.array(np.frombuffer(row[c], k)) for c, k in (("label", np.float64), ("digest", np.int64))]], ["cell", "label", "digest"])

    def pack(batches):
        for table in _gathered(batches):
            values = [table.column(c).to_numpy().tobytes() for c in ("cell", "label", "digest")]
            yield pa.RecordBatch.from_arrays([pa.array([table.num_rows], pa.int32()), *[pa.array([v], pa.binary()) for v in values]], ["n", "cell", "label", "digest"])

    tasks = max(int(blocks.df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks.rows // CELL_ROWS))
    dealt = blocks.df.mapInArrow(rows, "cell int, label double, digest long").repartitionByRange(tasks, "cell", "digest")
    return released(dealt.mapInArrow(pack, _CELL_ROWS), "rows-by-cell")


def _cell_pass(packed: DataFrame, tasks: list[dict], number: int, fn) -> list[dict]:
    """One pass for the models of ``tasks``: what ``fn(task, cell, residual)`` finds in each block's sample of the tree, as named arrays."""

    def run(batches):
        for row in _rows_of(batches):
            cell, label, digest = (np.frombuffer(row[c], k) for c, k in (("cell", np.int32), ("label", np.float64), ("digest", np.uint64)))
            samples = {}
            for task in tasks:
                s = task["settings"]
                if (s.subsample, s.random_state) not in samples:
                    sample = growth.in_sample(digest, s, number)
                    samples[s.subsample, s.random_state] = (cell, label) if sample is None else (cell[sample], label[sample])
                here, y = samples[s.subsample, s.random_state]
                if len(here):
                    found = pickle.dumps({"model": task["model"], **fn(task, here, y - task["margin"][here])})
                    yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["found"])

    return [pickle.loads(x) for x in packed.mapInArrow(run, "found binary").toArrow().column(0).to_pylist()]


def _between(leaf: np.ndarray, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict:
    below, inside = values < low[leaf], (values >= low[leaf]) & (values <= high[leaf])
    return {"below": np.bincount(leaf[below], minlength=len(low)), "at": leaf[inside], "values": values[inside]}


def _gradients(task: dict, cell: np.ndarray, residual: np.ndarray) -> dict:
    """Rows and gradients by cell. Where Huber's loss turns is known between bounds only: rows between them are returned."""
    first = int(cell.min())
    found, s = {"first": first, "counts": np.bincount(cell - first)}, task["settings"]
    if s.loss != "huber":
        return {**found, "gradient": np.bincount(cell - first, growth.downhill(residual, s, 0.0))}
    size = np.abs(residual)
    low, high = task["low"], task["high"]
    gradient = np.where(size < low, residual, np.where(size > high, np.sign(residual), 0.0))
    inside = (size >= low) & (size <= high)
    outer = size > high
    return {**found, "gradient": np.bincount(cell - first, np.where(outer, 0.0, gradient)), "outer": np.bincount(cell - first, np.where(outer, gradient, 0.0)),
            "below": int((size < low).sum()), "cell": cell[inside], "residual": residual[inside]}


def _worth(task: dict, cell: np.ndarray, residual: np.ndarray) -> dict:
    """What the quantiles of leaves follow from, and for Huber's loss the sums of clipped distances from medians that lie between bounds."""
    leaf, low, high, delta = task["leaf"][cell], task["low"], task["high"], task["delta"]
    found = _between(leaf, residual, low, high)
    if task["settings"].loss != "huber" or delta is None:
        return found
    upper, lower = residual - high[leaf] >= delta, residual - low[leaf] <= -delta
    linear = (residual - low[leaf] <= delta) & (residual - high[leaf] >= -delta) & ~upper & ~lower
    rest = ~(upper | lower | linear)
    n = len(low)
    return {**found, "outer": np.bincount(leaf[upper], minlength=n) - np.bincount(leaf[lower & ~upper], minlength=n), "linear": np.bincount(leaf[linear], minlength=n),
            "sum": np.bincount(leaf[linear], residual[linear], n), "rest_at": leaf[rest], "rest": residual[rest]}


def _exact_quantiles(packed: DataFrame, wanted: list[dict], number: int) -> dict[int, tuple[np.ndarray, list[dict]]]:
    """For each model of ``wanted`` the quantile of each leaf, and all that the pass found that gave them."""
    out = {}
    while wanted:
        for task in wanted:
            task["low"], task["high"] = task["bounds"].both()
        found = _cell_pass(packed, [{k: v for k, v in task.items() if k not in ("bounds", "counts")} for task in wanted], number, _worth)
        for task in wanted:
            own = [f for f in found if f["model"] == task["model"]]
            below = sum((f["below"] for f in own), np.zeros(len(task["counts"]), np.int64))
            values = task["bounds"].exact(task["counts"], below, *(np.concatenate([np.zeros(0, k), *[f[c] for f in own]]) for c, k in (("at", np.int64), ("values", np.float64))))
            if values is not None:
                out[task["model"]] = values, own
        wanted = [task for task in wanted if task["model"] not in out]
    return out


def _fit_robust_by_cells(blocks: Blocks, units: list[Unit], numbers: np.ndarray) -> list[Fitted]:
    """Models under other losses than the squares, grown together in two passes a tree over rows that lie by cell, whatever the depth.

    The first pass brings the gradients by cell, from which the driver grows the tree, the second one what its leaves are worth. Quantiles are exact: rows known to the
    driver tell bounds around each, and a pass counts the values below them and returns those between.
    """
    packed = _rows_by_cell(blocks, numbers).persist(StorageLevel.MEMORY_AND_DISK)
    radix, stride = _radix(blocks.binning), -(-blocks.rows // KNOWN_ROWS)

    def some(batches):
        for row in _rows_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row[c], k)[::stride]) for c, k in (("cell", np.int32), ("label", np.float64))], ["cell", "label"])

    sample = packed.mapInArrow(some, "cell int, label double").toArrow()
    known = sample.column("cell").to_numpy(), sample.column("label").to_numpy()
    bins = np.stack([numbers // step % (len(e) + 1) for step, e in zip(radix, blocks.binning.edges)])
    cells = LocalCells(blocks.binning.codes(bins), blocks.binning.starts, blocks.binning.total)
    trainings = [_RobustTraining(u, cells, known) for u in units]
    one = np.zeros(len(numbers), np.int64)
    begins = _exact_quantiles(packed, [
        {"model": m, "settings": replace(t.settings, subsample=1.0), "margin": t.margin, "leaf": one, "delta": None, "counts": np.array([blocks.rows]),
         "bounds": _Bounds(one[known[0]], known[1], growth.start_share(t.settings), 1)} for m, t in enumerate(trainings)], 0)
    for m, t in enumerate(trainings):
        t.out.begin = float(begins[m][0][0])
        t.margin = np.full(len(numbers), t.out.begin)
    for number in range(max(u.settings.n_estimators for u in units)):
        live = {m: t for m, t in enumerate(trainings) if number < t.settings.n_estimators}
        _grow_robust(packed, live, number)
        wanted = []
        for m, t in live.items():
            leaves = len(t.growth.feature)
            share = t.settings.alpha if t.settings.loss == "quantile" else 0.5
            wanted.append({"model": m, "settings": t.settings, "margin": t.margin, "leaf": t.leaf, "delta": t.delta, "counts": np.bincount(t.leaf, t.counts, leaves).astype(np.int64),
                           "bounds": _Bounds(t.leaf[known[0]], t.residual(), share, leaves)})
        counts = {task["model"]: task["counts"] for task in wanted}
        for m, (values, found) in _exact_quantiles(packed, wanted, number).items():
            t = live[m]
            if t.settings.loss == "huber":
                total = sum((f["outer"] * t.delta + f["sum"] - f["linear"] * values for f in found), np.zeros(len(values)))
                for f in found:
                    total += np.bincount(f["rest_at"], np.clip(f["rest"] - values[f["rest_at"]], -t.delta, t.delta), len(values))
                values = values + total / np.maximum(counts[m], 1)
            t.close(values)
    packed.unpersist()
    return [t.out for t in trainings]


def _grow_robust(packed: DataFrame, live: dict[int, _RobustTraining], number: int) -> None:
    """The next tree of each model, without what its leaves are worth."""
    none = np.zeros(0, np.int64)
    bounds = {m: _Bounds(np.zeros(len(t.known[0]), np.int64), np.abs(t.residual()), t.settings.alpha, 1) for m, t in live.items() if t.settings.loss == "huber"}
    waiting = dict(live)
    while waiting:
        tasks = []
        for m, t in waiting.items():
            low, high = bounds[m].both() if m in bounds else ([0.0], [0.0])
            tasks.append({"model": m, "settings": t.settings, "margin": t.margin, "low": low[0], "high": high[0]})
        found = _cell_pass(packed, tasks, number, _gradients)
        for m, t in list(waiting.items()):
            own = [f for f in found if f["model"] == m]
            counts, gradient, outer = np.zeros((3, len(t.margin)))
            for f in own:
                for total, name in ((counts, "counts"), (gradient, "gradient"), (outer, "outer")):
                    if name in f:
                        total[f["first"] : f["first"] + len(f[name])] += f[name]
            if m in bounds:
                cell, residual = (np.concatenate([none, *[f[c] for f in own]]) for c in ("cell", "residual"))
                below = np.array([sum(f["below"] for f in own)])
                delta = bounds[m].exact(np.array([int(counts.sum())]), below, np.zeros(len(cell), np.int64), np.abs(residual))
                if delta is None:
                    continue
                t.delta = float(delta[0])
                gradient += outer * t.delta + np.bincount(cell.astype(np.int64), growth.downhill(residual, t.settings, t.delta), len(gradient))
            t.counts = counts
            t.grow(counts, gradient)
            del waiting[m]


def fit_units(blocks: Blocks, units: list[Unit], keep: bool = True, local_rows: int = LOCAL_ROWS) -> list[Fitted]:
    """Train all units; their trees come along if ``keep`` is set."""
    if blocks.rows == 0:
        raise ValueError("there are no rows to train on")
    if blocks.weighted and any(u.settings.loss != "squared_error" for u in units):
        raise ValueError("only the squared loss takes weights")
    if any(u.settings.bootstrap for u in units):
        raise ValueError("only forests draw rows with replacement")
    if blocks.rows <= local_rows:
        return _fit_locally(blocks, units, keep)
    squared = [i for i, u in enumerate(units) if u.settings.loss == "squared_error"]
    robust = [i for i, u in enumerate(units) if u.settings.loss != "squared_error" and u.held is None and not u.points and u.settings.n_iter_no_change is None and u.settings.n_estimators]
    cells, found = _cells_of(blocks) if squared or robust else None, {}
    if cells is not None and squared:
        found |= zip(squared, _fit_by_cells(blocks, [units[i] for i in squared], keep, cells))
    if cells is not None:
        for at in range(0, len(robust), TOGETHER):
            found |= zip(robust[at : at + TOGETHER], _fit_robust_by_cells(blocks, [units[i] for i in robust[at : at + TOGETHER]], cells))
    rest = [i for i in range(len(units)) if i not in found]
    for at in range(0, len(rest), TOGETHER):
        found |= zip(rest[at : at + TOGETHER], _fit_in_passes(blocks, [units[i] for i in rest[at : at + TOGETHER]]))
    return [found[i] for i in range(len(units))]


def fit_forest(rows: DataFrame, features: list[str], key: str | None = None, label: str = "label", trees: int = 50, max_bins: int = MAX_BINS,
               random_state: int = 42, **settings) -> Model | None:
    """A forest of trees, each of its own draw of the rows with replacement; None if the rows lie in more than ``CELLS`` cells.

    The trees are models of one tree that grow side by side from sums over cells. Without a ``key`` a digest of the whole row stands for it.
    """
    keyed = rows if key is not None else rows.withColumn("_key", F.xxhash64(*rows.columns))
    blocks = make_blocks(keyed, features, key or "_key", label, max_bins=max_bins)
    if blocks.rows == 0:
        raise ValueError("there are no rows to train on")
    numbers = _cells_of(blocks)
    if numbers is None:
        return None
    wanted = [Settings(n_estimators=1, learning_rate=1 / trees, bootstrap=True, random_state=random_state * 1_000_003 + t, **settings) for t in range(trees)]
    fitted = _fit_by_cells(blocks, [Unit(s) for s in wanted], True, numbers)
    return Model(blocks.binning, wanted[0], fitted[0].begin, [out.trees[0] for out in fitted])


class _Scorer:
    """Predicts bin numbers. Rows whose bins are equal in all features that the trees use are worked out once, and up to ``CELLS`` of such cells are remembered."""

    def __init__(self, model: Model):
        self.model = model
        used = {int(f) for tree in model.trees for f in np.unique(tree.feature) if f >= 0}
        radix = _radix(replace(model.binning, edges=[e if f in used else [] for f, e in enumerate(model.binning.edges)]))
        self.radix = None if radix is None else {f: radix[f] for f in sorted(used)}
        self.cells, self.values = np.zeros(0, np.int64), np.zeros(0)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        if self.radix is None:
            return self.model.of_bins(bins)
        numbers = np.zeros(bins.shape[1], np.int64)
        for f, step in self.radix.items():
            numbers += bins[f].astype(np.int64) * step
        wanted, first, line = np.unique(numbers, return_index=True, return_inverse=True)
        place = np.searchsorted(self.cells, wanted)
        known = place < len(self.cells)
        known[known] = self.cells[place[known]] == wanted[known]
        new, out = ~known, np.empty(len(wanted))
        out[known] = self.values[place[known]]
        out[new] = self.model.of_bins(bins[:, first[new]])
        if len(self.cells) + int(new.sum()) > CELLS:
            self.cells, self.values = wanted[:CELLS], out[:CELLS]
        else:
            self.cells, self.values = np.insert(self.cells, place[new], wanted[new]), np.insert(self.values, place[new], out[new])
        return out[line]


def _gathered(batches):
    """Tables of about ``BLOCK_ROWS`` rows."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


@dataclass
class Model:
    """A fitted model: what it predicts without a tree, its trees and its bins."""

    binning: Binning
    settings: Settings
    begin: float
    trees: list[Tree]

    @functools.cached_property
    def _stacked(self) -> Stacked | None:
        return Stacked(self.trees) if all(t.depth() <= growth.SHALLOW for t in self.trees) else None

    def predict(self, columns: list[np.ndarray]) -> np.ndarray:
        return self.of_bins(self.binning.bins(columns))

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        """Predictions for bin numbers, a line a feature."""
        out = np.full(bins.shape[1], self.begin)
        if self._stacked is not None:
            self._stacked.add_to(out, self.binning.codes(bins))
            return out
        for at in range(0, bins.shape[1], _WALKED):
            codes = self.binning.codes(bins[:, at : at + _WALKED])
            for tree in self.trees:
                out[at : at + _WALKED] += tree.value[tree.leaves(codes)]
        return out

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``df``, a table or a stream, with the predictions."""
        model = self

        @F.pandas_udf("double")
        def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            scorer = _Scorer(model)
            for columns in batches:
                yield pd.Series(scorer.predict(model.binning.bins([c.to_numpy(np.float64, na_value=np.nan) for c in columns])))

        return df.withColumn(prediction, predict(*[F.col(c).cast("double") for c in self.binning.features]))

    def binned(self, rows: DataFrame, *keep: str) -> DataFrame:
        """``keep`` and the numbers of the row's bins as ``bins``: the number of its cell, or a byte a feature where such numbers are too large."""
        names, radix = [f"f{i}" for i in range(len(self.binning.features))], _radix(self.binning)
        flat = rows.select(*keep, *[F.col(c).cast("double").alias(n) for c, n in zip(self.binning.features, names)])

        def run(batches):
            for batch in batches:
                bins = self.binning.bins([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
                if radix is None:
                    limits = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(names))
                    line = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, limits.buffers()[1], pa.py_buffer(np.ascontiguousarray(bins.T).tobytes())])
                else:
                    line = pa.array(sum((x.astype(np.int64) * step for x, step in zip(bins, radix)), np.zeros(batch.num_rows, np.int64)))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], line], [*keep, "bins"])

        return flat.mapInArrow(run, StructType([*flat.select(*keep).schema.fields, StructField("bins", BinaryType() if radix is None else LongType())]))

    def _unbinned(self, column: pa.ChunkedArray) -> np.ndarray:
        """Bin numbers, a line a feature, of what ``binned`` gives."""
        if pa.types.is_integer(column.type):
            number = column.to_numpy()
            return np.stack([number // step % (len(e) + 1) for step, e in zip(_radix(self.binning), self.binning.edges)]).astype(np.uint8)
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), len(self.binning.features)).T

    def changed(self, rows: DataFrame, places: list[int]) -> DataFrame:
        """For rows (``repeat``, ``label``, ``bins``, ``other``): (``feature``, ``repeat``, ``label``, ``prediction``) for each place, which takes its bin from ``other``.

        ``feature`` is the index of the place; one of -1 changes nothing. Rows of like bins meet, so that a cell is worked out once for many of them.
        """
        model = self

        def run(batches):
            scorer = _Scorer(model)
            for table in _gathered(batches):
                n = table.num_rows
                bins, other = (model._unbinned(table.column(c)) for c in ("bins", "other"))
                copies = np.tile(bins, len(places))
                for i, place in enumerate(places):
                    if place >= 0:
                        copies[place, i * n : (i + 1) * n] = other[place]
                found = scorer.predict(copies).reshape(len(places), n)
                repeat, label = (table.column(c).combine_chunks() for c in ("repeat", "label"))
                for i in range(len(places)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i, np.int32)), repeat, label, pa.array(found[i])], ["feature", "repeat", "label", "prediction"])

        dealt = rows.select(F.col("repeat").cast("int"), F.col("label").cast("double"), "bins", "other").repartitionByRange("bins", "other")
        return dealt.sortWithinPartitions("bins", "other").mapInArrow(run, "feature int, repeat int, label double, prediction double")

    def importances(self) -> list[float]:
        """Share of each feature in the gains, every tree counting alike."""
        total = np.zeros(len(self.binning.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            gains = np.bincount(tree.feature[inner], tree.gain[inner], len(total))
            total += gains / gains.sum() if gains.sum() > 0 else 0
        return (total / total.sum() if total.sum() > 0 else total).tolist()

    def to_json(self) -> str:
        return json.dumps({"binning": asdict(self.binning), "settings": asdict(self.settings), "fitted": _to_json(Fitted(self.begin, self.trees))})

    @staticmethod
    def from_json(text: str) -> Model:
        found = json.loads(text)
        fitted = _from_json(found["fitted"])
        return Model(Binning(**found["binning"]), Settings(**found["settings"]), fitted.begin, fitted.trees)


def fit(rows: DataFrame, features: list[str], key: str, label: str = "label", stop: Column | None = None, weight: str | None = None,
        max_bins: int = MAX_BINS, local_rows: int = LOCAL_ROWS, **settings) -> Model:
    """One model of ``rows``. Rows for which ``stop`` is true decide when to end early and take no other part."""
    if stop is not None and settings.get("n_iter_no_change") is None:
        settings["n_iter_no_change"] = 10
    wanted = Settings(**settings)
    fold = None if stop is None else F.coalesce(stop, F.lit(False)).cast("int")
    blocks = make_blocks(rows, features, key, label, fold, weight, max_bins, bins_of=None if stop is None else ~F.coalesce(stop, F.lit(False)))
    fitted = fit_units(blocks, [Unit(wanted, None if stop is None else 1)], local_rows=local_rows)[0]
    return Model(blocks.binning, wanted, fitted.begin, fitted.trees)


def cross_validate(rows: DataFrame, features: list[str], key: str, candidates: list[dict], fold: Column, folds: int, label: str = "label",
                   max_bins: int = MAX_BINS, local_rows: int = LOCAL_ROWS) -> list[list[float | None]]:
    """r2 of each candidate on each fold by models of the other folds; all models share the bins and the passes."""
    blocks = make_blocks(rows, features, key, label, fold, None, max_bins)
    settings = [Settings(**c) for c in candidates]
    alike: dict[Settings, set[int]] = {}
    for s in settings:
        alike.setdefault(s.same_trees(len(features)), set()).add(s.n_estimators)
    units = [(shared, k, Unit(replace(shared, n_estimators=max(points)), k, tuple(sorted(points))))
             for shared, points in alike.items() for k in range(folds)]
    fitted = fit_units(blocks, [u for _, _, u in units], keep=False, local_rows=local_rows)
    found = {(shared, k): out for (shared, k, _), out in zip(units, fitted)}
    scores = []
    for s in settings:
        shared = s.same_trees(len(features))
        line = [found[shared, k].stats.get(s.n_estimators) for k in range(folds)]
        scores.append([None if stats is None else r2_of(stats) for stats in line])
    return scores
