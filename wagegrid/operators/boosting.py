"""Boosted trees of second order, trained on a distributed table.

A round grows one tree on the gradients g and curvatures h of the logistic loss.  For every
level of the tree the tasks sum g and h of their rows by (node, feature, bin); the sums
of all tasks give, for every node, the split of largest gain

    gl^2 / (hl + l) + gr^2 / (hr + l) - (gl + gr)^2 / (hl + hr + l)

and in the end every leaf's weight -g / (h + l).  The driver holds the bins and the trees,
one line comes back for every node and share of the features, and rows are never moved.  Models
of several folds are trained side by side in the same jobs, on values put in bins once.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.operators import sparse_rows

#: Bins of a feature.
BINS = 16
#: Rounds after which the sums of all trees so far are written down with the rows.
WRITTEN_ROUNDS = 10
#: Bin of a cell whose place has no cuts in a run; bins of a place as keys count them.
NO_BIN, BIN_KEYS = 255, 32
#: Cells of a block; keys that are summed in a plain array; places whose splits one group compares.
BLOCK_CELLS, DENSE_KEYS, SHARE_PLACES = 1 << 18, 1 << 21, 1 << 12
#: Sums that the driver takes from all tasks at once, instead of groups: some 12 MB.
DRIVER_KEYS = 1 << 19

#: A node: feature (-1 for a leaf), largest value that goes left, weight, children.
Node = tuple[int, float, float, int, int]


def feature_edges(df: DataFrame, features: str, bins: int = BINS) -> dict[int, np.ndarray]:
    """For every feature that is somewhere not 0: the values that part its bins, 0 among them."""
    return _edges(_cells(df.select(F.lit(0).alias("run"), features), features), 1, bins)[0]


def fold_edges(df: DataFrame, features: str, fold: str, numbers: list[int], bins: int = BINS) -> list[dict[int, np.ndarray]]:
    """The same for every number, by the rows of the other folds, in one job."""
    runs = F.array(*[F.struct(F.lit(i).alias("run"), F.lit(number).alias("number")) for i, number in enumerate(numbers)])
    cells = _cells(df.select(F.filter(runs, lambda r: r["number"] != F.col(fold)).alias("runs"), features), features)
    return _edges(cells.select(F.explode("runs.run").alias("run"), "place", "value"), len(numbers), bins)


def _cells(df: DataFrame, features: str) -> DataFrame:
    """Places and values that are not 0, in place of ``features``."""
    dense = F.when(F.size(f"{features}.values") > 0, F.sequence(F.lit(0), F.size(f"{features}.values") - 1))
    kept = [c for c in df.columns if c != features]
    return df.select(*kept, F.inline(F.arrays_zip(
        F.coalesce(f"{features}.indices", dense).alias("place"), F.col(f"{features}.values").alias("value")
    ))).where("value <> 0")


def _edges(cells: DataFrame, runs: int, bins: int) -> list[dict[int, np.ndarray]]:
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    held = cells.groupBy("run", "place").agg(
        F.percentile_approx("value", shares, F.lit(1000)).alias("cuts"), F.max("value").alias("most")
    )
    found: list[dict[int, np.ndarray]] = [{} for _ in range(runs)]
    for row in held.collect():
        cuts = np.unique([0.0, *row.cuts])
        cuts = cuts[cuts < max(row.most, 0.0)]
        if len(cuts):
            found[row.run][row.place] = cuts
    return found


def margins(rows: sparse_rows.Rows, trees: list[list[Node]]) -> np.ndarray:
    """The sum of the trees' weights for every row."""
    total = np.zeros(len(rows))
    for tree in trees:
        total += np.array([node[2] for node in tree])[leaves(rows, tree)]
    return total


def leaves(rows: sparse_rows.Rows, tree: list[Node]) -> np.ndarray:
    """The node that every row ends in."""
    at = np.zeros(len(rows), np.int64)
    wanted = {node[0] for node in tree if node[0] >= 0}
    columns = {}
    for place in wanted:
        hit = np.flatnonzero(rows.places == place)
        column = np.zeros(len(rows))
        column[np.searchsorted(rows.ends, hit, side="right") - 1] = rows.values[hit]
        columns[place] = column
    # children stand behind their parents
    for i, (place, cut, _, left, right) in enumerate(tree):
        if place >= 0:
            here = np.flatnonzero(at == i)
            at[here] = np.where(columns[place][here] <= cut, left, right)
    return at


@dataclass
class Block:
    """Some rows, packed: cells lie row by row, ``bins`` and ``base`` hold a line for every run."""

    fold: np.ndarray
    label: np.ndarray
    of: np.ndarray  #: row of every cell
    place: np.ndarray  #: position in ``Runs.places``
    bins: np.ndarray
    base: np.ndarray

    @staticmethod
    def all_of(batch: pa.RecordBatch, runs: int) -> Iterator[Block]:
        for row in batch.to_pylist():
            fold, sizes = np.frombuffer(row["fold"], np.int32), np.frombuffer(row["sizes"], np.int32)
            yield Block(
                fold, np.frombuffer(row["label"]), np.repeat(np.arange(len(fold)), sizes), np.frombuffer(row["place"], np.int32),
                np.frombuffer(row["bins"], np.uint8).reshape(runs, -1), np.frombuffer(row["base"]).reshape(runs, -1),
            )


_BLOCK = "fold binary, label binary, sizes binary, place binary, bins binary, base binary"

#: A tree while it grows: position of the place (-1 for a leaf), last bin that goes left, weight, left child.
Grown = list[tuple[int, int, float, int]]


@dataclass
class Runs:
    """What all runs are trained by: run i takes the rows whose fold is not ``numbers[i]``."""

    numbers: list[int]
    edges: list[dict[int, np.ndarray]]
    places: np.ndarray
    zeros: np.ndarray  #: run, position: bin of 0

    @staticmethod
    def of(numbers: list[int], edges: list[dict[int, np.ndarray]]) -> Runs:
        places = np.array(sorted(set().union(*edges)), np.int64)
        zeros = np.zeros((len(numbers), len(places)), np.uint8)
        for run, own in enumerate(edges):
            at = np.searchsorted(places, np.fromiter(own, np.int64, len(own)))
            zeros[run, at] = [np.searchsorted(cuts, 0.0) for cuts in own.values()]
        return Runs(numbers, edges, places, zeros)

    @property
    def most_keys(self) -> int:
        """Places and bins that a node of a run can have sums for."""
        return max((sum(len(cuts) + 1 for cuts in own.values()) for own in self.edges), default=0)

    def packed(self, rows: sparse_rows.Rows, fold: np.ndarray, label: np.ndarray) -> Iterator[dict]:
        """Blocks of rows as lines of a table; cells of places that no run has cuts for are left out."""
        at = np.minimum(np.searchsorted(self.places, rows.places), max(len(self.places) - 1, 0))
        use = np.flatnonzero(self.places[at] == rows.places) if len(self.places) else np.zeros(0, np.int64)
        at, values, of = at[use], rows.values[use], rows.of[use]
        bins = np.full((len(self.numbers), len(use)), NO_BIN, np.uint8)
        order = np.argsort(at, kind="stable")
        ends = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1))
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            part = order[a:b]
            place = int(self.places[at[part[0]]])
            for run, own in enumerate(self.edges):
                if place in own:
                    bins[run, part] = np.searchsorted(own[place], values[part], side="left")
        sizes = np.bincount(of, minlength=len(rows)).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        first = 0
        while first < len(rows):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_CELLS, side="right")) - 1)
            cells = slice(ends[first], ends[last])
            yield {
                "fold": fold[first:last].astype(np.int32).tobytes(), "label": label[first:last].tobytes(), "sizes": sizes[first:last].tobytes(),
                "place": at[cells].astype(np.int32).tobytes(), "bins": bins[:, cells].tobytes(),
                "base": np.zeros((len(self.numbers), last - first)).tobytes(),
            }
            first = last

    def ends(self, block: Block, run: int, trees: list[Grown]) -> list[np.ndarray]:
        """For every tree the node that each row ends in."""
        wanted = np.array(sorted({node[0] for tree in trees for node in tree if node[0] >= 0}), np.int64)
        held = np.repeat(self.zeros[run, wanted][:, None], len(block.fold), axis=1)
        column = np.full(len(self.places) + 1, -1)
        column[wanted] = np.arange(len(wanted))
        of = column[block.place]
        hit = np.flatnonzero(of >= 0)
        hit = hit[block.bins[run, hit] != NO_BIN]
        held[of[hit], block.of[hit]] = block.bins[run, hit]
        found = []
        for tree in trees:
            at = np.zeros(len(block.fold), np.int64)
            # children stand behind their parents
            for i, (place, cut, _, left) in enumerate(tree):
                if place >= 0:
                    here = np.flatnonzero(at == i)
                    at[here] = left + (held[column[place], here] > cut)
            found.append(at)
        return found

    def margins(self, block: Block, run: int, trees: list[Grown]) -> np.ndarray:
        total = block.base[run].copy()
        for tree, at in zip(trees, self.ends(block, run, trees), strict=True):
            total += np.array([node[2] for node in tree])[at]
        return total


def _sums(keys: np.ndarray, g: np.ndarray, h: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys (below ``most``) in order, with sums of g and h."""
    if most <= DENSE_KEYS:
        found = np.flatnonzero(np.bincount(keys, minlength=most))
        return found, np.bincount(keys, g, most)[found], np.bincount(keys, h, most)[found]
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, g, len(found)), np.bincount(at, h, len(found))


_SUMS = "run int, node int, share int, part int, g double, h double, keys binary, gs binary, hs binary"


def _summing(runs: Runs, trees: list[list[Grown]], grown: list[Grown], levels: list[list[int]]) -> Callable:
    """Sums of g and h over a task for the nodes of every run's level: of all their rows, and by place and bin."""
    places, shares = len(runs.places), max(1, math.ceil(len(runs.places) / SHARE_PLACES))

    def run_sums(block: Block, run: int) -> tuple:
        level = levels[run]
        odds = runs.margins(block, run, trees[run])
        share = 1 / (1 + np.exp(-odds))
        used = block.fold != runs.numbers[run]
        g, h = np.where(used, share - block.label, 0.0), np.where(used, share * (1 - share), 0.0)
        number = np.full(len(grown[run]), -1)
        number[level] = np.arange(len(level))
        node = np.where(used, number[runs.ends(block, run, [grown[run]])[0]], -1)
        rows, of = np.flatnonzero(node >= 0), node[block.of]
        cells = np.flatnonzero((of >= 0) & (block.bins[run] != NO_BIN))
        keys = (of[cells] * places + block.place[cells]) * BIN_KEYS + block.bins[run, cells]
        rows_of = block.of[cells]
        return (
            np.bincount(node[rows], g[rows], len(level)), np.bincount(node[rows], h[rows], len(level)),
            *_sums(keys, g[rows_of], h[rows_of], len(level) * places * BIN_KEYS),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in levels]
        for batch in batches:
            for block in Block.all_of(batch, len(levels)):
                for number, level in enumerate(levels):
                    if level:
                        held[number].append(run_sums(block, number))
        part, lines = TaskContext.get().partitionId(), []
        for number, (level, parts) in enumerate(zip(levels, held, strict=True)):
            if not parts:
                continue
            whole_g, whole_h = (np.sum([p[i] for p in parts], axis=0) for i in (0, 1))
            keys, g, h = _sums(*(np.concatenate([p[i] for p in parts]) for i in (2, 3, 4)), len(level) * places * BIN_KEYS)
            firsts = [(i * places + min(s * SHARE_PLACES, places)) * BIN_KEYS for i in range(len(level)) for s in range(shares)]
            cuts = [*np.searchsorted(keys, firsts).tolist(), len(keys)]
            for line in range(len(level) * shares):
                i, own = line // shares, slice(cuts[line], cuts[line + 1])
                lines.append({
                    "run": number, "node": level[i], "share": line % shares, "part": part, "g": whole_g[i], "h": whole_h[i],
                    "keys": (keys[own] - i * places * BIN_KEYS).tobytes(), "gs": g[own].tobytes(), "hs": h[own].tobytes(),
                })
        yield pa.RecordBatch.from_pylist(lines, schema=_SUMS_ARROW)

    return run


_SUMS_ARROW = pa.schema([
    *[(c, pa.int32()) for c in ("run", "node", "share", "part")], *[(c, pa.float64()) for c in ("g", "h")],
    *[(c, pa.binary()) for c in ("keys", "gs", "hs")],
])
_SPLIT = "run int, node int, g double, h double, gain double, place int, bin int, gl double, hl double"


def _choosing(zeros: np.ndarray, penalty: float, least: float) -> Callable[[pa.Table], pa.Table]:
    """The best split of a node among the places of a share; place -1 if none helps."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        number, node = table.column("run")[0].as_py(), table.column("node")[0].as_py()
        all_g, all_h = (float(np.sum(table.column(c).to_numpy())) for c in ("g", "h"))
        keys, g, h = (np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("keys", np.int64), ("gs", float), ("hs", float)))
        places, at = np.unique(keys // BIN_KEYS, return_inverse=True)
        size = len(places) * BIN_KEYS
        gl, hl = (np.bincount(at * BIN_KEYS + keys % BIN_KEYS, v, size).reshape(-1, BIN_KEYS) for v in (g, h))
        # values that are not held are 0
        right = np.arange(BIN_KEYS) >= zeros[number, places][:, None]
        gl, hl = (v.cumsum(axis=1) + right * (whole - v.sum(axis=1, keepdims=True)) for v, whole in ((gl, all_g), (hl, all_h)))
        score = lambda g, h: g * g / np.maximum(h + penalty, 1e-300)
        gain = np.round(score(gl, hl) + score(all_g - gl, all_h - hl) - score(all_g, all_h), 9)
        gain[(hl < least) | (all_h - hl < least)] = 0
        place, cut, most, left = -1, 0, 0.0, (0.0, 0.0)
        if gain.size and gain.max() > 0:  # of equal ones the first place and bin
            i, cut = divmod(int(gain.argmax()), BIN_KEYS)
            place, most, left = int(places[i]), float(gain[i, cut]), (float(gl[i, cut]), float(hl[i, cut]))
        return pa.table({
            **{k: pa.array([v], pa.int32()) for k, v in (("run", number), ("node", node))},
            **{k: pa.array([v], pa.float64()) for k, v in (("g", all_g), ("h", all_h), ("gain", most))},
            "place": pa.array([place], pa.int32()), "bin": pa.array([cut], pa.int32()),
            "gl": pa.array([left[0]], pa.float64()), "hl": pa.array([left[1]], pa.float64()),
        })

    return run


def _best(sums: DataFrame, choose: Callable[[pa.Table], pa.Table], few: bool) -> list[dict]:
    """What ``choose`` makes of the sums of every node and share; a few sums are compared on the driver."""
    if not few:
        return [r.asDict() for r in sums.groupBy("run", "node", "share").applyInArrow(choose, _SPLIT).collect()]
    groups: dict[tuple, list[dict]] = {}
    for line in sums.toArrow().to_pylist():
        groups.setdefault((line["run"], line["node"], line["share"]), []).append(line)
    return [choose(pa.Table.from_pylist(lines, schema=_SUMS_ARROW)).to_pylist()[0] for lines in groups.values()]


class SecondOrderTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A binary classifier: ``rounds`` trees of depth ``maxDepth``, weights times ``rate``."""

    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a leaf's weight that counts", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    penalty = Param(Params._dummy(), "penalty", "added to every curvature", TypeConverters.toFloat)
    leastCurvature = Param(Params._dummy(), "leastCurvature", "curvature a child must have", TypeConverters.toFloat)

    def __init__(self, rounds=100, rate=0.1, maxDepth=3, penalty=1.0, leastCurvature=1.0):  # noqa: N803
        super().__init__()
        self._set(rounds=rounds, rate=rate, maxDepth=maxDepth, penalty=penalty, leastCurvature=leastCurvature)

    def setLabelCol(self, value):  # noqa: N802
        return self._set(labelCol=value)

    def _fit(self, dataset: DataFrame) -> TreesModel:
        return self.fit_folds(dataset.withColumn("_fold", F.lit(0)), "_fold", {-1: self})[-1]

    def fit_folds(self, dataset: DataFrame, fold: str, estimators: dict[int, SecondOrderTrees]) -> dict[int, TreesModel]:
        """A model for every number of ``estimators`` (all set up like this one), trained on the rows of the
        other folds.  A level of the trees of all of them takes one job.
        """
        raw = dataset.select(
            F.col(self.getLabelCol()).cast("double").alias("label"), F.col(fold).cast("int").alias("fold"),
            sparse_rows.held(self.getFeaturesCol()).alias("v"),
        )
        numbers = sorted(estimators)
        runs = Runs.of(numbers, fold_edges(raw, "v", "fold", numbers))
        rows = self._packed(raw, runs)
        made: list[list[list[Node]]] = [[] for _ in numbers]
        recent: list[list[Grown]] = [[] for _ in numbers]
        for number in range(self.getOrDefault(self.rounds)):
            if number and number % WRITTEN_ROUNDS == 0:
                rows = self._with_margins(rows, runs, recent)
                recent = [[] for _ in numbers]
            for run, tree in enumerate(self._grow(rows, runs, recent)):
                recent[run].append(tree)
                made[run].append([
                    (-1, 0.0, weight, -1, -1) if place < 0 else
                    (int(runs.places[place]), float(runs.edges[run][int(runs.places[place])][cut]), 0.0, left, left + 1)
                    for place, cut, weight, left in tree
                ])
        return {
            number: TreesModel(json.dumps(trees))._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
            for number, trees in zip(numbers, made, strict=True)
        }

    @staticmethod
    def _packed(raw: DataFrame, runs: Runs) -> DataFrame:
        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fold, label = batch.column("fold").to_numpy(zero_copy_only=False), batch.column("label").to_numpy(zero_copy_only=False)
                for line in runs.packed(sparse_rows.rows_of(batch.column("v")), fold, label):
                    yield pa.RecordBatch.from_pylist([line], schema=_BLOCK_ARROW)

        known = raw.where(F.col("fold").isNotNull())
        return settings.written(settings.dealt(known, "v").mapInArrow(pack, _BLOCK), "boosting")

    @staticmethod
    def _with_margins(rows: DataFrame, runs: Runs, trees: list[list[Grown]]) -> DataFrame:
        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                base = [
                    np.stack([runs.margins(block, run, own) for run, own in enumerate(trees)]).tobytes()
                    for block in Block.all_of(batch, len(trees))
                ]
                yield batch.set_column(5, "base", pa.array(base, pa.binary()))

        return settings.written(rows.mapInArrow(add, _BLOCK), "boosting")

    def _grow(self, rows: DataFrame, runs: Runs, trees: list[list[Grown]]) -> list[Grown]:
        """The next tree of every run."""
        penalty, rate, least = (self.getOrDefault(p) for p in (self.penalty, self.rate, self.leastCurvature))
        weight = lambda g, h: -rate * g / (h + penalty) if h + penalty else 0.0
        grown: list[Grown] = [[(-1, 0, 0.0, -1)] for _ in runs.numbers]
        levels: list[list[int]] = [[0] for _ in runs.numbers]
        tasks = rows.rdd.getNumPartitions()
        for depth in range(max(self.getOrDefault(self.maxDepth), 1)):
            sums = rows.mapInArrow(_summing(runs, trees, grown, levels), _SUMS)
            found = _best(sums, _choosing(runs.zeros, penalty, least), runs.most_keys * sum(map(len, levels)) * tasks <= DRIVER_KEYS)
            best: dict[tuple[int, int], dict] = {}
            for s in sorted(found, key=lambda s: (s["run"], s["node"], -s["gain"], s["place"])):
                best.setdefault((s["run"], s["node"]), s)
            levels = [[] for _ in runs.numbers]
            for (run, node), s in best.items():
                tree = grown[run]
                if not depth:
                    tree[0] = (-1, 0, weight(s["g"], s["h"]), -1)
                if s["place"] < 0 or depth >= self.getOrDefault(self.maxDepth):
                    continue
                left = len(tree)
                tree[node] = (s["place"], s["bin"], 0.0, left)
                tree += [(-1, 0, weight(s["gl"], s["hl"]), -1), (-1, 0, weight(s["g"] - s["gl"], s["h"] - s["hl"]), -1)]
                levels[run] += [left, left + 1]
            if not any(levels):
                break
        return grown


_BLOCK_ARROW = pa.schema([(c.split()[0], pa.binary()) for c in _BLOCK.split(", ")])


class TreesModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    trees = Param(Params._dummy(), "trees", "the trees, as JSON", TypeConverters.toString)

    def __init__(self, trees="[]"):
        super().__init__()
        self._set(trees=trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = self.getOrDefault(self.trees)

        @F.arrow_udf("double")
        def predict(vectors: pa.Array) -> pa.Array:
            total = margins(sparse_rows.rows_of(vectors), json.loads(text))
            return pa.array((total > 0).astype(float))

        return dataset.withColumn(self.getPredictionCol(), predict(sparse_rows.held(self.getFeaturesCol())))
