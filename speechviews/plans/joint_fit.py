"""Logistic regressions of several penalties, fitted together: each pass over the rows serves all of them.

Every model has its own quasi-Newton steps (limited memory; where its penalty has an absolute part, orthant-wise) and its own
step length, but all ask for loss and gradient at once, so the number of passes is that of the slowest model instead of the
sum. A task adds up the gradients of its rows for all models side by side; partial sums are added in a tree, at last by
ranges of features, so that a pass sends the driver one number per feature and model, whatever the number of tasks.
"""

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

MEMORY = 6  # steps a model remembers
FAN_IN = 16  # partial sums that are added by one task
COLUMNS = 8192  # features of a partial sum's row
ENTRIES = 200_000  # entries of the feature vectors worked on at a time
TOLERANCE = 1e-6
SHORTEST = 2.0**-20  # of a step


@dataclass
class Fit:
    """One model on its way; weights are those of the scaled features, the intercept last."""

    l1: float
    l2: float
    at: np.ndarray
    trial: np.ndarray
    value: float = math.inf
    gradient: np.ndarray | None = None
    direction: np.ndarray | None = None
    step: float = 1.0
    steps: list = field(default_factory=list)
    iterations: int = 0
    done: bool = False

    def penalised(self, weights, loss, gradient):
        own = weights[:-1]
        value = loss + 0.5 * self.l2 * own @ own + self.l1 * np.abs(own).sum()
        return value, gradient + self.l2 * np.append(own, 0.0)

    def steepest(self):
        """The gradient, or where the penalty has a corner the side that falls, 0 if none does."""
        own, g = self.at[:-1], self.gradient[:-1]
        low, high = g - self.l1, g + self.l1
        corner = np.where(low > 0, low, np.where(high < 0, high, 0.0))
        return np.append(np.where(own == 0, corner, g + self.l1 * np.sign(own)), self.gradient[-1])

    def told(self, loss, gradient, most):
        """Takes what the pass found at ``trial`` and chooses the next one."""
        value, gradient = self.penalised(self.trial, loss, gradient)
        if self.gradient is not None:
            moved = self.trial - self.at
            if value > self.value + 1e-4 * (self.steepest() @ moved) and self.step > SHORTEST:
                self.step /= 2
                self._try()
                return
            change = gradient - self.gradient
            if change @ moved > 1e-12:
                self.steps = [*self.steps, (moved, change)][-MEMORY:]
            self.iterations += 1
            self.done = self.iterations >= most or self.value - value <= TOLERANCE * max(abs(value), 1e-12)
        self.at, self.value, self.gradient = self.trial, value, gradient
        if not self.done:
            self._turn()
            self._try()

    def _turn(self):
        downhill = self.steepest()
        q, kept = downhill.copy(), []
        for moved, change in reversed(self.steps):
            share = (moved @ q) / (change @ moved)
            q -= share * change
            kept.append((share, moved, change))
        if self.steps:
            moved, change = self.steps[-1]
            q *= (moved @ change) / (change @ change)
        for share, moved, change in reversed(kept):
            q += moved * (share - (change @ q) / (change @ moved))
        if self.l1:
            q[:-1][q[:-1] * downhill[:-1] <= 0] = 0.0
        self.direction = -q
        self.step = 1.0 if self.steps else 1.0 / max(np.linalg.norm(downhill), 1e-12)

    def _try(self):
        self.trial = self.at + self.step * self.direction
        if self.l1:
            side = np.where(self.at[:-1] != 0, np.sign(self.at[:-1]), -np.sign(self.steepest()[:-1]))
            self.trial[:-1][self.trial[:-1] * side < 0] = 0.0


def _sums(weights, features: int):
    """A function for ``mapInArrow`` that sums losses and gradients of all models over its rows."""

    def apply(batches):
        trials = weights.value
        models = trials.shape[1]
        gradient, losses, rows = np.zeros((models, features + 1)), np.zeros(models), 0
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            lists = batch.column("indices")
            ends = lists.offsets.to_numpy()
            index, value = lists.values.to_numpy(), batch.column("values").values.to_numpy()
            start = 0
            while start < len(labels):
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + ENTRIES, "right")) - 1)
                own = slice(ends[start], ends[stop])
                row = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1]))
                i, v, y = index[own], value[own], labels[start:stop]
                for m in range(models):
                    margin = np.bincount(row, trials[i, m] * v, stop - start) + trials[-1, m]
                    losses[m] += np.logaddexp(0, margin).sum() - margin @ y
                    excess = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
                    gradient[m, :-1] += np.bincount(i, excess[row] * v, features)
                    gradient[m, -1] += excess.sum()
                rows += stop - start
                start = stop
        table = np.vstack([gradient.T, losses, np.full(models, rows)])
        lane = np.random.default_rng().integers(1 << 30)
        for at in range(0, len(table), COLUMNS):
            yield pa.RecordBatch.from_pydict({"lane": pa.array([lane], pa.int64()), "part": pa.array([at], pa.int64()), "sums": [table[at:at + COLUMNS].tobytes()]})

    return apply


def _added(batches):
    sums = {}
    for batch in batches:
        for lane, part, found in zip(*(batch.column(c).to_pylist() for c in ("lane", "part", "sums"))):
            more = np.frombuffer(found)
            sums[part] = (lane, sums[part][1] + more if part in sums else more)
    for part, (lane, total) in sums.items():
        yield pa.RecordBatch.from_pydict({"lane": pa.array([lane], pa.int64()), "part": pa.array([part], pa.int64()), "sums": [total.tobytes()]})


def losses_and_gradients(rows: DataFrame, trials: np.ndarray, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean loss of each model (column of ``trials``) and its gradient, all from one pass over ``rows`` (label, indices, values) in so many tasks."""
    schema = "lane long, part long, sums binary"
    weights = rows.sparkSession.sparkContext.broadcast(trials)
    try:
        sums = rows.mapInArrow(_sums(weights, len(trials) - 1), schema)
        while tasks > FAN_IN:
            tasks = -(-tasks // FAN_IN)
            sums = sums.repartition(tasks, F.pmod("lane", F.lit(tasks))).mapInArrow(_added, schema)
        ranges = -(-(len(trials) + 2) // COLUMNS)
        sums = sums.repartition(min(ranges, FAN_IN), (F.col("part") / COLUMNS).cast("long")).mapInArrow(_added, schema)
        total = {r["part"]: np.frombuffer(r["sums"]) for r in sums.toArrow().to_pylist()}
    finally:
        weights.destroy()
    table = np.concatenate([total[p] for p in sorted(total)]).reshape(-1, trials.shape[1])
    count = max(table[-1, 0], 1)
    return table[-2] / count, table[:-2] / count


def fit_together(train: DataFrame, points: list[dict[str, float]], iterations: int, features="tfidf", label="score") -> list[LogisticRegressionModel]:
    """A model for each of the points (``regParam``, ``elasticNetParam``) from kept rows with 0/1 labels.

    Features are scaled by their deviation while fitting and not shifted; the intercept starts at the log odds and is not penalised.
    """
    if train.isEmpty():
        raise ValueError("no rows to fit on")
    stats = train.agg(Summarizer.std(F.col(features)).alias("std"), F.avg(label).alias("share")).first()
    deviation = stats.std.toArray()
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    share = min(max(stats.share, 1e-9), 1 - 1e-9)
    start = np.append(np.zeros(len(scale)), math.log(share / (1 - share)))
    vector = F.unwrap_udt(features)
    sparse = F.when(vector.type == 0, vector.indices).otherwise(F.sequence(F.lit(0), F.lit(len(scale) - 1)))
    rows = train.select(F.col(label).alias("label"), sparse.alias("indices"), vector["values"].alias("values"))
    shares = [(p.get("regParam", 0.0), p.get("elasticNetParam", 0.0)) for p in points]
    penalties = [(whole * part, whole * (1 - part)) for whole, part in shares]
    fits = {p: Fit(*p, start, start.copy()) for p in penalties}  # equal penalties are one model
    scaled, tasks = np.append(scale, 1.0), rows.rdd.getNumPartitions()
    while open_ := [f for f in fits.values() if not f.done]:
        losses, gradients = losses_and_gradients(rows, np.column_stack([f.trial * scaled for f in open_]), tasks)
        for f, loss, gradient in zip(open_, losses, gradients.T):
            f.told(loss, gradient * scaled, iterations)
    return [_model(train, fits[p].at * scaled, point, features, label) for p, point in zip(penalties, points)]


def _model(train: DataFrame, weights: np.ndarray, point: dict, features: str, label: str) -> LogisticRegressionModel:
    sc = train.sparkSession.sparkContext
    kept = np.flatnonzero(weights[:-1])
    vector = Vectors.sparse(len(weights) - 1, kept, weights[kept])
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(f"joint-{abs(hash(tuple(point.items()))):x}", _py2java(sc, vector), float(weights[-1]))
    model = LogisticRegressionModel(java)
    for name, value in {"featuresCol": features, "labelCol": label, **point}.items():
        model.set(model.getParam(name), value)
    model._transfer_params_to_java()
    return model
