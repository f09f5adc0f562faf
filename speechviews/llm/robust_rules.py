"""Quality rules by robust multivariate outliers: minimum covariance determinant per language and source.

Every document becomes a vector of transformed statistics. For each (lang, source), and for all documents together, the
location and scatter of the most central three quarters are found by concentration steps from three deterministic
starts (medians with deviations alone, with correlations of hyperbolic tangents, and of spatial signs). Steps go on until
the log determinant falls by less than ``TOLERANCE``; the start with the least determinant wins. All sums are partial
aggregates, so a source with most of the rows costs no more in one task. A group of n documents is judged by its own
estimate with weight n / (n + ``PRIOR``) and that of all documents with the rest, at every n. A document whose squared
Mahalanobis distance exceeds ``CUTOFF`` is rejected. The scatter has a floor per statistic, so that a statistic
without spread does not reject on a trace.

Nulls: a null text is empty and fails the base rules; a null lang or source is a value of its own. Repeated rows count
each. An empty table gives no rows.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from speechviews.llm.common import stored
from speechviews.session import broadcast_if_small

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals")
MIN_WORDS = 50
SHARE = 0.75
TOLERANCE = 0.01
PRIOR = 50
CUTOFF = 45.0
BIN, DISTANCE_BIN = 1 / 64, 1 / 32
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def counts_of(text: bytes) -> tuple:
    """The base statistics of one text, and its capital letters."""
    words = text.split()
    if not words:
        return 0, 0, 0, 0, 0, 0
    data = np.frombuffer(text, np.uint8)
    inside = b"".join(words)
    chars = len(inside) - int(((np.frombuffer(inside, np.uint8) & 0xC0) == 0x80).sum())
    lines = [line for line in text.split(b"\n") if line.split()] if b"\n" in text else ()
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    repeated = 0
    if len(words) > 3 and len(number) <= len(words) - 1:
        key = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:] if len(number) < 2_000_000 else _mixed(ids)
        _, where, n = np.unique(key, return_inverse=True, return_counts=True)
        twice = n[where] > 1
        if twice.any():
            cover = np.zeros(len(words), bool)
            for k in range(3):
                cover[k:k + len(twice)] |= twice
            repeated = int(cover.sum())
    capitals = int(((data >= 65) & (data <= 90)).sum())
    return len(words), chars, int(_IS_SYMBOL[data].sum()), len(lines) - len(set(lines)), repeated, capitals


def _mixed(ids):
    """Windows of a text with millions of different words, as exact numbers of pairs of numbers."""
    pairs = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)[1]
    return pairs[:-1] * (ids.max() + 1) + ids[2:]


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``rule_counts``; all other columns pass through."""
    docs = docs.drop("rule_counts")
    fields = ", ".join(f"{c}: bigint" for c in COUNTS)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [counts_of(t.as_py() or b"") for t in texts]
            arrays = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))]
            yield pa.record_batch([*batch.columns, pa.StructArray.from_arrays(arrays, list(COUNTS))], [*batch.schema.names, "rule_counts"])

    extra = docs.sparkSession.createDataFrame([], f"rule_counts struct<{fields}>").schema
    return docs.mapInArrow(run, type(docs.schema)([*docs.schema.fields, *extra.fields]))


def vector(c="rule_counts"):
    """The transformed statistics as columns x0, x1, ...; and the floors of their scatter."""
    g = lambda name: F.col(f"{c}.{name}").cast("double")
    words, chars = g("n_words") + 1, g("word_chars") + 1
    return [
        F.log(words), F.log(chars / words), F.sqrt(g("n_symbols") / chars), F.sqrt(g("n_dup_lines") / words),
        F.sqrt(g("n_repeat_words") / words), F.sqrt(g("n_capitals") / chars),
    ]


FLOORS = np.array([1.0, 0.15, 0.04, 0.05, 0.12, 0.06])
DIMS = len(FLOORS)
X = [f"x{i}" for i in range(DIMS)]


def _quantile(rows: DataFrame, value: str, q: float, width: float) -> DataFrame:
    """``group, k, <value>``: upper edge of the bin that holds the quantile; counts of all rows."""
    bins = rows.groupBy("group", "k", F.floor(F.col(value) / width).alias("bin")).count()
    by = Window.partitionBy("group", "k")
    run = F.sum("count").over(by.orderBy("bin"))
    passed = bins.withColumns({"run": run, "n": F.sum("count").over(by)}).where(F.col("run") >= F.ceil(F.col("n") * q))
    return passed.groupBy("group", "k").agg(((F.min("bin") + 1) * width).alias(value))


def _group(*names):
    return F.to_json(F.struct(*names))


def fit(stats: DataFrame) -> DataFrame:
    """``group, n, center, inverse, logdet`` of every (lang, source) and of all rows together (group ``*``).

    ``logdet`` is that of the group's own scatter; ``center`` and ``inverse`` are shrunk towards those of all rows.
    """
    own = stats.select(F.explode(F.array(_group("lang", "source"), F.lit("*"))).alias("group"), *X)
    model = stored(_starts(own), "rules-model")
    while model.where("falling").head():
        model = stored(_concentrated(own, model), "rules-model")
    best = F.min_by(F.struct("n", "center", "scatter", "logdet"), F.struct("logdet", "start")).alias("best")
    best = stored(model.groupBy("group").agg(best).select("group", "best.*"), "rules-best")
    whole = best.where("group = '*'").first()
    pooled = (np.array(whole.center), np.array(whole.scatter).reshape(DIMS, DIMS)) if whole else None

    def run(frames):
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                w = 1.0 if r.group == "*" else r.n / (r.n + PRIOR)
                center, scatter = _shrunk(w, np.array(r.center), np.array(r.scatter).reshape(DIMS, DIMS), *pooled)
                rows.append((r.group, r.n, center.tolist(), _inverse(scatter), r.logdet))
            yield pd.DataFrame(rows, columns=["group", "n", "center", "inverse", "logdet"])

    return best.mapInPandas(run, "group string, n long, center array<double>, inverse array<double>, logdet double")


def _shrunk(w, center, scatter, pooled_center, pooled_scatter):
    """Center and scatter of a mixture: share ``w`` of the group's own estimate, the rest of that of all rows."""
    off = center - pooled_center
    return pooled_center + w * off, w * scatter + (1 - w) * pooled_scatter + w * (1 - w) * np.outer(off, off)


_MODEL = "group string, start int, n long, center array<double>, scatter array<double>, inverse array<double>, logdet double"
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]


def _starts(own: DataFrame) -> DataFrame:
    """Three starts a group, all around its medians: no correlation, that of hyperbolic tangents, that of spatial signs."""
    long = own.select("group", F.posexplode(F.array(*X)).alias("k", "v"))
    middle = stored(_quantile(long, "v", 0.5, BIN).withColumnRenamed("v", "middle"), "rules-middle")
    off = long.join(_small(middle), ["group", "k"]).withColumn("v", F.abs(F.col("v") - F.col("middle")))
    spread = _quantile(off, "v", 0.5, BIN).withColumnRenamed("v", "spread")
    scales = middle.join(spread, ["group", "k"]).groupBy("group").agg(F.sort_array(F.collect_list(F.struct("k", "middle", "spread"))).alias("s"))
    scales = stored(scales.select("group", F.col("s.middle").alias("middle"), F.col("s.spread").alias("spread")), "rules-scales")
    z = [(F.col(x) - F.col("middle")[k]) / F.sqrt((1.4826 * F.col("spread")[k]) ** 2 + float(FLOORS[k]) ** 2) for k, x in enumerate(X)]
    rows = own.join(_small(scales), "group").withColumns({f"z{k}": v for k, v in enumerate(z)})
    length = F.sqrt(sum((F.col(f"z{k}") ** 2 for k in range(1, DIMS)), F.col("z0") ** 2))
    rows = rows.withColumn("length", F.greatest(length, F.lit(1e-12)))
    rows = rows.select("group", *[F.tanh(f"z{k}").alias(f"t{k}") for k in range(DIMS)], *[(F.col(f"z{k}") / F.col("length")).alias(f"u{k}") for k in range(DIMS)])
    sums = [F.count("*").alias("n"), *[F.sum(f"t{k}").alias(f"t{k}") for k in range(DIMS)]]
    sums += [F.sum(F.col(f"{c}{i}") * F.col(f"{c}{j}")).alias(f"{c}{i}_{j}") for c in "tu" for i, j in PAIRS]
    moments = rows.groupBy("group").agg(*sums).join(scales, "group")

    def run(frames):
        for frame in frames:
            rows = []
            for r in frame.to_dict("records"):
                mean = np.array([r[f"t{k}"] for k in range(DIMS)]) / r["n"]
                scale = 1.4826 * np.array(r["spread"])
                tanh, sign = (_symmetric([r[f"{c}{i}_{j}"] / r["n"] for i, j in PAIRS]) for c in "tu")
                for start, c in enumerate((np.eye(DIMS), tanh - np.outer(mean, mean), sign)):
                    scatter = _correlation(c) * np.outer(scale, scale)
                    rows.append((r["group"], start, r["n"], r["middle"], scatter.ravel().tolist(), _inverse(scatter), np.inf))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _MODEL.split(", ")])

    return moments.mapInPandas(run, _MODEL).withColumn("falling", F.lit(True))


def _symmetric(values):
    out = np.zeros((DIMS, DIMS))
    for (i, j), v in zip(PAIRS, values):
        out[i, j] = out[j, i] = v
    return out


def _correlation(covariance):
    """Correlations; a statistic without spread is correlated with none."""
    spread = np.sqrt(np.maximum(np.diag(covariance), 0))
    some = spread > 1e-9
    out = np.where(np.outer(some, some), covariance / np.maximum(np.outer(spread, spread), 1e-18), 0.0)
    np.fill_diagonal(out, 1.0)
    return out


def _small(table: DataFrame) -> DataFrame:
    """A table of few rows a group, broadcast when proven small: the rows of a large group then stay where they are."""
    return broadcast_if_small(table, max_rows=50_000)[0]


def _inverse(scatter) -> list[float]:
    return np.linalg.inv(scatter + np.diag(FLOORS**2)).ravel().tolist()


def _concentrated(own: DataFrame, model: DataFrame) -> DataFrame:
    """One concentration step of all starts whose determinant fell in the last one.

    The moments of a group are added up by bins of the distance in one pass; those of the nearest bins are the
    moments of its central share. A start keeps its estimate, and stops, when the new determinant is no smaller.
    """
    active = _small(model.where("falling").select("group", "start", "center", "inverse"))
    near = own.join(active, "group").withColumn("bin", F.floor(F.log(distance() + 1e-6) / DISTANCE_BIN))
    sums = [F.count("*").alias("m"), *[F.sum(x).alias(x) for x in X], *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in PAIRS]]
    bins = near.groupBy("group", "start", "bin").agg(*sums)

    def central(frame):
        frame = frame.sort_values("bin")
        n, reached = int(frame["m"].sum()), frame["m"].cumsum().to_numpy()
        inner = frame.iloc[:int(np.searchsorted(reached, np.ceil(SHARE * n))) + 1]
        m = inner["m"].sum()
        center = inner[X].sum().to_numpy() / m
        scatter = CONSISTENCY * (_symmetric([inner[f"s{i}_{j}"].sum() / m for i, j in PAIRS]) - np.outer(center, center))
        logdet = np.linalg.slogdet(scatter + np.diag(FLOORS**2))[1]
        values = (frame["group"].iloc[0], frame["start"].iloc[0], n, center.tolist(), scatter.ravel().tolist(), _inverse(scatter), logdet)
        return pd.DataFrame([values], columns=[c.split()[0] for c in _MODEL.split(", ")])

    found = bins.groupBy("group", "start").applyInPandas(central, _MODEL).select("group", "start", F.struct("center", "scatter", "inverse", "logdet").alias("new"))
    both = model.join(found, ["group", "start"], "left").withColumn("falls", F.coalesce(F.col("new.logdet") < F.col("logdet") - TOLERANCE, F.lit(False)))
    chosen = [F.when(F.col("falls"), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in ("center", "scatter", "inverse", "logdet")]
    return both.select("group", "start", "n", *chosen, F.col("falls").alias("falling"))


#: Makes the scatter of the central three quarters of normal rows in six dimensions that of all: 0.75 / P(chi2_8 <= q), q the 0.75 quantile of chi2_6.
CONSISTENCY = 1.362


def distance():
    """Squared Mahalanobis distance of x0, x1, ... from ``center`` under ``inverse``."""
    off = [F.col(X[i]) - F.col("center")[i] for i in range(DIMS)]
    total = F.lit(0.0)
    for i in range(DIMS):
        for j in range(DIMS):
            total = total + off[i] * off[j] * F.col("inverse")[i * DIMS + j]
    return total


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` with ``rule_counts``, ``base_failed``, ``distance2`` and ``kept``, which replace columns of the same name.

    Two passes over the texts; no text is shuffled.
    """
    own_names = ("lang", "source", "text")
    names = [c for c in docs.columns if c.lower() not in ("rule_counts", "base_failed", "distance2", "kept")]
    inner = {c: c if c in own_names else f"column_{k}" for k, c in enumerate(names)}
    docs = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in inner.items()])
    counted = with_counts(docs.select("lang", "source", "text")).drop("text").withColumns(dict(zip(X, vector())))
    model = fit(stored(counted, "rules-stats"))
    own = _small(stored(model.where("group <> '*'").select("group", "center", "inverse"), "rules-groups"))
    rows = with_counts(docs).withColumns(dict(zip(X, vector()))).withColumn("group", _group("lang", "source"))
    rows = rows.join(own, "group")
    n, r = F.col("rule_counts.n_words"), F.col("rule_counts.n_repeat_words")
    rows = rows.withColumns({"base_failed": (n < MIN_WORDS) | (100 * r > 50 * n), "distance2": distance()})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("distance2") <= cutoff)).select(
        *[F.col(i).alias(c) for c, i in inner.items()], "rule_counts", "base_failed", "distance2", "kept"
    )


def passing(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep; columns unchanged."""
    names = [c if c in ("lang", "source", "text") else f"in_{k}" for k, c in enumerate(docs.columns)]
    return judged(docs.toDF(*names)).where("kept").select(*names).toDF(*docs.columns)
