"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of a text become features ``cos(W x + b)`` with fixed random ``W`` and ``b``, whose inner products approximate
a Gaussian kernel. Every partition of labelled rows sums its part of the normal equations; the sums have one size
whatever the rows. Rows that the fit didn't see are counted by score bins and calibrated by pooling adjacent
violators. Features are computed once for all documents; labels meet them on the document id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import scratch
from guestbook.llm.textstats import shape

#: Random features, width of the kernel in standard deviations, ridge penalty for each labelled row.
FEATURES = 384
WIDTH = 3.0
RIDGE = 1e-4
#: Labelled rows that are used at most, those of least hash; a bound on the fit, not on what is scored.
LABELLED = 1_000_000
#: Of them, one in so many calibrates instead of fitting.
CALIBRATES = 3
BINS = 2048
SEED = 7
NAMES = list(shape(""))
_LOG = {"words", "symbols", "pipes", "bangs", "digits", "lines", "runs", "repeated", "dup_lines", "short", "long"}
_SCALE = {name: 1.0 if name == "words" else 1e3 for name in _LOG}


def vector(text: str | None) -> list[float]:
    """The statistics, those with long tails by their logarithm."""
    stats = shape(text)
    return [float(np.log1p(v * _SCALE[k])) if k in _LOG else float(v) for k, v in stats.items()]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def statistics(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, held_out, x`` of every document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "x": [vector(t) for t in batch["text"]]})

    ids = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("id"), "text").mapInPandas(rows, f"id {ids}, x array<double>")
    return found.withColumn("held_out", held_out(F.col("id")))


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _features(x, self.centre, self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.values)


def _features(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    random = np.random.default_rng(SEED)
    turn = random.normal(size=(x.shape[1], FEATURES)) / WIDTH
    shift = random.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((x - centre) / scale, -8, 8)
    return np.hstack([np.cos(z @ turn + shift) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))])


def _stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float).reshape(-1, len(NAMES))


def _labelled(stats: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``x, y, part``: rows to learn from, ``part`` 0 of which calibrates. A document's labels are averaged."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").alias("__id")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    rows = marked.withColumn("h", F.xxhash64(F.lit(SEED), "__id"))
    n = rows.count()
    if n > most:  # the rows of least hash, about as many as the bound
        rows = rows.where(F.col("h") < int(-(2**63) + most / n * 2**64))
    part = F.pmod("h", F.lit(CALIBRATES))
    one_each = stats.where(~F.col("held_out")).join(rows, F.col("id") == F.col("__id"))
    return one_each.select("x", "y", part.alias("part"))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", most: int = LABELLED) -> Model:
    """Learn from at most about ``most`` labelled documents that aren't held out."""
    rows = scratch(_labelled(stats, labels, label, most), "labelled").coalesce(64)
    p = len(NAMES)
    each = [F.col("x")[i] for i in range(p)]
    moments = rows.agg(
        F.count("*").alias("n"), F.avg("y").alias("mean"), *(F.avg(c) for c in each), *(F.stddev_pop(c) for c in each)
    ).first()
    prior = 0.5 if moments["mean"] is None else moments["mean"]
    if not moments["n"] or prior in (0.0, 1.0):
        flat = np.zeros(p), np.ones(p), np.zeros(FEATURES + 1), np.array([0.0]), np.array([prior])
        return Model(*flat)
    centre, scale = np.array(moments[2 : 2 + p]), np.maximum(np.array(moments[2 + p :]), 1e-3)

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, target, n = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), 0
        for batch in batches:
            z = _features(_stacked(batch["x"]), centre, scale)
            gram += z.T @ z
            target += z.T @ batch["y"].to_numpy()
            n += len(z)
        if n:
            yield pd.DataFrame({"gram": [gram.tobytes()], "target": [target.tobytes()], "n": [n]})

    # A row for each of at most 64 partitions, all of one size.
    sums = rows.where("part <> 0").mapInPandas(equations, "gram binary, target binary, n long").collect()
    if not sums:
        return Model(centre, scale, np.zeros(FEATURES + 1), np.array([0.0]), np.array([prior]))
    gram = sum(np.frombuffer(r["gram"]) for r in sums).reshape(FEATURES + 1, FEATURES + 1)
    target = sum(np.frombuffer(r["target"]) for r in sums)
    penalty = RIDGE * sum(r["n"] for r in sums) * np.eye(FEATURES + 1)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty + 1e-9 * np.eye(FEATURES + 1), target)
    raw = Model(centre, scale, weights, np.array([0.0]), np.array([prior]))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"s": raw.raw(_stacked(batch["x"])), "y": batch["y"]})

    scores = rows.where("part = 0").mapInPandas(scored, "s double, y double")
    width = F.lit(BINS / 3.0)  # ridge scores of 0/1 labels lie about them
    counted = (
        scores.groupBy(F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("s"))) * width).alias("bin"))
        .agg(F.avg("s").alias("s"), F.sum("y").alias("y"), F.count("*").alias("n"))
        .orderBy("bin")
        .collect()  # at most BINS + 1 rows
    )
    knots, values = isotonic([(r["s"], r["y"], r["n"]) for r in counted], prior)
    return Model(centre, scale, weights, knots, values)


def isotonic(bins: list[tuple[float, float, int]], prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ``(score, positives, rows)`` in order of score; one row of the prior smooths a pool."""
    pools: list[list[float]] = []
    for score, positives, rows in bins:
        pools.append([score * rows, positives, rows])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if not pools:
        return np.array([0.0]), np.array([prior])
    knots = np.array([s / n for s, _, n in pools])
    values = np.maximum.accumulate([(y + prior) / (n + 1) for _, y, n in pools])
    # Beyond the outer pools scores go on to rise, to 0 and 1 far out, so that they still tell rows apart.
    knots = np.concatenate([[min(-2.0, knots[0] - 1)], knots, [max(3.0, knots[-1] + 1)]])
    return knots, np.concatenate([[0.0], values, [1.0]])


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``id, held_out, score`` of every document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"id": batch["id"], "held_out": batch["held_out"], "score": model.scores(_stacked(batch["x"]))}
            )

    ids = stats.schema["id"].dataType.simpleString()
    return stats.select("id", "held_out", "x").mapInPandas(rows, f"id {ids}, held_out boolean, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``id, held_out, score`` of every document, learned from ``labels`` of those that aren't held out.

    Null and empty texts are scored as texts without words. Rows that repeat score alike. Labels of unknown documents and
    null labels aren't used, differing labels of a document are averaged; a document without an id isn't held out
    and has no label. Without labels of both kinds all scores are the labels' mean, or 0.5. An empty table gives no rows.
    """
    stats = scratch(statistics(docs), "statistics")
    return scored(stats, fit(stats, labels, label))
