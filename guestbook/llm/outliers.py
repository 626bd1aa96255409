"""Quality rules: fixed rules first, then robust outliers of each language and source.

Every document that passes the fixed rules becomes a vector of statistics, transformed so that the bulk of ordinary texts
is near normal in each. A minimum-covariance-determinant estimate says where the bulk of a language's vectors lies, then,
with the language as its prior, where that of each of its sources does; a document whose Mahalanobis distance to its
source's estimate is beyond the cutoff is rejected.

The determinant is that of the covariance of the ``SHARE`` nearest rows, regularised by the prior: a source counts
against ``PRIOR`` rows of its language, so that a source of few documents is judged much as its language is, one of many
by itself, and no number of rows switches from one to the other. Three starts (quartile ranges; correlations of
squashed scores; of the signs of scores) take ``FIRST`` concentration steps, and the one of least determinant goes on
until it falls no more. A step is one partial aggregation of sums by (stratum, start, distance bin), so that a hot
source is summed where its rows lie; the bin that holds the last row of the share counts in part. Texts that repeat in
a source count once in its estimate.

Real vectors have longer tails than normal ones. The cube root of the squared distance of a normal vector is near normal,
so its median and upper quartile over all documents say how far out ``TAIL`` lies; the cutoff is never below that of
normal vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from statistics import NormalDist
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guestbook.llm.common import fold, scratch, text_key
from guestbook.llm.textstats import WORDS, base_stats

MIN_WORDS = 50
SHARE = 0.75
#: Rows of a language that its estimate counts for in that of a source (and all rows' quartiles in a language's).
PRIOR = 100
#: Least weight of the prior's covariance: a source of near copies keeps a fifth of its language's deviations.
LEAST_PRIOR = 0.05
#: Concentration steps of every start, and of the best one at most.
FIRST = 2
STEPS = 12
#: A step that lowers no stratum's log-determinant by more is the last.
SETTLED = 0.01
#: Variances below are rounding errors.
ROUNDING = 1e-8
#: The distance beyond which so many normal vectors lie.
TAIL = 1e-4
#: Distance bins an octave.
BINS = 32
NAMES = ["word_length", "word_spread", "signs_share", "upper_share", "letter_entropy", "variety"]
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _vector(text: str, n_words: int, word_chars: int) -> list[float]:
    """Mean and spread of word lengths, shares of signs and capitals, entropy of letters, distinct words; of no words noughts."""
    if not n_words:
        return [0.0] * len(NAMES)
    codes, counts = np.unique(np.frombuffer(text.encode("utf-32-le"), np.uint32), return_counts=True)
    letters: dict[str, int] = {}
    upper = alike = 0
    for char, n in zip(map(chr, codes), counts.tolist(), strict=True):
        if char.isalpha():
            letters[char.lower()] = letters.get(char.lower(), 0) + n
        upper += n if char.isupper() else 0
        alike += n if char.isalnum() else 0
    share = np.fromiter(letters.values(), float, len(letters)) / max(1, sum(letters.values()))
    words = WORDS.findall(text)
    lengths = np.fromiter(map(len, words), float, n_words)
    return [
        math.log(word_chars / n_words),
        float(np.log(lengths).std()),
        math.sqrt((word_chars - alike + 1) / (word_chars + 1)),
        math.sqrt((upper + 1) / (word_chars + 1)),
        float(-(share * np.log2(share)).sum()),
        math.log(len(set(map(str.lower, words)))) / math.log(n_words + 1),
    ]


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = ["" if t is None else t for t in batch["text"]]
        base = [base_stats(t) for t in texts]
        out = pd.DataFrame(base, columns=_BASE)
        out[NAMES] = np.array([_vector(t, *b[:2]) for t, b in zip(texts, base, strict=True)]).reshape(-1, len(NAMES))
        yield pd.concat([batch[["id", "key", "lang", "source"]].reset_index(drop=True), out], axis=1)


def measures(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, key, lang, source``, the five counts, ``base_failed`` and the vector of every document."""
    ids = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.col(id_column).alias("id"),
        text_key(F.col("text")).alias("key"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        "text",
    ).mapInPandas(
        _measured,
        f"id {ids}, key binary, lang string, source string, "
        + ", ".join(f"{c} long" for c in _BASE)
        + "".join(f", {c} double" for c in NAMES),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _part(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null"))


def _language() -> Column:
    return _part("lang")


def _stratum() -> Column:
    """A name for each language and source, null ones included."""
    return F.concat_ws("|", F.length(_part("lang")), _part("lang"), _part("source"))


def chi2_cdf(x: float, p: int) -> float:
    """By the series of the lower incomplete gamma function."""
    a, y = p / 2, x / 2
    term = total = 1 / a
    n = a
    while term > 1e-17 * total:
        n += 1
        term *= y / n
        total += term
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a))) if x > 0 else 0.0


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, p) < q else (low, middle)
    return high


CUTOFF = chi2_quantile(1 - TAIL, len(NAMES))
#: Makes the covariance of the nearest SHARE of a normal distribution that of the whole.
CONSISTENCY = SHARE / chi2_cdf(chi2_quantile(SHARE, len(NAMES)), len(NAMES) + 2)


#: Quantile of the standard normal distribution that belongs to TAIL, and that of the upper quartile.
_FAR, _QUARTILE = NormalDist().inv_cdf(1 - TAIL), NormalDist().inv_cdf(0.75)
_PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]
_ESTIMATE = "stratum string, start int, centre array<double>, cov array<double>, whiten array<double>, logdet double"


def regularised(
    n: float, mean: np.ndarray, cov: np.ndarray, prior_centre: np.ndarray, prior_cov: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance of ``n`` rows, drawn to the prior."""
    weight = PRIOR / (n + PRIOR)
    least = max(weight, LEAST_PRIOR)
    off = mean - prior_centre
    return mean - weight * off, (1 - least) * cov + least * prior_cov + weight * (1 - weight) * np.outer(off, off)


def _estimated(stratum: str, start: int, centre: np.ndarray, cov: np.ndarray) -> tuple:
    values, axes = np.linalg.eigh(cov)
    cov = (axes * np.maximum(values, ROUNDING)) @ axes.T
    lower = np.linalg.cholesky(cov)
    return stratum, start, centre, cov.ravel(), np.linalg.inv(lower).ravel(), 2 * float(np.log(np.diag(lower)).sum())


def _each(frame: DataFrame, estimates: Callable[..., Iterator[tuple]]) -> DataFrame:
    """The estimates that a function makes of every row (a stratum, or one with a start) of ``frame``."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [e for row in part.itertuples(index=False) for e in estimates(row)]
            yield pd.DataFrame(out, columns=["stratum", "start", "centre", "cov", "whiten", "logdet"])

    return frame.mapInPandas(batches, _ESTIMATE)


def _square(values: Sequence[float]) -> np.ndarray:
    return np.reshape(np.asarray(values, float), (len(NAMES), len(NAMES)))


def _quartiles() -> list[Column]:
    return [F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, c in enumerate(NAMES)]


def _median_and_deviation(row: Any) -> tuple[np.ndarray, np.ndarray]:
    q = np.array([list(getattr(row, f"q{i}")) for i in range(len(NAMES))], float)
    return q[:, 1], np.maximum((q[:, 2] - q[:, 0]) / 1.349, math.sqrt(ROUNDING))


def _starts(rows: DataFrame, prior: DataFrame) -> DataFrame:
    """Three estimates a stratum, all about the medians and on the scale of the quartile ranges."""
    p = len(NAMES)
    quartiles = scratch(rows.groupBy("stratum").agg(F.count("*").alias("n"), *_quartiles()), "quartiles")
    least = F.lit(math.sqrt(ROUNDING))
    scores = [
        (F.col(c) - F.col(f"q{i}")[1]) / F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, least)
        for i, c in enumerate(NAMES)
    ]
    scored = rows.join(quartiles, "stratum").select("stratum", *(z.alias(f"z{i}") for i, z in enumerate(scores)))
    norm = F.sqrt(fold([F.col(f"z{i}") * F.col(f"z{i}") for i in range(p)]) + 1e-12)
    scored = scored.select(
        "stratum",
        *(F.tanh(f"z{i}").alias(f"t{i}") for i in range(p)),
        *((F.col(f"z{i}") / norm).alias(f"u{i}") for i in range(p)),
    )
    sums = scored.groupBy("stratum").agg(
        *(F.sum(F.col(f"{name}{i}") * F.col(f"{name}{j}")).alias(f"{name}{i}_{j}") for name in "tu" for i, j in _PAIRS)
    )

    def estimates(row: Any) -> Iterator[tuple]:
        median, deviation = _median_and_deviation(row)
        correlations = [np.eye(p)]
        for name in "tu":
            r = np.empty((p, p))
            for i, j in _PAIRS:
                r[i, j] = r[j, i] = getattr(row, f"{name}{i}_{j}")
            scale = np.sqrt(np.diag(r))
            known = np.outer(scale, scale) > 0
            r = np.divide(r, np.outer(scale, scale), out=np.eye(p), where=known)
            correlations.append(r)
        target = _square(row.prior_cov)
        for start, r in enumerate(correlations):
            # Few rows have no scale of their own.
            cov = r * np.outer(deviation, deviation)
            yield _estimated(row.stratum, start, median, regularised(row.n, median, cov, median, target)[1])

    return _each(sums.join(quartiles, "stratum").join(prior, "stratum"), estimates)


def _distance() -> Column:
    """Squared Mahalanobis distance of the row to the estimate beside it."""
    p = len(NAMES)
    off = [F.col(c) - F.col("centre")[i] for i, c in enumerate(NAMES)]
    axes = [fold([F.col("whiten")[i * p + j] * off[j] for j in range(i + 1)]) for i in range(p)]
    return fold([a * a for a in axes])


def _concentrated(rows: DataFrame, estimate: DataFrame, prior: DataFrame) -> DataFrame:
    """One concentration step: the estimates of the rows nearest to the last ones."""
    off = [F.col(c) - F.col("centre")[i] for i, c in enumerate(NAMES)]
    binned = (
        rows.join(estimate.select("stratum", "start", "centre", "whiten"), "stratum")
        .select(
            "stratum",
            "start",
            F.floor(BINS * F.log2(_distance() + 1e-9)).cast("int").alias("bin"),
            *(o.alias(f"o{i}") for i, o in enumerate(off)),
        )
        .groupBy("stratum", "start", "bin")
        .agg(
            F.count("*").alias("n"),
            *(F.sum(f"o{i}").alias(f"s{i}") for i in range(len(NAMES))),
            *(F.sum(F.col(f"o{i}") * F.col(f"o{j}")).alias(f"s{i}_{j}") for i, j in _PAIRS),
        )
    )
    # Bins of a stratum are about a thousand at most, whatever its rows.
    ranked = Window.partitionBy("stratum", "start").orderBy("bin")
    before = F.sum("n").over(ranked) - F.col("n")
    wanted = F.ceil(SHARE * F.sum("n").over(Window.partitionBy("stratum", "start")))
    weight = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (wanted - before) / F.col("n")))
    sums = [f"s{i}" for i in range(len(NAMES))] + [f"s{i}_{j}" for i, j in _PAIRS]
    totals = (
        binned.withColumn("w", weight)
        .groupBy("stratum", "start")
        .agg(*(F.sum(F.col(c) * F.col("w")).alias(c) for c in ["n", *sums]))
        .join(estimate.select("stratum", "start", "centre"), ["stratum", "start"])
        .join(prior, "stratum")
    )

    def estimates(row: Any) -> Iterator[tuple]:
        p = len(NAMES)
        off = np.array([getattr(row, f"s{i}") for i in range(p)]) / row.n
        cov = np.empty((p, p))
        for i, j in _PAIRS:
            cov[i, j] = cov[j, i] = getattr(row, f"s{i}_{j}") / row.n - off[i] * off[j]
        mean = np.asarray(row.centre, float) + off
        yield _estimated(
            row.stratum,
            row.start,
            *regularised(row.n, mean, CONSISTENCY * cov, np.asarray(row.prior_centre, float), _square(row.prior_cov)),
        )

    return _each(totals, estimates)


def _least(estimates: DataFrame, *by: str) -> DataFrame:
    """Of the estimates of a stratum (and start) that of least determinant."""
    others = [c for c in estimates.columns if c not in by]
    return (
        estimates.groupBy(*by)
        .agg(F.min(F.struct("logdet", *(c for c in others if c != "logdet"))).alias("e"))
        .select(*(f"e.{c}" if c in others else c for c in estimates.columns))
    )


def minimum_determinant(rows: DataFrame, prior: DataFrame, label: str = "mcd") -> DataFrame:
    """``stratum, start, centre, cov, whiten, logdet``: the estimate of every stratum.

    ``rows`` have ``stratum`` and the statistics, ``prior`` a row ``stratum, prior_centre, prior_cov`` for each stratum.
    """
    estimate = scratch(_starts(rows, prior), f"{label}-starts")
    for _ in range(FIRST):
        estimate = scratch(_concentrated(rows, estimate, prior), f"{label}-first")
    best = scratch(_least(estimate, "stratum"), f"{label}-best")
    for _ in range(STEPS):
        last = best.select("stratum", *(F.col(c).alias(f"last_{c}") for c in best.columns[1:]))
        falls = F.col("logdet") < F.col("last_logdet")
        both = _concentrated(rows, best, prior).join(last, "stratum")
        step = scratch(
            both.select(
                "stratum",
                *(F.when(falls, F.col(c)).otherwise(F.col(f"last_{c}")).alias(c) for c in best.columns[1:]),
                (F.col("last_logdet") - F.col("logdet")).alias("fall"),
            ),
            f"{label}-step",
        )
        best = step.drop("fall")
        if (step.agg(F.max("fall")).first()[0] or 0.0) <= SETTLED:
            break
    return best


def _language_priors(rows: DataFrame) -> DataFrame:
    """What is known of a language before its rows: medians and quartile ranges of all rows."""
    found = rows.agg(*_quartiles()).first()
    empty = found is None or found["q0"] is None
    median, deviation = (np.zeros(len(NAMES)), np.ones(len(NAMES))) if empty else _median_and_deviation(found)
    return rows.select("stratum").distinct().withColumns(
        {
            "prior_centre": F.array(*map(F.lit, median.tolist())),
            "prior_cov": F.array(*map(F.lit, np.diag(deviation**2).ravel().tolist())),
        }
    )


def estimated(passed: DataFrame) -> DataFrame:
    """The estimate of every language and source, of rows ``lang, source`` and the statistics."""
    of_languages = passed.select(_language().alias("stratum"), *NAMES)
    languages = minimum_determinant(of_languages, scratch(_language_priors(of_languages), "priors"), "mcd-lang")
    known = languages.select(
        F.col("stratum").alias("language"), F.col("centre").alias("prior_centre"), F.col("cov").alias("prior_cov")
    )
    named = passed.select(_stratum().alias("stratum"), _language().alias("language")).distinct()
    prior = scratch(named.join(known, "language").drop("language"), "priors")
    return minimum_determinant(passed.select(_stratum().alias("stratum"), *NAMES), prior, "mcd-source")


def cutoff(distances: DataFrame) -> float:
    """The squared distance beyond which a document is an outlier, from the column ``distance`` of the rest."""
    found = distances.agg(F.percentile_approx(F.cbrt("distance"), [0.5, 0.75], 10000)).first()[0]
    return CUTOFF if not found else max(CUTOFF, (found[0] + _FAR * (found[1] - found[0]) / _QUARTILE) ** 3)


def verdicts(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, key, lang, source``, the counts, ``base_failed``, ``distance`` and ``kept`` of every document.

    Null and empty texts have no words and fail; a null language or source is a value of its own; rows that
    repeat are judged alike, as the verdict depends on text, language and source only, and count once in the estimates;
    very long texts are measured whole; further columns, whatever their names, aren't looked at; an empty table gives
    no rows. ``distance`` is null where the fixed rules failed.
    """
    rows = scratch(measures(docs, id_column), "measures")
    passed = rows.where(~F.col("base_failed"))
    once = scratch(
        passed.groupBy("lang", "source", "key").agg(*(F.min(c).alias(c) for c in NAMES)).drop("key"), "vectors"
    )
    estimate = scratch(estimated(once).select("stratum", "centre", "whiten"), "mcd")
    far = cutoff(once.withColumn("stratum", _stratum()).join(estimate, "stratum").select(_distance().alias("distance")))
    distance = F.when(~F.col("base_failed"), _distance())
    return (
        rows.withColumn("stratum", _stratum())
        .join(estimate, "stratum", "left")
        .withColumn("distance", distance)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= far, F.lit(False)))
        .select("id", "key", "lang", "source", *_BASE, "base_failed", "distance", "kept")
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that pass all rules, columns unchanged."""
    bad = (
        verdicts(docs)
        .where(~F.col("kept"))
        .select(F.col("key").alias("__k"), F.col("lang").alias("__l"), F.col("source").alias("__s"))
        .distinct()
    )
    same = (
        (text_key(docs["text"]) == bad["__k"])
        & docs["lang"].cast("string").eqNullSafe(bad["__l"])
        & docs["source"].cast("string").eqNullSafe(bad["__s"])
    )
    return docs.join(bad, same, "left_anti")
