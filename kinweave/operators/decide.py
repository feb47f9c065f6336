"""From scores of pairs to predicted sets: a threshold tuned on macro F0.5, or the set of highest expected F0.5."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.metrics import f05

THRESHOLDS = [float(x) for x in np.linspace(0.05, 0.99, 95)]


def above(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.where(F.col("p") >= F.lit(threshold)).select("q", "t")


def sweep(universe: DataFrame, truth: DataFrame, scored: DataFrame) -> DataFrame:
    """(threshold, macro_f05). A query's candidates become two short arrays, so the pairs aren't multiplied by the thresholds."""
    true = truth.select("q", "t", F.lit(1).alias("_hit"))
    pairs = scored.select("q", "t", "p").join(true, ["q", "t"], "left")
    lists = pairs.groupBy("q").agg(F.collect_list("p").alias("all_p"), F.collect_list(F.when(F.col("_hit").isNotNull(), F.col("p"))).alias("true_p"))
    known = truth.groupBy("q").agg(F.count("*").alias("n_truth"))
    rows = universe.select("q").join(known, "q", "left").join(lists, "q", "left").fillna(0, ["n_truth"])
    points = rows.select("n_truth", "all_p", "true_p", F.explode(F.array(*map(F.lit, THRESHOLDS))).alias("threshold"))
    count = lambda c: F.coalesce(F.size(F.filter(c, lambda p: p >= F.col("threshold"))), F.lit(0))
    none = lambda c: F.when(F.col(c).isNull(), 0).otherwise(count(c))
    return points.groupBy("threshold").agg(F.round(F.avg(f05(F.col("n_truth"), none("all_p"), none("true_p"))), 9).alias("macro_f05"))


def best(swept: DataFrame) -> DataFrame:
    """The threshold of the highest macro F0.5; the larger one on ties."""
    return swept.agg(F.max(F.struct("macro_f05", "threshold")).alias("b")).select("b.threshold", "b.macro_f05")


def expected_best(p: np.ndarray) -> tuple[int, float]:
    """How many of the probabilities, sorted falling, to predict for the highest expected F0.5, and its value; the fewest of equals.

    The truth is a set of independent members. later[k] is the distribution of how
    many of those from k on are true; hits, kept up to date in one array, that of
    the predicted ones. Predicting none is worth the chance that none is true.
    """
    p = np.asarray(p, float)
    if not ((p >= 0) & (p <= 1)).all():
        raise ValueError("probabilities must be from 0 to 1")
    n = len(p)
    later = np.zeros((n + 1, n + 1))
    later[n, 0] = 1
    for k in range(n - 1, -1, -1):
        later[k] = later[k + 1] * (1 - p[k])
        later[k, 1:] += later[k + 1, :-1] * p[k]
    hits, values, number = np.eye(1, n + 1)[0], [later[0, 0]], np.arange(n + 1)
    for k in range(1, n + 1):
        hits[1:] = hits[1:] * (1 - p[k - 1]) + hits[:-1] * p[k - 1]
        hits[0] *= 1 - p[k - 1]
        worth = 1.25 * number[:, None] / (k + 0.25 * (number[:, None] + number))
        values.append(hits @ worth @ later[k])
    best = int(np.argmax(values))
    return best, float(values[best])


def expected_select(scored: DataFrame) -> DataFrame:
    """(q, t): the predicted pairs; a group is one query's candidates, at most three times the retrieval's k."""

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["p", "t"], ascending=[False, True], kind="stable")
        return pdf.head(expected_best(pdf["p"].to_numpy(float))[0])[["q", "t"]]

    return scored.select("q", "t", "p").groupBy("q").applyInPandas(choose, "q string, t string")


def choose_rule(threshold_value: float, expected_value: float, allow_expected: bool) -> str:
    """Expected F replaces the threshold only where it is allowed and strictly better."""
    return "expected_f" if allow_expected and expected_value > threshold_value else "threshold"
