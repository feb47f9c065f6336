"""Evaluation of predicted and retrieved pairs over a universe of queries, those without pairs included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bytes of the 27 features of a pair.
FEATURE_BYTES = 27 * 4


def f05(truth: Column, predicted: Column, hits: Column) -> Column:
    """F0.5 of one entity from counts; without truth 1 if nothing is predicted, else 0."""
    return F.when(truth == 0, (predicted == 0).cast("double")).otherwise(1.25 * hits / (0.25 * truth + predicted))


def evaluated(universe: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The universe, once it is checked: no empty or repeated query, and, with labelled (q), none without a label row. A fault fails the query that reads it."""
    others = [c for c in universe.columns if c != "q"]
    rows = universe.groupBy("q").agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in others))
    bad = F.col("q").isNull() | (F.col("q") == "") | (F.col("_n") > 1)
    if labelled is not None:
        rows = rows.join(labelled.select("q").distinct().withColumn("_known", F.lit(True)), "q", "left")
        bad = bad | F.col("_known").isNull()
    told = F.concat(F.lit("empty, repeated or unlabelled query: "), F.coalesce("q", F.lit("null")))
    return rows.withColumn("q", F.when(bad, F.raise_error(told)).otherwise(F.col("q"))).select(*universe.columns)


def per_entity(universe: DataFrame, truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """universe columns with n_truth, n_pred, n_hit and f05; a pair counts once, however often it stands."""
    true = truth.select("q", "t").distinct()
    hit = predictions.select("q", "t").distinct().join(true.withColumn("_hit", F.lit(1)), ["q", "t"], "left")
    made = hit.groupBy("q").agg(F.count("*").alias("n_pred"), F.count("_hit").alias("n_hit"))
    known = true.groupBy("q").agg(F.count("*").alias("n_truth"))
    out = universe.join(known, "q", "left").join(made, "q", "left").fillna(0, ["n_truth", "n_pred", "n_hit"])
    return out.withColumn("f05", f05(F.col("n_truth"), F.col("n_pred"), F.col("n_hit")))


def summary(entities: DataFrame, *by: str) -> DataFrame:
    """Macro F0.5, micro precision and recall, accuracy on entities without truth, and counts; overall or by columns."""
    alone = F.col("n_truth") == 0
    return entities.groupBy(*by).agg(
        F.count("*").alias("entities"),
        F.round(F.avg("f05"), 9).alias("macro_f05"),
        F.round(F.coalesce(F.try_divide(F.sum("n_hit"), F.sum("n_pred")), F.lit(0.0)), 9).alias("micro_precision"),
        F.round(F.coalesce(F.try_divide(F.sum("n_hit"), F.sum("n_truth")), F.lit(0.0)), 9).alias("micro_recall"),
        F.round(F.avg(F.when(alone, (F.col("n_pred") == 0).cast("double"))), 9).alias("singleton_accuracy"),
        F.sum("n_pred").alias("predicted"),
        F.sum("n_truth").alias("true_pairs"),
    )


def best_rank(cands: DataFrame) -> Column:
    """Best reciprocal rank of a candidate in any view."""
    return F.greatest("r_name", "r_address", "r_combined")


def recall_at(universe: DataFrame, truth: DataFrame, cands: DataFrame, ks: list[int], *by: str) -> DataFrame:
    """For each k, retrieval's recall of pairs, of entities with any match, and of entities with all, and mean candidates."""
    c = cands.select("q", "t", F.round(1 / best_rank(cands)).cast("int").alias("rank"))
    points = F.explode(F.array(*map(F.lit, ks))).alias("k")
    sizes = c.select("q", "rank", points).where("rank <= k").groupBy("q", "k").agg(F.count("*").alias("n"))
    found = truth.join(c, ["q", "t"], "left").select("q", "rank", points).groupBy("q", "k").agg(F.count("*").alias("n_truth"), F.count_if(F.col("rank") <= F.col("k")).alias("n_found"))
    rows = universe.select("q", *by, points).join(sizes, ["q", "k"], "left").join(found, ["q", "k"], "left").fillna(0, ["n", "n_truth", "n_found"])
    has = F.col("n_truth") > 0
    return rows.groupBy(*by, "k").agg(
        F.round(F.try_divide(F.sum("n_found"), F.sum("n_truth")), 9).alias("pair_recall"),
        F.round(F.avg(F.when(has, (F.col("n_found") > 0).cast("double"))), 9).alias("entity_recall"),
        F.round(F.avg(F.when(has, (F.col("n_found") == F.col("n_truth")).cast("double"))), 9).alias("complete_recall"),
        F.round(F.avg("n"), 9).alias("mean_candidates"),
    )


def size_stats(universe: DataFrame, cands: DataFrame) -> DataFrame:
    """Mean, interpolated quantiles and maximum of candidates per query, queries without any included."""
    n = universe.join(cands.groupBy("q").agg(F.count("*").alias("n")), "q", "left").fillna(0, ["n"])
    return n.agg(*_sizes())


def sizes_at(universe: DataFrame, cands: DataFrame, ks: list[int]) -> DataFrame:
    """For each k the size_stats of a retrieval cut there, and the GB of its numeric features for as many queries."""
    points = F.explode(F.array(*map(F.lit, ks))).alias("k")
    counted = cands.select("q", F.round(1 / best_rank(cands)).cast("int").alias("rank"), points).where("rank <= k").groupBy("q", "k").agg(F.count("*").alias("n"))
    n = universe.select("q", points).join(counted, ["q", "k"], "left").fillna(0, ["n"])
    return n.groupBy("k").agg(*_sizes(), (F.sum("n") * FEATURE_BYTES / 1e9).alias("feature_gb"))


def _sizes() -> list[Column]:
    return [F.round(F.avg("n"), 9).alias("mean"), F.percentile("n", F.lit(0.9)).alias("p90"), F.percentile("n", F.lit(0.99)).alias("p99"), F.max("n").alias("max")]


def errors(universe: DataFrame, truth: DataFrame, predictions: DataFrame, cands: DataFrame) -> DataFrame:
    """(q, t, kind): false_positive, singleton_error (a false positive of an entity without truth), false_negative, missed_by_blocking."""
    wrong = predictions.select("q", "t").join(truth, ["q", "t"], "left_anti").join(truth.select("q").distinct().withColumn("_has", F.lit(1)), "q", "left")
    wrong = wrong.select("q", "t", F.when(F.col("_has").isNull(), "singleton_error").otherwise("false_positive").alias("kind"))
    missed = truth.join(universe.select("q"), "q", "left_semi").join(predictions.select("q", "t"), ["q", "t"], "left_anti").join(cands.select("q", "t", F.lit(1).alias("_seen")), ["q", "t"], "left")
    return wrong.unionByName(missed.select("q", "t", F.when(F.col("_seen").isNull(), "missed_by_blocking").otherwise("false_negative").alias("kind")))
