"""Gradient-boosted scores of pairs: one stage, or stacked on out-of-fold scores; and transfer between countries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import text as X
from kinweave.operators import decide, metrics, trees
from kinweave.operators import pairs as P
from kinweave.sources import files

CONTEXT = ("p", "p_max", "p_gap", "p_rank", "p_sum")


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    depth: int = 5
    least_rows: int = 40
    rate: float = 0.06
    columns: str = "0.9"
    folds: int = 3
    seed: int = 2026


def _vectors(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="_x", handleInvalid="error").transform(df)


def train(df: DataFrame, columns: tuple[str, ...], s: Settings) -> GBTClassificationModel:
    """Boosted trees on rows with y; both classes must be there."""
    seen = {r[0] for r in df.select("y").distinct().collect()}
    if seen != {0, 1}:
        raise ValueError(f"training needs both classes, found {sorted(seen)}")
    gbt = GBTClassifier(featuresCol="_x", labelCol="y", maxIter=s.rounds, maxDepth=s.depth, stepSize=s.rate, minInstancesPerNode=s.least_rows, featureSubsetStrategy=s.columns, seed=s.seed)
    return gbt.fit(_vectors(df, columns))


def score(df: DataFrame, model: GBTClassificationModel, columns: tuple[str, ...], out: str = "p") -> DataFrame:
    scored = model.transform(_vectors(df, columns))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def fold(s: Settings):
    return F.pmod(X.entity_hash(F.col("q"), s.seed + 1), F.lit(s.folds)).cast("int")


def train_stack(df: DataFrame, s: Settings) -> tuple[list[trees.Trees], trees.Trees]:
    """One model for each fold of entities, and the second stage on their scores of the rows they didn't see."""
    rows, models, held = df.withColumn("_fold", fold(s)), [], None
    for k in range(s.folds):
        fit, rest = rows.where(F.col("_fold") != k), rows.where(F.col("_fold") == k)
        if rest.isEmpty():
            raise ValueError(f"fold {k} has no rows")
        models.append(trees.train(fit, P.FEATURES, s))
        part = trees.score(rest, models[-1:], ["p"]).withColumn("p", F.col("p").cast("float").cast("double"))
        held = part if held is None else held.unionByName(part)
    return models, trees.train(P.context(held), P.FEATURES + CONTEXT, s)


def score_stack(df: DataFrame, models: list[trees.Trees], second: trees.Trees) -> DataFrame:
    """Mean of the first-stage scores, their context, and the second stage's p."""
    own = [f"_p{i}" for i in range(len(models))]
    mean = sum(map(F.col, own[1:]), F.col(own[0])) / len(own)
    rows = trees.score(df, models, own).withColumn("p", mean).drop(*own)
    return trees.score(P.context(rows), [second], ["p2"])


def save(spark: SparkSession, models: list, second: trees.Trees | None, path: str) -> None:
    """Writes the models of one or two stages below a folder."""
    for i, m in enumerate(models):
        if isinstance(m, trees.Trees):
            files.put_text(spark, f"{path}/first_{i}", m.text())
        else:
            m.write().overwrite().save(f"{path}/first_{i}")
    if second is not None:
        files.put_text(spark, f"{path}/second", second.text())


def load(spark: SparkSession, path: str, first: int, two_stage: bool) -> tuple[list, trees.Trees | None]:
    """What save has written; first: how many models the first stage has."""
    places = [f"{path}/first_{i}" for i in range(first)]
    if not two_stage:
        return [GBTClassificationModel.load(p) for p in places], None
    *models, second = (trees.Trees.of(files.get_text(spark, p)) for p in [*places, f"{path}/second"])
    return models, second


def transfer(features: dict[str, DataFrame], universes: dict[str, DataFrame], truth: DataFrame, s: Settings) -> DataFrame | None:
    """How models of one country fare in another: one row for each ordered pair of countries.

    features and universes have the parts fit, tune and dev, with y or q and
    country. A model is trained on the fit part of the source country, its threshold
    is the best of the source's tune part, and macro F0.5 and counts are those of
    the target's dev part. The target's labels are read for that alone, the holdout
    never. Pairs with an empty side, and sources with one class, are left out.
    """
    columns = ("q", "t", "y", *P.FEATURES)
    there = {part: {r[0] for r in u.select("country").distinct().collect()} for part, u in universes.items()}
    out = None
    for a in sorted(there["fit"] & there["tune"]):
        of = lambda part, c: features[part].where(F.col("country") == c).select(*columns)
        uni = lambda part, c: universes[part].where(F.col("country") == c)
        if {r[0] for r in of("fit", a).select("y").distinct().collect()} != {0, 1}:
            continue
        model = train(of("fit", a), P.FEATURES, s)
        known = lambda u: truth.join(u.select("q"), "q", "left_semi")
        tune = score(of("tune", a), model, P.FEATURES)
        threshold = decide.best(decide.sweep(uni("tune", a), known(uni("tune", a)), tune)).head()["threshold"]
        for b in sorted(there["dev"] - {a}):
            chosen = decide.above(score(of("dev", b), model, P.FEATURES), threshold)
            one = metrics.summary(metrics.per_entity(uni("dev", b), known(uni("dev", b)), chosen))
            one = one.select(F.lit(a).alias("source_country"), F.lit(b).alias("target_country"), F.lit(threshold).alias("threshold"), "*")
            out = one if out is None else out.unionByName(one)
    return out
