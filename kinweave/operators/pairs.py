"""Features of query and target pairs, and the context of a pair among its query's candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions import similarity as S
from kinweave.functions import text as X
from kinweave.operators.lexical import VIEWS

SIMILARITIES = ("name_ratio", "name_token_sort", "name_token_set", "addr_ratio", "addr_token_sort", "addr_token_set", "unicode_name_ratio", "unicode_addr_ratio")
PLAIN = ("name_exact", "addr_exact", "name_missing", "addr_missing", "number_jaccard", "number_conflict", "number_missing", "country_equal", "target_source3", "name_length_ratio", "addr_length_ratio")
MIXED = ("name_addr_min", "name_addr_product")
RETRIEVAL = tuple(f"retrieval_{v}" for v in VIEWS) + tuple(f"rank_{v}" for v in VIEWS)
FEATURES = SIMILARITIES + PLAIN + MIXED + RETRIEVAL


def joined(cands: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates with the fields of both sides, as q_* and t_*. A candidate whose query or target is no record fails."""
    cols = ("source", "country", "name", "address", "latin_name", "latin_address")
    side = lambda p, on: records.select(F.col("id").alias(on), *(F.col(c).alias(f"{p}_{c}") for c in cols))
    rows = cands.join(side("q", "q"), "q", "left").join(side("t", "t"), "t", "left")
    unknown = F.raise_error(F.concat(F.lit("no record of a candidate: "), F.col("q"), F.lit(", "), F.col("t")))
    return rows.withColumn("q", F.when(F.col("q_source").isNull() | F.col("t_source").isNull(), unknown).otherwise(F.col("q")))


def _length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def plain_features(pairs: DataFrame) -> DataFrame:
    """The features that need no similarity, in built-in functions."""
    qn, tn, qa, ta = (F.col(c) for c in ("q_latin_name", "t_latin_name", "q_latin_address", "t_latin_address"))
    pairs = pairs.withColumns({"q_numbers": X.numbers(qa), "t_numbers": X.numbers(ta)})
    qs, ts = F.col("q_numbers"), F.col("t_numbers")
    union = F.size(F.array_union(qs, ts))
    flag = lambda c: c.cast("int")
    made = {
        "name_exact": flag((qn == tn) & (qn != "")),
        "addr_exact": flag((qa == ta) & (qa != "")),
        "name_missing": flag((qn == "") | (tn == "")),
        "addr_missing": flag((qa == "") | (ta == "")),
        "number_jaccard": F.when(union > 0, F.size(F.array_intersect(qs, ts)) / union).otherwise(0.0),
        "number_conflict": flag((F.size(qs) > 0) & (F.size(ts) > 0) & ~F.arrays_overlap(qs, ts)),
        "number_missing": flag((F.size(qs) == 0) | (F.size(ts) == 0)),
        "country_equal": flag((F.col("q_country") != "") & (F.col("q_country") == F.col("t_country"))),
        "target_source3": flag(F.col("t_source") == 3),
        "name_length_ratio": _length_ratio(qn, tn),
        "addr_length_ratio": _length_ratio(qa, ta),
    }
    made |= {f"retrieval_{v}": F.col(f"s_{v}") for v in VIEWS} | {f"rank_{v}": F.col(f"r_{v}") for v in VIEWS}
    return pairs.withColumns({k: c.cast("float") for k, c in made.items()})


def similarities(pairs: DataFrame) -> DataFrame:
    """The eight string similarities and the two mixes of them."""
    text = {c: F.col(c) for c in (f"{side}_{v}" for side in "qt" for v in ("name", "address", "latin_name", "latin_address"))}
    wanted = {f"{p}_{k}": (k, text[f"q_latin_{c}"], text[f"t_latin_{c}"]) for p, c in (("name", "name"), ("addr", "address")) for k in ("ratio", "token_sort", "token_set")}
    wanted |= {f"unicode_{p}_ratio": ("ratio", text[f"q_{c}"], text[f"t_{c}"]) for p, c in (("name", "name"), ("addr", "address"))}
    out = pairs.withColumn("_s", S.similarity_columns(wanted))
    out = out.withColumns({k: F.col("_s")[k].cast("float") for k in wanted}).drop("_s")
    return out.withColumns({"name_addr_min": F.least("name_ratio", "addr_ratio"), "name_addr_product": F.col("name_ratio") * F.col("addr_ratio")})


def labelled(cands: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidates with y = 1 for true pairs; true pairs that weren't retrieved aren't added."""
    return cands.join(truth.select("q", "t", F.lit(1).alias("_y")), ["q", "t"], "left").withColumn("y", F.coalesce("_y", F.lit(0))).drop("_y")


def features(cands: DataFrame, records: DataFrame, truth: DataFrame) -> DataFrame:
    """(q, t, y, and all features in order)."""
    return similarities(plain_features(joined(labelled(cands, truth), records))).select("q", "t", "y", *FEATURES)


def context(scored: DataFrame) -> DataFrame:
    """Adds p_max, p_gap, p_rank (reciprocal, ties by t) and p_sum of a pair among its query's candidates."""
    every, best = Window.partitionBy("q"), Window.partitionBy("q").orderBy(F.desc("p"), "t")
    out = scored.withColumns({"p_max": F.max("p").over(every), "p_rank": 1 / F.row_number().over(best), "p_sum": F.sum("p").over(every)})
    return out.withColumn("p_gap", F.col("p_max") - F.col("p"))
