"""Profiles of records and relational checks of their truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A text of white space only, in the syntax of both Spark and the SQL twin; what Python strips.
BLANK = r"^[\t-\r\x1c-\x20\x85\p{Z}]*$"


def profile(records: DataFrame) -> DataFrame:
    """Rows, empty names and empty addresses of each split, source and country."""
    return records.groupBy("split", "source", "country").agg(F.count("*").alias("n"), F.count_if(F.col("name") == "").alias("empty_name"), F.count_if(F.col("address") == "").alias("empty_address"))


def raw_profile(records: DataFrame) -> DataFrame:
    """Of each split, source and country: rows, ids with a wrong prefix, blank raw fields, the longest of them, and their bytes."""
    wrong = ~F.col("id").startswith(F.concat(F.lit("S"), F.col("source").cast("string"), F.lit("-")))
    blank = lambda c: F.count_if(F.col(c).rlike(BLANK))
    size = F.sum(F.octet_length("raw_name") + F.octet_length("raw_address")).cast("long")
    return records.groupBy("split", "source", "country").agg(
        F.count("*").alias("n"),
        F.count_if(wrong).alias("wrong_prefix"),
        blank("raw_name").alias("blank_name"),
        blank("raw_address").alias("blank_address"),
        F.max(F.length("raw_name")).alias("max_name"),
        F.max(F.length("raw_address")).alias("max_address"),
        size.alias("bytes"),
    )


def repeated_lists(lists: DataFrame) -> DataFrame:
    """One row: labelled rows, and those whose list (ids) names a target twice."""
    return lists.agg(F.count("*").alias("rows"), F.count_if(F.size("ids") != F.size(F.array_distinct("ids"))).alias("repeated_lists"))


def checks(records: DataFrame, truth: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row with the number of faults of each kind."""
    train = records.where("split = 'train'").select("id", "source", "country")
    queries = train.where("source = 1")
    targets = train.where("source in (2, 3)")
    pairs = truth.join(queries.select(F.col("id").alias("q"), F.col("country").alias("qc")), "q").join(targets.select(F.col("id").alias("t"), F.col("country").alias("tc")), "t")
    found = {
        "missing_truth_rows": queries.join(labelled, queries["id"] == labelled["q"], "left_anti"),
        "invalid_truth_queries": labelled.join(queries, labelled["q"] == queries["id"], "left_anti"),
        "invalid_truth_targets": truth.join(targets, truth["t"] == targets["id"], "left_anti"),
        "cross_country_pairs": pairs.where("qc != tc or qc = '' or tc = ''"),
        "shared_targets": truth.groupBy("t").count().where("count > 1"),
        "repeated_ids": records.groupBy("split", "id").count().where("count > 1"),
    }
    out = None
    for name, rows in found.items():
        one = rows.select(F.lit(name).alias("check")).groupBy().agg(F.count("*").alias(name))
        out = one if out is None else out.crossJoin(one)  # single rows
    return out


def gate(checked: DataFrame, country_block: bool) -> None:
    """Raises where labels are faulty or targets shared, and, under country blocks, where matches cross countries."""
    row = checked.head().asDict()
    stop = [k for k, n in row.items() if n and (k != "cross_country_pairs" or country_block)]
    if stop:
        raise ValueError(f"audit failed: {', '.join(f'{k} = {row[k]}' for k in stop)}")


def matches_per_entity(truth: DataFrame, labelled: DataFrame) -> DataFrame:
    """(matches, entities): how many labelled entities have how many matches; also 0."""
    n = truth.groupBy("q").agg(F.count("*").alias("m"))
    return labelled.join(n, "q", "left").groupBy(F.coalesce("m", F.lit(0)).cast("long").alias("matches")).agg(F.count("*").alias("entities"))
