"""Result lists of every query, and the checks that they must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def id_lists(universe: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """(source1_entity_id, column): sorted, comma-joined targets of every query; '' without any."""
    lists = pairs.groupBy("q").agg(F.array_join(F.array_sort(F.collect_set("t")), ",").alias(column))
    return universe.select("q").join(lists, "q", "left").select(F.col("q").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def both_lists(universe: DataFrame, scored: DataFrame, chosen: Column) -> DataFrame:
    """(source1_entity_id, matched_entity_ids, candidate_entity_ids): the lists of id_lists of the chosen pairs and of all, from one pass over them; one row for each query."""
    rows = universe.select("q", F.lit(None).cast("string").alias("t"), F.lit(False).alias("_in")).unionByName(scored.select("q", "t", chosen.alias("_in")))
    listed = lambda t, name: F.array_join(F.array_sort(F.collect_set(t)), ",").alias(name)
    rows = rows.groupBy("q").agg(F.bool_or(F.col("t").isNull()).alias("_asked"), listed(F.when(F.col("_in"), F.col("t")), "matched_entity_ids"), listed(F.col("t"), "candidate_entity_ids"))
    return rows.where("_asked").select(F.col("q").alias("source1_entity_id"), "matched_entity_ids", "candidate_entity_ids")


def write_tsv(rows: DataFrame, path: str) -> None:
    """A folder of tab-separated parts, in the order of the ids within and across parts."""
    rows.orderBy("source1_entity_id").write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("lineSep", "\n").csv(path)


def out_of_order(spark: SparkSession, path: str) -> int:
    """How many rows of such a folder don't come after the row before them, by the order of parts and of rows in them."""
    rows = spark.read.option("sep", "\t").option("header", True).schema("id string, ids string").csv(path)
    rows = rows.select("id", F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    before = F.lag("id").over(Window.partitionBy("part").orderBy("block", "n"))
    own = rows.withColumn("before", before).groupBy("part").agg(F.count_if(F.col("before") >= F.col("id")).alias("wrong"), F.min("id").alias("low"), F.max("id").alias("high"))
    # One row for each part is left.
    over = F.lag("high").over(Window.orderBy("part"))
    return own.withColumn("over", over).agg(F.sum(F.col("wrong") + F.coalesce((F.col("over") >= F.col("low")).cast("int"), F.lit(0)))).head()[0] or 0


def joined_file(spark: SparkSession, path: str, target: str, header: tuple[str, ...]) -> str:
    """The parts of a folder of write_tsv as one file with one header; its lines pass through one by one."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(str(x.getPath()) for x in fs.listStatus(root) if x.getPath().getName().startswith("part-"))
    with open(target, "w", encoding="utf-8", newline="") as out:
        out.write("\t".join(header) + "\n")
        for part in parts:
            lines = spark.read.text(part).rdd.toLocalIterator()
            next(lines, None)
            out.writelines(f"{r[0]}\n" for r in lines)
    return target


def sides(rows: DataFrame, kind: int | Column, column: str | None = None) -> DataFrame:
    """What ``counted`` takes, (q, kind, ids), from rows of the universe (kind 0; q), or from lists of matches (1) or candidates (2)."""
    kind = F.lit(kind) if isinstance(kind, int) else kind
    if column is None:
        return rows.select("q", kind.alias("kind"), F.expr("cast(array() as array<string>)").alias("ids"))
    ids = F.filter(F.transform(F.split(column, ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select(F.col("source1_entity_id").alias("q"), kind.alias("kind"), ids.alias("ids"))


def counted(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """One row of fault counts from (q, kind, ids): every query of the universe, list of matches and list of candidates.

    All rows of a query meet in one group, and each count is a sum over the groups, so
    the lists are made once. The sums go along with the ids, which are looked up once each.
    """
    size = lambda c: F.size(c).cast("long")
    lists = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.coalesce("ids", F.array())))
    repeated = F.count_if((F.col("kind") > 0) & (F.size("ids") != F.size(F.array_distinct("ids"))))
    own = rows.groupBy("q").agg(F.count_if(F.col("kind") == 0).alias("u"), lists(1).alias("m"), lists(2).alias("c"), repeated.alias("repeated"))
    u, m, c, alone = F.col("u"), size("m"), size("c"), F.col("q").isNull()
    # A row of matches goes with every row of candidates of its query.
    beyond = F.aggregate("m", F.lit(0).cast("long"), lambda n, x: n + F.when((F.size("c") == 0) | alone, (F.size(x) > 0).cast("long")).otherwise(size(F.filter("c", lambda y: F.size(F.array_except(x, y)) > 0))))
    none = F.lit(0).cast("long")
    counts = {
        "missing_queries": F.when((m == 0) | alone, u).otherwise(none),
        "unknown_queries": F.when((u == 0) | alone, m).otherwise(none),
        "one_sided_queries": F.when((m == 0) | (c == 0) | alone, m + c).otherwise(none),
        "repeated_queries": ((m > 1) | (c > 1)).cast("long"),
        "repeated_ids": F.col("repeated"),
        "beyond_candidates": beyond,
    }
    told = F.array(F.struct(F.lit(None).cast("string").alias("t"), *(x.alias(k) for k, x in counts.items())))
    ids = F.transform(F.array_distinct(F.flatten(F.concat("m", "c"))), lambda t: F.struct(t.alias("t"), *(none.alias(k) for k in counts)))
    by_id = own.select(F.explode(F.concat(told, ids)).alias("x")).select("x.*").groupBy("t").agg(*(F.sum(k).alias(k) for k in counts))
    known = targets.select(F.col("id").alias("t"), F.lit(True).alias("known")).distinct()
    unknown = F.count_if(F.col("t").isNotNull() & F.col("known").isNull()).alias("unknown_targets")
    return by_id.join(known, "t", "left").agg(*(F.coalesce(F.sum(k), none).alias(k) for k in counts), unknown)


def violations(universe: DataFrame, matching: DataFrame, candidate: DataFrame, targets: DataFrame) -> DataFrame:
    """One row of fault counts, all 0 for valid results: coverage, repeated queries, repeated ids, matches beyond candidates, unknown targets."""
    return counted(sides(universe, 0).unionByName(sides(matching, 1, "matched_entity_ids")).unionByName(sides(candidate, 2, "candidate_entity_ids")), targets)
