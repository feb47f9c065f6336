"""Records, truth and their files: strict tab-separated scans, the adapter over ``documents``, and the synthetic set."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.functions import text as X

RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def source_paths(root: str) -> list[str]:
    """The seven files of a data set."""
    return [f"{root}/{s}/{s}_source{k}.tsv" for s in ("train", "test") for k in (1, 2, 3)] + [f"{root}/train/train_ground_truth.tsv"]


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A tab-separated file with exactly these columns; quotes double inside quotes. A wrong header or row fails; empty cells are ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST", "enforceSchema": False, "encoding": "UTF-8"}
    return spark.read.schema(schema).options(**options).csv(path).select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))


def manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes, sha256) of files, each read in one task in blocks of 4 MiB; a missing file fails.

    Only names go through the table, so a file's size doesn't matter. Files that
    only Spark's readers open are read through them.
    """
    listed = [(p, str(spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getScheme() or "file")) for p in paths]
    if all(scheme == "file" for _, scheme in listed):

        @F.udf("struct<bytes:long,sha256:string>", useArrow=False)
        def told(path: str):
            digest, size = hashlib.sha256(), 0
            with open(path.removeprefix("file://").removeprefix("file:"), "rb") as f:
                while block := f.read(4 << 20):
                    digest.update(block)
                    size += len(block)
            return size, digest.hexdigest()

        rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths))
        return rows.select("path", told("path").alias("m")).select("path", "m.bytes", "m.sha256")
    return spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def with_positions(rows: DataFrame) -> DataFrame:
    """Rows of a file scan with their order in it: file, and a number that rises with the place of a row in the file.

    The number is that of the block of the file, then the row's own within its
    partition; a block is read by one task from its start on.
    """
    return rows.withColumns({"file": F.col("_metadata.file_path"), "position": F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))})


def compact(records: DataFrame) -> DataFrame:
    """Latin views that say the same as the plain ones become null; half the text where most names are Latin."""
    return records.withColumns({f"latin_{c}": F.nullif(F.col(f"latin_{c}"), F.col(c)) for c in ("name", "address")})


def restored(records: DataFrame) -> DataFrame:
    """What compact left out is put back."""
    return records.withColumns({f"latin_{c}": F.coalesce(f"latin_{c}", c) for c in ("name", "address")})


def with_views(raw: DataFrame, exact: bool = False) -> DataFrame:
    """Normalised and Latin views of raw_name and raw_address."""
    norm, lat = (X.normalize_exact, X.latin_exact) if exact else (X.normalize, X.latin)
    out = raw.withColumns({"name": norm(F.col("raw_name")), "address": norm(F.col("raw_address"))})
    return out.withColumns({"latin_name": lat(F.col("name")), "latin_address": lat(F.col("address"))})


def load_records(spark: SparkSession, root: str, seed: int = 2026, exact: bool = True) -> DataFrame:
    """The records of all six source files of a data set, with their views, entity hash and part."""
    out = None
    for split in ("train", "test"):
        for k in (1, 2, 3):
            rows = read_tsv(spark, f"{root}/{split}/{split}_source{k}.tsv", RECORD_COLUMNS)
            bad = F.raise_error(F.concat(F.lit(f"not an id of source {k}: "), F.col("entity_id")))
            rows = rows.select(F.lit(split).alias("split"), F.when(F.col("entity_id").startswith(f"S{k}-"), F.col("entity_id")).otherwise(bad).alias("id"), F.lit(k).alias("source"), "country", F.col("business_name").alias("raw_name"), F.col("business_address").alias("raw_address"))
            out = rows if out is None else out.unionByName(rows)
    h = X.blake_hash(seed)(F.col("id")) if exact else X.entity_hash(F.col("id"), seed)
    return with_views(out, exact).withColumn("h", h).withColumn("part", X.part_of(F.col("h")))


def truth_lists(spark: SparkSession, root: str) -> DataFrame:
    """(q, ids) of the label file as it stands: trimmed ids, blank ones left out, repeated ones kept."""
    rows = read_tsv(spark, f"{root}/train/train_ground_truth.tsv", TRUTH_COLUMNS)
    ids = F.filter(F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select(F.col("source1_entity_id").alias("q"), ids.alias("ids"))


def load_truth(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(q, t) pairs and the labelled entities (q), which keep those without a match. A repeated id in a list fails."""
    rows = truth_lists(spark, root)
    rows = rows.withColumn("ids", F.when(F.size("ids") == F.size(F.array_distinct("ids")), F.col("ids")).otherwise(F.raise_error(F.concat(F.lit("repeated match of "), F.col("q")))))
    return rows.select("q", F.explode("ids").alias("t")), rows.select("q").distinct()


def six_digits(number):
    """A number with zeros before it up to six digits; unlike lpad alone, longer numbers stay whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), "0")


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of three sources: the first 60 characters are the name, the next 80 the address."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").where("doc_id is not null")
    body, source = F.coalesce("text", F.lit("")), (F.col("doc_id") % 3 + 1).cast("int")
    raw = d.select(
        F.lit("train").alias("split"),
        F.concat(F.lit("S"), source.cast("string"), F.lit("-"), six_digits(F.col("doc_id"))).alias("id"),
        source.alias("source"),
        F.coalesce("lang", F.lit("")).alias("country"),
        F.substring(body, 1, 60).alias("raw_name"),
        F.substring(body, 61, 80).alias("raw_address"),
        F.md5(body.cast("binary")).alias("content"),
    )
    return with_views(raw)


def document_truth(records: DataFrame) -> DataFrame:
    """(q, t): targets with the whole text of a query; of several such queries the least owns them."""
    owner = records.where("source = 1").groupBy("content").agg(F.min("id").alias("q"))
    return records.where("source in (2, 3)").select("content", F.col("id").alias("t")).join(owner, "content").select("q", "t")


def synthetic(spark: SparkSession, n: int, split: str) -> DataFrame:
    """The generated set of records: matches in both target sources, one distractor each, some entities without a match."""
    i = F.col("id").cast("int")
    six = six_digits(i)
    name = F.concat(F.lit("Lotus "), (i % 13).cast("string"), F.lit(" Systems"))
    road = lambda kind: F.concat((100 + i).cast("string"), F.lit(f" Cedar {kind} Sector "), (i % 7).cast("string"))
    places = ["India", "US"] if split == "train" else ["India", "US", "France"]
    country = F.element_at(F.array(*map(F.lit, places)), (i % len(places) + 1).cast("int"))
    row = lambda source, prefix, a, b, when: F.when(when, F.struct(F.lit(source).alias("source"), F.concat(F.lit(prefix), six).alias("id"), a.alias("raw_name"), b.alias("raw_address")))
    rows = F.array(
        row(1, "S1-", name, road("Road"), F.lit(True)),
        row(2, "S2-", name, road("Rd"), i % 5 != 0),
        row(3, "S3-", F.upper(name), road("Road"), (i % 5 != 0) & (i % 3 == 0)),
        row(2, "S2-D", name, F.concat((9000 + i).cast("string"), F.lit(" Elm Street")), F.lit(True)),
        row(3, "S3-D", F.concat(F.lit("Unrelated Bakery "), i.cast("string")), F.lit("77 Distant Avenue"), F.lit(True)),
    )
    out = spark.range(n).select(F.lit(split).alias("split"), country.alias("country"), F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r"))
    return with_views(out.select("split", "r.id", "r.source", "country", "r.raw_name", "r.raw_address"))


def synthetic_truth(records: DataFrame) -> DataFrame:
    """(q, t) of the generated set: targets with the number of a query."""
    own = records.where("source != 1 and id not like '%D%'")
    return own.select(F.concat(F.lit("S1-"), F.expr("substring(id, 4)")).alias("q"), F.col("id").alias("t"))
