from kinweave.operators import lexical
from kinweave.sources import records as R
from kinweave.streaming.arrivals import match_arrivals


def test_arrivals_get_the_candidates_of_a_batch_run(spark, tmp_path):
    records = R.synthetic(spark, 30, "train")
    queries = records.where("source = 1")
    for part in (0, 1):
        queries.where(f"cast(substring(id, 4, 6) as int) % 2 = {part}").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(queries.schema).option("maxFilesPerTrigger", 4).parquet(str(tmp_path / "in"))
    lexical.postings(records.where("source != 1"), True, 2048).write.parquet(str(tmp_path / "index"))
    run = match_arrivals(stream, spark.read.parquet(str(tmp_path / "index")), lambda df, n: df.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={n}")), str(tmp_path / "state"), k=5)
    run.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = lexical.candidates(records, 5)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
