"""A whole run over the generated set, and the files at its edge."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from kinweave import cli
from kinweave.sources import files
from kinweave.sources import records as R


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    for split, n in (("train", 240), ("test", 36)):
        (root / split).mkdir()
        rows = R.synthetic(spark, n, split).orderBy("id").collect()
        for k in (1, 2, 3):
            lines = ["\t".join(R.RECORD_COLUMNS)] + ["\t".join((r["id"], r["raw_name"], r["raw_address"], r["country"])) for r in rows if r["source"] == k]
            (root / split / f"{split}_source{k}.tsv").write_text("\n".join(lines) + "\n")
    train = R.synthetic(spark, 240, "train")
    truth = R.synthetic_truth(train).groupBy("q").agg(F.concat_ws(",", F.sort_array(F.collect_set("t"))).alias("ts"))
    rows = train.where("source = 1").select(F.col("id").alias("q")).join(truth, "q", "left").collect()
    (root / "train/train_ground_truth.tsv").write_text("\t".join(R.TRUTH_COLUMNS) + "\n" + "".join(f"{r['q']}\t{r['ts'] or ''}\n" for r in rows))
    return root


def test_stages(spark, data, tmp_path, monkeypatch):
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"rounds": 4, "depth": 2, "least_rows": 4, "top_k": 5}))
    work = tmp_path / "work"
    call = lambda stage: cli.main([stage, "--data", str(data), "--work", str(work), "--settings", str(settings)], spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert set(call("audit")["checks"].values()) == {0}
    told = call("profile")
    assert sum(r["entities"] for r in told["matches"]) == 240 and told["labels"] == {"rows": 240, "repeated_lists": 0}
    assert sum(r["n"] for r in told["sources"]) == 976 + 145 and len(told["files"]) == 7
    assert {r["view"] for r in call("index")["keys"]} == {0, 1, 2}
    found = call("benchmark")
    assert found["recall"][-1]["entity_recall"] == 1 and {r["k"] for r in found["sizes"]} == {5, 10, 20, 30, 50}
    with pytest.raises(RuntimeError):
        call("infer")
    out = call("baseline")
    assert out["all"]["macro_f05"] > 0.5 and out["recall"]["pair_recall"] == 1
    log = (work / "experiments.csv").read_text().splitlines()
    assert len(log) == 2 and log[0].split(",") == cli.EXPERIMENT
    # Nothing is trained or retrieved again.
    monkeypatch.setattr(cli.model, "train", lambda *_: pytest.fail("trained again"))
    monkeypatch.setattr(cli.lexical, "postings", lambda *_: pytest.fail("indexed again"))
    assert call("holdout")["rule"] == out["rule"] == call("baseline")["rule"]
    monkeypatch.undo()
    assert set(call("infer").values()) == {0} == set(call("validate").values())
    assert json.loads((work / "baseline.json").read_text())["rule"]["rule"] == "threshold"
    pairs = call("loco")["pairs"]
    assert {(r["source_country"], r["target_country"]) for r in pairs} == {("India", "US"), ("US", "India")} and all(0 <= r["macro_f05"] <= 1 for r in pairs)
    assert {"baseline.json", "rule.json", "experiments.csv", "status.json", "manifest.json"} <= set(call("report")["files"])
    with pytest.raises(FileNotFoundError):
        call("package")
    (work / "METHOD.md").write_text("done")
    call("package")
    with zipfile.ZipFile(work / "package.zip") as z:
        lines = z.read("output/matching_results.tsv").decode().splitlines()
        assert len(lines) == 37 and lines[1:] == sorted(lines[1:]) and "code/kinweave/cli.py" in z.namelist()
    # Other trees need no other retrieval.
    settings.write_text(json.dumps({"rounds": 2, "depth": 2, "least_rows": 4, "top_k": 5, "two_stage": True, "folds": 2}))
    monkeypatch.setattr(cli.lexical, "candidates", lambda *_: pytest.fail("retrieved again"))
    assert call("baseline")["all"]["macro_f05"] > 0.5
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_other_engine_and_sizes(spark, data, tmp_path):
    settings = tmp_path / "settings.json"
    settings.write_text(json.dumps({"engine": "tfidf", "max_features": 1500, "rounds": 2, "depth": 2, "least_rows": 4, "top_k": 5, "fit_entities": 100, "dev_entities": 10}))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = cli.main(["baseline", "--data", str(data), "--work", str(tmp_path / "work"), "--settings", str(settings)], spark)
    assert out["all"]["entities"] == 10 and out["all"]["macro_f05"] > 0.5
    settings.write_text(json.dumps({"engine": "none"}))
    with pytest.raises(ValueError):
        cli.main(["index", "--data", str(data), "--work", str(tmp_path / "work"), "--settings", str(settings)], spark)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stage_from_an_archive(spark, data, tmp_path):
    with zipfile.ZipFile(tmp_path / "set.zip", "w") as z:
        for p in data.rglob("*.tsv"):
            z.write(p, f"set/{p.relative_to(data)}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = cli.main(["audit", "--data", str(tmp_path / "data"), "--work", str(tmp_path / "work"), "--archive", str(tmp_path / "set.zip")], spark)
    assert set(out["checks"].values()) == {0}
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_archives(tmp_path):
    good, bad = tmp_path / "good.zip", tmp_path / "bad.zip"
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("set/train/train_source1.tsv", "x")
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("../out.txt", "x")
    assert files.extract(str(good), str(tmp_path / "a")) == (tmp_path / "a/set").resolve()
    with pytest.raises(ValueError):
        files.extract(str(bad), str(tmp_path / "b"))
    (tmp_path / "doc.md").write_text("fine")
    assert files.pack(str(tmp_path / "p.zip"), {"doc.md": str(tmp_path / "doc.md"), "no": str(tmp_path / "no")}, ("doc.md",)) == ["doc.md"]
    (tmp_path / "doc.md").write_text("TODO")
    with pytest.raises(ValueError):
        files.pack(str(tmp_path / "p.zip"), {"doc.md": str(tmp_path / "doc.md")}, ("doc.md",))
    assert files.fingerprint(1, "a") != files.fingerprint(1, "b")
