"""python -m kinweave.cli STAGE --data DIR --work DIR: the stages of a run over six source files and the truth.

Every table of a run stands in a folder named by all that it was made from: the
digests of the input files, the code and library versions, and those settings that
it or what it reads depends on. So a stage runs once for the same input, and other
trees don't need another retrieval. ``infer`` and ``holdout`` need the rule that
``baseline`` has tuned; nothing but ``baseline`` tunes, and nothing but the stage
``fit``, which others call, trains.
"""

from __future__ import annotations

import argparse
import csv
import dataclasses
import io
import json
import os
import shutil
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import audit, decide, export, lexical, metrics, model, pairs, tfidf
from kinweave.sources import files
from kinweave.sources import records as R

#: The columns of the log of experiments, the cuts of the retrieval benchmark, and the files of a report.
EXPERIMENT = "experiment_id date git_commit description hypothesis blocking_method candidate_recall entity_candidate_recall avg_candidates p99_candidates model features negative_strategy validation_entities precision recall macro_f0.5 singleton_accuracy india_f0.5 us_f0.5 threshold_method runtime peak_ram gpu_used notes promoted".split()
CUTS = (10, 20, 30, 50)
REPORTED = ("settings.json", "runtime.json", "manifest.json", "profile.json", "audit.json", "benchmark.json", "baseline.json", "loco.json", "rule.json", "validate.json", "experiments.csv")
#: What a package holds besides the results: folders of code, and files.
CODE, PAPERS = ("kinweave",), ("README.md",)


@dataclasses.dataclass(frozen=True)
class Settings:
    seed: int = 2026
    engine: str = "lexical"
    top_k: int = 20
    cap: int = 2048
    max_features: int = 60_000
    vocabulary_sample: int | None = None
    country_block: bool = True
    two_stage: bool = False
    rounds: int = 300
    least_rows: int = 40
    depth: int = 5
    folds: int = 3
    expected_f: bool = False
    experiment_id: str = ""
    #: Entities of each part, the first by hash; None: all.
    fit_entities: int | None = None
    tune_entities: int | None = None
    dev_entities: int | None = None
    holdout_entities: int | None = None
    benchmark_entities: int | None = 256


class Run:
    def __init__(self, spark: SparkSession, data: str, work: str, settings: Settings):
        self.spark, self.data, self.work, self.s = spark, data, work, settings
        self.manifest = [tuple(r) for r in R.manifest(spark, R.source_paths(data)).orderBy("path").collect()]
        digests = [(os.path.basename(p), n, d) for p, n, d in self.manifest]
        s = settings
        made = lambda *parts: files.fingerprint(*parts)
        self.keys = {"records": made(files.code_fingerprint(), digests, s.seed)}
        self.keys["index"] = made(self.keys["records"], s.engine, s.cap, s.max_features, s.vocabulary_sample, s.country_block)
        sizes = {p: getattr(s, f"{p}_entities") for p in ("fit", "tune", "dev", "holdout", "benchmark")}
        self.keys["pairs"] = made(self.keys["index"], s.top_k, sizes)
        self.keys["models"] = made(self.keys["pairs"], s.rounds, s.depth, s.least_rows, s.folds, s.two_stage)
        self.keys["rule"] = made(self.keys["models"], s.expected_f)
        self.truth, self.labelled = R.load_truth(spark, data)
        self._sized()

    def _sized(self) -> None:
        """What the run found when it began, and the number of shuffle partitions, kept for its later sessions."""
        path = f"{self.work}/runtime-{self.keys['records']}.json"
        told = files.get_text(self.spark, path)
        if told is None:
            size = sum(n for _, n, _ in self.manifest)
            cores = self.spark.sparkContext.defaultParallelism
            parts = max(cores, -(-size // (64 << 20)))
            told = json.dumps({"cores": cores, "input_bytes": size, "shuffle_partitions": parts, "disk_free": shutil.disk_usage(".").free})
            files.put_text(self.spark, path, told)
        self.runtime = json.loads(told)
        self.spark.conf.set("spark.sql.shuffle.partitions", self.runtime["shuffle_partitions"])

    def folder(self, kind: str, name: str) -> str:
        return f"{self.work}/{kind}-{self.keys[kind]}/{name}"

    def stored(self, kind: str, name: str, make) -> DataFrame:
        """A table of the run, made where it isn't there; Spark's _SUCCESS file tells a whole one."""
        path = self.folder(kind, name)
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @property
    def records(self) -> DataFrame:
        return R.restored(self.stored("records", "records", lambda: R.compact(R.load_records(self.spark, self.data, self.s.seed))))

    def targets(self, split: str) -> DataFrame:
        return self.records.where(f"split = '{split}' and source in (2, 3)")

    def universe(self, part: str) -> DataFrame:
        """The queries of a part, the first by hash where the settings bound them; those of the benchmark are of the fit part."""
        rows = self.records.where("source = 1")
        if part == "test":
            return rows.where("split = 'test'").select(F.col("id").alias("q"), "country")
        rows = rows.where(f"split = 'train' and part = '{'fit' if part == 'benchmark' else part}'")
        most = getattr(self.s, f"{part}_entities")
        if most is not None:
            rows = rows.orderBy("h", "id").limit(most)
        return rows.select(F.col("id").alias("q"), "country")

    def known(self, part: str) -> DataFrame:
        return self.truth.join(self.universe(part).select("q"), "q", "left_semi")

    def index(self, split: str = "train"):
        """The stored index of a split's targets: postings by key, or of each view vocabulary and texts."""
        if self.s.engine == "lexical":
            return self.stored("index", f"postings_{split}", lambda: lexical.postings(self.targets(split), self.s.country_block, self.s.cap).sortWithinPartitions("key"))
        if self.s.engine == "tfidf":
            out = []
            for view in range(len(lexical.VIEWS)):
                vocab = self.stored("index", f"vocabulary_{view}_{split}", lambda v=view: tfidf.vocabulary(self.targets(split), v, self.s.max_features, self.s.vocabulary_sample))
                out.append((vocab, self.stored("index", f"texts_{view}_{split}", lambda v=view: tfidf.texts(self.targets(split), v))))
            return out
        raise ValueError(f"no engine named {self.s.engine}")

    def retrieved(self, part: str, k: int) -> DataFrame:
        split = "test" if part == "test" else "train"
        asked = self.records.join(self.universe(part).select(F.col("q").alias("id")), "id", "left_semi")
        if self.s.engine == "lexical":
            return lexical.candidates(asked, k, self.s.country_block, self.s.cap, self.index(split))
        return tfidf.candidates(asked, k, self.s.max_features, self.s.country_block, self.s.vocabulary_sample, self.index(split))

    def candidates(self, part: str) -> DataFrame:
        return self.stored("pairs", f"candidates_{part}", lambda: self.retrieved(part, self.s.top_k))

    def features(self, part: str) -> DataFrame:
        records = self.records.where(f"split = '{'test' if part == 'test' else 'train'}'")
        return self.stored("pairs", f"features_{part}", lambda: pairs.features(self.candidates(part), records, self.truth))

    def trees(self) -> model.Settings:
        return model.Settings(rounds=self.s.rounds, depth=self.s.depth, least_rows=self.s.least_rows, folds=self.s.folds, seed=self.s.seed)

    def fit(self) -> dict:
        """Trains once and writes the models; later calls find them."""
        path = self.folder("models", "models")
        told = files.get_text(self.spark, f"{path}/done.json")
        if told is None:
            rows = self.features("fit").persist()
            if self.s.two_stage:
                first, second = model.train_stack(rows, self.trees())
            else:
                first, second = [model.train(rows, pairs.FEATURES, self.trees())], None
            rows.unpersist()
            model.save(self.spark, first, second, path)
            told = json.dumps({"first": len(first), "two_stage": second is not None, "features": self.keys["pairs"], "trained": time.strftime("%Y-%m-%dT%H:%M:%S")})
            files.put_text(self.spark, f"{path}/done.json", told)
        return json.loads(told)

    def scored(self, part: str) -> DataFrame:
        def make() -> DataFrame:
            told = self.fit()
            if told["features"] != self.keys["pairs"]:
                raise ValueError("the models were trained on other features")
            first, second = model.load(self.spark, self.folder("models", "models"), told["first"], told["two_stage"])
            rows = self.features(part)
            if second is not None:
                return model.score_stack(rows, first, second).select("q", "t", "y", F.col("p2").alias("p"))
            return model.score(rows, first[0], pairs.FEATURES).select("q", "t", "y", "p")

        return self.stored("models", f"scored_{part}", make)

    def audit(self) -> dict:
        checked = audit.checks(self.records, self.truth, self.labelled)
        audit.gate(checked, self.s.country_block)
        return {"checks": checked.head().asDict(), "profile": _rows(audit.profile(self.records))}

    def profile(self) -> dict:
        lists = R.truth_lists(self.spark, self.data)
        return {
            "sources": _rows(audit.raw_profile(self.records)),
            "files": [{"path": p, "bytes": n} for p, n, _ in self.manifest],
            "labels": audit.repeated_lists(lists).head().asDict(),
            "matches": _rows(audit.matches_per_entity(self.truth, self.labelled)),
        }

    def build_index(self) -> dict:
        for split in ("train", "test"):
            self.index(split)
        if self.s.engine != "lexical":
            return {"engine": self.s.engine}
        return {"engine": "lexical", "keys": _rows(lexical.posting_stats(self.targets("train"), self.s.country_block, self.s.cap))}

    def benchmark(self) -> dict:
        ks = sorted({*CUTS, self.s.top_k})
        uni = self.universe("benchmark")
        self.index()
        began = time.time()
        c = self.stored("pairs", f"benchmark_{ks[-1]}", lambda: self.retrieved("benchmark", ks[-1]))
        seconds, known = time.time() - began, self.known("benchmark")
        n, tests = uni.count(), self.universe("test").count()
        sizes = _rows(metrics.sizes_at(uni, c, ks).withColumn("projected_test_feature_gb", F.col("feature_gb") / max(n, 1) * tests))
        return {
            "queries": n,
            "targets": self.targets("train").count(),
            "queries_per_second": n / max(seconds, 1e-9),
            "recall": _rows(metrics.recall_at(uni.select("q"), known, c, ks)),
            "by_country": _rows(metrics.recall_at(uni, known, c, ks, "country")),
            "sizes": sizes,
        }

    def rule(self) -> dict:
        """The rule that baseline has tuned."""
        told = files.get_text(self.spark, self.folder("rule", "rule.json"))
        if told is None:
            raise RuntimeError("no rule yet: run baseline first")
        return json.loads(told)

    def tuned(self) -> dict:
        if files.get_text(self.spark, self.folder("rule", "rule.json")) is None:
            uni, known, scored = metrics.evaluated(self.universe("tune"), self.labelled), self.known("tune"), self.scored("tune")
            best = decide.best(decide.sweep(uni, known, scored)).head().asDict()
            name = "threshold"
            if self.s.expected_f:
                other = metrics.summary(metrics.per_entity(uni, known, decide.expected_select(scored))).head()["macro_f05"]
                name = decide.choose_rule(best["macro_f05"], other, True)
            files.put_text(self.spark, self.folder("rule", "rule.json"), json.dumps({"rule": name, **best}))
        return self.rule()

    def predicted(self, part: str, rule: dict) -> DataFrame:
        return decide.expected_select(self.scored(part)) if rule["rule"] == "expected_f" else decide.above(self.scored(part), rule["threshold"])

    def evaluate(self, part: str) -> dict:
        began = time.time()
        rule = self.tuned() if part == "dev" else self.rule()
        uni, known, cands = metrics.evaluated(self.universe(part), self.labelled), self.known(part), self.candidates(part)
        chosen = self.predicted(part, rule)
        found = metrics.per_entity(uni, known, chosen).persist()
        out = {
            "rule": rule,
            "part": part,
            "all": metrics.summary(found).head().asDict(),
            "by_country": _rows(metrics.summary(found, "country")),
            "recall": metrics.recall_at(uni.select("q"), known, cands, [self.s.top_k]).head().asDict(),
            "sizes": metrics.size_stats(uni.select("q"), cands).head().asDict(),
        }
        found.unpersist()
        kinds = metrics.errors(uni, known, chosen, cands)
        out["errors"] = _rows(kinds.groupBy("kind").count())
        self.note(f"errors_{part}.json", _rows(kinds.orderBy("q", "t", "kind").limit(100)))
        out["seconds"] = time.time() - began
        return out

    def baseline(self) -> dict:
        out = self.evaluate("dev")
        if not Path(f"{self.work}/experiments.csv").exists():
            self.log_experiment(out)
        return out

    def log_experiment(self, report: dict) -> None:
        """One row about a development run, as a table of comma-separated values."""
        by = {r["country"]: r["macro_f05"] for r in report["by_country"]}
        every, recall, sizes = report["all"], report["recall"], report["sizes"]
        row = {"experiment_id": self.s.experiment_id, "date": time.strftime("%Y-%m-%d"), "git_commit": files.code_fingerprint(), "description": "matching run", "blocking_method": self.s.engine}
        row |= {"candidate_recall": recall["pair_recall"], "entity_candidate_recall": recall["entity_recall"], "avg_candidates": sizes["mean"], "p99_candidates": sizes["p99"]}
        row |= {"model": "boosted trees, two stages" if self.s.two_stage else "boosted trees", "features": len(pairs.FEATURES), "negative_strategy": "all retrieved pairs of the fit entities"}
        row |= {"validation_entities": every["entities"], "precision": every["micro_precision"], "recall": every["micro_recall"], "macro_f0.5": every["macro_f05"], "singleton_accuracy": every["singleton_accuracy"]}
        row |= {"india_f0.5": by.get("India"), "us_f0.5": by.get("US"), "threshold_method": report["rule"]["rule"], "runtime": report["seconds"], "gpu_used": False, "promoted": False}
        out = io.StringIO()
        table = csv.DictWriter(out, EXPERIMENT, restval="", lineterminator="\n")
        table.writeheader()
        table.writerow(row)
        self.note("experiments.csv", out.getvalue())

    def note(self, name: str, value) -> None:
        """A small file of the run beside its tables."""
        if name.endswith(".json"):
            files.write_json(f"{self.work}/{name}", value)
        else:
            Path(self.work).mkdir(parents=True, exist_ok=True)
            Path(self.work, name).write_text(value, encoding="utf-8")

    def infer(self) -> dict:
        rule, uni = self.rule(), self.universe("test").select("q")
        m = export.id_lists(uni, self.predicted("test", rule), "matched_entity_ids")
        c = export.id_lists(uni, self.candidates("test"), "candidate_entity_ids")
        export.write_tsv(m, self.folder("rule", "matching_results"))
        export.write_tsv(c, self.folder("rule", "candidate_pairs"))
        return self.validate()

    def validate(self) -> dict:
        m = R.read_tsv(self.spark, self.folder("rule", "matching_results"), ("source1_entity_id", "matched_entity_ids"))
        c = R.read_tsv(self.spark, self.folder("rule", "candidate_pairs"), ("source1_entity_id", "candidate_entity_ids"))
        faults = export.violations(self.universe("test").select("q"), m, c, self.targets("test")).head().asDict()
        faults |= {f"{n}_out_of_order": export.out_of_order(self.spark, self.folder("rule", n)) for n in ("matching_results", "candidate_pairs")}
        if any(faults.values()):
            raise ValueError(f"invalid results: {faults}")
        return faults

    def loco(self) -> dict:
        parts = ("fit", "tune", "dev")
        universes = {p: self.universe(p) for p in parts}
        rows = {p: self.features(p).join(universes[p], "q").persist() for p in parts}
        out = model.transfer(rows, universes, self.truth, self.trees())
        found = _rows(out) if out is not None else []
        for df in rows.values():
            df.unpersist()
        return {"pairs": found}

    def report(self) -> dict:
        """A ZIP of the run's small files; raw records, examples of errors and the holdout stay out."""
        self.note("settings.json", dataclasses.asdict(self.s))
        self.note("runtime.json", self.runtime)
        self.note("manifest.json", [{"path": p, "bytes": n, "sha256": d} for p, n, d in self.manifest])
        told = files.get_text(self.spark, self.folder("rule", "rule.json"))
        if told is not None:
            self.note("rule.json", json.loads(told))
        there = [n for n in REPORTED if Path(self.work, n).is_file()]
        self.note("status.json", {"reports": there, "baseline": "baseline.json" in there, "holdout_excluded": True, "records_excluded": True, "examples_excluded": True})
        return {"files": files.pack(f"{self.work}/report.zip", {n: f"{self.work}/{n}" for n in (*there, "status.json")})}

    def package(self) -> dict:
        """A ZIP of the validated results, the code, the settings and the methodology (work/METHOD.md, without an open TODO)."""
        self.validate()
        self.note("settings.json", dataclasses.asdict(self.s))
        root = Path(__file__).resolve().parent.parent
        held = {"METHOD.md": f"{self.work}/METHOD.md", "settings.json": f"{self.work}/settings.json"}
        for n, column in (("matching_results", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
            held[f"output/{n}.tsv"] = export.joined_file(self.spark, self.folder("rule", n), f"{self.work}/{n}.tsv", ("source1_entity_id", column))
        for d in CODE:
            held |= {f"code/{p.relative_to(root)}": str(p) for p in sorted((root / d).rglob("*.py"))}
        held |= {f"code/{n}": str(root / n) for n in PAPERS}
        return {"files": len(files.pack(f"{self.work}/package.zip", held, ("METHOD.md",)))}


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


STAGES = {
    "audit": Run.audit,
    "profile": Run.profile,
    "index": Run.build_index,
    "benchmark": Run.benchmark,
    "fit": Run.fit,
    "baseline": Run.baseline,
    "holdout": lambda r: r.evaluate("holdout"),
    "infer": Run.infer,
    "validate": Run.validate,
    "loco": Run.loco,
    "report": Run.report,
    "package": Run.package,
}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--data", required=True)
    parser.add_argument("--work", required=True)
    parser.add_argument("--archive", help="a ZIP of the source files, unpacked into --data first, once")
    parser.add_argument("--settings", help="a JSON file with fields of Settings")
    a = parser.parse_args(args)
    settings = Settings(**(json.loads(Path(a.settings).read_text()) if a.settings else {}))
    data = str(files.extract(a.archive, a.data)) if a.archive else a.data
    run = Run(spark or SparkSession.builder.getOrCreate(), data, a.work, settings)
    # Labels and shared targets are checked before anything is trained on them.
    if a.stage in ("benchmark", "fit", "baseline", "holdout", "infer", "loco"):
        audit.gate(audit.checks(run.records, run.truth, run.labelled), settings.country_block)
    out = STAGES[a.stage](run)
    files.write_json(f"{a.work}/{a.stage}.json", out)
    return out


if __name__ == "__main__":
    print(json.dumps(main(), indent=2, default=str))
