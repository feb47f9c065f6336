"""Sources, text functions, hashes and similarities against literal values and the generated set."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinweave.functions import similarity as S
from kinweave.functions import text as X
from kinweave.operators import audit
from kinweave.sources import records as R


@pytest.fixture(scope="module")
def train(spark):
    return R.synthetic(spark, 240, "train").cache()


def test_exact_normalisation():
    assert X.normalize_text("Straße & Co.") == "strasse co"
    assert X.normalize_text("ＡＢＣ １２") == "abc 12"
    assert X.normalize_text("x²½") == "x21 2"
    assert X.normalize_text("ﬁne—dash") == "fine dash"
    assert X.normalize_text("ಕನ್ನಡ") == "ಕನ್ನಡ"
    assert X.normalize_text(None) == ""
    assert X.latin_text("çà et là") == "ca et la"


def test_native_normalisation(spark):
    df = spark.createDataFrame([("  Été, À-Côté! 12 ",), (None,), ("Öl & Straße",)], "x string")
    out = df.select(X.normalize(F.col("x")).alias("n")).select("n", X.latin(F.col("n")).alias("l")).collect()
    assert [tuple(r) for r in out] == [("été à côté 12", "ete a cote 12"), ("", ""), ("öl straße", "ol strasse")]


def test_entity_hash_values(spark):
    df = spark.createDataFrame([("S1-000000",), ("S1-000001",), ("S1-example",)], "id string")
    assert [r[0] for r in df.select(X.blake_hash(2026)(F.col("id"))).collect()] == [349256104482948130, 71290843380931917, 2169701249098159333]
    parts = df.select(X.part_of(X.blake_hash(2026)(F.col("id")))).collect()
    assert [r[0] for r in parts] == ["fit", "dev", "fit"]


def test_numbers(spark):
    assert spark.range(1).select(X.numbers(F.lit("12 a 007 12"))).head()[0] == ["12", "007"]


def test_common_subsequence():
    assert S.lcs("kitten", "sitting") == 4 and S.lcs("abcdef", "acf") == 3 and S.lcs("", "x") == 0

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j, x=x, row=row: row[j - 1] + 1 if x == b[j - 1] else max(row[j], left), initial=0))
        return row[-1]

    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(12))) for _ in range(2))
        assert S.lcs(a, b) == plain(a, b)


def test_token_ratios():
    assert S.token_sort_ratio("b a", "a b") == 1
    assert S.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 1
    assert S.token_set_ratio("a b", "c d") == S.ratio("a b", "c d")
    assert S.token_set_ratio("", "a") == 0


def test_generated_counts(spark, train):
    assert [r[1] for r in sorted(train.groupBy("source").count().collect())] == [240, 432, 304]
    assert [r[1] for r in sorted(R.synthetic(spark, 36, "test").groupBy("source").count().collect())] == [36, 64, 45]
    truth = R.synthetic_truth(train)
    labelled = train.where("source = 1").select(F.col("id").alias("q"))
    assert truth.count() == 256
    assert dict(audit.matches_per_entity(truth, labelled).collect())[0] == 48
    checked = audit.checks(train, truth, labelled)
    assert set(checked.head().asDict().values()) == {0}
    audit.gate(checked, True)


def test_audit_finds_faults(spark, train):
    truth = spark.createDataFrame([("S1-000001", "S2-000001"), ("S1-000002", "S2-000001"), ("S1-000003", "S2-999999")], "q string, t string")
    labelled = spark.createDataFrame([("S1-000001",), ("S1-nobody",)], "q string")
    row = audit.checks(train, truth, labelled).head().asDict()
    assert row == {"missing_truth_rows": 239, "invalid_truth_queries": 1, "invalid_truth_targets": 1, "cross_country_pairs": 1, "shared_targets": 1, "repeated_ids": 0}
    with pytest.raises(ValueError):
        audit.gate(audit.checks(train, truth, labelled), False)
    assert audit.checks(train.unionByName(train.limit(3)), truth, labelled).head()["repeated_ids"] == 3


def test_files(spark, tmp_path):
    for split in ("train", "test"):
        (tmp_path / split).mkdir()
        for k in (1, 2, 3):
            body = "﻿" * (k == 1) + "\t".join(R.RECORD_COLUMNS) + f'\nS{k}-1\t"A ""B"" Straße"\t\tFrance\n'
            (tmp_path / split / f"{split}_source{k}.tsv").write_text(body, encoding="utf-8")
    (tmp_path / "train/train_ground_truth.tsv").write_text("\t".join(R.TRUTH_COLUMNS) + "\nS1-1\tS2-1, S3-1\nS1-2\t\n")
    rows = R.load_records(spark, str(tmp_path)).collect()
    assert len(rows) == 6 and {r["name"] for r in rows} == {"a b strasse"} and {r["raw_address"] for r in rows} == {""}
    pairs, labelled = R.load_truth(spark, str(tmp_path))
    assert sorted(map(tuple, pairs.collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-1")]
    assert sorted(r[0] for r in labelled.collect()) == ["S1-1", "S1-2"]
    assert R.manifest(spark, R.source_paths(str(tmp_path))).count() == 7
    for bad in ("entity_id\tname\n1\t2\n", "\t".join(R.RECORD_COLUMNS) + "\nS1-1\tx\n", "\t".join(R.RECORD_COLUMNS) + "\nS9-1\tx\ty\tz\n"):
        (tmp_path / "test/test_source1.tsv").write_text(bad)
        with pytest.raises(Exception):  # noqa: B017
            R.load_records(spark, str(tmp_path)).collect()
    (tmp_path / "train/train_ground_truth.tsv").write_text("\t".join(R.TRUTH_COLUMNS) + "\nS1-1\tS2-1,S2-1\n")
    with pytest.raises(Exception):  # noqa: B017
        R.load_truth(spark, str(tmp_path))[0].collect()


def test_long_ids_stay_whole(spark, tmp_path):
    ids = [7, 999_999, 1_000_001, 1_000_004, 1_000_007, 12_345_678]
    spark.createDataFrame([(i, f"text {i}", "en") for i in ids], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"] for r in R.from_documents(spark, str(tmp_path)).collect()}
    assert got == {f"S{i % 3 + 1}-{i:06d}" for i in ids}


def test_compact_views_come_back(spark, train):
    mixed = train.withColumn("latin_name", F.when(F.col("source") == 1, F.lit("other")).otherwise(F.col("latin_name")))
    small = R.compact(mixed)
    assert small.where("source = 1 and latin_name is null").count() == 0 and small.where("source != 1 and latin_name is not null").count() == 0
    assert sorted(map(tuple, R.restored(small).collect())) == sorted(map(tuple, mixed.collect()))


def test_positions_in_files(spark, tmp_path):
    path = tmp_path / "rows.tsv"
    path.write_text("\t".join(R.RECORD_COLUMNS) + "\n" + "".join(f"S1-{i}\tn\ta\tc\n" for i in range(200)))
    schema = ", ".join(f"{c} string" for c in R.RECORD_COLUMNS)
    rows = R.with_positions(spark.read.schema(schema).option("sep", "\t").option("header", True).csv(str(path))).orderBy("file", "position").collect()
    assert [r["entity_id"] for r in rows] == [f"S1-{i}" for i in range(200)]


def test_latin_spelling_loses_no_letter():
    assert X.latin_text(X.normalize_text("Ελλάδα")) != "" and X.latin_text("ಕನ್ನಡ").startswith("ka")
    one, other = X.latin_text("日本"), X.latin_text("中国")
    assert one and other and one != other
    assert X.latin_text("١٢٣") == "123"


def test_similarities_in_one_crossing(spark):
    rows = [("lotus systems", "systems lotus"), ("", "a"), (None, "a"), ("x", "x"), ("ab cd", "ab ce"), ("ab cd", "ab ce")]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(S.similarity_columns({"r": ("ratio", a, b), "s": ("token_sort", a, b), "t": ("token_set", b, a)}).alias("x")).select("x.*").collect()
    want = [(S.ratio(x, y), S.token_sort_ratio(x, y), S.token_set_ratio(y, x)) if x and y else (0, 0, 0) for x, y in rows]
    assert [tuple(r) for r in got] == want
    r = random.Random(2)
    for _ in range(300):
        x, y = ("".join(r.choice("ab ") for _ in range(r.randrange(1, 14))) for _ in range(2))
        assert S.ratio(x, y) == pytest.approx(2 * S.lcs(x, y) / (len(x) + len(y)))


def test_ratios_of_many_pairs(monkeypatch):
    """Many pairs at once give what each gives alone: any lengths and letters, and small tables."""
    r = random.Random(3)
    some = lambda n, letters: "".join(r.choice(letters) for _ in range(r.randint(0, n)))
    pairs = [(some(n, x), some(n, x)) for n, x in ((8, "ab "), (70, "abcdef "), (200, "abcd日本語字𝒳 "), (1300, "ab c")) for _ in range(20)]
    pairs += [(a, a[:9] + b + a[12:]) for a, b in pairs]
    want = [S.ratio(*p) for p in pairs]
    assert S.ratios(pairs).tolist() == want and S.ratios([]).tolist() == []
    monkeypatch.setattr(S, "TOGETHER", 7)
    monkeypatch.setattr(S, "TABLE", 300)
    assert S.ratios(pairs).tolist() == want
