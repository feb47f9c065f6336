"""Retrieval, features, decisions, evaluation and exports on the generated set and on literals."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.operators import decide, export, lexical, metrics, model, pairs, tfidf, trees
from kinweave.plans import registry
from kinweave.sources import records as R


@pytest.fixture(scope="module")
def train(spark):
    return R.synthetic(spark, 240, "train").cache()


@pytest.fixture(scope="module")
def truth(train):
    return R.synthetic_truth(train).cache()


@pytest.fixture(scope="module")
def cands(train):
    return lexical.candidates(train, 10).cache()


def test_keys(spark):
    df = spark.createDataFrame([("lotus 3 systems", "103 cedar road sector 3")], "n string, a string")
    found = df.select(F.explode(lexical.keys(F.col("n"), F.col("a"))).alias("k")).select("k.*").collect()
    keys = {(r["view"], r["key"]) for r in found}
    assert {(0, "N:lotus 3 systems"), (0, "W:systems"), (0, "W:lotus"), (0, "P:lotus:systems")} <= keys
    assert {k for v, k in keys if v == 1} == {"A:sector", "A:cedar", "A:road"}
    assert (2, "J:103:systems") in keys and (2, "H:3:sector") in keys
    assert len(found) == len(keys) <= 24


def test_matches_are_retrieved(cands, truth, train):
    for found in (cands, tfidf.candidates(train, 10, 1500)):
        missed = truth.where("t like 'S2%'").join(found, ["q", "t"], "left_anti")
        assert missed.count() == 0
    country = train.select("id", "country")
    both = cands.join(country.toDF("q", "a"), "q").join(country.toDF("t", "b"), "t")
    assert both.where("a != b").count() == 0


def test_results_do_not_depend_on_partitions(train, cands):
    again = lexical.candidates(train.repartition(7), 10)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, cands.select(again.columns).collect()))


def test_cap_drops_whole_keys(train):
    stats = {r["view"]: r for r in lexical.posting_stats(train.where("source != 1"), False, 2).collect()}
    assert stats[0]["omitted"] > 0 and all(r["keys"] == r["kept"] + r["omitted"] for r in stats.values())


def test_blank_address_is_found_by_name(spark, train):
    blank = train.withColumn("latin_address", F.when(F.col("id") == "S1-000001", "").otherwise(F.col("latin_address")))
    assert lexical.candidates(blank, 40).where("q = 'S1-000001' and t = 'S2-000001'").count() == 1


def test_ties_at_the_cut(spark):
    rows = [("q", 0, t, s) for t, s in zip("zyabx", (0.8, 0.9, 0.8, 0.8, 0.1), strict=True)]
    out = lexical.merge_views(spark.createDataFrame(rows, "q string, view int, t string, s double"), 3).orderBy(F.desc("r_name"))
    assert [r["t"] for r in out.collect()] == ["y", "a", "b"]


def test_f05_of_entities(spark):
    uni = spark.createDataFrame([(x,) for x in "abcdef"], "q string")
    truth = spark.createDataFrame([("a", "1"), ("a", "2"), ("d", "1"), ("e", "1")], "q string, t string")
    pred = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3"), ("c", "1"), ("e", "2")], "q string, t string")
    got = {r["q"]: r["f05"] for r in metrics.per_entity(uni, truth, pred).collect()}
    assert got == {"a": pytest.approx(5 / 7), "b": 1, "c": 0, "d": 0, "e": 0, "f": 1}
    uni = spark.createDataFrame([(x,) for x in "abc"], "q string")
    out = metrics.summary(metrics.per_entity(uni, spark.createDataFrame([("b", "t"), ("c", "u")], "q string, t string"), spark.createDataFrame([("b", "t")], "q string, t string"))).head()
    assert out["macro_f05"] == pytest.approx(2 / 3, abs=1e-8) and out["singleton_accuracy"] == 1


def test_expected_f_by_all_subsets():
    p = np.array([0.91, 0.73, 0.4, 0.12])
    k, value = decide.expected_best(p)

    def expected(chosen):
        total = 0
        for world in itertools.product((0, 1), repeat=4):
            weight = np.prod([x if w else 1 - x for x, w in zip(p, world, strict=True)])
            hits, true = sum(world[i] for i in chosen), sum(world)
            f = float(not chosen) if not true else 1.25 * hits / (0.25 * true + len(chosen)) if chosen else 0
            total += weight * f
        return total

    best = max((expected(c), -len(c)) for n in range(5) for c in itertools.combinations(range(4), n))
    assert (k, value) == (2, pytest.approx(0.797535, abs=1e-6)) and value == pytest.approx(best[0])
    assert decide.expected_best(np.zeros(0)) == (0, 1.0)
    with pytest.raises(ValueError):
        decide.expected_best(np.array([1.2]))


def test_larger_threshold_on_ties(spark):
    uni = spark.createDataFrame([("a",)], "q string")
    truth = spark.createDataFrame([("a", "1")], "q string, t string")
    scored = spark.createDataFrame([("a", "1", 0.5)], "q string, t string, p double")
    got = decide.best(decide.sweep(uni, truth, scored)).head()
    assert got["threshold"] == max(t for t in decide.THRESHOLDS if t <= 0.5) and got["macro_f05"] == 1
    assert decide.choose_rule(0.5, 0.5, True) == "threshold" and decide.choose_rule(0.5, 0.6, True) == "expected_f"


def test_exports_and_their_faults(spark, train, cands, truth):
    uni, targets = train.where("source = 1").select(F.col("id").alias("q")), train.where("source != 1")
    good = truth.join(cands, ["q", "t"], "left_semi")
    m, c = export.id_lists(uni, good, "matched_entity_ids"), export.id_lists(uni, cands, "candidate_entity_ids")
    assert set(export.violations(uni, m, c, targets).head().asDict().values()) == {0}
    assert m.count() == 240 and m.where("matched_entity_ids = ''").count() >= 48
    bad = spark.createDataFrame([("S1-000001", "S2-000001,S2-000001,S9-1"), ("S1-none", "")], "source1_entity_id string, matched_entity_ids string")
    row = export.violations(uni, bad, c, targets).head().asDict()
    assert row["repeated_ids"] == 1 and row["beyond_candidates"] == 1 and row["missing_queries"] == 239 and row["unknown_queries"] == 1


def test_files_of_results(spark, tmp_path, train, cands):
    uni = train.where("source = 1").select(F.col("id").alias("q"))
    export.write_tsv(export.id_lists(uni, cands.limit(0), "matched_entity_ids"), str(tmp_path / "m"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "m").glob("*.csv"))).splitlines()
    assert "S1-000000\t" in lines and "S1-000239\t" in lines


def test_context(spark):
    rows = [("a", "x", 0.5), ("a", "y", 0.5), ("a", "z", 0.9)]
    got = {r["t"]: r for r in pairs.context(spark.createDataFrame(rows, "q string, t string, p double")).collect()}
    assert [got[t]["p_rank"] for t in "zxy"] == [1, 0.5, pytest.approx(1 / 3)] and got["x"]["p_gap"] == pytest.approx(0.4) and got["x"]["p_sum"] == pytest.approx(1.9)


def test_models(spark, train, cands, truth):
    f = pairs.features(cands, train, truth).cache()
    assert f.columns == ["q", "t", "y", *pairs.FEATURES] and len(pairs.FEATURES) == 27
    s = model.Settings(rounds=3, depth=2, least_rows=4, folds=2)
    out = model.score_stack(f, *model.train_stack(f, s)).select("p", "p2", "y").toPandas()
    assert out[["p", "p2"]].min().min() >= 0 and out[["p", "p2"]].max().max() <= 1
    assert out[out.y == 1].p2.mean() > out[out.y == 0].p2.mean() + 0.3
    with pytest.raises(ValueError):
        model.train(f.where("y = 0"), pairs.FEATURES, s)


def test_flagship(spark, sf):
    assert registry.flagship(spark, sf).count() > 0


def test_block_products_by_definition(spark, train, monkeypatch):
    """Cosines of all pairs from plain counts; the same with one block and with many, and from stored vectors."""
    rows = train.where("cast(substring(id, -3) as int) < 25").cache()

    def grams(r, view):
        if view == 2:
            w = [x for x in f"{r['latin_name']} {r['latin_address']}".split() if len(x) > 1]
            return w + [f"{a} {b}" for a, b in itertools.pairwise(w)]
        c = ("name", "address")[view]
        text = f"{r[c]} {r['latin_' + c]}"
        return [text[i : i + n] for n in (3, 4) for i in range(len(text) - n + 1)]

    records = rows.collect()
    for view in range(3):
        counts = {r["id"]: collections.Counter(grams(r, view)) for r in records}
        targets = [r["id"] for r in records if r["source"] != 1]
        total, df = collections.Counter(), collections.Counter()
        for t in targets:
            total.update(counts[t])
            df.update(set(counts[t]))
        vocab = {w: np.log((1 + len(targets)) / (1 + df[w])) + 1 for w in sorted(total, key=lambda w: (-total[w], w))[:300]}
        weight = {i: {w: (1 + np.log(n)) * vocab[w] for w, n in c.items() if w in vocab} for i, c in counts.items()}
        unit = {i: {w: x / np.sqrt(sum(y * y for y in v.values())) for w, x in v.items()} for i, v in weight.items()}
        country = {r["id"]: r["country"] for r in records}
        want = {}
        for q in (r["id"] for r in records if r["source"] == 1):
            scores = [(-round(sum(x * unit[t].get(w, 0) for w, x in unit[q].items()), 6), t) for t in targets if country[t] == country[q]]
            want |= {(q, t): (-s, k + 1) for k, (s, t) in enumerate(sorted(x for x in scores if x[0] < 0)[:5])}
        for sizes in ((1 << 15, 1 << 15, 64, 1 << 17), (4, 7, 3, 50)):
            for name, size in zip(("QUERY_BLOCK", "TARGET_BLOCK", "QUERIES_AT_ONCE", "ENTRIES_AT_ONCE"), sizes, strict=True):
                monkeypatch.setattr(tfidf, name, size)
            got = {(r["q"], r["t"]): (r["s"], r["rank"]) for r in tfidf.top_of_view(rows, view, 5, 300).collect()}
            assert set(got) == set(want) and all(got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0], abs=2e-6) for k in got)


def test_evaluation_refuses_faulty_universes(spark):
    frame = lambda *xs: spark.createDataFrame([(x,) for x in xs], "q string")
    assert metrics.evaluated(frame("a", "b"), frame("a", "b", "c", "c")).count() == 2
    for bad in (frame("a", "a"), frame("a", ""), frame("a", None), frame("a", "z")):
        with pytest.raises(Exception, match="query"):
            metrics.evaluated(bad, frame("a", "b")).collect()
    pairs_ = spark.createDataFrame([("a", "1"), ("a", "1")], "q string, t string")
    row = metrics.per_entity(frame("a"), pairs_, pairs_).head()
    assert (row["n_truth"], row["n_pred"], row["n_hit"], row["f05"]) == (1, 1, 1, 1)


def test_sizes_of_cuts(spark, train, cands):
    uni = train.where("source = 1").select(F.col("id").alias("q"))
    got = {r["k"]: r for r in metrics.sizes_at(uni, cands, [1, 3, 10]).collect()}
    assert got[10]["max"] == metrics.size_stats(uni, cands).head()["max"] and got[1]["mean"] <= got[3]["mean"] <= got[10]["mean"]
    assert got[10]["feature_gb"] == pytest.approx(cands.count() * 108 / 1e9)


def test_order_of_results(spark, tmp_path):
    rows = spark.createDataFrame([(f"S1-{i:06d}", "x") for i in range(50)], "source1_entity_id string, matched_entity_ids string").repartition(5)
    export.write_tsv(rows, str(tmp_path / "good"))
    assert export.out_of_order(spark, str(tmp_path / "good")) == 0
    rows.repartition(1, "matched_entity_ids").orderBy(F.desc("source1_entity_id")).write.option("sep", "\t").option("header", True).csv(str(tmp_path / "bad"))
    assert export.out_of_order(spark, str(tmp_path / "bad")) > 0
    export.joined_file(spark, str(tmp_path / "good"), str(tmp_path / "one.tsv"), ("source1_entity_id", "matched_entity_ids"))
    lines = (tmp_path / "one.tsv").read_text().splitlines()
    assert lines[1:] == [f"S1-{i:06d}\tx" for i in range(50)]


def test_candidates_without_records_fail(spark, train):
    bad = spark.createDataFrame([("S1-000001", "S2-nobody")], "q string, t string")
    with pytest.raises(Exception, match="no record"):
        pairs.joined(bad, train).collect()


def test_blocks_get_texts_once(spark, train, monkeypatch):
    """Tasks get each different text once, not vectors, which are ten times as large; all its records are in the result."""
    rows = train.withColumn("id", F.concat("id", F.lit("-a"))).unionByName(train.withColumn("id", F.concat("id", F.lit("-b"))))

    def told(*_):
        def size(asked, stored):
            import pyarrow as pa

            return pa.table({"q": [""], "t": [str(asked.num_rows + stored.num_rows)], "s": [float(asked.nbytes + stored.nbytes)]})

        return size

    made = tfidf._best_of_block
    for n_q in (1, 4):
        with monkeypatch.context() as m:
            m.setattr(tfidf, "QUERY_BLOCK", 480 // n_q)
            m.setattr(tfidf, "_best_of_block", told)
            got = tfidf.block_hits(rows, 0, 5, 300, False).agg(F.sum(F.col("t").cast("long")).alias("n"), F.sum("s").alias("bytes")).head()
        n_q = max(n_q, spark.sparkContext.defaultParallelism)
        text = F.concat_ws(" ", "name", "latin_name")
        asked, stored = (train.where(x).select(text.alias("x"), F.octet_length(text).alias("n")).distinct().agg(F.count("*"), F.sum("n")).head() for x in ("source = 1", "source != 1"))
        assert got["n"] == asked[0] + n_q * stored[0] and got["bytes"] < 10 * n_q * (asked[1] + stored[1])
    assert tfidf._best_of_block is made
    found = lambda df: {(r["q"], r["t"]): r["s"] for r in tfidf.top_of_view(df, 0, 1000, 300).collect()}
    hits, once = found(rows.where("source = 1").unionByName(train.where("source != 1"))), found(train)
    assert hits == {(f"{q}-{a}", t): s for (q, t), s in once.items() for a in "ab"}
    hits = found(rows)
    assert set(hits) == {(f"{q}-{a}", f"{t}-{b}") for q, t in once for a in "ab" for b in "ab"} and all(hits[q, t] == hits[f"{q[:-1]}a", f"{t[:-1]}a"] for q, t in hits)


def test_vectors_of_odd_texts(spark):
    """Repeated ids, letters beyond the basic plane, many letters, ties at the cut, empty texts: by definition."""
    wide = "".join(chr(0x4E00 + 7 * i) for i in range(60)) + "\U00020000\U00020001\U00020000\U00020001"
    said = [("1", 1, "abcd"), ("1", 1, "dabc"), ("2", 1, wide), ("3", 1, ""), ("4", 1, "ab")]
    said += [(f"t{i}", 2, "abcd abcd") for i in range(9)] + [("u", 2, "abcd"), ("u", 2, "dabc"), ("w", 3, wide[30:]), ("x", 3, "")]
    rows = spark.createDataFrame([(i, s, "c", x) for i, s, x in said], "id string, source int, country string, name string").withColumns({c: F.col("name") for c in ("latin_name", "address", "latin_address")})
    counts, targets = collections.defaultdict(collections.Counter), [i for i, s, _ in said if s > 1]
    for i, _, x in said:
        counts[i].update(f"{x} {x}"[j : j + n] for n in (3, 4) for j in range(len(f"{x} {x}") - n + 1))
    df = collections.Counter(w for t in set(targets) for w in counts[t])
    weight = {i: {w: (1 + np.log(n)) * (np.log((1 + len(targets)) / (1 + df[w])) + 1) for w, n in c.items() if w in df} for i, c in counts.items()}
    norm = {i: np.sqrt(sum(x * x for x in v.values())) for i, v in weight.items()}
    want = []
    for q in "1234":
        scores = [(-round(sum(x * weight[t].get(w, 0) for w, x in weight[q].items()) / (norm[q] * norm[t] or 1), 6), t) for t in set(targets)]
        want += [(q, t, k + 1) for k, (s, t) in enumerate(sorted(x for x in scores if x[0] < 0)[:4])]
    assert sorted((r["q"], r["t"], r["rank"]) for r in tfidf.top_of_view(rows, 0, 4, 60_000).collect()) == sorted(want)


def test_faults_are_counted_in_one_pass(spark, sf, train, cands):
    """The candidates come once into the plan of the checks; repeated lists of a query count by pairs of matches and candidates."""
    retrieved = lambda name: registry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")
    assert retrieved("validate_outputs") == retrieved("validate_faulty_outputs") == retrieved("lexical_candidates") > 0
    lists = lambda rows, c: spark.createDataFrame(rows, f"source1_entity_id string, {c}_entity_ids string")
    uni, targets = spark.createDataFrame([(x,) for x in "abcdd"], "q string"), spark.createDataFrame([(f"t{i}",) for i in range(4)], "id string")
    m = lists([("a", "t1, t2"), ("a", "t1"), ("b", "t9,t9"), ("x", ""), ("y", "t3")], "matched")
    c = lists([("a", "t1"), ("a", "t3"), ("c", "t8"), ("b", "t9")], "candidate")
    row = export.violations(uni, m, c, targets).head().asDict()
    assert row == {"missing_queries": 3, "unknown_queries": 2, "one_sided_queries": 3, "repeated_queries": 1, "repeated_ids": 1, "beyond_candidates": 4, "unknown_targets": 2}
    some = train.where("source = 1").select(F.col("id").alias("q"))
    both = export.both_lists(some, cands.withColumn("p", F.col("s_name")), F.col("p") > 0.5)
    for column, pairs_ in (("matched_entity_ids", cands.where("s_name > 0.5")), ("candidate_entity_ids", cands)):
        assert sorted(map(tuple, both.select("source1_entity_id", column).collect())) == sorted(map(tuple, export.id_lists(some, pairs_, column).collect()))


def test_lexical_blocks_by_the_join(spark, train, monkeypatch):
    """The candidates are those of the plain join, with one block and with many, but its rows, thousands for a query, don't come into the plan."""
    want = sorted(map(tuple, lexical.top_k(lexical.view_scores(train.where("source = 1"), lexical.postings(train.where("source != 1"), True, 2048), True), 5).collect()))
    for sizes in ((1 << 14, 1 << 18), (60, 100)):
        for name, size in zip(("QUERY_BLOCK", "TARGET_BLOCK"), sizes, strict=True):
            monkeypatch.setattr(lexical, name, size)
        monkeypatch.setattr(lexical, "view_scores", None)
        got = lexical.candidates(train, 5)
        assert sorted(map(tuple, got.collect())) == want and "all0" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_features_are_made_once(spark, sf):
    """Training and scoring of the stack read the same stored features; nothing is retrieved again for the scores."""
    plan = registry.queries()["stack_scores"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Relation" not in plan


def test_scores_take_no_new_memory():
    """Batches of queries are scored in the same memory, dense terms and lists alike; each score is as near the exact one as its query's terms allow."""
    rng = np.random.default_rng(5)
    n, v, size = 3000, 2000, 30
    start = np.arange(0, n * size + 1, size)
    # Some terms are in most texts, most in few.
    often = 1 / np.arange(1, v + 1)
    often /= often.sum()
    term = np.concatenate([np.sort(rng.choice(v, size, False, often)) for _ in range(n)])
    w = rng.random(n * size)
    w /= np.repeat(np.sqrt(np.add.reduceat(w * w, start[:-1])), size)
    made, room = tfidf._Slice((start, term, w), np.bincount(term, minlength=v), n), tfidf._Room()
    assert 0 < len(made.head) < v and made.sizes.sum() > 0
    told = []
    for lo in (0, 8):
        wide, own = np.zeros((8, v)), [slice(start[lo + i], start[lo + i + 1]) for i in range(8)]
        for row, x in zip(wide, own, strict=True):
            row[term[x]] = w[x]
        got = made.scores(wide, [(term[x], w[x]) for x in own], room)
        want = np.add.reduceat(wide[:, term] * w, start[:-1], axis=1)
        assert (np.abs(got - want) <= want * (size + tfidf.MORE) * tfidf.SINGLE).all() and (got[want == 0] == 0).all()
        told.append((got, {k: id(x) for k, x in room.held.items()}))
    assert np.shares_memory(told[0][0], told[1][0]) and told[0][1]["scores"] == told[1][1]["scores"]


def test_terms_are_counted_before_they_are_rows(spark, monkeypatch):
    """Vocabularies by definition, of odd texts too; what is exploded or shuffled is not a row for each place of a term."""
    wide = "".join(chr(0x3400 + i) for i in range(26_000)) + "".join(chr(0x20000 + i) for i in range(14_000))
    said = [("a", "abcab cab ab"), ("a", "cabab"), ("b", "abcab cab ab"), ("c", "abcab cab ab"), ("d", ""), ("e", "x"), ("f", "ab a ab a bc  ab"), ("g", wide), ("h", "\U00020000\U00020001" * 3)]
    rows = spark.createDataFrame([(i, 2, "c", x) for i, x in said], "id string, source int, country string, name string").withColumns({c: F.col("name") for c in ("latin_name", "address", "latin_address")})
    for view in (0, 2):
        counts = collections.defaultdict(collections.Counter)
        for i, x in said:
            text = f"{x} {x}"
            w = [y for y in text.split(" ") if len(y) > 1]
            counts[i].update(w + [f"{y} {z}" for y, z in itertools.pairwise(w)] if view == 2 else [text[j : j + n] for n in (3, 4) for j in range(len(text) - n + 1)])
        total, df = collections.Counter(), collections.Counter()
        for c in counts.values():
            total.update(c)
            df.update(set(c))
        want = [(t, df[t], pytest.approx(np.log(10 / (1 + df[t])) + 1)) for t in sorted(total, key=lambda t: (-total[t], t))]
        for most in (7, 1 << 20):
            got = tfidf.vocabulary(rows, view, most)
            assert sorted(map(tuple, got.collect())) == sorted(want[:most]) and "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_countries_are_cut_by_their_share(spark, train, monkeypatch):
    """A country gets blocks by its share of the pairs, so that targets aren't made vectors again for a few queries; every pair of blocks has a task of its own."""
    rows = train.withColumn("country", F.when(F.substring("id", -1, 1) == "0", "small").otherwise("large"))

    def told(*_):
        def size(asked, stored):
            import pyarrow as pa
            from pyspark import TaskContext

            part = str(TaskContext.get().partitionId())
            return pa.table({"q": [asked.column("c")[0].as_py()], "t": [part], "s": [float(stored.num_rows)]}) if asked.num_rows and stored.num_rows else pa.table({"q": pa.array([], pa.string()), "t": pa.array([], pa.string()), "s": pa.array([], pa.float64())})

        return size

    with monkeypatch.context() as m:
        m.setattr(tfidf, "_best_of_block", told)
        blocks = tfidf.block_hits(rows, 0, 5, 300, True).collect()
        cores = spark.sparkContext.defaultParallelism
        of = collections.Counter(r["q"] for r in blocks)
        assert of["small"] == 1 and cores <= of["large"] + 1 <= cores + 1 and len({r["t"] for r in blocks if r["q"] == "large"}) == of["large"]
        m.setattr(tfidf, "LEAST_BLOCK", 20)
        cuts = {c: (n_q, n_t) for c, n_q, n_t in tfidf._cuts(rows.where("source = 1"), rows.where("source != 1"), F.col("country"))}
        q, t = rows.where("source = 1 and country = 'large'").count(), rows.where("source != 1 and country = 'large'").count()
        n_q, n_t = cuts["large"]
        assert n_q > 1 and n_t > 1 and n_q * n_t >= min(2 * cores, (q / 20) * (t / 20)) and q / n_q < 2 * t / n_t < 8 * q / n_q
    assert tfidf._cuts(rows.where("source = 7"), rows, F.col("country")) == [] and tfidf.top_of_view(rows.where("source != 1"), 0, 5, 300).count() == 0


def test_products_of_many_queries_by_parts_of_slices(spark, train, monkeypatch):
    """Batches of other sizes than the rows that stand whole at once, and slices of few targets, give the same."""
    found = lambda: sorted(map(tuple, tfidf.top_of_view(train, 0, 3, 300).collect()))
    want = found()
    for sizes in ((7, 3, 200), (64, 64, 16)):
        for name, size in zip(("QUERIES_AT_ONCE", "ROWS_AT_ONCE", "TARGETS_AT_ONCE"), sizes, strict=True):
            monkeypatch.setattr(tfidf, name, size)
        assert found() == want


def test_frequent_terms_by_directions(train, monkeypatch):
    """Frequent terms that come together are few directions; scores by them are bounds from above, and what is found is the same."""
    import pyarrow as pa

    rng = np.random.default_rng(7)
    # A word has eight terms of its own; rare terms stand alone.
    n, words, rare = 900, 40, 600
    of = [np.concatenate([(8 * rng.choice(words, 6, False)[:, None] + np.arange(8)).ravel(), 8 * words + rng.choice(rare, 5, False)]) for _ in range(n)]
    start, term, v = np.append(0, np.cumsum([len(x) for x in of])), np.concatenate(of), 8 * words + rare
    w = rng.random(v)[term] + 0.5
    w /= np.repeat(np.sqrt(np.add.reduceat(w * w, start[:-1])), np.diff(start))
    asked = np.bincount(term, minlength=v)
    head, axes = tfidf._axes((start, term, w), asked, n)
    assert len(head) >= tfidf.LEAST_TURNED and axes.shape[1] <= words
    made, room = tfidf._Slice((start, term, w), asked, n, (head, axes)), tfidf._Room()
    assert len(made.dense) == axes.shape[1] + 1 and made.sizes[head].sum() == 0
    some = [slice(start[i], start[i + 1]) for i in range(50)]
    wide = np.zeros((50, v))
    for row, x in zip(wide, some, strict=True):
        row[term[x]] = w[x]
    over = made.scores(wide, [(term[x], w[x]) for x in some], room) - np.add.reduceat(wide[:, term] * w, start[:-1], axis=1)
    assert over.min() > -made.margin and np.median(over) < 2 * tfidf.LEFT
    # The same of real texts, with directions and without, and slices of few targets.
    vocab, texts = tfidf.vocabulary(train.where("source != 1"), 0, 2000).toArrow(), tfidf.texts(train, 0).toArrow()
    ids, said, told, found = texts.column("id").to_pylist(), texts.column("text"), [], []
    tables = [said.filter(pa.array([i.startswith("S1") == x for i in ids])) for x in (True, False)]
    asked_, stored = (pa.table({"ids": [[f"{i:06d}"] for i in range(len(x))], "text": x}) for x in tables)
    turned = tfidf._axes
    monkeypatch.setattr(tfidf, "_axes", lambda *x: told.append(turned(*x)) or told[-1])
    monkeypatch.setattr(tfidf, "WORTH", 10)
    for least, at_once in ((1 << 20, 1 << 15), (32, 1 << 15), (32, 150)):
        monkeypatch.setattr(tfidf, "LEAST_TURNED", least)
        monkeypatch.setattr(tfidf, "TARGETS_AT_ONCE", at_once)
        got = tfidf._best_of_block(5, vocab.column("term").to_pylist(), vocab.column("idf").to_numpy(), False)(asked_, stored)
        found.append(sorted(zip(*(c.to_pylist() for c in got.columns), strict=True)))
    assert told[0] is None and all(x is not None and x[1].shape[1] < x[1].shape[0] for x in told[1:])
    assert found[0] and found[0] == found[1] == found[2]


def test_large_countries_come_first(spark):
    """Blocks of the first countries, which are the largest, have the first tasks, and each has one of its own."""
    cuts = [("large", 3, 4), ("small", 2, 2)]
    places = tfidf._pair_places(spark, cuts, 32)
    of = spark.createDataFrame(places, "c string, a int, b int, place int").select("c", "a", "b", F.pmod(F.hash("c", "place"), F.lit(32)).alias("part")).collect()
    parts = {c: sorted(r["part"] for r in of if r["c"] == c) for c, *_ in cuts}
    assert len({(r["c"], r["a"], r["b"]) for r in of}) == len({r["part"] for r in of}) == 16
    assert parts["large"][-1] < parts["small"][0]


def test_stack_takes_all_rounds(spark, sf, monkeypatch):
    """The registered query trains with the operator's own settings: 300 rounds, depth 5, 40 rows of a leaf."""
    told, train = [], model.train_stack
    monkeypatch.setattr(model, "train_stack", lambda f, s: told.append((s, train(f, s))) or told[0][1])
    assert registry.queries()["stack_scores"](spark, sf).count() > 0
    (s, (first, second)), = told
    assert s == model.Settings(rounds=300, depth=5, least_rows=40, seed=registry.SEED)
    assert len(first) == 3 and all(m.feature.shape == (300, 31) and m.leaf.shape == (300, 32) for m in (*first, second))
    assert all(np.abs(m.leaf).max(axis=1).all() for m in (*first, second))


def test_trees_by_spark(spark):
    """The trees of one job are those of Spark's GBTClassifier where each value has a bin, and the same from any number of tasks."""
    rng = np.random.default_rng(1)
    a, b, c = rng.integers(0, 20, 2000) / 7, rng.integers(-5, 15, 2000) * 1.0, rng.integers(0, 2, 2000) * 1.0
    y = (a + c * np.sin(b) + rng.normal(0, 0.7, 2000) > 1.6).astype(int)
    rows = spark.createDataFrame([(float(u), float(v), float(w), int(x)) for u, v, w, x in zip(a, b, c, y, strict=True)], "a double, b double, c double, y int").cache()
    columns, s = ("a", "b", "c"), model.Settings(rounds=12, depth=3, least_rows=10, columns="1.0")
    made = trees.train(rows.repartition(5), columns, s)
    both = model.score(trees.score(rows, [made], ["ours"]), model.train(rows, columns, s), columns).select("ours", "p").toPandas()
    assert (both.ours - both.p).abs().max() < 1e-6 and both.p.std() > 0.1
    one = trees.Trees.of(trees.train(rows.coalesce(1), columns, s).text())
    assert all(np.array_equal(getattr(one, k), getattr(made, k)) for k in ("feature", "threshold", "leaf"))
    with pytest.raises(ValueError):
        trees.train(rows.where("y = 1"), columns, s)


class Alone:
    """A stage of one task."""

    first = True

    def total(self, x):
        return np.ascontiguousarray(x, np.float64)

    tell = total


def test_bins_beside_a_frequent_value():
    """A frequent value has a bin of its own at either end, few values have one each, and the rest is cut evenly."""
    rng = np.random.default_rng(2)
    rare = rng.random(1000)
    x = np.stack([np.r_[np.zeros(9000), rare + 1], np.r_[rare - 2, np.full(9000, 1.0)], np.arange(10000) % 5 - 2.0, np.zeros(10000), rng.permutation(10000)]).astype(np.float32)
    edges = trees._edges(Alone(), x)
    sizes = [np.bincount(np.searchsorted(e, k, "left"), minlength=len(e) + 1) for e, k in zip(edges, trees._keys(x), strict=True)]
    assert [len(n) for n in sizes] == [32, 32, 5, 1, 32]
    assert sizes[0][0] == 9000 and sizes[0][1:].max() <= 63 and sizes[1][-1] == 9000 and sizes[1][:-1].max() <= 63
    assert set(sizes[2]) == {2000} and set(sizes[4]) <= {312, 313}
