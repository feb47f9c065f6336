"""Queries over the document tables, each with its SQL twin where one exists."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import text as X
from kinweave.operators import audit, decide, export, lexical, metrics, tfidf
from kinweave.operators import model as M
from kinweave.operators import pairs as P
from kinweave.plans import oracle as O
from kinweave.sources import records as R

SEED, TOP_K, CAP, FEATURES, THRESHOLD = 2026, 20, 2048, 60_000, 0.4
KS = [1, 5, 10, 20]
#: Small trees: the queries are run as checks.
SMALL = M.Settings(rounds=5, depth=3, least_rows=2, seed=SEED)
#: The operator's own rounds, depth and rows of a leaf.
WHOLE = M.Settings(seed=SEED)


class Data:
    """Records, truth, candidates and scores of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.records = R.from_documents(spark, sf_dir)
        self.queries = self.records.where("source = 1").select(F.col("id").alias("q"), "country")
        self.targets = self.records.where("source in (2, 3)")
        self.truth = R.document_truth(self.records)

    @functools.cached_property
    def candidates(self) -> DataFrame:
        return lexical.candidates(self.records, TOP_K, True, CAP)

    @functools.cached_property
    def scored(self) -> DataFrame:
        return self.candidates.withColumn("p", F.round((F.col("s_name") + F.col("s_combined")) / 2, 7))

    @functools.cached_property
    def predicted(self) -> DataFrame:
        return decide.above(self.scored, THRESHOLD)

    @functools.cached_property
    def features(self) -> DataFrame:
        return P.features(self.candidates, self.records, self.truth)


def _entities(d: Data) -> DataFrame:
    return metrics.per_entity(d.queries, d.truth, d.predicted)


def _partition(d: Data) -> DataFrame:
    return d.queries.select("q", X.entity_hash(F.col("q"), SEED).alias("h")).withColumn("part", X.part_of(F.col("h")))


def _trained(features: DataFrame, train) -> object:
    """What train makes of the features, which every round reads; they are kept meanwhile only."""
    kept = features.persist()
    try:
        return train(kept)
    finally:
        kept.unpersist()


def _once(features: DataFrame) -> DataFrame:
    """The features as a table in the cluster's checkpoint folder, which training and scoring read; without such a folder as they are."""
    spark = features.sparkSession
    there = spark.conf.get("spark.checkpoint.dir", None) or not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()
    return features.checkpoint() if there else features


def _gbt(d: Data) -> DataFrame:
    trees = _trained(d.features, lambda f: M.train(f, P.FEATURES, SMALL))
    return M.score(d.features, trees, P.FEATURES).select("q", "t", "y", "p")


def _stack(d: Data) -> DataFrame:
    features = _once(d.features)
    train = lambda f: M.train_stack(f, WHOLE)
    first, second = _trained(features, train) if features is d.features else train(features)
    return M.score_stack(features, first, second).select("q", "t", "y", "p", "p2")


def _loco(d: Data) -> DataFrame:
    """Transfer between countries, each with its own fit, tune and dev entities."""
    parts = _partition(d).join(d.queries, "q")
    universes = {p: parts.where(F.col("part") == p).select("q", "country") for p in ("fit", "tune", "dev")}

    def transfer(f: DataFrame) -> list:
        out = M.transfer({p: f.join(u, "q") for p, u in universes.items()}, universes, d.truth, SMALL)
        return [] if out is None else out.collect()

    kind = "source_country string, target_country string, threshold double, entities long, macro_f05 double, micro_precision double, micro_recall double, singleton_accuracy double, predicted long, true_pairs long"
    return d.records.sparkSession.createDataFrame(_trained(d.features, transfer), kind)


def _number(c: str) -> Column:
    return F.substring(c, 4, 20).cast("long")


def _faulty_labels(d: Data) -> DataFrame:
    """The relational checks over truth with planted faults of every kind."""
    n = _number("q")
    labelled = d.queries.select("q").where(n % 50 != 0).unionByName(d.records.sparkSession.createDataFrame([("S1-none",)], "q string"))
    least = d.targets.agg(F.min("id").alias("t"))
    unknown = d.queries.where(n % 7 == 0).select("q", F.concat(F.lit("S2-x"), "q").alias("t"))
    shared = d.queries.where(n % 11 == 0).select("q").crossJoin(F.broadcast(least))
    return audit.checks(d.records, d.truth.unionByName(unknown).unionByName(shared).distinct(), labelled)


def _checked(d: Data, matches: Column, more: list[tuple[str, str]]) -> DataFrame:
    """The checks of results; matches: the lists of matches that stand for a query, made of the right one; more: further ones. The candidates are retrieved once."""
    lists = export.both_lists(d.queries, d.scored, F.col("p") >= F.lit(THRESHOLD))
    kept = lambda xs, kind: F.transform(xs, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("list")))
    rows = lists.select("source1_entity_id", F.explode(F.concat(kept(matches, 1), kept(F.array("candidate_entity_ids"), 2))).alias("x")).select("source1_entity_id", "x.kind", "x.list")
    if more:
        rows = rows.unionByName(d.records.sparkSession.createDataFrame([(q, 1, ids) for q, ids in more], "source1_entity_id string, kind int, list string"))
    return export.counted(export.sides(d.queries, 0).unionByName(export.sides(rows, F.col("kind"), "list")), d.targets)


def _faulty_results(d: Data) -> DataFrame:
    """The checks of results over lists with planted faults of every kind."""
    n, ids = _number("source1_entity_id"), F.col("matched_entity_ids")
    bad = F.when(n % 10 == 1, F.concat_ws(",", F.nullif(ids, F.lit("")), F.lit("S9-none"))).when((n % 10 == 2) & (ids != ""), F.concat_ws(",", ids, F.substring_index(ids, ",", 1))).otherwise(ids)
    return _checked(d, F.array_repeat(bad, F.when(n % 10 == 0, 0).when(n % 10 == 3, 2).otherwise(1)), [("S1-none", "")])


def _synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.synthetic(spark, 240, "train").select("split", "id", "source", "country", "name", "address")


#: Expressions after the candidates.
_CAND = O.candidates(TOP_K, CAP)
_UNI = "uni AS (SELECT id AS q, country FROM rec WHERE source = 1)"
_SCORED = "scored AS (SELECT *, round((s_name + s_combined) / 2, 7) AS p FROM cand)"
_PRED = f"pred AS (SELECT q, t FROM scored WHERE p >= {THRESHOLD}::DOUBLE)"
_F05 = "CASE WHEN n_truth = 0 THEN (n_pred = 0)::INT::DOUBLE ELSE 1.25::DOUBLE * n_hit / (0.25::DOUBLE * n_truth + n_pred) END"
_ENT = f"""ent AS (
  SELECT *, {_F05} AS f05 FROM (
    SELECT uni.q, uni.country, coalesce(a.n, 0) AS n_truth, coalesce(b.n, 0) AS n_pred, coalesce(b.h, 0) AS n_hit FROM uni
    LEFT JOIN (SELECT q, count(*) AS n FROM truth GROUP BY q) a USING (q)
    LEFT JOIN (SELECT pred.q, count(*) AS n, count(truth.t) AS h FROM pred LEFT JOIN truth USING (q, t) GROUP BY pred.q) b USING (q)))"""
_SUMMARY = """count(*) AS entities, round(avg(f05), 9) AS macro_f05,
  round(coalesce(sum(n_hit) / nullif(sum(n_pred), 0), 0), 9)::DOUBLE AS micro_precision, round(coalesce(sum(n_hit) / nullif(sum(n_truth), 0), 0), 9)::DOUBLE AS micro_recall,
  round(avg((n_pred = 0)::INT::DOUBLE) FILTER (n_truth = 0), 9) AS singleton_accuracy, sum(n_pred)::BIGINT AS predicted, sum(n_truth)::BIGINT AS true_pairs"""
_THETAS = ", ".join(f"{t!r}::DOUBLE" for t in decide.THRESHOLDS)
_SWEEP = f"""thetas AS (SELECT unnest([{_THETAS}]) AS threshold),
counts AS (
  SELECT threshold, uni.q, count(s.t) FILTER (s.p >= threshold) AS n_pred, count(truth.t) FILTER (s.p >= threshold) AS n_hit
  FROM uni CROSS JOIN thetas LEFT JOIN scored s ON s.q = uni.q LEFT JOIN truth ON truth.q = s.q AND truth.t = s.t GROUP BY threshold, uni.q),
swept AS (
  SELECT threshold, round(avg({_F05}), 9) AS macro_f05 FROM (
    SELECT c.*, coalesce(n, 0) AS n_truth FROM counts c LEFT JOIN (SELECT q, count(*) AS n FROM truth GROUP BY q) USING (q)) GROUP BY threshold)"""
_RANKED = "ranked AS (SELECT q, t, round(1 / greatest(r_name, r_address, r_combined))::INT AS rank FROM cand)"


def _recall(by: str = "") -> str:
    lead, group = (f"{by}, ", f"{by}, k") if by else ("", "k")
    return f"""SELECT {lead}k, round(sum(n_found) / nullif(sum(n_truth), 0), 9)::DOUBLE AS pair_recall, round(avg((n_found > 0)::INT::DOUBLE) FILTER (n_truth > 0), 9) AS entity_recall,
  round(avg((n_found = n_truth)::INT::DOUBLE) FILTER (n_truth > 0), 9) AS complete_recall, round(avg(n), 9) AS mean_candidates FROM (
    SELECT uni.*, ks.k::INT AS k, (SELECT count(*) FROM ranked r WHERE r.q = uni.q AND r.rank <= ks.k) AS n,
      (SELECT count(*) FROM truth WHERE truth.q = uni.q) AS n_truth,
      (SELECT count(*) FROM truth JOIN ranked r USING (q, t) WHERE truth.q = uni.q AND r.rank <= ks.k) AS n_found
    FROM uni CROSS JOIN (SELECT unnest({KS}) AS k) ks) GROUP BY {group}"""


def _tfidf(view: int) -> str:
    """Expressions w{view}_q, w{view}_t and cos{view} of one view, and vocab{view}."""
    both = "concat_ws(' ', latin_name, latin_address)"
    text = ("concat_ws(' ', name, latin_name)", "concat_ws(' ', address, latin_address)", both)[view]
    if view == 2:
        words = f"list_filter(string_split({text}, ' '), lambda w: length(w) >= 2)"
        grams = f"list_concat({words}, list_transform(range(1, greatest(len({words}), 1)), lambda i: {words}[i] || ' ' || {words}[i + 1]))"
    else:
        grams = "list_concat(" + ", ".join(f"list_transform(range(1, greatest(length({text}) - {n - 2}, 1)), lambda i: substr({text}, i, {n}))" for n in (3, 4)) + ")"
    v = view
    return f"""
tf{v} AS (SELECT id, country, source, term, count(*) AS tf FROM (SELECT id, country, source, unnest({grams}) AS term FROM rec) GROUP BY ALL),
vocab{v} AS (SELECT term, df, ln((1 + (SELECT count(*) FROM rec WHERE source IN (2, 3))) / (1 + df)) + 1 AS idf FROM (
  SELECT term, sum(tf) AS total, count(*) AS df FROM tf{v} WHERE source IN (2, 3) GROUP BY term ORDER BY total DESC, term LIMIT {FEATURES})),
raw{v} AS (SELECT id, country, source, term, (1 + ln(tf)) * idf AS w FROM tf{v} JOIN vocab{v} USING (term)),
unit{v} AS (SELECT id, country, source, term, w / norm AS w FROM raw{v} JOIN (SELECT id, sqrt(sum(w * w)) AS norm FROM raw{v} GROUP BY id) USING (id)),
cos{v} AS (SELECT a.id AS q, b.id AS t, round(sum(a.w * b.w), 6) AS s FROM unit{v} a JOIN unit{v} b ON a.term = b.term AND a.country = b.country AND a.source = 1 AND b.source IN (2, 3) GROUP BY a.id, b.id)"""


def _topk(view: int) -> str:
    return O.with_records(_tfidf(view), select=f"SELECT * FROM (SELECT q, t, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, t)::INT AS rank FROM cos{view} WHERE s > 0) WHERE rank <= {TOP_K}")


def _keys(select: str) -> str:
    return O.with_records(O.record_keys(True), select=select)


def _after(*parts: str, select: str) -> str:
    return O.with_records(_CAND, *parts, select=select)


_qn, _tn = O.numbers("a.latin_address"), O.numbers("b.latin_address")
_PAIRS_SQL = f"""SELECT cand.q, cand.t, (truth.t IS NOT NULL)::INT AS y,
  (a.latin_name = b.latin_name AND a.latin_name != '')::INT::FLOAT AS name_exact, (a.latin_address = b.latin_address AND a.latin_address != '')::INT::FLOAT AS addr_exact,
  (a.latin_name = '' OR b.latin_name = '')::INT::FLOAT AS name_missing, (a.latin_address = '' OR b.latin_address = '')::INT::FLOAT AS addr_missing,
  coalesce(len(list_intersect({_qn}, {_tn})) / nullif(len(list_distinct(list_concat({_qn}, {_tn}))), 0), 0)::FLOAT AS number_jaccard,
  (len({_qn}) > 0 AND len({_tn}) > 0 AND NOT list_has_any({_qn}, {_tn}))::INT::FLOAT AS number_conflict, (len({_qn}) = 0 OR len({_tn}) = 0)::INT::FLOAT AS number_missing,
  (a.country != '' AND a.country = b.country)::INT::FLOAT AS country_equal, (b.source = 3)::INT::FLOAT AS target_source3,
  (least(length(a.latin_name), length(b.latin_name)) / greatest(length(a.latin_name), length(b.latin_name), 1))::FLOAT AS name_length_ratio,
  (least(length(a.latin_address), length(b.latin_address)) / greatest(length(a.latin_address), length(b.latin_address), 1))::FLOAT AS addr_length_ratio,
  s_name::FLOAT AS retrieval_name, s_address::FLOAT AS retrieval_address, s_combined::FLOAT AS retrieval_combined,
  r_name::FLOAT AS rank_name, r_address::FLOAT AS rank_address, r_combined::FLOAT AS rank_combined
FROM cand JOIN rec a ON a.id = cand.q JOIN rec b ON b.id = cand.t LEFT JOIN truth ON truth.q = cand.q AND truth.t = cand.t"""
_SIMILARITY = "SELECT *, least(name_ratio, addr_ratio) AS name_addr_min, name_ratio * addr_ratio AS name_addr_product FROM (SELECT cand.q, cand.t, " + ", ".join(f"coalesce(max(s) FILTER (k = '{k}'), 0)::FLOAT AS {k}" for k in P.SIMILARITIES) + " FROM cand LEFT JOIN sims USING (q, t) GROUP BY ALL)"
_CHECKS = """SELECT (SELECT count(*) FROM uni WHERE q NOT IN (SELECT q FROM lab)) AS missing_truth_rows, (SELECT count(*) FROM lab WHERE q NOT IN (SELECT q FROM uni)) AS invalid_truth_queries,
  (SELECT count(*) FROM {truth} WHERE t NOT IN (SELECT id FROM rec WHERE source IN (2, 3))) AS invalid_truth_targets,
  (SELECT count(*) FROM {truth} JOIN rec a ON a.id = q JOIN rec b ON b.id = t WHERE a.country != b.country OR a.country = '' OR b.country = '') AS cross_country_pairs,
  (SELECT count(*) FROM (SELECT t FROM {truth} GROUP BY t HAVING count(*) > 1)) AS shared_targets,
  (SELECT count(*) FROM (SELECT split, id FROM rec GROUP BY ALL HAVING count(*) > 1)) AS repeated_ids"""
_NUM = "substr({x}, 4)::BIGINT"
_FAULTY_LABELS = f"""lab AS (SELECT q FROM uni WHERE {_NUM.format(x="q")} % 50 != 0 UNION ALL SELECT 'S1-none'),
bad AS (SELECT q, t FROM truth UNION SELECT q, 'S2-x' || q FROM uni WHERE {_NUM.format(x="q")} % 7 = 0 UNION SELECT q, (SELECT min(id) FROM rec WHERE source IN (2, 3)) FROM uni WHERE {_NUM.format(x="q")} % 11 = 0)"""
_FAULTY_RESULTS = f"""(
  WITH few AS (SELECT q, CASE WHEN n % 10 = 1 THEN concat_ws(',', nullif(ids, ''), 'S9-none') WHEN n % 10 = 2 AND ids != '' THEN ids || ',' || string_split(ids, ',')[1] ELSE ids END AS ids, n FROM (SELECT *, {_NUM.format(x="q")} AS n FROM good) WHERE n % 10 != 0)
  SELECT q, ids FROM few UNION ALL SELECT q, ids FROM few WHERE n % 10 = 3 UNION ALL SELECT 'S1-none', '')"""
#: m and c (q, ids): lists of matches and candidates; {bad} takes the place of the good lists.
_RESULTS = """good AS (SELECT uni.q, coalesce(string_agg(DISTINCT x.t, ',' ORDER BY x.t), '') AS ids FROM uni LEFT JOIN pred x USING (q) GROUP BY uni.q),
m AS (SELECT q, list_filter(string_split(ids, ','), lambda x: x != '') AS ids FROM {bad}),
c AS (SELECT uni.q, coalesce(list(DISTINCT x.t) FILTER (x.t IS NOT NULL), []) AS ids FROM uni LEFT JOIN cand x USING (q) GROUP BY uni.q)"""
_VIOLATIONS = """SELECT (SELECT count(*) FROM uni WHERE q NOT IN (SELECT q FROM m)) AS missing_queries, (SELECT count(*) FROM m WHERE q NOT IN (SELECT q FROM uni)) AS unknown_queries,
  (SELECT count(*) FROM m FULL JOIN c USING (q) WHERE m.ids IS NULL OR c.ids IS NULL) AS one_sided_queries,
  (SELECT count(*) FROM (SELECT q FROM m GROUP BY q HAVING count(*) > 1 UNION SELECT q FROM c GROUP BY q HAVING count(*) > 1)) AS repeated_queries,
  (SELECT count(*) FROM (SELECT ids FROM m UNION ALL SELECT ids FROM c) WHERE len(ids) != len(list_distinct(ids))) AS repeated_ids,
  (SELECT count(*) FROM m FULL JOIN c USING (q) WHERE len(list_filter(coalesce(m.ids, []), lambda x: NOT list_contains(coalesce(c.ids, []), x))) > 0) AS beyond_candidates,
  (SELECT count(DISTINCT t) FROM (SELECT unnest(ids) AS t FROM c UNION ALL SELECT unnest(ids) FROM m) WHERE t NOT IN (SELECT id FROM rec WHERE source IN (2, 3))) AS unknown_targets"""
_LIST = "SELECT uni.q AS source1_entity_id, coalesce(string_agg(DISTINCT x.t, ',' ORDER BY x.t), '') AS {c} FROM uni LEFT JOIN {x} x USING (q) GROUP BY uni.q"

#: name: (query of Data, SQL or None).
_BY_DATA = {
    "normalize_records": (
        lambda d: d.records.select("split", "id", "source", "country", "name", "address", "latin_name", "latin_address"),
        O.with_records(select="SELECT split, id, source, country, name, address, latin_name, latin_address FROM rec"),
    ),
    "profile_counts": (
        lambda d: audit.profile(d.records),
        O.with_records(select="SELECT split, source, country, count(*) AS n, count(*) FILTER (name = '') AS empty_name, count(*) FILTER (address = '') AS empty_address FROM rec GROUP BY ALL"),
    ),
    "dataset_profile": (
        lambda d: audit.raw_profile(d.records),
        O.with_records(
            select=f"SELECT split, source, country, count(*) AS n, count(*) FILTER (NOT starts_with(id, 'S' || source || '-')) AS wrong_prefix, count(*) FILTER (regexp_matches(raw_name, '{audit.BLANK}')) AS blank_name, count(*) FILTER (regexp_matches(raw_address, '{audit.BLANK}')) AS blank_address, max(length(raw_name))::INT AS max_name, max(length(raw_address))::INT AS max_address, sum(strlen(raw_name) + strlen(raw_address))::BIGINT AS bytes FROM rec GROUP BY ALL"
        ),
    ),
    "truth_pairs": (lambda d: d.truth, O.with_records(select="SELECT q, t FROM truth")),
    "audit_checks": (lambda d: audit.checks(d.records, d.truth, d.queries.select("q")), O.with_records(_UNI, "lab AS (SELECT q FROM uni)", select=_CHECKS.format(truth="truth"))),
    "audit_checks_on_faults": (_faulty_labels, O.with_records(_UNI, _FAULTY_LABELS, select=_CHECKS.format(truth="bad"))),
    "match_histogram": (
        lambda d: audit.matches_per_entity(d.truth, d.queries.select("q")),
        O.with_records(_UNI, select="SELECT m AS matches, count(*) AS entities FROM (SELECT uni.q, count(truth.t) AS m FROM uni LEFT JOIN truth USING (q) GROUP BY uni.q) GROUP BY m"),
    ),
    "singletons": (lambda d: d.queries.join(d.truth, "q", "left_anti").select("q"), O.with_records(_UNI, select="SELECT q FROM uni WHERE q NOT IN (SELECT q FROM truth)")),
    "entity_partition": (
        _partition,
        O.with_records(_UNI, select=f"SELECT q, h, CASE WHEN h % 100 < 10 THEN 'holdout' WHEN h % 100 < 20 THEN 'dev' WHEN h % 100 < 30 THEN 'tune' ELSE 'fit' END AS part FROM (SELECT q, {O.md5_long(f"'{SEED}:' || q")} AS h FROM uni)"),
    ),
    "entity_sample": (
        lambda d: _partition(d).where("part = 'fit'").orderBy("h", "q").limit(50).select("q", "h"),
        O.with_records(_UNI, select=f"SELECT q, h FROM (SELECT q, {O.md5_long(f"'{SEED}:' || q")} AS h FROM uni) WHERE h % 100 >= 30 ORDER BY h, q LIMIT 50"),
    ),
    "oof_folds": (
        lambda d: d.queries.select("q", M.fold(SMALL).alias("fold")),
        O.with_records(_UNI, select=f"SELECT q, ({O.md5_long(f"'{SEED + 1}:' || q")} % {SMALL.folds})::INT AS fold FROM uni"),
    ),
    "lexical_keys": (lambda d: lexical.record_keys(d.records, True), _keys("SELECT id, view, key FROM rk")),
    "posting_stats": (
        lambda d: lexical.posting_stats(d.targets, True, CAP),
        _keys(f"SELECT view, count(*) AS keys, count(*) FILTER (n <= {CAP}) AS kept, count(*) FILTER (n > {CAP}) AS omitted, coalesce(sum(n) FILTER (n <= {CAP}), 0)::BIGINT AS postings FROM (SELECT view, key, count(*) AS n FROM rk WHERE source IN (2, 3) GROUP BY view, key) GROUP BY view"),
    ),
    "lexical_candidates": (lambda d: d.candidates, _after(select="SELECT * FROM cand")),
    "tfidf_vocab": (
        lambda d: tfidf.vocabulary(d.targets, 0, FEATURES).select("term", "df", F.round("idf", 9).alias("idf")),
        O.with_records(_tfidf(0), select="SELECT term, df, round(idf, 9) AS idf FROM vocab0"),
    ),
    "tfidf_name_topk": (lambda d: tfidf.top_of_view(d.records, 0, TOP_K, FEATURES), _topk(0)),
    "tfidf_address_topk": (lambda d: tfidf.top_of_view(d.records, 1, TOP_K, FEATURES), _topk(1)),
    "tfidf_combined_topk": (lambda d: tfidf.top_of_view(d.records, 2, TOP_K, FEATURES), _topk(2)),
    "tfidf_candidates": (
        lambda d: tfidf.candidates(d.records, TOP_K, FEATURES),
        O.with_records(*map(_tfidf, range(3)), "longs AS (" + " UNION ALL ".join(f"SELECT q, t, {v} AS view, s FROM cos{v}" for v in range(3)) + ")", O.merged(TOP_K), select="SELECT * FROM cand"),
    ),
    "blocking_recall_by_k": (lambda d: metrics.recall_at(d.queries.select("q"), d.truth, d.candidates, KS), _after("uni AS (SELECT id AS q FROM rec WHERE source = 1)", _RANKED, select=_recall())),
    "recall_by_country": (lambda d: metrics.recall_at(d.queries, d.truth, d.candidates, KS, "country"), _after(_UNI, _RANKED, select=_recall("country"))),
    "candidate_size_stats": (
        lambda d: metrics.size_stats(d.queries.select("q"), d.candidates),
        _after(_UNI, select="SELECT round(avg(n), 9) AS mean, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.99) AS p99, max(n) AS max FROM (SELECT uni.q, count(cand.t) AS n FROM uni LEFT JOIN cand USING (q) GROUP BY uni.q)"),
    ),
    "candidate_sizes_by_k": (
        lambda d: metrics.sizes_at(d.queries.select("q"), d.candidates, KS).select("k", "mean", "p90", "p99", "max"),
        _after(_UNI, _RANKED, select=f"SELECT k, round(avg(n), 9) AS mean, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.99) AS p99, max(n) AS max FROM (SELECT k::INT AS k, uni.q, count(r.t) AS n FROM uni CROSS JOIN (SELECT unnest({KS}) AS k) LEFT JOIN ranked r ON r.q = uni.q AND r.rank <= k GROUP BY ALL) GROUP BY k"),
    ),
    "compact_views": (
        lambda d: R.compact(d.records).select("id", "latin_name", "latin_address"),
        O.with_records(select="SELECT id, nullif(latin_name, name) AS latin_name, nullif(latin_address, address) AS latin_address FROM rec"),
    ),
    "pair_features_native": (
        lambda d: P.plain_features(P.joined(P.labelled(d.candidates, d.truth), d.records)).select("q", "t", "y", *P.PLAIN, *P.RETRIEVAL),
        _after(select=_PAIRS_SQL),
    ),
    "pair_similarity": (lambda d: P.similarities(P.joined(d.candidates, d.records)).select("q", "t", *P.SIMILARITIES, *P.MIXED), _after(O.similarities(), select=_SIMILARITY)),
    "pair_features": (
        lambda d: d.features,
        _after(O.similarities(), f"plain AS ({_PAIRS_SQL})", f"alike AS ({_SIMILARITY})", select=f"SELECT plain.q, plain.t, y, {', '.join(P.FEATURES)} FROM plain JOIN alike USING (q, t)"),
    ),
    "entity_f05": (lambda d: _entities(d), _after(_UNI, _SCORED, _PRED, _ENT, select="SELECT * FROM ent")),
    "evaluate_macro": (lambda d: metrics.summary(_entities(d)), _after(_UNI, _SCORED, _PRED, _ENT, select=f"SELECT {_SUMMARY} FROM ent")),
    "eval_by_country": (lambda d: metrics.summary(_entities(d), "country"), _after(_UNI, _SCORED, _PRED, _ENT, select=f"SELECT country, {_SUMMARY} FROM ent GROUP BY country")),
    "threshold_sweep": (lambda d: decide.sweep(d.queries, d.truth, d.scored), _after(_UNI, _SCORED, _SWEEP, select="SELECT threshold, macro_f05 FROM swept")),
    "best_threshold": (lambda d: decide.best(decide.sweep(d.queries, d.truth, d.scored)), _after(_UNI, _SCORED, _SWEEP, select="SELECT threshold, macro_f05 FROM swept ORDER BY macro_f05 DESC, threshold DESC LIMIT 1")),
    "error_analysis": (
        lambda d: metrics.errors(d.queries, d.truth, d.predicted, d.candidates),
        _after(
            _SCORED,
            _PRED,
            select="""SELECT q, t, CASE WHEN q IN (SELECT q FROM truth) THEN 'false_positive' ELSE 'singleton_error' END AS kind FROM pred ANTI JOIN truth USING (q, t)
UNION ALL SELECT q, t, CASE WHEN (q, t) IN (SELECT (q, t) FROM cand) THEN 'false_negative' ELSE 'missed_by_blocking' END FROM (SELECT q, t FROM truth ANTI JOIN pred USING (q, t))""",
        ),
    ),
    "context_features": (
        lambda d: P.context(d.scored.select("q", "t", "p")).withColumn("p_sum", F.round("p_sum", 9)),
        _after(_SCORED, select="SELECT q, t, p, max(p) OVER w AS p_max, max(p) OVER w - p AS p_gap, 1.0::DOUBLE / row_number() OVER (PARTITION BY q ORDER BY p DESC, t) AS p_rank, round(sum(p) OVER w, 9) AS p_sum FROM scored WINDOW w AS (PARTITION BY q)"),
    ),
    "matching_results": (lambda d: export.id_lists(d.queries, d.predicted, "matched_entity_ids"), _after(_UNI, _SCORED, _PRED, select=_LIST.format(c="matched_entity_ids", x="pred"))),
    "candidate_pairs": (lambda d: export.id_lists(d.queries, d.candidates, "candidate_entity_ids"), _after(_UNI, select=_LIST.format(c="candidate_entity_ids", x="cand"))),
    "validate_outputs": (
        lambda d: _checked(d, F.array("matched_entity_ids"), []),
        _after(_UNI, _SCORED, _PRED, _RESULTS.format(bad="good"), select=_VIOLATIONS),
    ),
    "validate_faulty_outputs": (_faulty_results, _after(_UNI, _SCORED, _PRED, _RESULTS.format(bad=_FAULTY_RESULTS), select=_VIOLATIONS)),
    "expected_f_select": (lambda d: decide.expected_select(d.scored), None),
    "exact_normalize": (lambda d: d.records.select("id", X.normalize_exact("raw_name").alias("name"), X.latin_exact(X.normalize_exact("raw_name")).alias("latin_name")), None),
    "gbt_scores": (_gbt, None),
    "stack_scores": (_stack, None),
    "loco_report": (_loco, None),
}

_SYNTHETIC_SQL = f"""WITH n AS (SELECT unnest(range(240))::INT AS i), b AS (
  SELECT i, lpad(i::VARCHAR, 6, '0') AS six, 'Lotus ' || (i % 13) || ' Systems' AS nm, (100 + i) || ' Cedar ' AS road, ' Sector ' || (i % 7) AS sector, CASE WHEN i % 2 = 0 THEN 'India' ELSE 'US' END AS country FROM n),
r AS (
  SELECT country, 1 AS source, 'S1-' || six AS id, nm AS raw_name, road || 'Road' || sector AS raw_address FROM b
  UNION ALL SELECT country, 2, 'S2-' || six, nm, road || 'Rd' || sector FROM b WHERE i % 5 != 0
  UNION ALL SELECT country, 3, 'S3-' || six, upper(nm), road || 'Road' || sector FROM b WHERE i % 5 != 0 AND i % 3 = 0
  UNION ALL SELECT country, 2, 'S2-D' || six, nm, (9000 + i) || ' Elm Street' FROM b
  UNION ALL SELECT country, 3, 'S3-D' || six, 'Unrelated Bakery ' || i, '77 Distant Avenue' FROM b)
SELECT 'train' AS split, id, source, country, {O.norm("raw_name")} AS name, {O.norm("raw_address")} AS address FROM r"""


def _query(f):
    return lambda spark, sf_dir: f(Data(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Data(spark, sf_dir).candidates


def queries() -> dict:
    return {k: _query(f) for k, (f, _) in _BY_DATA.items()} | {"synthetic_records": _synthetic}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in _BY_DATA.items() if s} | {"synthetic_records": _SYNTHETIC_SQL}
