"""Candidate retrieval over an inverted index of weighted keys.

A record has up to 24 keys of three views: name, address, and both joined. A
query's score for a target is the share of its key weights that the target has.
Keys with more targets than a cap are dropped as a whole and counted; this also
bounds the rows that a query can make in the join with the postings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions import text as X

VIEWS = ("name", "address", "combined")
SHARES = (0.4, 0.3, 0.3)
#: Queries and targets in a block, each with up to 24 keys.
QUERY_BLOCK, TARGET_BLOCK = 1 << 14, 1 << 18


def _longest(words: Column, n: int) -> Column:
    """The n longest words, of equal length the first by alphabet."""
    ranked = F.array_sort(F.transform(F.array_distinct(words), lambda w: F.struct((-F.length(w)).alias("l"), w.alias("w"))))
    return F.transform(F.slice(ranked, 1, n), lambda s: s["w"])


def _pairs(left: Column, right: Column, prefix: str) -> Column:
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.concat(F.lit(prefix), a, F.lit(":"), b))))


def keys(name: Column, address: Column, country: Column | None = None) -> Column:
    """Array of (view, key) of a record's Latin views; under a country the keys of different countries never meet."""
    name_words = _longest(F.filter(F.split(name, " "), lambda w: F.length(w) > 1), 4)
    address_words = _longest(F.filter(F.split(address, " "), lambda w: (F.length(w) > 2) & ~w.rlike("^[0-9]+$")), 4)
    numbers = F.slice(F.array_sort(X.numbers(address)), 1, 2)
    tight = F.replace(name, F.lit(" "), F.lit(""))
    count = F.length(tight) - 2
    grams = F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.substring(tight, i, 3))).otherwise(F.expr("cast(array() as array<string>)"))
    hashed = F.array_sort(F.transform(F.array_distinct(grams), lambda g: F.struct(F.md5(g.cast("binary")).alias("h"), g.alias("g"))))
    two = [(0, 1), (0, 2), (0, 3)]
    joined = F.array(*(F.when(F.size(name_words) > j, F.concat(F.lit("P:"), F.array_join(F.array_sort(F.array(F.get(name_words, F.lit(i)), F.get(name_words, F.lit(j)))), ":"))) for i, j in two))
    mark = lambda prefix: lambda w: F.concat(F.lit(prefix), w)
    by_view = [
        F.concat(F.when(name != "", F.array(F.concat(F.lit("N:"), name))).otherwise(F.expr("cast(array() as array<string>)")), F.transform(name_words, mark("W:")), F.filter(joined, lambda k: k.isNotNull()), F.transform(F.slice(hashed, 1, 4), lambda s: F.concat(F.lit("G:"), s["g"]))),
        F.transform(address_words, mark("A:")),
        F.concat(_pairs(numbers, F.slice(name_words, 1, 2), "J:"), _pairs(numbers, F.slice(address_words, 1, 2), "H:")),
    ]
    lead = F.lit("") if country is None else F.concat(country, F.lit("|"))
    told = lambda v: lambda k: F.struct(F.lit(v).alias("view"), F.concat(lead, k).alias("key"))
    return F.concat(*(F.transform(F.array_distinct(ks), told(v)) for v, ks in enumerate(by_view)))


def record_keys(records: DataFrame, country_block: bool) -> DataFrame:
    """(id, view, key)."""
    c = F.col("country") if country_block else None
    return records.select("id", F.explode(keys(F.col("latin_name"), F.col("latin_address"), c)).alias("k")).select("id", "k.view", "k.key")


def postings(targets: DataFrame, country_block: bool, cap: int) -> DataFrame:
    """The index: (key, t, n, total), the targets of every key with at most ``cap`` of them, their number, and that of all targets.

    Written as a table, it is read by any number of retrievals.
    """
    rows = record_keys(targets, country_block).select("key", F.col("id").alias("t"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= cap)
    total = targets.agg(F.count("*").alias("total"))  # a single row
    return rows.join(sizes, "key").crossJoin(F.broadcast(total))


def posting_stats(targets: DataFrame, country_block: bool, cap: int) -> DataFrame:
    """Per view: keys, kept keys, omitted keys, kept postings."""
    sizes = record_keys(targets, country_block).groupBy("view", "key").agg(F.count("*").alias("n"))
    kept = F.col("n") <= cap
    return sizes.groupBy("view").agg(F.count("*").alias("keys"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("omitted"), F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("postings"))


def view_scores(queries: DataFrame, index: DataFrame, country_block: bool) -> DataFrame:
    """(q, t, s0, s1, s2): evidence of each view, and 0.4, 0.3, 0.3 of name, address and joint for the combined one.

    A query has up to 24 keys, each with at most the index's cap of targets, so the
    rows of the join grow with the queries alone. Where many queries share a key,
    the join is on plain tables, which Spark splits at a hot key. What the join
    gives is dealt out by query once; all that follows, top_k too, stays there. A
    key of n targets brings its weight n times, so the sum of a query's weights is
    that of all its rows, each divided by n.
    """
    asked = record_keys(queries, country_block).withColumnRenamed("id", "q")
    w = F.log(1 + F.col("total") / F.col("n"))
    found = asked.join(index, "key").select("q", "t", "view", w.alias("w"), (w / F.col("n")).alias("part")).repartition("q")
    of_view = lambda c, v: F.sum(F.when(F.col("view") == v, F.col(c)))
    own = found.groupBy("q").agg(*(F.greatest(of_view("part", v), F.lit(1e-9)).alias(f"all{v}") for v in range(3)))
    got = found.groupBy("q", "t").agg(*(of_view("w", v).alias(f"w{v}") for v in range(3))).join(own, "q")
    half_up = lambda x: F.floor(x * 1e6 + 0.5) / 1e6  # noqa: E731  as _half_up, and as the SQL twin rounds
    wide = got.select("q", "t", *(F.coalesce(half_up(F.col(f"w{v}") / F.col(f"all{v}")), F.lit(0.0)).alias(f"e{v}") for v in range(3)))
    mixed = half_up(sum((F.col(f"e{v}") * SHARES[v] for v in range(1, 3)), F.col("e0") * SHARES[0]))
    return wide.select("q", "t", F.col("e0").alias("s0"), F.col("e1").alias("s1"), mixed.alias("s2"))


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """The best k targets of each query and view: (q, t, s_name, s_address, s_combined, and reciprocal ranks r_*), 0 beyond a view's best."""
    long = scores.select("q", "t", F.posexplode(F.array("s0", "s1", "s2")).alias("view", "s")).where("s > 0")
    return merge_views(long, k)


def merge_views(long: DataFrame, k: int) -> DataFrame:
    """One row for each query and target from (q, view, t, s): ranks by score, then id, cut at k for each view."""
    best = Window.partitionBy("q", "view").orderBy(F.desc("s"), "t")
    hits = long.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    picks = [F.coalesce(F.max(F.when(F.col("view") == v, x)), F.lit(0.0)).alias(f"{p}_{n}") for p, x in (("s", F.col("s")), ("r", 1 / F.col("rank"))) for v, n in enumerate(VIEWS)]
    return hits.groupBy("q", "t").agg(*picks)


def _half_up(x: np.ndarray) -> np.ndarray:
    return np.floor(x * 1e6 + 0.5) / 1e6


def _best_of_block(k: int):
    """A function of a block of queries (q, keys with view and weight) and one of targets (t, keys): (q, view, t, s) of each query's k best of each view, ties by t."""

    def best(asked: pa.Table, stored: pa.Table) -> pa.Table:
        out: list[tuple[str, int, str, float]] = []
        if asked.num_rows and stored.num_rows:
            stored = stored.sort_by("t")
            ts, lists = stored.column("t").to_pylist(), stored.column("keys").combine_chunks()
            keys = lists.flatten().to_numpy()
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], np.repeat(np.arange(len(ts)), lists.value_lengths().to_numpy())[order]
            lists = asked.column("keys").combine_chunks()
            inner, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy())
            view, w = inner.field("view").to_numpy(), inner.field("w").to_numpy()
            low, high = (np.searchsorted(keys, inner.field("key").to_numpy(), side).tolist() for side in ("left", "right"))
            got, place = np.zeros((3, len(ts))), np.zeros(len(ts), np.int64)
            for q, lo, hi in zip(asked.column("q").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                found = [owner[low[i] : high[i]] for i in range(lo, hi)]
                sizes = [len(x) for x in found]
                if not sum(sizes):
                    continue
                at, all_w = np.concatenate(found), np.maximum(np.bincount(view[lo:hi], w[lo:hi], 3), 1e-9)
                np.add.at(got, (np.repeat(view[lo:hi], sizes), at), np.repeat(w[lo:hi], sizes))
                # Each target once: where its last entry stands.
                number = np.arange(len(at))
                place[at] = number
                at = at[place[at] == number]
                e = _half_up(got[:, at] / all_w[:, None])
                got[:, at] = 0
                for v, s in enumerate((e[0], e[1], _half_up(e[0] * SHARES[0] + e[1] * SHARES[1] + e[2] * SHARES[2]))):
                    least = max(np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else 0, 1e-9)
                    on = np.flatnonzero(s >= least)
                    for i in on[np.lexsort((at[on], -s[on]))][:k].tolist():
                        out.append((q, v, ts[at[i]], float(s[i])))
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table({n: pa.array(c, kind) for n, c, kind in zip(("q", "view", "t", "s"), columns, (pa.string(), pa.int32(), pa.string(), pa.float64()), strict=True)})

    return best


def candidates(records: DataFrame, k: int, country_block: bool = True, cap: int = 2048, index: DataFrame | None = None) -> DataFrame:
    """Candidates of all queries (source 1) among all targets (sources 2 and 3), or those of a stored index.

    The scores of ``view_scores`` and its best k, without its join: a query has
    thousands of rows there. Queries and targets are cut into blocks; each pair of
    them is a task that gets the keys of both, by their 64-bit hashes, and looks up
    the ones in the others.
    """
    queries, targets = records.where("source = 1"), records.where("source in (2, 3)")
    n_q, n_t = (max(1, -(-df.count() // size)) for df, size in ((queries, QUERY_BLOCK), (targets if index is None else index.select("t").distinct(), TARGET_BLOCK)))
    cores = records.sparkSession.sparkContext.defaultParallelism
    n_q = max(n_q, -(-cores // n_t))
    index = postings(targets, country_block, cap) if index is None else index
    weights = index.groupBy("key").agg(F.log(1 + F.any_value("total") / F.any_value("n")).alias("w"))
    asked = record_keys(queries, country_block).withColumnRenamed("id", "q").join(weights, "key")
    code = F.xxhash64("key").alias("key")
    asked = asked.groupBy("q").agg(F.collect_list(F.struct("view", code, "w")).alias("keys"))
    stored = index.groupBy("t").agg(F.collect_list(code).alias("keys"))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda df: df.repartition(max(8 * n_q * n_t, cores), "a", "b").groupBy("a", "b")
    left = dealt(asked.select("q", "keys", block("q", n_q).alias("a"), every(n_t).alias("b")))
    right = dealt(stored.select("t", "keys", block("t", n_t).alias("b"), every(n_q).alias("a")))
    long = left.cogroup(right).applyInArrow(_best_of_block(k), "q string, view int, t string, s double")
    return merge_views(long.repartition("q"), k)
