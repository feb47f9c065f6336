import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from kinweave.llm import components, simhash, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text, k=4):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def joined(ids, linked):
    up = {i: i for i in ids}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_classes_by_brute_force(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    prints = {r["doc_id"]: plain_print(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{p:016x}" for d, p in prints.items()}
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {r["doc_id"]: r["component_id"] for r in got} == joined(ids, links)


def test_native_hash_agrees(spark):
    text = "one two three four"
    assert spark.sql(f"select xxhash64('{text}')").head()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(text, 42)


def test_bit_sliced_distances():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 62, 300).astype(np.uint64)
    x[100:200] = x[:100] ^ np.uint64(0b1011)
    q = x[:70]
    for radius in (0, 3, 4, 7, 20):
        got = set(zip(*map(list, simhash.near(simhash.planes_of(x), q, radius)), strict=True))
        want = {(i, j) for i in range(70) for j in range(300) if (int(q[i]) ^ int(x[j])).bit_count() <= radius}
        assert {(i, j) for i, j in got if j < 300} == want
    for lag in (1, 5, 64, 100):
        got = simhash.near_at_lag(simhash.planes_of(x), lag, 4, len(x)).tolist()
        assert got == [i for i in range(300 - lag) if (int(x[i]) ^ int(x[i + lag])).bit_count() <= 4]


def test_large_groups_and_split_keys(spark, monkeypatch):
    r = random.Random(4)
    base = r.getrandbits(64)
    prints = {base}
    for _ in range(400):
        prints.add(r.choice(sorted(prints)[-30:]) ^ 1 << r.randrange(64) ^ 1 << r.randrange(64))
    prints = sorted(prints)
    ids = list(range(len(prints)))
    df = spark.createDataFrame([(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)], "doc_id long, fp long")
    links = [(a, b) for a in ids for b in ids[a + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = joined(ids, links)
    assert {x["doc_id"]: x["component_id"] for x in simhash.classes(df).collect()} == want
    # The same with keys split into blocks of 20, with few, one or hardly any pivots, and with all under one key.
    from pyspark.sql import functions as F

    keyed = df.select(F.explode(simhash.band_keys(F.col("fp"))).alias("k"), F.col("fp").alias("v"), F.col("fp").alias("p"))
    for rows, block, pivots in ((keyed, 20, 8), (keyed, 20, 1), (df.select(F.lit(1).cast("long").alias("k"), F.col("fp").alias("v"), F.col("fp").alias("p")), 50, 4)):
        monkeypatch.setattr(simhash, "PIVOTS", pivots)
        roots = {x["v"]: x["root"] for x in components.components(simhash.link_edges(rows, 4, len(ids), block)).collect()}
        groups = collections.defaultdict(set)
        for i, p in enumerate(prints):
            v = int(np.uint64(p).astype(np.int64))
            groups[roots.get(v, v)].add(i)
        assert {i: min(g) for g in groups.values() for i in g} == want


def test_components_by_rounds(spark):
    r = random.Random(5)
    spread = lambda v: v * 0x9E3779B97F4A7C15 % 2**61
    edges = [(spread(a), spread(r.randrange(max(0, a - 3), a))) for a in range(1, 200) if a % 37] + [(spread(0), spread(x)) for x in range(1000, 1100)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = joined(sorted({v for e in edges for v in e}), edges)
    groups = collections.defaultdict(set)
    for v, root in want.items():
        groups[root].add(v)
    for local in (20, 10**6):
        got = collections.defaultdict(set)
        for row in components.components(df, local).collect():
            got[row["root"]].add(row["v"])
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))
    assert components.components(df.limit(0)).count() == 0


def test_similar_texts(spark):
    r = random.Random(6)
    rows = []
    for g in range(12):
        words = [f"w{r.randrange(5000)}" for _ in range(300)]
        rows.append((10 * g, " ".join(words)))
        near = list(words)
        near[r.randrange(300)] = "other"
        rows += [(10 * g + 1, " ".join(near)), (10 * g + 2, " ".join(words)), (10 * g + 3, " ".join(words[:90] + [f"v{r.randrange(5000)}" for _ in range(210)]))]
    got = {x["doc_id"]: x["component_id"] for x in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d if d % 10 == 3 else d - d % 10 for d, _ in rows}


def test_odd_rows(spark, odd):
    for out in (simhash.near_duplicates(odd), simhash.similar_texts(odd)):
        rows = out.collect()
        assert len(rows) == 10
        by = collections.defaultdict(set)
        for x in rows:
            by[x["doc_id"]].add(x["component_id"])
        assert by[8] == by[1] == {1} and by[2] == by[3] == by[4] == {2} and by[None] == {None}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    assert simhash.similar_texts(odd.limit(0)).count() == 0


def brute(rows, window=35):
    words = [(d, WORDS.findall(t or "")) for d, t in rows]
    count = collections.Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    rows = substrings.remove_duplicate_passages(df).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows), key=str)


def test_passages_of_documents(spark, docs):
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_passages_made_up(spark):
    r = random.Random(3)
    many = [f"w{i}" for i in range(400)]
    bases = [" ".join(r.choice(many) for _ in range(120)) for _ in range(5)]
    rows = []
    for i in range(180):
        kind, w = i % 6, r.choice(bases).split()
        if kind == 0:
            t = " ".join(r.choice("abc") for _ in range(r.randrange(150)))
        elif kind == 1:
            t = " ".join(["x", "y", "z"][: r.randrange(1, 4)] * r.randrange(10, 60))
        elif kind == 2:
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = r.choice(many)
            t = "\n".join(w)
        elif kind == 3:
            a = r.randrange(60)
            t = " ".join(r.choice(many) for _ in range(20)) + " " + " ".join(w[a : a + r.randrange(30, 60)]) + " q " + " ".join(w[a : a + 40])
        elif kind == 4:
            t = None if i % 4 else ""
        else:
            t = " ".join(w)
        rows.append((i, t))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_words_that_fool_linear_hashes(spark):
    """Words of 1,024 letters in the order of Thue and Morse, which every polynomial modulo 2**64 takes for equal."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"r{i}" for i in range(34))
    rows = [(1, f"{one} {rest}"), (2, f"{other} {rest}")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_longest_matches_and_factors_by_definition():
    r = random.Random(8)
    for _ in range(200):
        parts = [[r.randrange(r.choice([2, 3, 30])) for _ in range(r.randrange(1, 90))] for _ in range(r.randrange(1, 6))]
        parts += [parts[0][3:40]] if len(parts[0]) > 3 else []
        flat, sizes = np.array(sum(parts, []), np.uint64), np.array([len(x) for x in parts])
        suffixes = [(i, j) for i, x in enumerate(parts) for j in range(len(x))]

        def common(a, b):
            n = 0
            while a[1] + n < len(parts[a[0]]) and b[1] + n < len(parts[b[0]]) and parts[a[0]][a[1] + n] == parts[b[0]][b[1] + n]:
                n += 1
            return n

        want = [min(64, max((common(a, b) for b in suffixes if b != a), default=0)) for a in suffixes]
        assert substrings.longest_matches(flat, sizes).tolist() == want
        for window in (1, 5, 35):
            windows = collections.Counter(tuple(x[j : j + window]) for x in parts for j in range(len(x) - window + 1))
            assert substrings.repeated_windows(flat, sizes, window).tolist() == [j + window <= len(parts[i]) and windows[tuple(parts[i][j : j + window])] > 1 for i, j in suffixes]


def test_passages_around_hot_grams(spark, monkeypatch):
    """Grams with many surroundings are counted by windows; small blocks hold few grams each."""
    r = random.Random(11)
    line = " ".join(f"c{i}" for i in range(25))
    rows = [(i, " ".join([*(f"w{r.randrange(3000)}" for _ in range(r.randrange(60))), line, *(f"w{r.randrange(3000)}" for _ in range(60))])) for i in range(60)]
    rows += [(i + 100, t.split(" ", 5)[5]) for i, t in rows[:20]] + [(200 + i, t) for i, t in rows[:10]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for hot, block in ((100, 1 << 18), (1 << 16, 200), (100, 200)):
        monkeypatch.setattr(substrings, "HOT_WINDOWS", hot)
        monkeypatch.setattr(substrings, "BLOCK_WORDS", block)
        assert found(df) == want


def test_passages_of_odd_rows(spark, odd):
    assert found(odd) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert substrings.remove_duplicate_passages(odd.limit(0)).count() == 0


def test_fingerprint_of_nulls_in_a_batch():
    assert simhash.fingerprint_batch(pa.array([None, "", "a b c d e"])).tolist() == [0, 0, plain_print("a b c d e")]


def exact_classes(rows):
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d, t in rows if (w := t.lower().split())}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return joined(ids, links)


def test_similar_texts_by_exact_similarity(spark):
    """Pairs just above and below 0.8, long and short, and a chain; the estimate alone decides half of them wrongly."""
    r = random.Random(9)
    rows = []
    for g in range(60):
        n = (204, 104, 9, 40)[g % 4]
        words = [f"w{r.randrange(10**6)}" for _ in range(n)]
        # Words put at the end: n - 4 shingles are shared, of n - 4 + extra.
        extra = int((n - 4) / 0.8 + 1e-9) - (n - 4) + (g // 4 % 2)
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join([*words, *(f"x{r.randrange(10**6)}" for _ in range(extra))]))]
    got = {x["doc_id"]: x["component_id"] for x in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == exact_classes(rows)


def test_large_classes_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TEXTS", 20)
    monkeypatch.setattr(simhash, "PIVOTS", 3)
    r = random.Random(10)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(words)
        for _ in range(r.randrange(5)):
            w[r.randrange(120)] = f"y{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {x["doc_id"]: x["component_id"] for x in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == exact_classes(rows)


def test_shared_and_null_ids_merge_no_texts(spark):
    import corpus_pipeline

    text = lambda i: " ".join(f"t{i}w{j}" for j in range(60))
    rows = [(None, text(1), "en", "a", 1), (None, text(2), "en", "a", 1), (7, text(3), "en", "b", 1), (7, text(4), "en", "a", 1), (7, text(4), "en", "a", 1), (8, text(4), "en", "a", 1), (None, text(3), "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((x["doc_id"], x["text"]) for x in corpus_pipeline.near_duplicates(spark, df, "").collect()), key=str)
    assert got == sorted([(None, text(1)), (None, text(2)), (7, text(3)), (7, text(4))], key=str)


def test_one_document_of_each_class_by_brute_force(spark, docs, odd):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = {}
    for d, t in rows:
        w = WORDS.findall(low(t))
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    out = simhash.one_of_each_class(docs)
    got = out.collect()
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in got) == sorted(set(joined(ids, links).values()))
    source = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in got} <= source
    # All columns stay, and a text that is broadcast is one that is joined.
    want = sorted(map(str, simhash.one_of_each_class(odd).collect()))
    assert len(want) == 6 and simhash.one_of_each_class(odd).columns == odd.columns
    limit, simhash.BROADCAST_ROWS = simhash.BROADCAST_ROWS, -1
    try:
        assert sorted(map(str, simhash.one_of_each_class(odd).collect())) == want
    finally:
        simhash.BROADCAST_ROWS = limit
    assert simhash.one_of_each_class(odd.limit(0)).count() == 0
