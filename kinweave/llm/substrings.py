"""Exact duplicate passages by relative Lempel-Ziv parsing against indexed blocks of the corpus.

The reference is the corpus itself, cut into blocks so that whatever could match
meets in one block: of the six-word grams in each window of 35 words one has the
least hash, and it names the block of the window. Consecutive windows with the same
least gram make a stretch, which depends on the words alone, so a passage is cut
alike wherever it stands. Stretches whose gram stands nowhere else hold no
duplicate, and never get to a block; equal stretches are counted and get there once.

A block is indexed by ranks of its word sequences of 1, 2, 4, ... 64 words (prefix
doubling), from which its suffix array and the longest match of each place with any
other place follow. Every stretch is then parsed greedily: a factor is the longest
match from where the last one ended. All windows inside a factor are duplicates;
windows across a boundary of factors are looked up by themselves. As stretches of a
block hold all windows with its grams, what has no match there stands once in the
corpus, and its place is told to its document; all other windows are duplicates.

A gram with very many different surroundings would make too large a block. Its
windows are counted by 128-bit hashes instead, which spreads them evenly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.llm import bytesops as B
from kinweave.llm import tables

WINDOW, GRAM = 35, 6
#: Longest stretch in windows; only texts that repeat themselves have longer runs, which are cut.
LONGEST = 256
#: Words in a block that is indexed at once, unless one gram has more; windows of a gram beyond which they are counted one by one.
BLOCK_WORDS, HOT_WINDOWS = 1 << 18, 1 << 13
#: Ranks of sequences of up to 2 ** LEVELS words; longer matches count as so long.
LEVELS = 6
#: What is known of a stretch: stands once and nothing else has its gram; is to be parsed; the same, and stands more than once. Added for hot grams.
ALONE, PARSED, REPEATED, HOT = 0, 1, 2, 4
_U = np.uint64


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a chunk, and where each text's words begin and end."""
    starts, ends, first = B.words(data, offsets, B.WORD_BY_SPACE)
    return B.word_hashes(data, starts, ends), first


def stretches(words: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, hash of the words, first window, number of windows, repeats itself) of each stretch; windows by word in the chunk."""
    n = len(words) - window + 1
    none = tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64, bool))
    if n <= 0:
        return none
    at = np.arange(len(words) - gram + 1)
    grams = B.span_hashes(words, at, at + gram)
    least = B.sliding_min(grams, window - gram + 1)
    sizes = np.diff(first)
    full = np.flatnonzero(sizes >= window)
    if not len(full):
        return none
    # Windows within one text: from its first word to its last but window - 1.
    begin, count = first[full], sizes[full] - window + 1
    valid = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
    m = least[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (m[1:] != m[:-1]) | (valid[1:] != valid[:-1] + 1)
    new[np.cumsum(count) - count] = True
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(valid)))
    if lengths.max() > LONGEST:
        parts = -(-lengths // LONGEST)
        inner = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        heads = np.repeat(heads, parts) + LONGEST * inner
        lengths = np.diff(np.append(heads, len(valid)))
    s = valid[heads]
    # Stretches around a gram that stands again within reach may hold a window twice.
    chosen = np.flatnonzero(grams == B.sliding_max(np.pad(least, window - gram, mode="edge"), window - gram + 1)[: len(grams)])
    pair = np.flatnonzero((grams[chosen[1:]] == grams[chosen[:-1]]) & (np.diff(chosen) <= window))
    mark = np.zeros(len(s) + 1, np.int64)
    np.add.at(mark, np.searchsorted(s + lengths, chosen[pair] - (window - gram), "right"), 1)
    np.add.at(mark, np.searchsorted(s, chosen[pair + 1], "right"), -1)
    again = np.cumsum(mark[:-1]) > 0
    again |= lengths > window - gram + 1
    return m[heads], B.span_hashes(words, s, s + lengths + window - 1, 1), s, lengths, again


def _owner(doc_hash: np.ndarray, start: np.ndarray) -> np.ndarray:
    """31 more bits of a row's identity and a word's place in one long."""
    return (doc_hash.astype(np.int64) & 0x7FFFFFFF) << 32 | start


def stretch_index(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(k, d, s, n, check) for stretches that stand once, and one of each that is to be parsed.

    Tasks add up equal stretches of a batch before the shuffle, which deals out by
    gram: a gram in very many copies arrives as one row for each batch.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, d = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            parts = []
            for lo, _, data, offsets in B.chunks(batch.column(2)):
                words, first = words_of(data, offsets)
                a, b, s, n, again = stretches(words, first, window, gram)
                row = np.searchsorted(first, s, "right") - 1
                parts.append((a, b, k[lo + row], _owner(d[lo + row], s - first[row]), n * 2 + again))
            if not parts:
                continue
            a, b, key, owner, size = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(new)
            one = order[at]
            columns = (a[at].view(np.int64), b[at].view(np.int64), key[one], owner[one], size[one], np.diff(np.append(at, len(a))))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["a", "b", "k", "o", "size", "n"])
        tables.release()

    rows = docs.select("k", "d", "text").mapInArrow(work, "a long, b long, k long, o long, size long, n long").repartition("a")
    one = rows.groupBy("a", "b").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("k", "o", "size")))
    near = Window.partitionBy("a")
    again = F.col("size").bitwiseAND(F.lit(1)) == 1
    parsed = (F.count("*").over(near) > 1) | F.max(again).over(near)
    windows = F.sum(F.shiftright("size", 1)).over(near)
    out = one.select("k", "o", F.shiftright("size", 1).alias("size"), "n", parsed.alias("parsed"), windows.alias("windows")).where("parsed or n = 1")
    check = F.when(F.col("parsed"), F.when(F.col("n") > 1, REPEATED).otherwise(PARSED) + F.when(F.col("windows") > HOT_WINDOWS, HOT).otherwise(0)).otherwise(ALONE)
    return out.select("k", F.shiftright("o", 32).alias("d"), F.col("o").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("s"), F.col("size").cast("int").alias("n"), check.alias("check"))


def _marked(batch: pa.RecordBatch, checks: tuple[int, ...]) -> Iterator[tuple]:
    """For each chunk of a batch (k, d, text, marks): words, and k, d, first word in the chunk and in the text, windows and check of the stretches marked so."""
    k, d = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    marks = batch.column(3).to_pylist()
    for lo, hi, data, offsets in B.chunks(batch.column(2)):
        runs = [(i, m["s"], m["n"], m["check"]) for i in range(lo, hi) for m in marks[i] or () if m["check"] in checks]
        if runs:
            words, first = words_of(data, offsets)
            row, s, n, check = np.array(runs, np.int64).T
            yield words, k[row], d[row], first[row - lo] + s, s, n, check


def longest_matches(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each place of stretches (words one after the other, of the given sizes) the longest match with any other place, at most 2 ** LEVELS words.

    No match goes beyond the end of a stretch.
    """
    n, ends = len(words), np.cumsum(sizes)
    # Each stretch is followed by a sign of its own.
    place = np.arange(n) + np.repeat(np.arange(len(sizes)), sizes)
    total = n + len(sizes)
    rank = np.empty(total, np.int64)
    rank[place] = np.unique(words, return_inverse=True)[1]
    rank[ends + np.arange(len(sizes))] = n + np.arange(len(sizes))
    ranks = [rank]
    for level in range(LEVELS):
        step = 1 << level
        later = np.concatenate([rank[step:], 2 * total + np.arange(min(step, total))])[:total]
        rank = np.unique(rank * (4 * total) + later, return_inverse=True)[1]
        ranks.append(rank)
    suffixes = np.argsort(rank, kind="stable")
    left, right, common = suffixes[:-1], suffixes[1:], np.zeros(max(total - 1, 0), np.int64)
    same = rank[left] == rank[right]
    for level in range(LEVELS - 1, -1, -1):
        # What lies beyond the end differs from everything.
        x, y = left + common, right + common
        inside = np.maximum(x, y) < total
        equal = inside & (ranks[level][np.minimum(x, total - 1)] == ranks[level][np.minimum(y, total - 1)])
        common += np.where(equal, 1 << level, 0)
    common[same] = 1 << LEVELS
    best = np.zeros(total, np.int64)
    best[right] = common
    best[left] = np.maximum(best[left], common)
    return best[place]


def repeated_windows(words: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """For each place of stretches whether the window that starts there stands elsewhere in the block; the last window - 1 places of a stretch start none.

    Parses every stretch greedily into factors; windows across their boundaries are looked up.
    """
    match = longest_matches(words, sizes)
    ends = np.cumsum(sizes)
    at, end = ends - sizes, ends.copy()
    inside, across = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, np.int64)
    while len(at):
        # A word without a match is a factor of its own.
        length = np.minimum(match[at], end - at)
        stop, last = at + np.maximum(length, 1), end - window + 1
        # Windows that start here and end within the factor, and those that it cuts.
        cut = np.maximum(at, np.minimum(at + length - window + 1, last))
        np.add.at(inside, at, 1)
        np.add.at(inside, cut, -1)
        over = np.maximum(cut, np.minimum(stop, last))
        np.add.at(across, cut, 1)
        np.add.at(across, over, -1)
        on = stop < last
        at, end = stop[on], end[on]
    return (np.cumsum(inside[:-1]) > 0) | (np.cumsum(across[:-1]) > 0) & (match >= window)


def _runs(k: np.ndarray, o: np.ndarray) -> pa.RecordBatch:
    """(k, d, s, n): runs of consecutive windows of one document, from rows sorted by document and place."""
    new = np.ones(len(o), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1] + 1)
    at = np.flatnonzero(new)
    columns = [k[at], o[at] >> 32, (o[at] & 0xFFFFFFFF).astype(np.int32), np.diff(np.append(at, len(o))).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "d", "s", "n"])


def single_windows(found: DataFrame, window: int, gram: int) -> DataFrame:
    """(k, d, singles): of the windows of parsed stretches, runs of those that stand once, by their first words."""

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, k, d, place, s, n, check in _marked(batch.select(["k", "d", "text", "marks"]), (PARSED, REPEATED)):
                grams = B.span_hashes(words, np.arange(len(words) - gram + 1), np.arange(len(words) - gram + 1) + gram)
                a = B.sliding_min(grams, window - gram + 1)[place]
                raw = words.tobytes()
                w = pa.array([raw[8 * p : 8 * (p + m + window - 1)] for p, m in zip(place.tolist(), n.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), w, pa.array(k), pa.array(_owner(d, s)), pa.array(check)], ["a", "w", "k", "o", "check"])
        tables.release()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(block: pa.Table) -> pa.RecordBatch:
            flat = block.column("w").combine_chunks()
            sizes = np.diff(np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]).astype(np.int64) // 8
            words = np.frombuffer(b"".join(flat.to_pylist()), _U)
            k, o, check = (block.column(c).to_numpy() for c in ("k", "o", "check"))
            again = repeated_windows(words, sizes, window)
            start = np.cumsum(sizes) - sizes
            nth = np.arange(len(words)) - np.repeat(start, sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            once = np.flatnonzero(~again & (nth <= (sizes - window)[row]) & (check == PARSED)[row])
            return _runs(k[row[once]], o[row[once]] + nth[once])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) < 8 * BLOCK_WORDS:
                continue
            block = pa.Table.from_batches(held)
            a = block.column("a").to_numpy()
            # The last gram may go on in the next batch.
            end = int(np.flatnonzero(a != a[-1]).max(initial=-1)) + 1
            if end:
                yield give(block.slice(0, end))
            held = block.slice(end).combine_chunks().to_batches()
        if held and (block := pa.Table.from_batches(held)).num_rows:
            yield give(block)
        tables.release()

    def count_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, k, d, place, s, n, check in _marked(batch.select(["k", "d", "text", "marks"]), (PARSED + HOT, REPEATED + HOT)):
                nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at, row = np.repeat(place, n) + nth, np.repeat(np.arange(len(n)), n)
                columns = [B.span_hashes(words, at, at + window, salt).view(np.int64) for salt in (2, 3)]
                columns += [k[row], _owner(d[row], s[row] + nth), check[row] - HOT]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["x", "y", "k", "o", "n"])
        tables.release()

    # With the key, which isn't used, the texts are dealt out by the same exchange as for the result, so only once.
    rows = found.select("key", "k", "d", "text", "marks")
    cut = rows.where("exists(marks, m -> m.check in (1, 2))").mapInArrow(cut_out, "a long, w binary, k long, o long, check long")
    parsed = cut.repartition("a").sortWithinPartitions("a").mapInArrow(parse, "k long, d long, s int, n int")
    windows = rows.where("exists(marks, m -> m.check > 4)").mapInArrow(count_out, "x long, y long, k long, o long, n long")
    once = windows.groupBy("x", "y").agg(F.sum("n").alias("n"), F.first("k").alias("k"), F.first("o").alias("o")).where("n = 1")
    counted = once.select("k", F.shiftright("o", 32).alias("d"), F.col("o").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("s"), F.lit(1).alias("n"))
    return parsed.unionByName(counted).repartition("k", "d").groupBy("k", "d").agg(F.collect_list(F.struct("s", "n")).alias("singles"))


def kept_words(text: bytes, marks: list, singles: list, window: int) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by spaces) of one text."""
    words = text.translate(_SPACES).split()
    n = len(words)
    if n < window:
        return n, 0, b" ".join(words)
    single = np.zeros(n - window + 1, bool)
    for m in marks or ():
        if m["check"] == ALONE:
            single[m["s"] : m["s"] + m["n"]] = True
    for m in singles or ():
        single[m["s"] : m["s"] + m["n"]] = True
    edge = np.zeros(n + 1, np.int64)
    twice = np.flatnonzero(~single)
    edge[twice] += 1
    edge[twice + window] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return n, int(n - keep.sum()), b" ".join(words) if keep.all() else b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


_SPACES = bytes(0x20 if B._WHITE[i] else i for i in range(256))


def remove_duplicate_passages(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, text, n_words, n_removed): each whole text without the words of passages that stand elsewhere too.

    A window of ``window`` consecutive words of one text is a duplicate if the same
    words start anywhere else, in the same text too; every word that a duplicate
    covers goes. What is left is joined by single spaces. Null texts are empty,
    repeated rows are copies of each other, null keys pass through, and other
    columns are left out. A row is told by hashes of its text and key, so the
    result doesn't depend on how often a task runs.
    """
    docs = df.select(df[key].alias("key"), F.coalesce(df[text], F.lit("")).alias("text"))
    told = F.coalesce(F.col("key").cast("string"), F.lit("\0"))
    docs = docs.withColumn("k", F.xxhash64("text", told)).withColumn("d", F.hash("text", told).bitwiseAND(F.lit(0x7FFFFFFF)).cast("long"))
    # Cut here, the long second half needn't be done again if an executor is lost, and begins with small heaps.
    index = tables.cut(stretch_index(docs, window, gram))
    tables.settle(df.sparkSession)
    marks = index.repartition("k", "d").groupBy("k", "d").agg(F.collect_list(F.struct("s", "n", "check")).alias("marks"))
    found = docs.repartition("k", "d").join(marks.hint("shuffle_hash"), ["k", "d"], "left")
    done = found.join(single_windows(found, window, gram), ["k", "d"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [kept_words(t, m, s, window) for t, m, s in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            n, removed, kept = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())], ["key", "text", "n_words", "n_removed"])
        tables.release()

    kind = df.schema[key].dataType.simpleString()
    return done.select("key", "text", "marks", "singles").mapInArrow(work, f"key {kind}, text string, n_words long, n_removed long").withColumnsRenamed({"key": key, "text": text})


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that passages of 35 words found elsewhere cover, and what is kept."""
    out = remove_duplicate_passages(tables.read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: The same in SQL, by comparing the words of all windows.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, w FROM d),
s AS (SELECT r, i, word, CASE WHEN i + {WINDOW - 1} <= len(w) THEN array_to_string(w[i:i + {WINDOW - 1}], ' ') END AS seq FROM x),
c AS (SELECT r, i, word, seq IS NOT NULL AND count(*) OVER (PARTITION BY seq) > 1 AS twice FROM s),
g AS (SELECT r, i, word, max(twice::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) = 1 AS gone FROM c),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
