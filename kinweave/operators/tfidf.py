"""Candidate retrieval by cosine of TF-IDF vectors, as products of blocks of vectors.

Three views: character grams of three and four of name and address, in Unicode and
Latin spelling, and word grams of one and two of both together. The vocabulary is
the most frequent terms of the targets, weights are (1 + ln tf) idf with
idf = ln((1 + n) / (1 + df)) + 1, and vectors have length one.

Equal texts of a country are one row. Queries and targets are cut into blocks of a
bounded size, and every pair of blocks of a country is a task of its own that gets
the texts, which are a tenth of the vectors, and makes the vectors slice by slice.
Terms that most pairs share are columns of a dense product in single precision, or the
few directions that hold nearly all of their weight, the others lists of postings; what
may come near a query's best k so far is worked out again in double precision, so the
result is that of all pairs. The best of the blocks are
the best of all. No join is on terms and none of them is hot.
"""

from __future__ import annotations

import collections
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinweave.operators.lexical import VIEWS, merge_views

#: Records of queries and of targets in a block, how many queries are multiplied at once, and how many entries of vectors are compared exactly at once.
QUERY_BLOCK, TARGET_BLOCK, QUERIES_AT_ONCE, ENTRIES_AT_ONCE = 1 << 14, 1 << 17, 384, 1 << 15
#: Smaller blocks are made for so many tasks a core, down to so many records; so many countries are cut at most.
TASKS, LEAST_BLOCK, MOST_CUT = 3, 1 << 13, 1 << 16
#: Targets of a block that are vectors at the same time (some 200 MB with all that is made of them), and texts that are cut into grams at once.
TARGETS_AT_ONCE, TEXTS_AT_ONCE = 1 << 15, 1 << 12
#: How many terms may be dense, and what a dense term costs a pair against one that both share in a list.
HEADS, DENSE_COST = (0, 32, 64, 128, 192, 256, 384, 512, 768, 1024), 1 / 300
#: Frequent terms are replaced by directions from so many on, if these leave so much of the targets' squares and if a pair costs so much of what it does otherwise.
LEAST_TURNED, LEFT, WORTH = 256, 0.02, 0.85
#: For a first bound so many times k of a query's likely best are worked out.
FIRST = 2
#: Columns of targets that a dense product works on at once, queries whose whole vectors stand as rows at once, and queries whose lists are copied at once.
COLUMNS_AT_ONCE, ROWS_AT_ONCE, LISTS_AT_ONCE = 1 << 13, 64, 4
#: Bound of the relative error of a score in single precision, for each term of a query and a few more: all products are positive, and only those of shared terms are rounded.
SINGLE, MORE = 2.0**-23, 16
#: Between the texts of records with the same id; no gram across it is in a vocabulary.
BETWEEN = ("\n", "\n", " \n\n ")
#: What the text of a view is made of.
COLUMNS = (("name", "latin_name"), ("address", "latin_address"), ("latin_name", "latin_address"))


def _numbers(key: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    """Numbers 0, 1, ... of the different values below ``most``, and how many there are; by a table if it is small, as sorting takes longer."""
    if most > 1 << 22:
        values, number = np.unique(key, return_inverse=True)
        return number, len(values)
    seen = np.zeros(most, np.bool_)
    seen[key] = True
    table = np.cumsum(seen, dtype=np.int64)
    return table[key] - 1, int(table[-1])


def _char_counts(some: list[str], m: np.ndarray) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Grams of three and of four of texts that come m times each: terms, how often each comes, and in how many texts."""
    joined = "".join(some)
    letter = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(some)), [len(x) for x in some])
    if len(letter) < 3:
        return
    code, base = _numbers(letter, 0x110000)
    cut = np.append(0, np.cumsum(letter == ord("\n")))
    two, pairs = _numbers(code[:-1] * base + code[1:], base**2)
    three, threes = _numbers(two[:-1] * base + code[2:], pairs * base)
    for n, key, most in ((3, three, threes), (4, three[:-1] * base + code[3:], threes * base)):
        on = np.flatnonzero((owner[: len(key)] == owner[n - 1 :]) & (cut[n:] == cut[:-n]))
        term, many = _numbers(key[on], most)
        own, place = owner[on], np.zeros(many, np.int64)
        place[term] = on
        once = np.sort(own * many + term)
        once = once[np.append(True, once[1:] != once[:-1])] if len(once) else once
        counts = (np.bincount(t, m[o], many).astype(np.int64) for t, o in ((term, own), (once % max(1, many), once // max(1, many))))
        yield [joined[i : i + n] for i in place.tolist()], *counts


def _word_counts(some: list[str], m: np.ndarray) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """The same for grams of one and of two words."""
    total, texts_of = collections.Counter(), collections.Counter()
    for x, n in zip(some, m.tolist(), strict=True):
        grams = []
        for part in x.split(BETWEEN[2]):
            words = [y for y in part.split(" ") if len(y) >= 2]
            grams += words + [f"{y} {z}" for y, z in zip(words, words[1:], strict=False)]
        for g in grams:
            total[g] += n
        for g in set(grams):
            texts_of[g] += n
    yield list(total), np.array(list(total.values()), np.int64), np.array([texts_of[g] for g in total], np.int64)


def _counts(view: int):
    """A function of batches of (text, m), which come m times each: (term, total, df) of each batch."""
    counted = _word_counts if view == 2 else _char_counts

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for term, total, df in counted(b.column("text").to_pylist(), b.column("m").to_numpy()):
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(total), pa.array(df)], ["term", "total", "df"])

    return of


def texts(records: DataFrame, view: int) -> DataFrame:
    """(id, country, text) of one view; what records of the same id and country say stands in one text, cut by BETWEEN."""
    text = F.concat_ws(" ", *COLUMNS[view])
    return records.select("id", "country", text.alias("text")).groupBy("id", "country").agg(F.array_join(F.array_sort(F.collect_list("text")), BETWEEN[view]).alias("text"))


def vocabulary(targets: DataFrame, view: int, max_features: int, sample: int | None = None) -> DataFrame:
    """(term, df, idf) of the most frequent terms, ties by term; of the first ``sample`` targets by hash, or of all."""
    if sample:
        chosen = targets.orderBy("h", "id").limit(sample).select("id")
        n = chosen.agg(F.count("*").alias("n"))
        targets = targets.join(chosen.distinct(), "id", "left_semi")
    else:
        n = targets.agg(F.count("*").alias("n"))
    # Equal texts are cut once, and terms are counted by batches of texts before they are rows.
    rows = texts(targets, view).groupBy("text").agg(F.count("*").alias("m"))
    found = rows.mapInArrow(_counts(view), "term string, total long, df long")
    top = found.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df")).orderBy(F.desc("total"), "term").limit(max_features)
    return top.crossJoin(F.broadcast(n)).select("term", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


class _Terms:
    """The terms of a vocabulary as a tree of their characters or words, and vectors of texts by it."""

    def __init__(self, terms: list[str], idf: np.ndarray, words: bool):
        self.idf, self.words = idf, words
        cut = [t.split(" ") if words else t for t in terms]
        self.names = {x: i for i, x in enumerate(sorted({x for t in cut for x in t}))}
        self.width = max(1, len(self.names))
        longest = max(map(len, cut), default=0)
        grid = np.array([[*map(self.names.get, t), *[-1] * (longest - len(t))] for t in cut], np.int64).reshape(len(cut), longest)
        size, at = (grid >= 0).sum(axis=1), grid[:, 0] if longest else np.zeros(0, np.int64)
        at, nodes = at.copy(), self.width
        #: For each length: the codes of nodes (above * width + the next one), a table of them if it is small, and the term that ends there.
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray]] = []
        for n in range(longest):
            codes, table = np.zeros(0, np.int64), None
            if n:
                on = np.flatnonzero(size > n)
                above, (codes, at[on]) = nodes, np.unique(at[on] * self.width + grid[on, n], return_inverse=True)
                nodes = len(codes)
                if above * self.width <= 1 << 24:
                    table = np.full(above * self.width, -1, np.int32)
                    table[codes] = np.arange(nodes)
            ends = np.full(nodes, -1, np.int64)
            own = np.flatnonzero(size == n + 1)
            ends[at[own]] = own
            self.levels.append((codes, table, ends))
        if not words:
            self.points = np.full(0x110000, -1, np.int64)
            self.points[[ord(c) for c in self.names]] = list(self.names.values())

    def _tokens(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What the texts are made of, by number (-1: in no term), and whose it is."""
        if self.words:
            lists = [[self.names.get(w, -1) for w in x.split(" ") if len(w) >= 2] for x in some]
            return np.array([w for x in lists for w in x], np.int64), np.repeat(np.arange(len(some)), [len(x) for x in lists])
        found = self.points[np.frombuffer("".join(some).encode("utf-32-le"), "<u4")]
        return found, np.repeat(np.arange(len(some)), [len(x) for x in some])

    def _some(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        token, owner = self._tokens(some)
        node, keys = token, []
        for n, (codes, table, ends) in enumerate(self.levels):
            if n:
                if len(token) <= n:
                    break
                code = np.where((node[:-1] >= 0) & (token[n:] >= 0) & (owner[n:] == owner[:-n]), node[:-1] * self.width + token[n:], -1)
                if table is not None:
                    node = np.where(code >= 0, table[code], -1)
                else:
                    place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    node = np.where((code >= 0) & (codes[place] == code), place, -1)
            on = np.flatnonzero(node >= 0)
            term = ends[node[on]]
            keys.append((owner[on] * len(self.idf) + term)[term >= 0])
        key, tf = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        own, term = np.divmod(key, max(1, len(self.idf)))
        w = (1 + np.log(tf)) * self.idf[term]
        return np.bincount(own, minlength=len(some)), term, w / np.sqrt(np.bincount(own, w * w, len(some)))[own]

    def vectors(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each text's vector starts and the last one ends, terms by number, and weights."""
        parts = [self._some(some[i : i + TEXTS_AT_ONCE]) for i in range(0, len(some), TEXTS_AT_ONCE)]
        size, term, w = (np.concatenate(x) for x in zip(*parts, strict=True))
        return np.append(0, np.cumsum(size)), term, w


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _numbered(of: tuple, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors by other numbers of terms; what has none is left out."""
    start, term, w = of
    term = number[term]
    on = term >= 0
    return np.append(0, np.cumsum(on))[start], term[on], w[on]


class _Room:
    """Memory that is used again: what is taken anew for each batch comes from the system page by page, which takes longer than the arithmetic in it."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def of(self, name: str, n: int, kind: type) -> np.ndarray:
        if name not in self.held or len(self.held[name]) < n:
            self.held[name] = np.empty(n + n // 4, kind)
        return self.held[name][:n]


def _above(scores: np.ndarray, bound: np.ndarray, room: _Room) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of scores that reach their row's bound. They are few, so eight places are looked at together."""
    near = room.of("near", -(-scores.size // 8) * 8, np.bool_)
    near[scores.size :] = False
    np.greater_equal(scores, bound[:, None], out=near[: scores.size].reshape(scores.shape))
    eight = np.flatnonzero(near.view(np.uint64))
    which, one = np.nonzero(near.reshape(-1, 8)[eight])
    return np.divmod(8 * eight[which] + one, scores.shape[1])


def _by_use(term: np.ndarray, asked: np.ndarray, n: int, n_asked: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms by the pairs of a query and one of n targets that share them, and for each number of first ones how many of the others a pair shares."""
    shared = asked * np.bincount(term, minlength=len(asked))
    order = np.argsort(-shared, kind="stable")
    return order, (shared.sum() - np.append(0, np.cumsum(shared[order]))) / max(1, n * n_asked)


def _heads(rest: np.ndarray) -> tuple[float, int]:
    """What a pair costs, in entries of lists, with as many dense terms as are best."""
    return min((h * DENSE_COST + rest[h], h) for h in HEADS if h < len(rest))


def _axes(of: tuple, asked: np.ndarray, n_asked: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Frequent terms, and directions (terms x directions, orthonormal) in which targets have nearly all of their weight of these; none if that is not less to do.

    Grams of the same words come together, so that there are far fewer directions than terms.
    """
    (start, term, w), n = of, min(len(of[0]) - 1, TEXTS_AT_ONCE)
    order, rest = _by_use(term, asked, len(start) - 1, n_asked)
    tried = [h for h in HEADS if LEAST_TURNED <= h < len(rest)]
    if min(n, n_asked) < 2 * LEAST_TURNED or not tried:
        return None
    column = np.full(len(asked), -1)
    column[order[: tried[-1]]] = np.arange(tried[-1])
    at, owner = column[term[: start[n]]], np.repeat(np.arange(n), np.diff(start[: n + 1]))
    dense = np.zeros((tried[-1], n), np.float32)
    dense[at[at >= 0], owner[at >= 0]] = w[: start[n]][at >= 0]
    both, found = (dense @ dense.T).astype(np.float64) / n, []
    for h in tried:
        left = np.cumsum(np.maximum(np.linalg.eigvalsh(both[:h, :h]), 0))
        many = h - int(np.searchsorted(left, LEFT, "right"))
        found.append(((many + 1) * DENSE_COST + rest[h], h, many))
    cost, h, many = min(found)
    if many == 0 or cost > WORTH * _heads(rest)[0]:
        return None
    return order[:h], np.ascontiguousarray(np.linalg.eigh(both[:h, :h])[1][:, h - many :], np.float32)


class _Slice:
    """Some targets as a dense block of frequent terms and postings of the others, for the queries of a block.

    With axes the dense block has directions instead of terms, and the length of what
    is left of a target beyond them: products of lengths bound those of what is left,
    so that scores are bounds from above, but for ``margin``.
    """

    def __init__(self, of: tuple, asked: np.ndarray, n_asked: int, axes: tuple | None = None):
        """asked: how many queries have a term."""
        (self.start, self.term, self.w), n = of, len(of[0]) - 1
        self.n, v, self.axes, self.margin, self.kind = n, len(asked), None, 0.0, np.uint16 if n <= 1 << 16 else np.int32
        if axes:
            self.head, self.axes = axes
            self.margin = (sum(self.axes.shape) + MORE) * SINGLE
        else:
            order, rest = _by_use(self.term, asked, n, n_asked)
            self.head = order[: _heads(rest)[1]]
        self.column = np.full(v, -1, np.int32)
        self.column[self.head] = np.arange(len(self.head))
        at = self.column[self.term]
        self.dense = np.empty((self.axes.shape[1] + 1 if axes else len(self.head), n), np.float32)
        for lo in range(0, n, COLUMNS_AT_ONCE):
            hi = min(lo + COLUMNS_AT_ONCE, n)
            self.dense[:, lo:hi] = self.turned(self.rows(lo, hi, self.start, self.term, self.w)).T
        tail = np.flatnonzero((at < 0) & (asked[self.term] > 0))
        owner = np.repeat(np.arange(n), np.diff(self.start))[tail]
        by_term = np.argsort(self.term[tail] * n + owner)
        self.sizes = np.bincount(self.term[tail], minlength=v)
        ends = np.append(0, np.cumsum(self.sizes))
        #: Of each term the targets that have it and their weights, as bytes: so all lists of a query are copied at once.
        self.listed, self.weight = (pa.Array.from_buffers(pa.large_binary(), v, [None, pa.py_buffer(ends * x.itemsize), pa.py_buffer(x)]) for x in (owner[by_term].astype(self.kind), self.w[tail[by_term]].astype(np.float32)))

    def rows(self, lo: int, hi: int, start: np.ndarray, term: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Weights of the frequent terms in vectors from lo to hi, a row for each."""
        out, some = np.zeros((hi - lo, len(self.head)), np.float32), slice(start[lo], start[hi])
        own, column = np.repeat(np.arange(hi - lo), np.diff(start[lo : hi + 1])), self.column[term[some]]
        out[own[column >= 0], column[column >= 0]] = w[some][column >= 0]
        return out

    def turned(self, rows: np.ndarray) -> np.ndarray:
        """Rows of weights by the axes, with the length of what is left; without axes as they are."""
        if self.axes is None:
            return rows
        out = np.empty((len(rows), self.axes.shape[1] + 1), np.float32)
        along, square = np.matmul(rows, self.axes, out=out[:, :-1]), np.einsum("ij,ij->i", rows, rows)
        # What single precision may lose of a square is added.
        out[:, -1] = np.where(square > 0, np.sqrt(np.maximum(square - np.einsum("ij,ij->i", along, along), 0) + self.margin), 0)
        return out

    def scores(self, wide: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], room: _Room) -> np.ndarray:
        """Of each query (a row of wide; its terms and weights) and target, in single precision; they stand in the room until the next call."""
        return self.products(self.turned(wide[:, self.head].astype(np.float32)), vectors, room)

    def products(self, heads: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], room: _Room) -> np.ndarray:
        """Scores, by the queries' turned weights of the frequent terms."""
        out = room.of("scores", len(vectors) * self.n, np.float32).reshape(len(vectors), self.n)
        for lo in range(0, self.n, COLUMNS_AT_ONCE):
            np.matmul(heads, self.dense[:, lo : lo + COLUMNS_AT_ONCE], out=out[:, lo : lo + COLUMNS_AT_ONCE])
        for lo in range(0, len(vectors), LISTS_AT_ONCE):
            term, w = (np.concatenate(x) for x in zip(*vectors[lo : lo + LISTS_AT_ONCE], strict=True))
            size, which = self.sizes[term], pa.array(term)
            many = int(size.sum())
            if many:
                at, x = (np.frombuffer(lists.take(which).buffers()[2], kind, many) for lists, kind in ((self.listed, self.kind), (self.weight, np.float32)))
                to, y = room.of("at", many, np.int64), np.repeat(w.astype(np.float32), size)
                to[:] = at
                y *= x
                ends = np.append(0, np.cumsum(size))[np.cumsum([0, *(len(v[0]) for v in vectors[lo : lo + LISTS_AT_ONCE])])].tolist()
                for row, i, j in zip(out[lo : lo + LISTS_AT_ONCE], ends, ends[1:], strict=False):
                    np.add.at(row, to[i:j], y[i:j])
        return out

    def exact(self, wide: np.ndarray, rows: np.ndarray, columns: np.ndarray, most: int) -> np.ndarray:
        """Scores of pairs that share a term, in double precision and rounded; about ``most`` entries at once."""
        size, out = np.diff(self.start)[columns], np.zeros(len(rows))
        ends = np.cumsum(size)
        lo = 0
        while lo < len(rows):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - size[lo] + most, "right")))
            n = size[lo:hi]
            at = _places(self.start[columns[lo:hi]], n)
            out[lo:hi] = np.add.reduceat(wide.reshape(-1).take(np.repeat(rows[lo:hi] * wide.shape[1], n) + self.term[at]) * self.w[at], np.cumsum(n) - n)
            lo = hi
        return np.round(out, 6)


def _best_of_block(k: int, terms: list[str], idf: np.ndarray, words: bool):
    """A function of a block of queries and one of targets (ids, text): (q, t, s) of each query's k best, s rounded to six places, ties by t."""
    rows_at_once, most, slices = min(ROWS_AT_ONCE, QUERIES_AT_ONCE), ENTRIES_AT_ONCE, TARGETS_AT_ONCE
    at_once = QUERIES_AT_ONCE // rows_at_once * rows_at_once
    if words:
        # Vectors are short, and few terms are dense.
        at_once, slices = rows_at_once, 2 * slices

    def best(asked: pa.Table, stored: pa.Table) -> pa.Table:
        out: list[tuple[str, str, float]] = []
        if asked.num_rows and stored.num_rows and len(terms):
            known, room = _Terms(terms, idf, words), _Room()
            start, term, w = known.vectors(asked.column("text").to_pylist())
            axes: tuple | None = None
            # Terms of queries are numbered anew, the most frequent first, so that what is looked up most stands together; others of targets add nothing.
            n, many, number = asked.num_rows, np.bincount(term, minlength=len(terms)), np.full(len(terms), -1)
            used = np.argsort(-many, kind="stable")[: np.count_nonzero(many)]
            number[used] = np.arange(len(used))
            many, term = many[used], number[term]
            close = 1 - (np.diff(start) + MORE) * SINGLE
            top, hits = np.zeros((n, k)), [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
            wide = np.zeros((min(rows_at_once, n), len(many)))
            for first in range(0, stored.num_rows, slices):
                made = _numbered(known.vectors(stored.column("text").slice(first, slices).to_pylist()), number)
                axes = axes if first else _axes(made, many, n)
                targets = _Slice(made, many, n, axes)
                found = [hits]
                for lo in range(0, n, rows_at_once):
                    hi = min(lo + rows_at_once, n)
                    if lo % at_once == 0:
                        end = min(lo + at_once, n)
                        heads = targets.turned(targets.rows(lo, end, start, term, w))
                        all_scores = targets.products(heads, [(term[start[i] : start[i + 1]], w[start[i] : start[i + 1]]) for i in range(lo, end)], room)
                    scores = all_scores[lo % at_once :][: hi - lo]
                    at = (np.repeat(np.arange(hi - lo), np.diff(start[lo : hi + 1])), term[start[lo] : start[hi]])
                    wide[at] = w[start[lo] : start[hi]]
                    least = top[lo:hi].min(axis=1)
                    if targets.n > k:
                        # Who has no k targets yet has them after this slice, or takes all of it.
                        # The exact scores of some of the best, as many as parts of the slice at least, give a bound.
                        new, deep = np.flatnonzero(least == 0), max(1, targets.n // (32 * FIRST * k))
                        parts = targets.n // deep
                        if len(new):
                            bests = scores[:, : deep * parts].reshape(hi - lo, deep, parts).max(axis=1)[new]
                            high = np.maximum(np.partition(bests, parts - min(parts, FIRST * k), axis=1)[:, parts - min(parts, FIRST * k)], 1e-7)
                            rows, columns = _above(scores[new], high, room)
                            s = targets.exact(wide, new[rows], columns, most)
                            order, size = np.lexsort((-s, rows)), np.bincount(rows, minlength=len(new))
                            enough = np.flatnonzero(size >= k)
                            least[new[enough]] = np.maximum(s[order[(np.cumsum(size) - size)[enough] + k - 1]] - 1e-6, 0)
                    rows, columns = _above(scores, np.maximum(least * close[lo:hi] - targets.margin - 1e-6, 1e-7).astype(np.float32), room)
                    s = targets.exact(wide, rows, columns, most)
                    wide[at] = 0
                    # A k-th best in single precision may be a little above the one that it becomes by rounding.
                    on = (s > 0) & (s >= least[rows] - 1e-6)
                    rows, columns, s = rows[on], columns[on], s[on]
                    found.append([rows + lo, columns + first, s])
                    on = s > top[lo:hi].min(axis=1)[rows]
                    rows, s = rows[on], s[on]
                    for j, own in zip(np.unique(rows), np.split(s, np.flatnonzero(np.diff(rows)) + 1), strict=False):
                        both = np.append(top[lo + j], own)
                        top[lo + j] = np.partition(both, len(both) - k)[len(both) - k :]
                hits = [np.concatenate(x) for x in zip(*found, strict=True)]
                on = hits[2] >= top.min(axis=1)[hits[0]]
                hits = [x[on] for x in hits]
            order = np.argsort(hits[0], kind="stable")
            rows, columns, s = (x[order] for x in hits)
            sets = dict(zip(used := np.unique(columns), stored.column("ids").take(pa.array(used)).to_pylist(), strict=True))
            ids = asked.column("ids")
            for i in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(rows)) + 1) if len(rows) else []:
                ranked = sorted((-x, t) for x, c in zip(s[i].tolist(), columns[i].tolist(), strict=True) for t in sets[c])[:k]
                out += [(q, t, -x) for q in ids[int(rows[i[0]])].as_py() for x, t in ranked]
        columns = list(zip(*out, strict=True)) or [()] * 3
        return pa.table({"q": pa.array(columns[0], pa.string()), "t": pa.array(columns[1], pa.string()), "s": pa.array(columns[2], pa.float64())})

    return best


def _cuts(queries: DataFrame, targets: DataFrame, country: Column) -> list[tuple[str, int, int]]:
    """Countries that are cut, with the number of blocks of queries and of targets: no block is too large, every core has some, and a country has its share of them."""
    size = lambda df, n: df.groupBy(country.alias("c")).agg(F.count("*").alias(n))
    both = size(queries, "q").join(size(targets, "t"), "c")
    rows = both.orderBy(F.desc(F.greatest(F.col("q") / QUERY_BLOCK, F.col("t") / TARGET_BLOCK)), "c").limit(MOST_CUT).collect()
    cores, pairs, out = queries.sparkSession.sparkContext.defaultParallelism, sum(r["q"] * r["t"] for r in rows), []
    for c, q, t in rows:
        share, n_q, n_t = cores * q * t / pairs, -(-q // QUERY_BLOCK), -(-t // TARGET_BLOCK)
        while n_q * n_t < TASKS * share and max(q / n_q, t / n_t) > LEAST_BLOCK:
            n_q, n_t = (n_q + 1, n_t) if q / n_q >= t / n_t else (n_q, n_t + 1)
        # Small tables are cut finer still.
        n_q = max(n_q, -int(-share // n_t))
        if n_q * n_t > 1:
            out.append((c, n_q, n_t))
    return out


def _pair_places(spark: SparkSession, cuts: list[tuple[str, int, int]], parts: int) -> list[tuple[str, int, int, int]]:
    """(country, block of queries, block of targets, place) of every pair of blocks: hashes of country and place differ, so that each has a task of its own."""
    tries = spark.createDataFrame([(c, 64 + 8 * n_q * n_t) for c, n_q, n_t in cuts], "c string, n int")
    told = tries.select("c", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("place")).select("c", "place", F.pmod(F.hash("c", "place"), F.lit(parts)).alias("part"))
    found, taken, out = collections.defaultdict(list), set(), []
    # Partitions are worked on in their order, and the first countries are the largest: theirs come first, so that no large task begins last.
    for c, part, place in sorted((c, part, place) for c, place, part in told.collect()):
        found[c].append((place, part))
    for c, n_q, n_t in cuts:
        free, other = [], []
        for place, part in found[c]:
            (other if part in taken or len(free) == n_q * n_t else free).append(place)
            if free and free[-1] == place:
                taken.add(part)
        out += [(c, i // n_t, i % n_t, place) for i, place in enumerate((free + other)[: n_q * n_t])]
    return out


def block_hits(records: DataFrame, view: int, k: int, max_features: int, country_block: bool, sample: int | None = None, index: tuple | None = None) -> DataFrame:
    """(q, t, s): of each query the k best targets of every block, with their cosine rounded to six places.

    index: stored vocabulary and texts of the targets, else they are made here. The
    vocabulary comes to the driver, which sends it along with the tasks.
    """
    queries, targets = records.where("source = 1"), records.where("source in (2, 3)")
    vocab, stored = index or (vocabulary(targets, view, max_features, sample), texts(targets, view))
    terms = vocab.select("term", "idf").toArrow()
    country = F.col("country") if country_block else F.lit("")
    spark, cuts = records.sparkSession, _cuts(queries, stored if index else targets, country)
    parts = max(2 * sum(n_q * n_t for _, n_q, n_t in cuts), spark.sparkContext.defaultParallelism)
    sizes = F.broadcast(spark.createDataFrame(cuts, "c string, n_q int, n_t int"))
    places = F.broadcast(spark.createDataFrame(_pair_places(spark, cuts, parts), "c string, a int, b int, place int"))
    block = lambda n: F.pmod(F.xxhash64("text"), F.coalesce(n, F.lit(1))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    # All ids of an equal query; of equal targets the first k can be among the best.
    asked = texts(queries, view).groupBy(country.alias("c"), "text").agg(F.collect_list("id").alias("ids"))
    same = Window.partitionBy("c", "text").orderBy("id")
    few = stored.select("id", country.alias("c"), "text").withColumn("n", F.row_number().over(same)).where(F.col("n") <= k).groupBy("c", "text").agg(F.collect_list("id").alias("ids"))
    left = asked.join(sizes, "c", "left").select("ids", "text", "c", block("n_q").alias("a"), every("n_t").alias("b"))
    right = few.join(sizes, "c", "left").select("ids", "text", "c", block("n_t").alias("b"), every("n_q").alias("a"))
    # A block is little to read and much to do, so partitions go by blocks.
    pair = ["c", "place"]
    dealt = lambda df: df.join(places, ["c", "a", "b"], "left").select("ids", "text", "c", F.coalesce("place", F.lit(0)).alias("place")).repartition(parts, *pair).groupBy(*pair)
    best = _best_of_block(k, terms.column("term").to_pylist(), terms.column("idf").to_numpy(), view == 2)
    return dealt(left).cogroup(dealt(right)).applyInArrow(best, "q string, t string, s double")


def _once(records: DataFrame, *columns: str) -> DataFrame:
    """The records' columns as a table in the cluster's checkpoint folder, as they are read again and again; without such a folder as they are."""
    spark, narrow = records.sparkSession, records.select("id", "source", "country", *columns, *(c for c in records.columns if c == "h"))
    there = spark.conf.get("spark.checkpoint.dir", None) or not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()
    return narrow.checkpoint() if there else narrow


def top_of_view(records: DataFrame, view: int, k: int, max_features: int, country_block: bool = True, sample: int | None = None) -> DataFrame:
    """(q, t, s, rank) of the best k targets of each query."""
    records, best = _once(records, *COLUMNS[view]), Window.partitionBy("q").orderBy(F.desc("s"), "t")
    return block_hits(records, view, k, max_features, country_block, sample).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def candidates(records: DataFrame, k: int, max_features: int, country_block: bool = True, sample: int | None = None, index: list | None = None) -> DataFrame:
    """Union of the best k of each view, as ``lexical.candidates``. index: of each view the vocabulary and texts of the targets."""
    long, records = None, records if index else _once(records, *COLUMNS[0], *COLUMNS[1])
    for v in range(len(VIEWS)):
        one = block_hits(records, v, k, max_features, country_block, sample, index and index[v]).withColumn("view", F.lit(v))
        long = one if long is None else long.unionByName(one)
    return merge_views(long.repartition("q"), k)
