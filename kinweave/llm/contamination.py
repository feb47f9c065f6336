"""Benchmark decontamination by CGK embeddings, bit-sampling LSH and edit verification.

The CGK embedding walks through a sequence of words and writes the current word
at each step; a random bit of step and word decides whether it moves on. Two
sequences under the same bits that differ by few edits fall into step again soon,
so their edit distance turns into few differing places of the embeddings. A table
of the LSH looks at some places only and finds the items that agree there. Walks
are repeated, with new bits, until a simulation with as many edits as are allowed
finds the wanted share of every class of lengths. What collides is verified by
exact edit distance.

The more edits are allowed, the more walks it takes, so long items are cut into
pieces of at most PIECE words. If all pieces had more than their share of edits,
the item had more than it is allowed, so one piece at least keeps to its share,
and that finds the item. Should a class of lengths still miss the wanted share
after MOST_WALKS walks, all windows that are placed for it are verified.

Windows have a piece's size and are placed where at least one run of words that
the allowed edits can't break occurs in the text, at its place in the piece: of L
words with at most d edits a run of (L - d) / (d + 1) words stays unbroken. No
window that could hold the piece is lost by this.
"""

from __future__ import annotations

import math
import random
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import bytesops as B
from kinweave.llm import tables

SIMILARITY = 0.8
RECALL = 0.99
#: Places that a table samples, tables for each walk, most walks, longest run of words for placing windows.
PLACES, TABLES, MOST_WALKS, LONGEST_RUN = 5, 4, 64, 4
#: Items of more than PIECE words are cut into pieces as long as each other; lengths up to these are classes of the simulation.
PIECE = 40
CLASSES = (4, 8, 12, 16, 24, 32, PIECE)
#: Edited pieces of each class in the simulation.
SIMULATED = 500
#: Items are taken in blocks of about this many bytes, each a pass over the corpus. An index takes about 12 times that.
BLOCK_BYTES = 4 << 20
WINDOWS_AT_ONCE = 8192
SEED = 7
_U = np.uint64


def text_words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words of letters and digits of one text."""
    data = B.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = B.words(data, np.array([0, len(data)]), B.WORD_ALNUM)
    return B.word_hashes(data, starts, ends)


def edits_allowed(length: int, similarity: float) -> int:
    return int(math.floor(length * (1 - similarity) + 1e-9))


def run_length(length: int, edits: int) -> int:
    return max(1, min(LONGEST_RUN, length, -(-(length - edits) // (edits + 1))))


def embed(rows: np.ndarray, steps: int, bits: np.ndarray) -> np.ndarray:
    """CGK embedding of rows of word hashes, padded with zeros: the words seen at each of so many steps."""
    at, n = np.zeros(len(rows), np.int64), np.arange(len(rows))
    out, last = np.empty((steps, len(rows)), _U), rows.shape[1] - 1
    for t in range(steps):
        w = rows[n, np.minimum(at, last)]
        out[t] = w
        at += (w * bits[t] >> _U(63)).astype(np.int64)
    return out


def pieces_of(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word, number of words) of the pieces of all items."""
    sizes = np.array([len(w) for w in words], np.int64)
    parts = -(-sizes // PIECE)
    item = np.repeat(np.arange(len(words)), parts)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = sizes[item] * nth // parts[item]
    return item, begin, sizes[item] * (nth + 1) // parts[item] - begin


@dataclass
class Index:
    """Items of one block: their words, the pieces and the runs that place windows of them, and the tables of each walk."""

    ids: list
    words: list[np.ndarray]
    similarity: float
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    size: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    walks: int = 0
    #: For each class of lengths whether its windows are verified without tables.
    direct: np.ndarray = field(default_factory=lambda: np.zeros(len(CLASSES), bool))
    longest: int = 0
    bits: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), _U))
    #: By run length: sorted hashes, and piece and offset of each.
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: By walk and table: sorted keys, and the piece of each.
    tables: list[list[tuple[np.ndarray, np.ndarray]]] = field(default_factory=list)

    def places(self, walk: int, table: int, lengths: np.ndarray) -> np.ndarray:
        """The steps that a table looks at, for items of the given lengths."""
        u = np.random.default_rng((SEED, walk, table)).random(PLACES)
        return np.minimum((u[None] * 2 * lengths[:, None]).astype(np.int64), 2 * self.longest - 1)

    def keys(self, walk: int, rows: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """The key of each row in each table of a walk."""
        seen, n = embed(rows, 2 * self.longest, self.bits[walk]), np.arange(len(rows))[:, None]
        out = []
        for t in range(TABLES):
            w = seen[self.places(walk, t, lengths), n]
            key = B.mix(lengths.astype(_U))
            for j in range(PLACES):
                key = B.mix(key * _U(B.BASE) ^ w[:, j])
            out.append(key)
        return out


def build(items: list[tuple[object, str | None]], similarity: float = SIMILARITY, recall: float = RECALL) -> Index:
    """Index of (id, text); items without words find nothing."""
    kept = [(i, w) for i, t in items if len(w := text_words(t))]
    ix = Index([i for i, _ in kept], [w for _, w in kept], similarity)
    if not kept:
        return ix
    ix.item, ix.begin, ix.size = pieces_of(ix.words)
    parts_of = [ix.words[j][b : b + n] for j, b, n in zip(ix.item, ix.begin, ix.size, strict=True)]
    ix.longest = int(ix.size.max())
    runs = defaultdict(list)
    for j, w in enumerate(parts_of):
        q = run_length(len(w), edits_allowed(len(w), similarity))
        at = np.arange(len(w) - q + 1)
        runs[q].append((B.span_hashes(w, at, at + q), np.full(len(at), j, np.int32), at.astype(np.int32)))
    for q, parts in runs.items():
        h, j, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        ix.runs[q] = h[order], j[order], at[order]
    ix.bits = np.random.default_rng(SEED).integers(0, 1 << 63, (MOST_WALKS, 2 * ix.longest), np.int64).astype(_U) << _U(1) | _U(1)
    ix.walks, ix.direct = _walks_needed(ix, parts_of, recall)
    rows = _rows(parts_of, ix.longest)
    for walk in range(ix.walks):
        found = []
        for key in ix.keys(walk, rows, ix.size):
            order = np.argsort(key, kind="stable").astype(np.int32)
            found.append((key[order], order))
        ix.tables.append(found)
    return ix


def class_of(lengths: np.ndarray) -> np.ndarray:
    return np.searchsorted(CLASSES, lengths)


def _rows(words: list[np.ndarray], longest: int) -> np.ndarray:
    out = np.zeros((len(words), longest + 1), _U)
    for i, w in enumerate(words):
        out[i, : len(w)] = w
    return out


def _walks_needed(ix: Index, parts: list[np.ndarray], recall: float) -> tuple[int, np.ndarray]:
    """Walks until a simulation, in which pieces of each class of lengths get as many random edits as allowed, finds the wanted share of each class, and the classes that miss it."""
    r = random.Random(SEED)
    pool = defaultdict(list)
    for w in parts:
        if edits_allowed(len(w), ix.similarity):
            pool[int(class_of(len(w)))].append(w)
    words = [some[r.randrange(len(some))] for _, some in sorted(pool.items()) for _ in range(SIMULATED)]
    missed = np.zeros(len(CLASSES), bool)
    if not words:
        return 1, missed  # only unchanged pieces count, and they collide in every table
    edited = []
    for w in words:
        x = [int(v) for v in w]
        for _ in range(edits_allowed(len(w), ix.similarity)):
            kind, i = r.randrange(3), r.randrange(len(x))
            if kind == 0:
                x[i] = r.getrandbits(64)
            elif kind == 1:
                x.insert(i, r.getrandbits(64))
            elif len(x) > 1:
                del x[i]
        edited.append(np.array(x[: len(w)], _U))
    lengths = np.array([len(w) for w in words])
    kind = class_of(lengths)
    a, b, found = _rows(words, ix.longest), _rows(edited, ix.longest), np.zeros(len(words), bool)
    for walk in range(MOST_WALKS):
        for x, y in zip(ix.keys(walk, a, lengths), ix.keys(walk, b, lengths), strict=True):
            found |= x == y
        share = np.bincount(kind, found, len(CLASSES)) / np.maximum(np.bincount(kind, minlength=len(CLASSES)), 1)
        missed = (share < recall) & (np.bincount(kind, minlength=len(CLASSES)) > 0)
        if not missed.any():
            # Half as many again, since the simulation stops at its first lucky walk and places no windows.
            return min(MOST_WALKS, walk + 1 + (walk + 2) // 2), missed
    return MOST_WALKS, missed


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for i, w in enumerate(words.tolist()):
        out[w] |= 1 << i
    return dict(out)


def best_match(masks: dict[int, int], size: int, text: list[int], most: int) -> tuple[int, int] | None:
    """(edits, end) of the best place of an item in a text by bit-parallel edit distance, the first of equals; None beyond ``most``."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best = full, 0, size, None
    for i, w in enumerate(text):
        eq = masks.get(w, 0)
        x = eq | minus
        down = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(down | plus))
        low = plus & down
        if up & top:
            score += 1
        elif low & top:
            score -= 1
        up, low = (up << 1) & full, (low << 1) & full
        plus, minus = low | (full & ~(x | up)), up & x
        if score <= most and (best is None or score < best[0]):
            best = score, i + 1
    return best


def hits_in(ix: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, first word, word after the last) of the items found in a chunk of texts."""
    starts, ends, first = B.words(data, offsets, B.WORD_ALNUM)
    words = B.word_hashes(data, starts, ends)
    rows, begin, piece = [], [], []
    for q, (h, item, offset) in ix.runs.items():
        if len(words) < q:
            continue
        at = np.arange(len(words) - q + 1)
        grams = B.span_hashes(words, at, at + q)
        may = np.zeros(1 << 20, bool)
        may[(h >> _U(44)).astype(np.int64)] = True
        at = at[may[(grams >> _U(44)).astype(np.int64)]]
        lo, hi = np.searchsorted(h, grams[at], "left"), np.searchsorted(h, grams[at], "right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        row = np.searchsorted(first, at, "right") - 1
        whole = at + q <= first[row + 1]
        at, lo, n, row = at[whole], lo[whole], (hi - lo)[whole], row[whole]
        entry = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - lo, n)
        rows.append(np.repeat(row, n))
        begin.append(np.repeat(at, n) - offset[entry])
        piece.append(item[entry])
    if not rows:
        return []
    rows, begin, piece = np.concatenate(rows), np.concatenate(begin), np.concatenate(piece)
    size = ix.size[piece]
    found: dict[tuple[int, int], list[int]] = defaultdict(list)
    open_ = ix.direct[class_of(size)]
    for row, s, j in set(zip(rows[open_].tolist(), begin[open_].tolist(), piece[open_].tolist(), strict=True)):
        found[row, int(ix.item[j])].append(s - int(ix.begin[j]))
    place = np.unique(np.stack([rows[~open_], begin[~open_], size[~open_]]), axis=1)
    for lo in range(0, place.shape[1], WINDOWS_AT_ONCE):
        row, s, n = place[:, lo : lo + WINDOWS_AT_ONCE]
        at = s[:, None] + np.arange(ix.longest + 1)[None]
        inside = (at >= first[row][:, None]) & (at < np.minimum(s + n, first[row + 1])[:, None])
        window = np.where(inside, words[np.clip(at, 0, len(words) - 1)], _U(0))
        pairs = set()
        for walk, by_table in enumerate(ix.tables):
            for (keys, own), key in zip(by_table, ix.keys(walk, window, n), strict=True):
                left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                for i in np.flatnonzero(right > left):
                    pairs.update((int(i), int(j)) for j in own[left[i] : right[i]])
        for i, j in pairs:
            found[int(row[i]), int(ix.item[j])].append(int(s[i]) - int(ix.begin[j]))
    masks: dict[int, dict[int, int]] = {}
    out = []
    for (row, j), begins in sorted(found.items()):
        size = len(ix.words[j])
        most, best = edits_allowed(size, ix.similarity), None
        low, high = int(first[row]), int(first[row + 1])
        regions = []
        for s in sorted(begins):
            a, b = max(low, s - most), min(high, s + size + most)
            if regions and a <= regions[-1][1]:
                regions[-1][1] = max(regions[-1][1], b)
            else:
                regions.append([a, b])
        for a, b in regions:
            text = words[a:b].tolist()
            if j not in masks:
                masks[j] = _masks(ix.words[j])
            m = best_match(masks[j], size, text, most)
            if m and (best is None or m[0] < best[0]):
                back = best_match(_masks(ix.words[j][::-1]), size, text[: m[1]][::-1], m[0])
                best = m[0], a - low + m[1] - back[1], a - low + m[1]
        if best:
            out.append((row, j, *best))
    return out


def find_items(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(key, item key, edits, similarity, first_word, last_word): one row for each item that stands in a text.

    An item stands in a text if some stretch of it is at most (1 - similarity)
    times the item's words away, counted in edits of lower-cased words of letters
    and digits; the best place is given, the first of equals. Null or wordless
    texts and items find nothing; items with equal texts and different keys each
    give their rows, and repeated items count once; repeated texts give their rows
    again; null keys pass through; other columns are left out. Items come to the driver in blocks
    of a measured size and each block is one pass over the texts, without a shuffle.
    """
    kind, item_kind = df.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, edits int, similarity double, first_word long, last_word long"
    item_type = items.select(item_key).limit(0).toArrow().schema.field(0).type
    out = None
    for shared in indexes(items, item_key, item_text, similarity, recall):

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                found = []
                for lo, _, data, offsets in B.chunks(batch.column(1)):
                    found += [(lo + h[0], *h[1:]) for h in hits_in(ix, B.LOWER[data], offsets)]
                row, item, edits, start, end = zip(*found, strict=True) if found else ((),) * 5
                near = [1 - e / len(ix.words[j]) for e, j in zip(edits, item, strict=True)]
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array([ix.ids[j] for j in item], item_type), pa.array(edits, pa.int32()), pa.array(near, pa.float64()), pa.array(start, pa.int64()), pa.array([e - 1 for e in end], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "item", "edits", "similarity", "first_word", "last_word"])
            tables.release()

        part = df.select(key, text).mapInArrow(work, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"key": key, "item": item_key})


def indexes(items: DataFrame, item_key: str, item_text: str, similarity: float, recall: float) -> list:
    """One broadcast index for each block of items; a block's size is measured before it comes to the driver. Repeated rows count once."""
    items = items.select(F.col(item_key).alias("key"), F.col(item_text).alias("text")).distinct()
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).head()[0] or 0
    blocks, out = max(1, -(-int(size) // BLOCK_BYTES)), []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b).collect()
        out.append(items.sparkSession.sparkContext.broadcast(build(sorted(map(tuple, rows), key=str), similarity, recall)))
    return out


def drop_contaminated(df: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows whose text holds no item, with all their columns.

    Null and empty texts stay, repeated rows are kept or dropped alike, and keys
    don't matter. See find_items for what counts.
    """
    for shared in indexes(items, item_key, item_text, similarity, recall):
        df = df.where(_clean(shared)(df[text]))
    return df


def _clean(shared):
    """A column function: whether a text holds none of the items of one block."""

    @F.arrow_udf("boolean")
    def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            ok = np.ones(len(column), bool)
            for lo, _, data, offsets in B.chunks(column):
                ok[[lo + h[0] for h in hits_in(shared.value, B.LOWER[data], offsets)]] = False
            yield pa.array(ok)
        tables.release()

    return clean


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in the whole texts of all documents; clean documents give no row."""
    return find_items(tables.read(spark, sf_dir, "documents", "doc_id", "text"), tables.read(spark, sf_dir, "benchmark", "item_id", "text"))
