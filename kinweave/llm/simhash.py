"""SimHash near-duplicates with a bit-sliced comparison.

Fingerprints are compared in blocks that are stored by bit: word j of plane b
holds bit b of fingerprints 64j to 64j+63. A difference with one fingerprint is
64 such planes, and counters that are bit planes themselves add one plane after
the other to 64 distances at a time, carry by carry. A block is abandoned as soon
as all of its distances exceed the radius.

Which fingerprints meet: 64 bits are cut into six bands. Fingerprints that differ
in at most four bits agree in two whole bands, so they share one of the 15 keys
made of two bands. This is exact, and a key has about 21 bits.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import bytesops as B
from kinweave.llm import tables
from kinweave.llm.components import Forest, components

SHINGLE, RADIUS, BANDS, HASH_SEED = 4, 4, 6, 42
#: Fingerprints under one key beyond which the key is split into blocks, and about how many of them all others are compared with first.
BLOCK, PIVOTS = 65_536, 128
#: similar_texts: least hashes that make a key, words of 64 bits of a fingerprint.
LEAST_HASHES, FINGERPRINT_WORDS = 5, 2
#: Texts of so few shingles meet by their least shingles, of which similar sets always share one.
SHORT = 32
#: Texts of a candidate class, and bytes of their sets, that a block of the exact comparison holds at most (a larger set makes a block of its own).
TEXTS, SET_BYTES = 16_384, 32 << 20
#: A table of texts (a few longs each, 40 bytes or so) is broadcast up to this many rows, which are counted; beyond it is joined by a shuffle.
BROADCAST_ROWS = 1 << 19
#: Groups up to this size are compared pair by pair in one go, larger ones block by block.
SMALL = 32
ROWS_AT_ONCE, BYTES_AT_ONCE = 32_768, 1 << 24
_TO_WORDS = bytes(0x20 if B._WHITE[i] else B.LOWER[i] for i in range(256))
#: Spreads the bits of a byte over the eight bytes of a word, to count up to 255 of them at once.
_SPREAD = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.uint8)[:, ::-1]).copy().view(np.uint64).ravel()
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(data: bytes, k: int) -> list[int]:
    """XXH64 of every shingle of k lower-cased words; of the whole sequence if there are fewer; none without words."""
    words = data.translate(_TO_WORDS).split()
    if not words:
        return []
    flat, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return [h(flat, HASH_SEED)]
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return [h(flat[s : e - 1], HASH_SEED) for s, e in zip(starts, ends[k - 1 :], strict=False)]


def bit_majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits that are set in over half of it; 0 for an empty run."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    first = np.cumsum(n) - n
    pieces = -(-n // 255)
    owner = np.repeat(np.arange(len(full)), pieces)
    cuts = first[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.zeros((len(full), 64), np.int64)
    heads = np.cumsum(pieces) - pieces
    for j in range(8):
        part = np.add.reduceat(_SPREAD[octets[:, j]], cuts).view(np.uint8).reshape(-1, 8)
        counts[:, 8 * j : 8 * j + 8] = np.add.reduceat(part.astype(np.int64), heads, axis=0)
    out[full] = np.packbits(counts * 2 > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint_batch(column: pa.Array, k: int = SHINGLE) -> np.ndarray:
    out = []
    for _, _, data, offsets in B.chunks(column):
        raw, cuts = data.tobytes(), offsets.tolist()
        runs = [shingle_hashes(raw[a:b], k) for a, b in itertools.pairwise(cuts)]
        sizes = np.array([len(r) for r in runs])
        out.append(bit_majorities(np.fromiter(itertools.chain.from_iterable(runs), np.uint64, int(sizes.sum())), sizes))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """(key, fp): the 64-bit fingerprint of each whole text, as a long. No words, or a null text: 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprint_batch(batch.column(1), k).view(np.int64))], ["key", "fp"])
        tables.release()

    return df.select(key, text).mapInArrow(work, f"key {df.schema[key].dataType.simpleString()}, fp long").withColumnRenamed("key", key)


def planes_of(x: np.ndarray) -> np.ndarray:
    """Bit planes (bits, ceil(n / 64)) of n fingerprints of one or more words; the last word is filled up with zeros."""
    x = x.reshape(len(x), -1)
    wide = np.zeros((-(-len(x) // 64) * 64, x.shape[1]), np.uint64)
    wide[: len(x)] = x
    bits = np.unpackbits(wide.view(np.uint8).reshape(len(wide), -1), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near_at_lag(planes: np.ndarray, lag: int, radius: int, n: int) -> np.ndarray:
    """Which of n fingerprints are within radius of the one ``lag`` places after: planes against themselves, shifted."""
    word, bit = divmod(lag, 64)
    counters = [np.zeros(planes.shape[1], np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(planes.shape[1], np.uint64)
    later = np.zeros((2, planes.shape[1]), np.uint64)
    for i, p in enumerate(planes):
        later[0, : len(p) - word] = p[word:]
        if bit:
            later[1, : len(p) - word - 1] = p[word + 1 :]
            over |= _add(counters, p ^ (later[0] >> np.uint64(bit) | later[1] << np.uint64(64 - bit)))
        else:
            over |= _add(counters, p ^ later[0])
        if i % 32 == 31 and i >= radius and (_beyond(counters, radius) | over == _FULL).all():
            return np.zeros(0, np.int64)
    hit = np.unpackbits((~(_beyond(counters, radius) | over)).view(np.uint8), bitorder="little")
    at = np.flatnonzero(hit)
    return at[at < n - lag]


def near(planes: np.ndarray, queries: np.ndarray, radius: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, fingerprint) indices at a distance of at most radius. order: which bits to look at, first those that differ most."""
    order = np.arange(len(planes)) if order is None else order
    live = np.arange(len(queries))
    queries = queries.reshape(len(queries), -1)
    shape = (len(queries), planes.shape[1])
    counters = [np.zeros(shape, np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(shape, np.uint64)
    for i, b in enumerate(order):
        flip = np.where(queries[live, b // 64] >> np.uint64(b % 64) & np.uint64(1), _FULL, np.uint64(0))[:, None]
        over |= _add(counters, planes[b][None] ^ flip)
        if i % 8 == 7 and radius <= i < len(order) - 1:
            keep = ~(_beyond(counters, radius) | over == _FULL).all(1)
            if not keep.all():
                if not keep.any():
                    return np.zeros(0, np.int64), np.zeros(0, np.int64)
                live, over, counters = live[keep], over[keep], [c[keep] for c in counters]
    hit = ~(_beyond(counters, radius) | over)
    rows, words = np.nonzero(hit)
    bits = np.unpackbits(hit[rows, words][:, None].view(np.uint8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return live[rows[at]], words[at] * 64 + bit


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit plane of the counts, given as planes from the lowest bit on, that exceed radius."""
    over, same = np.zeros_like(counters[0]), np.full_like(counters[0], _FULL)
    for j in range(len(counters) - 1, -1, -1):
        if radius >> j & 1:
            same = same & counters[j]
        else:
            over, same = over | same & counters[j], same & ~counters[j]
    return over


def _add(counters: list[np.ndarray], carry: np.ndarray) -> np.ndarray:
    """Adds a bit plane to the counters, carry by carry; returns what overflows."""
    for j, c in enumerate(counters):
        counters[j], carry = c ^ carry, c & carry
    return carry


def alike(one: bytes, others: list[bytes], similarity: float) -> np.ndarray:
    """Which of several sets (sorted 64-bit words) have at least this Jaccard similarity with one."""
    a, sizes = np.frombuffer(one, np.uint64), np.array([len(x) // 8 for x in others])
    out = np.zeros(len(others), bool)
    may = np.flatnonzero(np.minimum(sizes, len(a)) >= similarity * np.maximum(sizes, len(a)) - 1e-9)
    may = may[sizes[may] > 0]
    if len(may) and len(a):
        b, n = np.frombuffer(b"".join([others[i] for i in may]), np.uint64), sizes[may]
        both = np.add.reduceat((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).astype(np.int64), np.cumsum(n) - n)
        out[may] = both / (n + len(a) - both) >= similarity
    return out


def links_of_groups(key: np.ndarray, prints: np.ndarray, names: np.ndarray, radius: int, forest: Forest, sets: list[bytes] | None = None, similarity: float = 0, asked: np.ndarray | None = None) -> None:
    """Links the names of fingerprints within radius under the same key; rows come sorted by key. With sets, only those that are alike.

    asked: which rows are compared with all of their key; without it all are.
    """
    if not len(key):
        return
    prints = prints.reshape(len(prints), -1)
    cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    sizes = np.diff(cuts)
    own = np.repeat(sizes, sizes)
    rows = np.flatnonzero((own > 1) & (own <= SMALL)) if asked is None else ()
    if len(rows):
        x, k, planes = names[rows], key[rows], planes_of(prints[rows])
        for lag in range(1, int(own[rows].max())):
            for i in near_at_lag(planes, lag, radius, len(rows)):
                if k[i] == k[i + lag] and (sets is None or forest.root(int(x[i])) != forest.root(int(x[i + lag])) and alike(sets[rows[i]], [sets[rows[i + lag]]], similarity)[0]):
                    forest.link(int(x[i]), int(x[i + lag]))
    for g in np.flatnonzero(sizes > (SMALL if asked is None else 1)):
        query = np.arange(sizes[g]) if asked is None else np.flatnonzero(asked[cuts[g] : cuts[g + 1]])
        if not len(query):
            continue
        x, name = prints[cuts[g] : cuts[g + 1]], names[cuts[g] : cuts[g + 1]]
        # Bits on which the group is split evenly come first: they tell apart soonest. A bit that all share never differs.
        share = np.array([(x[:, b // 64] >> np.uint64(b % 64) & np.uint64(1)).mean() for b in range(64 * x.shape[1])])
        order = np.argsort(np.abs(share - 0.5), kind="stable")
        order = order[: max(1, int(((share > 0) & (share < 1)).sum()))]
        # label: which rows are known to hang together; only links between different labels are new.
        label, starts = np.arange(len(x)), range(0, len(x), 4096)
        planes = [planes_of(x[i : i + 4096]) for i in starts]
        for at in range(0, len(query), 64):
            some = query[at : at + 64]
            # Where all are asked, a pair is seen from its first row alone.
            for j in range(at // 4096 if asked is None else 0, len(planes)):
                p, r = near(planes[j], x[some], radius, order)
                p, r = some[p], r + starts[j]
                new = (r < len(x)) & (r > p if asked is None else r != p)
                p, r = p[new], r[new]
                if sets is not None:
                    for u in np.unique(p):
                        own = r[(p == u) & (label[r] != label[u])]
                        for v in own[alike(sets[cuts[g] + u], [sets[cuts[g] + i] for i in own], similarity)]:
                            if label[u] != label[v]:
                                forest.link(int(name[u]), int(name[v]))
                                label[label == max(label[u], label[v])] = min(label[u], label[v])
                    continue
                for u, v in {tuple(e) for e in np.unique(np.stack([label[p], label[r]], 1), axis=0).tolist()}:
                    u, v = label[u], label[v]
                    if u != v:
                        forest.link(int(name[u]), int(name[v]))
                        label[label == max(u, v)] = min(u, v)


def band_keys(fp, radius: int = RADIUS, bands: int = BANDS):
    """The keys of a fingerprint column: every choice of bands - radius bands, with their bits."""
    width = [64 // bands + (i < 64 % bands) for i in range(bands)]
    start = [sum(width[:i]) for i in range(bands)]
    keys = []
    for c, chosen in enumerate(itertools.combinations(range(bands), bands - radius)):
        key = F.lit(c).cast("long")
        for i in chosen:
            key = F.shiftleft(key, width[i]).bitwiseOR(F.shiftrightunsigned(fp, start[i]).bitwiseAND(F.lit((1 << width[i]) - 1)))
        keys.append(key)
    return F.array(*keys)


def link_edges(keyed: DataFrame, radius: int, n: int, block: int = BLOCK, similarity: float = 0) -> DataFrame:
    """Edges (a, b) that connect what lies within radius under a common key, from rows (k, v, p): key, name, fingerprint (long or binary).

    Each task gives a spanning forest of the links that it finds, not the links.
    n: how many fingerprints there are; keys needn't be counted if that is at most
    ``block``. With a similarity, rows have a set too (s, sorted 64-bit words), and a
    link counts only if the sets of both have at least this Jaccard similarity;
    blocks hold at most SET_BYTES of sets, too.

    A key with more than ``block`` fingerprints is dealt out in blocks by a hash.
    First all of them are compared with about PIVOTS of them, in proportion to
    their number. What hangs together with most pivots' rows needs no more links
    among itself; the rest, which in a large group of near copies is little, is
    compared with all of the key, block by block. So no link is lost, and only keys
    whose fingerprints don't hang together take a square of comparisons.
    """
    own_set = ["s"] if similarity else []
    parts = F.ceil(F.count("*") / block)
    if similarity:
        parts = F.greatest(parts, F.ceil(F.sum(F.octet_length("s")) / SET_BYTES))
    large = tables.cut(keyed.groupBy("k").agg(parts.cast("long").alias("n"), F.count("*").alias("count")).where("n > 1"), n) if similarity or n > block else None
    if large is None or large.isEmpty():
        return _compared(keyed.select("k", F.lit(0).cast("long").alias("part"), "v", "p", *own_set), radius, similarity)
    few = keyed.join(large, "k", "left_anti").select("k", F.lit(0).cast("long").alias("part"), "v", "p", *own_set)
    many = keyed.join(large, "k")
    cells = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    own = F.pmod(F.xxhash64("v"), F.col("n"))
    asked = lambda yes: F.lit(yes).alias("asked")
    pivot = F.pmod(F.xxhash64("v", F.lit("pivot")), F.greatest(F.lit(1), F.floor(F.col("count") / PIVOTS))) == 0
    dealt = many.select("k", own.alias("part"), "v", "p", *own_set, asked(False))
    pivots = many.where(pivot).select("k", cells("n").alias("part"), "v", "p", *own_set, asked(True))
    first = tables.cut(_compared(dealt.unionByName(pivots), radius, similarity))
    rooted = many.select("k", "v", "n").join(components(first), "v", "left")
    main = rooted.where("root is not null").groupBy("k", "root").count().groupBy("k").agg(F.max(F.struct("count", "root"))["root"].alias("main"))
    rest = tables.cut(rooted.join(main, "k", "left").where("root is null or main is null or root != main").select("k", "v"))
    found = _compared(few, radius, similarity).unionByName(first)
    sizes = rest.groupBy("k").agg(F.ceil(F.count("*") / block).cast("long").alias("m"))
    if rest.isEmpty():
        return found
    every = many.join(sizes, "k").select("k", "n", own.alias("own"), cells("m").alias("cell"), "v", "p", *own_set)
    every = every.select("k", (F.col("own") + F.col("n") * F.col("cell")).alias("part"), "v", "p", *own_set, asked(False))
    left = many.join(rest, ["k", "v"]).join(sizes, "k").select("k", "n", F.pmod(F.xxhash64("v", F.lit("rest")), F.col("m")).alias("own"), cells("n").alias("cell"), "v", "p", *own_set)
    left = left.select("k", (F.col("cell") + F.col("n") * F.col("own")).alias("part"), "v", "p", *own_set, asked(True))
    return found.unionByName(_compared(every.unionByName(left), radius, similarity))


def _compared(rows: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Edges (a, b) from rows (k, part, v, p, s with a similarity, asked if only some are compared with all) that share k and part."""
    some = "asked" in rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(forest: Forest) -> pa.RecordBatch:
            a, b = np.array(forest.edges(), np.uint64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(a.copy().view(np.int64)), pa.array(b.copy().view(np.int64))], ["a", "b"])

        def link(held: tuple, sets: list | None) -> None:
            links_of_groups(held[0], held[2], held[1], radius, forest, sets, similarity, held[3] if some else None)

        forest, held, waiting, sets = Forest(), None, [], []
        for batch in itertools.chain(batches, [None]):
            # Planes are worth making for many rows at a time.
            waiting += [batch] * (batch is not None)
            if not waiting or batch is not None and sum(map(len, waiting)) < ROWS_AT_ONCE and sum(x.nbytes for x in waiting) < BYTES_AT_ONCE:
                continue
            batch, waiting = pa.concat_batches(waiting), []
            if not len(batch):
                continue
            k, part, v = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3))
            p = batch.column(3)
            prints = np.frombuffer(b"".join(p.to_pylist()), np.uint64) if pa.types.is_binary(p.type) else p.to_numpy(zero_copy_only=False).view(np.uint64)
            prints = prints.reshape(len(v), -1)
            group = B.mix(B.mix(k.copy()) + part) if some else k
            rows = (group, v, prints, *([batch.column("asked").to_numpy(zero_copy_only=False)] if some else []))
            sets = sets + batch.column("s").to_pylist() if similarity else None
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            # The last group may go on in the next batch.
            end = int(np.flatnonzero(rows[0] != rows[0][-1]).max(initial=-1)) + 1
            held, rows = tuple(x[end:] for x in rows), tuple(x[:end] for x in rows)
            link(rows, sets)
            sets = sets[end:] if similarity else None
            if len(forest.up) > 200_000:
                yield give(forest)
                forest = Forest()
        if held is not None:
            link(held, sets)
        yield give(forest)
        tables.release()

    return rows.repartition("k", "part").sortWithinPartitions("k", "part").mapInArrow(work, "a long, b long")


def _named(prints: DataFrame, least: DataFrame, edges: DataFrame, key: str, n: int, most: int) -> DataFrame:
    """(key, v, component_id): rows (_key, v) with the least key of their component; least: (v, least), n rows; at most ``most`` edges.

    Only fingerprints with links go through the components; all others are named by their own least key.
    """
    linked = tables.cut(components(edges, most=most).join(least, "v"), n)
    ids = linked.groupBy("root").agg(F.min("least").alias("id"))
    named = linked.join(ids, "root").select("v", F.col("id").alias("component_id"), F.lit(True).alias("linked"))
    told = least.join(named, "v", "left").select("v", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    told = tables.cut(told, n)
    tables.settle(prints.sparkSession)
    return prints.join(told, "v").select(F.col("_key").alias(key), "v", "component_id")


def classes(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS, bands: int = BANDS) -> DataFrame:
    """(key, fp, component_id) from (key, fp): component_id is the smallest key that links reach.

    Equal fingerprints collapse into one before anything is compared, so exact
    copies cost one row; what is linked are distinct fingerprints. Null keys and
    repeated rows as in near_duplicates.
    """
    prints = tables.cut(prints.select(F.col(key).alias("_key"), F.col("fp").alias("v")))
    least = tables.cut(prints.groupBy("v").agg(F.min("_key").alias("least")), prints.count())
    n, chosen = least.count(), math.comb(bands, radius)
    keyed = least.select(F.explode(band_keys(F.col("v"), radius, bands)).alias("k"), "v", F.col("v").alias("p"))
    return _named(prints, least, link_edges(keyed, radius, n), key, n, n * chosen).withColumnRenamed("v", "fp")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id) for each row.

    fingerprint: 16 hexadecimal digits. Texts without words, null ones too, have
    fingerprint zero and are linked like any other. Repeated rows stay; a null key
    counts in no minimum, and a component of null keys alone has a null id. Other
    columns are left out.
    """
    out = classes(fingerprints(df, key, text, k), key, radius)
    return out.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def bands_needed(similarity: float, recall: float, least: int = LEAST_HASHES) -> int:
    """Keys of so many least hashes each, one of which sets of at least this similarity share with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**least))


def meeting_keys(sets: list[np.ndarray], similarity: float, bands: int, least: int = LEAST_HASHES) -> list[np.ndarray]:
    """The keys by which each set meets others: of its least hashes under several orders, or its least shingles if it is short."""
    upto = math.floor(SHORT / similarity)
    out = [[s[: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1].view(np.int64) | np.int64(-1 << 63)] if 0 < len(s) <= upto else [] for s in sets]
    long = [i for i, s in enumerate(sets) if len(s) > SHORT]
    if long:
        h, sizes = np.concatenate([sets[i] for i in long]), np.array([len(sets[i]) for i in long])
        starts = np.cumsum(sizes) - sizes
        orders = np.random.default_rng(HASH_SEED).integers(0, 1 << 63, (bands, least), np.int64).astype(np.uint64) << np.uint64(1) | np.uint64(1)
        keys = np.empty((bands, len(long)), np.uint64)
        for b in range(bands):
            key = np.full(len(long), b + 1, np.uint64)
            for order in orders[b]:
                key = B.mix(key * np.uint64(B.BASE) ^ np.minimum.reduceat(h * order, starts))
            keys[b] = key >> np.uint64(1)
        for i, row in zip(long, keys.T, strict=True):
            out[i].append(row.view(np.int64) if row.flags.c_contiguous else np.ascontiguousarray(row).view(np.int64))
    return [np.concatenate(k) if k else np.zeros(0, np.int64) for k in out]


def text_digest(text):
    """The column by which rows of the same text are told; null is empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _known(rows: DataFrame, few: DataFrame, n: int, how: str) -> DataFrame:
    """rows joined with n rows of another table by t, broadcast if these are few."""
    return rows.join(F.broadcast(few) if n <= BROADCAST_ROWS else few, "t", how)


def _text_classes(df: DataFrame, key: str, text: str, k: int, similarity: float, recall: float) -> tuple[DataFrame, DataFrame, int]:
    """Rows (_key, t, v), v naming a set of shingles and t a text; (v, class, first, rows), first being the least (no key, key, t) of a set; the number of sets.

    Texts of more than SHORT shingles meet by keys of least hashes, as many as the
    wanted recall needs. Shorter ones, and those up to what can be similar to them,
    meet by their least shingles, of which similar sets always share one. What
    meets and lies within the radius (the mean distance at this similarity, of
    small sets, where it is largest, and four deviations) makes candidate classes;
    in these, all pairs within the radius are compared by their sets, and only
    similar ones count.
    """
    bands, bits = bands_needed(similarity, recall), 64 * FINGERPRINT_WORDS
    differ = max(3 / 16, math.acos(2 * similarity / (1 + similarity)) / math.pi)
    radius = int(bits * differ + 4 * math.sqrt(bits * differ * (1 - differ)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), k)
            v = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            keys = meeting_keys(sets, similarity, bands)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            p = pa.array([r.tobytes() for r in wide_fingerprints(sets, FINGERPRINT_WORDS)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(v), p, lists], ["_key", "t", "v", "p", "ks"])
        tables.release()

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("text"), text_digest(F.col(text)).alias("t"))
    prints = tables.cut(rows.mapInArrow(work, f"_key {kind}, t long, v long, p binary, ks array<long>"))
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("id"), "t")).alias("first")
    once = tables.cut(prints.groupBy("v").agg(first, F.count("*").alias("rows"), F.first("p").alias("p"), F.first("ks").alias("ks")), 8 * prints.count())
    n = once.count()
    keyed = once.select(F.explode("ks").alias("k"), "v", "p")
    near_by = components(link_edges(keyed, radius, n), most=n * bands)
    tables.settle(df.sparkSession)
    candidates = tables.cut(near_by.join(once, "v").select(F.col("root").alias("k"), "v", "p", F.col("first.t").alias("t")), n)

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([s.tobytes() for s in shingle_sets(batch.column(3), k)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sets], ["k", "v", "p", "s"])
        tables.release()

    # Only texts of candidates are sent, and equal ones are added up first, so a text with very many copies is one row a task.
    many = candidates.count()
    texts = _known(rows.select("t", "text"), candidates.select("t").distinct(), many, "left_semi").groupBy("t").agg(F.first("text").alias("text"))
    full = candidates.join(texts, "t").select("k", "v", "p", "text").mapInArrow(with_sets, "k long, v long, p binary, s binary")
    sure = components(link_edges(tables.cut(full), radius, many, TEXTS, similarity))
    told = once.select("v", "first", "rows").join(sure, "v", "left").select("v", F.coalesce("root", "v").alias("class"), "first", "rows")
    return prints.select("_key", "t", "v"), tables.cut(told, n), n


def similar_texts(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(key, component_id): classes of texts whose sets of k-word shingles have this Jaccard similarity or more.

    Fingerprints of the distinct shingles tell which texts are compared; a link
    counts only after the exact similarity of the two sets. recall: the share of
    pairs just at the similarity that are found; more similar ones are found more
    often, and pairs of short texts always. Equal sets collapse first. Texts
    without words are one class. Repeated rows stay, a null key counts in no
    minimum, other columns are left out.
    """
    prints, told, n = _text_classes(df, key, text, k, similarity, recall)
    ids = told.groupBy("class").agg(F.min("first.id").alias("component_id"))
    named = tables.cut(told.join(ids, "class").select("v", "component_id"), n)
    return prints.join(named, "v").select(F.col("_key").alias(key), "component_id")


def one_of_each_class(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """The rows of df, with all their columns, but one for each class of similar_texts: least key, null last, then digest of the text.

    Classes are of texts, so a shared or null key merges nothing. Of repeated rows
    with that key and text the least by the other columns stays, nulls first. Rows
    whose text is alone in the table pass through without a shuffle; only texts of
    classes with several rows are looked up. An empty table stays empty.
    """
    prints, told, n = _text_classes(df, key, text, k, similarity, recall)
    large = told.groupBy("class").agg(F.sum("rows").alias("rows"), F.min("first").alias("first")).where("rows > 1")
    several = tables.cut(told.select("v", "class").join(large.select("class", F.col("first.id").alias("_first"), F.col("first.t").alias("_first_t")), "class").drop("class"), n)
    texts = tables.cut(prints.join(several, "v").select("t", "_first", "_first_t", F.lit(True).alias("_several")).distinct(), n)
    rows = df.select(F.struct(*df.columns).alias("_row"), F.col(key).alias("_key"), text_digest(F.col(text)).alias("t"))
    found = _known(rows, texts, texts.count(), "left")
    tables.settle(df.sparkSession)
    alone = found.where("_several is null").select("_row.*")
    chosen = found.where("_several and t = _first_t and _key <=> _first")
    rest = F.min(F.struct(*(F.col("_row").getField(c).alias(c) for c in df.columns))).alias("_row")
    return alone.unionByName(chosen.groupBy("_key", "t").agg(rest).select("_row.*"))


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the shingles of each text."""
    out = []
    for _, _, data, offsets in B.chunks(column):
        raw, cuts = data.tobytes(), offsets.tolist()
        out += [np.unique(np.array(shingle_hashes(raw[a:b], k), np.uint64)) for a, b in itertools.pairwise(cuts)]
    return out


def wide_fingerprints(sets: list[np.ndarray], words: int) -> np.ndarray:
    """Fingerprints of so many words; each word from a hash of its own of the shingles' hashes."""
    out = []
    for lo in range(0, len(sets), 256):
        part = sets[lo : lo + 256]
        h, sizes = np.concatenate(part), np.array([len(s) for s in part])
        out.append(np.stack([bit_majorities(B.mix(h + np.uint64(j * B.BASE & 0xFFFFFFFFFFFFFFFF)), sizes) for j in range(words)], 1))
    return np.concatenate(out) if out else np.zeros((0, words), np.uint64)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(tables.read(spark, sf_dir, "documents", "doc_id", "text"))
