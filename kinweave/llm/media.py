"""Copies of images in a binary column, found by local descriptors.

Corners are found at several scales: every place that is stronger than all others
around it, so their number follows the area, and a crop keeps those of the whole.
The patch around a corner is turned by the direction of its centre of mass, and
pairs of its points are compared; the results are the bits of its descriptor.

Descriptors meet in tables, one for each of PARTS parts of their bits. The query's
side also looks under keys with one of the bits turned that were least sure, those
whose points differed least. What meets within a Hamming radius is a match. Two
matches of a pair of images fix a turn, a scale and a shift; the copy is an image
for which many matches agree on one. So crops, turned, resized and retouched copies
are found, while single look-alike patches count for nothing.

Images are portable graymaps or pixmaps (P5, P6), read and written here.
"""

from __future__ import annotations

import cmath
import functools
import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import tables

#: Scales of an image, and those of a query, half a step apart.
SCALES, ASKED_SCALES = (1.0, 0.7071, 0.5), (1.0, 0.8409, 0.7071, 0.5946, 0.5)
#: The distance within which a corner is the strongest.
APART = 5
#: Descriptors of BITS bits, of which PARTS times KEY_BITS are keys of tables; the least sure bits of a key that a query turns one at a time, and two at a time.
PATCH, BITS, KEY_BITS, PARTS, TURNED, PAIRED = 9, 128, 20, 6, 8, 4
#: Largest distance of matching descriptors, and distinct places of the query that agree in a copy.
RADIUS, INLIERS = 15, 4
#: Pixels that a corner may be off, and pairs of matches that are tried for a pair of images; with fewer matches all pairs are.
OFF, TRIED = 3.0, 600
#: Points are compared by the mean of a square of this many pixels around them, and as many more on each side.
SOFT = 1
IMAGES_AT_ONCE, PIXELS_AT_ONCE, CORNERS_AT_ONCE = 32, 1 << 21, 1024
_HEADER = re.compile(rb"^(P[56])(?:\s+|#[^\n]*\n)+(\d+)(?:\s+|#[^\n]*\n)+(\d+)(?:\s+|#[^\n]*\n)+(\d+)\s")

_GRID = np.mgrid[-PATCH : PATCH + 1, -PATCH : PATCH + 1]
_DISC = (_GRID**2).sum(0) <= PATCH**2


def encode(image: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % image.shape[::-1] + np.ascontiguousarray(image, np.uint8).tobytes()


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey values of an image, or None where the bytes aren't a whole image with 8-bit samples."""
    m = _HEADER.match(data or b"")
    if not m or int(m[4]) > 255 or int(m[4]) == 0:
        return None
    w, h, k = int(m[2]), int(m[3]), 3 if m[1] == b"P6" else 1
    if len(data) - m.end() < w * h * k or not w * h:
        return None
    flat = np.frombuffer(data, np.uint8, w * h * k, m.end()).astype(np.float32) * (255 / int(m[4]))
    return flat.reshape(h, w) if k == 1 else flat.reshape(h, w, 3) @ np.array([0.299, 0.587, 0.114], np.float32)


def _box(x: np.ndarray, r: int) -> np.ndarray:
    """Sums over squares of 2r + 1; the borders repeat."""
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (r + 1, r)
        c = np.cumsum(np.pad(x, pad, mode="edge"), axis=axis, dtype=np.float64)
        n = x.shape[axis]
        x = np.take(c, np.arange(2 * r + 1, 2 * r + 1 + n), axis) - np.take(c, np.arange(n), axis)
    return x.astype(np.float32)


def _resize(x: np.ndarray, scale: float) -> np.ndarray:
    """Bilinear, after a blur that fits the scale."""
    if scale == 1:
        return x
    x = _box(x, 1) / 9
    out = x
    for axis in (1, 2):
        n = max(1, int(round(x.shape[axis] * scale)))
        at = np.clip((np.arange(n) + 0.5) / scale - 0.5, 0, x.shape[axis] - 1)
        lo = np.floor(at).astype(int)
        hi = np.minimum(lo + 1, x.shape[axis] - 1)
        f = (at - lo).astype(np.float32).reshape([-1 if i == axis else 1 for i in range(3)])
        out = np.take(out, lo, axis) * (1 - f) + np.take(out, hi, axis) * f
    return out


def corners(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, row, column) of the places of each image that are the strongest within APART pixels, away from the border."""
    n, h, w = x.shape
    edge = PATCH + 1
    if h <= 2 * edge or w <= 2 * edge:
        return (np.zeros(0, int),) * 3
    s = _box(x, 1)
    gy, gx = np.zeros_like(s), np.zeros_like(s)
    gy[:, 1:-1], gx[:, :, 1:-1] = s[:, 2:] - s[:, :-2], s[:, :, 2:] - s[:, :, :-2]
    a, b, c = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
    strength = a * b - c * c - 0.05 * (a + b) ** 2
    top = strength
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (APART, APART)
        p = np.pad(top, pad, constant_values=-np.inf)
        size = top.shape[axis]
        top = np.maximum.reduce([np.take(p, np.arange(i, i + size), axis) for i in range(2 * APART + 1)])
    inner = np.zeros((h, w), bool)
    inner[edge:-edge, edge:-edge] = True
    return np.nonzero((strength == top) & (strength > 1) & inner)


def _values(x: np.ndarray, image: np.ndarray, row: np.ndarray, col: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of patches (radians), and the softened values at points of them that turn with the patch."""
    soft = _box(x, SOFT)
    patch = soft[image[:, None, None], row[:, None, None] + _GRID[0], col[:, None, None] + _GRID[1]] * _DISC
    angle = np.arctan2((patch * _GRID[0]).sum((1, 2)), (patch * _GRID[1]).sum((1, 2)))
    cos, sin = np.cos(angle)[:, None], np.sin(angle)[:, None]
    dy, dx = points[None, :, 0], points[None, :, 1]
    y, z = row[:, None] + sin * dx + cos * dy, col[:, None] + cos * dx - sin * dy
    lo, left = np.floor(y).astype(int), np.floor(z).astype(int)
    a, b = (y - lo).astype(np.float32), (z - left).astype(np.float32)
    flat, width = soft.reshape(-1), soft.shape[2]
    at = (image[:, None] * soft.shape[1] + lo) * width + left
    # Where a turned point falls on the very last line, its neighbour weighs nothing.
    down, right = np.where(a > 0, width, 0), (b > 0).astype(int)
    upper, lower = flat[at] * (1 - b) + flat[at + right] * b, flat[at + down] * (1 - b) + flat[at + down + right] * b
    return angle, upper * (1 - a) + lower * a


def leaves(seed: int, size: int = 96) -> np.ndarray:
    """A picture of discs of grey that lie on each other, as objects do: what the points to compare are chosen on."""
    r = np.random.default_rng(seed)
    y, x = np.mgrid[:size, :size]
    out = np.zeros((size, size), np.float32)
    for _ in range(150):
        cy, cx, radius = r.uniform(0, size), r.uniform(0, size), 2 / r.uniform(0.05, 1)
        out[(y - cy) ** 2 + (x - cx) ** 2 < radius**2] = r.uniform(0, 255)
    return out


@functools.cache
def comparisons(count: int = BITS, most_alike: float = 0.25) -> np.ndarray:
    """The pairs of points to compare: (count, 2, 2).

    An upright patch is brighter on one side, so most comparisons nearly always
    come out alike. Of many random ones those are taken, the most even first, that
    split patches of sample pictures evenly and hardly correlate with those taken
    before; the bound on the correlation is raised until there are enough.
    """
    r = np.random.default_rng(128)
    points = np.round(r.uniform(-1, 1, (9000, 2)) * (PATCH - 1))
    points = points[(points**2).sum(1) <= (PATCH - 1) ** 2]
    points = points[: len(points) // 2 * 2]
    stack = np.stack([leaves(int(s)) for s in r.integers(0, 1 << 62, 50)])
    _, value = _values(stack, *corners(stack), points)
    bits = (value[:, 0::2] < value[:, 1::2]).astype(np.float32)
    z = (bits - bits.mean(0)) / (bits.std(0) + 1e-6)
    alike = np.abs(z.T @ z) / len(z)
    order = np.argsort(np.abs(bits.mean(0) - 0.5), kind="stable")
    order = order[: max(count, int((np.abs(bits.mean(0) - 0.5) < 0.15).sum()))].tolist()
    taken: list[int] = []
    while len(taken) < count:
        for i in order:
            if len(taken) < count and i not in taken and (not taken or alike[i, taken].max() < most_alike):
                taken.append(i)
        most_alike += 0.05
    return points.reshape(-1, 2, 2)[np.random.default_rng(5).permutation(taken)]


def describe(x: np.ndarray, image: np.ndarray, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Angles of patches turned upright, their bits (rows of BITS zeros and ones), and how sure each bit is."""
    angle, value = _values(x, image, row, col, comparisons().reshape(-1, 2))
    value = value.reshape(len(value), -1, 2)
    differ = value[:, :, 1] - value[:, :, 0]
    return angle, (differ > 0).astype(np.uint8), np.abs(differ)


def asked_keys(bits: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Keys under which a query's descriptors look: of each table their own, and those with unsure bits turned."""
    out = []
    for t in range(PARTS):
        part = bits[:, t * KEY_BITS : (t + 1) * KEY_BITS].astype(np.int64)
        key = part @ (np.int64(1) << np.arange(KEY_BITS)) | np.int64(t) << np.int64(KEY_BITS)
        turned = np.int64(1) << np.argsort(sure[:, t * KEY_BITS : (t + 1) * KEY_BITS], axis=1, kind="stable")[:, :TURNED]
        out += [key] + [key ^ turned[:, j] for j in range(TURNED)] + [key ^ turned[:, i] ^ turned[:, j] for i, j in itertools.combinations(range(PAIRED), 2)]
    return np.stack(out, 1)


def own_keys() -> Column:
    """The keys under which a descriptor (columns d0, d1, ...) stands in the tables."""
    keys = []
    for t in range(PARTS):
        word, at = divmod(t * KEY_BITS, 64)
        key = F.shiftrightunsigned(F.col(_WORDS[word]), at)
        if at + KEY_BITS > 64:
            key = key.bitwiseOR(F.shiftleft(F.col(_WORDS[word + 1]), 64 - at))
        keys.append(key.bitwiseAND(F.lit((1 << KEY_BITS) - 1)).bitwiseOR(F.lit(t << KEY_BITS)))
    return F.array(*keys)


_WORDS = [f"d{i}" for i in range(BITS // 64)]
#: Of each corner: place in the image in pixels, descriptor, and the keys of a query.
FEATURES = f"array<struct<x:float,y:float,{','.join(f'{d}:long' for d in _WORDS)},keys:array<long>>>"
_POINT = pa.struct([("x", pa.float32()), ("y", pa.float32()), *((d, pa.int64()) for d in _WORDS), ("keys", pa.list_(pa.int64()))])


def features_of(images: list[np.ndarray | None], asked: bool = False) -> list[list[dict]]:
    """Described corners of each image; none of what is no image, or too small. asked: with the keys of a query."""
    out: list[list[dict]] = [[] for _ in images]
    shapes = defaultdict(list)
    for i, im in enumerate(images):
        if im is not None:
            shapes[im.shape].append(i)
    for shape, ids in shapes.items():
        at_once = max(1, min(IMAGES_AT_ONCE, PIXELS_AT_ONCE // (shape[0] * shape[1])))
        for lo in range(0, len(ids), at_once):
            part = ids[lo : lo + at_once]
            stack = np.stack([images[i] for i in part])
            for scale in ASKED_SCALES if asked else SCALES:
                x = _resize(stack, scale)
                im, row, col = corners(x)
                for c in range(0, len(im), CORNERS_AT_ONCE):
                    i, r, k = (v[c : c + CORNERS_AT_ONCE] for v in (im, row, col))
                    _, bits, sure = describe(x, i, r, k)
                    words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
                    keys = asked_keys(bits, sure).tolist() if asked else [None] * len(i)
                    for j, y, z, d, own in zip(i.tolist(), r.tolist(), k.tolist(), words.tolist(), keys, strict=True):
                        out[part[j]].append({"x": (z + 0.5) / scale, "y": (y + 0.5) / scale, "keys": own} | dict(zip(_WORDS, d, strict=True)))
    return out


def features(df: DataFrame, key: str, image: str, asked: bool = False) -> DataFrame:
    """(key, features) for each row of a binary image column."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(features_of([decode(x) for x in part.column(1).to_pylist()], asked), pa.list_(_POINT))], ["key", "features"])

    return df.select(key, image).mapInArrow(work, f"key {df.schema[key].dataType.simpleString()}, features {FEATURES}").withColumnRenamed("key", key)


def consensus(pairs: np.ndarray) -> tuple[int, float, float, float, float] | None:
    """(distinct places that agree, scale, turn in degrees, shift x and y) of the best placing of a query in an image.

    pairs: rows (x, y in the query, x, y in the image). A placing turns, scales and
    shifts; each pair of matches gives one, those that most matches follow within
    OFF pixels win, the first of equals. Corners within about 2 OFF of each other,
    as of one place at several scales, count as one place.
    """
    pairs = pairs[np.lexsort(pairs.T[::-1])]
    q, p = pairs[:, 0] + 1j * pairs[:, 1], pairs[:, 2] + 1j * pairs[:, 3]
    place = np.unique(np.round(pairs[:, :2] / (2 * OFF)), axis=0, return_inverse=True)[1].ravel()
    i, j = np.triu_indices(len(pairs), 1) if len(pairs) ** 2 <= 2 * TRIED else np.random.default_rng(1).integers(0, len(pairs), (2, TRIED))
    far = np.abs(q[i] - q[j]) > 4 * OFF
    i, j = i[far], j[far]
    turn = (p[i] - p[j]) / (q[i] - q[j])
    ok = (np.abs(turn) > 0.2) & (np.abs(turn) < 5)
    i, turn = i[ok], turn[ok]
    best = None
    for lo in range(0, len(i), 64):
        t = turn[lo : lo + 64, None]
        shift = p[i[lo : lo + 64], None] - t * q[i[lo : lo + 64], None]
        fits = np.abs(t * q[None] + shift - p[None]) <= OFF * np.maximum(1, np.abs(t))
        for k in np.flatnonzero(fits.sum(1) > (best[0] if best else INLIERS - 1)):
            n = len(np.unique(place[fits[k]]))
            if n > (best[0] if best else INLIERS - 1):
                best = n, complex(t[k, 0]), complex(shift[k, 0])
    return best and (best[0], abs(best[1]), math.degrees(cmath.phase(best[1])), best[2].real, best[2].imag)


def find_copies(queries: DataFrame, images: DataFrame, key: str, image: str = "image") -> DataFrame:
    """(query_id, match_id, copies, inliers, scale, rotation, shift_x, shift_y): images that hold a part of a query.

    Equal images are one class, named by its smallest key (match_id) and counted
    in copies; only one of them is indexed, so a group of exact copies adds one
    image to the search. A class without a key has a null id. What isn't an image
    finds nothing and isn't found. Repeated query rows, and queries with the same
    key, count as one query; null keys of queries are left out. Other columns are
    left out. A pair of images is judged in one task, from its matches alone.
    """
    told = images.select(F.struct(images[key].alias("id"), F.xxhash64(images[image]).alias("h"), F.sha2(images[image], 256).alias("sha")).alias("k"), images[image].alias("image")).where("image is not null")
    # Of equal images the features are equal: the aggregate keeps one of them.
    indexed = features(told, "k", "image").groupBy("k.h", "k.sha").agg(F.min("k.id").alias("match_id"), F.count("*").alias("copies"), F.first("features").alias("features"))
    indexed = tables.cut(indexed.select(F.xxhash64("h", "sha").alias("image"), "match_id", "copies", "features"))
    tables.settle(images.sparkSession)
    asked = features(queries.where(queries[key].isNotNull()).select(F.col(key).alias("query_id"), image), "query_id", image, True)

    def by_key(df: DataFrame, keys: Column, *names: str) -> DataFrame:
        one = df.select(*names, F.posexplode("features").alias("n", "f")).select(*names, "n", "f.*")
        return one.select(*names, "n", "x", "y", *_WORDS, F.explode(keys).alias("k"))

    q = by_key(asked, F.col("keys"), "query_id").withColumnsRenamed({c: f"q{c}" for c in ("n", "x", "y", *_WORDS)})
    # Images are told by their hash; their ids follow only to what matches.
    found = q.join(by_key(indexed.select("image", "features"), own_keys(), "image"), "k")
    distance = functools.reduce(lambda a, b: a + b, (F.bit_count(F.col(f"q{d}").bitwiseXOR(F.col(d))) for d in _WORDS))
    # A match that several tables find counts once.
    votes = found.where(distance <= RADIUS).groupBy("query_id", "image", "qn", "n").agg(*(F.first(c).alias(c) for c in ("qx", "qy", "x", "y")))
    gathered = votes.groupBy("query_id", "image").agg(F.collect_list(F.array(*(F.col(c).cast("double") for c in ("qx", "qy", "x", "y")))).alias("m"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [consensus(np.array(m)) for m in batch.column(2).to_pylist()]
            kept = [i for i, b in enumerate(best) if b]
            columns = list(zip(*(best[i] for i in kept), strict=True)) or [()] * 5
            kinds = [pa.int64()] + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(kept, pa.int64())) for i in range(2)), *map(pa.array, columns, kinds)], ["query_id", "image", "inliers", "scale", "rotation", "shift_x", "shift_y"])

    kind = queries.schema[key].dataType.simpleString()
    agreed = gathered.where(F.size("m") >= INLIERS).mapInArrow(judge, f"query_id {kind}, image long, inliers long, scale double, rotation double, shift_x double, shift_y double")
    return agreed.join(indexed.drop("features"), "image").select("query_id", "match_id", "copies", "inliers", "scale", "rotation", "shift_x", "shift_y")


SIZE, CROP = 96, 72


def picture(seed: int) -> np.ndarray:
    """A cloudy picture that depends on the seed alone."""
    r = np.random.default_rng(seed)
    out = np.zeros((1, SIZE, SIZE), np.float32)
    for cells, weight in ((8, 1.0), (16, 0.8), (32, 0.7), (48, 0.7)):
        grid = r.random((1, cells, cells), np.float32)
        at = np.clip((np.arange(SIZE) + 0.5) * cells / SIZE - 0.5, 0, cells - 1)
        lo = np.floor(at).astype(int)
        hi, f = np.minimum(lo + 1, cells - 1), (at - lo).astype(np.float32)
        rows = grid[:, lo] * (1 - f)[None, :, None] + grid[:, hi] * f[None, :, None]
        out += weight * (rows[:, :, lo] * (1 - f) + rows[:, :, hi] * f)
    out = (out[0] - out.min()) / (np.ptp(out) + 1e-6)
    return np.round(out * 255).astype(np.uint8)


def retouched(image: np.ndarray, seed: int) -> np.ndarray:
    """A crop of an image, turned by right angles, darker, with less contrast and noise."""
    r = np.random.default_rng(seed ^ 0x5DEECE66D)
    y, x = r.integers(0, SIZE - CROP + 1, 2)
    part = np.rot90(image[y : y + CROP, x : x + CROP], int(r.integers(4))).astype(np.float32)
    return np.clip(part * 0.85 + 8 + r.normal(0, 2, part.shape), 0, 255).astype(np.uint8)


def pictures(df: DataFrame, edited: bool, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, image): a picture drawn from each vector, or its retouched copy. A null vector has no image; keys may be null."""
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                made = []
                for own, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seed = None if v is None else xxhash.xxh64_intdigest(np.array(v, np.float32).tobytes()) >> 1
                    image = None if seed is None else picture(seed)
                    made.append(None if image is None else encode(retouched(image, seed + xxhash.xxh32_intdigest(str(own))) if edited else image))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], ["key", "image"])
        tables.release()

    return df.select(key, vector).mapInArrow(work, f"key {kind}, image binary").withColumnRenamed("key", key)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies found for retouched crops of every twentieth picture among the pictures of all vectors.

    The tables hold no images; each vector of ``embeddings`` is drawn as one. A null
    vector is no picture: it finds nothing and isn't found.
    """
    rows = tables.read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return find_copies(pictures(rows.where("vec_id % 20 = 0"), True), pictures(rows, False), "vec_id")
