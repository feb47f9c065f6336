"""Boosted trees by the rules of Spark's GBTClassifier (log loss, variance, mean of a leaf), all of them in one job.

Spark begins a job for each level of each tree, 1500 for 300 rounds of depth 5. Here
the tasks of one barrier stage keep their rows as bins; for each level they send sums
of bins up a tree of tasks, and the first task answers with the splits. Gradients are
whole multiples of GRAIN, so sums are exact and no result depends on how the rows are
dealt out. No row is left out, and no task gets the rows of another.
"""

from __future__ import annotations

import base64
import io
import json
import math
import secrets
import socket
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame

BINS = 32
#: Sums of gradients stay exact up to 5e8 rows.
GRAIN = 2.0**-22
#: Features are counted together as long as their bins have no more combinations.
GROUP = 1024
#: Rows that are scored at once.
CHUNK = 1 << 15
#: Rows that are counted or dealt out at once.
SLICE = 1 << 16
#: Seconds that a task waits for another.
PATIENCE = 600


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: a row goes left where its feature is at most the threshold; leaf has the summands of the margin."""

    columns: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def text(self) -> str:
        out = io.BytesIO()
        np.savez_compressed(out, feature=self.feature, threshold=self.threshold, leaf=self.leaf)
        return json.dumps({"columns": self.columns, "arrays": base64.b64encode(out.getvalue()).decode()})

    @staticmethod
    def of(text: str) -> Trees:
        told = json.loads(text)
        with np.load(io.BytesIO(base64.b64decode(told["arrays"]))) as z:
            return Trees(tuple(told["columns"]), z["feature"], z["threshold"], z["leaf"])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of class 1; x: a row for each feature."""
        out = np.empty(x.shape[1])
        for lo in range(0, len(out), CHUNK):
            part = np.ascontiguousarray(x[:, lo : lo + CHUNK])
            margin = np.zeros(part.shape[1])
            for tree in zip(self.feature, self.threshold, self.leaf, strict=True):
                margin += _values(part, *tree)
            out[lo : lo + CHUNK] = 1 / (1 + np.exp(-2 * margin))
        return out


def _values(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(x.shape[1], np.uint8 if len(leaf) <= 256 else np.int64)
    nodes = 1
    while nodes < len(leaf):
        right = np.zeros(len(at), bool)
        for v in range(nodes):
            f, cut = feature[nodes - 1 + v], threshold[nodes - 1 + v]
            if cut != np.inf:
                right |= (at == v) & (x[f] > cut)
        at *= 2
        at += right
        nodes *= 2
    return np.take(leaf, at)


def _matrix(batch: pa.RecordBatch, columns: tuple[str, ...]) -> np.ndarray:
    """A row for each feature, in single precision; nulls and NaN are errors."""
    x = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.float32) for c in columns])
    if np.isnan(x).any():
        raise ValueError("a feature is null or NaN")
    return x + np.float32(0)  # no negative zero


def score(df: DataFrame, models: list[Trees], outs: list[str]) -> DataFrame:
    """Adds the probability of class 1 by each model."""
    fields = pa.schema([(out, pa.float64()) for out in outs])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = {columns: _matrix(b, columns) for columns in {m.columns for m in models}}
            found = [pa.array(m.probabilities(x[m.columns]), pa.float64()) for m in models]
            yield pa.RecordBatch.from_arrays([*b.columns, *found], schema=pa.schema([*b.schema, *fields]))

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{out}` double" for out in outs)])
    return df.mapInArrow(scored, kinds)


class _Links:
    """The tasks of a stage as a binary tree: sums go up to the first task, its answers go down."""

    def __init__(self, told: BarrierTaskContext):
        rank, token = told.partitionId(), secrets.token_hex(16)
        here = told.getTaskInfos()[rank].address.rsplit(":", 1)[0]
        with socket.create_server(("", 0)) as server:
            server.settimeout(PATIENCE)
            places = [json.loads(x) for x in told.allGather(json.dumps([here, server.getsockname()[1], token]))]
            self.up = None
            if rank:
                host, port, secret = places[(rank - 1) // 2]
                self.up = self.ready(socket.create_connection((host, port), PATIENCE))
                self.up.sendall(secret.encode() + struct.pack("<q", rank))
            below = {}
            wanted = {k for k in (2 * rank + 1, 2 * rank + 2) if k < len(places)}
            while wanted - set(below):
                s = self.ready(server.accept()[0])
                said = bytes(self.read(s, len(token) + 8))
                if not secrets.compare_digest(said[:-8], token.encode()):
                    s.close()
                    continue
                below[struct.unpack("<q", said[-8:])[0]] = s
        self.first, self.down = not rank, [below[k] for k in sorted(below)]

    @staticmethod
    def ready(s: socket.socket) -> socket.socket:
        s.settimeout(PATIENCE)
        s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
        return s

    @staticmethod
    def read(s: socket.socket, n: int) -> bytearray:
        out = bytearray(n)
        view = memoryview(out)
        while n:
            got = s.recv_into(view, n)
            if not got:
                raise ConnectionError("another task of the stage ended")
            view, n = view[got:], n - got
        return out

    def total(self, x: np.ndarray) -> np.ndarray:
        """The sum of all tasks' arrays, in the first task."""
        x = np.ascontiguousarray(x, np.float64)
        for s in self.down:
            x = x + np.frombuffer(self.read(s, x.nbytes)).reshape(x.shape)
        if self.up:
            self.up.sendall(x.tobytes())
        return x

    def tell(self, x: np.ndarray | None) -> np.ndarray:
        """The first task's array, a table of doubles, in all of them."""
        if self.up:
            n, width = struct.unpack("<qq", self.read(self.up, 16))
            data = bytes(self.read(self.up, 8 * n * width))
        else:
            (n, width), data = x.shape, np.ascontiguousarray(x, np.float64).tobytes()
        for s in self.down:
            s.sendall(struct.pack("<qq", n, width) + data)
        return np.frombuffer(data).reshape(n, width)

    def close(self) -> None:
        for s in [*self.down, *([self.up] if self.up else [])]:
            s.close()


def _keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of single precision floats."""
    k = np.ascontiguousarray(x, np.float32).view(np.int32)
    return np.where(k < 0, k ^ 0x7FFFFFFF, k)


def _floats(k: np.ndarray) -> np.ndarray:
    k = np.asarray(k, np.int64).astype(np.int32)
    return np.where(k < 0, k ^ 0x7FFFFFFF, k).astype(np.int32).view(np.float32)


def _edges(links: _Links, x: np.ndarray) -> list[np.ndarray]:
    """Of each feature the keys that end its bins, without the last: the bin with most rows is halved while there are fewer than BINS, so that a frequent value stands alone and what is beside it has bins too."""
    order = np.sort(_keys(x), axis=1)
    n = len(order)

    def below(keys: np.ndarray | None) -> np.ndarray:
        """How many rows have at most such a key; an empty table from the first task ends it."""
        asked = links.tell(keys)
        return links.total(np.array([[np.searchsorted(o, q, "right") for q in row] for o, row in zip(order, asked.astype(np.int64).astype(np.int32), strict=False)]).reshape(asked.shape)) if len(asked) else asked

    if not links.first:
        while below(None).size:
            pass
    else:
        low, high = -(1 << 31), (1 << 31) - 1
        rows = int(below(np.full((n, 1), high))[0, 0])
        bins = [[(low, high, 0, rows)] for _ in range(n)]  # a bin: keys above the first up to the second, rows up to either
        whole = [[] for _ in range(n)]
        for _ in range(BINS * 2):
            chosen = {f: max(b, key=lambda v: v[3] - v[2]) for f, b in enumerate(bins) if b and len(b) + len(whole[f]) < BINS}
            if not chosen:
                break
            lo, hi, goal = np.zeros(n), np.zeros(n), np.zeros(n)
            for f, (a, b, ca, cb) in chosen.items():
                lo[f], hi[f], goal[f] = a, b, ca + (cb - ca + 1) // 2
            while (lo < hi).any():
                mid = np.floor((lo + hi) / 2)
                enough = below(mid[:, None])[:, 0] >= goal
                lo, hi = np.where(enough | (lo >= hi), lo, mid + 1), np.where(enough, np.minimum(hi, mid), hi)
            counts = below(np.stack([np.maximum(lo - 1, low), lo], 1))
            for f, v in chosen.items():
                a, b, ca, cb = v
                bins[f].remove(v)
                before, upto = map(int, counts[f])
                if upto < cb:
                    cut, k = int(lo[f]), upto
                elif before > ca:
                    cut, k = int(lo[f]) - 1, before
                else:
                    whole[f].append(v)
                    continue
                bins[f] += [(a, cut, ca, k), (cut, b, k, cb)]
        found = [sorted(v[1] for v in b + w)[:-1] for b, w in zip(bins, whole, strict=True)]
        below(np.zeros((0, 0)))
    told = links.tell(np.array([e + [np.inf] * (BINS - len(e)) for e in found]) if links.first else None)
    return [row[np.isfinite(row)].astype(np.int64) for row in told]


class _Sums:
    """Counts and sums of gradients in the bins of all features, for some rows in some places."""

    def __init__(self, bins: np.ndarray, sizes: list[int]):
        self.groups, self.features = [], len(sizes)
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            fits = next((g for g in self.groups if math.prod(sizes[k] for k in g) * sizes[f] <= GROUP), None)
            fits.append(f) if fits else self.groups.append([f])
        self.shapes = [tuple(sizes[f] for f in g) for g in self.groups]
        self.codes = []
        for g in self.groups:
            code = np.zeros(bins.shape[1], np.int16)
            for f in g:
                code = code * np.int16(sizes[f]) + bins[f]
            self.codes.append(code.astype(np.int16))

    def __call__(self, rows: np.ndarray | None, place: np.ndarray | None, places: int, weights: np.ndarray) -> np.ndarray:
        """(count or sum, place, feature, bin) of some rows; of all rows, whose count doesn't change, only the sum."""
        n = len(weights)
        out = np.zeros((2, places, self.features, BINS))
        for group, shape, code in zip(self.groups, self.shapes, self.codes, strict=True):
            size = math.prod(shape)
            found = np.zeros((2, places * size))
            for lo in range(0, n, SLICE):
                part = slice(lo, lo + SLICE)
                at = code[part] if rows is None else place[part] * size + code[rows[part]]
                if rows is not None:
                    found[0] += np.bincount(at, None, places * size)
                found[1] += np.bincount(at, weights[part], places * size)
            found = found.reshape(2, places, *shape)
            for i, f in enumerate(group):
                out[:, :, f, : shape[i]] = found.sum(axis=tuple(k + 2 for k in range(len(shape)) if k != i))
        return out


def _best(count: np.ndarray, total: np.ndarray, least: int, allowed: np.ndarray) -> np.ndarray:
    """Of each node feature and bin of the split with most gain (or -1), and count and sum of both sides; without a split the left side has all."""
    n, s = count.cumsum(2), total.cumsum(2)
    # All features have the same rows.
    all_n, all_s = n[:, :1, -1:], s[:, :1, -1:]
    right_n, right_s = all_n - n, all_s - s
    ok = (n >= max(least, 1)) & (right_n >= max(least, 1)) & allowed[:, :, None]
    gain = np.where(ok, s**2 / np.maximum(n, 1) + right_s**2 / np.maximum(right_n, 1) - all_s**2 / np.maximum(all_n, 1), 0.0)
    flat = gain.reshape(len(gain), -1)
    k = flat.argmax(1)
    i = np.arange(len(gain))
    f, b = np.divmod(k, BINS)
    some = flat[i, k] > 0
    pick = lambda x, other: np.where(some, x[i, f, b], other)
    return np.stack([np.where(some, f, -1), np.where(some, b, -1), pick(n, all_n[:, 0, 0]), pick(s, all_s[:, 0, 0]), pick(right_n, 0), pick(right_s, 0)], 1)


def _fitted(links: _Links, x: np.ndarray, y: np.ndarray, s) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Features, thresholds and leaves of all trees, the same in each task; None if a class is missing."""
    classes = links.tell(links.total(np.array([[(y == 0).sum(), (y == 1).sum()]])))[0]
    if not classes.all():
        return None
    edges = _edges(links, x)
    sizes = [len(e) + 1 for e in edges]
    keys = _keys(x)
    bins = np.stack([np.searchsorted(e, k, "left").astype(np.uint8) for e, k in zip(edges, keys, strict=True)])
    del keys
    sums, n_features, inner = _Sums(bins, sizes), len(sizes), 2**s.depth - 1
    keep = max(1, math.ceil(float(s.columns) * n_features)) if s.columns != "all" else n_features
    sign = np.where(y == 1, 1.0, -1.0)
    margin, wanted = np.zeros(len(y)), np.rint(sign / GRAIN)
    feature, cut, leaf = np.zeros((s.rounds, inner), np.int32), np.full((s.rounds, inner), np.inf, np.float32), np.zeros((s.rounds, inner + 1))
    every = links.total(sums(None, None, 1, np.ones(len(y)))[1])
    for t in range(s.rounds):
        if t:
            np.multiply(margin, 2 * sign, out=wanted)
            np.exp(wanted, out=wanted)
            wanted += 1
            np.divide(sign, wanted, out=wanted)
            wanted *= 4 / GRAIN
            np.rint(wanted, out=wanted)
        count, total = every, links.total(sums(None, None, 1, wanted)[1])
        at = np.zeros(len(y), np.uint8 if s.depth < 8 else np.int32)
        open_ = np.ones(1, bool)  # nodes that may be split
        for level in range(s.depth):
            nodes = 2**level
            if links.first:
                rng = np.random.default_rng([s.seed, t, level])
                allowed = rng.permuted(np.tile(np.arange(n_features) < keep, (nodes, 1)), axis=1)
                split = _best(count, total, s.least_rows, allowed & open_[:, None])
                open_ = np.repeat(split[:, 0] >= 0, 2)
            split = links.tell(split if links.first else None)
            cuts = [(v, int(split[v, 0]), int(split[v, 1])) for v in range(nodes) if split[v, 0] >= 0]
            for v, f, b in cuts:
                feature[t, nodes - 1 + v], cut[t, nodes - 1 + v] = f, _floats(edges[f][b : b + 1])[0]
            for lo in range(0, len(y), SLICE):
                part = slice(lo, lo + SLICE)
                here = at[part]
                right = np.zeros(len(here), bool)
                for v, f, b in cuts:
                    right |= (here == v) & (bins[f, part] > b)
                here *= 2
                here += right
            if level + 1 == s.depth:
                break
            # Of two sides only that with fewer rows is counted; the other is what is left.
            less = np.where(split[:, 2] <= split[:, 4], 0, 1)
            parents = np.flatnonzero(split[:, 0] >= 0)
            place = np.full(2 * nodes, -1)
            place[2 * parents + less[parents]] = np.arange(len(parents))
            rows = np.flatnonzero(np.take(place >= 0, at))
            where = place[at[rows]]
            fewer = links.total(sums(rows, where, len(parents), wanted[rows]))
            if links.first:
                both = np.zeros((2, 2 * nodes, n_features, BINS))
                both[:, 0::2] = np.stack([count, total])
                small = 2 * parents + less[parents]
                rest = both[:, 2 * parents] - fewer
                both[:, small], both[:, small ^ 1] = fewer, rest
                count, total = both
        ends = np.stack([split[:, 3] / np.maximum(split[:, 2], 1), split[:, 5] / np.maximum(split[:, 4], 1)], 1).reshape(-1)
        leaf[t] = ends * GRAIN * (1.0 if t == 0 else s.rate)
        for lo in range(0, len(y), SLICE):
            margin[lo : lo + SLICE] += np.take(leaf[t], at[lo : lo + SLICE])
    return feature, cut, leaf


def _slots(df: DataFrame) -> int:
    """How many tasks can run at once, all of which a barrier stage needs."""
    jvm = df.sparkSession.sparkContext._jsc.sc()
    return max(1, jvm.maxNumConcurrentTasks(jvm.resourceProfileManager().defaultResourceProfile()))


def train(df: DataFrame, columns: tuple[str, ...], s) -> Trees:
    """Boosted trees on rows with y; both classes must be there. s: model.Settings."""
    n_features = len(columns)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y = b.column(b.schema.get_field_index("y")).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_pydict({"x": pa.array([_matrix(b, columns).tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [np.zeros((n_features, 0), np.float32)], [np.zeros(0, np.uint8)]
        for b in batches:
            for x, y in zip(b.column(0), b.column(1), strict=True):
                xs.append(np.frombuffer(x.as_py(), np.float32).reshape(n_features, -1))
                ys.append(np.frombuffer(y.as_py(), np.uint8))
        x, y = np.concatenate(xs, 1), np.concatenate(ys)
        del xs, ys
        links = _Links(BarrierTaskContext.get())
        try:
            found = _fitted(links, x, y, s)
        finally:
            links.close()
        if links.first:
            yield pa.RecordBatch.from_pydict({"model": pa.array([Trees(columns, *found).text() if found else ""], pa.string())})

    rows = df.select("y", *columns).mapInArrow(packed, "x binary, y binary").repartition(_slots(df))
    text = rows.mapInArrow(fitted, "model string", barrier=True).collect()[0][0]
    if not text:
        raise ValueError("training needs both classes")
    return Trees.of(text)
