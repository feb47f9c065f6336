"""Secret scans: base rules, and a character convolutional network over every candidate and its surroundings.

The network is trained here, with numpy, on labelled findings: strings made by
rules from a fixed seed, each with its surroundings and whether it is a secret.
A part of them is kept for calibration: it fits the slope and offset that turn
the network's output into a probability, and the threshold is the highest one at
which the wanted share of its secrets is found.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import bytesops as B
from kinweave.llm import tables

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

_HEX = np.zeros(256, bool)
_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
_KEYISH = np.zeros(256, bool)
_KEYISH[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_.=-"]] = True
#: A candidate of the method is a run of key characters at least so long; shorter secrets are left to the base rules.
CANDIDATE_CHARS = 16

#: Characters that the network sees: before a candidate, of it, and after it.
BEFORE, INSIDE, AFTER = 24, 48, 16
WIDTH = BEFORE + INSIDE + AFTER
KERNEL, FILTERS = 5, 24
#: The share of secrets that the threshold must keep on the calibration part.
RECALL = 0.98
SEED = 20240613

# Groups of characters: blank, space, lower vowels and consonants, hexadecimal letters, upper, digits, signs.
_GROUPS = np.full(256, 1, np.int64)
for _i, _set in enumerate(["\0", " \t\r\n", "ae", "bcdf", "iou", "ghjklmnpqrstvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/", "=", ":", "_", "-", ".", "\"'", ",;", "@", "()[]{}<>", "#$%&*!?\\|~^`"]):
    for _c in _set:
        _GROUPS[ord(_c)] = _i
_GROUPS[128:] = 20
N_GROUPS = 21


def view(data: bytes, start: int, end: int) -> np.ndarray:
    """Character groups around data[start:end]; of a long candidate its first and last half window."""
    cand = data[start:end]
    if len(cand) > INSIDE:
        cand = cand[: INSIDE // 2] + cand[-(INSIDE // 2) :]
    before = data[max(0, start - BEFORE) : start].rjust(BEFORE, b"\0")
    return _GROUPS[np.frombuffer(before + cand.ljust(INSIDE, b"\0") + data[end : end + AFTER].ljust(AFTER, b"\0"), np.uint8)]


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a candidate that the network sees one by one; any INSIDE / 2 characters in a row are whole in one."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(s, s + INSIDE) for s in [*range(start, end - INSIDE, INSIDE // 2), end - INSIDE]]


class Network:
    """Convolution over character groups, the largest value of each filter before, inside and after, and one hidden layer."""

    def __init__(self, seed: int):
        r = np.random.default_rng(seed)
        self.p = {
            "conv": r.normal(0, 0.3, (KERNEL * N_GROUPS, FILTERS)),
            "conv_b": np.zeros(FILTERS),
            "hid": r.normal(0, 0.15, (6 * FILTERS, 24)),
            "hid_b": np.zeros(24),
            "out": r.normal(0, 0.2, (24, 1)),
            "out_b": np.zeros(1),
        }
        self.slope, self.offset, self.threshold = 1.0, 0.0, 0.5

    def forward(self, x: np.ndarray):
        half = KERNEL // 2
        wide = np.pad(x, ((0, 0), (half, half)))
        table = self.p["conv"].reshape(KERNEL, N_GROUPS, FILTERS)
        z = self.p["conv_b"] + sum(table[k][wide[:, k : k + x.shape[1]]] for k in range(KERNEL))
        act = np.maximum(z, 0)
        cuts = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, WIDTH))
        peaks = [act[:, a:b].argmax(1) + a for a, b in cuts]
        used = (x[:, BEFORE : BEFORE + INSIDE] > 0).sum(1)[:, None, None] if len(x) else np.ones((0, 1, 1))
        means = [act[:, a:b].sum(1) / (np.maximum(used[:, :, 0], 1) if a == BEFORE else b - a) for a, b in cuts]
        feats = np.concatenate([np.take_along_axis(act, p[:, None], 1)[:, 0] for p in peaks] + means, 1)
        h = np.maximum(feats @ self.p["hid"] + self.p["hid_b"], 0)
        return (h @ self.p["out"] + self.p["out_b"])[:, 0], (wide, act, peaks, used, feats, h, cuts)

    def step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss."""
        out, (wide, act, peaks, used, feats, h, cuts) = self.forward(x)
        d = ((1 / (1 + np.exp(-out))) - y)[:, None] / len(y)
        g = {"out": h.T @ d, "out_b": d.sum(0)}
        dh = (d @ self.p["out"].T) * (h > 0)
        g |= {"hid": feats.T @ dh, "hid_b": dh.sum(0)}
        df = dh @ self.p["hid"].T
        dz = np.zeros_like(act)
        rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None]
        for i, p in enumerate(peaks):
            dz[rows, p, cols] += df[:, i * FILTERS : (i + 1) * FILTERS]
        for i, (a, b) in enumerate(cuts):
            dz[:, a:b] += (df[:, (3 + i) * FILTERS : (4 + i) * FILTERS] / (np.maximum(used[:, :, 0], 1) if a == BEFORE else b - a))[:, None]
        dz *= act > 0
        flat, conv = dz.reshape(-1, FILTERS), np.zeros((KERNEL, N_GROUPS, FILTERS))
        for k in range(KERNEL):
            hot = np.eye(N_GROUPS)[wide[:, k : k + x.shape[1]].ravel()]
            conv[k] = hot.T @ flat
        return g | {"conv": conv.reshape(-1, FILTERS), "conv_b": flat.sum(0)}

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-(self.slope * self.forward(x)[0] + self.offset))) if len(x) else np.zeros(0)


def labelled_findings(n: int, seed: int) -> list[tuple[bytes, int, int, int]]:
    """(text, start, end, is a secret) made by rules, half of them secrets."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    chars = lambda abc, k: "".join(abc[i] for i in r.integers(0, len(abc), k))
    low, up, dig, hexa = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    syl = ["th", "an", "re", "ing", "sch", "tion", "os", "la", "en", "ou", "er", "qui", "ment", "ge", "ro", "st", "ve", "lo"]
    word = lambda: "".join(pick(syl) for _ in range(int(r.integers(1, 5))))
    prose = lambda k: " ".join(word() for _ in range(k))
    out = []
    for i in range(n):
        secret = i % 2 == 0
        size = int(r.integers(18, 52))
        before, after = prose(6) + " ", " " + prose(5)
        if secret:
            abc = pick([low + up + dig, low + dig, up + dig, hexa, low + up + dig + "+/", low + up + dig + "_-"])
            text = pick(["", "", "", "sk-", "ghp_", "xoxb-", "AKIA", "pk_live_"]) + chars(abc, size)
            before += pick(["", "", "", "key: ", "auth=", "Authorization: Bearer ", "secret_key = \"", "credential ", "pass: ", "client_id="])
        else:
            text = pick(
                [
                    lambda: "/".join(word() for _ in range(4)) + "/" + chars(dig, 4) + ".html",
                    lambda: f"{r.integers(1990, 2030)}-{r.integers(10, 13)}-{r.integers(10, 29)}T{r.integers(10, 24)}.{r.integers(10, 60)}.{r.integers(10, 60)}",
                    lambda: "-".join(word() for _ in range(4)) + "-" + chars(dig, 3),
                    lambda: word() + "." + word() + chars(dig, 3) + "." + word() + ".com",
                    lambda: chars(dig, size),
                    lambda: "_".join(word().upper() for _ in range(3)) + "_" + chars(dig, 3),
                    lambda: word() * 4 + chars(dig, 4),
                    lambda: "=" * 12 + chars(dig, 3) + "-" * 8,
                    lambda: f"{r.integers(1, 99)}.{r.integers(0, 99)}.{r.integers(0, 99)}-{word()}.{word()}",
                    lambda: "/".join(chars(dig, 3) for _ in range(5)),
                    lambda: word() * 5,
                    lambda: "-".join(word() for _ in range(5)),
                    lambda: "/".join(pick([word, lambda: word().title()])() for _ in range(6)),
                    lambda: "".join(word().title() for _ in range(5)) + chars(dig, int(r.integers(0, 3))),
                    lambda: "_".join(word().upper() for _ in range(4)),
                    lambda: ".".join(word() for _ in range(5)) + pick(["", "..."]),
                    lambda: pick("=-_./+") * size,
                    lambda: "+" + chars(dig, 3) + "-" + chars(dig, 3) + "-" + chars(dig, 8),
                ]
            )()
            text = text if len(text) >= CANDIDATE_CHARS else text + "-" + word() + chars(dig, 3) + word() * 2
        data = (before + text + after).encode()
        out.append((data, len(before.encode()), len(before.encode()) + len(text.encode()), int(secret)))
    return out


def long_findings(n: int, seed: int) -> list[tuple[bytes, int, int, int, int]]:
    """(text, start, end, start of the secret, end of it): runs longer than the network sees, every other with a secret in it (else 0, 0)."""
    r = np.random.default_rng(seed)
    found = labelled_findings(4 * n, seed + 1)
    # Secrets of at most half a window in one part of a longer path or query; the rest of it is made of ordinary words.
    keys = [d[s:e] for d, s, e, y in found if y and e - s <= INSIDE // 2]
    plain = re.findall(rb"[a-z]+", b" ".join(d[:s] for d, s, _, y in found if not y))
    out = []
    for i in range(n):
        part = lambda: b"/".join(plain[int(j)] for j in r.integers(0, len(plain), int(r.integers(4, 9))))
        a, b = part() + b"/" + part() + b"/", b"/" + part() + b"/" + part()
        key = keys[int(r.integers(len(keys)))] if i % 2 == 0 else b""
        before = b" ".join(plain[int(j)] for j in r.integers(0, len(plain), 5)) + b" "
        start = len(before)
        at = start + len(a)
        out.append((before + a + key + b + b" " + part().replace(b"/", b" "), start, at + len(key) + len(b), at if key else 0, at + len(key) if key else 0))
    return out


def seen(f: tuple) -> list[tuple[int, int, int, int]]:
    """(start, end, is a secret, whether to learn from it) of the windows of a finding; a secret cut by a window teaches nothing."""
    start, end = f[1:3]
    a, b = (start, end) if len(f) == 4 and f[3] else f[3:] if len(f) == 5 else (0, 0)
    out = []
    for s, e in windows(start, end):
        shared = min(e, b) - max(s, a)
        whole = shared >= min(b - a, CANDIDATE_CHARS)
        out.append((s, e, int(b > a and whole), int(b == a or shared <= 0 or whole)))
    return out


@functools.cache
def train(n: int = 2400, epochs: int = 6, seed: int = SEED) -> Network:
    """Fits the network on three quarters of the findings; the rest sets calibration and threshold.

    The threshold is set end to end: a finding goes through the candidates and
    windows of the scan, and one that makes no candidate counts as missed.
    """
    found = [*labelled_findings(n, seed), *long_findings(n // 4, seed)]
    r = np.random.default_rng(seed)
    order = r.permutation(len(found))
    learnt = [found[i] for i in order[: len(found) * 3 // 4]]
    kept = [found[i] for i in order[len(found) * 3 // 4 :]]
    parts = [(f[0], *w) for f in learnt for w in seen(f) if w[3]]
    x, y = np.stack([view(*w[:3]) for w in parts]), np.array([w[3] for w in parts], float)
    fit = np.arange(len(x))
    net = Network(seed)
    mean, var, t = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    for _ in range(epochs):
        r.shuffle(fit)
        for i in range(0, len(fit), 64):
            t += 1
            for k, g in net.step(x[fit[i : i + 64]], y[fit[i : i + 64]]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.999 * var[k] + 0.001 * g * g
                net.p[k] -= 0.01 * (mean[k] / (1 - 0.9**t)) / (np.sqrt(var[k] / (1 - 0.999**t)) + 1e-8)
    label = np.array([f[3] > 0 for f in kept], float)
    out = np.array([_best(net, f) for f in kept])
    a, b = 1.0, 0.0
    raw, told, out, label = out, label, out[np.isfinite(out)], label[np.isfinite(out)]
    for _ in range(200):  # logistic regression on the output
        p = 1 / (1 + np.exp(-(a * out + b)))
        a, b = a - 0.05 * ((p - label) * out).mean(), b - 0.05 * (p - label).mean()
    net.slope, net.offset = float(a), float(b)
    reached = 1 / (1 + np.exp(-(net.slope * raw[told == 1] + net.offset)))
    net.threshold = float(min(0.9, np.quantile(reached, 1 - RECALL, method="lower")))
    return net


def candidates(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(start, end) of the runs that the network judges."""
    starts, ends, _ = B.words(data, offsets, _KEYISH)
    may = ends - starts >= CANDIDATE_CHARS
    return np.stack([starts[may], ends[may]], 1)


def _best(net: Network, finding: tuple) -> float:
    """The largest output over the windows of the candidates that hold the finding; minus infinity without any."""
    data, start, end = finding[:3]
    runs = candidates(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    views = [view(data, *w) for s, e in runs.tolist() if s < end and start < e for w in windows(s, e)]
    return float(net.forward(np.stack(views))[0].max()) if views else -np.inf


def base_spans(data: bytes, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base rules, in code points; hex_runs are told already."""
    out, lower = [], data.lower()
    assign = any(k in lower for k in _KEYWORDS[:3]) or (b"api" in lower and (b"apikey" in lower or b"api_key" in lower))
    if assign or b"AKIA" in data:
        text = data.decode()
        if assign:
            out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return out + [(s, e, 2) for s, e in hex_runs]


def scan_batch(column: pa.Array, net: Network) -> list[list[tuple[int, int, int]]]:
    """All spans of each text of a column, in code points, by start and kind; takes time in proportion to the text."""
    out: list[list[tuple[int, int, int]]] = []
    for lo, hi, data, offsets in B.chunks(column):
        raw = data.tobytes()
        # How many code points begin before each byte.
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts, ends, _ = B.words(data, offsets, _HEX)
        long = ends - starts >= LEAST["hex"]
        hexes = np.stack([starts[long], ends[long]], 1)
        cands = candidates(data, offsets)
        hex_at, cand_at = np.searchsorted(hexes[:, 0], offsets), np.searchsorted(cands[:, 0], offsets)
        views, owner = [], []
        for i in range(hi - lo):
            a, b = int(offsets[i]), int(offsets[i + 1])
            doc = raw[a:b]
            out.append(base_spans(doc, (points[hexes[hex_at[i] : hex_at[i + 1]]] - points[a]).tolist()))
            for s, e in cands[cand_at[i] : cand_at[i + 1]].tolist():
                parts = windows(s - a, e - a)
                views += [view(doc, *w) for w in parts]
                owner.append((lo + i, int(points[s] - points[a]), int(points[e] - points[a]), len(views) - len(parts)))
        if views:
            p = np.concatenate([net.score(np.stack(views[k : k + 4096])) for k in range(0, len(views), 4096)])
            top = np.maximum.reduceat(p, [x[3] for x in owner])
            base: dict[int, list] = {}
            for k in np.flatnonzero(top >= net.threshold):
                i, s, e, _ = owner[k]
                # Base spans by start; they may overlap each other, so the largest end so far tells whether one reaches here.
                if i not in base:
                    told = sorted(out[i])
                    base[i] = [x[0] for x in told], list(itertools.accumulate((x[1] for x in told), max))
                before = bisect.bisect_left(base[i][0], e)
                if not before or base[i][1][before - 1] <= s:
                    out[i].append((s, e, 3))
    for spans in out:
        spans.sort(key=lambda x: (x[0], x[2], x[1]))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Finds secrets in each whole text: key, counts of the base kinds, digest of the base spans, all spans.

    A null text is empty: no spans, and the digest of no bytes. Repeated rows and
    null keys pass through; other columns are left out. One pass without a shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(train())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scan_batch(batch.column(1), shared.value)
            base = [[x for x in spans if x[2] < 3] for spans in found]
            counts = [pa.array([sum(x[2] == k for x in spans) for spans in base], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base], pa.string()), pa.array([joined(x) for x in found], pa.string())], ["key", *(x.split()[0] for x in SCHEMA.split(", "))])
        tables.release()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(work, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def redact(df: DataFrame, text: str = "text", mask: str = "[redacted]") -> DataFrame:
    """Replaces every secret in a text column by a mask; overlapping spans become one. Null stays null."""
    shared = df.sparkSession.sparkContext.broadcast(train())
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("string")
    def masked(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            done = []
            for value, spans in zip(column.to_pylist(), scan_batch(column, shared.value), strict=True):
                if spans:
                    at, parts = 0, []
                    for s, e, _ in spans:
                        if s >= at:
                            parts += [value[at:s], mask]
                        at = max(at, e)
                    value = "".join([*parts, value[at:]])
                done.append(value)
            yield pa.array(done, pa.string())
        tables.release()

    return df.withColumn(text, masked(df[text]))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document's whole text."""
    return secrets(tables.read(spark, sf_dir, "documents", "doc_id", "text"))
