"""String similarities by longest common subsequence, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; one addition on a bit row for each character of b."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; of two empty texts 1."""
    n = len(a) + len(b)
    if a == b:
        return 1.0
    # What both begin or end with is common anyway.
    head = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    x, y = a[head:], b[head:]
    tail = next((i for i, (c, d) in enumerate(zip(reversed(x), reversed(y), strict=False)) if c != d), min(len(x), len(y)))
    return 2 * (head + tail + lcs(x[: len(x) - tail], y[: len(y) - tail])) / n


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among shared words, and shared words with those of either side; 1 if one side's words hold the other's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (both == x or both == y):
        return 1.0
    common = " ".join(sorted(both))
    left, right = (" ".join([common] * bool(common) + sorted(z - both)) for z in (x, y))
    found = [ratio(left, right)]
    if common:
        found += [ratio(common, left), ratio(common, right)]
    return max(found)


#: Pairs that are compared at once, and entries of the table of their letters; texts beyond LONG letters are compared one by one.
TOGETHER, TABLE, LONG = 2048, 1 << 21, 1024


def ratios(pairs: list[tuple[str, str]]) -> np.ndarray:
    """The ratio of each pair, by the bit rows of lcs for many pairs at once."""
    out = np.ones(len(pairs))
    # The shorter text of a pair makes the bits.
    sides = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    sizes = np.array([(len(a), len(b)) for a, b in sides], np.int64).reshape(-1, 2)
    long = sizes[:, 1] > LONG
    for k in np.flatnonzero(long):
        out[k] = ratio(*pairs[k])
    different = np.array([a != b for a, b in sides], bool) & ~long
    words = (sizes[:, 0] + 63) // 64
    order = np.lexsort((sizes[:, 1], words))
    order = order[different[order]]
    lo = 0
    while lo < len(order):
        w = max(1, int(words[order[lo]]))
        part = order[lo : lo + TOGETHER]
        part = part[np.maximum(words[part], 1) == w]
        letters = [np.frombuffer("".join(sides[k][i] for k in part).encode("utf-32-le", "surrogatepass"), np.uint32) for i in (0, 1)]
        number = np.zeros(max((int(x.max(initial=0)) for x in letters)) + 1, np.int32)
        number[letters[0]] = 1
        number = np.where(number > 0, np.cumsum(number, dtype=np.int32), 0)
        kinds = int(number.max()) + 1
        fit = max(32, TABLE // (kinds * w))
        if fit < len(part):
            part = part[:fit]
            letters = [x[: sizes[part, i].sum()] for i, x in enumerate(letters)]
        lo += len(part)
        out[part] = 2 * _common(*(number[x] for x in letters), sizes[part], kinds, w) / sizes[part].sum(1)
    return out


def _common(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, kinds: int, words: int) -> np.ndarray:
    """Lengths of longest common subsequences; a and b: numbers of the letters of all pairs, 0 for letters that no a has."""
    n = len(sizes)
    across = np.arange(n)

    def laid(x: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Places in the table: a row for each place in the text, a column for each pair."""
        m = np.zeros((n, int(size.max())), np.int64)
        m[np.arange(m.shape[1]) < size[:, None]] = x
        return np.ascontiguousarray(m.T) * n + across

    where = np.zeros((words, kinds * n), np.uint64)
    for i, at in enumerate(laid(a, sizes[:, 0])):
        where[i // 64, at] |= np.uint64(1 << i % 64)
    where[:, :n] = 0  # no letter
    rows = [np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64) for _ in range(words)]
    for at in laid(b, sizes[:, 1]):
        carry = None
        for k, row in enumerate(rows):
            hit = row & where[k][at]
            more = row + hit
            if words > 1:
                over = more < row
                if carry is not None:
                    more += carry
                    over |= more < carry
                carry = over
            rows[k] = more | (row - hit)
    found = np.zeros(n, np.int64)
    for k, row in enumerate(rows):
        bits = np.clip(sizes[:, 0] - 64 * k, 0, 64)
        kept = np.where(bits == 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(bits, 63).astype(np.uint64)) - np.uint64(1))
        found += np.bitwise_count(~row & kept)
    return found


class _Tokens:
    """Of two texts the least similarity that is known at once, and the texts whose ratio may be more, or None; the words of a text are split once."""

    def __init__(self):
        self.split: dict[str, tuple[str, frozenset]] = {}

    def of(self, text: str) -> tuple[str, frozenset]:
        known = self.split.get(text)
        if known is None:
            words = text.split()
            known = self.split[text] = " ".join(sorted(words)), frozenset(words)
        return known

    def ratio(self, a: str, b: str) -> tuple[float, tuple[str, str] | None]:
        return 0.0, (a, b)

    def token_sort(self, a: str, b: str) -> tuple[float, tuple[str, str] | None]:
        return 0.0, (self.of(a)[0], self.of(b)[0])

    def token_set(self, a: str, b: str) -> tuple[float, tuple[str, str] | None]:
        x, y = self.of(a)[1], self.of(b)[1]
        if not x or not y:
            return 0.0, None
        both = x & y
        if both and (both == x or both == y):
            return 1.0, None
        common = " ".join(sorted(both))
        left, right = (" ".join([common] * bool(common) + sorted(z - both)) for z in (x, y))
        # The shared words begin both sides, so they are all that they have in common with either.
        return (2 * len(common) / (len(common) + min(len(left), len(right))) if common else 0.0), (left, right)


def similarity_columns(wanted: dict[str, tuple[str, Column, Column]]) -> Column:
    """A struct of similarities, name: (ratio, token_sort or token_set; two texts); 0 if either text is empty or null.

    All of them are worked out in one crossing to Python, and each distinct pair of
    texts of a batch once.
    """
    texts: list[Column] = []
    places: dict[str, tuple[str, int, int]] = {}
    for name, (kind, a, b) in wanted.items():
        at = []
        for c in (a, b):
            known = next((i for i, t in enumerate(texts) if t is c), None)
            at.append(len(texts) if known is None else known)
            if known is None:
                texts.append(c)
        places[name] = (kind, *at)

    @F.arrow_udf("struct<" + ",".join(f"{n}:double" for n in places) + ">")
    def made(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in parts:
            columns, tokens = [c.to_pylist() for c in columns], _Tokens()
            numbers: dict[tuple[str, str], int] = {}
            least, asked = [], []
            for kind, i, j in places.values():
                compared = getattr(tokens, kind)
                for a, b in zip(columns[i], columns[j], strict=True):
                    value, pair = compared(a, b) if a and b else (0.0, None)
                    least.append(value)
                    asked.append(-1 if pair is None else numbers.setdefault(pair, len(numbers)))
            # The last place stands for pairs without a ratio.
            found = np.maximum(least, np.append(ratios(list(numbers)), 0.0)[asked])
            out = [pa.array(x, pa.float64()) for x in found.reshape(len(places), -1)]
            yield pa.StructArray.from_arrays(out, list(places))

    return made(*texts)
