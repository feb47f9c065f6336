"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a byte string there is one token that ends the encoding of
that prefix. It is stored for each prefix: the last token ``t`` of prefix ``i``
is the one token ending at ``i`` that may follow the last token of the prefix
``i - len(t)``. Two tokens may stand side by side if encoding their joined bytes
gives these two back. The whole encoding is read backwards from the last prefix.
Appending bytes only adds prefixes, and after an edit only the prefixes from the
edit on are worked out again, until their last tokens agree with the old ones.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import tables

#: A worker keeps the ids of up to twice so many distinct pieces: when a generation is full, the one before it
#: goes, so that frequent pieces stay.
CACHE_PIECES = 80_000
#: Longer pieces are encoded each time: they hardly come again and would fill the cache.
CACHED_CHARS = 64


class Vocabulary:
    """Ranks of a byte-level BPE: the bytes of each token, in the order of merging."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self._spines: dict[int, tuple[list, list]] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in ranks.items():
            if self.whole(i):
                self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()

    @classmethod
    def from_lines(cls, lines: bytes) -> Vocabulary:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a})

    def merge(self, piece: bytes, down_to: int = 1) -> list[bytes]:
        """Merges from single bytes on, lowest rank first; the definition that the prefix method is held against."""
        parts, ranks = [piece[i : i + 1] for i in range(len(piece))], self.ranks
        while len(parts) > down_to:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to the token."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = len(self.merge(self.tokens[token])) == 1
        return known

    def spines(self, token: int) -> tuple[list, list]:
        """What stands at the left and at the right end of a token while it is merged: (bytes, rank of the merge that takes them)."""
        known = self._spines.get(token)
        if known is None:
            data, after = self.tokens[token], [(self.tokens[token], 1 << 62)]
            if len(data) == 1:
                known = after, after
            else:
                left, right = self.merge(data, 2)
                lower = [(self.spines(self.ranks[left])[0], left), (self.spines(self.ranks[right])[1], right)]
                known = tuple(spine[:-1] + [(part, token)] + after for spine, part in lower)
            self._spines[token] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, joined, encode to the two tokens.

        They do unless a merge across the boundary comes before both of the merges
        that take its two sides; of equal ranks the leftmost comes first.
        """
        known = self._pairs.get((left, right))
        if known is not None:
            return known
        a, b, i, j, get = self.spines(left)[1], self.spines(right)[0], 0, 0, self.ranks.get
        known = True
        while True:
            (x, until), (y, till) = a[i], b[j]
            c = get(x + y)
            if c is not None and c < until and c <= till:
                known = False
                break
            if until <= till:
                if until == 1 << 62:
                    break
                i += 1
            else:
                j += 1
        if len(self._pairs) > 200_000:
            self._pairs.clear()
        self._pairs[left, right] = known
        return known

    def last_token(self, data: bytes, last: list[int], i: int) -> int:
        """The token that ends the encoding of data[:i], given those of all shorter prefixes."""
        get = self.ranks.get
        for start in range(max(0, i - self.longest), i):
            token = get(data[start:i])
            if token is not None and self.whole(token) and (not start or self.follows(last[start], token)):
                return token
        raise ValueError(f"no token ends at byte {i}; the vocabulary lacks a byte")

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece. An automaton names all tokens that end at each byte, the longest first."""
        token = self.ranks.get(piece)
        if token is not None and self.whole(token):
            return [token]
        last, pairs, done = [-1], self._pairs, 0
        for at, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            if at < done:
                continue
            left = last[at + 1 - size]
            if left >= 0:
                fits = pairs.get((left, token))
                if fits is None:
                    fits = self.follows(left, token)
                if not fits:
                    continue
            elif size != at + 1:
                continue
            last.append(token)
            done += 1
        if done != len(piece):
            raise ValueError(f"no token ends at byte {done + 1}; the vocabulary lacks a byte")
        return self.read_back(last)

    def read_back(self, last: list[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]


class PrefixEncoder:
    """A byte string with the last token of each prefix; grows by appends and follows edits exactly."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        for i in range(len(self.last), len(self.data) + 1):
            self.last.append(self.vocabulary.last_token(self.data, self.last, i))

    def edit(self, start: int, end: int, by: bytes) -> int:
        """Replaces data[start:end]; returns how many prefixes were worked out again."""
        old, shift = self.last, len(by) - (end - start)
        self.data = self.data[:start] + by + self.data[end:]
        self.last, same, keep = old[: start + 1], 0, self.vocabulary.longest
        for i in range(start + 1, len(self.data) + 1):
            self.last.append(self.vocabulary.last_token(self.data, self.last, i))
            same = same + 1 if i >= start + len(by) and self.last[i] == old[i - shift] else 0
            # A last token depends on the bytes and last tokens of the prefixes up to the longest token before it.
            if same >= keep and i - keep >= start + len(by):
                self.last += old[i - shift + 1 :]
                return i - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.vocabulary.read_back(self.last)


class TextEncoder:
    """Splits texts into pieces by a pattern and encodes each piece; keeps the ids of frequent pieces as packed bytes."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        top = max(vocabulary.tokens) + 1
        self.table = np.array([vocabulary.tokens.get(i, b"") for i in range(top)], object)

    def _piece(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            ids = self.vocabulary.encode_piece(piece.encode())
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            self.cache[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(self.cache) >= CACHE_PIECES:
            self.cache, self.older = {}, self.cache
        get, piece = self.cache.get, self._piece
        return b"".join([get(p) or piece(p) for p in self.find(text)])

    def forget(self) -> None:
        """Gives the memory of the caches back, at the end of a task."""
        self.cache, self.older = {}, {}
        self.vocabulary._pairs.clear()

    def decode(self, packed: bytes) -> bytes:
        return b"".join(self.table[np.frombuffer(packed, "<u4")].tolist())


_encoders: dict[tuple[int, str], TextEncoder] = {}


def _encoder(lines: bytes, pattern: str) -> TextEncoder:
    """One encoder for each worker process and vocabulary."""
    key = (hash(lines), pattern)
    if key not in _encoders:
        _encoders[key] = TextEncoder(Vocabulary.from_lines(lines), pattern)
    return _encoders[key]


def ranks_file(path: str) -> bytes:
    """A vocabulary's lines, read by the driver; their number is the vocabulary's size, whatever the corpus."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, lines: bytes, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the token ids (array of int) of a text column. Null text: no ids. A column named ``out`` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(lines)
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<int>")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(shared.value, pattern)
        for s in parts:
            yield pd.Series([np.frombuffer(enc.encode(t or ""), "<i4") for t in s], dtype=object)

    return df.withColumn(out, ids(df[text]))


def decode(df: DataFrame, lines: bytes, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes (binary) that a column of token ids stands for. Null ids: no bytes."""
    shared = df.sparkSession.sparkContext.broadcast(lines)
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("binary")
    def joined(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(shared.value, pattern)
        for s in parts:
            yield pd.Series([enc.decode(np.asarray(x, "<u4").tobytes()) if x is not None else b"" for x in s], dtype=object)

    return df.withColumn(out, joined(df[ids]))


def digests(df: DataFrame, lines: bytes, pattern: str, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Encodes and decodes each text; gives key, n_tokens, ids_sha256, decoded_sha256, and the ids themselves if asked for.

    One pass in which no decoded bytes leave the worker; nothing is shuffled and a
    row's memory is a few times its text. A null text is empty
    (no tokens, digests of no bytes); repeated rows and null keys pass through;
    other columns are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(lines)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sha = _encoder(shared.value, pattern), hashlib.sha256
        for batch in (whole.slice(lo, 256) for whole in batches for lo in range(0, len(whole), 256)):
            n, hashes, decoded, arrays = [], [], [], []
            for text in batch.column(1).to_pylist():
                packed = enc.encode(text or "")
                n.append(len(packed) // 4)
                hashes.append(sha(packed).hexdigest())
                if ids:
                    arrays.append(np.frombuffer(packed, "<i4"))
                decoded.append(sha(enc.decode(packed)).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns, names = [*columns, pa.array(arrays, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)
        enc.forget()
        tables.release()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(work, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids).withColumnRenamed("key", key)


def public_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[bytes, str]:
    import public_tokenizers

    return ranks_file(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded bytes of every document's whole text."""
    return digests(tables.read(spark, sf_dir, "documents", "doc_id", "text"), *public_vocabulary())
