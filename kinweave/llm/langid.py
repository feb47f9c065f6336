"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes is counted. A symbol
unseen in a context is coded by an escape and then in the next shorter context,
without the symbols that the longer one would have coded. The statistics are
frozen, and hold what was seen only. A text goes to the language that codes it in
fewest bits.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import bytesops as B
from kinweave.llm import tables

ORDER = 3
#: Labelled documents for each language from which the trees are counted; the rest of the labelled ones aren't used.
TRAIN_DOCS = 600
#: What stands before the first byte.
PAD = 0x0A
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


#: Code lengths that were worked out are kept up to so many bytes.
MET_BYTES = 12 << 20
#: A slot of the table without an entry.
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass
class Model:
    """Frozen statistics, of which only what was seen is stored.

    symbols[byte] and zero[language, symbol] (code lengths without context) are
    plain arrays. All else stands in one table with open addressing, keys in slots:
    the code length of each symbol seen in a context, and of each context what a
    symbol unseen in it costs on top of its code length in the next shorter one.
    """

    languages: list[str]
    symbols: np.ndarray
    n_symbols: int
    zero: np.ndarray
    slots: np.ndarray
    values: np.ndarray

    def __post_init__(self):
        # The bytes in context that were met last, one for each slot, and their code lengths in all languages.
        self.met, self.lengths = np.zeros(0, np.uint64), np.zeros((0, 0), np.float32)

    def __getstate__(self):
        return self.__dict__ | {"met": self.met[:0], "lengths": self.lengths[:0, :0]}

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key; NaN where there is none."""
        out, some = np.full(len(keys), np.nan, np.float32), np.arange(len(keys))
        mask = np.uint64(len(self.slots) - 1)
        at = B.mix(keys) & mask
        while len(some):
            found = self.slots[at[some]]
            hit = found == keys[some]
            out[some[hit]] = self.values[at[some[hit]]]
            some = some[~hit & (found != EMPTY)]
            at[some] = at[some] + np.uint64(1) & mask
        return out


def _key(language: np.ndarray | int, order: int, kind: int, code: np.ndarray) -> np.ndarray:
    """kind 0: a context and a symbol, 1: a context."""
    return (np.asarray(language, np.uint64) * np.uint64(2 * (ORDER + 1)) + np.uint64(2 * order + kind)) << np.uint64(36) | code.astype(np.uint64)


def has_letter(text: str) -> bool:
    """Whether a character of Unicode category L stands in the text; numerals such as fractions and Roman numbers are none."""
    return any(c.isalpha() and unicodedata.category(c)[0] == "L" for c in text)


def padded(data: np.ndarray, offsets: np.ndarray, pad: int = PAD) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ORDER pad bytes before each, and where each byte of a text stands there."""
    n = len(offsets) - 1
    at = np.arange(len(data)) + ORDER * (np.repeat(np.arange(n), np.diff(offsets)) + 1)
    out = np.full(len(data) + ORDER * n, pad, data.dtype)
    out[at] = data
    return out, at


def count_grams(df: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n): how often each byte stands after each three bytes, added up within a task first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for name in set(langs.tolist()):
                part = batch.column(1).filter(pa.array(langs == name))
                for _, _, data, offsets in B.chunks(part):
                    s, at = padded(data, offsets)
                    s = s.astype(np.uint32)
                    new = np.unique(s[at - 3] << 24 | s[at - 2] << 16 | s[at - 1] << 8 | s[at], return_counts=True)
                    if name in found:
                        both = np.concatenate([found[name][0], new[0]])
                        grams, back = np.unique(both, return_inverse=True)
                        new = grams, np.bincount(back, np.concatenate([found[name][1], new[1]])).astype(np.int64)
                    found[name] = new
        for name, (grams, n) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    return df.select(lang, text).mapInArrow(work, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def freeze(rows: list[tuple[str, int, int]]) -> Model | None:
    """Code lengths from counted four-byte sequences; in memory as many entries as distinct contexts and symbols in them."""
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    which = np.array([number[r[0]] for r in rows])
    grams = np.array([r[1] for r in rows], np.int64)
    n = np.array([r[2] for r in rows], np.float64)
    raw = np.stack([grams >> 24 & 255, grams >> 16 & 255, grams >> 8 & 255, grams & 255])
    used = np.union1d(np.unique(raw), [PAD])
    symbols = np.zeros(256, np.int64)  # symbol 0: any byte that wasn't seen
    symbols[used] = np.arange(1, len(used) + 1)
    a, sym = len(used) + 1, symbols[raw]
    seen_before, prob_before, zero = None, None, np.zeros((len(languages), a))
    keys, bits = [], []
    for k in range(ORDER + 1):
        code = np.zeros(len(grams), np.int64)
        for j in range(ORDER - k, ORDER + 1):
            code = code * a + sym[j]
        size = a ** (k + 1)
        seen, back = np.unique(which * size + code, return_inverse=True)
        count = np.bincount(back, n)
        contexts, own = np.unique(seen // a, return_inverse=True)
        total, kinds = np.bincount(own, count), np.bincount(own)
        # What is seen in a context is seen in the shorter one, too: the share of the shorter one that is left for the rest.
        if k:
            shorter = seen // size * (size // a) + seen % (size // a)
            lower = prob_before[np.searchsorted(seen_before, shorter)]
        else:
            lower = np.full(len(seen), 1 / a)
        left = np.where(kinds < a, np.maximum(1 - np.bincount(own, lower), 1e-300), 0)
        total = total + np.where(left > 0, kinds, 0)
        prob = count / total[own]
        rest = np.where(left > 0, kinds / total / np.maximum(left, 1e-300), 1)
        if k:
            keys += [_key(seen // size, k, 0, seen % size), _key(contexts // (size // a), k, 1, contexts % (size // a))]
            bits += [-np.log2(prob), -np.log2(rest)]
        else:
            zero[:] = -np.log2(1 / a)
            zero[contexts] -= np.log2(rest)[:, None]
            zero.ravel()[seen] = -np.log2(prob)
        seen_before, prob_before = seen, prob
    return Model(languages, symbols.astype(np.uint16), a, zero.astype(np.float32), *_table(np.concatenate(keys), np.concatenate(bits).astype(np.float32)))


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values with linear probing, at most half full."""
    size = 1 << max(4, (2 * len(keys) - 1).bit_length())
    slots, out, some = np.full(size, EMPTY), np.zeros(size, np.float32), np.arange(len(keys))
    at = B.mix(keys) & np.uint64(size - 1)
    while len(some):
        free = some[slots[at[some]] == EMPTY]
        place, first = np.unique(at[free], return_index=True)
        slots[place], out[place] = keys[free[first]], values[free[first]]
        some = some[slots[at[some]] != keys[some]]
        at[some] = at[some] + np.uint64(1) & np.uint64(size - 1)
    return slots, out


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text in each language.

    A byte with its context is worked out once for all its places in the data, and
    not again while it is among those met last.
    """
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    if not len(data):
        return out
    if not len(model.met):
        size = 1 << max(8, (MET_BYTES // (8 + 4 * len(model.languages))).bit_length() - 1)
        model.met, model.lengths = np.full(size, EMPTY), np.zeros((size, len(model.languages)), np.float32)
    s, at = padded(model.symbols[data], offsets, int(model.symbols[PAD]))
    s, a = s.astype(np.uint64), np.uint64(model.n_symbols)
    code = (((s[:-3] * a + s[1:-2]) * a + s[2:-1]) * a + s[3:])[at - 3]
    slot = (code * np.uint64(B.BASE) >> np.uint64(65 - len(model.met).bit_length())).astype(np.int64)
    new = np.unique(code[model.met[slot] != code])
    place = (new * np.uint64(B.BASE) >> np.uint64(65 - len(model.met).bit_length())).astype(np.int64)
    model.met[place], model.lengths[place] = new, _lengths(model, new)
    bits = model.lengths[slot]
    # Of two that share a slot the later stays; the other is worked out for this data alone.
    lost = np.flatnonzero(model.met[slot] != code)
    if len(lost):
        again, back = np.unique(code[lost], return_inverse=True)
        bits[lost] = _lengths(model, again)[back]
    full = np.flatnonzero(np.diff(offsets))
    out[full] = np.add.reduceat(bits, offsets[full], axis=0, dtype=np.float64)
    return out


def _lengths(model: Model, code: np.ndarray) -> np.ndarray:
    """Bits of the last symbol of each four in each language."""
    out, a = np.zeros((len(code), len(model.languages)), np.float32), model.n_symbols
    code = code.astype(np.int64)
    for language in range(len(model.languages)):
        rest = np.arange(len(code))
        for k in range(ORDER, 0, -1):
            here = code[rest] % a ** (k + 1)
            found = model.look_up(_key(language, k, 0, here))
            seen = ~np.isnan(found)
            out[rest[seen], language] += found[seen]
            rest, here = rest[~seen], here[~seen]
            out[rest, language] += np.nan_to_num(model.look_up(_key(language, k, 1, here // a)))
        out[rest, language] += model.zero[language, code[rest] % a]
    return out


def train(df: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", docs: int = TRAIN_DOCS) -> Model | None:
    """Counts the trees on about ``docs`` labelled rows of each language, picked by a hash of the key, and freezes them.

    Rows without language, text or key don't count. Only the number of rows of
    each language and the counts of byte sequences come to the driver; both are
    bounded by the bytes of the sample, whatever the table holds, and so is the
    model, with 24 bytes for each distinct context and byte in it. None if no row
    has a label.
    """
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return None
    share = F.coalesce(*(F.when(F.col(lang) == name, F.lit(min(1.0, docs / n))) for name, n in sizes.items()))
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("train")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return freeze([tuple(r) for r in count_grams(rows.where(draw < share), lang, text).collect()])


def prediction(model: Model | None, spark: SparkSession):
    """A column function: struct (lang_pred, score) of a text column.

    lang_pred is the language that codes the whole text in fewest bits (the first
    by name on ties), or ``und`` where the text is null or has no letter, or
    nothing was learned. score is its share of 2**-bits among the languages, 0 for
    ``und``. Each row stands for itself: repeated rows and nulls in other columns
    change nothing.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in columns:
            pred, score = ["und"] * len(column), [0.0] * len(column)
            for lo, hi, data, offsets in B.chunks(column) if m else ():
                letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[offsets]
                bits = code_lengths(m, data, offsets)
                best = bits.argmin(1)
                share = 1 / np.exp2(np.minimum(0, bits[np.arange(len(best)), best][:, None] - bits)).sum(1)
                for i in range(hi - lo):
                    if letters[i + 1] > letters[i] or has_letter(column[lo + i].as_py() or ""):
                        pred[lo + i], score[lo + i] = m.languages[best[i]], float(share[i])
            yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])
        tables.release()

    # Else Spark would work it out again for every condition on it.
    return predicted.asNondeterministic()


def fold(key: str = "doc_id"):
    """crc32 of the key as text, modulo 3; documents with 1 are held out. Null keys: 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3, F.lit(0))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the language of every document; learned from labelled documents outside the held-out third."""
    docs = tables.read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.where(fold() != 1))
    told = docs.select("doc_id", prediction(model, spark)("text").alias("p"))
    return told.select("doc_id", (fold() == 1).alias("held_out"), "p.lang_pred", "p.score")
