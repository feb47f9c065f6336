"""Licence scans: an automaton finds notice phrases and identifier tags, a shunting-yard parser reads licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import bytesops as B
from kinweave.llm import tables

#: Phrases whose places are counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: More notice phrases in lower-case words, their labels, and how sure they are by themselves.
NOTICES = {
    "affero general public license": ("agpl", 0.95),
    "lesser general public license": ("lgpl", 0.95),
    "gnu general public license version 2": ("gpl-2.0", 0.95),
    "gnu general public license version 3": ("gpl-3.0", 0.95),
    "apache license version 2 0": ("apache-2.0", 0.95),
    "bsd license": ("bsd", 0.9),
    "isc license": ("isc", 0.9),
    "mozilla public license": ("mpl", 0.95),
    "eclipse public license": ("epl", 0.95),
    "cc by 4 0": ("cc-by", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc0 1 0": ("cc0", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "public domain": ("public-domain", 0.5),
    "all rights reserved": ("proprietary", 0.5),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
}
BASE_SURE = 0.9
TAG = "spdx license identifier"
TAG_SURE = 0.99
_TAG_LINE = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_EXPRESSION = re.compile(r"\s*(\(|\)|[A-Za-z0-9.+:-]+)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Licences that don't ask for the same licence on derived works; a family is what stands before the version.
PERMISSIVE = {"mit", "apache", "bsd", "isc", "cc0", "cc", "unlicense", "zlib", "0bsd", "bsl"}
#: Families of licence identifiers: a word after a tag is a licence only if what stands before its first sign or version is one.
FAMILIES = PERMISSIVE | set(
    "afl agpl apl apsl artistic beerware blueoak boost cal catosl cddl cecill cpal cpl curl ecl efl epl eupl fdl ftl gfdl gpl hpnd ijg intel ipl json lgpl libpng licenseref lppl mpl ms mulanpsl naist ncsa nist none noassertion npl oclc odbl odc ofl ogl openssl osl pddl php postgresql psf python qpl rpl ruby sgi sissl sleepycat spl sspl tcl unicode upl vim w3c watcom wtfpl x11 xnet zpl".split()
)

_TO_WORDS = bytes(B.LOWER[i] if B.WORD_ALNUM[i] else 0x20 for i in range(256))


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        out.add_word(phrase, phrase)
    out.make_automaton()
    return out


def parse(text: str) -> tuple | None:
    """The tree of a licence expression: a name, or (operator, left, right), or None where no name stands.

    Reads as far as the text is an expression: up to the first character or token
    that can't go on with it. Operators without a right side and open parentheses
    are left out.
    """
    out: list = []
    held: list[str] = []

    def reduce() -> None:
        op = held.pop()
        if op != "(":
            right, left = out.pop(), out.pop()
            out.append((op, left, right))

    operand, at = True, 0
    while m := _EXPRESSION.match(text, at):
        at = m.end()
        token = m[1]
        word = token.lower()
        if token == "(":
            if not operand:
                break
            held.append(token)
        elif token == ")":
            if operand or "(" not in held:
                break
            while held[-1] != "(":
                reduce()
            held.pop()
        elif word in _PRECEDENCE:
            if operand:
                break
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= _PRECEDENCE[word]:
                reduce()
            held.append(word)
            operand = True
        else:
            if not operand:
                break
            out.append(word)
            operand = False
    # What waits for an operand that never came goes: open parentheses at the end, up to an operator, whose left side stands.
    while operand and held:
        operand = held.pop() == "("
    while held:
        reduce()
    return out[-1] if out else None


def names(tree) -> list[str]:
    """The licences of a tree, in order; exceptions after ``with`` stay with their licence."""
    if tree is None:
        return []
    if isinstance(tree, str):
        return [tree]
    op, left, right = tree
    if op == "with":
        return [f"{x} with {y}" for x in names(left) for y in names(right)]
    return names(left) + names(right)


def known(name: str) -> bool:
    """Whether a name is that of a licence: one of FAMILIES, with or without version and variant."""
    name = name.partition(" with ")[0]
    return re.split(r"[-+.:]|(?<=[a-z])v?(?=[0-9])", name, maxsplit=1)[0] in FAMILIES or name in FAMILIES


def permissive(tree) -> bool:
    """Whether the expression can be met by permissive licences alone: any side of ``or``, both sides of ``and``."""
    if tree is None:
        return False
    if isinstance(tree, str):
        return re.split(r"[-+]", tree)[0] in PERMISSIVE and not re.search(r"-(sa|nc|nd)\b", tree)
    op, left, right = tree
    if op == "with":
        return permissive(left)
    return permissive(left) or permissive(right) if op == "or" else permissive(left) and permissive(right)


def scan(data: bytes, find: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, permissive) of one text's bytes."""
    flat = b" ".join(data.translate(_TO_WORDS).split())
    n, places, base, more, miss, tagged = flat.count(b" ") + 1 if flat else 0, [], set(), set(), 1.0, False
    for at, phrase in find.iter(flat.decode("latin-1")):
        start = at + 1 - len(phrase)
        if (start and flat[start - 1] != 0x20) or (at + 1 < len(flat) and flat[at + 1] != 0x20):
            continue
        if phrase in BASE:
            places.append(start)
            base.add(BASE[phrase])
            miss *= 1 - BASE_SURE
        elif phrase in NOTICES:
            label, sure = NOTICES[phrase]
            more.add(label)
            miss *= 1 - sure
        else:
            tagged = True
    free = None
    if tagged:
        trees = [t for t in map(parse, _TAG_LINE.findall(data.decode("utf-8", "replace"))) if t is not None and all(map(known, names(t)))]
        for tree in trees:
            more.update(names(tree))
            miss *= 1 - TAG_SURE
        free = all(map(permissive, trees)) if trees else None
    word = lambda p: flat.count(b" ", 0, p)
    return n, len(places), word(min(places)) if places else None, word(max(places)) if places else None, ",".join(sorted(base)), ",".join(sorted(base | more)), round(1 - miss, 6), free


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean"


def licences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scans each whole text for licences.

    Gives the key and: n_words, n_base (places of base phrases), first_word and
    last_word (their smallest and largest start, null if none), base_labels and
    labels (sorted, comma-joined, empty if none), score (how sure it is that any
    licence applies; 0 if nothing was found) and permissive (of tagged
    expressions, else null). A null text is empty. Repeated rows and null keys
    pass through; other columns are left out. One pass without a shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = automaton()
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_()]
        for batch in batches:
            rows = [scan(x or b"", find) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", *(x.split()[0] for x in SCHEMA.split(", "))])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(work, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document's whole text."""
    return licences(tables.read(spark, sf_dir, "documents", "doc_id", "text")).drop("permissive")


def _sql() -> str:
    """The same in SQL, by comparing the words at every place; of a tagged expression the names, as it stands, without WITH."""
    phrases = [(p, label, BASE_SURE, True) for p, label in BASE.items()] + [(p, label, sure, False) for p, (label, sure) in NOTICES.items()]
    rows = ", ".join(f"('{p}', {len(p.split())}, '{label}', {1 - sure}::DOUBLE, {base})" for p, label, sure, base in phrases)
    return f"""
WITH phrases(phrase, size, label, miss, base) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
x AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
placed AS (SELECT r, i, label, miss, base FROM x JOIN phrases ON word = string_split(phrase, ' ')[1] JOIN d USING (r) WHERE array_to_string(w[i:i + size - 1], ' ') = phrase),
tags AS (SELECT r, unnest(regexp_extract_all(text, '(?i)spdx-license-identifier\\s*:[ \\t]*([^\\r\\n]*)', 1)) AS x FROM d),
named AS (SELECT r, 0 AS i, unnest(list_filter(regexp_extract_all(lower(x), '[a-z0-9.+:-]+'), lambda t: t NOT IN ('and', 'or'))) AS label, {1 - TAG_SURE}::DOUBLE AS miss, false AS base FROM tags),
every AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(i - 1) FILTER (base) AS first_word, max(i - 1) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, round(1 - product(miss), 6) AS score
  FROM (SELECT * FROM placed UNION ALL SELECT * FROM named) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN every USING (r)
"""


SQL = _sql()
