"""Main text of web pages by template deduction from equivalence classes.

The tokens of a page are the tags of its elements, told apart by where they stand
(the elements around them, and which of their like among their siblings), and its
lines of text, told apart by the element that they stand in. On a host, tokens
that occur equally often on every page have the same occurrence vector and make an
equivalence class. A class is valid if it holds both tags of each of its elements,
so that what stands between them nests, and if its pages are at least half of the
host's; valid classes, nested into each other, are the host's template. Lines of
text in the class of the element around them are part of the template, too. What
is left are the slots, which differ from page to page. The main text is what the
slots take of the innermost element of the template that holds more than half of
all that the host's slots take.

No class name decides anything; an element's name does where the standard gives
it a meaning: what isn't flow text, and what lies outside the main text by
definition (nav, aside, footer, form and the like).

An occurrence vector is never gathered. It is a sum of one hash for each page and
count, which tasks add up before anything is shuffled.
"""

from __future__ import annotations

import functools
import html as references
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import tables

#: A start or end tag, whose attributes may be quoted; a tag that isn't closed takes the rest of the page.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)(?:>|\Z)""")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*+(?:>|\Z)", re.DOTALL)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "noscript", "iframe")}
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""", re.IGNORECASE)
#: Elements that make up the tree; all others are markup inside a slot.
STRUCTURE = frozenset("html head body nav header footer aside main article section div form ul ol li dl table tbody thead tfoot tr td th fieldset figure figcaption template svg button select option label dialog menu object canvas video audio".split())
#: Elements that stand as often as there are records of them: their places among their siblings tell nothing.
RECORDS = frozenset("li tr td th option".split())
#: Elements that stay in the line of their text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: What isn't flow text, or lies outside the main text, by the meaning that the standard gives an element; a header stays inside the main text.
LEFT_OUT = frozenset("head nav aside footer form template svg button select dialog menu object canvas video audio".split())
#: Elements that may hold a part of its own of a page.
PARTS = frozenset(("section", "div"))
#: Distinct pages from which a host has a template of its own; others go by that of all pages together.
LEAST_PAGES = 5
#: Templates up to this many bytes are sent to every executor; larger ones are joined by host and salt.
BROADCAST_BYTES = 8 << 20
#: Groups of equal pages up to this many (40 bytes each) are sent to every executor, larger tables are joined.
BROADCAST_ROWS = 1 << 19
SALTS = 32
ROOT = 1
_MASK = (1 << 63) - 1


@functools.lru_cache(20_000)
def label(name: str, attributes: str) -> str:
    """An element's name with class, id and role, digits folded."""
    parts = [f"{m[1].lower()}={(m[2] or m[3] or m[4] or '').strip().lower()}" for m in _ATTRIBUTE.finditer(attributes)] if "=" in attributes else []
    return re.sub(r"[0-9]+", "0", " ".join([name, *parts]))


def _hash(*parts) -> int:
    return xxhash.xxh64_intdigest("\t".join(map(str, parts)).encode("utf-8", "replace")) & _MASK


@dataclass(slots=True)
class Node:
    """An element of a page. group: its label below its parent; nth: which of its group it is, from 0 on."""

    parent: int
    name: str
    label: str
    nth: int
    closed: bool = False
    chars: int = 0
    children: dict = field(default_factory=dict)


def tree(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The elements of a page, parents first, and its lines of text with the elements that they begin in.

    An end tag closes up to its start tag, and is ignored without one; what is
    open at the end of the page counts as closed there. Node 0 stands for the page.
    Takes one pass, whatever the page holds.
    """
    nodes, lines = [Node(-1, "", "", 0, True)], []
    stack, names = [0], {}
    run: list[str] = []
    home = at = 0

    def end_line() -> None:
        if run:
            line = " ".join("".join(run).split())
            run.clear()
            if line:
                lines.append((home, line))
                nodes[home].chars += len(line)

    def text(value: str) -> None:
        nonlocal home
        if not run:
            home = stack[-1]
        run.append(references.unescape(value) if "&" in value else value)

    while (start := page.find("<", at)) >= 0:
        m = _TAG.match(page, start)
        if not m:
            other = _OTHER.match(page, start)
            # A sign that begins no tag is text.
            stop = other.end() if other else start + 1
            text(page[at : start if other else stop])
            at = stop
            continue
        if start > at:
            text(page[at:start])
        at = m.end()
        if page[at - 1] != ">":
            break
        name = m[2].lower()
        if name in _RAW_END and not m[1]:
            end_line()
            close = _RAW_END[name].search(page, at)
            at = close.end() if close else len(page)
        elif name not in STRUCTURE:
            if name == "br":
                text(" ")
            elif name not in INLINE:
                end_line()
        elif m[1]:
            end_line()
            if names.get(name):
                while True:
                    i = stack.pop()
                    names[nodes[i].name] -= 1
                    if nodes[i].name == name:
                        nodes[i].closed = True
                        break
        else:
            end_line()
            if name == "li" and nodes[stack[-1]].name == "li":
                names["li"] -= 1
                nodes[stack.pop()].closed = True
            own = label(name, m[3])
            like = nodes[stack[-1]].children.setdefault(own, [])
            nodes.append(Node(stack[-1], name, own, 0 if name in RECORDS else len(like)))
            like.append(len(nodes) - 1)
            if not m[3].endswith("/"):
                stack.append(len(nodes) - 1)
                names[name] = names.get(name, 0) + 1
            else:
                nodes[-1].closed = True
    if at < len(page) and page.find("<", at) < 0:
        text(page[at:])
    end_line()
    for i in stack:
        nodes[i].closed = True
    return nodes, lines


def identities(nodes: list[Node]) -> tuple[list[int], list[int]]:
    """For each element a number that equal places have on all pages, and whether it or what it stands in is left out."""
    ids, out = [ROOT], [False]
    for n in nodes[1:]:
        ids.append(_hash(ids[n.parent], n.label, n.nth))
        out.append(out[n.parent] or n.name in LEFT_OUT)
    return ids, out


def host_of(url):
    """Host of a url column in lower case; a null url, or one without a host, has the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


#: of: the parent of an element, the element around a line; place: name, label and nth; likes: how many of its group stand there; left: left out.
STATS = "host string, token long, of long, place string, line boolean, pages double, first long, second long, closed long, chars double, likes double, left boolean"
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
_NAMES = [x.split()[0] for x in STATS.split(", ")]


def page_tokens(page: str) -> Iterator[tuple]:
    """(token, of, place, line, count, closed count, chars, likes, left out) of each distinct token of a page. chars: text in the slot of an element."""
    nodes, lines = tree(page)
    ids, out = identities(nodes)
    chars = [0 if o else n.chars for n, o in zip(nodes, out, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        chars[nodes[i].parent] += chars[i]
    found: dict[int, list] = {}
    for i, n in enumerate(nodes):
        row = found.get(ids[i])
        if row is None:
            likes = len(nodes[n.parent].children[n.label]) if i else 1
            found[ids[i]] = row = [ids[i], ids[n.parent] if i else 0, f"{n.name}\t{n.nth}\t{n.label}", False, 0, 0, 0, likes, out[i]]
        row[4] += 1
        row[5] += n.closed
        row[6] += chars[i]
    for home, line in lines:
        if not out[home]:
            token = _hash(ids[home], "line", line)
            row = found.setdefault(token, [token, ids[home], "", True, 0, 0, 0, 0, False])
            row[4] += 1
            row[5] += 1
            row[6] += len(line)
    yield from found.values()


def token_stats(pages: DataFrame) -> DataFrame:
    """For each host, and for all pages together (host null), and token: share of pages, occurrence vectors of both tags, text.

    pages: host, html, copies (equal pages of the host; each counts for its part).
    A line can only be in the class of the element around it if it is there on all
    pages of a task, too; other lines are left out before the shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, list] = {}
            for host, page, copies in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                page = page or ""
                seed = xxhash.xxh64_intdigest(page.encode("utf-8", "replace"))
                for token, of, place, line, n, closed, chars, likes, left in page_tokens(page):
                    # Two hashes of 32 bits: their sums fit a long for two thousand million pages.
                    one, two = (_hash(seed, n) for n in (n, closed))
                    for own in (host, None) if not line else (host,):
                        row = found.get((own, token))
                        if row is None:
                            found[own, token] = row = [of, place, line, 0.0, 0, 0, 0, 0.0, 0.0, left]
                        row[3] += 1 / copies
                        row[4] += one & 0xFFFFFFFF
                        row[5] += one >> 32
                        row[6] += (two & 0xFFFFFFFF) - (one & 0xFFFFFFFF) if n != closed else 0
                        row[7] += chars / copies
                        row[8] += likes / copies
            rows = [(*k, *v) for k, v in found.items() if not v[2] or _same(v, found[k[0], v[0]])]
            columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, _KINDS[x.split()[1]]) for c, x in zip(columns, STATS.split(", "), strict=True)], _NAMES)

    def _same(line: list, element: list) -> bool:
        return line[4:6] == element[4:6]

    rows = pages.select("host", "html", "copies").mapInArrow(work, STATS)
    sums = [F.sum(c).alias(c) for c in ("pages", "first", "second", "closed", "chars", "likes")]
    return rows.groupBy("host", "token", "of", "line").agg(F.max("place").alias("place"), F.max("left").alias("left"), *sums)


@dataclass
class Template:
    """chain: (name, label, nth, how many alike) from the page's first element down to the main one; ids of the main element, of lines and of elements to leave out."""

    chain: list[tuple[str, str, int, int]]
    main: int
    lines: frozenset[int]
    parts: frozenset[int]


def classes(rows: list[dict]) -> dict[tuple[int, int], list[dict]]:
    """Valid equivalence classes of a host's frequent tokens, by occurrence vector: elements with both tags, and the lines that go with them."""
    found: dict[tuple[int, int], list[dict]] = {}
    for r in rows:
        # Both tags of an element are in one class if their vectors differ nowhere.
        if r["line"] or r["closed"] == 0:
            found.setdefault((r["first"], r["second"]), []).append(r)
    return {v: rs for v, rs in found.items() if any(not r["line"] for r in rs)}


def deduce(rows: list[dict]) -> Template | None:
    """The template from the tokens on at least half of a host's pages; None if it leads to no element."""
    valid = classes(rows)
    element = {r["token"]: r | {"vector": v} for v, rs in valid.items() for r in rs if not r["line"]}
    # Classes nest where the elements around are of the template, too.
    reached, below = {ROOT}, {}
    for r in element.values():
        below.setdefault(r["of"], []).append(r)
    queue = [ROOT]
    while queue:
        for r in below.get(queue.pop(), ()):
            reached.add(r["token"])
            queue.append(r["token"])
    element = {t: r for t, r in element.items() if t in reached}
    lines = [r for v, rs in valid.items() for r in rs if r["line"] and r["of"] in element and element[r["of"]]["vector"] == v]
    mass = {t: r["chars"] for t, r in element.items()}
    for r in lines:
        t = r["of"]
        while t in mass:
            mass[t] -= r["chars"]
            t = element[t]["of"]
    main, chain = ROOT, []
    while True:
        inner = max((r for r in below.get(main, ()) if not r["left"] and r["token"] != ROOT), key=lambda r: (mass[r["token"]], r["token"]), default=None)
        if inner is None or 2 * mass[inner["token"]] <= mass.get(main, 0):
            break
        name, nth, own = inner["place"].split("\t", 2)
        chain.append((name, own, int(nth), round(inner["likes"] / inner["pages"])))
        main = inner["token"]
    if not chain:
        return None
    # Parts of the main element that mostly hold records, as lists of comments do.
    parts, queue = set(), [main]
    while queue:
        for r in below.get(queue.pop(), ()):
            inner = below.get(r["token"], ())
            records = r["chars"] - sum(x["chars"] for x in inner if round(x["likes"] / x["pages"]) == 1)
            many = any(round(x["likes"] / x["pages"]) > 1 for x in inner)
            if r["place"].split("\t")[0] in PARTS and many and 2 * records > r["chars"] and 2 * mass[r["token"]] < mass[main]:
                parts.add(r["token"])
            else:
                queue.append(r["token"])
    return Template(chain, main, frozenset(r["token"] for r in lines), frozenset(parts))


def templates(stats: DataFrame, pages: DataFrame) -> DataFrame:
    """(host, template): the pickled template of each host with LEAST_PAGES distinct pages, and of all pages (host null).

    pages: (host, pages). A host gathers only tokens that are on half of its pages,
    so at most twice as many as a page has on average.
    """
    every = pages.agg(F.sum("pages").alias("all_pages")).select(F.lit(None).cast("string").alias("host"), "all_pages")
    known = pages.select("host", F.col("pages").alias("all_pages")).unionByName(every)
    often = stats.join(known, stats["host"].eqNullSafe(known["host"])).where(f"all_pages >= {LEAST_PAGES} and 2 * pages >= all_pages - 1e-6").select(stats["host"], F.struct("token", "of", "place", "line", "pages", "first", "second", "closed", "chars", "likes", "left").alias("t"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [deduce(sorted(rows, key=lambda r: r["token"])) for rows in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t and pickle.dumps(t) for t in made], pa.binary())], ["host", "template"])

    return often.groupBy("host").agg(F.collect_list("t").alias("t")).mapInArrow(work, "host string, template binary")


def _main_node(nodes: list[Node], chain: list[tuple[str, str, int, int]]) -> int | None:
    """The element of a page at the end of the chain.

    Where a page has as many alike as usual, place decides, else the one with most text.
    """
    at, weight = 0, None
    for _, own, nth, usual in chain:
        like = nodes[at].children.get(own)
        if not like:
            return None
        if len(like) == usual and nth < usual:
            at = like[nth]
            continue
        if weight is None:
            weight = [n.chars for n in nodes]
            for i in range(len(nodes) - 1, 0, -1):
                weight[nodes[i].parent] += weight[i]
        at = max(like, key=lambda i: (weight[i], -i))
    return at


def main_text(page: str, template: Template | None) -> str:
    """Text of the main slots, line by line.

    A page that lacks the template's main element, or has no template, goes by its
    own main or else article element if it has just one, or by all that isn't left out.
    """
    nodes, lines = tree(page)
    found = _main_node(nodes, template.chain) if template else None
    drop, parts = (template.lines, template.parts) if found is not None else ((), ())
    if found is None:
        found = next((own[0] for name in ("main", "article") if len(own := [i for i, n in enumerate(nodes) if n.name == name]) == 1), 0)
    whole = nodes[found].name in ("", "html", "body")
    # Below the main element places are told as in the template, whichever of its like was taken here.
    ids, kept = {found: template.main if drop or parts else ROOT}, {found: True}
    for i in range(found + 1, len(nodes)):
        n = nodes[i]
        if n.parent in kept:
            ids[i] = _hash(ids[n.parent], n.label, n.nth) if drop or parts else ROOT
            kept[i] = kept[n.parent] and n.name not in LEFT_OUT and not (whole and n.name == "header") and ids[i] not in parts
    return "\n".join(line for home, line in lines if kept.get(home) and not (drop and _hash(ids[home], "line", line) in drop))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every page.

    Pages come back as often as they stand in the input. A null html is empty and
    gives an empty text; a null url counts as a host of its own; null keys pass
    through. Templates are deduced from all pages of a host, of which equal ones
    count as one; of texts of equal weight the first by place is the main one.
    Templates are broadcast if they take at most BROADCAST_BYTES, which is
    measured; beyond that pages and templates meet by host and a salt, so that a
    host with very many pages is dealt out. Other columns are left out.
    """
    rows = pages.select(pages[key].alias("key"), pages[url].alias("url"), pages[html].alias("html")).withColumn("host", host_of(F.col("url")))
    rows = rows.withColumn("h", F.xxhash64("html"))
    sizes = tables.cut(rows.groupBy("host", "h").agg(F.count("*").alias("copies")))
    equal = sizes.where("copies > 1")
    counted = rows.join(F.broadcast(equal) if equal.count() <= BROADCAST_ROWS else equal, ["host", "h"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    found = tables.cut(templates(token_stats(counted), sizes.groupBy("host").agg(F.count("*").alias("pages"))))
    general = found.where("host is null").head()
    shared = pages.sparkSession.sparkContext.broadcast(general and general["template"])
    found = found.where("host is not null")
    size = found.agg(F.sum(F.length("host") + F.coalesce(F.length("template"), F.lit(0)) + 64)).head()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("key", "url", F.length("html")), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(salted, ["host", "salt"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes | None, Template | None] = {}
        for batch in batches:
            texts = []
            for page, packed in zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True):
                packed = shared.value if packed is None else packed
                if packed not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[packed] = packed and pickle.loads(packed)
                texts.append(main_text(page or "", known[packed]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["key", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = joined.select("key", "url", "html", "template").mapInArrow(work, f"key {kinds['key']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"key": key, "url": url})


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(tables.read(spark, sf_dir, "pages", "page_id", "url", "html"))
