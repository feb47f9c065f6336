import collections
import hashlib
import html as references
import random
import re
import time

import numpy as np

import corpus_pipeline
from kinweave.llm import chat, html, media, registry

OWN = r"\### Assistant: </turn> ok"


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_conversations(spark, sf):
    got = {r["conv_id"]: r for r in chat.op4_chat_format(spark, sf).collect()}
    want = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        want[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    want[-7] = [(0, "user", OWN), (1, "assistant", OWN)]
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), digest(loss))


def test_round_trip_of_hostile_turns(spark):
    r = random.Random(2)
    bits = ["#", "##", "### ", "\\", "</turn>", "</turn>\n", "<", "/turn>", "\n", ": ", "user", "é", "😀", "", " ", "x" * 500]
    rows = [(c, t, r.choice(["user", "assistant", "a: b", "", None, "\\", "#", "sys\n"]), r.choice([None, *("".join(r.choice(bits) for _ in range(r.randrange(8))) for _ in range(3))])) for c in range(60) for t in range(r.randrange(1, 6))]
    rows += [(None, 1, "user", "no id"), (0, None, "user", "first"), (0, None, "user", "first"), (99, 1, "assistant", "long " * 50000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as t", "'x' as formatted")
    want = collections.defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t is not None, t or 0, role or "", text or ""))
    for x in chat.format_chats(df).collect():
        turns = sorted(want.pop(x["conv_id"]))
        assert [(y["role"], y["text"]) for y in x["turns"]] == [y[2:] for y in turns]
        back = [re.sub(r"(?s)\\(.)", r"\1", x["formatted"][s["start"] : s["end"]]) for s in x["loss_spans"]]
        assert back == [y[3] for y in turns if y[2] == "assistant"]
    assert not want
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_is_native(spark, sf):
    plan = chat.op4_chat_format(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def articles(source):
    """Text of each page's article, read from the markup of the test pages."""
    out = {}
    for page, text in source.items():
        article = re.search(r"<article>(.*?)</article>", text, re.S)[1]
        blocks = [" ".join(references.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?p>|</?h1>", article)]
        out[page] = "\n".join(b for b in blocks if b)
    return out


def without_names(page):
    """A page whose class, id and role attributes and article elements are gone."""
    page = re.sub(r"""\s(class|id|role)="[^"]*\"""", "", page)
    return page.replace("<article>", "<div>").replace("</article>", "</div>")


def without_meaning(page):
    """The same, and no element says what it is for."""
    return re.sub(r"<(/?)(?:nav|footer|header|aside|main)\b", r"<\1div", without_names(page))


def test_articles_of_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    want = articles({i: h for i, _, h in rows})
    for change in (lambda x: x, without_names, without_meaning):
        df = spark.createDataFrame([(i, u, change(h)) for i, u, h in rows], "page_id long, url string, html string")
        got = html.extract(df).collect()
        assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
        assert {r["page_id"]: r["text"] for r in got} == want


def test_classes_by_brute_force():
    """Tokens are in one class if and only if they occur equally often on every page."""
    r = random.Random(3)
    for _ in range(20):
        pages = ["<body>" + "".join(r.choice(["<div>a</div>", "<div class=x><p>b", "<ul><li>c<li>d</ul>", "</div>", "e <section>"]) for _ in range(r.randrange(1, 8))) for _ in range(4)]
        counts = collections.defaultdict(lambda: [0] * 2 * len(pages))
        sums = collections.defaultdict(lambda: [0, 0, 0])
        for i, page in enumerate(pages):
            for token, _, _, _, n, closed, *_ in html.page_tokens(page):
                counts[token][2 * i : 2 * i + 2] = [n, closed]
                one, two = html._hash(i, n), html._hash(i, closed)
                for j, x in enumerate((one & 0xFFFFFFFF, one >> 32, (two & 0xFFFFFFFF) - (one & 0xFFFFFFFF) if n != closed else 0)):
                    sums[token][j] += x
        rows = [{"token": t, "line": False, "first": a, "second": b, "closed": c} for t, (a, b, c) in sums.items()]
        got = {frozenset(x["token"] for x in found) for found in html.classes(rows).values()}
        want = collections.defaultdict(set)
        for token, v in counts.items():
            if v[::2] == v[1::2]:
                want[tuple(v)].add(token)
        assert got == {frozenset(x) for x in want.values()}


def test_hostile_pages_take_linear_time():
    for page in ("<a " * 350_000, '<a "' * 250_000, "<div>" * 100_000, "<!--" * 250_000, "<" * 1_000_000, '<a ="' * 200_000, "<div>" * 50_000 + "</p>" * 50_000):
        began = time.process_time()
        html.main_text(page, None)
        sum(1 for _ in html.page_tokens(page))
        assert time.process_time() - began < 5


def test_other_templates_and_odd_pages(spark):
    frame = '<html><body><header>Site</header><div id="menu1">Menu</div><main><header><h2>{t}</h2></header><p>One &amp; two<br>{t} three</p><p>Read more</p><section class="comments">{c}</section></main><aside>x {t}</aside><form>f</form><div class="cookie-notice">ok</div></body>'
    made = lambda i: frame.format(t=f"Title {i}", c="".join(f"<div>Nice {j}!</div>" for j in range(1, i % 3 + 2)))
    rows = [(i, f"http://a.example/{i}", made(i)) for i in range(6)]
    rows += [(10, None, None), (11, "http://b.example/", ""), (12, "http://c.example/", "just <b>text</b> &copy"), (13, "http://d.example", "<article>a<script>var x='<p>';</script>b<!-- c --></article> tail <p"), (0, "http://a.example/0", made(0))]
    # Forty copies of a page don't make its text a part of the template.
    rows += [(20 + i, "http://a.example/20", frame.format(t="Copied", c="")) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as text", "1 as key")
    got = {r["page_id"]: r["text"] for r in html.extract(df).collect()}
    assert all(got[i] == f"Title {i}\nOne & two Title {i} three" for i in range(6))
    assert {got[20 + i] for i in range(40)} == {"Copied\nOne & two Copied three"}
    assert (got[10], got[11], got[12], got[13]) == ("", "", "just text ©", "a\nb")
    assert html.extract(df).count() == 51 and html.extract(df.limit(0)).count() == 0
    limit, html.BROADCAST_BYTES = html.BROADCAST_BYTES, -1
    try:
        assert {r["page_id"]: r["text"] for r in html.extract(df).collect()} == got
    finally:
        html.BROADCAST_BYTES = limit


def test_image_search_recall(spark, sf):
    got = media.op6_media(spark, sf).collect()
    asked = {r[0] for r in spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id % 20 = 0").select("vec_id").collect()}
    found = {(r["query_id"], r["match_id"]) for r in got}
    assert len([q for q in asked if (q, q) in found]) >= 0.9 * len(asked)
    assert len([p for p in found if p[0] != p[1]]) <= 0.02 * len(asked)


def edited(image, degrees, scale, border):
    """An image turned about its middle and resized, without its border, darker and with noise."""
    h, w = image.shape
    t, (y, x) = np.radians(degrees), np.mgrid[: int(h * scale), : int(w * scale)]
    y, x = y - (int(h * scale) - 1) / 2, x - (int(w * scale) - 1) / 2
    u = (x * np.cos(t) + y * np.sin(t)) / scale + (w - 1) / 2
    v = (y * np.cos(t) - x * np.sin(t)) / scale + (h - 1) / 2
    i, j = np.clip(v.astype(int), 0, h - 2), np.clip(u.astype(int), 0, w - 2)
    a, b, f = np.clip(v - i, 0, 1), np.clip(u - j, 0, 1), image.astype(float)
    out = f[i, j] * (1 - a) * (1 - b) + f[i, j + 1] * (1 - a) * b + f[i + 1, j] * a * (1 - b) + f[i + 1, j + 1] * a * b
    out = out[border : out.shape[0] - border, border : out.shape[1] - border]
    return np.clip(0.85 * out + 8 + np.random.default_rng(len(out)).normal(0, 2, out.shape), 0, 255).astype(np.uint8)


def test_matching_descriptors_are_found_by_the_tables(spark):
    """At least nine in ten of all pairs of corners within the radius, against every pair."""
    found = every = 0
    for i in range(12):
        image = media.picture(i)
        stored = spark.createDataFrame([(f["d0"], f["d1"]) for f in media.features_of([image.astype(np.float32)])[0]], "d0 long, d1 long")
        own = [(r["d0"], r["d1"], set(r["k"])) for r in stored.select("d0", "d1", media.own_keys().alias("k")).collect()]
        for degrees, scale in ((0, 1), (7, 1), (90, 1), (33, 1), (0, 0.85), (0, 0.7)):
            asked = media.features_of([edited(image, degrees, scale, 8).astype(np.float32)], True)[0]
            for q in asked:
                for d0, d1, keys in own:
                    if ((q["d0"] ^ d0) & (2**64 - 1)).bit_count() + ((q["d1"] ^ d1) & (2**64 - 1)).bit_count() <= media.RADIUS:
                        every += 1
                        found += bool(keys & set(q["keys"]))
    assert every > 500 and found >= 0.9 * every


def test_turned_resized_and_cropped_copies(spark):
    images = [(i, media.encode(media.picture(i))) for i in range(30)]
    large = np.block([[media.picture(100 + 6 * y + x) for x in range(6)] for y in range(6)])
    images.append((100, media.encode(large)))
    asked = [(1000 + 100 * n + i, media.encode(edited(media.picture(i), d, s, b))) for n, (d, s, b) in enumerate(((7, 1, 8), (90, 1, 8), (0, 0.85, 0))) for i in range(10)]
    asked += [(2000 + i, media.encode(edited(large[70 * i : 70 * i + 110, 200:310], 0, 1, 4))) for i in range(5)]
    frame = lambda rows: spark.createDataFrame(rows, "id long, image binary")
    got = {(r["query_id"], r["match_id"]): r for r in media.find_copies(frame(asked), frame(images), "id").collect()}
    want = {(q, 100 if q >= 2000 else q % 100) for q, _ in asked}
    assert len(want & set(got)) >= 0.9 * len(want) and len(set(got) - want) <= 1, (want - set(got), set(got) - want)
    assert all(abs(abs(r["rotation"]) - 90) < 3 and abs(r["scale"] - 1) < 0.05 for (q, m), r in got.items() if 1100 <= q < 1200 and m == q - 1100)
    assert media.find_copies(frame(asked + asked), frame(images), "id").count() == len(got)


def test_pictures_of_odd_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None), (None, [1.0, 2.0]), ("c", [])], "vec_id string, embedding array<float>").selectExpr("*", "'x' as key", "1 as image")
    got = {r["vec_id"]: r["image"] for r in media.pictures(df, False).collect()}
    assert got["b"] is None and got["a"] == got[None] != got["c"]
    assert media.pictures(df.limit(0), True).count() == 0


def test_image_classes_and_odd_images(spark):
    a, b = media.picture(1), media.picture(2)
    images = [(1, media.encode(a)), (2, media.encode(a)), (2, media.encode(a)), (3, media.encode(b)), (4, None), (5, b""), (6, b"P5\n9 9\n255\n"), (7, media.encode(np.zeros((96, 96)))), (None, media.encode(b)), (8, media.encode(a[:5, :5]))]
    df = spark.createDataFrame(images, "id long, image binary").selectExpr("*", "'x' as sha", "'y' as features")
    queries = spark.createDataFrame([(20, media.encode(media.retouched(a, 3))), (40, media.encode(b)), (60, None), (None, media.encode(a))], "id long, image binary")
    got = sorted((r["query_id"], r["match_id"], r["copies"]) for r in media.find_copies(queries, df, "id").collect())
    assert got == [(20, 1, 3), (40, 3, 2)]
    assert media.find_copies(queries, df.limit(0), "id").count() == 0


def test_pipeline_stages(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        ids = [r[0] for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept
        if name != "tokenize":
            assert out.columns == columns
            docs = out
        if name == "secrets":
            assert set(ids) == kept and not any(re.search(r"AKIA[A-Z0-9]{16}", r[0]) for r in out.select("text").collect())
        kept = set(ids)
    assert len(kept) > 150
    # Odd rows go through all stages.
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert sorted(r["doc_id"] or -1 for r in docs.collect()) == [-1, 1, 5, 6]


def test_every_operator_has_a_query():
    assert [int(n.split("_")[0][2:]) for n in registry.queries()] == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "secrets", "tokenize"]
