from __future__ import annotations

import hashlib
import random
import re

import pytest
from fixtures import FOLDER, pages

from stakeline.llm import page_text, url_rules, warc
from stakeline.llm.common import prepare, read

# --- url rules --------------------------------------------------------------------------------


def brute_rule(url, rules):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


ODD_URLS = [
    None,
    "",
    "no scheme.com/x",
    "http://",
    "http:///en/",
    "HTTP://WWW.Example.COM/en/",
    "http://example.com",
    "http://example.com/",
    "http://example.com?x=/en/",
    "http://example.com/en",
    "http://xexample.com/en/a",
    "http://com/en/",
    "a://b://example.com/en/",
    "http://www.example.com:80/en/",
    "http://É.example.com/en/\U0010ffff",
    "http://net/fr/" + "x" * 100_000,
    "http://..com/",
    "http://example.com/EN/",
    "http://a.net/es/#/fr/",
]


@pytest.mark.parametrize("partitions", [1, 13])
def test_odd_urls(spark, partitions):
    prepare(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rows = [(i, u, None) for i, u in enumerate(ODD_URLS)] + [(None, ODD_URLS[5], "x")] * 2
        rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
        got = [tuple(r) for r in url_rules.judge_urls(pages(spark, rows), rules).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = [(i, *brute_rule(u, url_rules.RULES)) for i, u, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_random_rules(spark):
    prepare(spark)
    rng = random.Random(8)

    def host():
        return ".".join(rng.choices(["a", "b", "a-b", "com", "x1"], k=rng.randrange(1, 5)))

    def path():
        return "/" + "/".join(rng.choices(["en", "e", "fr", "", "en-x"], k=rng.randrange(4)))

    rules = [(rng.choice(["allow", "block"]), host(), path()) for _ in range(80)]
    rules += [("allow", "a.com", ""), ("block", "a.com", ""), ("block", "b", "/")]
    rules += [("block", "com", ""), ("block", "com", "a.b"), ("block", "x1", "e")]
    rows = [(i, f"http://{host()}{path()}{rng.choice(['', '?q', '#/en'])}", None) for i in range(600)]
    # A host with a third of the rows.
    rows += [(i, f"http://b.a.com{path()}", None) for i in range(600, 900)]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = [tuple(r) for r in url_rules.judge_urls(pages(spark, rows), table).collect()]
    want = [(i, *brute_rule(u, rules)) for i, u, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert url_rules.judge_urls(pages(spark, rows), table.limit(0)).where("rule IS NULL").count() == 900


def test_plan_has_no_python(spark):
    prepare(spark)
    rules = spark.createDataFrame(url_rules.RULES, "verdict string, host string, path string")
    found = url_rules.judge_urls(read(spark, FOLDER, "pages"), rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- main text --------------------------------------------------------------------------------

ARTICLES = [
    ("<nav>menu</nav><article><h1>T &amp; x</h1><p>a\n b&nbsp;c</p></article>", "T & x a b c"),
    ("<main>one<br>two <b>bo</b>ld<aside>no</aside><p>three</main>tail", "one two bold three"),
    ("<article>x<script>var a='</p><article>';</script>y</article>", "x y"),
    ("<article>a<div class='share-bar comments'>no</div>b<form>no</form></article>", "a b"),
    ("<article>a<!-- no <p> -->b</article><div class=ad>no</div>", "ab"),
    ("<article>5 < 6 &lt;p&gt; <p title='a>b'>c</article>", "5 < 6 <p> c"),
    ("<div role=main>text<footer>no</footer></div>", "text"),
    ("<article>cut <p cla", "cut"),
    ("<article><p title='a class=ad hidden' data-class=\"ad\">kept</p></article>", "kept"),
    ("<article><p Class = ad>no</p><p HIDDEN>no</p><p aria-hidden='false'>yes</p></article>", "yes"),
    ("<nav><article>no</article></nav><article></article>", ""),
    ("<article hidden>no</article><article>yes<p hidden>no</p></article>", "yes"),
    ("<ARTICLE>Caps<STYLE>p{}</STYLE></ARTICLE>", "Caps"),
    ("<article><section id='main-comments'>no</section>ok<span aria-hidden=true>no</span>",
     "ok"),
]


@pytest.mark.parametrize(("page", "want"), ARTICLES)
def test_marked_articles(page, want):
    assert page_text.article_text(page) == want


MARKED_BY_NAMES = [
    ("<main class='site-main no-sidebar'>text</main>", "text"),
    ("<article class='post category-social comments-open'>text</article>", "text"),
    ("<div class='with-sidebar'><article>text<p class=ad-slot>no</p></article></div>", "text"),
    ("<div class=sidebar><article>text</article></div>", "text"),
    ("<div class=promo><div class=social><main id=notice>text</main></div></div>", "text"),
    ("<div role=main class='share with-sidebar'>text</div>", "text"),
    ("<article>the longer text</article><div class=sidebar><article>no</article></div>",
     "the longer text"),
    ("<article>a</article><div class=comments><article>a reader's long words</article></div>", "a"),
    ("<article>a<article class=comment>a reader's long words</article></article>", "a"),
    ("<nav><div class=social><article>no</article></div></nav><main>text</main>", "text"),
    ("<article><div class=search>no<div class=no-search>no</div></div>text</article>", "text"),
    ("<article><div class=topic-nav>no</div><div class=cat-menu>no</div>a<p class=tag-sidebar>no"
     "<p class=no-sidebar>b</article>", "a b"),
    ("<div class=category-social><p>open<article>a</article></div>", "a"),
    # Ends that HTML leaves out.
    ("<article>a<p class='ad'>no<p>b<p class=ad>no<div>c</div>d</article>", "a b c d"),
    ("<article><ul><li class='notice'>no<li>a<ul><li class=ad>no</ul>b<li>c</ul></article>",
     "a b c"),
    ("<main><dl><dt class=ad>no<dd>a<dt>b<dd class=ad>no<dt>c</dl></main>", "a b c"),
    ("<main><table><tr><td class=ad>no<td>a<tr class=ad><td>no<tr><td>b<table><tr><td class=ad>no"
     "</table>c</table>d</main>", "a b c d"),
    ("<main><p class=ad>no<table><tr><td>a</table></main>", "a"),
    ("<main><li class=ad><b>no</b><div><p>no</p></div><li>a</main>", "a"),
    ("<main>a<select><option class=ad>no<option>no</select>b</main>", "a b"),
]


@pytest.mark.parametrize(("page", "want"), MARKED_BY_NAMES)
def test_names_and_ends_left_out(page, want):
    assert page_text.article_text(page) == want


def test_deep_markup_is_read_in_one_pass():
    deep = "<div class=social>" * 50_000 + "<article>" * 50_000 + "text"
    assert page_text.article_text(deep) == "text"


def test_whole_table(spark):
    """The test pages have one template, which a few patterns can read."""
    import html

    table = read(spark, FOLDER, "pages")
    got = {r.page_id: (r.text, r.n_chars) for r in page_text.extract_text(table).collect()}
    for r in table.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.DOTALL)[1]
        cut = re.split(r"</?(?:h1|p|br)[^>]*>", re.sub(r"</?b>", "", inside))
        want = " ".join(" ".join(html.unescape(x).split()) for x in cut)
        want = " ".join(want.split())
        assert got[r.page_id] == (want, len(want))


def unmarked(host, n, menu="Home News Sport Weather Travel Money Health Video About Us"):
    body = " ".join(f"{host}{n}word{k}" for k in range(30))
    return f"<html><body><div>{menu}</div><div><p>{body}</p></div><div>{menu}</div></body>", body


def test_repeats_of_a_host_go_and_unique_runs_stay(spark):
    prepare(spark)
    rows, want = [], {}
    for n in range(40):
        host = "hot" if n < 30 else f"h{n // 5}"
        page, body = unmarked(host, n)
        rows.append((n, f"http://{host}.com/{n}", page))
        want[n] = body
    # Alone on its host: nothing repeats. Copies of one page do not empty each other.
    rows += [(100, "http://alone.com/", unmarked("alone", 0)[0])]
    page = "<p>copied page with enough different words to make a run of them here</p>"
    rows += [(101, "http://mirror.com/a", page), (102, "http://mirror.com/b", page)]
    # What another page of the host marks as a menu is one here too.
    rows += [
        (103, "http://mixed.com/a", "<nav>" + "Home News Sport Weather Travel Money Health Video"
         + "</nav><article>kept</article>"),
        (104, "http://mixed.com/b", "<div>Home News Sport Weather Travel Money Health Video</div>"
         "<div>text</div>"),
        (105, None, None), (106, "", ""), (None, "x", "<p>short</p>"),
    ]
    got = {r.page_id: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    for n, body in want.items():
        assert got[n] == body
    menu = "Home News Sport Weather Travel Money Health Video About Us"
    assert got[100].startswith(menu) and got[100].count(menu) == 2
    assert got[101] == got[102] and got[101].startswith("copied page")
    assert got[103] == "kept" and got[104] == "text"
    assert got[105] == got[106] == "" and got[None] == "short"
    assert len(got) == len(rows)


def test_near_copies_and_quotes_stay(spark):
    prepare(spark)
    menu = "Home News Sport Weather Travel Money Health Video About Us"
    first = [f"copy{k}" for k in range(40)]
    rows, want = [], {}

    def add(host, body, *, around="<div>{}</div>", more=""):
        n = len(rows)
        rows.append((n, f"http://{host}.com/{n}", around.format(body) + more))
        want[n] = " ".join(re.sub("<[^>]*>", " ", body).split())

    # Near copies, one word changed at either end or inside, without and with a menu on the host.
    for host, around in (("pair", "<p>{}</p>"), ("menu", f"<p>{menu}</p><p>{{}}</p><p>{menu}</p>")):
        for at in (5, 20, 39):
            add(host, " ".join([*first[:at], f"new{at}", *first[at + 1 :]]), around=around)
    for n in range(3):
        own = " ".join(f"page{n}word{k}" for k in range(40))
        add("menu", own, around=f"<p>{menu}</p><p>{{}}</p><p>{menu}</p>")
    # Different articles that quote the same passage.
    quote = " ".join(f"quoted{k}" for k in range(12))
    for n in range(2):
        own = " ".join(f"article{n}word{k}" for k in range(30))
        add("quote", f"<p>{own}</p><p>before{n} {own} {quote} after{n}</p>")
    # A menu of another page, and a comment of the same one, that hold words of the article.
    own = " ".join(f"told{k}" for k in range(30))
    add("told", f"<p>{own} end</p>", more=f"<nav>{own}</nav>")
    add("reader", f"<p>{own}</p><p>more</p>", more=f"<div class=comments><nav>x</nav>{own}</div>")
    got = {r.page_id: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert got == want


def test_quoted_pages_and_shared_paragraphs_stay(spark):
    """One article quoted by sixteen pages in stretches of twelve words, with a near copy or
    without, and a paragraph that two pages of a host share.
    """
    prepare(spark)
    rows, want = [], {}

    def add(host, *bodies):
        n = len(rows)
        rows.append((n, f"http://{host}.com/{n}", "".join(f"<p>{b}</p>" for b in bodies)))
        want[n] = " ".join(bodies)

    for host, copies in (("quoted", 1), ("twins", 2)):
        words = [f"{host}{k}" for k in range(160)]
        for n in range(copies):
            add(host, " ".join([*words[:80], *[f"copy{n}"] * n, *words[80:]]))
        for n in range(16):
            own = " ".join(f"{host}{n}own{k}" for k in range(30))
            add(host, own, f"said{n} " + " ".join(words[n * 9 : n * 9 + 12]), f"after{n} {own}")
    shared = " ".join(f"shared{k}" for k in range(100))
    for n in range(6):
        own = " ".join(f"body{n}own{k}" for k in range(50))
        add("paragraph", own, *[shared] * (n < 2))
    # All of a menu, in one long run, is gone where four pages hold it.
    menu = " ".join(f"menu{k}" for k in range(100))
    for n in range(4):
        add("menus", " ".join(f"page{n}own{k}" for k in range(50)))
        rows[-1] = (*rows[-1][:2], rows[-1][2] + f"<div>{menu}</div>")
    got = {r.page_id: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert got == want


def sweep(rows):
    """Texts of unmarked pages of one host without near copies, by plain search."""
    streams = {n: " ".join(found).split(" ") for n, found in rows}
    distinct = {" ".join(s) for s in streams.values() if len(s) >= 8}
    enough = min(4, len(distinct))

    def holders(run):
        return sum(f" {run} " in f" {s} " for s in distinct)

    texts = {}
    for n, found in rows:
        words, kept, at = streams[n], [], 0
        short = [False] * len(words)
        for i in range(len(words) - 7):
            number = holders(" ".join(words[i : i + 8]))
            if number > 1 and number >= enough:
                short[i : i + 8] = [True] * 8
        for block in found:
            size = len(block.split(" "))
            length = 8
            while 2 * length <= size // 2:
                length *= 2
            gone = [False] * len(words)
            for i in range(len(words) - length + 1):
                number = holders(" ".join(words[i : i + length]))
                if number > 1 and number >= enough:
                    gone[i : i + length] = [True] * length
            part = gone[at : at + size]
            if 2 * sum(part) < size:
                part = [False] * size
            if not all(short[at : at + size]):
                kept += [w for w, g in zip(words[at:], part, strict=False) if not g]
            at += size
        texts[n] = " ".join(kept)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_sweep_against_brute_force(spark, seed):
    prepare(spark)
    rng = random.Random(seed)
    passages = [" ".join(f"p{i}w{k}" for k in range(n)) for i, n in enumerate((3, 9, 20, 40, 70))]
    hosts = {}
    for host, n in (("a", 2), ("b", 3), ("c", 12)):
        for page in range(n):
            found = []
            for block in range(rng.randrange(1, 7)):
                # Own words at least double, so that no page is a near copy.
                own = " ".join(f"{host}{page}b{block}w{k}" for k in range(rng.randrange(30, 90)))
                part = rng.choice(passages).split(" ")
                begin = rng.randrange(len(part))
                part = " ".join(part[begin:]) if rng.random() < 0.3 else " ".join(part)
                found += [own, part] if rng.random() < 0.6 else [f"{own} {part}"]
            hosts.setdefault(host, []).append((f"{host}{page}", found))
    rows, want = [], {}
    for host, found in hosts.items():
        texts = sweep(found)
        for name, of_page in found:
            want[len(rows)] = texts[name]
            html = "".join(f"<p>{b}</p>" for b in of_page)
            rows.append((len(rows), f"http://{host}.org/{name}", html))
    got = {r.page_id: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert got == want


def test_lines_of_nearly_all_articles_go(spark):
    """Content is boilerplate on nine tenths of a host's pages only, and never most of a page."""
    prepare(spark)
    rows, want = [], {}
    for host, n, holding in (("most", 40, 36), ("less", 40, 35), ("small", 19, 19)):
        for page in range(n):
            own = " ".join(f"{host}{page}w{k}" for k in range(40))
            line = "<p>Share this story</p>" if page < holding else ""
            want[len(rows)] = own + (" Share this story" if line and host != "most" else "")
            rows.append((len(rows), f"http://{host}.com/", f"<article>{own}{line}</article>"))
    # A short page that is mostly that line, and equal pages, which count once.
    rows += [(len(rows), "http://most.com/s", "<article><p>Brief<p>Share this story</article>")]
    want[len(want)] = "Brief Share this story"
    for n in range(30):
        rows.append((len(rows), "http://copies.com/", "<article><p>All the same<p>text</article>"))
        want[len(want)] = "All the same text"
    got = {r.page_id: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert got == want


def test_runs_of_nearly_all_articles_go(spark):
    """Runs inside the blocks of marked articles, against a search of every run on every page."""
    prepare(spark)
    rng = random.Random(11)
    lines = {n: " ".join(f"line{n}w{k}" for k in range(n)) for n in (7, 8, 9, 14)}
    found = {}
    for host, n, shares in (("wide", 61, (1, 0.93, 0.9, 0.87)), ("few", 20, (0.95, 0.9, 0.85, 0.5)),
                            ("small", 19, (1, 1, 1, 1))):
        for number, share in zip(rng.sample(sorted(lines), 4), shares, strict=True):
            holding = set(rng.sample(range(n), round(share * n)))
            for page in range(n):
                own = [f"{host}{page}l{number}w{k}" for k in range(rng.randrange(70, 120))]
                at = rng.randrange(1, len(own))
                line = [lines[number]] if page in holding else []
                blocks = found.setdefault((host, page), [])
                blocks.append(" ".join(own[:at] + line + own[at:]))
    # Copies count once, and a short page that would lose too much stays whole.
    found |= {("wide", 61 + k): found["wide", 3] for k in range(30)}
    found["few", 20] = [f"brief {lines[9]}", lines[14]]
    want = {}
    for host in ("wide", "few", "small"):
        streams = {n: " ".join(b).split(" ") for (h, n), b in found.items() if h == host}
        distinct = {tuple(s) for s in streams.values()}
        held = {}
        for stream in distinct:
            for run in {stream[i : i + 8] for i in range(len(stream) - 7)}:
                held[run] = held.get(run, 0) + 1
        for n, stream in streams.items():
            gone = [False] * len(stream)
            for i in range(len(stream) - 7):
                if len(distinct) >= 20 and held[tuple(stream[i : i + 8])] >= 0.9 * len(distinct):
                    gone[i : i + 8] = [True] * 8
            if 5 * sum(gone) > len(stream):
                gone = [False] * len(stream)
            want[host, n] = " ".join(w for w, g in zip(stream, gone, strict=True) if not g)
    names = list(found)
    rows = [
        (i, f"http://{host}.com/{n}", "<article>" + "".join(f"<p>{b}</p>" for b in found[host, n]))
        for i, (host, n) in enumerate(names)
    ]
    got = {names[r.page_id]: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert got == want
    assert any(got[name] != " ".join(found[name]) for name in names if name[0] == "wide")
    assert any(got[name] != " ".join(found[name]) for name in names if name[0] == "few")


def test_many_near_copies_are_one_class(spark):
    """Links through the least stream of a bucket reach all of a large group."""
    prepare(spark)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for n in range(300):
        own = list(base)
        own[n % 60] = f"new{n}"
        rows.append((n, "http://hot.com/", f"<p>{' '.join(own)}</p>"))
    got = {r.page_id: r.text for r in page_text.extract_text(pages(spark, rows)).collect()}
    assert got == {n: page[3:-4] for n, _, page in rows}


# --- archives ---------------------------------------------------------------------------------


def archive_rows():
    rng = random.Random(9)
    big = "".join(rng.choices("aé漢\U0001f600\r\n <WARC/1.1>", k=50_000))
    return [
        (1, "http://a.com/x", big),
        (2, None, big),
        (3, "bad url\r\nWARC/1.1\r\n", big),
        (4, "u", None),
        (5, "u", ""),
        (6, "u", "é" * 499),
        (7, "u", "é" * 499),
        (8, "u", "é" * 500),
        (9, "u", "é" * 500),
        (9, "u", "é" * 500),
        (None, "u", "é" * 500),
        (None, "u", "n" * 2000),
        (None, "u", "n" * 2000),
        (10, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1"),
        (11, "u", "WARC/1.1\r\n" * 300),
        (12, "u", "x" * 1000 + "WARC/1.1"),
    ]


def brute_records(rows):
    found = []
    for page_id, _, payload in rows:
        data = (payload or "").encode()
        same = [i for i, _, p in rows if (p or "") == (payload or "") and i is not None]
        holder = max(same, default=None) if len(data) >= 1000 else None
        revisit = holder is not None and holder != page_id
        found.append(
            (
                page_id,
                len(data),
                hashlib.sha1(data).hexdigest(),
                "revisit" if revisit else "response",
                holder if revisit else None,
            )
        )
    return found


@pytest.mark.parametrize("chunk", [64, 1 << 18])
def test_archives_round_trip(spark, tmp_path, chunk):
    prepare(spark)
    rows = archive_rows()
    path = str(tmp_path / "warc")
    warc.write_archives(warc.chunk_table(pages(spark, rows).repartition(3), chunk_bytes=chunk), path)
    got = [tuple(r) for r in warc.read_records(spark, path).collect()]
    assert sorted(got, key=str) == sorted(brute_records(rows), key=str)

    chunks = warc.read_chunks(spark, path).collect()
    assert all(len(c.data.encode()) <= chunk for c in chunks)
    assert not any("WARC/1.1" in c.data for c in chunks)
    whole = "".join(c.data for c in sorted((c for c in chunks if c.id == 3), key=lambda c: c.chunk))
    assert whole == rows[2][2]


def test_a_changed_payload_is_noticed(spark, tmp_path):
    prepare(spark)
    path = str(tmp_path / "warc")
    table = warc.chunk_table(pages(spark, [(1, "u", "payload")]))
    warc.write_archives(table.selectExpr("*").replace("payload", "changed", "data"), path)
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_records(spark, path).collect()
