"""Page text: hand-made pages, the tables' articles, and differencing against plain alignment."""

import bisect
import html
import random
import re

import pytest
from ledgerloom.llm.pages import REST, candidates, common, main_text

CASES = [
    ("<html><body><nav>Menu</nav><article><h1>T &amp; x</h1><p>One<br>two  <b>three</b><p>Four</article><footer>f</footer></body>", ["T & x", "One two three", "Four"]),
    ("<main><div class='ad'>buy</div><header><h1>Head</h1></header><p>a&nbsp;&#233;&lt;b&gt;</p><aside>side</aside><div id=comments><p>hi</p></div></main>", ["Head", "a é<b>"]),
    ("<article><p>x <script>var t='</p>';</script>y</p><style>p{}</style><form><p>name</p></form><!-- c --><ul><li>1<li>2</ul></article>", ["x y", "1", "2"]),
    ("<article><p>shaded leader adapt</p><div class='header-image shadow'>k</div><div class='cookie-banner'>c</div></article>", ["shaded leader adapt", "k"]),
    ('<article><div class="post-header"><h1>Title</h1></div><div class="related-work">w</div><p id="notice-board">n</p><div class="related-posts">r</div><p class="notice">x</p></article>', ["Title", "w", "n"]),
    ("<article><p>a &am<b>p;</b> b &amp; c &lt;i&gt;</p></article>", ["a &amp; b & c <i>"]), ("<article><p>one <span class='ad'>buy</span> two <a class=share href=x>tell</a></p></article>", ["one two"]),
    ("<article><div class='badge load'>kept</div>tail 1 < 2</article>", ["kept", "tail 1 < 2"]),
    ("<article></article>", []), ("", []), ("plain text", ["plain text"]), ("<p>a<p>b<table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]), ("<article><p><b>Bold<br><p>Next</p></article>", ["Bold", "Next"]),
]


@pytest.mark.parametrize("page,want", CASES)
def test_blocks(page, want):
    assert [t for t, k in candidates(page)[0] if k != REST] == want


def test_common_is_longest():
    rng = random.Random(0)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        got = common(a, b)
        assert len(got) == t[-1][-1] and got == sorted(set(got))
        it = iter(b)
        assert all(any(x == y for y in it) for x in (a[i] for i in got))


def test_tables_articles(spark):
    d = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in main_text(spark.read.parquet(f"{d}/pages.parquet")).collect()}
    rows = spark.read.parquet(f"{d}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        a = re.search("<article>(.*)</article>", r.html, re.S)[1]
        x = re.sub("<br>|</?b>", " ", re.sub("</?(p|h1)>", "\n\n", a))
        want = "\n\n".join(y for y in (" ".join(html.unescape(z).split()) for z in x.split("\n\n")) if y)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_differencing(spark):
    page = lambda *x: "".join(f"<p>{y}</p>" for y in x)
    rows = [
        (1, "http://h.example/a/1", page("Top", "own one", "Links", "End")),
        (2, "http://h.example/a/2?x=1", page("Top", "own two", "more", "Links", "End")),
        (3, "http://h.example/b/3", page("Top", "own three", "End")),
        (4, "http://other.example/a/1", page("Top", "own one", "End")),
        (5, "http://h.example/a/1", "<article>" + page("Top", "kept") + "</article>"),
        (None, None, page("null url")), (7, "http://x.example/", None), (8, "http://x.example/", ""), (9, "http://y.example/q", page("same")), (9, "http://y.example/q", page("same")),
    ]
    want = [(1, "own one\n\nLinks"), (2, "own two\n\nmore\n\nLinks"), (3, "own three"), (4, "Top\n\nown one\n\nEnd"), (5, "Top\n\nkept"), (-1, "null url"), (7, ""), (8, ""), (9, "same"), (9, "same")]
    for parts in (1, 5):
        df = spark.createDataFrame([(*r, 3) for r in rows], "page_id long, url string, html string, mark int").repartition(parts)
        got = main_text(df).collect()
        assert sorted((-1 if r.page_id is None else r.page_id, r.text) for r in got) == sorted(want)
        assert all(r.n_chars == len(r.text) for r in got)
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_copies_keep_their_text(spark):
    page = lambda *x: "".join(f"<p>{y}</p>" for y in x)
    body = [f"par {k}" for k in range(9)]
    rows = [
        (1, "http://h.example/a", page("Top", "own one", "End")), (2, "http://h.example/a?x=1", page("Top", "own one", "End")), (3, "http://h.example/b", page("Top", "own one", "End")),
        (4, "http://h.example/c", page("Top", "own two", "End")), (5, "http://i.example/a", page("same", "text")), (6, "http://i.example/b", page("same", "text")),
        (7, "http://j.example/a", page(*body, "old")), (8, "http://j.example/b", page(*body, "new")),
    ]
    whole = "\n\n".join(body)
    want = {1: "own one", 2: "own one", 3: "own one", 4: "own two", 5: "same\n\ntext", 6: "same\n\ntext", 7: f"{whole}\n\nold", 8: f"{whole}\n\nnew"}
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        assert {r.page_id: r.text for r in main_text(df).collect()} == want


def test_differencing_decides_inside_articles(spark):
    """A block whose class only in part names furniture goes where it recurs at its place, and stays where it doesn't; what
    articles share under plain elements stays."""
    rows = [(k, f"http://h.example/{k}", f"<nav>m</nav><article><div class='post-header'><h1>Title {k}</h1></div><p>shared by all</p><p>own {k}</p><div class='read-also-related'>See our guide</div></article>") for k in range(6)]
    rows += [(10 + k, f"http://h.example/x{k}", f"<div>m</div><div><p>Own text {k} of a page without an article</p></div><div>See our guide</div>") for k in range(4)]
    for parts in (1, 4):
        got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)).collect()}
        assert got == {k: f"Title {k}\n\nshared by all\n\nown {k}" for k in range(6)} | {10 + k: f"Own text {k} of a page without an article" for k in range(4)}


@pytest.mark.parametrize("bare", [("article",), ("article", "h1")])
def test_tables_without_article_tags(spark, bare):
    """The table with its article tags made plain: at least 0.95 of the pages still give the article, block by block."""
    d = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{d}/pages.parquet")
    want = {r.page_id: r.text for r in main_text(pages).collect()}
    plain = "html"
    for tag in bare:
        plain = f"regexp_replace({plain}, '<(/?){tag}>', '<$1div>')"
    got = {r.page_id: r.text for r in main_text(pages.selectExpr("page_id", "url", f"{plain} AS html")).collect()}
    right = sum(got[i] == t for i, t in want.items())
    print("right", right, "of", len(want))
    assert right >= 0.95 * len(want)


def test_very_long_pages():
    """Pages of tens of thousands of lines are aligned in memory that grows with them; deep and unclosed markup is no trap."""
    import tracemalloc

    rng = random.Random(2)
    a, b = ([rng.randrange(10_000) for _ in range(6_000)] for _ in range(2))
    tracemalloc.start()
    got = common(a, b)
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()
    it, where, ends = iter(b), {}, []
    for j, y in enumerate(b):
        where.setdefault(y, []).append(j)
    for x in a:  # the length of the longest, by increasing runs of matching places
        for j in reversed(where.get(x, [])):
            k = bisect.bisect_left(ends, j)
            ends[k : k + 1] = [j]
    assert len(got) == len(ends) and all(any(x == y for y in it) for x in (a[i] for i in got))
    page = "<div>" * 50_000 + "x" + "</p></b></i>" * 20_000 + "<p>" * 20_000 + "<article>" + "".join(f"<p>line {k}" for k in range(60_000))
    assert len([t for t, k in candidates(page)[0] if k != REST]) == 60_000


def test_many_pages_over_borders(spark):
    """Pairs across the borders of partitions, empty ones between them included, give what one partition gives."""
    rows = [(k, f"http://h.example/{k // 40}/{k % 40:02d}", f"<div>Top</div><p>own text of page {k}</p><div>End {k % 3}</div>") for k in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = []
    for n in ("1", "7", "40"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append({r.page_id: r.text for r in main_text(df).collect()})
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2] and all(t.startswith("own") for t in got[0].values())
