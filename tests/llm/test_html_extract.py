"""HTML extraction: structure, repeated text against brute force, broken markup."""
import random

import pytest
from pyspark.sql import functions as F

from marketlens.llm import html_extract

ARTICLE = [
    ("<body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>One &amp; two<br>three</p></article><footer>F</footer></body>", "Title One & two three"),
    ("<article><p>a <b>b</b>c</p>\n\n<p>d</p></article>", "a bc d"),
    ("<main><aside>side</aside><div class='comments'><p>nice!</p></div><p>body</p><form><input><button>go</button></form></main>", "body"),
    ("<article><script>var t='</p><p>x';</script><style>p{}</style><p>k<!-- no --> e p</p></article>", "k e p"),
    ("<article><header><h1>T</h1></header><p>x<div class=\"ad-box\">buy</div>y</p><footer>by me</footer></article>", "T x y"),
    ("<header>Site</header><article><p>only <p>open <b>tags", "only open tags"),
    ("<article><p>5 < 6 &lt;b&gt; &#233;&nbsp;&eacute; &unknown; &copy</p></article>", "5 < 6 <b> é é &unknown; ©"),
    ("<ARTICLE><P CLASS=lead>Up</P></ARTICLE><div class=sidebar>no</div>", "Up"),
    ("<article><div hidden>h</div><div style='display: none'>i</div><div role=alert>j</div><p>v</p></article>", "v"),
    ("<article><table><tr><td>1<td>2</table><ul><li>a<li>b</ul></article>", "1 2 a b"),
    ("<article><p title='a > b'>q</p><p>w</article><p>out</p>", "q w"),
    ("<article></article>", ""), ("", ""), (None, ""), ("<article><p>x</p><script>never closed <p>y</p>", "x"), ("<article>a</article><article>b</article>", "a b"),
    ("<article><p>s<span>p</span>an <img alt=z>i</p></article>", "span i"),
    # a quote opens a string only right after the equals sign
    ("<article><p title=Bob's>one two don't stop</p><p>three</p></article>", "one two don't stop three"),
    ("<article><p data-x = 'a>b' title=\"c>d\" checked value=e'f>one</p><img alt='>'><p>two</p></article>", "one two"),
    # furniture words count as whole words, with words that may stand beside them
    ("<article><div class='related-work'><p>Our text</p></div></article>", "Our text"),
    ("<article><div class='social-history'>a</div><div class=search-tips>b</div><div id=share>c</div><div class='lead navy'>d</div></article>", "a b c d"),
    ("<article>a<div class='comment-list'>x</div><div class=ad_container>y</div><div class='side-bar right'>z</div><div id=cookie-notice-2>w</div>b</article>", "a b"),
    ("<article>a<div class='share-buttons'><a href=x>Tweet</a> <a href=y>Mail</a></div><div class=related><a href=1>One</a></div>b</article>", "a b"),
    # one article a page; parts at least half as long belong to it, teasers and lists of links do not
    ("<article><p>main text of the page here</p></article><article><a href=x>Teaser</a></article><article>card two</article>", "main text of the page here"),
    ("<article><a href=1>long list</a> <a href=2>of links here</a></article><article>short</article>", "short"),
    ("<main><article>a b</article><article>c</article></main>", "a b c"),
    ("<article>the story itself</article><article class=comment>a reader says that the story is long</article>", "the story itself"),
]


@pytest.mark.parametrize("source,text", ARTICLE)
def test_articles(source, text):
    assert " ".join(t for t, _ in html_extract.read_page(source).article) == text


def brute_covered(streams, run, pages):
    """streams: {row: (host, page, tokens)} -> {row: positions covered by substrings of run or more tokens on enough pages}."""
    out = {}
    for row, (host, _, toks) in streams.items():
        gone = set()
        for i in range(len(toks) - run + 1):
            sub = toks[i:i + run]
            found = {p for h, p, t in streams.values() if h == host and any(t[j:j + run] == sub for j in range(len(t) - run + 1))}
            if len(found) >= pages:
                gone |= set(range(i, i + run))
        out[row] = gone
    return out


def test_repeated_runs_equal_brute_force(spark):
    rnd = random.Random(8)
    menu, foot = "home news sport weather mail".split(), "all rights reserved by us here".split()
    streams = {}
    for i in range(40):
        own = [f"w{rnd.randrange(60)}" for _ in range(rnd.randint(0, 25))]
        streams[i] = (f"h{i % 3}" if i else None, i // 2 if i < 10 else i, (menu if rnd.random() < 0.8 else []) + own + (foot if rnd.random() < 0.6 else []))
    rows = spark.createDataFrame([(r, h or "", p, False, t) for r, (h, p, t) in streams.items()], "row long, host string, page long, has_root boolean, tokens array<string>")
    got = {r["row"]: set(r["covered"]) for r in html_extract.repeated_runs(rows).collect()}
    want = brute_covered({r: (h or "", p, t) for r, (h, p, t) in streams.items()}, html_extract.RUN, html_extract.PAGES)
    assert got == {r: g for r, g in want.items() if g}


def test_pages_without_an_article_keep_unique_runs(spark):
    shell = "<body><div>Welcome to our lovely little site</div><div>{}</div><div>Call us at the office any day</div></body>"
    rows = [(i, f"http://a.example/{i}", shell.format(f"number{i} tells a story of thing{i}")) for i in range(5)]
    rows += [(9, "http://b.example:80/x", shell.format("lonely host")), (10, None, None), (11, "odd", "<p>plain</p>"), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame([(*r, "k", True) for r in rows], "page_id long, url string, html string, text string, has_root boolean")
    out = html_extract.extract(spark, pages)
    assert out.columns == ["page_id", "url", "text"]
    got = sorted((r["page_id"], r["text"]) for r in out.collect())
    assert got == sorted([(i, f"number{i} tells a story of thing{i}") for i in [0, 0, 1, 2, 3, 4]]
                         + [(9, "Welcome to our lovely little site lonely host Call us at the office any day"), (10, ""), (11, "plain")])


def test_runs_of_five_by_brute_force_with_a_share_of_pages(spark):
    rnd = random.Random(9)
    streams = {i: ("big" if i < 30 else "small", i, ["a b c d e f".split(), "p q r s t".split()][i % 7 == 0] + [f"w{rnd.randrange(40)}" for _ in range(12)]) for i in range(36)}
    rows = spark.createDataFrame([(r, h, p, False, t) for r, (h, p, t) in streams.items()], "row long, host string, page long, has_root boolean, tokens array<string>")
    got = {r["row"]: set(r["covered"]) for r in html_extract.repeated_runs(rows, 5, 3).collect()}
    big, small = ({r: s for r, s in streams.items() if s[0] == h} for h in ("big", "small"))
    want = {**brute_covered(big, 5, 6), **brute_covered(small, 5, 3)}
    assert got == {r: g for r, g in want.items() if g} and 0 not in got and 1 in got


def test_a_large_host_keeps_shared_phrases_and_passages(spark):
    rnd = random.Random(4)
    phrases = [[f"f{k}x{j}" for j in range(7)] for k in range(12)]
    passages = [[f"g{k}x{j}" for j in range(30)] for k in range(20)]
    rows, want = [], {}
    for i in range(300):
        parts = [[f"u{i}y{j}" for j in range(10)], phrases[i % 12], passages[i % 20], phrases[rnd.randrange(12)], [f"v{i}"]]
        body = want[i] = " ".join(w for part in parts for w in part)
        rows.append((i, f"http://big.example/{i}", f"<div>Home</div><div>News of the day</div><p>{body}</p><div>All rights reserved</div>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extract.extract(spark, pages).collect()} == want


def test_hosts_of_two_pages(spark):
    long = " ".join(f"w{i}" for i in range(30))
    shell = "<div>Home</div><div>News</div><p>{}</p><p>" + long + "</p><p>{}</p><div>Imprint</div>"
    rows = [(1, "http://a/1", shell.format("one", "two")), (2, "http://a/2", shell.format("three", "four")), (3, "http://a/2", shell.format("three", "four")),
            (4, "http://b/1", f"<div>Home</div><p>{long}</p><p>x</p>"), (5, "http://b/2", f"<div>Home</div><p>{long}</p><p>y</p>"),
            (6, "http://c/1", "<p>same</p>"), (7, "http://c/2", "<p>same</p> ")]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: f"one {long} two", 2: f"three {long} four", 3: f"three {long} four", 4: f"{long} x", 5: f"{long} y", 6: "same", 7: "same"}


def test_doubtful_blocks_go_where_the_host_repeats_them(spark):
    """Blocks named share, related and the like inside an article: the host's other pages decide."""
    page = "<article><p>story {0} goes on</p><div class='related'><p>{1}</p></div><p>end {0}</p></article>"
    rows = [(i, f"http://a.example/{i}", page.format(i, "Read more about us")) for i in range(6)]
    rows += [(6, "http://a.example/6", page.format(6, "unlike any other text")), (7, "http://b.example/", page.format(7, "Read more about us")),
             (8, None, page.format(8, "")), (0, rows[0][1], rows[0][2])]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {i: f"story {i} goes on end {i}" for i in range(6)}
    assert got == {**want, 6: "story 6 goes on unlike any other text end 6", 7: "story 7 goes on Read more about us end 7", 8: "story 8 goes on end 8"}


def test_every_host_is_searched_for_its_doubtful_blocks(spark):
    """All pages mark their article; what the host repeats beside its articles decides the doubtful blocks inside them."""
    long = " ".join(f"n{i}" for i in range(30))
    page = "<div>{0}</div><article><p>story {1} goes on</p><div class='related'><p>{2}</p></div></article><footer>{3}</footer>"
    rows = [(i, f"http://a.example/{i}", page.format("Read more about us", i, "", "Before " + long + " after")) for i in range(8)]
    rows += [(8, "http://a.example/8", page.format("x", 8, "Read more about us", "y")), (9, "http://a.example/9", page.format("x", 9, " ".join(long.split()[:25]), "y")),
             (10, "http://a.example/10", page.format("x", 10, long + " and more", "y")), (11, "http://a.example/11", page.format("x", 11, "Read more", "y")),
             (12, "http://a.example/12", page.format("x", 12, " ".join(long.split()[:11]), "y"))]
    # on two of twelve pages, its own among them, it is not repeated, and copies of a page count once
    rows += [(20 + i, f"http://b.example/{i}", page.format("Read more about us" if i < 1 else f"z{i}", 20 + i, "", "")) for i in range(11)]
    rows += [(20, "http://b.example/0", rows[13][2])] * 5 + [(31, "http://b.example/31", page.format("x", 31, "Read more about us", ""))]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    kept = {10: f" {long} and more", 11: " Read more", 12: " " + " ".join(long.split()[:11]), 31: " Read more about us"}
    assert got == {i: f"story {i} goes on{kept.get(i, '')}" for i in [*range(13), *range(20, 32)]}


def test_what_hosts_repeat_equals_brute_force(spark):
    rnd = random.Random(5)
    phrases = [[f"f{k}x{j}" for j in range(rnd.choice([1, 3, 12, 15]))] for k in range(8)]
    rows, texts = [], {}
    for i in range(60):
        host, page = f"h{i % 4}", i if i % 10 else 0
        if (host, page) not in texts:
            texts[host, page] = [[w for _ in range(rnd.randint(1, 2)) for w in rnd.choice(phrases)] for _ in range(rnd.randint(0, 4))], [rnd.choice(phrases) for _ in range(rnd.randint(0, 2))]
        blocks, asides = texts[host, page]
        rows.append((i, host, page, True, ["An article", *map(" ".join, asides)], [False, *[True for _ in asides]], [w for b in blocks for w in b], [len(b) for b in blocks]))
    found, size = {}, html_extract.RUN
    for (host, page), (blocks, asides) in texts.items():
        stream = [w for b in blocks for w in b]
        for piece in [*blocks, *asides, *[t[i:i + size] for t in [stream, *asides] for i in range(len(t) - size + 1)]]:
            found.setdefault((host, tuple(piece)), set()).add(page)
    needed = {h: max(html_extract.PAGES, -(-sum(host == h for host, _ in texts) // 5)) for h, _ in texts}
    want = [(h, list(piece)) for (h, piece), pages in found.items() if len(pages) >= needed[h]]
    prints = spark.createDataFrame(want, "host string, t array<string>").select("host", html_extract._print(F.col("t")).alias("prefix"))
    schema = "row long, host string, page long, has_root boolean, parts array<string>, doubtful array<boolean>, tokens array<string>, sizes array<int>"
    got = html_extract.host_repeats(spark.createDataFrame(rows, schema))
    assert sorted(map(str, got.collect())) == sorted(map(str, prints.collect())) and 0 < len(want) < len(found)


def test_a_host_of_one_page_loses_its_menu_and_copyright_line(spark):
    html = "<div><a href=1>Home</a> <a href=2>News</a></div><ul><li><a href=3>Contact</a><li><a href=4>Jobs</a></ul><p>Unique story with <a href=5>a link</a>.</p>" \
           "<p><a href=6>One link alone</a></p><div>Copyright 2020 all rights reserved</div>"
    got = html_extract.extract(spark, spark.createDataFrame([(1, "http://one/", html)], "page_id long, url string, html string")).first()["text"]
    assert got == "Unique story with a link. One link alone"


def test_a_host_overrules_a_teaser_card_marked_as_an_article(spark):
    """The longer text beside a marked article is the main text, unless the host repeats it or structure marks it."""
    story = [" ".join(f"s{i}w{j}" for j in range(25)) for i in range(6)]
    notice = " ".join(f"n{j}" for j in range(20))
    page = "<div>Home</div><div><h1>Head {0}</h1><p>{1}</p></div><p>{2}</p>{3}"
    card = "<article><h3>Teaser of another story</h3></article>"
    rows = [(i, f"http://a.example/{i}", page.format(i, story[i], notice, card)) for i in range(5)]
    # beside this article there is only what the host repeats; here the article is the longer one; and here an advert is beside it
    rows += [(5, "http://a.example/5", f"<div>Home</div><p>{notice}</p><article><p>A short story</p></article>"),
             (6, "http://b.example/1", f"<article><p>{story[5]}</p></article><p>Seen beside</p>"),
             (7, "http://b.example/2", f"<article>Short</article><div class=ad>{story[5]}</div>"),
             (8, "http://a.example/8", f"<p>{notice}</p><article>Old<div class=related><p>Unlike others</p></div></article>"),
             (9, "http://c.example/", "<article>Brief news</article><p>Some few words more beside it</p>"), (0, rows[0][1], rows[0][2])]
    got = sorted((r["page_id"], r["text"]) for r in html_extract.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    want = [(i, f"Head {i} {story[i]}") for i in [0, 0, 1, 2, 3, 4]]
    assert got == want + [(5, "A short story"), (6, story[5]), (7, "Short"), (8, "Old Unlike others"), (9, "Brief news")]


def test_long_page_and_empty_table(spark):
    long = "<article>" + "<p>word &amp; more</p>" * 20000 + "</article>"
    pages = spark.createDataFrame([(1, "http://a/", long)], "page_id long, url string, html string")
    assert html_extract.extract(spark, pages).first()["text"] == " ".join(["word & more"] * 20000)
    assert html_extract.extract(spark, pages.where("page_id < 0")).count() == 0
