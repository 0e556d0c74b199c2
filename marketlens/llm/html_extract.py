"""HTML extraction: page structure and a host suffix array of repeated text.

A page is read once into blocks of text. Blocks inside its article (``article`` or ``main``) are the
main text, less the menus, notices, forms, comments and the like that lie inside. Of several articles beside each other the longest
is the page's, with those at least half as long; shorter ones and lists of links are teasers. Class, id and role words mark
furniture only as whole words (``ad-box``, not ``related-work``). Words that also name content (``share``, ``related``, ``search``) leave it to the host's
other pages: such a block goes if it is all links, or repeated on the host, there or beside the articles, whole or by runs that cover it.

A marked article is not taken on trust: where the text beside it that structure does not mark as furniture is longer, and a paragraph
or more, the host's repetitions decide. What they leave of that text is the main text if that still holds; the article is then a teaser card.

Pages that mark no article get theirs from repetition: the token streams of all text outside articles, and the doubtful blocks inside, are taken
together per host, of every host and page; whole blocks and substrings of RUN or more tokens are boilerplate where they
occur on PAGES distinct pages of the host and on at least SHARE of its pages, and the runs of tokens
that they leave uncovered are kept. So a phrase, or a passage that a few of a large host's pages share, stays.
A host of two pages has the equal short blocks (under PARAGRAPH tokens) at the beginning and at the end of both as
boilerplate; a host of one page shows no repetition. What structure marks, menus (several links and no other text) and
short copyright lines go on every host.

The suffix array is distributed: the suffixes of a host are put in order by their first RUN tokens (128 bits of hash stand for them), and
equal ones are the runs of the sorted suffixes whose common prefix is RUN or longer. Every
repeated substring of RUN or more tokens is covered by such prefixes, wherever its pages lie, so
a host with a third of all pages is neither gathered in one task nor cut into parts that miss
repeats. Pages count as distinct by their html, so copies of a page do not erase it.

Defined results: null html counts as empty; pages without text give an empty string; a null or
odd url belongs to the host of null; repeated rows give equal results; an empty table gives no
rows; further columns are ignored.
"""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Tokens in the shortest substring that counts as repeated (more than a phrase), and the distinct pages, in number
#: and as a share of the host's, that make it, or a whole block, boilerplate.
RUN, PAGES, SHARE = 12, 3, 0.2
#: Tokens from which a block is a paragraph, which two pages of a host may share.
PARAGRAPH = 20
_PIECES = "array<struct<pos: int, n: int, prefix: struct<hi: bigint, lo: bigint>>>"

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CHROME = frozenset("head nav footer aside form button select menu dialog template svg object canvas audio video fieldset".split())
ROOTS = frozenset(("article", "main"))
# Class, id and role words of page furniture; those that also name content; and words that may stand beside them.
FURNITURE = frozenset("""ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert
    sidebar comment comments replies disqus menu menus nav navbar navigation breadcrumb breadcrumbs foot footer masthead newsletter subscribe subscription
    popup modal pagination pager toolbar login signup contentinfo complementary""".split())
DOUBTFUL = frozenset("share sharing social related recommended search skip widget overlay".split())
BESIDE = frozenset("""box section list container wrapper wrap area block bar button buttons link links post posts item items story stories form field icon icons
    site page top bottom left right side inner outer main primary secondary sticky fixed text title header heading body content small large main reader user message""".split())
_JOINED = re.compile(r"\b(side|pop|bread)[-_](bar|up|crumbs?)\b")
HEADERS = frozenset("header head topbar".split())
NOT_ARTICLES = frozenset("ad ads advert advertisement sponsored promo comment comments replies reply".split())
_COPYRIGHT = re.compile(r"(?:^|\s)(?:©|\(c\)|copyright\b)|\ball rights reserved\b", re.I)
# An attribute: a quote opens a string only right after the equals sign.
_ONE_ATTR = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+"""
_ATTR = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?+""")
_MARKUP = re.compile(rf"""<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|{_ONE_ATTR})*+)>|<[!?/][^>]*>""", re.S)
_OPEN_COMMENT = re.compile(r"<!--.*(/?)()()\Z", re.S)
_CELL = frozenset("td th li dt dd p option tr".split())


@dataclass
class Page:
    """Blocks of one page in order: (text, doubtful) of the article, and text outside it with whether structure marks it as furniture."""
    has_root: bool = False
    article: list[tuple[str, bool]] = field(default_factory=list)
    outside: list[tuple[str, bool]] = field(default_factory=list)


KEEP, CLASS_WORD, DOUBT, TAG = range(4)


def _named(token: str, in_root: bool) -> int:
    """What one class, id or role word says: all its parts are furniture words or stand beside them."""
    parts = [p for p in re.split(r"[-_]+|\d+", _JOINED.sub(r"\1\2", token.lower())) if p]
    known = FURNITURE if in_root else FURNITURE | HEADERS
    if not all(p in known or p in DOUBTFUL or p in BESIDE for p in parts):
        return KEEP
    return CLASS_WORD if any(p in known for p in parts) else DOUBT if any(p in DOUBTFUL for p in parts) else KEEP


def _furniture(name: str, attrs: str, in_root: bool) -> int:
    if name in CHROME or (name == "header" and not in_root):
        return TAG
    if not attrs or name in ("html", "body"):
        return KEEP
    found = set()
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role"):
            if name in ROOTS and not in_root:  # a page's own article may be named after anything else
                found |= {CLASS_WORD for token in value.lower().split() if token in NOT_ARTICLES}
            else:
                found |= {_named(token, in_root) for token in value.split()}
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return TAG
    return next((kind for kind in (CLASS_WORD, DOUBT) if kind in found), KEEP)


def read_page(source: str | None) -> Page:
    """One pass over the markup; unclosed and stray tags are tolerated as browsers do."""
    page, stack, buffer = Page(), [], []  # stack: (name, kind of furniture, root); buffer: (text, number of the link it is in)
    open_ = [0, 0, 0, 0]  # elements open of each kind
    roots = links = link = 0
    found: list[list[tuple[str, int, int]]] = []  # of each outermost root: its blocks as (text, kind, links if there is no other text)
    outside: list[tuple[str, int, int]] = []
    source = source or ""
    at, end = 0, len(source)

    def flush() -> None:
        if not buffer:
            return
        text = " ".join("".join(t for t, _ in buffer).split())
        inside = {no for t, no in buffer if t.strip()}
        buffer.clear()
        if text:
            kind = TAG if open_[TAG] else CLASS_WORD if open_[CLASS_WORD] else DOUBT if open_[DOUBT] else KEEP
            (found[-1] if roots and found else outside).append((text, kind, 0 if 0 in inside else len(inside)))

    def leave(gone: list) -> None:
        nonlocal roots, links
        for name, kind, root in gone:
            open_[kind] -= kind != KEEP
            roots -= root
            links -= name == "a"

    last = source.rfind(">")
    while at < end:
        # without a closing bracket ahead only an open comment can still be markup
        m = _MARKUP.search(source, at) if at <= last else _OPEN_COMMENT.search(source, at)
        if m is None:
            buffer.append((entities.unescape(source[at:]), link if links else 0))
            break
        if m.start() > at:
            buffer.append((entities.unescape(source[at:m.start()]), link if links else 0))
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # closing tag
            if name not in INLINE:
                flush()
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                if any(k or r for _, k, r in stack[depth:]):
                    flush()
                leave(stack[depth:])
                del stack[depth:]
            continue
        if name in RAW:
            flush() if name not in INLINE else None
            if not m[3].rstrip().endswith("/") or name in ("script", "style", "textarea", "title"):
                close = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
            continue
        if name not in INLINE:
            flush()
        if name in VOID or (m[3].endswith("/") and name not in ROOTS and name not in CHROME and name not in ("div", "p", "section", "span", "a")):
            if name == "br":
                buffer.append((" ", link if links else 0))
            continue
        if name in _CELL and stack and stack[-1][0] == name and not stack[-1][1]:
            stack.pop()
        kind, root = _furniture(name, m[3], roots > 0), name in ROOTS
        if kind or root:
            flush()
        stack.append((name, kind, root))
        open_[kind] += kind != KEEP
        if root and not roots and not open_[TAG] and not open_[CLASS_WORD]:
            found.append([])
            page.has_root = True
        roots += root
        if name == "a":
            links, link = links + 1, link + 1
    flush()
    _choose(page, found)
    for i, (text, kind, linked) in enumerate(outside):
        menu = linked > 1 or linked and (i > 0 and outside[i - 1][2] or i + 1 < len(outside) and outside[i + 1][2])
        page.outside.append((text, bool(kind in (TAG, CLASS_WORD) or menu or (len(text.split(" ")) < PARAGRAPH and _COPYRIGHT.search(text)))))
    return page


def _choose(page: Page, found: list[list[tuple[str, int, int]]]) -> None:
    """The article's blocks: of the longest root, and of those half as long that are not all links."""
    roots = [[(t, k == DOUBT) for t, k, linked in blocks if k == KEEP or (k == DOUBT and not linked)] for blocks in found]
    teaser = [all(linked for _, k, linked in blocks if k == KEEP) for blocks in found]
    sizes = [sum(len(t.split(" ")) for t, _ in blocks) for blocks in roots]
    longest = max(range(len(roots)), key=lambda i: (not teaser[i], sizes[i]), default=0)
    for i, blocks in enumerate(roots):
        if i == longest or (2 * sizes[i] >= sizes[longest] and not teaser[i]):
            page.article += blocks


def parsed(pages: DataFrame) -> DataFrame:
    """Rows row, page_id, url, host, page (hash of the html), has_root (an article that the unmarked text beside it does
    not put in doubt), parts and doubtful (blocks of the article), own (its tokens), tokens and furniture (of the text outside), and sizes (tokens of each of its blocks)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    src = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", host.alias("host"), F.xxhash64("html").alias("page"),
                       common.text_or_empty("html").alias("html"))
    kinds = {c: src.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    names = ["row", "page_id", "url", "host", "page", "has_root", "parts", "doubtful", "own", "tokens", "furniture", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [read_page(h) for h in b.column(5).to_pylist()]
            tokens = [[w for text, _ in p.outside for w in text.split(" ")] for p in got]
            marks = [[f for text, f in p.outside for _ in text.split(" ")] for p in got]
            own = [sum(t.count(" ") + 1 for t, _ in p.article) for p in got]
            yield pa.RecordBatch.from_arrays([
                *(b.column(i) for i in range(5)), pa.array([p.has_root and len(m) - sum(m) < max(n + 1, PARAGRAPH) for p, n, m in zip(got, own, marks)], pa.bool_()),
                pa.array([[t for t, _ in p.article] for p in got], pa.list_(pa.string())), pa.array([[d for _, d in p.article] for p in got], pa.list_(pa.bool_())),
                pa.array(own, pa.int32()),
                pa.array(tokens, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.bool_())),
                pa.array([[text.count(" ") + 1 for text, _ in p.outside] for p in got], pa.list_(pa.int32()))], names=names)

    return src.mapInArrow(run, f"row long, page_id {kinds['page_id']}, url {kinds['url']}, host string, page long, has_root boolean, "
                               "parts array<string>, doubtful array<boolean>, own int, tokens array<string>, furniture array<boolean>, sizes array<int>")


def _print(tokens: Column) -> Column:
    """128 bits that stand for an array of tokens."""
    return F.struct(F.xxhash64(tokens).alias("hi"), F.xxhash64(F.lit(1), tokens).alias("lo"))


def _runs(tokens: Column, run: int) -> Column:
    """Structs pos, n, prefix of the suffixes' first ``run`` tokens."""
    return F.when(F.size(tokens) >= run, F.transform(
        F.sequence(F.lit(0), F.size(tokens) - run),
        lambda i: F.struct(i.alias("pos"), F.lit(run).alias("n"), _print(F.slice(tokens, i + 1, run)).alias("prefix")))).otherwise(F.array().cast(_PIECES))


def _blocks() -> Column:
    """Structs pos, n, prefix (128 bits of its tokens) of every block, in order."""
    ends = F.aggregate("sizes", F.array().cast("array<int>"), lambda a, n: F.concat(a, F.array(F.coalesce(F.element_at(F.when(F.size(a) > 0, a), -1), F.lit(0)) + n)))
    return F.transform(F.arrays_zip(ends.alias("end"), F.col("sizes").alias("n")), lambda b: F.struct(
        (b["end"] - b["n"]).alias("pos"), b["n"].alias("n"), _print(F.slice("tokens", b["end"] - b["n"] + 1, b["n"])).alias("prefix")))


def _of_block(words: Column, run: int) -> Column:
    """As ``_blocks``, of one block alone: the whole of it, and its runs."""
    whole = F.struct(F.lit(0).alias("pos"), F.size(words).alias("n"), _print(words).alias("prefix"))
    return F.concat(F.array(whole), _runs(words, run))


def _asides() -> Column:
    """The tokens of each doubtful block of the article."""
    return F.transform(F.filter(F.arrays_zip("parts", "doubtful"), lambda b: b["doubtful"]), lambda b: F.split(b["parts"], " "))


def repeated_pieces(rows: DataFrame, pieces: Column, used: Sequence[str | Column], pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """Rows host, prefix: the ``pieces`` (prefixes, of the columns ``used``) that stand on enough distinct pages of the host: ``pages`` of them, and ``share`` of all.

    A page speaks once, and for each of its pieces once: what repeats is counted before it is moved."""
    once = rows.select("host", "page", *used).dropDuplicates(["host", "page"])
    needed = rows.select("host", "page").distinct().groupBy("host").agg(F.greatest(F.lit(pages), F.ceil(F.count("*") * F.lit(share))).cast("long").alias("needed"))
    return (once.select("host", F.explode(F.array_distinct(pieces)).alias("prefix")).groupBy("host", "prefix").agg(F.count("*").alias("pages"))
            .where(F.col("pages") >= pages).join(needed, "host").where("pages >= needed").select("host", "prefix"))


def _covered(flat: DataFrame, repeated: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows key, covered: the token positions in the pieces of ``flat`` (host, pos, n, prefix) that are among the ``repeated``."""
    hits = flat.join(repeated, ["host", "prefix"], "left_semi")
    places = F.transform(F.collect_set(F.struct("pos", "n")), lambda p: F.sequence(p["pos"], p["pos"] + p["n"] - 1))
    return hits.groupBy(*key).agg(F.array_distinct(F.flatten(places)).alias("covered"))


def _prefixes(pieces: Column) -> Column:
    return F.transform(pieces, lambda x: x["prefix"])


def host_repeats(rows: DataFrame, run: int = RUN, pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """Rows host, prefix: the runs and whole blocks that every host repeats, of all text outside its pages' articles and
    of the doubtful blocks inside them."""
    asides = F.flatten(F.transform("asides", lambda words: _prefixes(_of_block(words, run))))
    outside = F.concat(_prefixes(_runs(F.col("tokens"), run)), _prefixes(_blocks()))
    return repeated_pieces(rows, F.concat(outside, asides), ["tokens", "sizes", _asides().alias("asides")], pages, share)


def repeated_runs(rows: DataFrame, run: int = RUN, pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """Rows row, covered: the token positions that substrings of ``run`` or more tokens cover which are repeated on ``pages``
    distinct pages, and on ``share`` of all, of the host, for rows without an article. ``rows`` needs row, host, page, has_root and tokens."""
    runs = _runs(F.col("tokens"), run)
    return _covered(rows.where("not has_root").select("row", "host", F.inline(runs)), repeated_pieces(rows, _prefixes(runs), ["tokens"], pages, share), ["row"])


def repeated_outside(rows: DataFrame, repeated: DataFrame, run: int = RUN) -> DataFrame:
    """Rows row, covered: the token positions outside articles that the runs and whole blocks ``repeated`` cover, for rows without an article."""
    flat = rows.where("not has_root").select("row", "host", F.inline(F.concat(_runs(F.col("tokens"), run), _blocks())))
    return _covered(flat, repeated, ["row"])


def shared_ends(rows: DataFrame) -> DataFrame:
    """Rows row, covered: the short blocks with which both pages of a host of two pages begin, and those with which both end.
    Pages of equal blocks, and a page's paragraphs, are not covered."""
    two = rows.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages")).where("pages = 2").select("host")
    own = rows.join(two, "host", "left_semi").select("row", "host", "page", "has_root", _blocks().alias("blocks"))
    other = own.select("host", F.col("page").alias("other_page"), F.col("blocks").alias("other")).dropDuplicates(["host", "other_page"])
    both = own.where("not has_root").join(other, "host").where("page <> other_page")

    def alike(a: Column, b: Column) -> Column:
        """Blocks before the first that differs or is a paragraph."""
        same = F.zip_with(a, b, lambda x, y: F.coalesce((x["prefix"] == y["prefix"]) & (x["n"] < PARAGRAPH), F.lit(False)))
        stop = F.array_position(same, False).cast("int")
        return F.when(stop > 0, stop - 1).otherwise(F.size(same))

    differ = F.transform("blocks", lambda x: x["prefix"]) != F.transform("other", lambda x: x["prefix"])
    both = both.where(differ).withColumn("first", alike(F.col("blocks"), F.col("other"))).withColumn("last", alike(F.reverse("blocks"), F.reverse("other")))
    cut = F.filter("blocks", lambda x, i: (i < F.col("first")) | (i >= F.size("blocks") - F.col("last")))
    return both.select("row", F.flatten(F.transform(cut, lambda x: F.sequence(x["pos"], x["pos"] + x["n"] - 1))).alias("covered"))


def repeated_doubtful(rows: DataFrame, repeated: DataFrame, run: int = RUN) -> DataFrame:
    """Rows row, gone: the places among an article's ``parts`` of doubtful blocks of which the host repeats the whole, or runs that cover it."""
    blocks = rows.select("row", "host", F.posexplode(F.arrays_zip("parts", "doubtful")).alias("place", "b")).where("b.doubtful")
    flat = blocks.select("row", "host", "place", F.split("b.parts", " ").alias("words"))
    flat = flat.select("row", "host", "place", F.size("words").alias("size"), F.inline(_of_block(F.col("words"), run)))
    gone = _covered(flat, repeated, ["row", "place", "size"]).where(F.size("covered") == F.col("size"))
    return gone.groupBy("row").agg(F.collect_set("place").alias("gone"))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Rows page_id, url, text: the main text of every page."""
    common.small_batches(spark)
    rows = common.materialize(spark, parsed(pages))
    # every host is searched, whatever its pages mark; what it repeats is few, and read by both that follow
    repeated = common.materialize(spark, host_repeats(rows))
    covered = repeated_outside(rows, repeated).union(shared_ends(rows)).groupBy("row").agg(F.flatten(F.collect_list("covered")).alias("covered"))
    places = F.when(F.size("tokens") > 0, F.sequence(F.lit(0), F.size("tokens") - 1)).otherwise(F.array().cast("array<int>"))
    unique = F.filter(F.array_except(places, F.coalesce("covered", F.array().cast("array<int>"))), lambda i: ~F.get("furniture", i))
    rest = F.array_join(F.transform(unique, lambda i: F.get("tokens", i)), " ")
    kept = F.when(F.col("gone").isNull(), F.col("parts")).otherwise(F.filter("parts", lambda x, i: ~F.array_contains("gone", i)))
    # only articles with doubtful blocks are moved to meet what goes of them
    doubtful = F.exists("doubtful", lambda x: x)
    plain = rows.where(F.col("has_root") & ~doubtful).select("page_id", "url", F.array_join("parts", " ").alias("text"))
    asked = rows.where(~F.col("has_root") | doubtful).join(covered, "row", "left").join(repeated_doubtful(rows, repeated), "row", "left")
    found = F.when(~F.col("has_root") & (F.size(unique) >= F.when(F.col("own") > 0, F.greatest(F.col("own") + 1, F.lit(PARAGRAPH))).otherwise(0)), rest).otherwise(F.array_join(kept, " "))
    return plain.union(asked.select("page_id", "url", found.alias("text")))
