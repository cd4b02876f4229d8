"""Main text of web pages: repeats across a host, with markup saying how much a repeat tells.

A page is a stream of blocks of tokens. The streams of a host's pages are laid end to end and
their suffixes sorted into the buckets of a suffix array: suffixes of several pages in one bucket
are a run of tokens that these pages hold. Boilerplate goes, unique runs stay. What markup says of
a block decides which suffixes it has and how many pages make it boilerplate.

*Content*, which lies in an article or main element, repeats in copied articles too, so only what
nearly the whole host holds is boilerplate there: ``TEMPLATE`` of the different pages of a host of
``TEMPLATE_PAGES`` or more. Every suffix counts, keyed by its first ``RUN`` tokens, wherever in a
block it begins, and runs are as long as the suffixes next to each other are held so widely. A
suffix at the start of a block counts with the whole block too, however short that is. What is
boilerplate goes, unless more than a fifth of the page's words would go: such a page is a copy of
the others and stays whole. A run that all but ``m`` of a host's pages hold is on all but ``m`` of
larger number of them, so the suffixes of half as many again are sorted first. Those that a third of
these pages hold, the candidates, are then looked for on all of the host's, so nothing is lost by it.

*Open* blocks are all of a page without any article or main element, apart from what its markup
rules out. Every suffix counts, keyed by its first ``RUN`` tokens and by those of every doubled
length up to the end of the stream. Tokens are boilerplate if a run covers them that ``HOLDERS``
different pages hold (all pages, on a host of fewer). A run counts for a block if it is at least
as long as the greatest of these lengths that is no more than half the block, and takes words only
where such runs cover half of the block or more; so a paragraph quoted in many short pieces stays,
and so does a block that only quotes. An open block that lies wholly in runs that markup puts
outside the article on any page of the host goes too, except where these are readers' words, which
may quote the article. On a page with an article, open blocks are outside of it and left out.

*Out* is what lies in menus, headers, footers, sidebars, adverts, forms and the like: it never
stays, and is evidence against open blocks.

The buckets are Spark's groups of (host, key), with pages counted on the map side. No host, however
hot, and no bucket meets in one task, and a run is found wherever its pages lie. Pages of equal
streams count as one page, and so do near copies among the open ones, so that copies of a page do
not empty each other. Near copies are found from the buckets as well: every page of a bucket is
paired with the least and the greatest one, pairs of fitting lengths are compared whole, and those
that share all but a fifth of their words, or but ``RUN`` words, are joined to classes.

Null and empty html has an empty text. Broken markup never fails: unclosed elements end where HTML
ends them (a paragraph at the next block, an item at the next one) or with their parents, an unfinished tag or comment ends with the page. Pages of null urls, and of urls
without a host, count as one host. Long pages are read whole. An empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stakeline.llm.common import mix, sized
from stakeline.llm.components import connected_components
from stakeline.llm.url_rules import url_host
from stakeline.sources.sinks import stage_table

# Tokens a run needs to count as repeated.
RUN = 8
# Near copies differ in one word of so many at most.
NEAR = 5
# Different pages that make a run of open blocks boilerplate, or all of a host with fewer.
HOLDERS = 4
# Share of a host's different pages, and least number of them, that make a block of content
# boilerplate; a page loses one word of so many that way at most.
TEMPLATE, TEMPLATE_PAGES, TEMPLATE_WORDS = 0.9, 20, 5
# Parts into which the pages of a host are dealt, some of which are sorted first.
PARTS = 64
# Hosts with such blocks or runs; lists of more are not broadcast.
TEMPLATE_HOSTS = 100_000

# Elements whose content is never text of the page.
RAW = frozenset(["script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"])
HIDDEN = frozenset(
    ["head", "noscript", "template", "svg", "math", "object", "canvas", "audio", "video", "map"]
)
# Elements that are not the article.
ASIDE = frozenset(
    ["nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "label"]
    + ["fieldset", "datalist", "output", "input", "option"]
)
# Elements that vouch for their content.
ARTICLE = frozenset(["article", "main"])
# Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements without content, and those around everything.
ROOT = frozenset(["html", "body"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id or role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar"
    " navigation menu breadcrumb breadcrumbs sidebar side aside footer foot header masthead"
    " topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay dialog"
    " comment comments reply replies respond disqus share sharing social related recommended"
    " newsletter subscribe subscription signup login search searchbox widget pagination pager"
    " complementary contentinfo skip".split()
)
# Attributes that say what an element is.
MARKING = frozenset(["class", "id", "role", "hidden", "aria-hidden"])
# Words that mark the article where no element does.
ARTICLE_WORDS = frozenset(["article", "main"])
# Words after which a name still means its thing ("ad-slot").
PLACE_WORDS = frozenset(
    "area articles bar block body bottom box button buttons col column container content count form"
    " group holder icon icons inner item items label line link links list media message next outer"
    " panel posts previous row section slot stories this title top unit wrap wrapper zone".split()
)
# Words of names that only tell about a thing ("no-sidebar").
TELLING_WORDS = frozenset("no not non without with has have hide hides by".split())
# Words that name what an article is about ("category-social"); inside of it, a
# thing may be called so too ("topic-nav").
TOPIC_WORDS = frozenset("category categories cat tag tags topic format type".split())
# Words that mark an article element as a reader's.
READER_WORDS = frozenset("comment comments reply replies respond disqus".split())

# Elements whose start ends an open paragraph.
_PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext"
    " pre search section summary table ul xmp".split()
)
# Elements that open ones outside of them are not ended from.
_BOUNDS = frozenset("applet button caption html marquee object table td template th".split())
# Elements whose start ends an open one of these, up to a bound.
_ENDED = {
    **dict.fromkeys(["dt", "dd"], frozenset(["dt", "dd"])),
    "li": frozenset(["li"]),
    "option": frozenset(["option"]),
    "optgroup": frozenset(["option", "optgroup"]),
    **dict.fromkeys(["td", "th"], frozenset(["td", "th", "caption"])),
    "tr": frozenset(["tr", "td", "th", "caption"]),
    **dict.fromkeys(
        ["tbody", "thead", "tfoot"],
        frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]),
    ),
}
_ENDED_BOUNDS = frozenset(["table", "select", "datalist"])
_ITEMS = frozenset(["li", "dt", "dd"])
_IN_ITEMS = INLINE | frozenset(["address", "div", "p"])

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.DOTALL)
# The rest of a tag; quotes may hold its end, unless they are never closed.
_REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_REST = re.compile(r"([^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.ASCII
)
_WORDS = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s+")

# Readers' words are out too.
CONTENT, OPEN, OUT, NEVER, READERS = 0, 1, 2, 3, 4


def _names_aside(name: str, inside: bool) -> bool:
    """Whether a class, id or role means something beside the article.

    A name means what its last word says, places aside: main-comments and ad-slot do, no-sidebar
    and comments-open do not, and category-social does only inside the article.
    """
    words = _WORDS.findall(name)
    if not TELLING_WORDS.isdisjoint(words) or not inside and not TOPIC_WORDS.isdisjoint(words):
        return False
    while len(words) > 1 and words[-1] in PLACE_WORDS:
        words.pop()
    return bool(words) and words[-1] in ASIDE_WORDS


def _marked(attributes: str, inside: bool) -> tuple[int | None, bool]:
    """What class, id and role say of an element that lies inside the article or not, and whether
    they name a reader's words.
    """
    names, found = [], None
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in MARKING:
            continue
        value = "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return NEVER, False
        if name == "aria-hidden":
            continue
        names += value.split()
        if name == "role" and not ARTICLE_WORDS.isdisjoint(value.split()):
            found = CONTENT
    aside = [n for n in names if _names_aside(n, inside)]
    readers = any(not READER_WORDS.isdisjoint(_WORDS.findall(n)) for n in aside)
    return OUT if aside and (found is None or readers) else found, readers


class _Element(NamedTuple):
    name: str
    state: int
    # Numbers of the elements around it, itself included, that a class, id or role rules out, as
    # pairs of the innermost and the rest.
    ruled: tuple | None
    # Whether it is out for a reason that an article inside does not change.
    fixed: bool


def _ended_by(name: str, stack: list[_Element], opened: Counter[str]) -> int | None:
    """Place on the stack of the outermost element that the start of ``name`` ends."""
    found = None
    ends = _ENDED.get(name, ())
    if any(opened[e] for e in ends):
        for i in range(len(stack) - 1, -1, -1):
            own = stack[i].name
            if own in ends:
                found = i
                if name in _ITEMS:
                    break
            elif own in _ENDED_BOUNDS or name in _ITEMS and own not in _IN_ITEMS:
                break
    if name in _PARAGRAPH_ENDS and opened["p"]:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name == "p":
                return i if found is None else min(found, i)
            if stack[i].name in _BOUNDS:
                break
    return found


def _parse(
    page: str, lifted: frozenset[int]
) -> tuple[bool, list[tuple[int, str]], set[int], set[int]]:
    """Marked or not, blocks, and the numbers of elements that are out by a name and hold a main
    element, or an article. Names do not rule the ``lifted`` elements out.
    """
    found: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[_Element] = []
    opened: Counter[str] = Counter()
    around_main: set[int] = set()
    around_article: set[int] = set()
    state, at, number, has_article = OPEN, 0, 0, False

    def end_block() -> None:
        if parts:
            text = _WHITE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text and state != NEVER:
                found.append((state, text))

    def end_elements(depth: int) -> None:
        nonlocal state
        after = stack[depth - 1].state if depth else OPEN
        if after != state:
            end_block()
        opened.subtract(e.name for e in stack[depth:])
        del stack[depth:]
        state = after

    while tag := _TAG.search(page, at):
        if tag.start() > at:
            parts.append(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue  # comments and declarations
        closing, name = tag[1], tag[2].lower()
        rest = _REST.match(page, at) or _PLAIN_REST.match(page, at)
        attributes, at = rest[1], rest.end()
        if name not in INLINE:
            end_block()
        if closing:
            if opened[name]:
                end_elements(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name))
            continue
        if name in _PARAGRAPH_ENDS or name in _ENDED:
            depth = _ended_by(name, stack, opened)
            if depth is not None:
                end_elements(depth)
        if name in RAW:
            # Ends at its own closing tag only.
            close = _closing(name).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in VOID or name in ROOT or attributes.endswith("/"):
            continue
        number += 1
        mark, readers = _marked(attributes, state == CONTENT) if attributes else (None, False)
        if mark == OUT and not readers and (name in ARTICLE or number in lifted):
            mark = None
        vouched = mark != OUT and name in ARTICLE or mark == CONTENT
        own = state
        ruled, fixed = (stack[-1].ruled, stack[-1].fixed) if stack else (None, False)
        if name in HIDDEN or mark == NEVER:
            own, fixed = NEVER, True
        elif state != NEVER and (mark == OUT or name in ASIDE):
            own = READERS if readers or state == READERS else OUT
            if readers or name in ASIDE or state == CONTENT and opened["article"]:
                fixed = True
            else:
                ruled = (number, ruled)
        elif state == OPEN and vouched:
            own, has_article = CONTENT, True
        elif state == OUT and vouched and not fixed:
            wrappers = around_main if name == "main" or mark == CONTENT else around_article
            around = ruled
            while around is not None and around[0] not in wrappers:
                wrappers.add(around[0])
                around = around[1]
        if own != state:
            end_block()
        stack.append(_Element(name, own, ruled, fixed))
        opened[name] += 1
        state = own
    parts.append(page[at:])
    end_block()
    return has_article, found, around_main, around_article


def _content_size(found: list[tuple[int, str]]) -> int:
    return sum(len(text) for kind, text in found if kind == CONTENT)


def blocks(page: str) -> tuple[bool, list[tuple[int, str]]]:
    """Whether the page marks an article; class and text of each block, in order.

    What lies in something that is out stays out; an article element inside open markup is
    content. A class, id or role rules out neither a main or article element, except a reader's
    comment, nor what holds a main element, nor what holds most of the page's article text.
    """
    has_article, found, around_main, around_article = _parse(page, frozenset())
    lifted = frozenset(around_main)
    if around_main:
        has_article, found, _, around_article = _parse(page, lifted)
    if around_article:
        whole = _parse(page, lifted | around_article)
        if _content_size(whole[1]) > 2 * _content_size(found):
            has_article, found = whole[:2]
    return has_article, found


@cache
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE)


def article_text(page: str) -> str | None:
    """The text of the marked article, or null on a page that marks none."""
    has_article, found = blocks(page)
    return " ".join(t for kind, t in found if kind == CONTENT) if has_article else None


# --- repeats across a host --------------------------------------------------------------------


def _suffix_keys(words: list[str], deep: bool = True) -> list[np.ndarray]:
    """Keys of the suffixes of a stream of words: hashes of their first RUN words, and by doubling
    of their first 2 RUN, 4 RUN and so on, as far as the stream reaches if ``deep``.
    """
    n = len(words) - RUN + 1
    if n < 1:
        return []
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(RUN):
        keys = mix(keys * np.uint64(31) + hashes[k : k + n])
    found, length = [keys], RUN
    while deep and len(keys) > length:
        keys = mix(keys[:-length] * np.uint64(31) + keys[length:] + np.uint64(length))
        found.append(keys)
        length *= 2
    return found


def _run_level(n: int) -> int:
    """How often RUN is doubled in the length of the runs that count for a block of n words."""
    return max((n // (2 * RUN)).bit_length() - 1, 0)


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


KEYS_DDL = "row bigint, host string, level int, place int, suffix bigint, stream bigint"
SCAN_DDL = (
    "id bigint, url string, host string, page bigint, keys array<bigint>, content array<string>,"
    " opened array<string>"
)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its name, its blocks of content and their keys, or its open blocks."""
    for rows in batches:
        pages, keys, contents, opened = [], [], [], []
        for page in rows[3].to_pylist():
            has_article, found = blocks(page or "")
            content = [text for kind, text in found if kind == CONTENT]
            pages.append(_key("\n".join(content)) if has_article else None)
            keys.append(sorted({_key(text) for text in content}) if has_article else None)
            contents.append(content if has_article else None)
            opened.append(None if has_article else [t for kind, t in found if kind == OPEN])
        yield pa.RecordBatch.from_arrays(
            [
                *rows.columns[:3],
                pa.array(pages, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(contents, pa.list_(pa.string())),
                pa.array(opened, pa.list_(pa.string())),
            ],
            names=["id", "url", "host", "page", "keys", "content", "opened"],
        )


def _content_runs(content: list[str]) -> np.ndarray:
    """Keys of all suffixes of a page's content, by place."""
    keys = _suffix_keys(" ".join(content).split(" "), deep=False)
    return keys[0].view(np.int64) if keys else np.empty(0, np.int64)


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different suffix keys of the content of each page."""
    for rows in batches:
        for host, content in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            keys = np.unique(_content_runs(content))
            yield pa.RecordBatch.from_arrays(
                [pa.array([host] * len(keys), pa.string()), pa.array(keys)], names=["host", "suffix"]
            )


def _found_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates of its host that each page holds."""
    for rows in batches:
        for host, page, content, wanted in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            keys = np.intersect1d(_content_runs(content), np.array(wanted, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([host] * len(keys), pa.string()),
                    pa.array([page] * len(keys), pa.int64()),
                    pa.array(keys),
                ],
                names=["host", "page", "suffix"],
            )


def _without(content: list[str], boilerplate: list[int], runs: list[int]) -> str:
    """Text of the content without the host's boilerplate, unless the page would lose too much."""
    text = " ".join(content)
    if not boilerplate and not runs:
        return text
    words, blocks_gone = text.split(" "), set(boilerplate)
    places = np.flatnonzero(np.isin(_content_runs(content), np.array(runs, np.int64)))
    gone, at = _covered(len(words), places.tolist(), RUN), 0
    for block in content:
        end = at + block.count(" ") + 1
        if _key(block) in blocks_gone:
            gone[at:end] = True
        at = end
    if TEMPLATE_WORDS * int(gone.sum()) > len(words):
        return text
    return " ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the pages that mark an article."""
    for rows in batches:
        found = zip(*(c.to_pylist() for c in rows.columns[2:]), strict=True)
        texts = [_without(content, gone or [], runs or []) for content, gone, runs in found]
        yield pa.RecordBatch.from_arrays(
            [rows[0], rows[1], pa.array(texts, pa.string())], names=["id", "url", "text"]
        )


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per suffix and length of the streams of open blocks."""
    for rows in batches:
        for row, host, of_page in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            text = " ".join(of_page)
            stream = _key(f"{host}\n{text}")
            for level, keys in enumerate(_suffix_keys(text.split(" "))):
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * n, pa.int64()),
                        pa.array([host] * n, pa.string()),
                        pa.array([level] * n, pa.int32()),
                        pa.array(range(n), pa.int32()),
                        pa.array(keys.view(np.int64)),
                        pa.array([stream] * n, pa.int64()),
                    ],
                    names=["row", "host", "level", "place", "suffix", "stream"],
                )


def _out_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffix keys of what markup puts outside the article, as evidence."""
    for rows in batches:
        for host, page in zip(rows[0].to_pylist(), rows[1].to_pylist(), strict=True):
            for kind, text in blocks(page or "")[1]:
                if kind == OUT:
                    for keys in _suffix_keys(text.split(" "), deep=False):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([host] * len(keys), pa.string()), pa.array(keys.view(np.int64))],
                            names=["host", "suffix"],
                        )


def _covered(n: int, places: list[int], length: int) -> np.ndarray:
    """Which of n words lie in the runs of that length that begin at these places."""
    step = np.zeros(n + 1, np.int64)
    if places:
        step[np.array(places)] += 1
        step[np.array(places) + length] -= 1
    return np.cumsum(step)[:-1] > 0


def _unique_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open blocks without those that runs cover, and without the repeats that are half of one."""
    for rows in batches:
        texts = []
        for of_page, repeats, runs in zip(*(c.to_pylist() for c in rows.columns[2:]), strict=True):
            words = " ".join(of_page).split(" ")
            at_level: dict[int, list[int]] = {}
            for repeat in repeats or ():
                at_level.setdefault(repeat["level"], []).append(repeat["place"])
            repeated = {k: _covered(len(words), p, RUN << k) for k, p in at_level.items()}
            covered = _covered(len(words), runs or [], RUN)
            kept, at = [], 0
            for block in of_page:
                end = at + block.count(" ") + 1
                level = _run_level(end - at)
                gone = repeated[level][at:end] if level in repeated else np.zeros(end - at, bool)
                if 2 * gone.sum() < end - at:
                    gone = np.zeros(end - at, bool)
                if not covered[at:end].all():
                    kept += [w for w, g in zip(words[at:end], gone, strict=True) if not g]
                at = end
            texts.append(" ".join(kept))
        yield pa.RecordBatch.from_arrays(
            [rows[0], rows[1], pa.array(texts, pa.string())], names=["id", "url", "text"]
        )


def _host_sizes(marked: DataFrame) -> DataFrame:
    """One row per host of enough different pages: how many make something boilerplate there
    (``need``), the last of the ``PARTS`` that are sorted first, and on how many of their pages a
    candidate is (``least``).
    """
    parts = (
        marked.select("host", "page")
        .distinct()
        .groupBy("host", F.pmod("page", F.lit(PARTS)).cast("int").alias("part"))
        .agg(F.count(F.lit(1)).alias("held"))
    )
    # At most PARTS rows of a host.
    of_host = Window.partitionBy("host")
    so_far = of_host.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = parts.withColumn("pages", F.sum("held").over(of_host)).withColumn(
        "before", F.sum("held").over(so_far) - F.col("held")
    )
    need = F.ceil(F.lit(TEMPLATE) * F.col("pages")).cast("bigint")
    missing = F.col("pages") - F.col("need")
    return (
        sums.where(F.col("pages") >= TEMPLATE_PAGES)
        .withColumn("need", need)
        .where(F.col("before") < missing + F.greatest(F.ceil(missing / 2), F.lit(2)))
        .groupBy(F.col("host").alias("__host"), "need")
        .agg(
            F.max("part").alias("last_part"),
            (F.sum("held") - (F.max("pages") - F.col("need"))).alias("least"),
        )
    )


def _template(scanned: DataFrame) -> DataFrame:
    """One row per host that has some: the keys of the blocks and of the runs of content that it
    has nearly everywhere. Those of blocks are at most 1 / TEMPLATE times the blocks of a page in
    the mean, those of runs as many times its words; candidates are three times its words at most.
    """
    marked = scanned.where("page IS NOT NULL")
    hosts = sized(stage_table(_host_sizes(marked), "host_sizes"))
    here = F.col("host") == F.col("__host")
    whole = (
        marked.select("host", "page", "keys")
        .distinct()
        .select("host", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("held"))
        .where(F.col("held") >= TEMPLATE * TEMPLATE_PAGES)
        .join(hosts, here)
        .where("held >= need")
        .select("host", "key", F.lit(True).alias("whole"))
    )
    # One row of each different page, so that texts do not move.
    first = (
        marked.join(hosts, here)
        .where(F.pmod("page", F.lit(PARTS)) <= F.col("last_part"))
        .groupBy("host", "page")
        .agg(F.min("row").alias("row"))
        .select("row")
    )
    candidates = (
        marked.join(sized(first), "row", "left_semi")
        .select("host", "content")
        .mapInArrow(_run_batches, "host string, suffix bigint")
        .groupBy("host", "suffix")
        .agg(F.count(F.lit(1)).alias("held"))
        .join(hosts, here)
        .where("held >= least")
        .groupBy("__host")
        .agg(F.collect_list("suffix").alias("wanted"))
    )
    candidates = stage_table(candidates, "candidate_runs")
    runs = (
        marked.join(sized(candidates, TEMPLATE_HOSTS), here)
        .select("host", "page", "content", "wanted")
        .mapInArrow(_found_batches, "host string, page bigint, suffix bigint")
        .distinct()
        .groupBy("host", "suffix")
        .agg(F.count(F.lit(1)).alias("held"))
        .join(hosts, here)
        .where("held >= need")
        .select("host", F.col("suffix").alias("key"), F.lit(False).alias("whole"))
    )
    return (
        whole.unionByName(runs)
        .groupBy(F.col("host").alias("__host"))
        .agg(
            F.collect_list(F.when(F.col("whole"), F.col("key"))).alias("boilerplate"),
            F.collect_list(F.when(~F.col("whole"), F.col("key"))).alias("runs"),
        )
    )


def _classes(keyed: DataFrame) -> DataFrame:
    """One row (node, component) per stream that has near copies on its host.

    A key leads a stream to two others at most, so the pairs grow with the keys however many
    copies there are.
    """
    keys = stage_table(
        keyed.where("level = 0").select("host", "suffix", "stream", "place").distinct(),
        "stream_keys",
    )
    buckets = stage_table(
        keys.groupBy("host", "suffix")
        .agg(F.min("stream").alias("least"), F.max("stream").alias("greatest"))
        .where("least <> greatest")
        .select("host", "suffix", F.array("least", "greatest").alias("ends")),
        "shared_keys",
    )
    sizes = keys.groupBy("stream").agg((F.max("place") + RUN).alias("words"))
    longer = F.greatest("a_words", "b_words")
    allowed = F.greatest(F.lit(RUN), F.floor(longer / NEAR))
    pairs = stage_table(
        keys.join(buckets, ["host", "suffix"])
        .select(F.col("stream").alias("a"), F.explode("ends").alias("b"))
        .where("a <> b")
        .distinct()
        .join(sizes.select(F.col("stream").alias("a"), F.col("words").alias("a_words")), "a")
        .join(sizes.select(F.col("stream").alias("b"), F.col("words").alias("b_words")), "b")
        .where(longer - F.least("a_words", "b_words") <= allowed)
        .select("a", "b", longer.alias("longer"), allowed.alias("allowed")),
        "pairs",
    )
    # Words of a that runs of b cover: a run adds the words up to the next one, RUN at most.
    words = F.expr(
        f"""aggregate(sort_array(collect_set(place)), struct(0 AS n, 0 AS end), (s, p) -> struct(
        s.n + p + {RUN} - greatest(s.end, p) AS n, p + {RUN} AS end), s -> s.n)"""
    )
    near = (
        pairs.join(keys.select(F.col("stream").alias("a"), "suffix", "place"), "a")
        .join(keys.select(F.col("stream").alias("b"), "suffix"), ["b", "suffix"], "left_semi")
        .groupBy("a", "b", "longer", "allowed")
        .agg(words.alias("words"))
        .where("longer - words <= allowed")
    )
    return connected_components(near.select("a", "b"))


def _unique_runs(pages: DataFrame, opened: DataFrame) -> DataFrame:
    """Texts of the pages that mark no article."""
    keyed = opened.select("row", "host", "opened").mapInArrow(_key_batches, KEYS_DDL)
    keyed = stage_table(keyed, "suffixes")
    hosts = opened.select("host").distinct()
    outside = (
        pages.select("host", "html")
        .join(sized(hosts), "host", "left_semi")
        .mapInArrow(_out_batches, "host string, suffix bigint")
        # One occurrence is enough, but covers whole blocks only.
        .select("host", F.lit(0).alias("level"), "suffix", F.lit(None).cast("bigint").alias("class"))
    )
    # Streams without a near copy, or shorter than any run, are classes of their own.
    classes = _classes(keyed).withColumnRenamed("node", "stream")
    held = keyed.join(classes, "stream", "left").select(
        "host", "level", "suffix", F.coalesce("component", "stream").alias("class")
    )
    few = (
        held.where("level = 0")
        .select("host", "class")
        .distinct()
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") < HOLDERS)
    )
    held = (
        held.unionByName(outside)
        .distinct()
        .groupBy("host", "level", "suffix")
        .agg(
            F.count("class").alias("holders"),
            F.max(F.col("class").isNull()).alias("outside"),
        )
        .where("holders > 1 OR outside AND holders > 0")
        .join(sized(few), "host", "left")
        .withColumn(
            "repeated",
            (F.col("holders") > 1) & (F.col("holders") >= F.coalesce("pages", F.lit(HOLDERS))),
        )
        .where("repeated OR outside")
        .select("host", "level", "suffix", "repeated")
    )
    # Stored, so that the join can be split where a run is on very many pages.
    held = stage_table(held, "held_runs")
    covered = (
        keyed.join(held, ["host", "level", "suffix"])
        .groupBy("row")
        .agg(
            F.collect_set(F.when(F.col("repeated"), F.struct("level", "place"))).alias("repeats"),
            F.collect_set(F.when(F.col("level") == 0, F.col("place"))).alias("runs"),
        )
    )
    return (
        opened.join(covered, "row", "left")
        .select("id", "url", "opened", "repeats", "runs")
        .mapInArrow(_unique_batches, "id bigint, url string, text string")
    )


def extract_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """One row per page: id, url, text, n_chars.

    One scan parses the pages and writes their blocks to the shared folder; the sweep and the
    texts come from these. Other columns are not read.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("id"),
        F.col(url).alias("url"),
        url_host(F.col(url)).alias("host"),
        F.col(payload).alias("html"),
    )
    scanned = rows.mapInArrow(_scan_batches, SCAN_DDL)
    scanned = stage_table(scanned.withColumn("row", F.monotonically_increasing_id()), "page_blocks")
    template = stage_table(_template(scanned), "template")
    texts = (
        scanned.where("page IS NOT NULL")
        .join(sized(template, TEMPLATE_HOSTS), F.col("host") == F.col("__host"), "left")
        .select("id", "url", "content", "boilerplate", "runs")
        .mapInArrow(_text_batches, "id bigint, url string, text string")
    )
    opened = scanned.where("opened IS NOT NULL")
    if not opened.isEmpty():
        opened = opened.select("id", "url", "host", "opened")
        opened = opened.withColumn("row", F.monotonically_increasing_id())
        texts = texts.unionByName(_unique_runs(rows, stage_table(opened, "open_pages")))
    return texts.select(
        F.col("id").alias(page_id),
        F.col("url").alias(url),
        "text",
        F.char_length("text").cast("bigint").alias("n_chars"),
    )
