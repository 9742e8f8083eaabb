"""Main text of web pages: a suffix array per host finds what pages repeat, and page structure protects the article.

A page is read once into blocks, each inside the article, in doubt there (its
markup only hints at furniture), in marked content, open, or outside. The words of
all blocks but those of an article that nothing rivals, in page order with a mark
between blocks, are the page's token stream. The streams of a host, end to end,
are searched for long substrings that distinct pages repeat. In this order: blocks
that repeated runs cover are put aside; what they leave decides which marked part
is the main one; of that part article text stays whole, and content, hints and
open text lose what was put aside; what is left over and unique goes where markup
puts it outside.

The suffix array is made by prefix doubling, as in its classic construction, and
cut off at depth 8: a suffix's name comes from the names of its two halves, so
suffixes of a host with equal names are neighbours in the array with at least 8
common tokens. A repeated substring of k tokens begins a chain of k - 7 repeated
names, so the chains are the maximal repeated runs of any length from 8 on, and
deeper names would cover no other token. Counting distinct pages per name is a
partially aggregated groupBy, so a host with a third of all pages is never in one
task.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import as_texts, bounded_batches, stored

#: Tokens of the shortest repeated substring; a power of two, as names are doubled.
DEPTH = 8
#: A repeated substring is boilerplate from so many distinct pages of a host on, however many pages the host has.
MIN_PAGES = 3
#: In what markup marks as article or content, where distinct pages also share lines of their own, it must be on more than this share of the host's distinct pages.
MARKED_SHARE = 0.5
#: The share of an open block that boilerplate must cover to remove it.
COVERED = 0.8

# What markup says about a part of a page.
NO_TEXT = frozenset("script style template noscript svg math canvas object iframe embed audio video head title textarea xmp noframes".split())
RAW_TEXT = frozenset("script style title textarea xmp iframe noframes noembed".split())
FURNITURE = frozenset("nav footer aside form button select option datalist dialog menu input label fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adbox adslot adsense adsbygoogle banner sponsor sponsored sponsors promo
    promos promotion nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer sidebar sidebars aside widget widgets related
    recommended recommendations share sharing social newsletter subscribe subscription signup cookie cookies consent gdpr notice notices popup
    modal overlay form search login pagination pager skip copyright toolbar alert alerts announcement disclaimer""".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond feedback".split())
#: Words that say nothing beside one of the above; with any other word beside it, such a word is only a hint.
NEUTRAL_WORDS = frozenset(
    """area bar block body bottom box buttons container content footer global group header holder inner item items js left link links list main
    module outer page panel post right row section site slot thread top unit wrap wrapper""".split()
)
#: Words of furniture that holds articles of its own, which are teasers or reader comments.
TEASING_WORDS = COMMENT_WORDS | frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adbox adslot adsense adsbygoogle sponsor sponsored sponsors promo promos
    promotion sidebar sidebars aside widget widgets related recommended recommendations footer""".split()
)
#: Words that are only a hint inside an article, where they also name parts of it.
HINTS_INSIDE = frozenset("alert alerts form related search share social widget widgets announcement disclaimer".split())
OUTER_WORDS = frozenset("header headers heading top".split())
CONTENT_WORDS = frozenset("content article post entry story maintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hr html legend li main menu nav ol option p pre section select summary table tbody tfoot thead tr ul""".split()
)
CELLS = frozenset("td th".split())
ITEMS = frozenset("li dd dt tr option".split())
LISTS = frozenset("ul ol dl table select menu".split())

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_QUOTE = re.compile("[\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_INVISIBLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_ASCII_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_ENDS = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW_TEXT}

#: What structure says of a block; HINT: in an article, but its markup hints at furniture.
ARTICLE, CONTENT, OPEN, CHROME, HINT = "a", "c", "o", "x", "h"
#: Furniture by the name of a wrapper alone. What is marked in such a wrapper has the capital letter of its kind.
NAMED = "n"
MARKED = (ARTICLE, HINT, CONTENT)


def _says(attributes: str, name: str, inside: bool) -> str | None:
    """CHROME, NAMED, HINT, ARTICLE, CONTENT or nothing, from a start tag; ``inside``: in an article already.

    NAMED is furniture by the name of a wrapper; whether it closes off what lies
    in it is decided when the page has been read.
    """
    if name in ("html", "body"):
        return None
    if "=" not in attributes and "hidden" not in attributes.lower():
        return CHROME if name in FURNITURE or name == "header" and not inside else ARTICLE if name == "article" else CONTENT if name == "main" and not inside else None
    tokens: list[set[str]] = []
    role, hidden = "", False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key in ("class", "id"):
            tokens += [set(_WORDS.findall(_ASCII_CAMEL.sub(" ", t).lower())) for t in value.split()]
        elif key == "role":
            role = value.lower()
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _INVISIBLE.search(value):
            hidden = True
    words = set().union(*tokens)
    furniture = FURNITURE_WORDS | COMMENT_WORDS
    if name == "article" or role == "article":
        # a comment is named as one; an article that has comments isn't
        comment = any(t & COMMENT_WORDS and (inside or t <= furniture | NEUTRAL_WORDS) for t in tokens)
        return CHROME if hidden or comment else ARTICLE
    if hidden or name in FURNITURE or role in FURNITURE_ROLES:
        return CHROME
    if not inside and (name == "main" or role == "main"):
        return CONTENT
    if not inside and name == "header":
        return CHROME
    closing = CHROME if inside or name in LISTS or words & TEASING_WORDS else NAMED
    if not inside and words & OUTER_WORDS:
        return closing
    named = [t for t in tokens if t & furniture]
    if any(t <= furniture | NEUTRAL_WORDS and not (inside and t & furniture <= HINTS_INSIDE) for t in named):
        return closing
    if named and inside:
        return HINT
    return CONTENT if not inside and words & CONTENT_WORDS else None


class _Tags:
    """The tags of a page in order, in time linear in its length.

    An end in quotes is no end. Where quotes leave a tag open to the end of the
    page, tags from there on end at the next >; what has none is text.
    """

    def __init__(self, source: str):
        self.source, self.quoted = source, True
        self.last = {c: source.rfind(c) for c in "\"'>"}

    def _find(self, c: str, at: int) -> int:
        return self.source.find(c, at) if at <= self.last[c] else -1

    def end(self, at: int) -> int:
        """Where the tag that begins before ``at`` has its >, or -1."""
        first = stop = self._find(">", at)
        while self.quoted and stop >= 0 and (m := _QUOTE.search(self.source, at, stop)):
            at = self._find(m.group(), m.end()) + 1
            if not at:
                stop = -1
            elif at > stop:
                stop = self._find(">", at)
        if stop < 0 <= first:
            self.quoted = False
            return first
        return stop


def blocks_of(source: str) -> tuple[list[tuple[str, str]], bool]:
    """(kind, text) of each non-empty block in page order, and whether an article is part of marked content.

    Character references are decoded and white space is one space. End tags close
    what they name, where it is open; a paragraph or list item also ends where
    the next one begins, and unclosed elements end with their parent.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str | None]] = []
    items: list[int] = []  # places in the stack of list items and what holds them
    open_names: Counter[str] = Counter()
    kinds = {ARTICLE: 0, CONTENT: 0, CHROME: 0, HINT: 0, NAMED: 0}
    silent, nested, spoken = 0, False, False
    parts: dict[str, list[str]] = {ARTICLE: [], CONTENT: [], OPEN: [], CHROME: [], HINT: []}
    parts |= {kind.upper(): [] for kind in MARKED}

    def flush() -> None:
        nonlocal spoken
        if spoken:
            for kind, held in parts.items():
                if held:
                    text = " ".join(html.unescape("".join(held)).split())
                    held.clear()
                    if text:
                        out.append((kind, text))
            spoken = False

    def say(text: str) -> None:
        nonlocal spoken
        if text and not silent:
            spoken = True
            kind = CHROME if kinds[CHROME] else HINT if kinds[HINT] else ARTICLE if kinds[ARTICLE] else CONTENT if kinds[CONTENT] else OPEN
            if kinds[NAMED]:
                kind = kind.upper() if kind in MARKED else CHROME
            parts[kind].append(text)

    def close(depth: int) -> None:
        nonlocal silent
        while len(stack) > depth:
            name, kind = stack.pop()
            open_names[name] -= 1
            silent -= name in NO_TEXT
            if kind:
                kinds[kind] -= 1
        while items and items[-1] >= depth:
            items.pop()

    tags = _Tags(source)
    said = at = 0
    while (at := source.find("<", at)) >= 0:
        if source.startswith("<!--", at):
            say(source[said:at])
            end = source.find("-->", at + 4)
            said = at = len(source) if end < 0 else end + 3
            continue
        named = _NAME.match(source, at + 1)
        if not named and source[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1
            continue
        end = tags.end(named.end() if named else at + 1)
        if end < 0:
            at += 1
            continue
        say(source[said:at])
        opening, attributes = at + 1, ""
        said = at = end + 1
        if not named:
            continue
        name = named.group(1).lower()
        if name in BLOCK:
            flush()
        elif name in CELLS:
            say(" ")
        if source[opening] == "/":
            if open_names[name]:
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                close(depth)
            continue
        if name in RAW_TEXT:
            ended = _RAW_ENDS[name].search(source, at)
            said = at = ended.start() if ended else len(source)
            continue
        if name in BLOCK and stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if name in ITEMS:
            for k in reversed(items):
                if stack[k][0] in LISTS:
                    break
                if stack[k][0] == name:
                    close(k)
                    break
        if name in VOID or source[end - 1] == "/" and name not in BLOCK:
            continue
        attributes = source[named.end() : end]
        kind = _says(attributes, name, bool(kinds[ARTICLE]))
        if kind == ARTICLE:
            nested = nested or bool(kinds[CONTENT])
            if kinds[CHROME]:  # some pages are one form from top to bottom
                for k, (outer, says) in enumerate(stack):
                    if says == CHROME and outer == "form":
                        stack[k] = (outer, None)
                        kinds[CHROME] -= 1
        if name in ITEMS or name in LISTS:
            items.append(len(stack))
        stack.append((name, kind))
        open_names[name] += 1
        silent += name in NO_TEXT
        if kind:
            kinds[kind] += 1
    say(source[said:])
    flush()
    return out, nested


#: What becomes of a block: it stays, the host's repeats decide, or it goes.
STAYS, DECIDED, GOES = 0, 1, 2


def main_part(blocks: list[tuple[str, str]], nested: bool) -> tuple[str, ...]:
    """The kinds of the main part: of the article where there is one, else of marked content, else of open text.

    Content beside an article that is shorter and no part of it is the main part
    (the article is a teaser). All that is marked in wrappers that are furniture by
    name is the main part if it is longer than all else marked.
    """
    size = Counter()
    for kind, text in blocks:
        size[kind] += len(text)
    if sum(size[kind.upper()] for kind in MARKED) > sum(size[kind] for kind in MARKED):
        return tuple(kind.upper() for kind in MARKED)
    article = size[ARTICLE] + size[HINT]
    if article and (nested or size[CONTENT] <= article):
        return ARTICLE, HINT
    return (CONTENT,) if size[CONTENT] else (OPEN,)


def settled(blocks: list[tuple[str, str]], nested: bool, repeated: list[bool] | None = None) -> list[int]:
    """What becomes of each block: by markup alone, or, given which blocks repeated runs cover, in the end (no block is DECIDED then).

    Parts are compared by what is not repeated. Article text of the main part
    stays even if it is. So does marked content of which repeats would leave
    nothing.
    """
    rivals = any(kind in MARKED for kind, _ in blocks)  # of what is marked in wrappers
    whole = main_part(blocks, nested)
    main, emptied = whole, False
    if repeated:
        main = main_part([b for b, r in zip(blocks, repeated, strict=True) if not r], nested)
        emptied = main == (OPEN,) != whole
        main = whole if emptied else main
    fates = []
    for k, (kind, _) in enumerate(blocks):
        if kind not in main:
            fates.append(GOES)
        elif repeated is None:
            fates.append(STAYS if kind == ARTICLE or kind == ARTICLE.upper() and not rivals else DECIDED)
        else:
            kept = kind.lower() == ARTICLE or not repeated[k] or emptied and kind.lower() == CONTENT
            fates.append(STAYS if kept else GOES)
    return fates


def split_page(source: str) -> list[tuple[int, str]]:
    """The page's blocks in order, with what markup alone says about each; all that doesn't stay by it meets the host's repeats."""
    blocks, nested = blocks_of(source)
    return [(fate, text) for fate, (_, text) in zip(settled(blocks, nested), blocks, strict=True)]


def stream_tokens(blocks: list[tuple[int, str]]) -> tuple[list[str], list[tuple[int, int] | None]]:
    """The tokens of all blocks that don't stay (a line feed marks the end of a block), and where each block's words are there."""
    tokens: list[str] = []
    places: list[tuple[int, int] | None] = []
    for fate, text in blocks:
        if fate == STAYS:
            places.append(None)
            continue
        words = text.split(" ")
        places.append((len(tokens), len(tokens) + len(words)))
        tokens += [*words, "\n"]
    return tokens, places


def suffix_names(tokens: list[str], depth: int = DEPTH) -> np.ndarray:
    """The name of each suffix by its first ``depth`` tokens, by prefix doubling; a short stream is padded at its end."""
    names = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) for t in [*tokens, *["\n"] * (depth - 1)]], np.uint64)
    span = 1
    while span < depth:
        names = (names[:-span] * np.uint64(0x9E3779B97F4A7C15)) ^ ((names[span:] + np.uint64(span)) * np.uint64(0xC2B2AE3D27D4EB4F))
        names ^= names >> np.uint64(29)
        span *= 2
    return names


def _key(tokens: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x00".join(tokens).encode("utf-8", "replace")) - (1 << 63)


_STREAM = T.StructType(
    [T.StructField("key", T.LongType()), T.StructField("page", T.LongType()), T.StructField("names", T.ArrayType(T.LongType()))]
)
_PARTS = T.StructType([T.StructField("key", T.LongType()), T.StructField("body", T.BinaryType())])


@arrow_udf(_STREAM)
def streams(sources: pa.Array) -> pa.Array:
    """Key, page identity and suffix names of each page's stream.

    Copies count as one page for repeats: the identity is the hash of the page's
    whole article, or of all its marked text where repeats choose between marked
    parts, or of all its open text where it marks none. Pages that share a part of
    it, such as a byline, are pages of their own, and so are near copies.
    """
    keys, pages, names = [], [], []
    for source in as_texts(sources):
        read, nested = blocks_of(source)
        fates = settled(read, nested)
        blocks = [(fate, text) for fate, (_, text) in zip(fates, read, strict=True)]
        tokens, _ = stream_tokens(blocks)
        found = suffix_names(tokens) if tokens else np.empty(0, np.uint64)
        kept = [t for fate, t in blocks if fate == STAYS]
        kept = kept or [t for kind, t in read if kind.lower() in (ARTICLE, CONTENT)] or [t for fate, t in blocks if fate == DECIDED]
        page = xxhash.xxh64_intdigest("\n".join(kept).encode("utf-8", "replace"))
        keys.append(_key(tokens))
        pages.append(page >> 1)
        names.append(found.view(np.int64))
    return pa.StructArray.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(pages, pa.int64()), pa.array(names, pa.list_(pa.int64()))], ["key", "page", "names"]
    )


@arrow_udf(_PARTS)
def parts(sources: pa.Array) -> pa.Array:
    """The stream's key and the page's blocks, compressed, as they wait for what the host says about them."""
    press = zstandard.ZstdCompressor(level=1)
    keys, bodies = [], []
    for source in as_texts(sources):
        read, nested = blocks_of(source)
        fates = settled(read, nested)
        keys.append(_key(stream_tokens([(fate, text) for fate, (_, text) in zip(fates, read, strict=True)])[0]))
        bodies.append(press.compress(json.dumps([nested, fates, read], ensure_ascii=False).encode("utf-8", "replace")))
    return pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())], ["key", "body"])


def _covered(starts: list[int] | None, places: list[tuple[int, int] | None], size: int) -> list[int]:
    """How many words of each block lie in the windows that begin at ``starts``."""
    if not starts:
        return [0] * len(places)
    covered = np.zeros(size + DEPTH, bool)
    for s in starts:
        covered[s : s + DEPTH] = True
    before = [0, *np.cumsum(covered).tolist()]
    return [before[place[1]] - before[place[0]] if place else 0 for place in places]


_COUNTS = ("n_outside", "n_repeated", "n_by_repeats", "n_by_markup", "n_by_both")
_TEXT = T.StructType([T.StructField("text", T.StringType()), *[T.StructField(c, T.LongType()) for c in _COUNTS]])


@arrow_udf(_TEXT)
def assembled(bodies: pa.Array, starts: pa.Array, widely: pa.Array) -> pa.Array:
    """The main text, given where repeated runs start in the stream; and what the runs cover and decide.

    The runs come first; markup then checks what they leave. ``widely`` are the
    starts that count in marked parts.
    """
    press = zstandard.ZstdDecompressor()
    texts, counts = [], []
    for body, found, wide in zip(bodies.to_pylist(), starts.to_pylist(), widely.to_pylist(), strict=True):
        nested, fates, read = json.loads(press.decompress(body))
        blocks = [(fate, text) for fate, (_, text) in zip(fates, read, strict=True)]
        tokens, places = stream_tokens(blocks)
        within, within_marked = _covered(found, places, len(tokens)), _covered(wide, places, len(tokens))
        sizes = [place[1] - place[0] if place else 0 for place in places]
        decisive = [m if kind.lower() in (ARTICLE, CONTENT) else w for (kind, _), w, m in zip(read, within, within_marked, strict=True)]
        repeated = [n > 0 and w >= COVERED * n for n, w in zip(sizes, decisive, strict=True)]
        outcome = settled(read, nested, repeated)
        kept = [text for fate, (_, text) in zip(outcome, read, strict=True) if fate == STAYS]
        gone = [(r, fate == GOES) for fate, r, end in zip(fates, repeated, outcome, strict=True) if end == GOES]
        by_repeats = sum(not by_markup for _, by_markup in gone)
        both = sum(r and by_markup for r, by_markup in gone)
        texts.append("\n".join(kept))
        counts.append((sum(sizes), sum(within), by_repeats, len(gone) - by_repeats - both, both))
    columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] if counts else [pa.array([], pa.int64())] * len(_COUNTS)
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), *columns], ["text", *_COUNTS])


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_outside, n_repeated, n_by_repeats, n_by_markup, n_by_both.

    n_outside counts the words that structure doesn't protect, n_repeated those of
    them in repeated runs of the host. Of the blocks removed n_by_repeats are those
    that markup alone would have kept, n_by_markup those that no repeated runs
    cover, n_by_both those that runs cover and markup puts outside too. Null and empty pages have
    empty text. A null url, or one without a host, is a host of its own. Repeated
    rows each give a row; as copies of one page they don't repeat anything.
    Malformed pages of any length take time in proportion to it.
    """
    bounded_batches(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))
    read = stored(pages.select(F.xxhash64(host).alias("host"), streams(F.col(source)).alias("s")).select("host", "s.*"), "streams")
    suffixes = read.select("host", "page", "key", F.posexplode("names").alias("at", "name"))
    held = read.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of"))
    repeated = suffixes.select("host", "name", "page").distinct().groupBy("host", "name").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    repeated = repeated.join(held, "host").select("host", "name", (F.col("n") > MARKED_SHARE * F.col("of")).alias("widely"))
    once = suffixes.select("host", "key", "name", "at").distinct()
    starts = (
        once.join(repeated, ["host", "name"])
        .groupBy("host", "key")
        .agg(F.collect_list("at").alias("starts"), F.collect_list(F.when(F.col("widely"), F.col("at"))).alias("widely"))
    )
    waiting = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.xxhash64(host).alias("of_host"), parts(F.col(source)).alias("p")
    )
    return (
        waiting.join(starts, (F.col("of_host") == F.col("host")) & (F.col("p.key") == F.col("key")), "left")
        .select("page_id", "url", assembled(F.col("p.body"), F.col("starts"), F.col("widely")).alias("a"))
        .select("page_id", "url", "a.*")
    )
