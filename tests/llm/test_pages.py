import random
import re
import time

import numpy as np
import pytest

from corvane.llm import pages as P
from corvane.llm.queries import op1_main_text


def main_text(source):
    """The text of a page on a host without repeats."""
    return "\n".join(t for fate, t in P.split_page(source) if fate != P.GOES)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><h1>T</h1><p>a&nbsp; b\n c</p></article>", "T\na b c"),
        ("<article><p>one<b>two</b> three<br><p>four</article><p>out", "onetwo three\nfour"),
        ('<nav>n</nav><article>x<div class="ad">buy</div>y<aside>z</aside><form>f</form></article><footer>q</footer>', "x\ny"),
        ('<body class="nav-open home"><header>h</header><main><p>m</p></main><div id="comments">c</div></body>', "m"),
        ('<article><p>t</p><section class="comments"><article class="comment">hi</article></section></article>', "t"),
        ('<script>var a="</p><article>no</article>";</script><style>p{}</style><article>yes</article>', "yes"),
        ('<form action="/"><article>a</article></form>', "a"),
        ("<!-- <article>no</article> --><div class='content'>c &#233;&eacute;</div>", "c éé"),
        ('<article><p title="a > b">t</p><p hidden>h</p></article>', "t"),
        ("<article>a < b and 3 > 2</article>", "a < b and 3 > 2"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc d"),
        ('<article class="post related">Body text.</article>', "Body text."),
        ('<article><div class="social-history">a</div><p class="form-factor">b</p><div class="alert">c</div><div class="comment-list">d</div><div class="ad-box">e</div></article>', "a\nb\nc"),
        ('<article class="teaser">Read on</article><div class="content">Main text of the page.</div>', "Main text of the page."),
        ('<main>A long line above the article<article>short</article></main>', "short"),
        ('<div class="content"><div class="social-links">s</div>t</div>', "t"),
        ('<article>a<p title="x>b</article><p>c', "a\nb"),
        ("<article>1 <2 and <- <> </article>", "1 <2 and <- <>"),
        ("<article>a<!-- b", "a"),
        ("<article>x</i></b></div>y</article>z", "x\ny"),
        ('<div id="top"><article>a</article></div>', "a"),
        ('<div class="site sticky-header"><article>a</article></div>', "a"),
        ('<div class="page menu"><nav>n</nav><article>a<p>b</p></article>c</div>', "a\nb"),
        ('<main class="search page"><article>a</article>b</main>', "a"),
        ('<main class="search page"><p>a</p></main>', "a"),
        ('<article class="post has-comments">a</article>', "a"),
        ('<article class="post has-comments">a<article class="user-comment">hi</article></article>', "a"),
        ('<div class="top"><div class="content">a long enough text</div></div><div>b</div>', "a long enough text"),
        ('<section class="comments"><article>hi, what a long comment this is</article></section><article>t</article>', "t"),
        ('<div class="related"><article>a card</article></div><p>open text</p>', "open text"),
        ('<div class="cookie-notice"><div class="content">We use it</div></div><article>the main text</article>', "the main text"),
        ('<article>a<p style="display: none">h</p><p style="color:red">b</p></article>', "a\nb"),
        ('<div class="menu"><ul><li>x</ul></div><p>open</p>', "open"),
    ],
)
def test_structure(source, text):
    assert main_text(source) == text


def test_suffix_names_equal_where_tokens_are():
    tokens = list("abcabcabcxabcabcabc")
    names = P.suffix_names(tokens, 4)
    padded = tokens + ["\n"] * 3
    for i in range(len(tokens)):
        for j in range(i):
            assert (names[i] == names[j]) == (padded[i : i + 4] == padded[j : j + 4])
    assert len(P.suffix_names(["a"], 8)) == 1 and np.array_equal(P.suffix_names(["a"]), P.suffix_names(["a"]))


def page(k, words, template=True):
    furniture = "<div>Welcome to the only portal of the northern valley with news every day</div>" if template else ""
    return f"<html><body>{furniture}<p>{words}</p><div>Reprints need the written consent of the valley press office in town</div></body></html>"


def test_repeated_runs_of_a_host_go_and_copies_stay(spark):
    body = {k: " ".join(f"w{k}x{i}" for i in range(40)) for k in range(12)}
    rows = [(k, f"http://a.example/{k}", page(k, body[k])) for k in range(12)]
    rows += [(100 + k, f"http://a.example/c{k}", page(3, body[3])) for k in range(5)]  # copies of one page
    rows += [(200, "http://b.example/", page(1, body[1])), (201, None, None), (202, "", ""), (203, "x", "<article></article>")]
    got = {r.page_id: r for r in P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == len(rows)
    for k in range(12):
        assert got[k].text == body[k]
    for k in range(5):
        assert got[100 + k].text == body[3]
    assert got[200].text.count("\n") == 2  # a host with one page has no repeats
    assert got[201].text == got[202].text == got[203].text == ""


def test_repeats_count_on_large_hosts_and_under_long_boilerplate(spark):
    section = "Our section on mountain weather is made with the help of nine stations"
    notice = " ".join(f"n{i}" for i in range(400))
    body = {k: " ".join(f"w{k}x{i}" for i in range(9)) for k in range(80)}
    rows = [(k, f"http://large.example/{k}", (f"<div>{section}</div>" if k < 4 else "") + f"<p>{body[k]}</p>") for k in range(80)]
    rows += [(100 + k, f"http://short.example/{k}", f"<div>{notice}</div><p>{body[k]}</p>") for k in range(6)]
    rows += [(200 + k, f"http://two.example/{k % 2}", f"<div>{notice}</div><p>{body[k % 2]}</p>") for k in range(8)]  # two pages, four copies each
    got = {r.page_id: r.text for r in P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == body[k] for k in range(80)) and all(got[100 + k] == body[k] for k in range(6))
    assert all(got[200 + k] == f"{notice}\n{body[k % 2]}" for k in range(8))


@pytest.mark.parametrize("byline", [f"by writer {k} of the valley" for k in range(6)])
def test_pages_that_share_a_byline_are_pages(spark, byline):
    share = "Send this story to all of your friends by mail today"
    rows = [(k, f"http://a.example/{k}", f'<article><p>{byline}</p><p>body {k}</p><div class="share-this-story">{share}</div></article>') for k in range(10)]
    got = {r.page_id: r.text for r in P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {k: f"{byline}\nbody {k}" for k in range(10)}


def test_repeats_change_texts_where_markup_is_silent(spark):
    """With and without the array, on pages that mark no main part."""
    rows = [(k, f"http://a.example/{k}", page(k, " ".join(f"w{k}x{i}" for i in range(20)))) for k in range(6)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {n: {r.page_id: (r.text, r.n_by_repeats, r.n_by_markup) for r in P.extract_main_text(frame, min_pages=n).collect()} for n in (3, 10**9)}
    for k in range(6):
        assert found[3][k][0] != found[10**9][k][0] and found[3][k][1:] == (2, 0) and found[10**9][k][1:] == (0, 0)


def covered_by_brute_force(streams, depth, least):
    """Per (page, place): whether it lies in a substring of ``depth`` or more tokens that ``least`` distinct pages have."""
    held = {}
    for page, tokens in streams:
        for i in range(len(tokens) - depth + 1):
            held.setdefault(tuple(tokens[i : i + depth]), set()).add(page)
    out = set()
    for page, tokens in streams:
        for i in range(len(tokens) - depth + 1):
            if len(held[tuple(tokens[i : i + depth])]) >= least:
                out.update((page, k) for k in range(i, i + depth))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    runs = [[f"r{k}w{i}" for i in range(rng.randrange(4, 20))] for k in range(6)]
    rows, streams = [], {}
    for k in range(60):
        host, blocks = rng.randrange(3), []
        for _ in range(rng.randrange(1, 5)):
            words = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(4))]
            for _ in range(rng.randrange(3)):
                run = rng.choice(runs)
                at = rng.randrange(len(run))
                words += run[at:] if rng.random() < 0.3 else run
            if words:
                blocks.append(words)
        rows.append((k, f"http://h{host}.example/{k}", f"<article>only page {k}</article>" + "".join(f"<div>{' '.join(b)}</div>" for b in blocks)))
        streams.setdefault(host, []).append((k, [t for b in blocks for t in [*b, "\n"]] + ["\n"] * (P.DEPTH - 1)))
    got = {r.page_id: r for r in P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    some = 0
    for held in streams.values():
        covered = covered_by_brute_force(held, P.DEPTH, P.MIN_PAGES)
        for page, tokens in held:
            words = [(page, i) in covered for i, t in enumerate(tokens) if t != "\n"]
            assert (got[page].n_outside, got[page].n_repeated, got[page].text) == (len(words), sum(words), f"only page {page}")
            some += sum(words)
    assert some > 100


def test_repeats_decide_what_markup_only_hints_at(spark):
    rows = [(k, f"http://a.example/{k}", f'<article><p>body {k}</p><div class="form-factor">The size of model {k} is {k} by {k} by {k} in all its parts</div><div class="share-this-story">Send this story to all of your friends by mail today</div></article>') for k in range(5)]
    got = {r.page_id: r for r in P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(5):
        assert got[k].text == f"body {k}\nThe size of model {k} is {k} by {k} by {k} in all its parts"
        assert (got[k].n_by_repeats, got[k].n_by_markup) == (1, 0)


NOTICE = "We use what you read here to choose what we show you on every other page"


def texts_of(spark, sources, **options):
    """Text, n_by_repeats, n_by_markup, n_by_both of each page of one host."""
    rows = [(k, f"http://a.example/{k}", source) for k, source in enumerate(sources)]
    found = P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"), **options).collect()
    return [(r.text, r.n_by_repeats, r.n_by_markup, r.n_by_both) for r in sorted(found, key=lambda r: r.page_id)]


@pytest.mark.parametrize("wrapper", ["<main>{}</main>", '<div class="content">{}</div>', '<div class="page menu"><main>{}</main></div>'])
def test_repeats_go_from_marked_content(spark, wrapper):
    """A main element without an article may hold furniture that no markup names."""
    found = texts_of(spark, [wrapper.format(f"<p>{NOTICE}</p><p>body of page {k}</p>") for k in range(4)])
    assert found == [(f"body of page {k}", 1, 0, 0) for k in range(4)]


def test_lines_that_some_pages_share_stay_in_marked_content(spark):
    """Less than half of a host's distinct pages: no furniture there, though it would be in open text."""
    sources = {w: [w.format((f"<p>{NOTICE}</p>" if k < 4 else "") + f"<p>body of page {k}</p>") for k in range(9)] for w in ("<main>{}</main>", "<div>{}</div>")}
    assert [NOTICE in t for t, *_ in texts_of(spark, sources["<main>{}</main>"])] == [k < 4 for k in range(9)]
    assert not any(NOTICE in t for t, *_ in texts_of(spark, sources["<div>{}</div>"]))


def test_repeats_never_empty_marked_content(spark):
    lines = [" ".join(f"l{k}w{i}" for i in range(12)) for k in range(4)]
    pages = ["".join(f"<p>{line}</p>" for j, line in enumerate(lines) if j != k) for k in range(4)]  # each line is on three distinct pages
    assert [t for t, *_ in texts_of(spark, [f"<main>{p}</main>" for p in pages])] == ["\n".join(x for j, x in enumerate(lines) if j != k) for k in range(4)]
    same = texts_of(spark, [f"<main><p>{NOTICE}</p></main>"] * 4)
    assert same == [(NOTICE, 0, 0, 0)] * 4  # copies are one page


@pytest.mark.parametrize("wrapper", ['<div class="content">{}</div>', '<div class="top"><div class="content">{}</div></div>'])
def test_repeats_choose_between_marked_parts(spark, wrapper):
    """Neither an article nor content is the main part by the length of what the host repeats."""
    beside = [f"<article>The story of page {k}</article>{wrapper.format(f'<p>{NOTICE}</p><p>{k}</p>')}" for k in range(4)]
    assert [t for t, *_ in texts_of(spark, beside)] == [f"The story of page {k}" for k in range(4)]
    teaser = [f"<article>{NOTICE}</article>{wrapper.format(f'<p>{NOTICE}, and the story of page {k}</p><p>A long end of story {k} that only this page {k} has, in many words: {k} and {k}</p>')}" for k in range(4)]
    assert all(t.endswith(f"{k} and {k}") and NOTICE + "\n" not in t for k, (t, *_) in enumerate(texts_of(spark, teaser)))


def test_repeats_come_before_markup(spark):
    """What runs cover goes by them; markup checks what they leave, and article text stays though it is repeated."""
    shared = "A line of the article that many pages of this host have word for word"
    sources = [f"<nav>{NOTICE}</nav><div class='ad'>advert {k}</div><article><p>{shared}</p><p>body {k}</p></article>" for k in range(4)]
    assert texts_of(spark, sources) == [(f"{shared}\nbody {k}", 0, 1, 1) for k in range(4)]
    assert texts_of(spark, sources, min_pages=10**9) == [(f"{shared}\nbody {k}", 0, 2, 0) for k in range(4)]


def covered_by_suffix_array(streams, depth, least):
    """As covered_by_brute_force, by all suffixes in order and the common length of neighbours."""
    suffixes = sorted((tokens[i:], page, i) for page, tokens in streams for i in range(len(tokens) - depth + 1))
    common = [0] + [next((k for k, (x, y) in enumerate(zip(a[0], b[0])) if x != y), min(len(a[0]), len(b[0]))) for a, b in zip(suffixes, suffixes[1:])]
    out, first = set(), 0
    for end in range(1, len(suffixes) + 1):
        if end == len(suffixes) or common[end] < depth:
            group = suffixes[first:end]
            if len({page for _, page, _ in group}) >= least:
                shared = min(common[first + 1 : end], default=depth)
                out.update((page, k) for _, page, i in group for k in range(i, i + shared))
            first = end
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_cut_off_array_covers_what_the_whole_one_does(spark, seed):
    rng = random.Random(seed)
    runs = [[rng.choice("abcd") for _ in range(rng.randrange(6, 30))] for _ in range(5)]
    bodies = [[w for _ in range(3) for w in [f"u{rng.randrange(10**6)}", *rng.choice(runs)[rng.randrange(4) :]]] for _ in range(25)]
    sources = [f"<article>only page {k}</article><div>{' '.join(b)}</div>" for k, b in enumerate(bodies)]
    streams = [(k, [*b, *["\n"] * P.DEPTH]) for k, b in enumerate(bodies)]
    whole = covered_by_suffix_array(streams, P.DEPTH, P.MIN_PAGES)
    assert whole == covered_by_brute_force(streams, P.DEPTH, P.MIN_PAGES)
    rows = [(k, f"http://a.example/{k}", source) for k, source in enumerate(sources)]
    found = {r.page_id: r.n_repeated for r in P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {k: sum((k, i) in whole for i in range(len(b))) for k, b in enumerate(bodies)} and sum(found.values()) > 200


@pytest.mark.parametrize(
    "source",
    ['<a href="x>' * 90_000 + '"', "<a title='>'" * 80_000, "<a " * 330_000, "</p>" * 250_000, "<b>" * 100_000 + "</i>" * 150_000, "<li><ul>" + "<b>" * 50_000 + "<li></li>" * 80_000,
     "< <" * 330_000, "<!--" * 250_000, "<div " + "class " * 160_000 + ">", '<div class="content">' * 45_000, "<script>" * 125_000, "<p" + " " * 1_000_000 + ">", '<a "' * 250_000, "&" * 1_000_000],
)
def test_malformed_pages_take_linear_time(source):
    seconds = []
    for part in (source[: len(source) // 4], source):
        began = time.process_time()
        P.split_page(part)
        seconds.append(time.process_time() - began)
    assert seconds[1] < 3 and seconds[1] < 10 * max(seconds[0], 0.05)


def test_repeated_article_text_stays(spark):
    source = "<article><p>the same long line of an article that many pages of this host repeat word for word</p></article>"
    rows = [(k, "http://a.example/x", f"<nav>menu number one two three four five six seven eight nine</nav>{source}") for k in range(30)]
    found = P.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.text for r in found} == {re.sub("<[^>]+>", "", source)}
    assert P.extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_query(spark, sf):
    rows = op1_main_text(spark, sf).collect()
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(sources)
    for r in rows:
        inner = re.search("(?s)<article>(.*?)</article>", sources[r.page_id]).group(1)
        blocks = (" ".join(P.html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
