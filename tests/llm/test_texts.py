"""HTML, fingerprints, URL lists, chat windows and repeated strings against brute force."""

import datetime
import hashlib
import random
import time

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from indexloom.llm import chat, html_text, suffix_dedup, url_filters, winnow
from indexloom.llm.html_training import PAGES
from tests.llm.helpers import documents, prose


def test_content_of_pages_unlike_the_training_pages():
    model = html_text.train()
    body = "<p>The old bridge was closed in spring. Boats carried people over, for a small fee.</p>"
    page = (
        "<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header class=top><a href=/>Site</a></header>"
        "<nav><a href=/x>One</a><a href=/y>Two</a></nav><div class='cookie-notice'>We use cookies, of course.</div>"
        f"<article><h1>A &amp; B</h1>{body}<p>Fo<b>o</b>&nbsp;bar<br>baz\n qux<script>var a='<p>no</p>';</script></p><ul><li>One, first.<li>Two</ul>"
        "<div class='ad'>Buy this now</div><form><input><p>Sign up here</p></form></article>"
        f"<aside class=sidebar><a href=/1>More</a></aside><section class='comments'><div class='comment'>{body}</div></section><footer>&copy; 2020</footer>"
    )
    assert html_text.main_text(page, model) == "A & B The old bridge was closed in spring. Boats carried people over, for a small fee. Foo bar baz qux One, first. Two"


def test_training_pages_are_learnt_and_messages_give_exact_marginals():
    model = html_text.train()
    right = total = 0
    for html in PAGES:
        page = html_text.parse(html)
        labels = [0]
        for i in range(1, len(page.tags)):
            mark = page.attributes[i]
            labels.append(0 if "data-not" in mark or page.tags[i] in html_text.HIDDEN else 1 if "data-main" in mark else labels[page.parents[i]])
        found = [p > 0.5 for p in html_text.marginals(page, model)]
        hits = sum(a == b for a, b in zip(found, labels, strict=True))
        assert hits >= 0.9 * len(labels)
        right, total = right + hits, total + len(labels)
    assert right >= 0.98 * total
    # All labellings of a small tree.
    import itertools
    import math

    page = html_text.parse("<div class=post><p>One, two. <i>x</i></p><nav><a>b</a></nav></div>")
    n, total, on = len(page.tags), 0.0, [0.0] * len(page.tags)
    e = model.edges
    for y in itertools.product((0, 1), repeat=n):
        score = model.root * y[0] + sum(sum(model.evidence.get(f, 0) for f in found) * y[i] for i, found in enumerate(html_text.features(page)) if i)
        weight = math.exp(score + sum(e[2 * y[page.parents[i]] + y[i]] for i in range(1, n)))
        total += weight
        on = [a + weight * b for a, b in zip(on, y, strict=True)]
    assert html_text.marginals(page, model) == pytest.approx([x / total for x in on])


_A = "The old bridge was closed in spring. Boats carried people over, for a small fee."
_B = "A new one will be built next year, said the mayor, if the money is found."
_MENU = "<nav><a href=/x>One</a> <a href=/y>Two</a></nav>"
_END = "<footer>&copy; 2020 Some site. All rights reserved.</footer>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>Hi there</p>", "Hi there"),
        (f"{_A} {_B}", f"{_A} {_B}"),
        (f"<html><body>{_A}<br>{_B}</body></html>", f"{_A} {_B}"),
        ("<body><p>Only one plain paragraph here, with words, and more. It reads well.</p></body>", "Only one plain paragraph here, with words, and more. It reads well."),
        (f"<body><h1>Title</h1><p>{_A}</p><p>{_B}</p></body>", f"Title {_A} {_B}"),
        (f"<body>{_MENU}<h2>Title</h2><p>{_A}</p><div class=ad>Buy this, now.</div><p>{_B}</p><aside><a href=/1>More</a></aside>{_END}</body>", f"Title {_A} {_B}"),
        (f"<html><head><title>x</title></head><h1>Title</h1><p>{_A}</p>{_END}", f"Title {_A}"),
        (f"{_MENU}<p>{_A}</p><p>{_B}</p>{_END}", f"{_A} {_B}"),
        (f"<table><tr><td>{_A}</td></tr><tr><td>{_B}</td></tr></table>", f"{_A} {_B}"),
        (f"<body><div><div>{_MENU}<div><p>{_A}</p><p>{_B}</p></div></div></div>{_END}</body>", f"{_A} {_B}"),
        (f"<body>{_MENU}{_END}</body>", ""),
        (f"<body>{_MENU}<form><p>Sign up here, it is free.</p><input></form>{_END}</body>", ""),
    ],
)
def test_pages_without_an_element_around_the_article(page, want):
    assert html_text.main_text(page, html_text.train()) == want


@pytest.mark.parametrize(
    "comments",
    [
        f"<section class=discussion><h2>Replies</h2><div class=item><p>I saw it, too.</p></div><div class=item><p>{_A}</p></div></section>",
        f"<div class=kommentare><p>Ja, so war es.</p><p>{_A}</p></div>",
        f"<section class=comments><article class=comment><p>{_A}</p></article></section>",
        f"<div id=x1><h3>More</h3><p>{_A}</p></div>",
    ],
)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_comments_of_unseen_names_beside_a_marked_article(tag, comments):
    page = f"<body>{_MENU}<{tag}><h1>Title</h1><p>{_A}</p><p>{_B}</p></{tag}>{comments}{_END}</body>"
    assert html_text.main_text(page, html_text.train()) == f"Title {_A} {_B}"


def test_links_and_lists_in_running_text_stay():
    page = f"<body>{_MENU}<div class=artikel><h1>Title</h1><p>{_A} See <a href=/z>this</a>, too.</p><ul><li>One, first.</li><li>Two, and last.</li></ul><p>{_B}</p></div>{_END}</body>"
    assert html_text.main_text(page, html_text.train()) == f"Title {_A} See this, too. One, first. Two, and last. {_B}"


def test_scripts_and_images_part_no_words():
    page = html_text.parse("<p>Hello<script>x</script>World<img src=a>s<style>p{}</style></p><p>b")
    assert len({block for element, block, _ in page.runs if page.tags[element] == "p"}) == 2
    article = "<article><h1>Rain</h1><p>Hello<script>x</script>World, and all of you, at once.</p></article>"
    assert html_text.main_text(article, html_text.train()) == "Rain HelloWorld, and all of you, at once."


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "</span>" * 20_000, "<p><button>" + "<div>" * 20_000, "<li>" + "<b>" * 20_000 + "</p>" * 20_000, "<p><button>" + "<b><p>" * 20_000])
def test_stray_tags_take_linear_time(page):
    began = time.process_time()
    html_text.parse(page)
    assert time.process_time() - began < 2


def test_pages_of_all_kinds_do_not_crash(spark):
    htmls = [None, "", "plain text", "<", "<p", "<p class='", "<!--", "<script>x", "</p></div>", "<div>" * 30_000 + "x", "<td><li><p>a<p>b</ul>", "&#0;&am &amp", "<article><p>" + "Yes, it is so. " * 50_000 + "</article>"]
    pages = spark.createDataFrame([(i, "u", h, "x", "y") for i, h in enumerate(htmls)], "page_id long, url string, html string, text string, row string")
    rows = {r.row.page_id: r.text for r in html_text.with_main_text(pages).collect()}
    assert len(rows) == len(htmls) and rows[0] == rows[1] == "" and len(rows[12]) == 15 * 50_000 - 1
    assert html_text.with_main_text(pages.limit(0)).count() == 0


def test_stray_quotes_end_with_their_tag():
    model = html_text.train()
    plain = "<article><p>Hello, all of you there.</p><p>More text, as it is.</p></article>"
    want = html_text.main_text(plain, model)
    assert want == "Hello, all of you there. More text, as it is."
    for tag in ('<p class="x"">', "<p title=it's>", "<p '>", '<p a"b">', "<p a=b'c>", '<p a = "x>y" \'>', "<p =\">", "<p a/=\">", '<p title="it\'s">', "<p title='a>b'\">", "<p title=>"):
        assert html_text.main_text(plain.replace("<p>", tag, 1), model) == want, tag
    assert html_text.main_text(plain.replace("</p>", "</p \">", 1), model) == want
    page = html_text.parse("<p title=\"class='no'\" CLASS = it's id='a b' role=x\"y z>t")
    assert page.words[1] == "it's a b x\"y"


def test_raw_elements_end_at_their_own_tag():
    model = html_text.train()
    plain = "<article><p>Hello, all of you there.</p>{}<p>More text, as it is.</p></article>"
    want = html_text.main_text(plain.format(""), model)
    letters = "<p>" + "\u0130yi, \u0130stanbul. " * 20 + "</p>"
    after = html_text.main_text(letters + plain.format(""), model)
    assert "More text, as it is." in after
    for raw in ("<script>var a = '<p>no</p>';</script>", "<STYLE>p{}</Style >", "<noscript><p>no</p></noscript/>", "<script>'</scripts>', \u0130, '</\u017fcript>'</SCRIPT>", "<iframe>\u0130\u0130</iframe\n>"):
        assert html_text.main_text(plain.format(raw), model) == want, raw
        assert html_text.main_text(letters + plain.format(raw), model) == after, raw
    assert [text for _, _, text in html_text.parse("a<script>b</script").runs] == ["a", "b</script"]


def slow_prints(text, gram=winnow.GRAM, window=winnow.WINDOW):
    units = regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|[\p{L}\p{M}\p{N}]{1,16}|[^ \t\n\x0b\f\r]", text)

    def hashed(parts):
        seed = 42
        for x in parts:
            seed = xxhash.xxh64_intdigest(x.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) >> 17

    if len(units) < gram:
        return {(0, hashed([" ".join(units)]))} if units else set()
    h = [hashed(units[i : i + gram]) for i in range(len(units) - gram + 1)]
    windows = (range(s, min(len(h), s + window)) for s in range(max(1, len(h) - window + 1)))
    return {(i, h[i]) for i in (min(w, key=lambda j: (h[j], -j)) for w in windows)}


def test_fingerprints_equal_brute_force_in_one_and_many_pieces(spark, monkeypatch):
    rng = random.Random(3)
    mk = lambda n: "".join(rng.choice("abcdé  𝄞x,你") for _ in range(n))
    texts = ["a b", "a b c", "x" * 100, "  ", "", None, "a a a a a a a a", *(mk(n) for n in (3, 10, 40, 300, 2000)), "a b", "a b"]
    docs = documents(spark, texts, [*range(len(texts) - 2), None, 3])
    order = sorted(zip([*range(len(texts) - 2), None, 3], texts, strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    for piece in (winnow.PIECE, 64):
        monkeypatch.setattr(winnow, "PIECE", piece)
        rows = winnow.edited_fingerprints(docs).collect()
        found = {(r.doc_id, r.text): r for r in rows}
        assert len(rows) == len(texts)
        for k, (i, t) in enumerate(order):
            text, following = t or "", order[(k + 1) % len(order)][1] or ""
            q = len(text) // 4
            edited, r = text[: len(text) - q] + following[:q], found[i, text]
            assert r.edited == edited
            for got, want in ((r.prints, text), (r.edited_prints, edited), (r.next_prints, following)):
                assert {(p.place, p.hash) for p in got} == slow_prints(want) and len(got) == len(slow_prints(want))
    assert winnow.edited_fingerprints(docs.limit(0)).count() == 0


def test_next_documents_across_buckets(spark):
    docs = documents(spark, [f"text {i}" for i in range(300)], extra=False)
    rows = winnow.neighbours(docs, "doc_id", "text", bucket_bytes=100).collect()
    assert len({r.bucket for r in rows}) > 10
    got = {}
    for b in {r.bucket for r in rows}:
        own = [r.doc_id for r in sorted((r for r in rows if r.bucket == b), key=lambda r: (r.guest, r.doc_id))]
        got |= dict(zip(own, own[1:], strict=False))
    assert got == {i: (i + 1) % 300 for i in range(300)}


def test_next_documents_across_buckets_with_repeated_ids(spark):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(1, 12)) for _ in range(240)]
    ids = [None if i < 3 else i // 3 for i in range(240)]
    order = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (_, own), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        q = len(own) // 4
        want.append(own[: len(own) - q] + after[:q])
    rows = winnow.neighbours(documents(spark, texts, ids, extra=False), "doc_id", "text", bucket_bytes=200).collect()
    got = []
    for b in sorted({r.bucket for r in rows}):
        own = sorted((r for r in rows if r.bucket == b), key=lambda r: (r.guest, r.doc_id is not None, r.doc_id or 0, r.text.encode()))
        got += [x.text[: len(x.text) - len(x.text) // 4] + y.text[: len(x.text) // 4] for x, y in zip(own, own[1:], strict=False)]
    assert len({r.bucket for r in rows}) > 10 and sorted(got) == sorted(want)


def test_url_lists_equal_a_day_by_day_reading(spark):
    rng = random.Random(8)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    urls = ["http://a.b.example.org/x/y?q", "https://user@B.example.org:80/x", "http://example.org", "nonsense", "", None, "http:///x", "http://other.net/" + "s/" * 300]
    patterns = ["example.org", "b.example.org", "a.b.example.org", "a.b.example.org/x/", "ple.org", "other.net/s/s/", None]
    entries = [(rng.choice((True, False, None)), rng.choice(patterns), rng.choice((True, True, False, None)), rng.choice([day(rng.randrange(200)), None])) for _ in range(120)]
    captures = [(rng.choice(urls), rng.choice([day(rng.randrange(220)), None]), "x", "y") for _ in range(200)]
    captures += captures[:5]
    c = spark.createDataFrame(captures, "url string, fetched date, pattern string, row string")
    e = spark.createDataFrame(entries, "blocks boolean, pattern string, active boolean, since date")

    def slow(url, fetched):
        state = {}
        if url and fetched:
            for d in sorted({x[3] for x in entries if x[3] and x[3] <= fetched}):
                today = {}
                for blocks, pattern, active, since in entries:
                    if since == d and pattern:
                        k = (blocks is not False, pattern)
                        today[k] = today.get(k, False) or bool(active)
                state |= today
            keys = [r for r in spark_keys[url]]
            active = [(len(p), b, p) for (b, p), on in state.items() if on and p in keys]
            if active:
                return max(active)[1], max(active)[2], len(active)
        return False, None, 0

    spark_keys = {r.url: r.k for r in c.select("url", url_filters.keys(F.col("url")).alias("k")).distinct().collect()}
    assert set(spark_keys[urls[0]]) == {"a.b.example.org", "b.example.org", "example.org", "org", "a.b.example.org/x/", "a.b.example.org/x/y/"}
    rows = url_filters.judged(c, e).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.row.url, r.row.fetched, r.blocked, r.pattern, r.n_active) for r in rows), key=key) == sorted(((u, f, *slow(u, f)) for u, f, _, _ in captures), key=key)
    assert url_filters.judged(c.limit(0), e).count() == 0 and url_filters.judged(c, e.limit(0)).filter("blocked").count() == 0


def test_path_patterns_keep_their_case_and_need_no_last_slash(spark):
    day = datetime.date(2024, 1, 1)
    urls = ["http://Host.org/Ads/x.html", "http://host.org/ads/x.html", "http://host.org/Adsense", "http://host.org/a//B", "http://host.org/a/b", "http://host.org"]
    want = {  # by hand: which of the urls each pattern covers
        "host.org/Ads/": [0], "HOST.org/Ads": [0], "host.org/ads": [1], "host.org/ads//": [1], "host.org/Ads/x.html": [0], "Host.ORG": [0, 1, 2, 3, 4, 5],
        "host.org/a/B": [3], "host.org/a//B/": [3], "host.org/a": [3, 4], "ost.org/a": [], "/Ads": [], "host.org/A": [], "": [],
    }
    captures = spark.createDataFrame([(u, day) for u in urls], "url string, fetched date")
    for pattern, covered in want.items():
        entries = spark.createDataFrame([(True, pattern, True, day)], "blocks boolean, pattern string, active boolean, since date")
        assert sorted(urls.index(r.row.url) for r in url_filters.judged(captures, entries).filter("blocked").collect()) == covered, pattern
    both = spark.createDataFrame([(True, "host.org/Ads", True, day), (True, "HOST.org/Ads/", False, day), (True, "host.org/ads", True, day)], "blocks boolean, pattern string, active boolean, since date")
    assert {(r.pattern, r.until) for r in url_filters.intervals(both).collect()} == {("host.org/Ads/", None), ("host.org/ads/", None)}


def test_chat_windows_retain_all_opening_system_turns(spark):
    # By conversation: its turns in order; two opening system turns and a late one, one after a null turn, a sole one.
    said = {
        1: [(0, "system", "first rule"), (1, "system", "second rule"), (2, "user", "hi"), (3, "system", "late rule"), *((i, "user", "x" * 150) for i in range(4, 30))],
        2: [(None, "system", "null rule"), (0, "system", "zero rule"), *((i, "assistant", "y" * 150) for i in range(1, 20))],
        3: [(0, "assistant", "z"), (0, "system", "same number"), *((i, "user", "z" * 150) for i in range(1, 20))],
        None: [(0, "system", "no one's rule"), *((i, "user", "w" * 150) for i in range(1, 20))],
    }
    turns = spark.createDataFrame([(c, *t) for c, ts in said.items() for t in ts], "conv_id long, turn long, role string, text string")
    rows = chat.windows(turns, budget=64, history=60).orderBy("conv_id", "window").collect()
    for c, opening in ((1, ["first rule", "second rule"]), (2, ["null rule", "zero rule"]), (3, []), (None, ["no one's rule"])):
        own = [r.formatted for r in rows if r.conv_id == c]
        heads = [f"<|turn|>system\n{x}<|end|>\n" for x in opening]
        assert len(own) > 5 and all(f.startswith("".join(heads)) for f in own), own[-1]
        assert all(f.count("rule<|end|>") == len(opening) for f in own[4:]) and all(f.count(h) == 1 for f in own for h in heads)
    # The late turns stand in their own window and, as history, in the next one where it is near.
    assert sum("late rule" in r.formatted for r in rows) > 1 and sum("same number" in r.formatted for r in rows) > 1
    read = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.conversations(chat.read_turns(spark.createDataFrame(rows))).collect()}
    assert read == {c: [t[1:] for t in ts] for c, ts in said.items()}


def test_whole_chat_windows_hold_their_budgets(spark):
    """Many opening system turns: what a window repeats does not grow with their number."""
    size = lambda s: 4 + -(-len(s.encode()) // 4)
    sums = {}
    for n in (50, 100):
        turns = spark.createDataFrame([(1, i, "system", "s" * 100) for i in range(n)] + [(1, i, "user", "u" * 100) for i in range(n, n + 40)] + [(2, 0, "system", "s" * 900), *((2, i, "user", "u" * 90) for i in range(1, 20))], "conv_id long, turn long, role string, text string")
        rows = chat.windows(turns, budget=128, history=40).collect()
        for r in rows:
            held = [x.partition("\n")[2].removesuffix("<|end|>\n") for x in r.formatted.split("<|turn|>")[1:]]
            first = 229 if r.conv_id == 2 else 0
            assert sum(map(size, held)) <= 128 + 40 + 64 + first or len(held) == 1
            assert r.conv_id == 1 or held[0] == "s" * 900
        sums[n] = sum(len(r.formatted) for r in rows if r.conv_id == 1)
        read = {r.conv_id: len(r.turns) for r in chat.conversations(chat.read_turns(chat.windows(turns, budget=128, history=40))).collect()}
        assert read == {1: n + 40, 2: 20}
    assert sums[100] < 2 * sums[50]


def test_chat_windows_read_back_and_budgets_hold(spark):
    rng = random.Random(6)
    texts = ["sys <|x", "a<|\\|turn|>b <\\\\|", "<|end|>\n<|turn|>user\nhi", "", None, "é" * 700, "x" * 300, "<|turn|>", "<\\|", "end", "</s>[INST] ok [/INST]"]
    rows = [(c, i, "system" if i == 0 and c % 2 == 0 else rng.choice(("assistant", "user", "sys\nt<|")), rng.choice(texts)) for c in range(6) for i in range(rng.choice((1, 7, 300)))]
    rows += [(None, 0, "assistant", "of no one"), (9, 0, None, "x"), (9, 0, "user", "tie"), (9, 0, "user", "tie"), (9, None, "assistant", "first")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string").repartition(3)
    windows = chat.windows(turns, budget=64, history=20)
    read = {r.conv_id: r for r in chat.conversations(chat.read_turns(windows)).collect()}
    own = {}
    for c, i, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    assert read.keys() == own.keys()
    for c, want in own.items():
        assert [tuple(t) for t in read[c].turns] == want
        assert read[c].loss_text == "".join(t for r, t in want if r == "assistant")
    size = lambda s: 4 + -(-len(s.encode()) // 4)
    for r in chat.read_turns(windows).collect():
        assert sum(size(t.text) for t in r.turns) <= 64 or len(r.turns) == 1
    later = windows.filter("conv_id = 0").orderBy("window").collect()
    assert len(later) > 1 and all(w.formatted.startswith("<|turn|>system\n") for w in later) and any(w.n_repeated > 1 for w in later)
    assert chat.conversations(chat.read_turns(chat.windows(turns.limit(0)))).count() == 0


def repeat_case():
    rng = random.Random(1)
    w = lambda n: "".join(rng.choice("abcdef é") for _ in range(n))
    p, r, base = w(300), w(230), w(900)
    texts = [w(50) + p + w(100), w(120) + p, p + w(30), p[:250], w(10), "", None, "ab" * 300, w(20) + "ab" * 150, r + w(5), w(3) + r[10:], p]
    for _ in range(20):
        own = list(base)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(900)] = "Z"
        texts.append("".join(own))
    return texts + [w(60 + i) + p + w(40) for i in range(20)] + ["".join(prose(rng, 3000))] * 2


def repeated_by_table(texts: list[bytes], length: int, keep_first: bool) -> list[list[tuple[int, int]]]:
    """The spans by a table of all strings, for tests."""
    seen: dict[bytes, list[tuple[int, int]]] = {}
    for d, data in enumerate(texts):
        for i in range(len(data) - length + 1):
            seen.setdefault(hashlib.sha256(data[i : i + length]).digest(), []).append((d, i))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for places in seen.values():
        for d, i in places[1:] if keep_first else places if len(places) > 1 else []:
            spans[d].append((i, i + length))
    return [suffix_dedup.merged(x) for x in spans]


@pytest.mark.parametrize(("length", "gram", "keep_first", "crowd"), [(200, 32, False, 400), (200, 32, False, 3), (64, 8, True, 3), (64, 8, True, 400)])
def test_repeated_strings_equal_brute_force(spark, length, gram, keep_first, crowd):
    texts = repeat_case()
    docs = documents(spark, texts)
    want = repeated_by_table([(t or "").encode() for t in texts], length, keep_first)
    rows = suffix_dedup.without_repeats(docs, length, keep_first, gram=gram, crowd=crowd).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans, data = want[r.row.doc_id], (texts[r.row.doc_id] or "").encode()
        assert [(s.start, s.end) for s in r.spans] == spans
        ends, starts = [0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)]
        assert bytes(r.kept) == b"".join(data[e:s] for e, s in zip(ends, starts, strict=True)) and r.n_bytes - r.n_removed == len(r.kept)


def test_equal_rolling_hashes_of_different_strings_are_told_apart(monkeypatch):
    contexts = [b"abcd", b"abce", b"abcd", b"xabcd"]
    args = (contexts, suffix_dedup.np.array([0, 0, 0, 0]), suffix_dedup.np.array([0, 0, 0, 1]), suffix_dedup.np.arange(4), 4)
    plain = [[x.tolist() for x in suffix_dedup.repeated_starts(*args, first)] for first in (True, False)]
    assert plain == [[[], [], [0], [1]], [[0], [], [0], [1]]]
    monkeypatch.setattr(suffix_dedup, "_powers", lambda base, n: suffix_dedup.np.zeros(n, suffix_dedup.np.uint64))
    assert [[x.tolist() for x in suffix_dedup.repeated_starts(*args, first)] for first in (True, False)] == plain


def test_anchors_of_texts_longer_than_a_piece(monkeypatch):
    rng = random.Random(2)
    data = bytes(rng.choices(b"abcd ", k=50_000))
    whole = suffix_dedup.Anchors(200, 32).of(data)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    parts = suffix_dedup.Anchors(200, 32).of(data)
    assert whole[0].tolist() == parts[0].tolist() and (whole[1] == parts[1]).all()


def test_repeated_rows_and_ids(spark):
    text = "".join(random.Random(3).choices("abc ", k=400))
    docs = documents(spark, [text, text, text, None, None], [1, 1, None, None, 2])
    both = {(r.row.doc_id, r.n_removed) for r in suffix_dedup.without_repeats(docs, keep_first=False).collect()}
    assert both == {(1, 400), (None, 400), (None, 0), (2, 0)}
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0
