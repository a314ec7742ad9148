"""Archives and page text."""

import base64
import hashlib

import pytest

from tabflow.llm import html_text, warc
from tabflow.llm.common import materialise
from tabflow.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, body string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


ROWS = [(5, "http://a/5", "<p>same"), (3, "http://a/3", "<p>same"), (9, "http://a/9", "<p>other é\r\n\r\n"), (4, "http://a/4", None), (6, None, ""), (2, "http://x y\r\nz", "<p>two"),
        (7, "http://a/7", "<p>rep"), (7, "http://a/7", "<p>rep"), (7, "http://a/8", "<p>rep"), (None, "http://n", "<p>same"), (None, "http://n", "<p>null")]


def test_archives(spark):
    got = sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.deduplicated_archives(spark, _pages(spark, ROWS)).collect()), key=str)
    sha = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    expected = [
        (5, "http://a/5", "<p>same", "revisit", 3), (3, "http://a/3", "<p>same", "response", None), (9, "http://a/9", "<p>other é\r\n\r\n", "response", None), (4, "http://a/4", None, "response", None),
        (6, "", "", "revisit", 4), (2, "http://x%20y%0D%0Az", "<p>two", "response", None), (7, "http://a/7", "<p>rep", "response", None), (7, "http://a/7", "<p>rep", "revisit", 7),
        (7, "http://a/8", "<p>rep", "revisit", 7), (None, "http://n", "<p>same", "revisit", 3), (None, "http://n", "<p>null", "response", None)]
    assert got == sorted(((p, u, len((h or "").encode()), sha(h), k, r) for p, u, h, k, r in expected), key=str)


def test_short_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.deduplicated_archives(spark, _pages(spark, rows), min_bytes=6).collect()}
    assert got == {(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)}


def test_no_pages(spark):
    assert warc.deduplicated_archives(spark, _pages(spark, [])).collect() == []
    assert html_text.main_text(spark, _pages(spark, [])).collect() == []


def test_a_damaged_archive_is_noticed(spark):
    folder = scratch_path(spark, "test-warc")
    rows = warc.resolve(_pages(spark, ROWS)).withColumn("repeats", warc.F.lit(True))
    archives = materialise(spark, warc.write_archives(rows, folder, "2020-01-01T00:00:00Z"), "test-index")
    assert warc.read_archives(archives, folder).count() == len(ROWS)
    fs, _ = warc.file_system(folder)
    name = archives.first().file
    with fs.open_input_stream(name, compression=None) as f:
        data = f.read()
    with fs.open_output_stream(name, compression=None) as f:
        f.write(data[:-5])
    with pytest.raises(Exception):
        warc.read_archives(archives, folder).collect()


def _page(article, before="", after=""):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if(a<b)"</p>"</script></head><body><nav><ul><li><a href="/x">menu one</a></ul></nav>{before}<article>{article}</article>{after}<footer>&copy; me</footer></body></html>'


TEXT = "some words of the article " * 8


@pytest.fixture(scope="module")
def weights(spark):
    rows = [(i, f"u{i}", _page(f"<h1>Head</h1><p>{TEXT}{i}<br>more<p>{TEXT}")) for i in range(30)]
    return html_text.learn(_pages(spark, rows))


@pytest.mark.parametrize("page, text", [
    (_page(f"<h1>A &amp; B</h1><p>{TEXT}x<b>y</b>\n z<br>w<p>end"), f"A & B {TEXT}xy z w end"),
    (_page(f"<p>{TEXT}", '<div class="cookie-notice"><p>we use cookies</p></div><aside>side bar</aside>', '<section id="comments"><p>first! nice post and more words</p></section>'), TEXT.strip()),
    (_page(f"<p>{TEXT}</p><div class=ad>buy now</div><form>mail me <input></form><p>{TEXT}"), f"{TEXT}{TEXT}".strip()),
    (f"<div><p>{TEXT}<p>{TEXT}", f"{TEXT}{TEXT}".strip()),
    ("plain words only", "plain words only"), ("", ""), ("<p>", ""), ("<", "<"), ("a < b", "a < b"), ("<p>x<!-- y", "x"), ("<script>never closed", ""), ('<p class="a>b">q', "q"),
])
def test_regions(weights, page, text):
    assert html_text.extract(page, weights) == " ".join(text.split())


def test_pages_keep_their_rows(spark):
    long = "<p>" + "word " * 60_000
    rows = [(1, "u", _page(f"<p>{TEXT}")), (1, "u", _page(f"<p>{TEXT}")), (None, None, None), (3, "v", long)]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.main_text(spark, _pages(spark, rows)).collect()), key=str)
    assert got == sorted([(1, "u", TEXT.strip(), len(TEXT) - 1)] * 2 + [(None, None, "", 0), (3, "v", ("word " * 60_000).strip(), 299_999)], key=str)


WORDS = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize("page", [
    f'<body class="no-sidebar page"><p>{WORDS}</p></body>', f'<article class="post comments-open"><p>{WORDS}</p></article>', f'<div class="site has-header"><p>{WORDS}</p></div>',
    f'<main id="comments"><p>{WORDS}</p></main>', f'<html class="modal-open"><body class="login"><div class="with-banner"><p>{WORDS}</p></div></body></html>'])
def test_layout_names_drop_no_article(page):
    assert html_text.extract(page, html_text.Weights({})) == WORDS


@pytest.mark.parametrize("name", ["sidebar-left", "ad", "cookie-notice", "site-footer", "box related-posts", "post-comments"])
def test_named_asides_are_left_out(name):
    page = f'<p>{WORDS}</p><div class="{name}"><p>{"buy now " * 100}</p></div><p>{WORDS}</p>'
    assert html_text.extract(page, html_text.Weights({})) == f"{WORDS} {WORDS}"


def test_menus_of_plain_lists_do_not_tell_on_lists_of_text(spark):
    menu = "<ul>" + "".join(f'<li><a href="/{k}">go there {k}</a></li>' for k in range(40)) + "</ul>"
    rows = [(i, "u", f"<html><body>{menu}<article><h1>Title {i}</h1><p>{WORDS}</p></article></body></html>") for i in range(30)]
    text = f"Head {WORDS} one two three four and more of it {WORDS}"
    rows.append((99, "u", f"<body>{menu}<article><h1>Head</h1><p>{WORDS}</p><ul><li>one two three</li><li>four and more of it</li></ul><p>{WORDS}</p></article></body>"))
    got = {r.page_id: r.text for r in html_text.main_text(spark, _pages(spark, rows)).collect()}
    assert got[99] == text and got[3] == f"Title 3 {WORDS}"


def test_the_region_is_the_best_of_all():
    """The scan against all contiguous regions of random tokens."""
    import random

    rng = random.Random(3)
    weights = html_text.Weights({})
    weights.of = {"word:p": 1.0, "word:div": 0.4, "word:li:link": -1.5, "aside:div": -2.0, "tag:p": -0.7, "tag:/p": -0.2, "tag:div": -1.1}
    for _ in range(60):
        page = "".join(rng.choice([f"<p>{'a ' * rng.randrange(4)}</p>", f"<div>{'b ' * rng.randrange(5)}</div>", "<li><a href=x>c c</a></li>", '<div class="ad">d d d</div>']) for _ in range(rng.randrange(1, 12)))
        seen = html_text.tokens(page)
        score = [weights[k] * (w if k.startswith("word:") else min(w, 1) if k.startswith("aside:") else 1) for k, w, *_ in seen]
        best = max((sum(score[i:j]) for i in range(len(seen)) for j in range(i, len(seen) + 1)), default=0)
        options = {" ".join(t for k, _, t, _, _ in seen[i:j] if k.startswith("word:")).split().__str__() for i in range(len(seen)) for j in range(i, len(seen) + 1) if abs(sum(score[i:j]) - best) < 1e-9}
        assert str(html_text.extract(page, weights).split()) in options
