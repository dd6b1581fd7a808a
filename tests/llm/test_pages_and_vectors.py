"""HTML extraction by hand-made pages; top-k search by brute force."""

import numpy as np
import pytest

from barframe.llm import topk_search
from barframe.llm.html_extract import extract, extract_pages
from barframe.llm.topk_search import top_k

BODY = "This is the first paragraph of the article, with commas, and a full stop. It goes on for a while, as texts do."
MORE = "The second one, which follows, has its own sentences; it is also long enough to count. See?"


def page(main, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News, more</a></li></ul></nav>{before}{main}{after}"
            f"<footer>&copy; example, all rights. Words, words, words.</footer></body></html>")


def test_article():
    html = page(f"<article><h1>Title here</h1><p>{BODY}<p><b>{MORE}<br><p>Short.</article>", "<!-- ad --><div class=\"ad\">Buy this, now, today.</div>")
    assert extract(html) == f"Title here {BODY} {MORE} Short."


def test_div_page_with_sidebar_comments_and_forms():
    html = page(f"<div class='post'><p>{BODY}</p><p>{MORE}</p></div>",
                f"<div id=sidebar><p>{BODY}</p></div><div class='cookie-notice'><p>We use cookies, as you know, to improve.</p></div>",
                f"<section class='reader-comments'><p>I liked this, really, a lot. {MORE}</p></section><form><p>{BODY}</p><input></form><aside><p>{MORE}</p></aside>")
    assert extract(html) == f"{BODY} {MORE}"


def test_inline_markup_entities_and_space():
    html = page("<article><p>One&nbsp;&amp;  <a href='x'>two</a>,\n three<script>no()</script> f<em>ou</em>r. &lt;five&gt; and, so, on.</p></article>")
    assert extract(html) == "One & two, three four. <five> and, so, on."


@pytest.mark.parametrize("html", [None, "", "   ", "<html></html>", "<p", "<!-- open", "<script>x", "<nav><p>Menu, all.</p></nav>"])
def test_nothing_to_find(html):
    assert extract(html) == "" or html == "<p"


def test_long_page_is_linear_and_whole():
    n = 20_000
    html = page("<article>" + "".join(f"<p>Sentence {i}, of many.</p>" for i in range(n)) + "</article>")
    assert extract(html) == " ".join(f"Sentence {i}, of many." for i in range(n))


def test_pages_rows(spark):
    rows = [(1, "u", page(f"<article><p>{BODY}</p></article>"), 1), (1, "u", None, 2), (None, None, "", 3)]
    got = extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("", 0), (BODY, len(BODY))]
    assert extract_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def brute(rows, k=20, every=20):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    ints = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in ok]
    out = set()
    for q, a in ints:
        if q % every == 0:
            best = sorted((-int(a @ b), i) for i, b in ints if i != q and len(b) == len(a))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id bigint, embedding array<float>, label int, norm double")


def found(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_top_k_by_brute_force(spark, monkeypatch, spread):
    """Equal lengths, and lengths over several buckets; small parts, so that all kinds of pruning run."""
    monkeypatch.setattr(topk_search, "PART", 50)
    monkeypatch.setattr(topk_search, "QUERY_PART", 4)
    monkeypatch.setattr(topk_search, "SEEDS", 30)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8))
    v = v / np.linalg.norm(v, axis=1)[:, None] * np.exp(spread * rng.normal(size=300))[:, None]
    v[50:90] = v[50]  # ties
    rows = [(i, x.tolist()) for i, x in enumerate(v.astype(np.float32))]
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")] * 8), (460, []), (None, [1.0] * 8), (480, [0.0] * 8), (500, [1.0, 2.0]), (501, [1.0, -2.0]), rows[20], rows[21]]
    assert found(top_k(vectors(spark, rows))) == brute(rows)


def test_top_k_few_and_none(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.5, 0.5]), (2, [-1.0, 0.25])]
    assert found(top_k(vectors(spark, rows))) == brute(rows)
    assert top_k(vectors(spark, rows).limit(0)).count() == 0


def test_top_k_leaves_out_what_is_not_exact(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [1e30]), (20, [16384.0])]
    assert found(top_k(vectors(spark, rows))) == brute([r for r in rows if r[0] != 2])


@pytest.mark.parametrize("size", [3e4, 3e6, 5e6])
def test_top_k_takes_long_vectors(spark, monkeypatch, size):
    """Long vectors are queries and candidates, and products that doubles round are exact."""
    monkeypatch.setattr(topk_search, "SEEDS", 30)
    rng = np.random.default_rng(2)
    v = (rng.normal(size=(120, 6)) * np.where(np.arange(120) % 3, 1.0, size)[:, None]).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(200, [size, size / 2, 1.0, 0.0, 0.0, 0.0]), (201, [size, size / 2, 0.984375, 0.0, 0.0, 0.0])]
    assert found(top_k(vectors(spark, rows))) == brute(rows)


def test_top_k_ranks_by_scores_beyond_bigint(spark):
    rows = [(0, [2.0 ** 50]), (1, [2.0 ** 50]), (2, [2.0 ** 51]), (3, [-(2.0 ** 52)]), (4, [1.0])]
    assert found(top_k(vectors(spark, rows))) == {(0, 1, 2, 2 ** 63 - 1), (0, 2, 1, 2 ** 63 - 1), (0, 3, 4, 2 ** 62), (0, 4, 3, -2 ** 63)}


@pytest.mark.parametrize("name", ["layout with-sidebar", "has-sidebar", "no-sidebar", "comments-open post", "page-content menu-open"])
def test_modifiers_do_not_bar_the_text(name):
    inner = f"<p>{BODY}</p><p>{MORE}</p>"
    assert extract(page(f"<div class='{name}'>{inner}</div>")) == f"{BODY} {MORE}"
    assert extract(page(f"<div class='{name}'><article>{inner}</article></div>")) == f"{BODY} {MORE}"


def test_article_in_a_barred_wrapper_form_or_widgets():
    inner = f"<p>{BODY}</p><p>{MORE}</p>"
    assert extract(page(f"<form id=aspnetForm>{inner}</form>")) == f"{BODY} {MORE}"
    assert extract(page(f"<div class=sidebar-layout><main>{inner}</main></div><div class=ad><p>{MORE}</p></div>")) == f"{BODY} {MORE}"
    assert extract(page("".join(f"<div class='elementor-widget-container'><p>{x}</p></div>" for x in (BODY, MORE)))) == f"{BODY} {MORE}"
    assert extract(page(f"<article><div class='entry-header'><h1>A heading, of some length.</h1></div>{inner}</article>")) == f"A heading, of some length. {BODY} {MORE}"
    assert extract(page(f"<div class=overlay>{inner}</div>")) == f"{BODY} {MORE}"  # nothing else scores


def test_roles_bar_even_where_they_are_long():
    inner = f"<p>{BODY}</p><p>{MORE}</p>"
    for name in ("comments", "reader-comments", "related", "sidebar", "sidebar-right", "is-hidden"):
        assert extract(page(f"<div class=post>{inner}</div>", "", f"<div class='{name}'>{inner * 5}</div>")) == f"{BODY} {MORE}"
    assert extract(page(f"<article>{inner}</article>", "", f"<div class=related-posts><article><p>{MORE}</p></article></div>")) == f"{BODY} {MORE}"
