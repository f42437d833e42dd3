"""Main texts of awkward pages, and pages made to take long."""

import time

import pytest

from loantape.llm import html

P = "<p>The quick brown fox jumps over the lazy dog and it was not in the house when they came to see what had been there.</p>"
TEXT = P[3:-4]


@pytest.mark.parametrize("page", [
    '<div class="page has-sidebar"><article>%s</article></div>', '<div id="content" class="post no-comments">%s</div>',
    '<form id="aspnetForm"><div id="content">%s</div></form>', '<div class="header-fixed"><main>%s</main></div>',
    '<div class="sidebar-left"><main>%s</main></div>', '<div class="with-nav"><div class="entry">%s</div></div>',
    '<form><main>%s</main></form>', '<div class="banner-page"><article>%s</article></div>', "<main>%s<p <a <b", "<main>%s<!-- <p>x",
    "<main>%s</p></i></zz></main></main>", "<div hidden></div><main>%s", "<main><script>if (a</b) '<p>'</script>%s",
])
def test_articles_under_named_wrappers(page):
    assert html.main_text(page % P) == TEXT


@pytest.mark.parametrize("page", [
    '<div class="comments"><article>%s</article></div>', "<aside><article>%s</article></aside>", '<div class="related-posts"><article>%s</article></div>',
    "<footer>%s</footer>", "<form>%s</form>", '<div class="sidebar widget"><article>%s</article></div>', '<nav class="no-js">%s</nav>',
    '<div role="dialog">%s</div>', "<textarea>%s</textarea>", '<div aria-hidden="true">%s</div>', "<noscript>%s</noscript>",
])
def test_what_lies_beside_an_article_stays_out(page):
    assert html.main_text("<main>" + P + "</main>" + page % P.replace("quick", "slow")) == TEXT
    assert html.main_text(page % P) == ""


def test_paragraph_of_links_in_an_article():
    link = "<p><a href=x>What the writer and the others had to say about it in the end</a></p>"
    assert html.main_text(f"<article>{P}{link}{P}</article>").count("\n") == 2
    assert html.main_text(f"<article>{P}<ul><li><a href=x>More of this and of that and all the rest of it</a></li></ul></article>") == TEXT


def test_references_and_stray_marks():
    page = f"<main>{P}<p>a &lt; b &amp; c &#65;&#x42;&#0000000000067;&#{'9' * 6000};&#x{'f' * 6000}; 1 < 2 &nosuch; <3</p></main>"
    assert html.main_text(page) == TEXT + "\na < b & c ABC\ufffd\ufffd 1 < 2 &nosuch; <3"
    assert html.main_text("<") == html.main_text("</") == html.main_text("<a") == html.main_text("<!") == ""
    assert html.main_text("<main><p class='x\">" + P) == ""


N = 40_000
HOSTILE = {
    "open tags": "<p " * N * 8, "foreign ends": "<span>" * N + "</i>" * N, "ends across a block": "<q><div>" + "<b>" * N + "</q>" * N,
    "links": "<b><a>" * N + "</q>" * N, "lists": "<div>" * N + "</li>" * N, "comments": "<!--" * N * 6, "quotes": '<a b="' * N * 3,
    "marks": "<" * N * 25, "digits": "&#" + "1" * N * 25 + ";", "scripts": "<script>" * N * 3, "names": '<div class="' + "advert_" * N * 3 + '!">x',
    "attributes": "<a " + "b " * N * 12 + ">x", "declarations": "<!" * N * 12, "tables": "<table><tr><td>" * N, "sections": "<![CDATA[" * N * 3,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_is_linear(name):
    page, took = HOSTILE[name], []
    for part in (page[: len(page) // 4], page):
        began = time.process_time()
        html.main_text(part)
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.3


def test_very_long_page_is_whole():
    words = "there was once a time when all of this had been said by them "
    page = "<main>" + "".join(f"<p>{words * 4}{i}</p>" for i in range(8000)) + "</main>"
    assert html.main_text(page) == "\n".join(f"{words * 4}{i}" for i in range(8000))


def test_clashing_names_in_another_case(spark):
    table = spark.createDataFrame([(1, P, "x", 3), (2, None, "y", 4)], "page_id int, html string, Text string, N_CHARS int")
    got = html.extract(table)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert [(r.page_id, r.n_chars) for r in got.orderBy("page_id").collect()] == [(1, len(TEXT)), (2, 0)]


def test_clashing_names_of_other_operators(spark):
    import public_tokenizers

    from loantape.llm import bpe, language

    docs = spark.createDataFrame([(1, "ab ab", 7, "z", 0.5)], "doc_id int, text string, N_TOKENS int, Lang_Pred string, SCORE double")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert bpe.tokenise(docs, path, public_tokenizers.PATTERN, ["n_tokens"]).columns == ["doc_id", "text", "Lang_Pred", "SCORE", "n_tokens"]
    assert language.identify(docs, None).select("lang_pred", "score").collect()[0] == ("und", 0.0)
