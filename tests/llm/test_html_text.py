"""Main-text extraction on small pages with a known article."""

import pytest

from stratum.llm import html_text as H

PARA = "This is a paragraph of the article with quite a few words in it, number {}."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


ARTICLE = "".join(f"<p>{PARA.format(i)}" for i in range(5))
WANT = "\n".join(PARA.format(i) for i in range(5))
NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About</a></li></ul></nav>"


@pytest.mark.parametrize("html", [
    page(f"{NAV}<article>{ARTICLE}</article><footer>&copy; us</footer>"),
    page(f"{NAV}<div id=content>{ARTICLE}</div><div class='sidebar'><p>Side text of some length here</p></div>"),
    page(f"<header><h1>Site</h1></header><main>{ARTICLE}</main><section id=comments><p>Nice post! I agree with all.</p></section>"),
    page(f"<div class='cookie-notice'>We use cookies and other things</div><div class='with-sidebar'>{ARTICLE}</div>"),
    page(f"<form><p>Your name and more words</p><input></form>{ARTICLE}<script>var t = '</p>';</script>"),
    page(f"<div class=ad>Buy this now, it is very cheap</div><!-- <p>hidden</p> --><div><div>{ARTICLE}</div></div>"),
    page(f"<article>{ARTICLE}<div class='post-comments'><p>First!</p></div><aside>Also read this</aside></article>"),
    page(f"<article><p>{PARA.format(0)}</p><script>if (a<b) x('<p>')</script>"
         + "".join(f"<p>{PARA.format(i)}</p>" for i in range(1, 5)) + "</article>"),
])
def test_article_without_furniture(html):
    assert H.main_text(html) == WANT


@pytest.mark.parametrize("html", [
    page(f"{NAV}<article class='post category-social'>{ARTICLE}</article><div class='sidebar'><p>Side text</p></div>"),
    page(f"{NAV}<article class='post tag-search'>{ARTICLE}<div class='post-comments'><p>First!</p></div></article>"),
    page(f"{NAV}<div class='side-by-side'>{ARTICLE}</div><div class='social-share'><p>Share this</p></div>"),
    page(f"{NAV}<div class='overlay'>{ARTICLE}</div>"),
    page(f"<main>{ARTICLE}<article class='comment'><p>Nice post!</p></article><dialog><p>Closed</p></dialog></main>"),
])
def test_class_words_do_not_remove_the_article(html):
    assert H.main_text(html) == WANT


@pytest.mark.parametrize("name", ["comments", "comments-area", "comment-list", "post-comments", "disqus_thread", "cookie-notice", "sidebar",
                                  "related-posts", "newsletter-box"])
@pytest.mark.parametrize("times", [1, 10, 100])
@pytest.mark.parametrize("box", ["<article class=story>{}</article>", "<div class=story>{}</div>"])
def test_furniture_never_wins_by_its_length(name, times, box):
    """A thread, notice or sidebar up to a hundred times as long as the article."""
    other = "".join(f"<p>Somebody else writes at length here, as always, entry {i}.</p>" for i in range(5 * times))
    assert H.main_text(page(f"{NAV}{box.format(ARTICLE)}<section class='{name}'>{other}</section>")) == WANT


@pytest.mark.parametrize("part", [
    "<section class='related-work'><p>{}</p></section>", "<p class=alert>{}</p>", "<div class='hidden-gem'><p>{}</p></div>",
    "<p class='side-note'>{}</p>", "<div class='share-price'><p>{}</p></div>", "<h2 id='search-results'>{}</h2>", "<p id='login-flow'>{}</p>",
    "<div class='banner'><p>{}</p></div>", "<ul class=tags><li>{}</li></ul>", "<div class='advertising-history'><p>{}</p></div>"])
def test_words_inside_the_article_remove_nothing(part):
    assert H.main_text(page(f"{NAV}<article>{ARTICLE}{part.format(PARA.format(9))}</article>")) == WANT + "\n" + PARA.format(9)


def test_everything_shown_inside_the_article_is_kept():
    html = page(f"{NAV}<article>{ARTICLE}<figure><img src=x><figcaption>A caption</figcaption></figure><p><label>Term</label> one</p>"
                "<fieldset><p>Boxed</p></fieldset><dialog open><p>Said</p></dialog>"
                "<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be</p>"
                "<p><object data=y>fallback</object> <canvas>drawn</canvas></p></article>")
    assert H.main_text(html) == "\n".join([WANT, "A caption", "Term one", "Boxed", "Said", "Let x=1 be", "fallback drawn"])


def test_references_white_space_and_blocks():
    html = page("<article><h1>A &amp; B</h1><p>one\n  <b>two</b>\tthree<br>four &lt;x&gt; &#233;&#x41;</p><ul><li>i<li>ii</ul></article>")
    assert H.main_text(html) == "A & B\none two three four <x> éA\ni\nii"


def test_split_article_is_joined():
    html = page(f"{NAV}<div class=row><div class=a>{ARTICLE}</div><div class=b><p>{PARA.format(9)}</p></div></div>")
    assert H.main_text(html) == WANT + "\n" + PARA.format(9)


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""), ("<script>x</script>", ""),
    ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("</div></p>x", "x"), ("<a href='x", ""),
    ("<div>" * 5000 + "deep", "deep"), ("<p title=it's>a</p><p title=\"b>c\">d</p>", "a\nd"),
])
def test_odd_pages(html, want):
    assert H.main_text(html) == want


def test_long_page_is_kept_whole():
    paras = [PARA.format(i) for i in range(20_000)]
    assert H.main_text(page("<article>" + "".join(f"<p>{p}</p>" for p in paras) + "</article>")) == "\n".join(paras)


def test_table_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "old"), (1, "u", None, "old"), (None, None, "", None), (None, None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    out = H.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in out.collect()) == [0, 0, 0, len(WANT)]
    assert H.extract(df.limit(0)).count() == 0
