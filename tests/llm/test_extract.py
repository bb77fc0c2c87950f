import re

import pytest

from cadenza.llm import extract

BODY = (
    '<!DOCTYPE html><html><head><title>No title</title><style>p{x:1}</style><script>var t="</p>";</script></head><body>'
    "<nav><ul><li><a href='/a'>Menu</a></li><li><a href='/b'>About us</a></li></ul></nav><!-- a comment -->"
    '<div class="ad">Buy this thing now please</div>'
    "ARTICLE_HERE"
    "<footer>&copy; someone &middot; some words at the end</footer></body></html>"
)
ARTICLE = (
    "<article><h1>A  head\n line</h1><p><b>First &amp; foremost.<br>Then more<p>Second block with <a href=x>a link</a> inside.</p>"
    '<div class="ad-box">Sponsored words</div><form><input name=q><button>Send</button></form>'
    "<blockquote>Quoted words here, as many as a sentence has.</blockquote><aside>By the way</aside><script>alert(1)</script>"
    "<ul><li>one item of a list of things</li><li>two item with some words too</li></ul><p>Last &#233;l&eacute;ment &lt;tag&gt; closes what has been said.</p></article>"
)
WANT = (
    "A head line\n\nFirst & foremost. Then more\n\nSecond block with a link inside.\n\nQuoted words here, as many as a sentence has.\n\none item of a list of things\n\n"
    "two item with some words too\n\nLast élément <tag> closes what has been said."
)


def page_of(article):
    return BODY.replace("ARTICLE_HERE", article)


@pytest.fixture(scope="module")
def weights(spark):
    return extract.learn(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_article_without_its_surroundings(weights):
    assert extract.main_text(page_of(ARTICLE), weights) == WANT


def test_page_that_marks_nothing(weights):
    plain = ARTICLE.replace("article>", "div>")
    assert extract.main_text(page_of(plain), weights) == WANT
    comments = '<div id="comments"><p>Reader one says a lot of words here today.</p><p>Reader two too, no less.</p></div>'
    assert extract.main_text(page_of(plain + comments), weights) == WANT


def test_learning_tells_elements_apart(weights):
    assert weights["w:p"] > 0
    assert all(v < 0 for k, v in weights.items() if k.startswith("t:"))


def test_region_is_the_best_run(weights):
    for page in (page_of(ARTICLE), "<p>a b c</p><hr><hr><div>d e f g</div>", "<li><li><li>", "plain words only", "<nav>a b c</nav>"):
        values = [extract.score(t, weights) for t in extract.tokens(page)]
        best = max([0.0, *(sum(values[a:b]) for a in range(len(values)) for b in range(a + 1, len(values) + 1))])
        assert sum(extract.score(t, weights) for t in extract.region(page, weights)) == pytest.approx(best)


def test_broken_markup_does_not_crash(weights):
    for page in ("<", "<p", "<!-- never closed", "<script>x", "</p></p></div>", "<p a='", '<div class="x" <p>words</p>', "&bogus; &amp", "<p><p><p>x", "\x00<b>퟿</b>"):
        assert isinstance(extract.main_text(page, weights), str)


def test_rows(spark):
    rows = [(1, "u", page_of(ARTICLE), "x"), (None, None, None, None), (2, "v", "", ""), (1, "u", page_of(ARTICLE), "x"),
            (3, "w", page_of("<article>" + "<p>many words again and again.</p>" * 20_000 + "</article>"), "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"] > 0) for r in got) == [(0, False), (1, True), (1, True), (2, False), (3, True)]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert next(r for r in got if r["page_id"] == 3)["text"].count("\n\n") == 19_999
    assert extract.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("opened", ["<body class='single no-sidebar'>", "<body><div id=main class='with-sidebar'>", "<body><div class=has-header><div role=search>"])
def test_wrappers_with_marked_classes(weights, opened):
    page = page_of(ARTICLE).replace("<body>", opened)
    assert extract.main_text(page, weights) == WANT
    assert any(article and element != extract.BOILER for _, _, element, article in extract.tokens(page))
    assert extract.main_text(page.replace("article>", "div>"), weights) == WANT


@pytest.mark.parametrize("opened", ["<article class='post comment-status-open'>", "<main class='has-header'>", "<article><div class='social-story'>"])
def test_article_elements_with_marked_classes(weights, opened):
    closed = "</main>" if "main" in opened else "</article>"
    page = page_of(ARTICLE.replace("<article>", opened).replace("</article>", closed))
    assert extract.main_text(page, weights) == WANT


def test_long_comments_beside_an_article_stay_out(weights):
    comments = '<div id="comments">' + "<p>Reader one says a lot of words here today.</p>" * 50 + "</div>"
    for page in (page_of(ARTICLE + comments), page_of('<div class="with-sidebar">' + ARTICLE + comments + "</div>")):
        assert extract.main_text(page, weights) == WANT


def test_captions_and_headlines_of_an_article(weights):
    text = "<p>Words of a paragraph that is as long as one line.</p>"
    for opened in ("<header>", "<header class='entry-header'>", "<div class='post-header'>"):
        closed, head = ("</div>", "A headline of eight words stands right here") if "div" in opened else ("</header>", "A headline")
        article = f"<article>{opened}<h1>{head}</h1>{closed}{text}<figure><img src=x><figcaption>A caption</figcaption></figure>{text}</article>"
        site = page_of("<header>Name of the site</header>" + article)
        assert extract.main_text(site, weights).split("\n\n") == [head, text[3:-4], "A caption", text[3:-4]]


@pytest.mark.parametrize("empty", ['<svg class="i"/>', "<svg/>", '<iframe src="x" />', "<textarea/>", "<script src='x'/>"])
def test_raw_elements_that_close_themselves(weights, empty):
    for rest in ("", "<script>var a = 1 < 2;</script>", "<svg><path d='x'/><text>drawn words</text></svg>"):
        assert extract.main_text(f"<article><p>one</p>{empty}<p>two three</p>{rest}</article>", weights) == "one\n\ntwo three"
    assert extract.main_text("<article><p>one two</p><textarea/>typed words</textarea><p>three</p></article>", weights) == "one two\n\nthree"


@pytest.mark.parametrize("inner", [
    '<p class="alert">An alert that is part of the text.</p>', '<p>Press <kbd class="menu">File</kbd> and go on.</p>',
    '<p>A <span class="search-highlight">match</span> in a line.</p>', '<div class="alert notice"><p>Mind the step here.</p></div>',
    '<h2 class="page-header">A headline with a class</h2>', '<ul class="menu-of-the-day"><li>Soup of the day</li></ul>',
    '<blockquote class="comment">Quoted words of someone.</blockquote>', '<p id="form">The form of a sonnet.</p>',
])
def test_words_in_classes_do_not_cut_an_article(weights, inner):
    around = "<p>Words of a paragraph that is as long as one line.</p>"
    got = extract.main_text(page_of(f"<article>{around}{inner}{around}</article>"), weights).split("\n\n")
    plain = re.sub("<[^>]*>", "", inner)
    assert got == ["Words of a paragraph that is as long as one line.", plain, "Words of a paragraph that is as long as one line."]


def test_tables_within_an_article_stay(weights):
    around = "<p>Words of a paragraph that is as long as one line.</p>"
    table = "<table>" + "".join(f"<tr><th>row {i}</th><td>{i}</td></tr>" for i in range(20)) + "</table>"
    got = extract.main_text(page_of(f"<article>{around}{table}{around}</article>"), weights).split("\n\n")
    assert got[0] == got[-1] and got[1:-1] == [t for i in range(20) for t in (f"row {i}", str(i))]


def test_adverts_and_comments_within_an_article_go(weights):
    around = "<p>Words of a paragraph that is as long as one line.</p>"
    for name in ("ad", "comments", "social-share", "related"):
        got = extract.main_text(page_of(f"<article>{around}<div class='{name}'><p>Other words</p></div>{around}</article>"), weights)
        assert got.split("\n\n") == ["Words of a paragraph that is as long as one line."] * 2


def test_headings_with_classes_outside_of_articles(weights):
    page = "<body><nav><a href=x>Menu</a></nav><div><h1 class='page-header'>A headline of the page</h1><p>" + "Many words follow here. " * 9 + "</p></div></body>"
    assert extract.main_text(page, weights).startswith("A headline of the page\n\nMany words")
