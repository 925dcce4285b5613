from loomstar.llm import html_text

ARTICLE = "<article><h1>Title {k}</h1><p>First &amp; {k}<br>line\n two<p>Second <b>bold</b> {k}</p></article>"
WANTED = "Title {k}\nFirst & {k} line two\nSecond bold {k}"


def text(page, boilerplate=frozenset()):
    return html_text.main_text(page, boilerplate)


def test_named_noise_goes_and_blocks_are_joined():
    page = (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x='</p><p>no';</script></head><body>"
        "<header>Head</header><nav><ul><li><a href='x'>Menu</a></ul></nav><!-- c --><div class='ad'>Buy</div>"
        + ARTICLE.format(k=1)
        + "<section class='comments'><article>Reader</article></section><aside>Side</aside><form>F<input></form>"
        "<div id='cookie-notice'>C</div><footer>&copy; F</footer></body></html>"
    )
    assert text(page) == WANTED.format(k=1)


def test_articles_keep_their_lists_tables_and_headers():
    page = "<main><header><h2>H</h2></header><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><div class='share'>s</div>e</main>"
    assert text(page) == "H\na\nb\nc\nd\ne"


def test_broken_and_odd_markup():
    assert text(None) == text("") == ""
    assert text("<p>a<p>b<div>c") == "a\nb\nc"
    assert text("<article><p>cut &am") == "cut &am"
    assert text("<article><p>cut <b") == "cut"
    assert text("<p>1 < 2 &lt;p&gt; &#233;&eacute;&nbsp;x") == "1 < 2 <p> éé x"
    assert text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert text("<article><p>" + "word " * 200_000 + "</article>") == ("word " * 200_000).strip()
    assert text("<script>never ends <p>x") == ""
    assert text("<article><p>a<select><option>no<option>no</select><svg><title>no</title></svg><p>b</article>") == "a\nb"
    assert text("<div><option>no</div><p>c<div><svg><path d='x'></div><p>d") == "c\nd"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as text", "0 as low")


def test_branches_that_repeat_over_a_host_go(spark):
    """Anonymous boilerplate is known by its entropy alone; the same markup elsewhere stays."""
    page = "<body><div class='x'>Same on all pages</div><div class='y'><p>Own text {k}</p><div>Try our news</div></div></body>"
    rows = [(k, f"http://a.example/{k}", page.format(k=k)) for k in range(12)]
    rows += [(50, "http://b.example/1", page.format(k=50))]
    out = {r.page_id: r for r in html_text.extract(pages(spark, rows)).collect()}
    assert all(out[k].text == f"Own text {k}" for k in range(12))
    assert out[50].text == "Same on all pages\nOwn text 50\nTry our news"
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_branches_inside_marked_articles(spark):
    page = "<article><h1>News</h1><p>Own {k}</p><div class='z'>Follow us</div></article>"
    out = html_text.extract(pages(spark, [(k, f"http://a.example/{k}", page.format(k=k)) for k in range(9)])).collect()
    assert {r.text for r in out} == {f"News\nOwn {k}" for k in range(9)}


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(k, "http://a.example/", "<body><div>One</div><p>page</p></body>") for k in range(30)]
    assert {r.text for r in html_text.extract(pages(spark, rows)).collect()} == {"One\npage"}


def test_nulls_and_repeats(spark):
    rows = [(1, None, None), (None, "no url", "<p>a"), (None, "no url", "<p>a"), (2, "http://h/", "")]
    out = html_text.extract(pages(spark, rows)).collect()
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in out) == [
        ("1", "None", "", 0), ("2", "http://h/", "", 0), ("None", "no url", "a", 1), ("None", "no url", "a", 1),
    ]


def test_importance_is_entropy(spark):
    page = "<body><div class='s'>same</div><div class='d'>{k}</div></body>"
    tree = html_text.style_tree(pages(spark, [(k, "http://a/", page.format(k=k)) for k in range(8)]))
    found = {bytes(r.path): (r.pages, r.importance) for r in tree.collect()}
    of = lambda label: html_text._path(html_text._path(b"", "body"), label)
    assert found[of("div.s")] == (8, 0.0)
    pages_, importance = found[of("div.d")]
    assert pages_ == 8 and abs(importance - 0.9) < 1e-9  # one presentation, all contents their own


STORY = "<article><h1>T</h1><p>The story of {k}</p></article>"


def test_names_are_no_verdict():
    """Each page keeps its story whatever its wrappers, headings and inline elements are called."""
    told = "T\nThe story of 1"
    story = STORY.format(k=1)
    for page in (
        f"<body class='has-sidebar'>{story}</body>", f"<html class='no-comments'><body>{story}", f"<form>{story}</form>",
        f"<div class='layout with-menu'>{story}<nav>Menu</nav></div>", f"<div class='header'><div id='search'>{story}</div></div>",
    ):
        assert text(page) == told
    assert text("<article><h1 class='ad-hoc'>T</h1><p class='social'>x</p><h2 id='search'>Y</h2></article>") == "T\nx\nY"
    assert text("<p>see <a class='related-link'>it</a> <span class='search-hit'>now</span></p>") == "see it now"


def test_text_outside_of_a_marked_article_stays():
    assert text("<div class='content'><p>The long story</p></div><article>Teaser</article>") == "The long story\nTeaser"
    assert text("<p>Lead</p>" + STORY.format(k=2)) == "Lead\nT\nThe story of 2"


def test_named_noise_goes_however_long():
    long = "<p>" + "much said " * 200 + "</p>"
    assert text(f"<div><p>Short story</p></div><div class='comments'>{long}</div>") == "Short story"
    assert text(f"{STORY.format(k=3)}<section class='comments'><article>{long}</article></section>") == "T\nThe story of 3"
    assert text(f"<nav>{long}</nav>") == text(f"<aside>{long}</aside>") == ""


def test_the_tree_decides_beside_and_inside_articles(spark):
    """Unnamed branches that repeat go, with and without <article>; the same ones on a host of few pages stay."""
    with_article = "<body><div class='q'>We are here for you</div>" + STORY + "</body>"
    without = "<body><div class='q'>We are here for you</div><div class='r'><p>The story of {k}</p></div></body>"
    rows = [(k, f"http://a.example/{k}", with_article.format(k=k)) for k in range(10)]
    rows += [(20 + k, f"http://b.example/{k}", without.format(k=20 + k)) for k in range(10)]
    rows += [(40 + k, f"http://c.example/{k}", without.format(k=40 + k)) for k in range(4)]
    out = {r.page_id: r.text for r in html_text.extract(pages(spark, rows)).collect()}
    assert all(out[k] == f"T\nThe story of {k}" for k in range(10))
    assert all(out[20 + k] == f"The story of {20 + k}" for k in range(10))
    assert all(out[40 + k] == f"We are here for you\nThe story of {40 + k}" for k in range(4))
