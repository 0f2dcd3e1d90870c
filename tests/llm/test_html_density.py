import html as library
import re

import duckdb

from lexisift.llm.html_density import extract_main_text, main_text, op4_html_density


def test_boilerplate_goes_and_all_of_the_article_stays():
    page = """<html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><a href="/">Home</a></header><nav><ul><li><a href="a">One</a><li><a href="b">Two</a></ul></nav><div class="cookie-notice">We use cookies, a long notice about all of them</div>
    <div id="wrap"><article><h1>Title &amp; more</h1><p>First <b>bold</b>
      text&nbsp;with enough characters to be a paragraph.<p>Yes.<ul><li>item one<li>item two</ul><table><tr><td>cell<td>other</table></article>
    <aside>side text that is rather long, but not of the article</aside><form><input><p>Search here</form><div class="comments"><p>a comment by a reader that is long</p></div></div>
    <footer>&copy; someone</footer></body></html>"""
    assert main_text(page).split("\n\n") == ["Title & more", "First bold text with enough characters to be a paragraph.", "Yes.", "item one", "item two", "cell", "other"]


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == main_text("<!-- a -->") == ""
    assert main_text("just text &am &lt;") == "just text &am <"
    assert main_text("<p>a<br>b") == "a b"
    deep = "<div>" * 5000 + "deep text" + "</div>" * 10
    assert main_text(deep) == "deep text"
    assert main_text("</p></div>stray") == "stray"
    assert len(main_text("<article>" + "<p>word word word</p>" * 20000 + "</article>").split("\n\n")) == 20000


def test_query_over_the_table(spark):
    rows = duckdb.sql("SELECT page_id, url, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in op4_html_density(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for page_id, url, page in rows:
        inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [re.sub(r"\s+", " ", library.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n\n".join(x for x in parts if x)
        assert got[page_id] == (url, want, len(want))


def test_frame(spark):
    df = spark.createDataFrame([(1, "<p>a</p>", "x"), (1, "<p>a</p>", "x"), (2, None, "y"), (None, "", None)], "page_id long, html string, TEXT string")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "html", "text"]
    assert sorted((str(r["page_id"]), r["text"]) for r in got.collect()) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "")]
    assert extract_main_text(df.where("false")).count() == 0


def test_titles_and_short_sections_stay():
    part = lambda n, size, c: "".join(f"<p>{(c * 7 + ' ') * (size // 8)}</p>" for _ in range(n))
    sections = f"<section>{part(3, 80, 'a')}</section><section>{part(10, 300, 'b')}</section><ul><li><a href='/x'>a linked story elsewhere</a></ul>"
    links = "<div><a href='/1'>one of the links</a> <a href='/2'>two of the links</a></div>"
    for page in (
        f"<body>{links}<article><h1>A title of thirty characters..</h1>{sections}</article><div>unmarked small print</div>",
        f"<body>{links}<main><header><h1>A title of thirty characters..</h1></header><div>{sections}</div></main>",
        f"<body>{links}<h1>A title of thirty characters..</h1><article>{sections}</article>",
        f"<body>{links}<div><h2>A title of thirty characters..</h2>{sections}</div>",
    ):
        got = main_text(page).split("\n\n")
        assert got[0] == "A title of thirty characters.." and len(got) == 14 and not any("link" in x or "print" in x for x in got)


def test_open_heads_and_layout_classes():
    text = "A paragraph of the article that is long enough to be one. " * 4
    want = text.strip()
    for page in (
        f"<html><head><title>t</title><meta charset=utf-8><body><p>{text}</html>",
        f"<html><head><title>t</title><script>x</script><div><p>{text}</div>",
        f"<html><head><title>t</title>{text}",
        *[f"<body><div class='{c}'><article><p>{text}</article></div></body>" for c in ("content has-sidebar", "no-sidebar", "with-nav", "social-policy", "page-sidebar")],
        f"<body><article><p>{text}</article><div class='main-nav'><a href='/'>Home page</a></div><div class='site-footer'>small</div></body>",
    ):
        assert main_text(page) == want


def test_wrapping_forms_and_names_in_articles():
    text = "A paragraph of the article that is long enough to be one. " * 4
    want = text.strip()
    assert main_text(f"<body><form action='/'><input type=hidden><nav><a href='/'>Home</a></nav><article><p>{text}</article></form>") == want
    assert main_text(f"<body><form id=aspnet><p>{text}</form><div class=ad>buy</div>") == want
    assert main_text(f"<body><article><p>{text}</article><form><p>Name <input></p><p>Mail <input></p></form>") == want
    for own in ("<p class='notice-of-meeting'>The board meets in May.</p>", "<div class='menu-item related-work'>The board meets in May.</div>"):
        assert main_text(f"<body><article><p>{text}</p>{own}</article>") == f"{want}\n\nThe board meets in May."
    math = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='tex'>x=1</annotation></math>"
    assert main_text(f"<body><article><p>{text}Then {math} holds.</article>") == f"{want} Then x=1 holds."
    assert main_text(f"<body><article><p>{text}<map name=m>a<area></map> b</article>") == f"{want} a b"


TEXT = "A paragraph of the article that is long enough to be one. " * 4
WANT = TEXT.strip()
POST = "Some reader wrote this post, which is as long as a paragraph of the article is. " * 4


def test_wrappers_named_like_boilerplate_keep_their_article():
    for wrapped in (
        f"<div class='widget'><article><p>{TEXT}</article></div>",
        f"<section class='social'><main><p>{TEXT}</main></section>",
        f"<div class='nav'><div class='banner'><article><p>{TEXT}</article></div></div>",
        f"<div class='sidebar'><article><p>Short words of a teaser in the sidebar.</article></div><div class='promo'><article><p>{TEXT}</article></div>",
    ):
        assert main_text(f"<body>{wrapped}<div class='widget'>Weather today</div>") == WANT


def test_a_title_in_a_banner_stays_unless_the_article_has_one():
    assert main_text(f"<body><div id='banner'><p>Since 1899</p><h1>Title</h1></div><article><p>{TEXT}</article>") == f"Title\n\n{WANT}"
    assert main_text(f"<body><div id='banner'><h1>Site</h1></div><article><h1>Title</h1><p>{TEXT}</article>") == f"Title\n\n{WANT}"
    assert main_text(f"<body><div id='top'><div><h1>Title</h1></div></div><article><p>{TEXT}</article>") == f"Title\n\n{WANT}"
    assert main_text(f"<body><div id='top'><h1><a href='/'>Site</a></h1></div><article><p>{TEXT}</article>") == WANT


def test_threads_longer_than_the_article_go():
    posts = "".join(f"<p>{POST}</p>" for _ in range(8))
    for name in ("user-comments", "comments", "comment-list", "comments-area", "reader-replies", "disqus"):
        for tag in ("section", "div", "ul"):
            assert main_text(f"<body><article><p>{TEXT}</article><{tag} class='{name}'>{posts}</{tag}>") == WANT
            assert main_text(f"<body><article><p>{TEXT}<{tag} class='{name}'>{posts}</{tag}></article>") == WANT
    each = "".join(f"<div><b>Ann</b> <time>12 May 2020</time><p>{POST}</p></div>" for _ in range(10))
    assert main_text(f"<body><article><p>{TEXT}</article><div>{each}</div>") == WANT
    as_articles = "".join(f"<article class='comment'><p>{POST}</p></article>" for _ in range(3))
    assert main_text(f"<body><article><p>{TEXT}</article>{as_articles}") == WANT


def test_all_articles_of_a_page_stay_but_teasers():
    three = "".join(f"<article><h2>Title {n}</h2><p>{TEXT * n}</article>" for n in (1, 3, 2))
    teasers = "".join(f"<article><h3><a href='/{n}'>Another story {n}</a></h3><p>What it is about.</article>" for n in range(4))
    want = [x for n in (1, 3, 2) for x in (f"Title {n}", (TEXT * n).strip())]
    assert main_text(f"<body>{three}<div>{teasers}</div>").split("\n\n") == want
    assert main_text(f"<body><div><div>{three}</div></div>{teasers}").split("\n\n") == want


def test_phrasing_elements_do_not_cut_blocks():
    for odd in ("<button>x</button>", "<canvas>x</canvas>", "<input>", "<script>x</script>", "<svg><text>x</text></svg>", "<select><option>x</select>", "<object>x</object>", "<audio><source>x</audio>"):
        assert main_text(f"<body><article><p>{TEXT}one {odd} two</p><p>three</p></article>") == f"{WANT} one two\n\nthree"


def test_paragraphs_and_quotations_named_like_comments_stay():
    for own in ("<p class='reply'>The board answered.</p>", "<blockquote class='comment'>The board answered.</blockquote>", "<blockquote class='comment'><p>The board answered.</p></blockquote>"):
        assert main_text(f"<body><article><p>{TEXT}</p>{own}<p>{TEXT}</article>") == f"{WANT}\n\nThe board answered.\n\n{WANT}"


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert op4_html_density(spark, str(tmp_path)).collect() == []
