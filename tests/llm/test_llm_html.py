from gleaner.llm import html_text
from gleaner.llm.html_text import main_text

PROSE = "First, a long paragraph, with commas, and words enough to count as prose. " * 3


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body class='has-sidebar'>{body}</body></html>"


def test_article_without_its_surroundings():
    text = main_text(page(
        "<header><p>Head, er, text, long enough</p></header><nav><ul><li><a href=/a>A</a></ul></nav><div class='ad'>Buy, now, or, never</div>"
        f"<article><h1>Title</h1><p>{PROSE}<p>Second &amp; &eacute;&#33; <b>bold</b><br>line</p><script>var p='</p><p>no';</script>"
        "<aside>side</aside><div id='comments'><p>Nice, post, indeed, I, say</p></div></article><footer>&copy; foot</footer>"
    ))
    assert text == f"Title\n{PROSE.strip()}\nSecond & é! bold line"


def test_scored_container_and_siblings():
    text = main_text(page(
        f"<div id=siteHeader><p>{PROSE}</p></div><div class=wrap><div class=text><p>{PROSE}</p><ul><li>One, item here</li><li>Two</li></ul></div>"
        f"<p>{PROSE}</p><div class=links><p><a href=1>{PROSE}</a></p></div></div><div class=cookie-notice><p>{PROSE}</p></div><form><p>{PROSE}</p></form>"
    ))
    assert text == f"{PROSE.strip()}\nOne, item here\nTwo\n{PROSE.strip()}"


def test_broken_markup():
    assert main_text("plain & simple") == "plain & simple"
    assert main_text("<p>a<p>b<br>c<div>d") == "a\nb c\nd"
    assert main_text("<p>ok <a hr") == "ok" and main_text("<!-- open") == "" and main_text("x</div></p>y") == "xy"
    assert main_text("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"
    assert main_text("<div>" * 50000 + "deep") == "deep"
    assert main_text("a < b and c > d") == "a < b and c > d"
    assert main_text("<p>x &nbsp;&#x20;\n\t y &bogus; &amp</p>") == "x y &bogus; &"


def test_long_page_is_whole():
    body = "".join(f"<p>Paragraph {i}, of many, in a long page.</p>" for i in range(20000))
    assert main_text(page(f"<article>{body}</article>")).count("\n") == 19999


def test_pages(spark):
    rows = [(1, "u", None, "old"), (2, None, "", "old"), (3, "u", page(f"<article><p>{PROSE}</p></article>"), "old"), (3, "u", page(f"<article><p>{PROSE}</p></article>"), "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(html_text.extract(pages).select("page_id", "text").collect())
    assert [r.text for r in found] == ["", "", PROSE.strip(), PROSE.strip()]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_a_name_does_not_empty_a_wrapper():
    want = PROSE.strip()
    for wrapper in ("div class='content-sidebar-wrap'", "div class='page-sidebar-right'", "div id='main-header-layout'", "form action='/'"):
        end = "</" + wrapper.split()[0] + ">"
        side = f"<div class=sidebar><p>Side, bar</p></div><div id=comments><article><p>{PROSE * 3}</p></article></div>"
        assert main_text(page(f"<{wrapper}><main><p>{PROSE}</p></main>{side}{end}")) == want, wrapper
        assert main_text(page(f"<{wrapper}><article><p>{PROSE}</p></article><div class=sidebar><p>Side, bar</p></div>{end}")) == want, wrapper
        assert main_text(page(f"<{wrapper}><div><p>{PROSE}</p><p>{PROSE}</p></div><div class=sidebar><p>Side, bar</p></div>{end}")) == f"{want}\n{want}", wrapper


def test_named_parts_beside_the_main_part_stay_out():
    assert main_text(page(f"<article><p>{PROSE}</p></article><div id=comments><article><p>Nice, post</p></article></div>")) == PROSE.strip()
    assert main_text(page(f"<div><p>{PROSE}</p></div><div class=cookie-consent><p>{PROSE * 9}</p></div>")) == PROSE.strip()
    assert main_text("<div class=sidebar>" * 20000 + "deep") == ""


def test_short_sections_and_texts_beside_the_longest_one_stay():
    section = lambda n: f"<section>{f'<p>{PROSE}</p>' * n}</section>"
    want = PROSE.strip()
    text = main_text(page(
        f"<div class=menu><a href=1>Menu</a></div><div id=c>{section(20)}<div>{section(3)}</div>bare <b>words</b> <a href=2>link</a> here"
        f"<dl><dt>Term</dt><dd>Meaning</dd></dl><div><a href=3>{PROSE}</a></div><section><p>Short end.</p></section></div><div><p>{PROSE}</p></div>"
    ))
    assert text == "\n".join([want] * 23 + ["bare words link here", "Term", "Meaning", "Short end.", want])


def test_lists_of_sources_in_the_article_stay():
    sources = "<h2>Sources</h2><ul><li><a href=1>First source</a></li><li><a href=2>Second source</a></li></ul>"
    for tag in ("article", "main"):
        assert main_text(page(f"<{tag}><p>{PROSE}</p>{sources}</{tag}>")) == f"{PROSE.strip()}\nSources\nFirst source\nSecond source"


def test_best_container_inside_an_inline_element():
    assert main_text(page(f"<div><a href=1>{PROSE}</a> x <span><p>{PROSE}</p></span></div><div><p>End.</p></div>")).endswith(f"{PROSE.strip()}\nEnd.")


def test_tokens_that_only_hold_a_name_stay():
    kept = (
        "<section id='related-work'><p>Work, done, before.</p></section>", "<p class='ad-hoc'>Ad hoc, it is.</p>", "<div class='share-price'>Price, 12</div>",
        "<div class='section-header'><h2>Part, two</h2></div>", "<p class=\"menu-planning\">Plans, of meals</p>", "<div id=article-header>Over, all</div>",
        "<p class='socialism navigator'>Words, words</p>", "<div class='notice-board'>Board, of it</div>", "<div class='comment-on-law'>On, law</div>",
    )
    for part in kept:
        text = main_text(page(f"<article><p>{PROSE}</p>{part}</article>"))
        assert text == PROSE.strip() + "\n" + main_text(part), part
    dropped = (
        "siteHeader", "page-footer", "comment-list", "comments-area", "left-sidebar", "ad", "ad-slot-3", "banner_ad", "cookie-notice", "main-menu", "nav",
        "share-buttons", "newsletter-form", "related-posts", "x sidebar y", "AdUnit",
    )
    for name in dropped:
        assert main_text(page(f"<article><p>{PROSE}</p><div class='{name}'>Out, of it</div></article>")) == PROSE.strip(), name


def test_attributes_as_written():
    assert main_text("<p data-x=it's>Hello</p><p>don't</p>") == "Hello\ndon't"
    assert main_text("<p title=\"abc>Hello</p><p>World</p>") == "Hello\nWorld"
    assert main_text("<p title='a > b' class=x\"y>Hello</p>") == "Hello"
    assert main_text("<p title = \"a'b\" checked = >Hello <a href=http://x/>link</a> end</p>") == "Hello link end"
    assert main_text("<p =a \"q\" 'r' / x>Hello</p>") == "Hello" and main_text("<p hidden>No</p><p>Yes</p>") == "Yes"
    assert main_text("<p a='" + "x" * 200_000) == "" and main_text("<p" + " a=\"" * 50_000 + ">Hi") is not None


def test_all_articles_of_a_main_part_and_inline_parts():
    two = f"<article><h2>One</h2><p>{PROSE}</p></article><article><h2>Two</h2><p>{PROSE * 4}</p></article>"
    want = f"One\n{PROSE.strip()}\nTwo\n{(PROSE * 4).strip()}"
    assert main_text(page(f"<main>{two}</main>")) == want and main_text(page(f"<div>{two}</div><footer>f</footer>")) == want
    assert main_text(page(f"<main><h1>All</h1>{two}</main>")) == "All\n" + want
    assert main_text(page("<p>Press <button>Save</button> now, please, and wait</p>")) == "Press now, please, and wait"


#: Pages without an article, marked by hand: the markup and the blocks of its main text.
MARKED = [
    (f"<div id=nav><a href=1>Home</a></div><div id=content><h1>Name</h1><p>{PROSE}</p><p>Short.</p></div><div id=footer>Foot, er</div>", ["Name", PROSE.strip(), "Short."]),
    (f"<table><tr><td class=sidebar><a href=1>A</a></td><td><p>{PROSE}</p><blockquote>Quote, of it</blockquote></td></tr></table>", [PROSE.strip(), "Quote, of it"]),
    (f"<div class=post><p>{PROSE}</p><pre>code  here</pre><ol><li>First, step</li><li>Second</li></ol></div><div class=comments><p>Nice, one</p></div>",
     [PROSE.strip(), "code here", "First, step", "Second"]),
    (f"<section><h2>A</h2><p>{PROSE}</p></section><section><h2>B</h2><p>{PROSE}</p></section><div class=ads><p>Buy, it, now</p></div>", ["A", PROSE.strip(), "B", PROSE.strip()]),
    (f"<div><div><p>{PROSE}</p></div><figure><figcaption>A, picture</figcaption></figure></div><form><p>Your, name</p></form>", [PROSE.strip(), "A, picture"]),
    ("<p>Only one, short, paragraph here.</p>", ["Only one, short, paragraph here."]),
    ("<ul><li>a</li><li>b</li></ul>", ["a", "b"]),
    (f"<div class=layout-with-sidebar><p>{PROSE}</p></div><div class=pagination><a href=2>2</a></div>", [PROSE.strip()]),
]


def test_pages_marked_by_hand():
    for body, want in MARKED:
        assert main_text(page(body)).split("\n") == want, body
