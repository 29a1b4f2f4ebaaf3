from hypothesis import given, settings
from hypothesis import strategies as st

from cairnflow.llm.html_text import extract_pages, main_text

A = "This is the first real paragraph of the article, which has a good number of words in it, and it goes on."
B = "A second paragraph follows with <b>bold</b>x words and a <a href='/x'>link</a> inside of the running text."
PLAIN_B = "A second paragraph follows with boldx words and a link inside of the running text."


def test_layout_by_classes():
    page = f"""<html><head><title>T</title></head><body><div id=header><h2>Site</h2><ul><li><a href=/>Home</a><li><a href=/a>About</a></ul></div>
    <div class='content-with-sidebar'><div class=post><h1>Title here</h1><p>{A}<p>{B}</div><div class=sidebar><p>Some sidebar text that is rather
    long but not the article.</p></div></div><div class=cookie-notice>We use cookies to improve your experience on this site, please accept.</div>
    <div id=comments><div class=comment><p>Great post! I have really enjoyed reading it, thank you so very much.</p></div></div>
    <form><input><label>Your name</label></form><footer>Copyright</footer></body></html>"""
    assert main_text(page) == f"Title here {A} {PLAIN_B}"


def test_layout_by_elements():
    page = f"""<body><header><a href=/>Logo</a><nav><a>a</a></nav></header><main><article><header><h1>Head</h1></header><section><h2>One</h2><p>{A}</p></section>
    <section><h2>Two</h2><p>{B}</p><div class='ad'>Buy now this great product for just a little money today</div></section><ul><li>x1<li>x2</ul></article>
    <section id='comments'><article class=comment><p>{A}</p></article></section></main><aside>related things</aside></body>"""
    assert main_text(page) == f"Head One {A} Two {PLAIN_B} x1 x2"


def test_layout_words_do_not_cost_the_article():
    assert main_text(f"<main><article class='post has-sidebar share'><p>{A}</p></article><article class='comment'><p>{A} {A}</p></article></main>") == A
    assert main_text(f"<body class=nav-open><div class='content no-sidebar'><p>{A}</p><p>{B}</p></div><div class=sidebar>Short text here.</div></body>") == f"{A} {PLAIN_B}"
    assert main_text(f"<form id=aspnet><div class=menu><a href=/>x</a></div><h1>Title</h1><p>{A}</p></form>") == f"Title {A}"


def test_small_and_broken_pages():
    assert main_text(None) == main_text("") == main_text("<script>x</script>") == ""
    assert main_text("just text &lt;no&gt; markup &eacute;&#233;&nbsp;x &am") == "just text <no> markup éé x &am"
    assert main_text(f"<body><article><p>{A}<p>tail <b") == f"{A} tail"
    assert main_text('<script>var x="<p>hi</p>"</script><p>ok</p>') == "ok"
    assert main_text(f"<table><tr><td class=menu><a href=1>m1</a><br><a href=2>m2</a></td><td><p>{A}</p></td></tr></table>") == A
    assert main_text("<div>" * 3000 + A) == A


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div class=ad>", "</div>", "text ", "<a href='", "\">", "<!--", "-->", "<br/>", "&amp;", "<li>", "</ul>", "<article>", "<script>", "</script>"]), max_size=25))
def test_never_fails(parts):
    out = main_text("".join(parts))
    assert out == " ".join(out.split())


def test_all_rows_return(spark):
    rows = [(1, "u", f"<p>{A}", 1), (1, "u", f"<p>{A}", 1), (2, None, None, 1), (None, "v", "", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract_pages(df).collect())
    assert got == [(0, "v", "", 0), (1, "u", A, len(A)), (1, "u", A, len(A)), (2, "", "", 0)]
    assert extract_pages(df.limit(0)).count() == 0


def test_generated_pages_give_their_article(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    for r in pages.collect():
        want = html.unescape(re.sub(r"<[^>]*>", " ", re.search("<article>(.*?)</article>", r.html, re.S)[1]))
        assert got[r.page_id] == " ".join(want.split())


def test_attribute_values_and_compound_names_do_not_cost_text():
    assert main_text(f'<div data-v1="is hidden here"><p>{A}</p><p>{B}</p></div>') == f"{A} {PLAIN_B}"
    assert main_text(f"<div hidden><p>no</p></div><div><p>{A}</p><p hidden=''>no</p></div>") == A
    assert main_text(f"<article><section class='related-story-body'><p>{A}</p></section><section id='comment-on-policy'><p>{B}</p></section></article>") == f"{A} {PLAIN_B}"
    assert main_text(f"<article><h1>T</h1><p>{A}</p><section id='discussion'><h2>Discussion</h2><p>{A}</p><p>{B}</p></section></article>") == f"T {A} Discussion {A} {PLAIN_B}"
    assert main_text(f"<article><h1>T</h1><p>{A}</p><section id='discussion'><div class=comment><p>{A}</p></div></section></article>") == f"T {A}"


def test_short_paragraphs_beside_the_core_stay():
    assert main_text(f"<body><div><div><p>{A}</p><p>{B}</p><p>{A}</p></div><p>Yes.</p><p>He left it.</p></div></body>") == f"{A} {PLAIN_B} {A} Yes. He left it."
    assert main_text(f"<body><div>Own words first.<div><p>{A}</p><p>{B}</p><p>{A}</p></div></div><div>Buy it now!</div></body>") == f"Own words first. {A} {PLAIN_B} {A}"
    sections = "".join(f"<div><h2>Part {i}</h2>{'<p>' + A + '</p>' * 1}{'<p>' + B + '</p>' if i else ''}</div>" for i in range(3))
    assert main_text(f"<body><div class=x1><a href=/>Home</a></div><div class=x2>{sections}</div></body>").startswith("Part 0 ")


def plain_pages(spark):
    """Pages without article tags and with names that no list knows, and their articles."""
    import html
    import re

    out = []
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.search("<article>(.*?)</article>", r.html, re.S)[1])).split())
        page = r.html.replace('class="ad"', 'class="xq7"')
        for tag in ("article", "footer", "nav"):
            page = page.replace(f"<{tag}>", f"<div id={tag[::-1]}>").replace(f"</{tag}>", "</div>")
        out.append((page, want))
    return out


def test_densities_decide_without_names_and_article_tags(spark, monkeypatch):
    from cairnflow.llm import html_text

    pages = plain_pages(spark)
    right = sum(main_text(page) == want for page, want in pages)
    assert right >= 0.95 * len(pages)  # the others have articles hardly longer than their advert
    real = html_text.densities

    def zero(tree, chars):
        real(tree, chars)
        return [0.0] * len(tree.tag)

    monkeypatch.setattr(html_text, "densities", zero)
    assert not any(main_text(page) == want for page, want in pages)


def test_densities_against_a_plain_computation():
    """Densities and the core, recomputed from nested lists."""
    import math

    from cairnflow.llm.html_text import Tree, core_of, densities

    page = f"<body><div><a href=1>one link</a><a href=2>two</a></div><div><p>{A}</p><p>{B}</p><p>{A}</p></div></body>"
    tree = Tree(page)
    chars = [0] * len(tree.tag)
    for node, raw in tree.pieces:
        chars[node] += len("".join(raw.split()))
    got = densities(tree, chars)

    def under(k):
        return [k] + [x for j in range(k + 1, len(tree.tag)) if tree.parent[j] == k for x in under(j)]

    link = ("a", "button", "select")
    everything = under(0)
    page_chars, page_links = sum(chars), sum(chars[k] for k in everything if tree.tag[k] in link)
    inline = ("b",)
    for k in range(1, len(tree.tag)):
        below = under(k)
        c, lc = sum(chars[j] for j in below), sum(chars[j] for j in below if tree.tag[j] in link)
        if not c:
            continue
        t = max(1, sum(tree.tag[j] not in inline for j in below[1:]))
        own = tree.tag[k] in link
        lt = max(1, sum(tree.tag[j] in link or own for j in below[1:]))
        base = math.log(c / max(c - lc, 1) * lc + page_links / page_chars * c + math.e)
        ratio = c / (lc or 1) * t / lt
        assert abs(got[k] - max(0.0, c / t * math.log(ratio) / math.log(base))) < 1e-6 * max(1.0, got[k])
    core, total = core_of(tree, got)
    assert tree.tag[core] == "div" and total[core] == sum(got[k] for k in range(len(got)) if tree.parent[k] == core)


def test_very_long_page():
    page = "<div class=menu><a href=/>x</a></div><div>" + f"<p>{A}</p>" * 20_000 + "</div>"
    assert main_text(page) == " ".join([A] * 20_000)


def test_labels_and_formulas_of_an_article_stay():
    page = f"<html><body><nav><label>Menu</label></nav><article><p>He said <label>word</label> there, and <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p><p>{'More text of the article here. ' * 20}</p><form><label>Your name</label><input></form></article></body></html>"
    got = main_text(page)
    assert got.startswith("He said word there, and x=1 holds. More text") and "Menu" not in got and "Your name" not in got
