import random
import time

from murmura.llm import html
from murmura.llm.html import tree, visible_text


def test_layout():
    text = visible_text(
        """<html><head><title>t</title><style>p{}</style><body><h1>Head  line</h1><p>One <b>bold</b>
 word<p>Two<br>lines<ul><li>a<li>b<ol start=3><li>n1<li>n2</ol></ul>
<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>fig<td>12</table><pre>  keep
   this</pre>&amp; more<script>var t="</p>";</script>"""
    )
    assert text == (
        "Head line\n\nOne bold word\n\nTwo\nlines\n\n- a\n- b\n  3. n1\n  4. n2\n\n"
        "Name   Qty\napple  3\nfig    12\n\n  keep\n   this\n\n& more"
    )


def test_columns_that_span_and_nested_tables():
    assert visible_text("<table><tr><td>a<td>b<tr><td colspan=2>wide cell<td>c</table>") == "a  b\nwide cell  c"
    assert visible_text("<table><tr><td>x<table><tr><td>in<td>ner</table><td>y</table>") == "x in  ner  y"
    assert visible_text("<table>loose<tr><td>1</table>after") == "loose\n\n1\n\nafter"


def test_visibility():
    hidden = [
        "<p hidden>x</p>", "<div style='Display : none'>x</div>", "<i style=visibility:hidden>x</i>", "<!-- x -->", "<noscript>x</noscript>",
        "<template><p>x</template>", "<input type=hidden value=x>", "<div hidden><p>x<table><tr><td>x</table></div>",
    ]
    for h in hidden:
        assert visible_text(f"a {h} b").split() == ["a", "b"]


def test_odd_inputs():
    assert visible_text(None) is None
    assert [visible_text(h) for h in ("", " ", "<", "<p", "</p>", "a</b></table></td>c", "<td>x</td>y")] == ["", "", "<", "<p", "", "ac", "x\ny"]
    assert visible_text("<div>" * 20_000 + "x") == "x"
    assert visible_text("<li>a<li>b") == "- a\n- b"


def test_all_visible_text_comes_out_in_order_of_the_tree():
    def visible(node, out):
        for child in node.children:
            if isinstance(child, str):
                out.append(child)
            elif not child.hidden():
                visible(child, out)
        return out

    rnd = random.Random(1)
    tags = "p li ul table tr td th ol pre dd dl dt blockquote div span b h2 option select".split()
    parts = [f"<{t}>" for t in tags] + [f"</{t}>" for t in tags] + ["<br>", "<div hidden>", "<th colspan=3>", "<td colspan=x>", "\n", " "]
    for _ in range(3000):
        words = iter(f"w{i} " for i in range(100))
        markup = "".join(rnd.choice(parts) if rnd.random() < 0.7 else next(words) for _ in range(rnd.randint(0, 40)))
        want = "".join(visible(tree(markup), [])).split()
        got = [w for w in visible_text(markup).split() if w.startswith("w")]
        # A table inside a paragraph's line may be moved after it; nothing is lost or doubled.
        assert sorted("".join(got)) == sorted("".join(want)), markup


def test_drawings_and_formulas():
    assert visible_text("a<svg><title>t</title><desc>d</desc><defs><path/></defs><text>one</text><text>two</text></svg>b") == "a\none\ntwo\nb"
    assert visible_text("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>x=1/2</annotation></math> holds") == "so x=1 2 holds"
    assert visible_text("<div>a <svg/> b <math/> c <svg><path d=x /><g/></svg> d</div>") == "a b c d"
    assert visible_text("<svg><desc>d<p>x</p></desc></svg><svg><defs><p>out") == "out"


def test_head_ends_at_what_is_not_its_own():
    for markup in ("<b>bold</b> text", "bold text", "<a href=x>bold</a> text", "<img src=x>bold text"):
        assert visible_text(f"<html><head><meta charset=x><title>t</title>\n{markup}") == "bold text"
    assert visible_text("<head><title>t</title><style>s</style><script>x</script></head><body>y") == "y"


def test_cells_keep_their_lines_and_rows_span():
    assert visible_text("<table><tr><td><p>a1<p>a2<td>b<tr><td>c<td><ul><li>d<li>e</ul></table>") == "a1  b\n\na2\nc   - d\n    - e"
    assert visible_text("<table><tr><td>k<td><pre>x\n  y</pre></table>") == "k  x\n     y"
    assert visible_text("<table><tr><td><table><tr><td>in<td>1<tr><td>ner<td>2</table><td>y</table>") == "in   1  y\nner  2"
    assert visible_text("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a  b\n   c\nd  e"
    assert visible_text("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>") == "a  b\n   c\nd  e"


def test_table_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a", 5), (1, "u", "<p>a", 5), (None, None, None, 6)], "page_id long, url string, html string, text int")
    rows = sorted(((r.page_id, r.text) for r in html.extract(pages).collect()), key=str)
    assert rows == [(1, "a"), (1, "a"), (None, None)]
    assert html.extract(pages.limit(0)).collect() == []


def test_styles_are_read_by_declaration():
    seen = ["background:url(/display:none.png)", "--display:none", "content:'; display:none'", "/* display:none */", "display:none;display:block", "display:block!important;display:none"]
    assert all(visible_text(f'<p style="{s}">x') == "x" for s in seen)
    gone = ["display:none", "color:red; DISPLAY : None", "display:none!important;display:block", "background:url(a;b);display:none"]
    assert all(visible_text(f'<p style="{s}">x') == "" for s in gone)


def test_visible_inside_invisible():
    assert visible_text('<div style="visibility:hidden">a<p style="visibility:visible">b<i style="visibility:collapse">c</i></div>d') == "b\n\nd"
    assert visible_text('<div style="display:none">a<p style="visibility:visible;display:block">b</div>d') == "d"
    assert visible_text('<ul style="visibility:hidden"><li>a<li><b style="visibility:visible">b</b></ul>') == "  b"


def test_broken_markup():
    assert visible_text('<a title="x>y</a> z') == "y z"
    assert visible_text("a <!-- b <p>c") == "a" and visible_text("a <!--> b <!--- x --!> c") == "a b c"
    assert visible_text("<textarea><b>x</b></textarea><title>t</b></title>") == "<b>x</b>"
    assert visible_text("<textarea>x <b>y") == "x y" and visible_text("a<script>x</scripts><p>y") == "a"
    assert visible_text("<i a=1 b='2' / c/>x &lt; 1 < 2 &amp;<br/>y<z") == "x < 1 < 2 &\ny<z"
    assert visible_text("<p hidden=1 hidden>x</p><svg><text><![CDATA[a<b]]></text></svg>") == "a<b"


def test_hostile_pages_take_time_by_their_length():
    size = 200_000
    cells = "<tr><td colspan=1000 rowspan=65534>" * (size // 35)
    pages = [
        f"<table>{cells}", "<p>" + "<span>" * (size // 12) + "<li>" * (size // 8), "<table><td>" + "<b>" * 9 + "</b>" * (size // 4),
        *((part * size)[:size] for part in ("<a ", "<b a=", '<a href="', "<!--", "<br>", "<blockquote>x", "<ul><li>x", "<table><tr><td>x<br>", "<dl><dd>x")),
        "<table><tr><td>" + "w" * (size // 2) + "<td>b" + "<tr><td>a<td>b" * (size // 28), "<p style='" + "(" * size + ";display:none'>x",
    ]
    for page in pages:
        start = time.process_time()
        text = visible_text(page)
        assert time.process_time() - start < 10, page[:40]
        assert len(text) <= len(page) + (text.count("\n") + 1) * html.WIDEST
    deep = "".join(f"<table><tr><td>x{i}<br>" for i in range(500))
    assert visible_text(deep).split() == [f"x{i}" for i in range(500)]
