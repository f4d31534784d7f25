from html import escape

from hypothesis import given, settings
from hypothesis import strategies as st

from costlens.llm import html_text
from costlens.llm.html_text import render


def test_blocks_and_inline():
    assert render("a  b<b> c</b>d<br>e<p>one<p>two<div>x<div>y</div>z</div>w") == "a b cd\ne\n\none\n\ntwo\n\nx\ny\nz\nw"
    assert render("<h1>T</h1>text<hr>more") == "T\n\ntext\n\nmore"
    assert render("<pre>\n a\n  b\n</pre><textarea> k  l</textarea>") == " a\n  b\n\n k  l"
    assert render(None) == render("") == render("<p></p>") == ""
    assert render("x &amp; &lt;y&gt; &copy;&nbsp;z") == "x & <y> © z"


def test_lists():
    page = "<ul><li>a<li>b<ol start=9><li>c<li value=20>d<li>e</ol><li><p>f</p>g</ul>"
    assert render(page) == "- a\n- b\n\n  9. c\n  20. d\n  21. e\n- f\n\n  g"
    assert render("<dl><dt>T<dd>D1<dd>D2</dl>") == "T\n  D1\n  D2"


def test_tables():
    page = """<table><caption>C</caption><thead><tr><th>Name<th>N<tbody>
      <tr><td>apple<td>1<tr><td colspan=2>a span that is wide<td>end
      <tr><td rowspan=2>tall<td>2<tr><td>3<td>日本<tr><td>x<br>y<td>4</table>after"""
    assert render(page) == (
        "C\nName   N\napple  1\na span that is wide  end\ntall   2\n       3             日本\nx      4\ny\n\nafter"
    )
    assert render("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>") == "in  ner  out"


def test_visibility():
    page = """<head><title>t</title><style>.h{display:none} #i{visibility:hidden} b.x{display:none}</style></head>
      <body><script>if (a<b) "</p>"</script><!-- c --><p hidden>no<p class="h z">no<p id=i>no<span style="visibility: visible">yes</span>
      <p style="color:red; display : none">no</p><b class=x>no</b><b>bold</b><template>no</template><dialog>no</dialog>
      <details><summary>sum</summary>no</details><details open><summary>s</summary>yes</details><input type=hidden value=no>"""
    text = render(page)
    assert "no" not in text.split() and text.split() == ["yes", "bold", "sum", "s", "yes"]


def test_broken_markup():
    assert render("<p>a</b></p></div>b<br/>c</p>d") == "a\n\nb\nc\n\nd"
    assert render("a <b>b") == "a b"
    assert render('x<a href="1>2">y</a>') == "xy"
    assert render("1 < 2 > 0 <3") == "1 < 2 > 0 <3"
    assert render("a<!-- open") == "a"
    assert render("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert render("<ul><li>" * 500 + "deep").endswith("deep")
    assert len(render("<td>" * 2000 + "x")) > 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    "<p> </p> <table> </table> <tr> <td> <td> <th> </tr> <ul> <ol> <li> </ul> a b & &amp; <b> </b> <!-- --> <pre> "
    "</pre> <select> <option> <br> < > \" ' <a href=\"x <style> </style> <div hidden> </div> <dl> <dt> <dd> \x00 \n".split(" ")
), max_size=40))
def test_never_fails(parts):
    render("".join(parts))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=33, max_codepoint=0x2FF, exclude_characters="\x7f\x85\xa0\xad"), min_size=1), min_size=1, max_size=8))
def test_all_visible_words_come_out_in_order(words):
    page = "<p>" + "</p> <p>".join(escape(w) for w in words) + "</p>"
    assert render(page).split() == " ".join(words).split()


def test_query(spark):
    rows = [(1, "u", "<p>a<p>b"), (1, "u", "<p>a<p>b"), (2, None, None), (None, "v", "plain"), (3, "w", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = sorted((str(r.page_id), r.text, r.n_chars, r.n_lines) for r in html_text.extract(df).collect())
    assert out == [("1", "a\n\nb", 4, 3), ("1", "a\n\nb", 4, 3), ("2", "", 0, 0), ("3", "", 0, 0), ("None", "plain", 5, 1)]
    assert html_text.extract(df.filter("false")).count() == 0


def test_whole_pages_table(spark):
    from costlens.llm.queries import op3_html_text

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = op3_html_text(spark, sf).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.text == render(pages[r.page_id]) and "track(0)" not in r.text and "<p" not in r.text


def test_styles_that_do_not_hold_on_a_screen():
    for style in (
        "<style>@media print{.x{display:none}}</style>",
        "<style>@media (max-width:600px){.x{display:none}} @media not all{.x{display:none}}</style>",
        "<style>@media screen and (width <= 40em), print and (color){p{color:red}.x{visibility:hidden}}</style>",
        "<style media=print>.x{display:none}</style>",
        "<noscript><style>.x{display:none}</style></noscript>",
        "<style>@font-face{src:url('a}b')} @keyframes k{from{display:none}} @page{.x{display:none}}</style>",
    ):
        assert render(f"{style}<p class=x>seen</p>") == "seen", style
    for style in (
        "<style>@media screen{.x{display:none}}</style>",
        "<style>@media only screen and (min-width:600px){@supports (display:grid){.x{display:none}}}</style>",
        "<style media='all'><!-- .x{display:none} --></style>",
        "<style>@import 'a.css'; .x{color:red;display:none</style>",
        "<style>@media not print{.x{display:none}}</style>",
    ):
        assert render(f"{style}<p class=x>hidden</p>") == "", style


def test_the_last_declaration_decides():
    def seen(css, attributes):
        return bool(render(f"<style>{css}</style><p {attributes}>text</p>"))

    assert seen(".x{display:none} .x{display:block}", "class=x")
    assert not seen(".x{display:block} .x{display:none}", "class=x")
    assert seen(".x{display:none}", "class=x style='display:block'")
    assert not seen(".x{display:none!important}", "class=x style='display:block'")
    assert not seen("#i{display:none} .x{display:block} p{display:block}", "class=x id=i")
    assert seen(".x{visibility:hidden} .x{visibility:visible}", "class=x")
    assert not seen("p{visibility:visible}", "style='visibility:visible;visibility:hidden'")
    assert not seen("", "hidden") and seen("", "hidden style='display:block'")
    assert not seen("", "style='display:block;display:none'")


def test_formulas_drawings_maps_and_inputs():
    assert render("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds") == "if x=2 holds"
    drawing = "<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><path d='m'/><g><text>Sales <tspan>2024</tspan></text></g></svg>"
    assert render(f"a{drawing}b<svg/>c") == "a Sales 2024 bc"
    assert render("<map name=m><p>in the map<area></map>") == "in the map"
    kinds = "text tel number date time week month datetime-local email url search submit other".split()
    shown = "".join(f"<input type={k} value={k}>" for k in kinds)
    unseen = "".join(f"<input type={k} value=no>" for k in "hidden password checkbox radio file image color range".split())
    assert render(shown + unseen).split() == kinds
