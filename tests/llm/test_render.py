import pytest
from pyspark.sql import functions as F

from tierload.llm import render as R

CASES = {
    "<p>one<p>two  \n three</p>four": "one\n\ntwo three\n\nfour",
    "<head><title>t</title></head><body>a<br>b<div>c</div>d": "a\nb\nc\nd",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>x<li>y</ol>": "9. x\n10. y",
    "<table><tr><th>name<th align=right>n<tr><td>bread<td align=right>5<tr><td>é<td align=right>120</table>": "name     n\nbread    5\né      120",
    "<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>": "wide cell  z\na  b       c",
    "<table><tr><td rowspan=2>r<td>1<tr><td>2</table>": "r  1\n   2",
    "<table><td>only<tr><td>column</table>": "only\ncolumn",
    "<p hidden>x</p><p style='display: none'>y</p><div style='visibility:hidden'>z<b style='visibility:visible'>w</b></div>v": "w\nv",
    "<style>.ad, #k{display:none} p{margin:0}</style><div class='x ad'>no</div><i id=k>no</i>yes": "yes",
    "<script>var t='</p>';</script>a<!-- <p>b -->c<noscript>d</noscript>": "acd",
    "<pre>\n a\n   b\n</pre>": " a\n   b",
    "<details><summary>s</summary>body</details><details open><summary>s</summary>body</details>": "s\ns\nbody",
    "<blockquote>q</blockquote>x &amp; &lt;y&gt; &nbsp;z": "  q\n\nx & <y> \xa0z",
    "<select><option>a<option selected>b</select><input type=hidden value=h><input value=v>": "b v",
    "a < b <c": "a < b <c",
    "</div></p>text</b>": "text",
    "<h2>T</h3>x": "T\n\nx",
    "": "", "   ": "",
}
KEPT = {
    "<table><tr><form><td>x</td></form></tr></table>": "x",
    "<table><form><tr><td>x<td>y</tr>w</form></table>": "w\n\nx  y",
    "<table>in table<tr>in row<td>x</td></tr><tbody>in body<tr><td>y</table>z": "in tablein rowin body\n\nx\ny\n\nz",
    "a<table><tr><td>x</td><b>c</b> <i>d</i></tr><div>e</div></table>": "ac d\ne\n\nx",
    "<table><tr><td>x<table><tr>s<td>y</table></table>": "xs\n\ny",
    "<table><tr><table><tr><td>y</table>z": "y\n\nz",
    "<table hidden>shown<tr><td>x</table>": "shown",
    "<svg><title>t</title><defs/><g><text x=1>one</text><text>two</text></g></svg>three": "one two three",
    "<svg><title/><desc>d</desc></svg>x <math><mi>y</mi><mo>=</mo><mn>1</mn></math>": "x y=1",
    "<p title=it's>Hello it's me</p>": "Hello it's me",
    '<a href="x"">one</a> two <a href="y"">three</a>': "one two three",
    "<a 'b>one</a> it's": "one it's",
    "<a href = 'x>y' title=a=\"b>one</a> \"two": 'one "two',
    '<p title="x>one': "one",
}


@pytest.mark.parametrize("page", KEPT)
def test_no_visible_text_is_dropped(page):
    assert R.render_page(page) == KEPT[page]


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert R.render_page(page) == CASES[page]


def test_deep_nesting_and_long_pages_keep_their_text():
    assert R.render_page("<div>" * 5000 + "x" + "</div>" * 5000 + "y").replace("\n", "") == "xy"
    assert R.render_page("<b>" * 3000 + "x") == "x"
    assert len(R.render_page("<p>word " * 50_000).split()) == 50_000
    assert R.render_page("<table><tr><td colspan=999999999>a<td>b</table>").split() == ["a", "b"]


@pytest.mark.parametrize("depth", [5, 118, 119, 120, 121, 600, 20_000])
def test_hidden_text_stays_hidden_at_any_depth(depth):
    inside = ("<div style='display:none'>secret<p>s</div>a<div hidden>no</div><script>var x</script>"
              "<span style='visibility:hidden'>v<b style='visibility:visible'>w</b>u</span><ul><li>c</ul>d")
    for sheet, more in (("", ""), ("<style>.off{display:none} i{visibility:hidden}</style>", "<q class=off>no</q><i>no</i>")):
        page = sheet + "<div>" * depth + inside + more + "</div>" * depth + "z"
        assert [x for x in R.render_page(page).split() if x != "-"] == ["aw", "c", "d", "z"]


def test_end_tags_match_at_any_depth():
    for depth in (3, 119, 500):
        deep = R.render_page("<b>" * depth + "<div>x</div>y<p>z</p>" + "</b>" * depth + "<div>e</div>").split("\n")
        assert deep == ["x", "y", "", "z", "", "e"]


def test_spans_up_to_a_thousand_columns():
    row = "<tr>" + "".join(f"<td>{i % 10}" for i in range(300))
    got = R.render_page(f"<table>{row}<tr><td colspan=299>a<td>b</table>").split("\n")
    assert got[0].rindex("9") == got[1].index("b")


def test_hostile_pages_end_soon():
    import time
    pages = {"row spans": "<table>" + "<tr><td rowspan=3000 colspan=1000>a<td>b" * 3000 + "</table>",
             "unclosed tags": "<a " * 350_000, "deep": "<div>" * 100_000 + "x",
             "scope far up": "<p><button>" + "<span>" * 50_000 + "<div>" * 50_000 + "x",
             "stray ends": "<span>" * 50_000 + "</b>" * 100_000, "comments": "<!-- " * 200_000}
    for name, page in pages.items():
        start = time.monotonic()
        text = R.render_page(page)
        assert time.monotonic() - start < 20, name
        assert {"row spans": text.count("a") == text.count("b") == 3000, "deep": text == "x", "scope far up": text == "x",
                "unclosed tags": text.count("<a") == 350_000}.get(name, text == ""), name


def test_pages_table_keeps_all_visible_words(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in R.render_pages(pages).collect():
        body = re.sub(r"<head>.*?</head>|<!--.*?-->", "", raw[r.page_id], flags=re.S)
        want = html.unescape(re.sub(r"</?(?:b|a)\b[^>]*>", "", body))
        want = re.sub(r"<[A-Za-z/!][^>]*>", " ", want).split()
        assert [w for w in r.text.replace("\n", " ").split() if w != "-"] == want


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "<p>x"), (2, "")], "page_id long, html string").withColumn("text", F.lit("clash"))
    got = sorted(map(tuple, R.render_pages(df).collect()), key=repr)
    assert got == sorted([(1, ""), (1, ""), (None, "x"), (2, "")], key=repr)
    assert R.render_pages(df.limit(0)).count() == 0
