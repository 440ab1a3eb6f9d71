import time

import pytest

from eventstar.llm.html import extract_text, render


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<p>a<p>b<div>c</div>d<br>e<br><br>f", "a\n\nb\n\nc\nd\ne\n\nf"),
    ("a<b>c</b> d <i> e </i>f", "ac d e f"),
    ("<b><p>a</b>b</p>c", "ab\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x", "- a\n- b\n  - c\n- d\n\nx"),
    ("<ol start=3><li>a</li><li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ("<table><tr><th>Name<th>N<tr><td>Al<td>12</table>z", "Name  N\nAl    12\n\nz"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td colspan=2>both wide<tr><td>1<td>2</table>", "both wide\n1  2"),
    ("<table><caption>cap</caption><td>a</table>", "cap\na"),
    ("<head><title>t</title><p>body", "body"),
    ("<script>if(a<b)</script>t<style>q", "t"), ("<noscript>n</noscript><template>x</template>y", "y"),
    ("<p hidden>x</p><div style='display: none'>q<p>z</div>y", "y"),
    ("<span style='visibility:hidden'>a<b>c</b></span>d", "d"),
    ("<dialog>a</dialog><dialog open>b</dialog>", "b"),
    ("x < y & z &amp; w &lt;", "x < y & z & w <"), ("<!-- c -->a<!doctype x>b", "ab"),
    ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"), ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("<div>unclosed <a href='x", "unclosed"), ("</p>a", "a"), ("a<br/>b", "a\nb"),
    ("<td>a<td>b", "a\nb"), ("a<hr>b", "a\n\n---\n\nb"),
])
def test_render(html, text):
    assert render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ('<a href="x"">text</a> more', "text more"), ("<a title=it's>text</a> more", "text more"),
    ("<a title=it's>one</a> two <a title=it's>three</a>", "one two three"),
    ("<p class='a'' hidden>x</p>y", "y"), ('<p title=a"b hidden>x</p>y', "y"),
    ('a<br">b', 'ab'), ('<i>a</i">b', "ab"), ('<a "b>c', "c"), ('<a =">c', "c"), ("<a x=>c", "c"),
    ("<a x = 'a>b' y=\"'>\">c", "c"), ('<a x="a"y=\'>\'>c', "c"), ("<a x=a/b'>c</a>d", "cd"),
    ('a<a href="x>lost', "a"), ("a<a b='c' d=\"", "a"), ("a<a b=", "a"),
])
def test_stray_quotes_in_tags(html, text):
    assert render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"),
    ("<math><semantics><mi>y</mi><annotation>tex</annotation></semantics></math>z", "yz"),
    ("<math><mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr></mtable></math>", "1 2"),
    ("a<svg><title>t</title><desc>d</desc><defs><text>n</text></defs><style>s{}</style>"
     "<script>x()</script><g><path d=M0/></path><text>la<tspan>bel</tspan></text><text>two</text></g>"
     "</svg>b", "a label two b"),
    ("<svg>raw<text/>raw<title/><text>c</text></svg>d", "c d"),
    ("<svg><text><![CDATA[a > &amp; b]]></text></svg>", "a > &amp; b"),
    ("<svg><foreignObject><p>html</p></foreignObject></svg>z", "html\n\nz"),
    ("<svg><path d='M0'><p>after", "after"), ("<a><svg><path></a>after", "after"),
    ("<div><svg><path></div>after", "after"), ("<svg style='display:none'><text>a</text></svg>b", "b"),
    ("<svg/>a<math/>b", "ab"),
    ("<object data=x><param name=p>fall <b>back</b></object> z", "fall back z"),
    ("<object><p>a</object>b", "a\n\nb"), ("<video>v</video><canvas>c</canvas>a", "a"),
])
def test_svg_math_and_object(html, text):
    assert render(html) == text


@pytest.mark.parametrize(("html", "text"), [
    ("<table><tr><th colspan=2>A very long header spanning<th>C<tr><td>a<td>b<td>c</table>",
     "A very long header spanning  C\na  b                         c"),
    ("<table><tr><td colspan=3>x<td>y<tr><td>aaa<td>b<td>c<td>d</table>", "x          y\naaa  b  c  d"),
    ("<table><tr><td>a<td colspan=9>wide<tr><td>b<td>c</table>", "a  wide\nb  c"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d</table>", "a  b\n   c  d"),
    ("a<!-- a --!> b --> c", "a b --> c"), ("x<!-->y<!--->z<!--q-->", "xyz"), ("x<!--->y", "xy"),
    ("<div style='visibility:hidden'>a<b style='Visibility: visible'>b</b>c</div>d", "b\nd"),
    ("<div style='visibility:hidden'><p>a<p hidden style='visibility:visible'>b</div>c", "c"),
    ("<p style=\"background:url('display:none')\">shown", "shown"),
    ("<p style='content:\";display:none\"'>shown", "shown"), ("<p style='x-display:none'>shown", "shown"),
    ("<p style='display:none;display:block'>shown", "shown"),
    ("<p style='display:none !important;display:block'>x</p>y", "y"),
    ("<ruby>k<rp>(</rp><rt>an</rt><rp>)</rp></ruby>", "kan"),
    ("<b>1<i>2</b>3</i>4", "1234"), ("<a><div>1</a>2</div>3", "12\n3"),
])
def test_spans_comments_and_styles(html, text):
    assert render(html) == text


@pytest.mark.parametrize("html", [
    "<div>" * 64000 + "x", "<span>" * 64000 + "<p>a</p>" * 64000,
    "<p><button>" + "<span>" * 32000 + "<div>" * 32000, "<b><i>" * 32000 + "</b></i>" * 32000,
    "<a><div>" * 32000 + "</a>" * 32000, "<table><tr>" + "<td>a" * 64000, "<html>" * 64000])
def test_64000_elements_take_seconds(html):
    least = []
    for n in (len(html) // 4, len(html)):
        start = time.process_time()
        render(html[:n])
        least.append(time.process_time() - start)
    # four times the page, about four times the work (a walk of the stack: sixteen times)
    assert least[1] < 10 and least[1] < 9 * least[0] + 0.5


def test_deep_and_long_pages_are_linear():
    assert render("<div>" * 20000 + "x") == "x"
    assert render("<b" * 50000) == ""
    assert render('<a x="' * 20000) == ""
    assert render("<p>a" * 20000).count("a") == 20000


def test_frames(spark):
    schema = "page_id bigint, url string, html string, text string"
    pages = spark.createDataFrame(
        [(1, "u", "<p>a", "clash"), (1, "u", "<p>a", "clash"), (None, None, None, None)], schema)
    got = sorted((r.page_id or 0, r.text, r.n_chars, r.n_lines) for r in extract_text(pages).collect())
    assert got == [(0, "", 0, 0), (1, "a", 1, 1), (1, "a", 1, 1)]
    assert extract_text(spark.createDataFrame([], schema)).count() == 0
