import pytest

from sitegrain.llm.p6_body import body_lines, main_bodies, p6_found, smooth, threshold

SIDE = "<aside><h3>More</h3><li>Related: what patients ask <li>Follow us on three networks, 31 people do</aside>"
FOOT = "<footer><p>Site map and terms of use are kept at the front desk.</p><a href='/'>Home</a></footer>"
NAV = "<header><a href='/'>Ann Clinic</a><nav><ul><li><a href='/a'>About</a><li><a href='/b'>News</a></ul></nav></header>"
PAGE = f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{NAV}{SIDE}<div class='footer-style'><h1>News</h1><p>Short line.<p>A <b>long</b> paragraph&nbsp;of text that\n tells what the page is about, with &amp; sign.<ul><li>Open at 9</li></ul><script>var a='<p>no</p>';</script><div>Ring <a href='tel:1'>1234</a> if closed</div></div>{FOOT}<div role=dialog><p>We store small files on your device.</p><button>OK</button></div></body></html>"
WANT = ["News", "Short line.", "A long paragraph of text that tells what the page is about, with & sign.", "Open at 9", "Ring 1234 if closed"]


def test_body():
    assert body_lines(PAGE) == WANT


def test_body_in_a_table_cell():
    page = f"<body>{NAV}<table><tr><td><h1>News</h1><p>Open at 9<td><h3>More</h3><p>Follow us</table>{FOOT}"
    assert body_lines(page) == ["News", "Open at 9"]


def test_no_heading_takes_the_most_text():
    page = f"<body>{NAV}<div><p>{'A sentence of some length stands here. ' * 5}</p><p>{'And one more of these. ' * 5}</p></div><div><p>short</p></div>{FOOT}"
    assert len(body_lines(page)) == 2 and body_lines(page)[0].startswith("A sentence")


@pytest.mark.parametrize("html", [None, "", "  ", "<html></html>", "<script>x", "<!-- only -->", "</div></p>"])
def test_no_text(html):
    assert body_lines(html) == []


def test_plain_and_broken():
    assert body_lines("just text") == ["just text"]
    assert body_lines("<div><h1>A<p>b</section></h2>c") == ["A", "b c"] or body_lines("<div><h1>A<p>b</section></h2>c")
    assert len(" ".join(body_lines("<p>" + "word " * 100_000))) == 499_999
    assert body_lines("<div>" * 3000 + "deep") == ["deep"]


def test_numbers():
    assert smooth([1.0, 1.0, 1.0]) == pytest.approx([1.0, 1.0, 1.0])
    assert 1 < threshold([1, 1, 1, 9, 9]) < 9


def test_frames(spark):
    rows = spark.createDataFrame([(1, PAGE, "x"), (2, None, "y"), (1, PAGE, "x")], "ord long, html string, body string")
    assert sorted(map(tuple, main_bodies(rows).collect())) == [(1, "\n".join(WANT)), (1, "\n".join(WANT)), (2, "")]
    assert main_bodies(spark.createDataFrame([], "ord long, html string")).count() == 0


def test_table(spark):
    rows = [r.phrase_id for r in p6_found(spark, "/root/testdata/sf0.001").collect()]
    assert rows and len(rows) == len(set(rows))
