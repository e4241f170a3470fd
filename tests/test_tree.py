import pytest

from sitegrain.functions.tree import facts_of, map_place, page_facts

PAGE = """<div itemscope><span itemprop="name">Ann Clinic</span><div itemscope itemprop="address"><b itemprop="streetAddress">1 Elm St</b>, <b itemprop="addressLocality">Brel</b></div><i itemprop="telephone">555</i></div>
<p data-label="Name&lt;br/&gt;12 Main St&lt;br/&gt;City, ST 12345">x</p><li data-street="9 Oak" data-city="Brel" data-zip="12345">y</li>
<iframe src="https://www.google.com/maps/embed?pb=!1m18!2s7+Low+Road%2C+Brel!5e0"></iframe><a href="https://maps.google.com/?q=1+Elm+St">m</a><a href="https://maps.google.com/?q=1+Elm+St">again</a>
<h2>North office</h2><p>3 High St</p><p>Brel, TX 12345</p><h3>No place</h3><p>text</p><div class="page footer-wide">At the <b>end</b><script>no</script></div>"""


def test_facts():
    assert facts_of(PAGE) == [
        ("microdata", "1 Elm St, Brel"), ("microdata", "Ann Clinic, 555"), ("data", "Name | 12 Main St | City, ST 12345"), ("data", "9 Oak, Brel, 12345"), ("map", "7 Low Road, Brel"), ("map", "1 Elm St"), ("heading", "North office | 3 High St Brel, TX 12345"), ("footer", "At the end"),
    ]


@pytest.mark.parametrize("html", [None, "", "<", "</div>", "<div itemscope><b itemprop='name'>one part</b>", "<h1>" * 99, "text"])
def test_nothing(html):
    assert facts_of(html) == []


@pytest.mark.parametrize("url, want", [("https://www.google.com/maps/place/1+Elm+St,+Brel/@1,2", "1 Elm St, Brel"), ("https://www.google.com/maps/dir//5+Low+Rd", "5 Low Rd"), ("https://maps.google.com/maps?daddr=9+Oak&q=x", "9 Oak"), ("https://a.test/?q=1", ""), ("https://[bad", ""), ("", "")])
def test_maps(url, want):
    assert map_place(url) == want


def test_frames(spark):
    rows = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (1, PAGE, "x")], "ord long, html string, fact string")
    assert page_facts(rows).count() == 16 and page_facts(rows.where("false")).count() == 0
