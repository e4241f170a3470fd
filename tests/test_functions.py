import pytest
from pyspark.sql import functions as F

from sitegrain.functions import addresses as ad
from sitegrain.functions import pages as pg
from sitegrain.functions import scoring as sc
from sitegrain.functions import urls as ul
from sitegrain.functions.text import clean, contains_any, squeeze


def one(spark, f, *values):
    kinds = ", ".join(f"c{i} {'int' if isinstance(v, int) else 'string'}" for i, v in enumerate(values))
    return spark.createDataFrame([tuple(values)], kinds).select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize("text, want", [
    ("200 E Main St SE, Suite 100", "200 East Main Street Southeast, Suite 100"), ("St Rd 60", "State Road 60"), ("Main St N", "Main Street North"), ("St Francis Dr", "Saint Francis Drive"), ("12 Oak St Suite# 300", "12 Oak Street, Suite 300"),
    ("12 Oak St #221", "12 Oak Street, Suite 221"), ("9 elm ave 4th Floor", "9 Elm Avenue, 4th Floor"), ("1 Elm Rd ste 8a", "1 Elm Road, Suite 8A"), ("", ""), (None, ""), ("   ", ""),
])
def test_display(spark, text, want):
    assert one(spark, ad.canonical_display, text) == want


@pytest.mark.parametrize("text, want", [("Riverside Plaza, 59 Elm Rd", ("59", "elm")), ("100 4th Ave", ("100", "th")), ("100 5th Ave", ("100", "th")), ("12 N Oak", ("12", "north")), ("12 Oak St, 2nd Floor", ("12", "oak")), ("", ("", "")), (None, ("", ""))])
def test_signature(spark, text, want):
    assert tuple(one(spark, ad.street_signature, text)) == want


@pytest.mark.parametrize("text, want", [("123 Main St | Austin, TX 78701", ("123 Main St", "Austin", "TX", "78701")), ("Name — 123 Main St, City, TX 12345-9999", ("123 Main St", "City", "TX", "12345")), ("Austin", ("", "Austin", "", "")), ("", ("", "", "", "")), (None, ("", "", "", ""))])
def test_address_line(spark, text, want):
    assert tuple(one(spark, lambda c: ad.parse_address_line(c, ["TX"]), text)) == want


def test_streets(spark):
    assert one(spark, ad.norm_street, "5 N. Oak St, #3") == "5 north oak street suite 3"
    assert one(spark, lambda c: ad.norm_street(c, False), "5 N. Oak St Ste 3") == "5 north oak street"
    assert one(spark, ad.strip_suite, "5 Oak St Ste 3") == "5 Oak St" and one(spark, ad.strip_suite, None) == ""
    assert [one(spark, ad.norm_zip, z) for z in ("12345-678", "123", None)] == ["12345", "", ""]
    assert [one(spark, ad.norm_phone, p) for p in ("+1 (612) 234-5678", "234-5678", None)] == ["6122345678", "2345678", ""]
    assert one(spark, ad.expand_city, "Ft. Mt St") == "fort mount saint"
    assert [one(spark, ad.bad_zip, z, s) for z, s in (("21201", "AZ"), ("85001", "AZ"), ("2120", "AZ"), ("21201", "XX"), (None, None))] == [True, False, False, False, False]


@pytest.mark.parametrize("street, page, want", [("2025 Warren Avenue", "since 2025 we " + "grow " * 20 + "warren street", False), ("12 Oak St", "find us at 12 N. Oak Street", True), ("Oak St", "nothing", True), ("12 St", "at 12 now", True), ("12 St", "at 13", False), (None, None, True)])
def test_street_on_page(spark, street, page, want):
    assert one(spark, ad.street_on_page, street, page) is want


def test_placeholder(spark):
    assert one(spark, ad.looks_like_placeholder, "123 Research Way", None, None) and one(spark, ad.looks_like_placeholder, None, "(555) 555-1234", "")
    assert not one(spark, ad.looks_like_placeholder, None, None, None)


@pytest.mark.parametrize("status, html, want", [(403, "x" * 600, True), (429, "x" * 600, True), (503, "x" * 600, True), (200, "tiny", True), (200, "x" * 600 + "cloudflare ray id" + "y" * 200, True), (200, "<html><body>" + "content " * 100 + "</body></html>", False), (200, None, True)])
def test_blocked(spark, status, html, want):
    assert one(spark, pg.is_blocked, status, html) is want


def test_pages(spark):
    assert one(spark, pg.is_parked, "", "", 0) is False and one(spark, pg.is_parked, "x" * 900, "https://sedoparking.com/a", 301) is True
    assert one(spark, pg.content_quality, "x" * 6000 + "Please log in") == "login_wall" and one(spark, pg.content_quality, None) == "ok"
    assert one(spark, pg.content_quality, "<script>" + "x" * 11000 + "</script><p>hi</p>") == "spa_shell"
    assert one(spark, pg.visible_text, "<style>a</style><b>A</b>\n c") == "A c" and one(spark, pg.visible_text, None) == ""
    assert one(spark, pg.error_class, "SSL: handshake") == "ssl" and one(spark, pg.error_class, None) == ""
    html = '<div data-label="Name<br/>12 Main St<br/>City, ST 12345"></div><a href="https://maps.google.com/?q=1+Main+St">m</a><span itemprop="streetAddress">1 Elm</span>'
    assert one(spark, pg.data_addresses, html) == ["Name | 12 Main St | City, ST 12345"] and one(spark, pg.map_addresses, html) == ["1 Main St"] and one(spark, pg.microdata, html) == ["1 Elm"]
    assert one(spark, pg.structured_data, '<script type="application/ld+json">{broken</script>') == [] and one(spark, pg.json_ld, None) == []


def test_structured_data(spark):
    page = "".join(f'<script type="application/ld+json">{j}</script>' for j in ('{"@type":"A","name":"n","address":{"x":"1"}}', '[{"@type":"B"},{"name":"no type"}]', '{"@graph":[{"@type":"C","telephone":"5"},{"@type":"D"}]}', "{broken", ""))
    assert [tuple(x) for x in one(spark, pg.structured_data, page)] == [("A", "n", None, '{"x":"1"}'), ("B", None, None, None), ("C", None, "5", None), ("D", None, None, None)]


def test_urls(spark):
    u = "HTTPS://www.A.test/X/y/?q=a%20b#f"
    assert one(spark, ul.norm_url, u) == "a.test/x/y" and one(spark, ul.url_host, u) == "a.test" and one(spark, ul.query_param and (lambda c: ul.query_param(c, "q")), u) == "a b"
    assert one(spark, ul.parent_path, u) == "/x" and one(spark, ul.parent_path, None) == "/" and one(spark, ul.page_url, u) == "HTTPS://www.A.test/X/y"
    assert one(spark, ul.links, '<a href="/a">1</a><a href="b">2</a><a href="#x">3</a><a href="mailto:x">4</a><a href="//c.test/d">5</a>', "a.test") == ["https://a.test/a", "https://a.test/b", "https://c.test/d"]
    assert one(spark, ul.specialties_of, "https://a.test/spain/cardiology") == ["Cardiology", "Pain Management"]
    assert one(spark, ul.humanised, "a-b_c.test") == "a b c" and one(spark, lambda c: ul.query_param(c, "q"), "x?q=%zz") == ""


@pytest.mark.parametrize("f, expected, actual, want", [
    (sc.compare_name, "", "x", "skip"), (sc.compare_name, "A B", None, "miss"), (sc.compare_name, "a b", "The A B Inc", "exact"), (sc.compare_phone, "(612) 234-5678", "+1 612 234 5678", "exact"), (sc.compare_phone, "612", "613", "miss"), (sc.compare_address, "12 Oak", "at 12", "exact"),
    (sc.compare_address, "oak tx", "zz tx", "soft"), (sc.compare_count, "90+", "90+ sites", "exact"), (sc.compare_count, "90+", "90", "soft"), (sc.compare_count, "many", "90", "skip"), (sc.compare_url, "http://www.a.test/x/", "https://a.test/x", "exact"), (sc.compare_url, "a.test/x", "a.test/y", "soft"), (sc.compare_label, "Site", "site ", "exact"), (sc.compare_label, None, None, "skip"),
])
def test_comparators(spark, f, expected, actual, want):
    assert one(spark, f, expected, actual) == want


def test_text(spark):
    assert one(spark, clean, " a ") == "a" and one(spark, clean, None) == "" and one(spark, squeeze, "a\n\n\n\nb   c ") == "a\n\nb c" and one(spark, lambda c: contains_any(c, ["x"]), None) is False
