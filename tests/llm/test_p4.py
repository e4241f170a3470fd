from itertools import combinations

import pytest

from sitegrain.llm.p4_addresses import p4_found, parse, same_addresses

STATES = (("az", "arizona"), ("ga", "georgia"), ("il", "illinois"), ("nc", "north carolina"), ("ny", "new york"), ("tx", "texas"))
SAME = [
    ("1", [("100 N. Fifth Street, Suite 510", "N. Vonleg", "TX", "73555"), ("100 north 5th st #510", "North Vonleg", "Texas", ""), ("Suite 510, 100 North 5th St.", "", "TX", "73555-1234"), ("5th Street 100", "North Vonlge", "", "")]),
    ("2", [("18 Old Gartrirdel Creek Road E., floor 2", "Fort Mimbel", "NY", "14273"), ("18 East Old Gartridrel Crreek Rd, 2nd Fl", "Ft Mimbel", "N.Y.", "14273"), ("Numlam Tower, 18 Old Gartrirdel Creek Rd", "Fort Mimbel", "", ""), ("18 E Old Gartrirdel Creek Road, Fort Mimbel, NY 14273", "", "", "")]),
    ("3", [("12 St. Lonbranva Avenue", "Zazim", "GA", "30021"), ("12 Saint Lonbranva Ave", "ZAZIM", "GA", "30012")]),
]
OTHER = [("101 N 5th St Suite 510", "N Vonleg", "TX", "73555"), ("100 S 5th St Suite 510", "N Vonleg", "TX", "73555"), ("100 N 5th Lane Suite 510", "N Vonleg", "TX", "73555"), ("100 N 5th St Suite 511", "N Vonleg", "TX", "73555"), ("100 N 6th St", "N Vonleg", "TX", "73555"), ("12 Saint Lonbranva Ave", "Drehomp", "GA", "30999"), ("18 E Old Gartrirdel Mill Rd", "Fort Mimbel", "NY", "14273")]
JUNK = [(None, "Zazim", "GA", "30021"), ("", "", "", ""), (" ", None, None, None), ("{{street}}", "Zazim", "GA", "30021"), ("12 Sample Street", "Zazim", "GA", "30021"), ("x" * 5000, "y" * 5000, "z", "1"), ("Lonbranva Avenue", "Zazim", "GA", "30021")]
COLUMNS = "ord long, address_street string, address_city string, address_state string, address_zip string, number string"


@pytest.fixture(scope="module")
def zips(spark):
    return spark.createDataFrame([("73555", "North Vonleg", "TX"), ("14273", "Fort Mimbel", "NY")], "zip string, city string, state string")


def test_pairs(spark, zips):
    rows, want = [], set()
    for _, forms in SAME:
        ids = range(len(rows), len(rows) + len(forms))
        want |= set(combinations(ids, 2))
        rows += forms
    want |= {(3, len(rows) + 1), (3, len(rows) + 3)}  # row 3 leaves direction and suite out, so both fit
    rows += OTHER + JUNK
    frame = spark.createDataFrame([(i, *r, "clash") for i, r in enumerate(rows)], COLUMNS)
    assert {tuple(r) for r in same_addresses(frame, STATES, zips).collect()} == want


def test_copies_are_no_pair_but_other_spellings_of_copies_are(spark, zips):
    a, b = SAME[2][1]
    frame = spark.createDataFrame([(i, *x, "") for i, x in enumerate([a, a, b, b, (" 12 St. Lonbranva Avenue", *a[1:])])], COLUMNS)
    assert {tuple(r) for r in same_addresses(frame, STATES, zips).collect()} == {(0, 2), (0, 3), (1, 2), (1, 3), (0, 4), (1, 4), (2, 4), (3, 4)}


def test_empty(spark, zips):
    assert same_addresses(spark.createDataFrame([], COLUMNS), STATES, zips).count() == 0


@pytest.mark.parametrize("text, want", [("Trezer Street 7338 (Bran Center)", ("7338", "trezer", "street", "")), ("12495 Hepu Mill Blvd #841", ("12495", "hepu", "boulevard", "841")), ("12 Nidel Lae Drive", ("12", "nidel", "drive", "")), ("Ste# 9B, 1 Way", ("1", "way", "", "9b"))])
def test_parts(text, want):
    number, _, name, _, kind, unit, *_ = parse(text, "", "", "", STATES)
    assert (number, name, kind, unit) == want


def test_rows_are_distinct_and_ordered(spark):
    rows = [tuple(r) for r in p4_found(spark, "/root/testdata/sf0.001").collect()]
    assert rows and len(rows) == len(set(rows)) and all(a < b for a, b in rows)
