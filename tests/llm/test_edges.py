"""Nulls, empty and very long texts, ties, repeated rows, empty tables and columns of clashing names."""

import datetime

import pytest
from pyspark.sql import functions as F

from sitegrain.llm.p1_canonical import bigrams, canonicalize, labels, set_similarity_join
from sitegrain.llm.p2_residue import dummy_phone, dummy_street, error_pages
from sitegrain.llm.p3_survivor import truth_discovery
from sitegrain.llm.p5_names import variant_groups
from sitegrain.llm.p7_lookalike import canonical_forms
from sitegrain.llm.p10_spans import pairs_of, shared_windows

SMALL = "/root/testdata/sf0.001"
LONG = "lorem (dolor " * 60_000
AT = datetime.datetime(2024, 1, 1)


def test_p1_values(spark):
    rows = [("specialties", v, "clash") for v in (None, "", " ", LONG, "é" * 9, "Cardiology", "Cardiology", "123", "\n")]
    frame = spark.createDataFrame(rows, "field_name string, value string, canon_key string")
    got = canonicalize(frame, labels(spark, SMALL)).collect()
    assert len(got) == len(rows) and {(r.value, r.canon_key) for r in got} == {(v, "Cardiology" if v == "Cardiology" else "") for _, v, _ in rows}
    assert canonicalize(frame.where("false"), labels(spark, SMALL)).count() == 0


def test_p1_bigrams(spark):
    got = {r.t: sorted(r.g) for r in spark.createDataFrame([("ab  c",), ("",), ("aa aa",)], "t string").select("t", bigrams(F.col("t")).alias("g")).collect()}
    assert got == {"ab  c": ["^a", "^c", "ab", "b$", "c$"], "": ["^$"], "aa aa": ["^a", "a$", "aa"]}


def test_p1_join_equals_all_pairs(spark):
    sets = {i: {chr(97 + (i * 7 + j * j) % 11) for j in range(1 + i % 5)} for i in range(30)}
    left = spark.createDataFrame([("p", i, sorted(s)) for i, s in sets.items()] + [("p", 99, [])], "part string, lid int, toks array<string>")
    right = left.toDF("part", "rid", "toks")
    for t in (0.2, 0.5, 1.0):
        got = {(r.lid, r.rid) for r in set_similarity_join(left, right, t).collect()}
        assert got == {(a, b) for a, x in sets.items() for b, y in sets.items() if len(x & y) / len(x | y) >= t - 1e-9}


def test_p2_pages(spark):
    rows = [(1, "h", "u", None, "x"), (2, "h", "u", "", "x"), (3, None, None, "<p>404 Not Found</p>", "x"), (3, None, None, "<p>404 Not Found</p>", "x"), (4, "h", "u", f"<p>{LONG}</p>", "x"), (5, "h", "u", "<p>" + "a real word of text " * 50_000 + "</p>", "x"), (6, "h", "u", "<" * 9999, "x")]
    frame = spark.createDataFrame(rows, "ord long, domain string, url string, html string, line string")
    assert {r.ord for r in error_pages(frame).collect()} <= {3, 4} and {r.ord for r in error_pages(frame).collect()} >= {3}
    assert error_pages(frame.where("false")).count() == 0


@pytest.mark.parametrize("value, street, phone", [(None, False, False), ("", False, False), ("  ", False, False), ("{{x}}", True, True), ("12 Sample St", True, None), ("12 Sample Mill Road", False, None), ("(555) 555-0100", None, True), ("(612) 234-5678", None, False), ("N/A", True, True)])
def test_p2_values(spark, value, street, phone):
    r = spark.createDataFrame([(value,)], "v string").select(dummy_street("v").alias("s"), dummy_phone("v").alias("p")).first()
    assert (street is None or bool(r.s) == street) and (phone is None or bool(r.p) == phone)


def test_p3_ties_and_nulls(spark):
    rows = [(1, "f", "a", None, AT, 2, "x"), (1, "f", "a", None, AT, 1, "x"), (1, "f", "b", "low", None, 3, "x"), (2, "f", "c", "high", AT, 5, "x"), (2, "f", "d", "high", AT, 4, "x"), (2, "f", "d", "high", AT, 4, "x")]
    frame = spark.createDataFrame(rows, "entity long, field string, value string, source string, at timestamp, ord long, support string")
    got = {r.entity: (r.value, r.ord) for r in truth_discovery(frame, "max", ["high", "low"]).collect()}
    assert got == {1: ("b", 3), 2: ("d", 4)}
    assert truth_discovery(frame.where("false"), "max", ["high"]).count() == 0 and truth_discovery(frame.where("false")).count() == 0


def test_p5_long_names(spark):
    name = "abcdefghij" * 300
    rows = [("location_name", "d", 1, name, ""), ("location_name", "d", 2, name + "x", ""), ("location_name", None, 3, None, ""), ("location_name", "d", 4, "(" * 5000, "")]
    pairs = variant_groups(spark.createDataFrame(rows, "field_name string, scope string, ord long, name string, grp string"), ())[1]
    assert pairs.count() == 1


def test_p7_columns(spark):
    rows = [(1, "café", "a", "k"), (2, "café", "b", "k"), (3, None, "c", "k"), (4, " ", "d", "k"), (5, "ａb", "e", "k"), (6, "ab", "f", "k"), (1, "café", "a", "k"), (7, "​" * 9999, "g", "k")]
    frame = spark.createDataFrame(rows, "ord long, snippet string, look string, canonical string")
    got = canonical_forms(frame).collect()
    form = {r.ord: r.canonical for r in got}
    assert len(got) == len(rows) and got[0].asDict().keys() == {"ord", "snippet", "look", "canonical"}
    assert form[1] == form[2] and form[3] is None and form[4] == "" and form[5] == form[6] == "ab" and form[7] == ""
    assert canonical_forms(frame.where("false")).count() == 0


def test_p10_hot_group(spark):
    rows = [(i, f"{i} " + "shared stretch of forty letters and more, " + f" {i}") for i in range(120)]
    assert pairs_of(shared_windows(spark.createDataFrame(rows, "doc_id long, text string"), 40)).count() == 120 * 119 // 2
