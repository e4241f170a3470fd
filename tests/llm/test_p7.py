from sitegrain.llm.p7_lookalike import canonical_forms, p7_found

SAME = [("Phase \u2161", "Phase II"), ("Phase \u2172", "Phase iii"), ("\uff76\uff9e\uff72", "\u30ac\u30a4"), ("\uffa1", "\u3131"), ("\uffe1 5", "\u00a3 5"), ("\uffe5", "\u00a5"), ("\uff21\uff22", "AB"), ("\ufb01n", "fin")]
OTHER = [("Phase II", "Phase ii"), ("caf\u00e9", "cafe"), ("x\u00b2", "x2"), ("\u30ab", "\u30ac")]


def test_looks(spark):
    texts = sorted({x for pair in SAME + OTHER for x in pair})
    form = {r.snippet: r.canonical for r in canonical_forms(spark.createDataFrame([(x,) for x in texts], "snippet string")).collect()}
    assert [(a, b) for a, b in SAME if form[a] != form[b]] == []
    assert [(a, b) for a, b in OTHER if form[a] == form[b]] == []


def test_query_runs(spark):
    assert p7_found(spark, "/root/testdata/sf0.001").columns == ["field_name", "ord_a", "ord_b"]
