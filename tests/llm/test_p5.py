from itertools import combinations

import pytest

from sitegrain.llm.p5_names import average_linkage, p5_found, parse, similar, variant_groups
from sitegrain.llm.pairs import row_pairs

STATES = ("florida", "new york", "west virginia", "virginia")
ORGS = [
    ["Gizadorbri Kakurmapa Family Clinic", "GIZADORBRI & KAKURMAPA FAM. CLINIC", "Family Clinic, Gizadorbri Kakurmapa", "The Gizadorbri-Kakurmapa Family Clinic", "GizadorbriKakurmapa Family Clinic LLC", "Gizadorbri Kakurmapa", "Gizdaorbri Kakurmapa Fam. Clin., P.C."],
    ["Gizadorbri Fugrokilnor Family Clinic"],
    ["Lifazimpa Tromdanzafu Health Partners of Florida", "Health Ptnrs at Lifazimpa Tromdanzafu of Florida"],
    ["Lifazimpa Tromdanzafu Health Partners of West Virginia"],
    ["Susan Zerlamlamma DO", "Zerlamlamma, Sue", "dr. s zerlamlamma", "Office of Dr. Susan Zerlamlamma"],
    ["Dr. Robert Zerlamlamma"],
]
LABELS = ["HQ", "Main Office", "Annex", "", " ", None, "N/A", "###", "x" * 4000]
SCHEMA = "field_name string, scope string, ord long, name string, id string"


def pairs_of(spark, rows, field="canonical_org_name"):
    frame = spark.createDataFrame([(field, s, i, n, "clash") for i, (s, n) in enumerate(rows)], SCHEMA)
    return {tuple(r) for r in row_pairs(*variant_groups(frame, STATES)).collect()}


def test_variants(spark):
    rows, want = [], set()
    for group in ORGS:
        want |= set(combinations(range(len(rows), len(rows) + len(group)), 2))
        rows += [("", n) for n in group]
    rows += [("", n) for n in LABELS]
    assert pairs_of(spark, rows) == want


def test_scopes_copies_and_empty(spark):
    a, b = ORGS[0][:2]
    rows = [("x", a), ("y", b), ("x", b), ("x", a), ("x", b)]
    assert pairs_of(spark, rows, "location_name") == {(0, 2), (0, 4), (2, 3), (3, 4)}
    assert pairs_of(spark, []) == set()


@pytest.mark.parametrize("name, want", [("Bamerzadel, Chuck", ("bamerzadel", "", "", "charles")), ("J. Zomograrbim, M.D.", ("zomograrbim", "", "", "j")), ("William R. Drustavamgi, MD", ("drustavamgi", "", "", "william")), ("Lamti Rsch Ctr., L.L.C.", ("lamti", "center research", "", "")), ("Visom Burar Physicians' Group", ("visomburar", "physicians", "", "")), ("West Campus", ("", "", "", ""))])
def test_parts(name, want):
    assert parse(name, STATES) == want


def test_cosine_join_equals_all_pairs(spark):
    import math
    from collections import Counter

    words = ["gizadorbrikakurmapa", "gizdaorbrikakurmapa", "gizadorbrikakurmap", "lifazimpatromdanzafu", "lifazimpatromdansafu", "lifazimpa", "ab", "kakurmapagizadorbri"]
    got = {(r.a, r.b): r.cos for r in similar(spark.createDataFrame([(i, "s", w, "", "", "") for i, w in enumerate(words)], "id long, scope string, core string, kind string, state string, first string")).collect()}
    grams = [{f"^{w}$"[i : i + 5] for i in range(max(1, len(w) - 2))} for w in words]
    df = Counter(g for x in grams for g in x)
    weight = {g: math.log(len(words) / n) + 1 for g, n in df.items()}
    norm = [math.sqrt(sum(weight[g] ** 2 for g in x)) for x in grams]
    cos = {(i, j): sum(weight[g] ** 2 for g in grams[i] & grams[j]) / norm[i] / norm[j] for i, j in combinations(range(len(words)), 2)}
    close = {(0, 1), (0, 2), (1, 2), (3, 4)}
    assert set(got) == {p for p in close if cos[p] >= 0.4}
    assert all(abs(got[p] - cos[p]) < 1e-9 for p in got)


def test_average_linkage(spark):
    edges = [(1, 2, 0.9), (1, 3, 0.8), (2, 3, 0.85), (3, 4, 0.5), (5, 6, 0.4), (6, 7, 0.4)]
    got = {r.id: r.grp for r in average_linkage(spark.createDataFrame(edges, "a long, b long, cos double"), 0.3).collect()}
    assert got[1] == got[2] == got[3] == 1 and got[4] == 4 and got[5] == got[6] == 5 and got[7] == 7


def test_table(spark):
    rows = [tuple(r) for r in p5_found(spark, "/root/testdata/sf0.001").collect()]
    assert rows and len(rows) == len(set(rows)) and all(a < b for _, a, b in rows)
