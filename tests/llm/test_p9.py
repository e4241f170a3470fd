import random
from itertools import product

import pytest

from sitegrain.llm import p9_mix
from sitegrain.llm.p9_mix import draw, fit_lengths, p9_shares, token_lengths

DOCS = "doc_id long, source string, text string, repeats string"
TARGETS = "source string, target_share double, max_repeats int"


@pytest.mark.parametrize("seed", range(30))
def test_lengths_reach_the_best_sum(seed, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(p9_mix, "REST", r.choice([0, 10, 20_000]))
    counts = {r.randint(1, 40): r.randint(1, 4) for _ in range(4)}
    budget = r.randint(-3, 200)
    take = fit_lengths(counts, budget)
    sums = [sum(n * k for n, k in zip(counts, ks)) for ks in product(*(range(c + 1) for c in counts.values()))]
    got = sum(n * k for n, k in take.items())
    assert all(0 < take[n] <= counts[n] for n in take) and got <= max(0, budget)
    if p9_mix.REST == 20_000:
        assert got == max(x for x in sums if x <= max(0, budget))


def corpus(n, seed=0):
    r = random.Random(seed)
    return [(i, r.choice(["a", "a", "a", "b", "c"]), "word " * r.randint(1, 30), "x") for i in range(n)] + [(n, None, "t", ""), (n + 1, "a", None, ""), (n + 2, "a", "", ""), (n + 3, "other", "t", "")]


def test_shares_and_caps(spark):
    docs = spark.createDataFrame(corpus(4000), DOCS)
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 3), ("c", 0.15, 2), ("none", 0.05, 9)], TARGETS)
    drawn, parts = draw(docs, targets)
    rows = drawn.collect()
    tokens = {p.source: sum(r.n_tokens * r.repeats for r in rows if r.source == p.source) for p in parts}
    assert {p.source: p.budget for p in parts} == tokens and tokens["none"] == 0
    total = sum(tokens.values())
    assert all(abs(tokens[p.source] / total - p.share / 0.95) < 1e-4 for p in parts if p.source != "none")
    caps = {p.source: p.repeats for p in parts}
    assert all(1 <= r.repeats <= caps[r.source] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    assert sorted(map(tuple, draw(docs, targets)[0].collect())) == sorted(map(tuple, rows))


def test_given_total_and_empty(spark):
    docs = spark.createDataFrame(corpus(50), DOCS)
    drawn, parts = draw(docs, spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], TARGETS), total_tokens=10**6)
    assert all(p.budget == p.tokens * p.repeats for p in parts)
    assert draw(docs, spark.createDataFrame([], TARGETS))[0].count() == 0
    assert draw(docs.where("false"), spark.createDataFrame([("a", 1.0, 1)], TARGETS))[0].count() == 0


def test_every_document_can_be_chosen(spark):
    # All documents have an even number of tokens but one, which the seeded order puts far behind any small budget.
    order = spark.range(6000).selectExpr("id", f"pmod(xxhash64(id, 7), {1 << 40}) turn").orderBy("turn").collect()
    odd = order[-1].id
    docs = spark.createDataFrame([(r.id, "a", "word word word" if r.id == odd else "word word", "x") for r in order], DOCS)
    assert {r.n_tokens for r in token_lengths(docs).collect()} == {2, 3}
    drawn, parts = draw(docs, spark.createDataFrame([("a", 1.0, 1)], TARGETS), total_tokens=101)
    rows = drawn.collect()
    assert parts[0].budget == 101 == sum(r.n_tokens for r in rows)
    assert odd in {r.doc_id for r in rows} and {r.doc_id for r in rows} - {odd} == {r.id for r in order[:49]}


def test_counts(spark):
    got = {r.doc_id: r.n_tokens for r in token_lengths(spark.createDataFrame([(1, "s", "hello world", ""), (2, "s", "", ""), (3, "s", None, ""), (4, "s", "<|endoftext|>", "")], DOCS)).collect()}
    assert got[1] == 2 and got[2] == 0 and got[4] > 1 and 3 not in got


def test_table(spark):
    rows = p9_shares(spark, "/root/testdata/sf0.01").collect()
    found = sum(r.target_share for r in rows if r.n_tokens)
    assert sum(r.reached_share for r in rows) == pytest.approx(1) and all(abs(r.reached_share - r.target_share / found) < 1e-3 for r in rows if r.n_tokens)
