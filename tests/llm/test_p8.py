import random

import duckdb
import numpy as np
import pytest

from sitegrain.llm import p8_leaks
from sitegrain.llm.p8_leaks import common_subsequence, leaked_runs, p8_found, paraphrased, randomised_svd, words_of


def brute(docs, items, run=12):
    out = set()
    for i, t in items:
        w = words_of(t)
        runs = {tuple(w[k : k + run]) for k in range(len(w) - run + 1)}
        for d, x in docs:
            v = words_of(x)
            if any(tuple(v[k : k + run]) in runs for k in range(len(v) - run + 1)):
                out.add((i, d))
    return out


def material(seed):
    r = random.Random(seed)
    word = lambda n=40: r.choice("abcdefghij") + str(r.randint(0, n))
    items = [(i, " ".join(word() for _ in range(r.choice([5, 11, 12, 13, 40])))) for i in range(12)]
    docs = []
    for d in range(60):
        words = [word(400) for _ in range(r.randint(0, 80))]
        if r.random() < 0.6:
            source = r.choice(items)[1].upper().split()
            at, n = r.randint(0, max(0, len(source) - 12)), r.choice([10, 11, 12, 12, 13, 20])
            words[r.randint(0, len(words)) : 0] = source[at : at + n]
        docs.append((d, ", ".join(words)))
    return docs + [(100, None), (101, ""), (102, " ".join(t for _, t in items)), docs[0]], items + [(50, None), (51, ""), items[4]]


@pytest.mark.parametrize("seed, block", [(1, 10**6), (2, 10**6), (3, 30)])
def test_runs_equal_brute_force(spark, seed, block, monkeypatch):
    monkeypatch.setattr(p8_leaks, "BLOCK_WORDS", block)
    docs, items = material(seed)
    got = leaked_runs(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string"))
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == brute(docs, items) and len(rows) == len(set(rows))


def test_table(spark):
    docs, items = (duckdb.sql(f"select {k}, text from '/root/testdata/sf0.001/{t}.parquet'").fetchall() for k, t in (("doc_id", "documents"), ("item_id", "eval_items")))
    assert {tuple(r) for r in p8_found(spark, "/root/testdata/sf0.001").collect()} == brute(docs, items)


def test_empty(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert leaked_runs(none, some).count() == 0
    assert leaked_runs(some.withColumnRenamed("item_id", "doc_id"), none.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_svd(spark):
    r = np.random.default_rng(0)
    ids, idf = r.integers(0, 30, (80, 6)), r.random(30) + 0.5
    dense = np.zeros((80, 30))
    for row, x in zip(dense, ids):
        np.add.at(row, x, idf[x])
    v = randomised_svd(spark.createDataFrame([(x.tolist(),) for x in ids], "ids array<int>"), idf, 10)
    want = np.linalg.svd(dense)[2][:10]
    assert np.allclose(np.linalg.norm(dense @ v), np.linalg.norm(dense @ want.T), rtol=0.01) and np.allclose(v.T @ v, np.eye(10), atol=1e-8)


def test_subsequence():
    assert common_subsequence(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2
    assert common_subsequence(np.array([], dtype=int), np.array([1])) == 0


def test_paraphrase(spark):
    item = "How many of the 37 clinics in Brel did nurse Karo visit between May 2021 and June 2022 for the Tindal study of gout"
    docs = [(1, item.replace("visit", "see").replace("How many", "Count how many")), (2, "Patients ask what to bring and where to park near the old mill of Stendal on a Friday"), (3, item.replace("37", "99").replace("2021", "1999").replace("2022", "1998"))]
    got = paraphrased(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert {(r.item_id, r.doc_id) for r in got.collect()} == {(7, 1)}
