import random
from itertools import combinations

import duckdb
import pytest

from sitegrain.llm import p10_spans
from sitegrain.llm.p10_spans import p10_found, pairs_of, shared_spans, shared_windows

SPAN = 40


def brute(docs, span):
    sets = [(d, {t[i : i + span] for i in range(len(t) - span + 1)}) for d, t in docs if t]
    return sorted({(min(a, b), max(a, b)) for (a, x), (b, y) in combinations(sets, 2) if a != b and x & y})


def corpus(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abcd é😀") for _ in range(n))
    parts = [word(r.choice([30, 39, 40, 41, 55, 90])) for _ in range(8)]
    texts = [word(r.randint(0, 60)) + r.choice(parts) + word(r.randint(0, 60)) + r.choice(parts + [""]) for _ in range(60)]
    return list(enumerate([*texts, None, "", "x", "a" * 300, "a" * 40, "a" * 39, texts[0], texts[1] * 9]))


@pytest.mark.parametrize("seed", range(3))
def test_pairs_equal_brute_force(spark, seed, monkeypatch):
    docs = corpus(seed)
    frame = spark.createDataFrame(docs + docs[:5], "doc_id long, text string")
    assert sorted(map(tuple, pairs_of(shared_windows(frame, SPAN)).collect())) == brute(docs, SPAN)


def test_spans(spark):
    docs = corpus(7)
    windows = {}
    for d, t in docs:
        for i in range(len(t or "") - SPAN + 1):
            windows.setdefault(t[i : i + SPAN], set()).add(d)
    want = {d: {i + j for i in range(len(t or "") - SPAN + 1) if len(windows[t[i : i + SPAN]]) > 1 for j in range(SPAN)} for d, t in docs}
    got = {d: set() for d, _ in docs}
    for r in shared_spans(spark.createDataFrame(docs, "doc_id long, text string"), SPAN).collect():
        got[r.doc_id] |= set(range(r.start, r.stop))
    assert got == want


def test_pieces_of_long_texts():
    text = "".join(random.Random(1).choices("abc", k=500))
    p10_spans_piece, p10_spans.PIECE = p10_spans.PIECE, 64
    try:
        parts = [x for lot in p10_spans._pieces([1], [text], SPAN) for x in lot]
    finally:
        p10_spans.PIECE = p10_spans_piece
    assert [text[at : at + len(p)] for _, at, p in parts] == [p for _, _, p in parts]
    assert sum(len(p) - SPAN + 1 for _, _, p in parts) == len(text) - SPAN + 1


def test_empty(spark):
    assert pairs_of(shared_windows(spark.createDataFrame([], "doc_id long, text string, key string"), SPAN)).count() == 0


def test_table(spark):
    docs = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert sorted(map(tuple, p10_found(spark, "/root/testdata/sf0.001").collect())) == brute(docs, 200)
