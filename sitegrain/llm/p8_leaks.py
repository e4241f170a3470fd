"""Problem 8: evaluation texts leaking into training text.

Latent semantic retrieval. Passages (windows of words) of the items are weighted by TF-IDF with frequencies over all
documents, and a distributed randomised SVD gives their latent space. Every passage of every document is projected
into it; passages whose energy lies outside of the space cannot be alike and are passed over, the others are looked up
by cosine. What is found is verified: word by word for verbatim runs, by longest common subsequence and by the numbers
and codes an answer rests on for paraphrases.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.sources.tables import materialize, table

RUN, RANK, OVERSAMPLE, ROUNDS = 12, 64, 16, 3
#: Words of items that are searched at once; more items are searched in several blocks.
BLOCK_WORDS = 2_000_000
#: Hyperplanes of the cosine look-up.
PLANES = 20
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """The longest runs of letters and digits, in lower case."""
    return WORD.findall(text.lower()) if text else []


def _windows(n_words: int, width: int, step: int) -> np.ndarray:
    """Starts of the windows; the last one ends with the text. A text shorter than the window is one window."""
    if n_words == 0:
        return np.zeros(0, dtype=np.int64)
    last = max(0, n_words - width)
    return np.unique(np.append(np.arange(0, last + 1, step), last))


@dataclass
class Space:
    """The latent space of one block of items: word numbers, idf, the idf of a word no item has, and word vectors."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    foreign: float
    vectors: np.ndarray

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, [-1] * len(words)), np.int32, len(words)) if words else np.zeros(0, np.int32)

    def energy(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums over the words: of all energy, and of that within the vocabulary."""
        known = ids >= 0
        within = np.where(known, self.idf[ids] ** 2, 0.0)
        return _running(np.where(known, within, self.foreign**2)), _running(within)

    def project(self, ids: np.ndarray) -> np.ndarray:
        """The latent vectors of windows, given as rows of word numbers (-1 has none)."""
        weights = np.where(ids >= 0, self.idf[ids], 0.0)
        return np.einsum("nw,nwk->nk", weights, self.vectors[np.maximum(ids, 0)])


def _running(v: np.ndarray) -> np.ndarray:
    return np.concatenate(([0.0], np.cumsum(v)))


def _count_words(batches: Iterator[pd.DataFrame], vocabulary: frozenset[str]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: Counter[str] = Counter()
        for text in batch["text"]:
            seen.update(vocabulary.intersection(words_of(text)))
        yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})


def _partial_gram(batches: Iterator[pd.DataFrame], idf: np.ndarray, basis: np.ndarray) -> Iterator[pd.DataFrame]:
    """The sum over the passages x of x (x' basis), one matrix a task."""
    total = np.zeros_like(basis)
    for batch in batches:
        for ids in batch["ids"]:
            w = idf[ids]
            np.add.at(total, ids, w[:, None] * (w @ basis[ids]))
    yield pd.DataFrame({"part": [total.tobytes()]})


def randomised_svd(passages: DataFrame, idf: np.ndarray, rank: int, seed: int = 0, tasks: int = 8) -> np.ndarray:
    """The leading right singular vectors (words x rank) of the TF-IDF matrix of ``passages`` (ids array<int>).

    The passages stay distributed: each round multiplies them with a thin basis, and one matrix of words x rank a task
    comes back to be summed and made orthonormal.
    """
    width = min(rank + OVERSAMPLE, len(idf))
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(idf), width)))[0]
    rows = passages.coalesce(tasks)

    def gram(b: np.ndarray) -> np.ndarray:
        parts = rows.mapInPandas(partial(_partial_gram, idf=idf, basis=b), "part binary").collect()
        return sum((np.frombuffer(p.part).reshape(b.shape) for p in parts), np.zeros_like(b))

    for _ in range(ROUNDS):
        basis = np.linalg.qr(gram(basis))[0]
    values, turn = np.linalg.eigh(basis.T @ gram(basis))
    return basis @ turn[:, np.argsort(values)[::-1][:rank]]


def fit(spark: SparkSession, docs: DataFrame, texts: list[str], width: int, step: int, rank: int = RANK) -> Space:
    """The space of the passages of ``texts``; the document frequencies are counted over all of ``docs``."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for t in texts for w in words_of(t)}))}
    n_docs = docs.count()
    counts = docs.select("text").mapInPandas(partial(_count_words, vocabulary=frozenset(vocabulary)), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    idf = np.full(len(vocabulary), np.log(1.0 + n_docs) + 1.0)
    for row in counts.collect():  # at most one row a word of the items
        idf[vocabulary[row.word]] = np.log((1.0 + n_docs) / (1.0 + row.n)) + 1.0
    passages = []
    for text in texts:
        ids = [vocabulary[w] for w in words_of(text)]
        passages += [(ids[s : s + width],) for s in _windows(len(ids), width, step).tolist()]
    vectors = randomised_svd(spark.createDataFrame(passages, "ids array<int>"), idf, rank)
    return Space(vocabulary, idf, float(np.log(1.0 + n_docs) + 1.0), vectors)


@dataclass
class Index:
    """The items' passages by the side of the hyperplanes on which their latent vectors lie."""

    space: Space
    planes: np.ndarray
    bit: np.ndarray
    least: float
    sides: np.ndarray
    ids: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, space: Space, items: list[tuple[int, str]], width: int) -> Index:
        ids, owners = [], []
        for item, text in items:
            w = space.ids(words_of(text))
            ids += [w[s : s + width] for s in range(len(w) - width + 1)]
            owners += [item] * max(0, len(w) - width + 1)
        rows = np.array(ids, dtype=np.int32).reshape(-1, width)
        planes = np.random.default_rng(1).standard_normal((space.vectors.shape[1], PLANES))
        bit = 1 << np.arange(PLANES, dtype=np.int64)
        latent = space.project(rows) if len(rows) else np.zeros((0, space.vectors.shape[1]))
        share = (latent**2).sum(1) / np.maximum((space.idf[rows] ** 2).sum(1), 1e-12) if len(rows) else np.zeros(0)
        sides = ((latent @ planes) > 0) @ bit
        order = np.argsort(sides, kind="stable")
        return cls(space, planes, bit, float(share.min(initial=1.0)), sides[order], rows[order], np.array(owners, dtype=np.int64)[order])


def _verbatim(batches: Iterator[pa.RecordBatch], index: Index, width: int, margin: float = 1e-6) -> Iterator[pa.RecordBatch]:
    """(item_id, doc_id) of each document's passages that equal one of an item.

    A passage equal to an item's has the energy share of that one, so passages below the least share of all items
    (``margin`` for rounding) are passed over; sides within the margin of a hyperplane are looked up on both.
    """
    space, reach = index.space, np.arange(width)
    for batch in batches:
        found: set[tuple[int, int]] = set()
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = space.ids(words_of(text))
            if len(ids) < width:
                continue
            energy, within = space.energy(ids)
            inside = (within[width:] - within[:-width]) >= (1 - margin) * (energy[width:] - energy[:-width])
            starts = np.flatnonzero(inside)
            if not len(starts):
                continue
            rows = ids[starts[:, None] + reach]
            latent = space.project(rows)
            share = (latent**2).sum(1) / (space.idf[rows] ** 2).sum(1)
            near = share >= index.least - margin
            rows, latent = rows[near], latent[near]
            heights = latent @ index.planes
            sides = (heights > 0) @ index.bit
            for row, side, height in zip(rows, sides, heights):
                unsure = index.bit[np.abs(height) < margin]
                for flip in range(1 << len(unsure)):
                    probe = side ^ sum(int(b) for j, b in enumerate(unsure) if flip >> j & 1)
                    lo, hi = np.searchsorted(index.sides, [probe, probe + 1])
                    for at in range(lo, hi):
                        if np.array_equal(index.ids[at], row):
                            found.add((int(index.items[at]), doc))
        pairs = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["item_id", "doc_id"])


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in lots of BLOCK_WORDS words at most, so that neither driver nor tasks hold more at once."""
    lot, size = [], 0
    for row in items.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct().toLocalIterator():
        lot.append((row[0], row[1]))
        size += len(words_of(row[1]))
        if size >= BLOCK_WORDS:
            yield lot
            lot, size = [], 0
    if size:
        yield lot


def _search(docs: DataFrame, items: DataFrame, width: int, step: int, task: Callable[[Space, list[tuple[int, str]]], Callable], schema: str) -> DataFrame:
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    out = spark.createDataFrame([], schema)
    for lot in _blocks(items):
        space = fit(spark, texts, [t for _, t in lot], width, step)
        out = out.unionByName(texts.mapInArrow(task(space, lot), schema))
    return out


def leaked_runs(docs: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """(item_id, doc_id), distinct: the document contains at least ``run`` consecutive words of the item.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored. Null texts and texts of fewer words
    leak nothing; repeated rows count once; empty tables give no row. Equal passages have equal latent vectors, so the
    search loses none of them: its recall is 1 but for rounding beyond the margin.
    """
    found = _search(docs, items, run, 1, lambda space, lot: partial(_verbatim, index=Index.of(space, lot, run), width=run), "item_id long, doc_id long")
    return found.distinct()


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that contain 12 consecutive words of an evaluation item, with that item."""
    return leaked_runs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common subsequence, by whole bit rows."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b.tolist():
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _paraphrases(batches: Iterator[pa.RecordBatch], space: Space, items: list[tuple[int, str]], width: int, step: int, cosine: float, kept: float) -> Iterator[pa.RecordBatch]:
    own, owners, answers = [], [], {}
    for item, text in items:
        w = words_of(text)
        ids = space.ids(w)
        answers[item] = {space.vocabulary[x] for x in w if any(c.isdigit() for c in x)}
        for s in _windows(len(ids), width, step).tolist():
            row = np.full(width, -1, np.int32)
            row[: len(ids[s : s + width])] = ids[s : s + width]
            own.append(row)
            owners.append(item)
    own_ids = np.array(own, dtype=np.int32).reshape(-1, width)
    own_latent = space.project(own_ids)
    own_latent /= np.maximum(np.linalg.norm(own_latent, axis=1, keepdims=True), 1e-12)
    for batch in batches:
        best: dict[tuple[int, int], tuple[int, float, int, int]] = {}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = space.ids(words_of(text))
            starts = _windows(len(ids), width, step)
            energy, within = space.energy(ids)
            ends = np.minimum(starts + width, len(ids))
            starts = starts[(within[ends] - within[starts]) >= cosine**2 * (energy[ends] - energy[starts])]
            if not len(starts):
                continue
            padded = np.concatenate((ids, np.full(width, -1, np.int32)))
            rows = padded[starts[:, None] + np.arange(width)]
            latent = space.project(rows)
            norm = np.linalg.norm(latent, axis=1)
            near = norm**2 >= cosine**2 * (energy[np.minimum(starts + width, len(ids))] - energy[starts])
            rows, latent = rows[near], latent[near] / np.maximum(norm[near], 1e-12)[:, None]
            likeness = latent @ own_latent.T
            for i, j in zip(*np.nonzero(likeness >= cosine)):
                a, b = own_ids[j], rows[i]
                a, b = a[a >= 0], b[b >= 0]
                length = common_subsequence(a, b)
                asked = answers[owners[j]] & set(a.tolist())
                sure = 2 * len(asked & set(b.tolist())) >= len(asked) if asked else length >= (1 + kept) / 2 * len(a)
                if length >= kept * len(a) and sure:
                    key = (owners[j], doc)
                    best[key] = max(best.get(key, (0, 0.0, 0, 0)), (length, round(float(likeness[i, j]), 4), len(asked & set(b.tolist())), len(asked)))
        rows_out = [(*k, *v) for k, v in sorted(best.items())]
        cols = list(zip(*rows_out)) if rows_out else [()] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["item_id", "doc_id", "common_words", "cosine", "answers_kept", "answers"])


def paraphrased(docs: DataFrame, items: DataFrame, width: int = 24, step: int = 6, cosine: float = 0.75, kept: float = 0.6) -> DataFrame:
    """(item_id, doc_id, common_words, cosine, answers_kept, answers): documents with a passage close to one of an item.

    Passages of ``width`` words whose latent cosine is at least ``cosine`` are compared by longest common subsequence;
    the best passage counts where it keeps the share ``kept`` of the item's passage and half of its answers: the numbers
    and codes of that passage. A passage without any must keep the middle between ``kept`` and the whole. Nulls, copies and empty tables as in ``leaked_runs``; a shorter text is one passage.
    """
    schema = "item_id long, doc_id long, common_words int, cosine double, answers_kept int, answers int"
    return _search(docs, items, width, step, lambda space, lot: partial(_paraphrases, space=space, items=lot, width=width, step=step, cosine=cosine, kept=kept), schema)


def p8_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with passages that stay close to an evaluation item though words differ."""
    found = materialize(paraphrased(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")), "p8-near")
    order = F.struct("common_words", "cosine", "answers_kept", "answers")
    best = found.groupBy("item_id", "doc_id").agg(F.max(order).alias("b"))
    return best.select("item_id", "doc_id", "b.common_words", "b.cosine", "b.answers_kept", "b.answers")
