"""Problem 10: long exact spans shared between records.

Level-wise doubling. At the first level a text's windows of half the wanted length are hashed and, of each run of
windows that a span of the full length must contain, the one with the least hash is taken (so a span of the full
length is known by its own content, wherever it stands). Only windows repeated in another record are extended to the
full length: first as blocks of neighbouring full windows, then window by window where a block's members differ.
Whoever survives at the full length shares a span; spans of any greater length are runs of such windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.sources.tables import materialize, table

SPAN = 200
#: Characters hashed at once by one Python worker; a longer text is cut into overlapping pieces, none of it is left out.
PIECE = 1 << 20
#: Neighbouring full windows that are first tried together.
BLOCK = 16
ANCHOR = "doc_id long, pos int, first int, n int, base long"
BLOCKS = "doc_id long, pos int, first int, n int, core binary, whole binary, start int, stop int"
SINGLES = "key binary, doc_id long, start int, stop int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _join(a: np.ndarray, n: int, b: np.ndarray) -> np.ndarray:
    """Hashes of the windows of ``a`` (n long), each with the window of ``b`` that follows it."""
    m = max(0, len(b) - n)
    return _mix(a[:m] * np.uint64(0xD6E8FEB86659FD93) + b[n : n + m])


def window_hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """The hash of every window of ``n`` characters, by doubling."""
    power, k, out, done = _mix(chars), 1, None, 0
    while True:
        if n & k:
            out, done = (power, k) if out is None else (_join(out, done, power), done + k)
        if 2 * k > n:
            return out
        power = _join(power, k, power)
        k *= 2


def _least(v: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours."""
    k = 1
    while 2 * k <= w:
        v = np.minimum(v[:-k], v[k:])
        k *= 2
    return np.minimum(v[: len(v) - (w - k)], v[w - k :]) if w > k else v


def _pieces(docs: list[int], texts: list[str], span: int) -> Iterator[list[tuple[int, int, str]]]:
    """(doc, offset, text) in lots of about PIECE characters; the pieces of a long text overlap by span - 1."""
    lot, size = [], 0
    for doc, text in zip(docs, texts):
        for at in range(0, len(text) - span + 1, PIECE):
            part = text[at : at + PIECE + span - 1]
            lot.append((doc, at, part))
            size += len(part)
            if size >= PIECE:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _anchors(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    half = span // 2
    for batch in batches:
        for lot in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), span):
            chars = np.frombuffer("".join(t for _, _, t in lot).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            lens = np.array([len(t) for _, _, t in lot])
            ends = np.cumsum(lens)
            h = window_hashes(chars, half)
            # The low bits hold the place: of equal hashes the first one counts.
            bits = np.uint64(max(1, int(len(h)).bit_length()))
            low = np.uint64((1 << int(bits)) - 1)
            least = _least((h & ~low) | np.arange(len(h), dtype=np.uint64), span - half + 1)
            start = np.concatenate([np.arange(e - n, e - span + 1) for e, n in zip(ends, lens)])
            place = (least[start] & low).astype(np.int64)
            turn = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(start) != 1))))
            count = np.diff(np.append(turn, len(start)))
            owner = np.searchsorted(ends, start[turn], side="right")
            shift = np.array([at for _, at, _ in lot])[owner] - (ends - lens)[owner]
            ids = np.array([d for d, _, _ in lot], dtype=np.int64)[owner]
            cols = [ids, (place[turn] + shift).astype(np.int32), (start[turn] + shift).astype(np.int32), count.astype(np.int32), h[place[turn]].view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "pos", "first", "n", "base"])


def _lots(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    lot = []
    for row in rows:
        lot.append(row)
        if len(lot) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lot), types)], names)
            lot = []
    if lot:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lot), types)], names)


def _blocks(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Each anchor's full windows in blocks by their distance from it: the part all of a block share, and its whole reach."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for doc, text, zones in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for z in zones:
                    pos, first, n = z["pos"], z["first"], z["n"]
                    for k in range((pos - first - n + 1) // BLOCK, (pos - first) // BLOCK + 1):
                        near, far = pos - k * BLOCK, pos - k * BLOCK - BLOCK + 1  # first and last start of the block
                        lo, hi = max(first, far), min(first + n - 1, near)
                        core = text[near : far + span]
                        a, b = max(0, far), min(len(text), near + span)
                        whole = f"{a - far},{near + span - b}," + text[a:b]
                        yield doc, pos, lo, hi - lo + 1, _key(core), _key(whole), a, b

    return _lots(rows(), ["doc_id", "pos", "first", "n", "core", "whole", "start", "stop"], [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32()])


def _singles(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for doc, text, zones in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for z in zones:
                    for s in range(z["first"], z["first"] + z["n"]):
                        yield _key(text[s : s + span]), doc, s, s + span

    return _lots(rows(), ["key", "doc_id", "start", "stop"], [pa.binary(), pa.int64(), pa.int32(), pa.int32()])


def _key(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _repeated(rows: DataFrame, key: str, *more) -> DataFrame:
    """The keys that stand in two documents or more; only one row a key leaves each map task, so hot keys stay small."""
    return rows.groupBy(key).agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"), *more).where("_lo <> _hi").drop("_lo", "_hi")


def shared_windows(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(key binary, doc_id, start, stop): rows of one key hold the same text there, at least ``span`` characters of it.

    ``docs``: doc_id, text; other columns are ignored. Every pair of documents with a common stretch of ``span``
    characters meets in at least one key, and every window of a document that recurs in another one is covered.
    Null texts and texts under ``span`` characters share nothing; a text that repeats itself is no hit alone; rows
    that are repeated under one doc_id count once; an empty table gives no row.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text").where(F.length("text") >= span)
    anchors = materialize(texts.mapInArrow(partial(_anchors, span=span), ANCHOR), "p10-anchors")
    alive = anchors.join(_repeated(anchors, "base"), "base", "left_semi")
    zones = alive.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "first", "n")).alias("zones"))
    live = materialize(texts.join(zones, "doc_id"), "p10-live")
    blocks = materialize(live.mapInArrow(partial(_blocks, span=span), BLOCKS), "p10-blocks")
    classes = _repeated(blocks, "core", (F.min("whole") == F.max("whole")).alias("settled"))
    judged = materialize(blocks.drop("whole").join(classes, "core"), "p10-judged")
    settled = judged.where("settled").select(F.col("core").alias("key"), "doc_id", "start", "stop")
    unsettled = judged.where("not settled").groupBy("doc_id").agg(F.collect_set(F.struct("first", "n")).alias("zones"))
    singles = live.select("doc_id", "text").join(unsettled, "doc_id").mapInArrow(partial(_singles, span=span), SINGLES)
    singles = materialize(singles, "p10-singles")
    return settled.unionByName(singles.join(_repeated(singles, "key"), "key", "left_semi"))


def pairs_of(members: DataFrame) -> DataFrame:
    """The distinct pairs (doc_a < doc_b) of documents that meet in a key of ``members`` (key, doc_id).

    Keys with the same documents are first reduced to one by a sum of hashes, so a long common stretch costs one key.
    """
    rows = materialize(members.select("key", "doc_id").distinct(), "p10-members")
    sums = [F.sum(F.xxhash64("doc_id", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in (1, 2)]
    sets = rows.groupBy("key").agg(F.count("*").alias("n"), *sums).groupBy("n", "s1", "s2").agg(F.min("key").alias("key"))
    kept = rows.join(sets.select("key"), "key", "left_semi")
    a, b = kept.select("key", F.col("doc_id").alias("doc_a")), kept.select("key", F.col("doc_id").alias("doc_b"))
    return a.join(b, "key").where("doc_a < doc_b").select("doc_a", "doc_b").distinct()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents with a common stretch of at least 200 characters."""
    return pairs_of(shared_windows(table(spark, sf_dir, "documents")))


def shared_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, start, stop): the maximal stretches of each document of which every ``span`` characters recur elsewhere."""
    ranges = shared_windows(docs, span).select("doc_id", "start", "stop").distinct()
    spans = ranges.selectExpr("doc_id", "start", "stop", "coalesce(max(stop) over (partition by doc_id order by start, stop rows between unbounded preceding and 1 preceding) < start, true) as opens")
    runs = spans.selectExpr("doc_id", "start", "stop", "sum(int(opens)) over (partition by doc_id order by start, stop rows unbounded preceding) as run")
    return runs.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its length, the characters of it that are shared elsewhere, their number of stretches and their share."""
    docs = table(spark, sf_dir, "documents")
    held = shared_spans(docs).groupBy("doc_id").agg(F.sum(F.col("stop") - F.col("start")).alias("shared_chars"), F.count("*").alias("n_spans"))
    chars = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    out = chars.join(held, "doc_id", "left").na.fill(0, ["shared_chars", "n_spans"])
    return out.withColumn("share", F.round(F.col("shared_chars") / F.greatest("chars", F.lit(1)), 6))
