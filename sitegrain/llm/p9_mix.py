"""Problem 9: mixing sources to target weights.

Subset-sum budget fitting. Documents are counted by source and exact token length; each source's budget is its share
of the largest total that every source with documents can fill within its repeats. Whole passes over a source come
first. Of the rest a like part of every length is taken, and for what then remains a bounded-knapsack dynamic programme
over the counts of all token lengths finds how many documents of each length reach the budget to the token. Which
documents of a length are drawn is up to a seeded order.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitegrain.sources.tables import materialize, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Steps of the seeded order at which the documents of one length are counted, so that none is ranked among all of its length.
STEPS = 4096
#: Tokens that are left to the dynamic programme after the longest documents have been taken greedily.
REST = 20_000


@lru_cache(2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    for batch in batches:
        counts = [len(encoder.encode_ordinary(t)) if t else 0 for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["doc_id", "source", "n_tokens"])


def token_lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens) of every document with text; the whole text is counted."""
    rows = docs.select(F.col("doc_id").cast("long"), "source", "text").where("text is not null")
    return rows.mapInArrow(partial(_count, path=tokenizer), "doc_id long, source string, n_tokens long")


def fit_lengths(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take (at most ``counts``), so that their sum is as near below ``budget`` as can be.

    All is taken where the budget is at least the whole sum. Else a like part of every length, then single documents
    from the longest down, leave about REST tokens; these are filled by dynamic programming over the counts left.
    """
    whole = sum(n * c for n, c in counts.items())
    if budget >= whole:
        return dict(counts)
    if budget <= 0:
        return {}
    part = max(0.0, (budget - REST) / whole)
    take = {n: int(c * part) for n, c in counts.items()}
    left = budget - sum(n * c for n, c in take.items())
    for n in sorted(counts, reverse=True):
        more = max(0, min(counts[n] - take[n], (left - REST) // n))
        take[n] += more
        left -= n * more
    # Reached sums are the bits of one number; each item (so many documents of a length) keeps the bits before it.
    full, items, history, reached = (1 << (left + 1)) - 1, [], [], 1
    for n in sorted(counts):
        free, k = min(counts[n] - take[n], left // n), 1
        while free > 0:
            k = min(k, free)
            items.append((n, k))
            history.append(reached)
            reached |= (reached << (n * k)) & full
            free -= k
            k *= 2
        if reached >> left & 1:
            break
    at = reached.bit_length() - 1
    for (n, k), before in zip(reversed(items), reversed(history)):
        if not before >> at & 1:
            take[n] += k
            at -= n * k
    return {n: c for n, c in take.items() if c}


@dataclass
class Part:
    """What is drawn of one source: every document ``passes`` times, and once more documents of ``rest`` tokens in all."""

    source: str
    share: float
    repeats: int
    tokens: int = 0
    budget: int = 0
    passes: int = 0
    rest: int = 0


def _targets(targets: DataFrame) -> list[Part]:
    rows = targets.where("source is not null and target_share > 0").groupBy("source").agg(F.sum("target_share").alias("share"), F.coalesce(F.min("max_repeats"), F.lit(0)).alias("repeats"))
    return [Part(r.source, float(r.share), max(0, int(r.repeats))) for r in rows.orderBy("source").collect()]  # one row a target


def _by_source(parts: list[Part], value) -> Column:
    out = F.lit(None).cast("long")
    for p in parts:
        out = F.when(F.col("source") == p.source, F.lit(value(p)).cast("long")).otherwise(out)
    return out


def _first(sized: DataFrame, counts: DataFrame) -> DataFrame:
    """The first ``take`` documents of each source and length in the seeded order; ranks are found within single steps of it."""
    cell = ["source", "n_tokens", "step"]
    stepped = sized.withColumn("step", F.expr(f"turn div {(1 << 40) // STEPS}"))
    before = F.sum("n").over(Window.partitionBy("source", "n_tokens").orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    cells = stepped.groupBy(*cell).agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    room = cells.join(counts, ["source", "n_tokens"]).select(*cell, (F.col("take") - F.col("before")).alias("room")).where("room > 0")
    order = Window.partitionBy(*cell).orderBy("turn", "doc_id")
    return stepped.join(room, cell).withColumn("k", F.row_number().over(order)).where("k <= room")


def draw(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER) -> tuple[DataFrame, list[Part]]:
    """((doc_id, source, n_tokens, repeats) of each drawn document, the budget of each source).

    ``docs``: doc_id, source, text; ``targets``: source, target_share, max_repeats (rows of one source add up, with the
    lowest cap). Without ``total_tokens`` the total is the largest at which every source that has documents can fill its
    share; with it, a source that is too small gives all it has. Documents of null or other sources, and texts that are
    null or without tokens, are not drawn; rows repeated under one doc_id are documents of their own; a target without
    documents gives nothing, and the shares of the others stay in proportion; empty tables give no row.
    """
    parts = _targets(targets)
    names = [p.source for p in parts]
    sized = token_lengths(docs.where(F.col("source").isin(names)), tokenizer).where("n_tokens > 0")
    sized = materialize(sized.withColumn("turn", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40))), "p9-sized")
    lengths: dict[str, dict[int, int]] = {p.source: {} for p in parts}
    for r in sized.groupBy("source", "n_tokens").count().collect():  # all lengths of a target: at most the root of twice its tokens
        lengths[r.source][r.n_tokens] = r["count"]
    for p in parts:
        p.tokens = sum(n * c for n, c in lengths[p.source].items())
    able = [p for p in parts if p.tokens and p.repeats]
    total = total_tokens if total_tokens is not None else min((p.tokens * p.repeats / p.share for p in able), default=0)
    for p in able:
        p.budget = min(round(total * p.share), p.tokens * p.repeats)
        p.passes, p.rest = divmod(p.budget, p.tokens)
    wanted = [(p.source, n, c) for p in able for n, c in fit_lengths(lengths[p.source], p.rest).items()]
    counts = docs.sparkSession.createDataFrame(wanted, "source string, n_tokens long, take long")
    extra = _first(sized, counts)
    passes = _by_source(able, lambda p: p.passes)
    columns = ["doc_id", "source", "n_tokens", "turn"]
    once = extra.select(*columns).withColumn("add", F.lit(1))
    whole = sized.where(passes > 0).select(*columns).withColumn("add", passes)
    drawn = whole.unionByName(once).groupBy("doc_id", "source", "n_tokens").agg(F.sum("add").alias("repeats"))
    return drawn, parts


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn documents with their repeats."""
    return draw(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each target with the documents and tokens drawn and the share reached; a target without documents has 0."""
    drawn, parts = draw(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "mix_targets"))
    asked = spark.createDataFrame([(p.source, p.share, p.repeats, p.budget) for p in parts], "source string, target_share double, max_repeats int, budget long")
    sums = drawn.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("repeats").alias("n_records"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("n_tokens"))
    out = asked.join(sums, "source", "left").na.fill(0, ["n_docs", "n_records", "n_tokens"])
    total = F.sum("n_tokens").over(Window.partitionBy(F.lit(1)))  # one row a target
    return out.withColumn("reached_share", F.when(total > 0, F.col("n_tokens") / total).otherwise(0.0))
