"""Mixing sources to target weights.

Texts are packed, source by source, into blocks of a fixed number of words. Every output shard
draws how many of its slots go to each source; the slots of a source are mapped through a
pseudorandom permutation of its block numbers, one permutation per pass over the source; blocks
are then joined to slots by number.

Null texts and texts without words have size 0 and are never taken. A null source is a source of
its own, after all others. Rows that repeat count as often as they stand there. Other columns are
ignored. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import partitions, query, stored, table
from .text import permuted_index, text_of, word_count


class Mixture(NamedTuple):
    """documents: (doc_id, source, h, size, source_size, target, copies, taken), a row per input row.
    slots: (shard, slot, source_no, block), the blocks of every output shard.
    pieces: (source_no, block, off, words), the parts of documents in each block; `off` names the document.
    """

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def targets(sizes: Sequence[int], weights: Sequence[int], share: float, cap: float) -> list[float]:
    """Shares of `share` x all sizes by weight; no target above `cap` x its size, the excess shared anew by weight."""
    left, out = share * sum(sizes), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        unit = left / sum(weights[i % len(weights)] for i in free)
        over = {i for i in free if unit * weights[i % len(weights)] > cap * sizes[i]}
        for i in over or free:
            out[i] = float(cap * sizes[i]) if over else unit * weights[i % len(weights)]
        if not over:
            break
        left -= sum(out[i] for i in sorted(over))
        free -= over
    return out


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block_words: int = 64,
        shard_slots: int = 1 << 14, seed: str = "mix", max_sources: int = 10_000) -> Mixture:
    """Mix all documents (doc_id, text, source).

    Sources are a short list by nature (their weights are settings): more than `max_sources` raise
    an error. Only their sizes reach the driver. A hot source is split: its documents are ordered
    inside hashed buckets, and blocks and slots are joined by block number.

    Each shard's counts are drawn with one random start and equal steps through the cumulative
    weights (a systematic multinomial draw), so that totals stay within a slot per shard of their
    targets. No block is taken more than ceil(cap) times.
    """
    spark = docs.sparkSession
    base = stored(docs.select(F.col("doc_id"), F.col("source"), word_count(text_of("text")).alias("size"),
                              F.xxhash64(F.lit(seed), "doc_id", "text", "source").alias("h")), "mix-sizes")
    per_source = base.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(max_sources + 1).collect()
    if len(per_source) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    per_source.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["size"] for r in per_source], weights, share, cap)
    blocks = [-(-r["size"] // block_words) for r in per_source]
    sources = F.broadcast(spark.createDataFrame(
        [(i, r["source"], r["size"], goal[i], min(1_000_000, 1 + r["n"] // 500)) for i, r in enumerate(per_source)],
        "source_no int, source string, source_size bigint, target double, buckets int"))
    keyed = (base.join(sources, base["source"].eqNullSafe(sources["source"]))
             .select(base["*"], "source_no", "source_size", "target", F.pmod("h", "buckets").alias("bucket")))
    starts = keyed.groupBy("source_no", "bucket").agg(F.sum("size").alias("size")).selectExpr(
        "source_no", "bucket", "sum(size) OVER (PARTITION BY source_no ORDER BY bucket) - size AS base")
    placed = stored(
        keyed.selectExpr("*", "sum(size) OVER (PARTITION BY source_no, bucket ORDER BY h, doc_id "
                         "ROWS UNBOUNDED PRECEDING) - size AS within")
        .join(starts, ["source_no", "bucket"]).withColumn("off", F.col("base") + F.col("within")).drop("base", "within", "bucket"),
        "mix-placed")
    pieces = (placed.where("size > 0")
              .selectExpr("source_no", "off", "size",
                          f"explode(sequence(off div {block_words}, (off + size - 1) div {block_words})) AS block")
              .selectExpr("source_no", "block", "off",
                          f"least(off + size, (block + 1) * {block_words}) - greatest(off, block * {block_words}) AS words"))
    slots = _slots(spark, goal, blocks, cap, block_words, shard_slots, seed)
    taken = (slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
             .join(pieces.hint("merge"), ["source_no", "block"])
             .groupBy("source_no", "off").agg(
                 F.sum(F.col("words") * F.col("times")).alias("taken"),
                 F.max(F.when(F.col("block") == F.expr(f"off div {block_words}"), F.col("times"))).alias("copies")))
    documents = (placed.join(taken.hint("merge"), ["source_no", "off"], "left")
                 .select("doc_id", "source", "h", "size", "source_size", "target",
                         F.when(F.col("size") > 0, F.coalesce("copies", F.lit(0))).otherwise(F.lit(0)).alias("copies"),
                         F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken")))
    return Mixture(documents, slots, pieces)


def _slots(spark, goal: list[float], blocks: list[int], cap: float, block_words: int, shard_slots: int, seed: str) -> DataFrame:
    """(shard, slot, source_no, block): which block fills each slot of each shard."""
    wanted = [g / block_words for g in goal]
    total = round(sum(wanted))
    bounds, run = [0.0], 0.0
    for w in wanted:
        run += w
        bounds.append(run / sum(wanted) if sum(wanted) else 0.0)
    if bounds:
        bounds[-1] = 1.0
    if not total:
        return spark.createDataFrame([], "shard bigint, slot bigint, source_no int, block bigint")
    rows = [(i, bounds[i], bounds[i + 1], n) for i, n in enumerate(blocks) if n > 0 and wanted[i] > 0]
    plan = F.array(*[F.struct(F.lit(i).alias("source_no"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                              F.lit(n).cast("bigint").alias("n")) for i, low, high, n in rows])
    most = -(-int(cap * 1000) // 1000)
    shards = (spark.range(-(-total // shard_slots)).withColumnRenamed("id", "shard")
              .withColumn("n_slots", F.least(F.lit(shard_slots), F.lit(total) - F.col("shard") * shard_slots))
              .withColumn("start", F.pmod(F.xxhash64(F.lit(seed), "shard"), F.lit(1 << 30)) / float(1 << 30)))
    drawn = (shards.select("*", F.inline(plan))
             .withColumn("drawn", (F.floor(F.col("n_slots") * F.col("high") + F.col("start"))
                                   - F.floor(F.col("n_slots") * F.col("low") + F.col("start"))).cast("bigint")))
    counted = drawn.selectExpr("*", "sum(drawn) OVER (PARTITION BY source_no ORDER BY shard) - drawn AS first").selectExpr(
        "*", f"least(first + drawn, {most} * n) AS stop").where("stop > first")
    # few rows that each become many: dealt out by number, so that they aren't put together again
    numbered = counted.repartition(4 * partitions(spark), "shard", "source_no").select("shard", "source_no", "n", F.explode(F.sequence("first", F.col("stop") - 1)).alias("slot"))
    block = permuted_index(F.col("slot") % F.col("n"), F.col("n"), lambda half, i: F.xxhash64(
        F.lit(seed), F.col("source_no"), F.floor(F.col("slot") / F.col("n")), i, half))
    return numbered.select("shard", "slot", "source_no", block.alias("block"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as whole documents with all their columns: each as often as the block that holds its first word is taken.

    Rows equal in id, text and source are repeated alike.
    """
    seed = settings.get("seed", "mix")
    copies = mix(docs, **settings).documents.where("copies > 0").groupBy("h").agg(F.max("copies").alias("copies"))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.lit(seed), "doc_id", "text", "source").alias("h"))
    return (keyed.join(copies, "h").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns))


@query("op9_mixing")
def op9_mixing(spark, sf_dir):
    """Words taken from every document when all sources are mixed 5 : 2 : 1 : 5 : ... to 150 % of their size."""
    return mix(table(spark, sf_dir, "documents")).documents.select("doc_id", "size", "source_size", "target", "taken")
