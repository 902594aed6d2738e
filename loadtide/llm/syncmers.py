"""Document fingerprints from closed syncmers.

A text is cut into pieces: its words, long ones in parts of four code points. Of the k-mers of
pieces those are anchors whose smallest piece (by hash) stands first or last in them. Whether a k-mer is
an anchor depends on nothing outside it, so two texts that share a passage share its anchors, wherever it
stands. The fingerprint holds the smallest anchor hashes; likeness is the Dice coefficient of two
fingerprints' anchor sets, estimated from the part of both that is known whole.

Null texts count as empty. Texts without anchors among their k-mers take all k-mers; the start of a text is
filled up, so that short texts have k-mers too. Only texts of white space have empty fingerprints, which are
alike among each other and unlike any other. Extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.sources.scratch import fresh_path

from .registry import partitions, query, table
from .text import let, text_of, upto

PIECE = "[^\\x20\\x09-\\x0D]{1,4}"
MASK = 0xFFFFFFFF
NULL_ID = -(1 << 63)


def _anchor_hashes(text: Column, k: int) -> Column:
    """(hash at its place) for each k-mer of pieces: 32-bit anchor hash, or null where the k-mer is no anchor."""
    hashed = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p))

    def chosen(m: Column) -> Column:
        at = lambda i, j: F.get(m, i + j)
        kmer = lambda i: F.xxhash64(*[at(i, j) for j in range(k)]).bitwiseAND(F.lit(MASK))
        edge = lambda i: F.least(at(i, 0), at(i, k - 1)) <= F.least(*[at(i, j) for j in range(1, k - 1)])
        n = F.size(m) - (k - 1)
        anchors = F.transform(F.filter(upto(n), edge), kmer)
        return let(anchors, lambda a: F.when((F.size(a) == 0) & (n > 0), F.transform(upto(n), kmer)).otherwise(a))

    return let(hashed, lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(
        let(F.concat(F.array_repeat(F.lit(k).cast("bigint"), k - 1), h), chosen)))


def sketch(text: Column, k: int = 5, size: int = 128) -> Column:
    """The `size` smallest distinct anchor hashes in ascending order."""
    return F.slice(F.sort_array(F.array_distinct(_anchor_hashes(text, k))), 1, size)


def likeness(a: Column, b: Column, size: int = 128) -> Column:
    """Dice coefficient (0 to 1) of two texts' anchor sets from their sketches."""
    def compare(s: Column) -> Column:
        limit = F.least(F.when(F.size(s["a"]) == size, F.get(s["a"], F.lit(size - 1))),
                        F.when(F.size(s["b"]) == size, F.get(s["b"], F.lit(size - 1))))
        known = lambda x: F.filter(x, lambda v: limit.isNull() | (v <= limit))
        return let(F.struct(known(s["a"]).alias("a"), known(s["b"]).alias("b")), lambda t: F.when(
            F.size(t["a"]) + F.size(t["b"]) == 0, F.lit(1.0)).otherwise(
            2.0 * F.size(F.array_intersect(t["a"], t["b"])) / (F.size(t["a"]) + F.size(t["b"]))))

    return let(F.struct(a.alias("a"), b.alias("b")), compare)


def written(s: Column) -> Column:
    """The sketch as text, eight hex digits for each anchor."""
    return F.array_join(F.transform(s, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def anchors(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, anchor): all distinct anchors of every text, for matching passages by an equi-join."""
    return docs.select("doc_id", F.explode(F.array_distinct(_anchor_hashes(text_of("text"), k))).alias("anchor"))


def next_ids(docs: DataFrame) -> DataFrame:
    """(id, next_id, next_h): for every distinct id the next smaller one, for the smallest the largest.

    `next_h` is the smallest text hash of the rows with that id. Null ids come last, as one id. Ids
    are dealt out by ranges and numbered inside them; only a row per range is sorted in one task.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("h")).groupBy("id").agg(F.min("h").alias("h"))
    path = fresh_path(spark, "ids")  # the ranges have to be the same for both readers
    (ids.repartitionByRange(partitions(spark), F.desc("id")).withColumn("part", F.spark_partition_id())).write.parquet(path)
    ranged = spark.read.schema("id bigint, h bigint, part int").parquet(path)
    first = ranged.groupBy("part").agg(F.max_by(F.struct("id", "h"), "id").alias("first"))
    after = first.selectExpr("part", "coalesce(lead(first) OVER (ORDER BY part), first(first) OVER (ORDER BY part)) AS after")
    inside = ranged.selectExpr("id", "part", "lead(struct(id, h)) OVER (PARTITION BY part ORDER BY id DESC) AS inner_next")
    return inside.join(after, "part").select("id", F.coalesce("inner_next", "after").alias("n")).select(
        "id", F.col("n.id").alias("next_id"), F.col("n.h").alias("next_h"))


def compare_with_edited(docs: DataFrame, k: int = 5, size: int = 128) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text has the last third of its code points replaced by as many of the next text's first ones
    (or all it has). Rows with the same id have the same next text; where the next id has several rows, the
    one whose text has the smallest hash counts. Whole texts are shuffled once, by id and text hash; of the next
    text only the part needed travels.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("h"),
                       text_of("text").alias("text"), sketch(text_of("text"), k, size).cast("array<bigint>").alias("s"))
    wants = (docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("h"),
                         F.floor(F.length(text_of("text")) / 3).cast("int").alias("k")).distinct()
             .join(next_ids(docs), "id").withColumnsRenamed({"id": "by_id", "h": "by_h", "next_id": "id", "next_h": "h"}))
    given = (rows.join(wants.hint("merge"), ["id", "h"])
             .select(F.col("by_id").alias("id"), F.col("by_h").alias("h"), F.expr("substring(text, 1, k)").alias("head"),
                     F.col("s").alias("next_s"), "k").dropDuplicates(["id", "h"]))
    both = rows.join(given.hint("merge"), ["id", "h"], "left")
    edited = F.concat(F.expr("substring(text, 1, length(text) - k)"), F.col("head"))
    done = both.select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), "text", "s", "next_s", edited.alias("edited")).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "s", "next_s", sketch(F.col("edited"), k, size).alias("e"))
    return done.select("doc_id", "n_chars", "edited_sha256", written(F.col("s")).alias("fingerprint"),
                       written(F.col("e")).alias("edited_fingerprint"), likeness(F.col("s"), F.col("e"), size).alias("near_edited"),
                       likeness(F.col("s"), F.col("next_s"), size).alias("near_next"))


@query("op2_fingerprints")
def op2_fingerprints(spark, sf_dir):
    """Fingerprints of all texts and of their edited forms."""
    return compare_with_edited(table(spark, sf_dir, "documents"))
