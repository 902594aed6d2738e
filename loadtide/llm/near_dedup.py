"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification, connected components.

1. Each text becomes its set of distinct five-word shingles (64-bit hashes), a MinHash signature and
   band keys. Texts with the same set are one class from here on.
2. Classes that share a band key are candidates. They are not all paired: in every bucket each class is compared with one
   hub, and classes that turn out linked are joined to a component. After some such rounds, with another hub each, only
   classes of different components are still paired; pairs inside a component could change nothing. Buckets of up to
   `small` classes are paired whole. The classes of larger ones (say, thousands of variants of a text, many of which aren't
   similar enough) are paired where their rarest shingles meet: two sets that reach the threshold share a shingle among
   the first few of each, in any common order, and enough must follow (prefix and position filter), so no link is lost.
3. A pair's signatures are compared batch by batch. The pair is dropped as soon as the posterior chance (uniform
   prior) that its similarity reaches the threshold falls below `miss`. Survivors are verified on their whole sets.
4. Links are contracted to components by repeated minimum labels, in Spark.

Band width follows from the threshold, such that a pair at the threshold is no candidate with a chance below 5e-6.

ASCII letters count as lower case, words are runs of other characters than ASCII white space. A text with fewer words than a
shingle has its whole word sequence as one shingle; null texts and texts without words have none and are linked with
nothing. Null ids never name a group unless all of a group's are null. Rows that repeat are members like others. Other
columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import claim, query, ship, stored, table
from .text import text_of

NULL_ID = -(1 << 63)
BANDS = 32
BATCH = 32


class Words(dict):
    """64-bit hash of each word, computed on first use; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 300_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for j in range(n):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - n + 1 + j])
    return np.unique(h)


def rows_per_band(threshold: float, bands: int = BANDS, miss: float = 5e-6) -> int:
    """The widest band with which a pair at the threshold is still found."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold ** r) ** bands <= miss)


_FACTORS = np.random.default_rng(20240501).integers(0, 1 << 32, (16 * BANDS, 2), np.uint32)


def _signature(s: np.ndarray, first: int, n: int) -> np.ndarray:
    """Hash functions first ... first+n-1 of a MinHash signature."""
    f = _FACTORS[first:first + n]
    a, b = f[:, :1] | np.uint32(1), f[:, 1:]
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):  # stays in the cache
        np.minimum(out, (a * x[None, at:at + 2048] + b).min(axis=1), out=out)
    return out


def least_matches(threshold: float, hashes: int, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n hashes a pair with fewer than m matches reaches the threshold with a chance below `miss`.

    Under a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1).
    """
    def tail(m: int, n: int) -> float:
        return sum(math.comb(n + 1, j) * threshold ** j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))

    return [(n, next(m for m in range(n + 2) if m > n or tail(m, n) >= miss)) for n in range(BATCH, hashes + 1, BATCH)]


def signatures(docs: DataFrame, threshold: float, size: int = 5) -> DataFrame:
    """(doc_id, h, n, key, bands): text hash, size of the set, digest of the set (null: none), keys of its bands."""
    width = rows_per_band(threshold)
    ship(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        claim("near_dedup")
        for batch in batches:
            counts, keys, bands = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, size)
                counts.append(len(s))
                if len(s):
                    keys.append(hashlib.md5(s.tobytes()).digest())
                    sig = _signature(s, 0, BANDS * width).reshape(BANDS, width).astype(np.uint64)
                    h = np.arange(BANDS, dtype=np.uint64)
                    for j in range(width):
                        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, j])
                    bands.append(h.view(np.int64))
                else:
                    keys.append(None)
                    bands.append(np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, bands)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands) if bands else [], pa.int64()))],
                names=["doc_id", "h", "n", "key", "bands"])
        _words.clear()  # nothing stays between tasks

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(
        run, "doc_id long, h long, n long, key binary, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, size: int = 5, miss: float = 1e-6) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold; `texts` has (key, text)."""
    hashes = BANDS * rows_per_band(threshold) // BATCH * BATCH
    steps, num, den = least_matches(threshold, hashes, miss), round(threshold * 1000), 1000

    def run(batches):
        import pyarrow as pa

        kept: OrderedDict = OrderedDict()  # sets and signatures of the last texts seen

        def known(key: bytes, text: str) -> list:
            if key in kept:
                kept.move_to_end(key)
            else:
                kept[key] = [shingles(text, size), np.empty(0, np.uint32)]
                if len(kept) > 64:
                    kept.popitem(last=False)
            return kept[key]

        def linked(x: list, y: list) -> bool:
            same = 0
            for n, least in steps:
                for z in (x, y):
                    if len(z[1]) < n:
                        z[1] = np.concatenate([z[1], _signature(z[0], len(z[1]), n - len(z[1]))])
                same += int((x[1][n - BATCH:n] == y[1][n - BATCH:n]).sum())
                if same < least:
                    return False
            both = len(np.intersect1d(x[0], y[0], assume_unique=True))
            return den * both >= num * (len(x[0]) + len(y[0]) - both)

        for batch in batches:
            a, b, s, t = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            yes = [linked(known(a[i], s[i]), known(b[i], t[i])) for i in range(len(a))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(yes, pa.bool_())], names=["a", "b", "linked"])

    both = (pairs.join(texts.withColumnsRenamed({"key": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"key": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b"))
    return both.mapInArrow(run, "a binary, b binary, linked boolean").where("linked").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the label is the same within a component and differs between them.

    Every round points each node to its smallest neighbour (or itself) and contracts the links; a round at least halves the nodes
    that are left in a component. Tables are written between rounds.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    label = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("up")), "parents")
        edges = stored(edges.join(parent.withColumnsRenamed({"node": "a", "up": "pa"}), "a").join(
            parent.withColumnsRenamed({"node": "b", "up": "pb"}), "b").where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        label = parent.withColumnRenamed("up", "label") if label is None else stored(
            label.join(parent.withColumnsRenamed({"node": "label", "up": "next"}), "label", "left")
            .select("node", F.coalesce("next", "label").alias("label")), "labels")
    return links.sparkSession.createDataFrame([], "node binary, label binary") if label is None else label


def _by_rare_shingles(nodes: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """Pairs (a, b) of nodes (key, n, label, least) of different labels whose prefixes share a shingle.

    `least` is the smallest set size of a possible partner. Shingles are ordered by the number of nodes that have
    them. Those of one node only come first and meet nothing, so only their number counts.
    """
    ship(nodes.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                s = shingles(text, size).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(s), pa.binary()), pa.array(s)], names=["key", "s"])

    held = stored(texts.join(nodes.select("key"), "key", "left_semi").mapInArrow(run, "key binary, s long"), "shingles")
    common = held.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = held.join(common, "s").selectExpr("key", "s", "row_number() OVER (PARTITION BY key ORDER BY df, s) AS place",
                                               "count(*) OVER (PARTITION BY key) AS n_common")
    length = F.col("n") - F.ceil(threshold / (1 + threshold) * (F.col("n") + F.col("least")) - 1e-9) + 1
    first = stored(ranked.join(nodes, "key").where(F.col("place") <= length - (F.col("n") - F.col("n_common")))
                   .select("s", "key", "n", "label", (F.col("n") - F.col("n_common") + F.col("place")).alias("place")), "prefixes")
    meeting = first.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("s")
    left = first.join(meeting, "s", "left_semi")
    right = left.select("s", F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("label").alias("label2"), F.col("place").alias("place2"))
    overlap = F.ceil(threshold / (1 + threshold) * (F.col("n") + F.col("n2")) - 1e-9)  # of two sets that reach the threshold
    possible = 1 + F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))  # if this is the first shingle they share
    return (left.join(right, "s").where((F.col("key") < F.col("key2")) & (F.col("label") != F.col("label2")) & (possible >= overlap)
                                        & (F.least("n", "n2") >= threshold * F.greatest("n", "n2") - 1e-9))
            .select(F.col("key").alias("a"), F.col("key2").alias("b")))


def groups(docs: DataFrame, threshold: float = 0.8, size: int = 5, miss: float = 1e-6, hub_rounds: int = 2, small: int = 16) -> DataFrame:
    """(doc_id, h, n, label): every row with its text's hash, size of its set, and its component's label (null: no set)."""
    members = stored(signatures(docs, threshold, size), "members")
    classes = stored(members.where("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "h")).alias("one"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes")
    entries = classes.select("key", "n", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    buckets = stored(entries.join(shared, "bucket", "left_semi"), "buckets")
    wanted = classes.join(buckets.select("key").distinct(), "key", "left_semi").select("key", "one.*")
    texts = stored(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64("text").alias("h"), text_of("text").alias("text"))
                   .join(wanted, ["id", "h"]).select("key", "text").dropDuplicates(["key"]), "texts")
    label, tested = None, None
    for step in range(hub_rounds + 1):
        now = buckets.withColumn("label", F.col("key")) if label is None else (
            buckets.join(label.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key")))
        if step:  # only buckets that still hold several components
            mixed = now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("bucket")
            now = stored(now.join(mixed, "bucket", "left_semi"), "buckets")
        near = (F.col("label") != F.col("label2")) & (F.least("n", "n2") >= threshold * F.greatest("n", "n2") - 1e-9)
        if step < hub_rounds:
            hub = F.min_by(F.struct("key", "n", "label"), F.xxhash64(F.lit(step), "bucket", "key")).alias("hub")
            other = now.groupBy("bucket").agg(hub).select(
                "bucket", F.col("hub.key").alias("key2"), F.col("hub.n").alias("n2"), F.col("hub.label").alias("label2"))
            pairs = now.join(other, "bucket").where(near).select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b"))
        else:
            sizes = now.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.collect_set("n").alias("sizes"))
            now = now.join(sizes, "bucket")
            few = now.where(F.col("c") <= small)
            other = few.select("bucket", F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("label").alias("label2"))
            pairs = few.join(other, "bucket").where(near & (F.col("key") < F.col("key2"))).select(F.col("key").alias("a"), F.col("key2").alias("b"))
            least = F.array_min(F.filter("sizes", lambda x: x >= threshold * F.col("n") - 1e-9))
            nodes = stored(now.where(F.col("c") > small).select("key", "n", "label", least.alias("least"))
                           .groupBy("key", "n", "label").agg(F.min("least").alias("least")), "nodes")
            pairs = pairs.unionByName(_by_rare_shingles(nodes, texts, threshold, size))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = verified(pairs, texts, threshold, size, miss)
        if label is not None:
            up = label.withColumnRenamed("label", "up")
            links = (links.join(up.withColumnsRenamed({"node": "a", "up": "ua"}), "a", "left").join(up.withColumnsRenamed({"node": "b", "up": "ub"}), "b", "left")
                     .select(F.coalesce("ua", "a").alias("a"), F.coalesce("ub", "b").alias("b")))
        found = components(links)
        if label is None:
            label = found
        else:
            nodes = label.unionByName(found.select("node", F.col("node").alias("label"))).dropDuplicates(["node"])
            label = stored(nodes.join(found.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left")
                           .select("node", F.coalesce("new", "label").alias("label")), "labels")
    return members.join(label.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", "h", "n", F.coalesce("label", "key").alias("label"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5, **settings) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per input row; component_id is the smallest id reachable."""
    rows = stored(groups(docs, threshold, size, **settings), "groups")
    least = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, threshold: float = 0.8, size: int = 5, **settings) -> DataFrame:
    """One document of each group, with all columns: the one of smallest id (null ids last), then smallest text hash.

    Documents without words all stay.
    """
    rows = groups(docs, threshold, size, **settings)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h")
    keep = rows.where("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("one")).select(
        F.coalesce("one.doc_id", F.lit(NULL_ID)).alias("_k"), F.col("one.h").alias("_h")).distinct()
    all_rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_k"), F.xxhash64("text").alias("_h"))
    columns = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    empty = F.regexp_like(text_of(F.col("_row.text")), F.lit("[^\\x20\\x09-\\x0D]"))
    return (all_rows.where(empty).join(keep, ["_k", "_h"], "left_semi").dropDuplicates(["_k", "_h"]).select(*columns)
            .unionByName(all_rows.where(~empty).select(*columns)))


_SQL = """
WITH RECURSIVE docs AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
     sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM docs),
     sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
     shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
     links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
     reach AS (SELECT doc_id, doc_id AS r FROM docs UNION SELECT reach.doc_id, y FROM reach JOIN links ON r = x),
     least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id, docs.doc_id = component_id AS kept
FROM docs LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""


@query("op8_near_dedup", _SQL)
def op8_near_dedup(spark, sf_dir):
    """Groups of documents linked by a similarity of 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=0.85)
