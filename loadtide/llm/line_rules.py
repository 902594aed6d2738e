"""Quality rules: counts inside a text, and lines that too many documents of a host share.

The base rule fails texts of fewer than 50 words and texts of which over half the words lie in
3-word windows that occur twice or more. The line rule hashes every normalised line (lower
case, white space to one space, trimmed), counts for each host (`source`) the distinct documents
that hold it, takes lines above the limit for boilerplate, and rejects documents of which such
lines are nearly all. Copies and near copies of one text, which de-duplication has to see whole, do not make each
other's lines boilerplate: they are one class and count once, for a line as for the host. Classes are the components of
texts whose five-word shingles (of their distinct lines) agree by `alike` or more, judged on the `SKETCH` smallest hashes
of each text; texts with no more shingles than that are compared whole.

Null texts have no words and fail the base rule. A null source is a host of its own. Rows that are
alike get equal results. Empty tables give empty results. Extra columns are kept by `passing` and
ignored elsewhere.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .near_dedup import components
from .registry import query, stored, table
from .text import WS_CHARS, let, text_of, words

SYMBOLS = "#*$%&|<>"
SKETCH = 128
LEVEL = 1.1
OWN_MORE = 13


def _repeat_words(ws: Column) -> Column:
    """How many words lie in a 3-word window found twice or more, windows told apart by 64-bit hashes.

    The top bits of a window's hash and its place share one number. Sorted, equal windows are
    neighbours; where top bits agree, the whole hashes are compared.
    """
    def covered(s: Column) -> Column:
        def near(z: Column, x: Column, i: Column) -> Column:
            other = F.get(z, i)
            return F.coalesce(x.bitwiseXOR(other).between(F.lit(0), s["low"]), F.lit(False))

        def places(z: Column) -> Column:
            whole = lambda x: F.get(s["h"], x.bitwiseAND(s["low"]).cast("int"))
            again = F.filter(z, lambda x, i: near(z, x, i - 1) | near(z, x, i + 1))
            return let(again, lambda c: let(F.sort_array(F.transform(F.filter(c, lambda x, i: (
                F.coalesce(whole(x) == whole(F.get(c, i - 1)), F.lit(False)) | F.coalesce(whole(x) == whole(F.get(c, i + 1)), F.lit(False)))),
                lambda x: x.bitwiseAND(s["low"]))), lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
                F.lit(0).cast("bigint"), lambda t, x: t + x)))

        return let(F.sort_array(F.transform(s["h"], lambda h, i: h.bitwiseAND(F.bitwise_not(s["low"])).bitwiseOR(i.cast("bigint")))), places)

    def windows(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.slice(w, F.lit(1), n - 2), lambda h, i: F.xxhash64(h, F.get(w, i + 1), F.get(w, i + 2)))
        low = (F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))) - 1).cast("bigint")
        return let(F.struct(hashes.alias("h"), low.alias("low")), covered)

    return F.when(F.size(ws) < 4, F.lit(0).cast("bigint")).otherwise(
        let(F.transform(ws, lambda w: F.xxhash64(w)), windows))


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text without nulls."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words")))


def base_failed(n_words: Column, n_repeat_words: Column, min_words: int = 50, max_repeat_pct: int = 50) -> Column:
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_pct * n_words)


def distinct_lines(text: Column) -> Column:
    """The text's normalised lines that have a word, each once."""
    def cut(t: Column) -> Column:
        odd = reduce(or_, [F.contains(t, F.lit(c)) for c in ("  ", "\t", "\x0b", "\x0c", "\r")])
        plain = F.when(odd, F.regexp_replace(t, "[\\x20\\x09\\x0B-\\x0D]+", " ")).otherwise(t)
        return F.array_distinct(F.filter(F.transform(F.split(plain, "\n"), lambda x: F.btrim(x)), lambda x: x != ""))

    return let(F.lower(F.btrim(text, F.lit(WS_CHARS))), cut)


def _keyed(docs: DataFrame) -> DataFrame:
    """With _k and _h, which tell documents apart."""
    return docs.select("doc_id", "text", "source", F.coalesce(F.col("doc_id"), F.lit(-1)).alias("_k"), F.xxhash64("doc_id", "text", "source").alias("_h"))


def _sketch(hashes: Column) -> Column:
    """The `SKETCH` smallest distinct hashes of five-word shingles over an array of the words' hashes; of fewer words, their one hash.

    Of the hashes the upper halves are kept, in the same order.
    """
    def cut(w: Column) -> Column:
        whole = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(w)))
        return F.when(F.size(w) < 5, whole).otherwise(F.transform(
            F.slice(w, F.lit(1), F.size(w) - 4), lambda h, i: F.xxhash64(h, *[F.get(w, i + j) for j in range(1, 5)])))

    least = F.slice(F.sort_array(F.array_distinct(let(hashes, cut))), 1, SKETCH + 32)  # some more, should upper halves agree
    return F.slice(F.array_distinct(F.transform(least, lambda x: F.shiftright(x, 32).cast("int"))), 1, SKETCH)


def document_table(docs: DataFrame) -> DataFrame:
    """(_k, _h, host, node, sketch, lines): a row per document; `lines` has (line, n_words) for each distinct normalised line.

    `node` names the sketch. Written to the scratch folder: it is narrow and read several times.
    """
    def row(x: Column) -> Column:
        def named(s: Column, words_of: Column) -> Column:
            return F.struct(F.unhex(F.hex(F.xxhash64(s))).alias("node"), s.alias("sketch"), F.transform(
                x, lambda y, i: F.struct(F.xxhash64(y).alias("line"), F.size(F.get(words_of, i)).alias("n_words"))).alias("lines"))

        hashes = F.transform(x, lambda y: F.transform(F.split(y, " "), lambda z: F.xxhash64(z)))
        return let(hashes, lambda h: let(_sketch(F.flatten(h)), lambda s: named(s, h)))

    return stored(_keyed(docs).select("_k", "_h", F.col("source").alias("host"), let(distinct_lines(text_of("text")), row).alias("r")).select(
        "_k", "_h", "host", "r.*"), "lines")


def similar(a: Column, b: Column) -> Column:
    """Jaccard similarity of two texts' shingle sets, from the part of both sketches that is known whole."""
    def compare(s: Column) -> Column:
        limit = F.least(*[F.when(F.size(s[c]) == SKETCH, F.get(s[c], F.lit(SKETCH - 1))) for c in "ab"])
        known = lambda x: F.filter(x, lambda v: limit.isNull() | (v <= limit))
        return let(F.struct(known(s["a"]).alias("a"), known(s["b"]).alias("b")), lambda t: let(
            F.size(F.array_intersect(t["a"], t["b"])), lambda n: n / (F.size(t["a"]) + F.size(t["b"]) - n)))

    return let(F.struct(a.alias("a"), b.alias("b")), compare)


def _prefix(n: Column, alike: float) -> Column:
    """How many first hashes of a sketch of n, in any common order, hold one of those it shares with a sketch alike.

    Whether whole or cut, one of two sketches lies in the compared part whole. So at least `alike` times the larger size is shared.
    """
    return (n - F.ceil(alike * n - 1e-9) + 1).cast("int")


def _most_apart(n: Column, n2: Column, alike: float) -> Column:
    """How many hashes of two sketches alike of n and n2 can be in one only, counted where both sketches are known."""
    return F.floor((1 - alike) / (1 + alike) * (n + n2) + 1e-9)


def _largest_partner(n: Column, alike: float) -> Column:
    return F.least(F.lit(SKETCH), F.floor(n / alike + 1e-9))


def _families(nodes: DataFrame, alike: float) -> DataFrame:
    """(node, family): nodes (node, label, sketch) that can be alike to one of another label are in one family with it.

    Of a sketch's first hashes one alike to it lacks a certain number at most, so the others have to occur under another label, and
    not much further on. Most nodes that share a mere passage fall out by that. Sketches alike share one of their rarest hashes. Hashes are ordered by the number of nodes
    that have them; those of one label only come first and meet nothing, so only their number counts.
    """
    n = F.size("sketch")
    own = _prefix(n, alike) - 1  # hashes that one alike may lack
    before = own + _prefix(_largest_partner(n, alike), alike) - 1 + OWN_MORE  # so far on lie what a partner has among its first ones
    begun = nodes.select("node", "label", own.alias("own"), F.posexplode(F.slice("sketch", F.lit(1), before)).alias("at", "s")).repartition("s")
    met = begun.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("s")
    enough = begun.where(F.col("at") < F.col("own") + OWN_MORE).join(met, "s", "left_semi").groupBy("node").agg(F.count(F.lit(1)).alias("c"))
    nodes = nodes.join(enough, "node").where(F.col("c") >= F.least(n, own + OWN_MORE) - own).drop("c")
    held = stored(nodes.select("node", "label", F.size("sketch").alias("n"), F.explode("sketch").alias("s")), "hashes")
    common = held.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    ranked = held.join(common.select("s", "df"), "s").selectExpr(
        "s", "node", "label", "n", "row_number() OVER (PARTITION BY node ORDER BY df, s) AS place", "count(*) OVER (PARTITION BY node) AS n_common")
    first = stored(ranked.where(F.col("n") - F.col("n_common") + F.col("place") <= _prefix(F.col("n"), alike)).select("s", "node", "label"), "prefixes")
    meeting = first.groupBy("s").agg(F.min("node").alias("one"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return components(first.join(meeting, "s").selectExpr("node AS a", "one AS b")).withColumnRenamed("label", "family")


def _level(x: Column) -> Column:
    """The highest of the levels that lie at or below a hash; level 0 holds all hashes, each lower one a tenth fewer."""
    return F.floor(F.log((x + 2.0 ** 31 + 1) / 2.0 ** 32) / math.log(LEVEL)).cast("int")


def _by_differences(nodes: DataFrame, alike: float) -> DataFrame:
    """Pairs (a, b) of nodes (node, label, sketch) of different labels that their differences from what their family has in common leave possible.

    Variants of one text share nearly all their hashes, so that these tell few pairs apart. What tells them apart is where each
    departs from the family's core, the hashes that over half of it have: hashes a node has beyond the core or lacks. A hash is in
    one of two sketches only just if it is in one of their departures only. So two nodes that depart in m and m2 hashes and are
    alike have at least (m + m2 - most apart) / 2 departures in common, and share one among their rarest (prefix and place filter);
    where that is none, both are close to the core and are paired for that.

    All this holds up to any hash that both sketches reach. Nodes are compared at the highest level below the ends of
    both; sketches alike share so many hashes that a node needs only the levels from the end of such a part to its own end.
    """
    least = math.ceil(alike * SKETCH - 1e-9)
    nodes = nodes.withColumn("label", F.xxhash64("label"))
    family = _families(nodes, alike)
    members = stored(nodes.join(family, "node").select("family", "node", "label", "sketch"), "members")
    families = members.groupBy("family", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("family").agg(
        F.sum("c").alias("of"), F.max_by("label", F.struct("c", "label")).alias("main"))
    core = (members.select("family", F.explode("sketch").alias("s")).groupBy("family", "s").agg(F.count(F.lit(1)).alias("c")).join(families, "family")
            .where(2 * F.col("c") > F.col("of")).groupBy("family").agg(F.collect_list("s").alias("core")))
    n, none = F.size("sketch"), F.array().cast("array<int>")
    top = F.when(n < SKETCH, F.lit(0)).otherwise(_level(F.element_at("sketch", -1)))
    low = F.when(n < least, top).otherwise(F.least(top, _level(F.get("sketch", F.lit(least - 1)))))
    apart = members.join(families.join(core, "family", "left"), "family").withColumn("core", F.coalesce("core", none)).select(
        "family", "node", "label", (F.col("label") == F.col("main")).alias("main"), n.alias("n"), top.alias("top"), F.explode(F.sequence(low, top)).alias("level"),
        F.concat(F.array_except("sketch", "core"), F.array_except("core", "sketch")).alias("d"))
    apart = stored(apart.withColumn("d", F.filter("d", lambda x: (x + 2.0 ** 31 + 1) / 2.0 ** 32 <= F.pow(F.lit(LEVEL), F.col("level"))))
                   .withColumn("m", F.size("d")), "apart")
    most = _most_apart(F.col("n"), _largest_partner(F.col("n"), alike), alike)  # with the largest partner
    own = ["family", "level", "node", "label", "main", "n", "top", "m"]
    held = apart.select(*own, F.explode("d").alias("s"))
    common = held.groupBy("family", "level", "s").agg(F.count(F.lit(1)).alias("df"), F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
    ranked = held.join(common.select("family", "level", "s", "df"), ["family", "level", "s"]).select(
        *own, "s", F.expr("row_number() OVER (PARTITION BY node, level ORDER BY df, s)").alias("place"),
        F.expr("count(*) OVER (PARTITION BY node, level)").alias("n_common"))
    share = F.greatest(F.lit(1), F.ceil((F.col("m") + F.greatest(F.lit(0), F.col("m") - most) - most) / 2))
    left = ranked.withColumn("place", F.col("m") - F.col("n_common") + F.col("place")).where(F.col("place") <= F.col("m") - share + 1).drop("n_common")
    close = apart.where(F.col("m") <= most).select(*own, F.lit(None).cast("int").alias("s"), F.lit(0).cast("long").alias("place"))
    left = stored(left.unionByName(close), "departures")
    meeting = left.groupBy("family", "level", "s").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select(
        F.col("family").alias("f2"), F.col("level").alias("l2"), F.col("s").alias("s2"))
    left = left.join(meeting, (F.col("family") == F.col("f2")) & (F.col("level") == F.col("l2")) & F.col("s").eqNullSafe(F.col("s2")), "left_semi")
    right = left.withColumnsRenamed({c: f"{c}2" for c in left.columns})
    both = F.ceil((F.col("m") + F.col("m2") - _most_apart(F.col("n"), F.col("n2"), alike)) / 2)  # departures in common, if alike
    possible = 1 + F.least(F.col("m") - F.col("place"), F.col("m2") - F.col("place2"))  # if this is the first they share
    once = F.col("main2") | (F.col("node") < F.col("node2"))  # the nodes of the family's main label are not paired among themselves
    return left.where("not main").join(right, (F.col("family") == F.col("family2")) & (F.col("level") == F.col("level2")) & F.col("s").eqNullSafe(F.col("s2"))
                     & once & (F.col("label") != F.col("label2")) & (F.col("level") == F.least("top", "top2"))
                     & F.when(F.col("s").isNull(), both <= 0).otherwise((both > 0) & (possible >= both))).select(
                         F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))


def _few_differences(s: Column, t: Column, alike: float) -> Column:
    """Whether two sketches with these first hashes (n, head) can be alike: where both are known, few enough hashes are in one only."""
    def compare(x: Column) -> Column:
        limit = F.least(F.element_at(x["s"]["head"], -1), F.element_at(x["t"]["head"], -1))
        known = lambda c: F.filter(x[c]["head"], lambda v: v < limit)
        return let(F.struct(known("s").alias("s"), known("t").alias("t")), lambda k: (
            F.size(k["s"]) + F.size(k["t"]) - 2 * F.size(F.array_intersect(k["s"], k["t"])) <= _most_apart(x["s"]["n"], x["t"]["n"], alike)))

    return let(F.struct(s.alias("s"), t.alias("t")), compare)


def _linked(pairs: DataFrame, nodes: DataFrame, alike: float) -> DataFrame:
    """The pairs (a, b) whose sketches are alike. Whole sketches are fetched for pairs only that their first hashes leave possible."""
    heads = nodes.select("node", F.struct(F.size("sketch").alias("n"), F.slice("sketch", F.lit(1), _prefix(F.size("sketch"), alike)).alias("head")).alias("h"))
    left = stored(pairs.distinct().join(heads.withColumnsRenamed({"node": "a", "h": "s"}), "a").join(heads.withColumnsRenamed({"node": "b", "h": "t"}), "b")
                  .where(_few_differences(F.col("s"), F.col("t"), alike)).select("a", "b"), "possible")
    nodes = nodes.join(left.selectExpr("explode(array(a, b)) AS node").distinct(), "node", "left_semi")
    return stored(left.join(nodes.withColumnsRenamed({"node": "a", "sketch": "s"}), "a").join(nodes.withColumnsRenamed({"node": "b", "sketch": "t"}), "b")
                  .where(similar(F.col("s"), F.col("t")) >= alike).select("a", "b"), "alike")


def copies(rows: DataFrame, alike: float = 0.8, hub_rounds: int = 1, small: int = 16) -> DataFrame:
    """(node, label) for the nodes of `rows` (node, sketch) that are alike to others; the label is that of the class.

    Candidates share one of the smallest hashes of their sketches, so many (26 of 128 at 0.8) that no pair alike is missed.
    Every node of a bucket is compared with one hub (in several rounds with another hub each, if `hub_rounds` says so). Buckets that
    still hold several classes are paired whole up to `small` nodes; the nodes of larger ones are paired where they depart alike
    from what their family has in common. So every pair alike is found or lies in one class already.
    """
    entries = rows.select("node", F.explode(F.slice("sketch", F.lit(1), _prefix(F.size("sketch"), alike))).alias("bucket")).repartition("bucket")
    shared = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("bucket")
    buckets = stored(entries.join(shared, "bucket", "left_semi").distinct(), "buckets")
    wanted = buckets.select("node").distinct().hint("merge")  # one plan for all sizes, as the list grows with the rows
    nodes = stored(rows.select("node", "sketch").join(wanted, "node", "left_semi").groupBy("node").agg(
        F.first("sketch").alias("sketch")), "sketches")
    links, label = None, None
    for step in range(hub_rounds + 1):
        now = buckets.withColumn("label", F.col("node")) if label is None else (
            buckets.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
        per = now.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("low"), F.max("label").alias("high"), F.min_by(
            F.struct("node", "label"), F.xxhash64(F.lit(step), "bucket", "node")).alias("hub")).where("low <> high")
        if step < hub_rounds:
            other = per.select("bucket", F.col("hub.node").alias("node2"), F.col("hub.label").alias("label2"))
        else:
            many = now.join(per.where(F.col("c") > small).select("bucket"), "bucket", "left_semi").select("node", "label").distinct()
            departing = _by_differences(nodes.join(many, "node"), alike)
            now = now.join(per.where(F.col("c") <= small).select("bucket"), "bucket", "left_semi")
            other = now.select("bucket", F.col("node").alias("node2"), F.col("label").alias("label2"))
        pairs = now.join(other, "bucket").where("label <> label2").select(
            F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))
        found = _linked(pairs if step < hub_rounds else pairs.unionByName(departing), nodes, alike)
        if step and found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        label = components(links)
    return label


def line_table(docs: DataFrame, alike: float = 0.8) -> DataFrame:
    """(_k, _h, host, label, lines): a row per document with the class it counts as."""
    rows = document_table(docs)
    return rows.drop("sketch").join(copies(rows, alike), "node", "left").select("_k", "_h", "host", F.coalesce("label", "node").alias("label"), "lines")


def boilerplate(rows: DataFrame, min_docs: int = 20, max_share: float = 0.01) -> DataFrame:
    """(host, line, n_docs): hashed lines in more than `min_docs` distinct documents and `max_share` of the distinct documents of a host."""
    lines = rows.select("host", "label", F.explode("lines.line").alias("line"))
    counted = (lines.groupBy("host", "line", "label").agg(F.lit(1).alias("one"))
               .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > min_docs))
    hosts = (rows.groupBy(F.col("host").alias("all_of"), "label").agg(F.lit(1).alias("one"))
             .groupBy("all_of").agg(F.count(F.lit(1)).alias("n_all")))
    return (counted.join(hosts, counted["host"].eqNullSafe(hosts["all_of"])).where(F.col("n_docs") > max_share * F.col("n_all"))
            .select("host", "line", "n_docs"))


def boilerplate_words(docs: DataFrame, **limits) -> DataFrame:
    """(_k, _h, n_boiler, n_distinct, boiler): a document's words in distinct lines that are boilerplate and in all its distinct lines, hashes of the former.

    Documents without boilerplate are left out.
    """
    rows = line_table(docs)
    common = boilerplate(rows, **limits).select(F.col("host").alias("c_host"), F.col("line").alias("c_line"))
    total = F.aggregate("lines", F.lit(0).cast("bigint"), lambda t, x: t + x["n_words"])
    lines = rows.select("_k", "_h", "host", total.alias("n_distinct"), F.inline("lines"))
    hit = lines.join(common, lines["host"].eqNullSafe(common["c_host"]) & (lines["line"] == common["c_line"]), "left_semi")
    return (hit.groupBy("_k", "_h", "line").agg(F.max("n_words").alias("n_words"), F.max("n_distinct").alias("n_distinct"))
            .groupBy("_k", "_h").agg(F.sum("n_words").alias("n_boiler"), F.max("n_distinct").alias("n_distinct"), F.collect_list("line").alias("boiler")))


def judge(docs: DataFrame, min_left: float = 0.2, **limits) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_boiler, kept), a row per document.

    `n_boiler` counts each distinct boilerplate line once. A document is depleted where less than
    `min_left` of the words of its distinct lines is left.
    """
    text = text_of("text")
    own = _keyed(docs).select("doc_id", "_k", "_h", measures(text).alias("m")).select("doc_id", "_k", "_h", "m.*")
    joined = own.join(boilerplate_words(docs, **limits).drop("boiler"), ["_k", "_h"], "left").withColumn("n_boiler", F.coalesce("n_boiler", F.lit(0)))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         F.col("n_boiler").cast("long").alias("n_boiler"),
                         (~failed & _enough_left(min_left)).alias("kept"))


def _enough_left(min_left: float) -> Column:
    return F.col("n_distinct").isNull() | (F.col("n_distinct") - F.col("n_boiler") >= min_left * F.col("n_distinct"))


def without_lines(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normalised form has one of these hashes."""
    def hashed(x: Column) -> Column:
        return F.xxhash64(F.regexp_replace(F.lower(F.btrim(x, F.lit(WS_CHARS))), "[\\x20\\x09\\x0B-\\x0D]+", " "))

    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(hashes, hashed(x))), "\n")


def passing(docs: DataFrame, min_left: float = 0.2, remove_lines: bool = False, **limits) -> DataFrame:
    """The documents that `judge` keeps, with all their columns.

    With `remove_lines` the boilerplate lines are taken out of the texts, and `n_chars` is counted anew where something
    was; the other texts stay as they are.
    """
    text = text_of(F.col("_row.text"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("doc_id"), F.lit(-1)).alias("_k"),
                       F.xxhash64("doc_id", "text", "source").alias("_h"))
    good = rows.withColumn("_m", let(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))).where(
        ~base_failed(F.col("_m.n"), F.col("_m.r")))
    kept = good.join(boilerplate_words(docs, **limits), ["_k", "_h"], "left").where(_enough_left(min_left))
    if not remove_lines:
        return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    kept = kept.withColumn("_t", F.when(F.col("boiler").isNull(), F.col("_row.text")).otherwise(without_lines(text, F.col("boiler"))))
    new = {"text": F.col("_t")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("boiler").isNull(), F.col("_row.n_chars")).otherwise(F.length("_t")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


@query("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    """Counts, base rule and line rule for every document."""
    return judge(table(spark, sf_dir, "documents"))
