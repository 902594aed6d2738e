"""How far the sources of a language diverge in their words: integer divergences from joint tables of counts.

1. Each text's terms (runs of ASCII letters, lower-cased, and of characters beyond ASCII) are counted per (lang, source)
   inside the tasks that read them, and added up in Spark. A language keeps the terms of `min_docs` documents or more.
2. The kept terms are rows of a matrix with one indicator column for each (source, count above 0). A block of rows is
   multiplied by its own transpose: the product has, for each two columns, the number of terms with these two counts,
   and on its diagonal the number of terms with one count. Sums of 0 and 1 below 2^24 are exact in 32-bit floats.
3. A joint table prices a pair of sources: the number of terms with counts (a, b) times the divergence of their
   probabilities. Count 0 has no column; its share follows from the diagonal, as the difference to a pair in which both
   sources lack the term. So a product costs what occurs, not all terms times all sources.

Rows of the matrix are dealt out by a hash of the term, about `ROWS` to a block, columns by a hash of the source into blocks of about `width`
sources; each task works on one row block of one pair of column blocks and hands on sums per pair of sources. Nothing is
broadcast: the sizes of the sources travel to each task as rows before its terms. A language or source that holds most
of the corpus, or a word in every text, is spread over all row blocks like others.

Probabilities and divergences are whole numbers: p = 1 + floor(10^9 (count + 1) / (N + V)), f = floor((p - q)^2 / q).

Null texts, languages and sources count as ''. Empty texts and texts without terms still make their group occur. A
language without kept terms has divergences of 0 and no term rows. Very long texts are counted in slices, so that a
task holds one text and its distinct terms. Ties in value go by the item's UTF-8 bytes. Repeated rows are documents like
others. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .registry import claim, partitions, query, ship, stored, table

SCALE = 1_000_000_000
WIDTH = 256
COLUMNS = 384  # indicator columns in one product
ROWS = 32_768  # terms in a row block, about
HELD = 400_000  # counts that a counting task holds before it hands them on
SLICE = 1 << 20
# bytes of terms stay, A-Z as lower case, all others separate
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str):
    """Lists of the terms of a text, slice by slice."""
    data = text.encode().translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a row with term '' for each group that occurs."""
    ship(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        claim("source_audit")
        counts, seen, size = defaultdict(Counter), defaultdict(Counter), 0

        def handed_on():
            for (a, b), c in counts.items():
                words = list(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a], pa.string()).take(pa.array(np.zeros(len(words), np.int32))),
                     pa.array([b], pa.string()).take(pa.array(np.zeros(len(words), np.int32))),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array(c.values(), pa.int64()),
                     pa.array(map(seen[a, b].__getitem__, words), pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for a, b, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c, s = counts[a, b], seen[a, b]
                before, own = len(c), set()
                for part in terms(t):
                    c.update(part)
                    own.update(part)
                s.update(own)
                c[b""] += 0
                size += len(c) - before
                if size >= HELD:
                    yield from handed_on()
                    counts, seen, size = defaultdict(Counter), defaultdict(Counter), 0
        yield from handed_on()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    parts = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = 3) -> DataFrame:
    """(lang, term, total, entries): kept terms with their counts by source; term '' has all sources of the language."""
    return (counts.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("entries"))
            .filter((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"))


def probability(count, size):
    """1 + floor(10^9 (count + 1) / size) for whole numbers with 0 <= count < size < 2^53: long division, nothing rounded."""
    left, out = count + 1, 0
    for _ in range(3):
        out, left = out * 1000 + left * 1000 // size, left * 1000 % size
    return out + 1


def divergence(p, q):
    return (p - q) ** 2 // q


class Tile:
    """One row block of one pair of column blocks: sums per pair of sources, and the best terms of each source."""

    def __init__(self, sizes: dict, v: int, n_lang: int, halves: dict, first: bool, diagonal: bool, best: int):
        self.names = sorted(sizes)
        self.place = {s: i for i, s in enumerate(self.names)}
        self.size = np.array([max(1, sizes[s] + v) for s in self.names], np.int64)
        self.lang_size, self.diagonal, self.best = max(1, n_lang + v), diagonal, best
        self.p0 = probability(np.zeros(len(self.names), np.int64), self.size)
        self.f00 = divergence(self.p0[:, None], self.p0[None, :])
        self.sums = v * self.f00 if first else np.zeros_like(self.f00)
        half = np.array([halves[s] for s in self.names])
        self.wanted = ~np.eye(len(half), dtype=bool) if diagonal else half[:, None] != half[None, :]
        self.top: list[list] = [[] for _ in self.names]
        self.least = np.zeros(len(self.names), np.int64)

    def add(self, total: np.ndarray, words, offsets: np.ndarray, source: np.ndarray, n: np.ndarray) -> None:
        row = np.repeat(np.arange(len(total)), np.diff(offsets))
        if self.diagonal:
            self._terms(total, words, row, source, n)
        order = np.argsort(total, kind="stable")  # rows with like counts share columns
        rank = np.empty(len(total), np.int64)
        rank[order] = np.arange(len(total))
        by = np.argsort(rank[row], kind="stable")
        row, source, n = rank[row][by], source[by], n[by]
        todo = [(0, len(total))]
        while todo:
            low, high = todo.pop()
            a, b = np.searchsorted(row, (low, high))
            if a == b:
                continue
            code, column = np.unique(source[a:b] * (n[a:b].max() + 1) + n[a:b], return_inverse=True)
            if len(code) > COLUMNS and high - low > 1:
                middle = (low + high) // 2
                todo += [(low, middle), (middle, high)]
                continue
            x = np.zeros((high - low, len(code)), np.float32)
            x[row[a:b] - low, column] = 1
            s, level = np.divmod(code, n[a:b].max() + 1)
            self._price((x.T @ x).astype(np.int64), s, level)

    def _price(self, joint: np.ndarray, s: np.ndarray, level: np.ndarray) -> None:
        p = probability(level, self.size[s])
        # one count against a source without the term, in both directions, less a pair without it
        out = divergence(p[:, None], self.p0[None, :]) - self.f00[s]
        back = divergence(self.p0[None, :], p[:, None]) - self.f00[:, s].T
        alone = np.diag(joint)[:, None]
        np.add.at(self.sums, s, alone * out)
        np.add.at(self.sums.T, s, alone * back)
        u, v = np.nonzero(joint)
        u, v = (z[s[u] != s[v]] for z in (u, v))
        su, sv = s[u], s[v]
        np.add.at(self.sums, (su, sv), joint[u, v] * (divergence(p[u], p[v]) - out[u, sv] - back[v, su] - self.f00[su, sv]))

    def _terms(self, total, words, row, source, n) -> None:
        p, q = probability(n, self.size[source]), probability(total, self.lang_size)[row]
        value = divergence(p, q)
        at = np.flatnonzero((p > q) & (value >= self.least[source]))
        if not len(at):
            return
        at = at[np.argsort(source[at], kind="stable")]
        for part in np.split(at, np.flatnonzero(np.diff(source[at])) + 1):
            s, worth = source[part[0]], value[part]
            if len(part) > self.best:
                part = part[worth >= np.partition(worth, -self.best)[-self.best]]
            found = self.top[s]
            found += [(-int(value[k]), words[int(row[k])].as_py().encode()) for k in part]
            if len(found) > 8 * self.best:
                self._cut(s)

    def _cut(self, s: int) -> None:
        self.top[s] = sorted(self.top[s])[:self.best]
        if len(self.top[s]) == self.best:
            self.least[s] = -self.top[s][-1][0]

    def rows(self) -> tuple[list, list, list, list]:
        a, b = np.nonzero(self.wanted)
        out = [self.names[i] for i in a], ["pair"] * len(a), [self.names[i] for i in b], self.sums[a, b].tolist()
        for s in range(len(self.names)):
            self._cut(s)
            for value, word in self.top[s]:
                for column, x in zip(out, (self.names[s], "term", word.decode(), -value)):
                    column.append(x)
        return out


def _priced(rows: DataFrame, best: int) -> DataFrame:
    """Sums of each task; `rows` come sorted by tile, its sources first."""
    def run(batches):
        import pyarrow as pa

        now, tile, sizes, halves = None, None, {}, {}

        def built():
            lang, i, j, block = now
            return Tile(sizes, *whole, halves, block == 0, i == j, best)

        def done():
            out = (tile or built()).rows()
            for at in range(0, len(out[0]), 50_000):
                part = [c[at:at + 50_000] for c in out]
                yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(part[0]), pa.string())] + [
                    pa.array(c, pa.int64() if k == 3 else pa.string()) for k, c in enumerate(part)],
                    names=["lang", "source", "part", "item", "value"])

        for batch in batches:
            at = 0
            keys = zip(*(batch.column(k).to_pylist() for k in ("lang", "i", "j", "block", "kind")))
            for (*key, kind), group in itertools.groupby(keys):
                some = batch.slice(at, sum(1 for _ in group))
                at += some.num_rows
                if key != now:
                    if now is not None:
                        yield from done()
                    now, tile, sizes, halves = key, None, {}, {}
                entries = some.column("entries")
                names, counts = entries.flatten().field("source"), entries.flatten().field("n").to_numpy(zero_copy_only=False)
                if kind == 0:
                    sizes |= zip(names.to_pylist(), counts.tolist())
                    halves |= zip(names.to_pylist(), some.column("half").to_pylist())
                    whole = some.column("v")[0].as_py(), some.column("total")[0].as_py()
                    continue
                tile = tile or built()
                coded = names.dictionary_encode()
                places = np.array([tile.place[s] for s in coded.dictionary.to_pylist()], np.int64)
                offsets = entries.offsets.to_numpy()
                tile.add(some.column("total").to_numpy(), some.column("term"), offsets - offsets[0],
                         places[coded.indices.to_numpy()], counts)
        if now is not None:
            yield from done()

    return rows.mapInArrow(run, "lang string, source string, part string, item string, value long")


def audit(docs: DataFrame, min_docs: int = 3, best: int = 200, width: int = WIDTH) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of each source from the language's others, and its `best` terms."""
    spark = docs.sparkSession
    kept = stored(kept_terms(term_counts(docs), min_docs), "terms")
    langs = kept.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("v"), F.sum("total").alias("total"))
    groups = (kept.select("lang", F.explode("entries").alias("e")).groupBy("lang", F.col("e.source").alias("source"))
              .agg(F.sum("e.n").alias("n")))
    sizes = stored(groups.join(langs, "lang"), "groups")
    shape = sizes.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.first("v").alias("v")).agg(F.max("sources").alias("most"), F.max("v").alias("v")).first()
    halves = max(1, -(-(shape.most or 1) // width))
    blocks = max(1, -(-(shape.v or 1) // ROWS))

    def half(source) -> F.Column:
        return F.pmod(F.xxhash64(source), F.lit(halves)).cast("int")

    all_halves = F.sequence(F.lit(0), F.lit(halves - 1))
    heads = (sizes.withColumn("half", half(F.col("source"))).withColumn("other", F.explode(all_halves))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select("lang", F.least("half", "other").alias("i"), F.greatest("half", "other").alias("j"), "block",
                     F.lit(0).alias("kind"), "total", F.lit("").alias("term"), "v", "half",
                     F.array(F.struct("source", "n")).alias("entries")))
    pairs = F.array_distinct(F.flatten(F.transform("entries", lambda e: F.transform(
        all_halves, lambda o: F.struct(F.least(half(e["source"]), o).alias("i"), F.greatest(half(e["source"]), o).alias("j"))))))
    body = kept.filter("term != ''")
    if halves == 1:
        body = body.withColumn("t", F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    else:
        body = (body.withColumn("t", F.explode(pairs)).withColumn("entries", F.filter(
            "entries", lambda e: half(e["source"]).isin(F.col("t.i"), F.col("t.j")))))
    body = body.select("lang", "t.i", "t.j", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"),
                       F.lit(1).alias("kind"), "total", "term", F.lit(0).cast("long").alias("v"), F.lit(0).alias("half"), "entries")
    dealt = (heads.unionByName(body).repartition(partitions(spark), "lang", "i", "j", "block")
             .sortWithinPartitions("lang", "i", "j", "block", "kind"))
    # sums of tasks are exact modulo 2^64, as is their total
    two63, two64 = (F.lit(str(1 << k)).cast("decimal(38,0)") for k in (63, 64))
    found = (_priced(dealt, best).groupBy("lang", "source", "part", "item")
             .agg(F.sum(F.col("value").cast("decimal(20,0)")).cast("decimal(38,0)").alias("sum"))
             .select("lang", "source", "part", "item", (F.pmod(F.col("sum") + two63, two64) - two63).cast("long").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order)).filter((F.col("part") == "pair") | (F.col("rank") <= best))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
v AS (SELECT l.lang, count(term)::HUGEINT AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept USING (lang) GROUP BY l.lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT + any_value(v) AS z FROM g JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT s.lang, s.source, kept.term, coalesce(n, 0) AS n, (1 + 1000000000 * (coalesce(n, 0) + 1) // z)::HUGEINT AS p
      FROM size s JOIN kept USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = kept.term),
l AS (SELECT c.lang, c.term, (1 + 1000000000 * (sum(n) + 1) // any_value(z))::HUGEINT AS q
      FROM c JOIN (SELECT lang, sum(z) - (count(*) - 1) * any_value(v.v) AS z FROM size JOIN v USING (lang) GROUP BY lang) t USING (lang) GROUP BY c.lang, c.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
          UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200
"""


@query("op11_source_audit", SQL)
def source_audit(spark, sf_dir):
    """Divergences between the sources of each language, and the terms that set a source apart."""
    return audit(table(spark, sf_dir, "documents"))
