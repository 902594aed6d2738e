"""Stupid-backoff scores of documents under a bigram model counted on the whole corpus.

S(v | u) = c(u v) / c(u) where c(u v) reaches `min_count`, else alpha * c(v) / N. A document's score is the sum of log10 S over
its words; the first word's context is the document's start, which counts once per document with words.

The tables are partitioned by hash: tasks turn blocks of documents into sorted n-gram lists, each n-gram once per block, with the
documents that hold it, and send every hash partition its part. There the counts of all blocks add up, are joined to the
n-grams of each block, and give partial sums per document:

1. Word counts. Words that make up 1/`hot` of the corpus or more (at most `hot` of them) go to all tasks.
2. Counts of pairs of such words; the pairs that make up 1/`hot` or more (at most `hot`) too. Such pairs are scored where
   the document is read, so that no partition gets a list as long as the corpus.
3. All other pairs, partitioned by the hash of the predicted word (of the context where the predicted word is hot, of the pair
   where both are): here both c(u v) and c(v) are known. Where c(u) isn't, -log10 c(u) is still due.
4. What is due, partitioned by the hash of the context and joined to the word counts.
5. Sums per document.

Words are runs of other characters than ASCII white space, ASCII letters in lower case, told apart by 48-bit hashes. Null texts
and texts without words score 0 (mean null). Every row is a document, also rows that repeat or have no id. Other columns are
ignored. Empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import claim, partitions, query, ship, stored, table

START = 0  # the context of first words
BITS = 48
BLOCK_WORDS = 700_000
_ROW = "part long, kind int, block long, a binary, b binary, c binary, d binary, e binary, f binary"
_NAMES = ["part", "kind", "block", *"abcdef"]
_UNIT = 2.0 ** 36  # partial sums are sent in these parts of one


class Words(dict):
    """48-bit hash of each word, computed on first use; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 250_000:
            self.clear()
        h = self[word] = (xxhash.xxh64_intdigest(word) >> (64 - BITS)) or 1
        return h


_words = Words()


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte: all first bytes, all second bytes and so on, which compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def unplaned(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def ascending(x: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return planes(np.diff(x, prepend=np.uint64(0)))


def ascended(b: bytes) -> np.ndarray:
    return np.cumsum(unplaned(b, np.uint64), dtype=np.uint64)


def _slices(part: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(number, from, to) of the runs of a sorted array."""
    edges = np.searchsorted(part, np.arange(n + 1))
    return [(k, int(edges[k]), int(edges[k + 1])) for k in range(n) if edges[k] < edges[k + 1]]


def _part(h: np.ndarray, n: int) -> np.ndarray:
    """Hash partition: ascending with the hash."""
    return ((h >> np.uint64(BITS - 24)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def _blocks(batches, limit: int = BLOCK_WORDS):
    """(number, ids, lengths, word hashes) of blocks of documents."""
    from pyspark import TaskContext

    claim("lm_scoring")
    number = TaskContext.get().partitionId() << 32
    ids, lengths, hashes, n = [], [], [], 0
    for piece in (batch.slice(s, 500) for batch in batches for s in range(0, batch.num_rows, 500)):
        for i, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
            w = (text or "").encode().lower().split()
            ids.append(i)
            lengths.append(len(w))
            hashes.append(np.fromiter(map(_words.__getitem__, w), np.uint64, len(w)))
            n += len(w)
            if n >= limit or len(ids) >= 60_000:
                block = number, ids, np.array(lengths), np.concatenate(hashes)
                number, ids, lengths, hashes, n = number + 1, [], [], [], 0
                yield block
                del block
    if ids:
        yield number, ids, np.array(lengths), np.concatenate(hashes)
    _words.clear()


def _before(lengths: np.ndarray, values: np.ndarray, start) -> np.ndarray:
    """The value of the word before each word, `start` for first words."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[(np.cumsum(lengths) - lengths)[lengths > 0]] = start
    return out


class Hot:
    """Frequent words: their places in the ascending list from 1, 0 for other words."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def places(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(w), np.uint32)
        some = np.flatnonzero(self.maybe[(w & np.uint64(0xFFFF)).astype(np.int64)])
        out[some] = _look(self.words, np.arange(1, len(self.words) + 1, dtype=np.uint32), w[some])
        return out


def _rows(rows: list[tuple]) -> "object":
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * 6
    columns = list(zip(*[r + (None,) * (9 - len(r)) for r in rows])) if rows else [[]] * 9
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([r + (None,) * (9 - len(r)) for r in rows], columns=_NAMES)


def _partial(docs: np.ndarray, sums: np.ndarray) -> tuple[bytes, bytes]:
    """Places of documents, ascending, and their sums as whole numbers of units, the sign in the lowest bit."""
    units = np.rint(sums * _UNIT).astype(np.int64)
    return planes(np.diff(docs.astype(np.uint16), prepend=np.uint16(0))), planes((units << 1) ^ (units >> 63))


def _partials(docs: bytes, sums: bytes) -> tuple[np.ndarray, np.ndarray]:
    units = unplaned(sums, np.int64)
    return np.cumsum(unplaned(docs, np.uint16), dtype=np.int64), ((units >> 1) ^ -(units & 1)) / _UNIT


def word_counts(docs: DataFrame, parts: int, hot: int) -> DataFrame:
    """(part, words, counts, total, top): a row per hash partition, words ascending; START counts documents and not in total.

    `top` has the words that make up 1/`hot` of the partition's words or more, with their counts: every word that makes up as
    much of the whole corpus is among them.
    """
    ship(docs.sparkSession)

    def explode(batches):
        for number, _, lengths, w in _blocks(batches):
            u, c = np.unique(w, return_counts=True)
            started = int((lengths > 0).sum())
            if started:
                u, c = np.append(np.uint64(START), u), np.append(started, c)
            yield _rows([(k, 0, number, ascending(u[i:j]), planes(c[i:j].astype(np.uint32)))
                         for k, i, j in _slices(_part(u, parts), parts)])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([ascended(x) for x in pdf["a"]])
        c = np.concatenate([unplaned(x, np.uint32) for x in pdf["b"]])
        u, at = np.unique(h, return_inverse=True)
        n = np.bincount(at, weights=c).astype(np.uint64)
        total = int(n[u != START].sum())
        top = (n >= total / hot) | (u == START)
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "words": [ascending(u)], "counts": [planes(n)], "total": [total],
                             "top": [[{"w": int(x), "c": int(y)} for x, y in zip(u[top], n[top])]]})

    return docs.mapInArrow(explode, _ROW).groupBy("part").applyInPandas(
        add, "part long, words binary, counts binary, total long, top array<struct<w: long, c: long>>")


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _pair_part(v: np.ndarray, u: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    """Hash partition of pairs u v: of v, of u where v is hot, of the pair where both are, whose counts all tasks know."""
    both = (v * np.uint64(0x9E3779B97F4A7C15) + u * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(64 - BITS)
    hot_v, hot_u = (_look(hot, np.ones(len(hot), bool), x).astype(bool) for x in (v, u))
    return _part(np.where(hot_v, np.where(hot_u, both, u), v), n)


def _hot_words(counts: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Words with that count or more, ascending, and their counts."""
    rows = sorted(counts.select(F.inline("top")).where((F.col("c") >= least) | (F.col("w") == START)).collect())
    return np.array([r["w"] for r in rows], np.uint64), np.array([r["c"] for r in rows], np.uint64)


def _hot_pairs(docs: DataFrame, hot: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of hot words with that count or more as (context's place) * number of hot words + (word's place), and their counts."""
    size, known = max(1, len(hot)), Hot(hot)

    def run(batches):
        import pyarrow as pa

        for _, _, lengths, w in _blocks(batches):
            y = known.places(w)
            x = _before(lengths, y, known.places(np.array([START], np.uint64))[0])
            both = (x > 0) & (y > 0)
            code, n = np.unique((x[both].astype(np.int64) - 1) * size + y[both] - 1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    rows = sorted(docs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect())
    return np.array([r["code"] for r in rows], np.uint64), np.array([r["n"] for r in rows], np.uint64)


def score(docs: DataFrame, alpha: float = 0.4, min_count: int = 2, hot: int = 2000) -> DataFrame:
    """(doc_id, n_words, log10_score, mean_log10) for every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = 2 * partitions(spark)
    counts = stored(word_counts(docs, parts, hot), "words")
    total = counts.agg(F.sum("total")).first()[0] or 0
    least = max(1.0, total / hot)
    hot_w, hot_n = _hot_words(counts, least)
    pair_codes, pair_n = _hot_pairs(docs, hot_w, max(least, min_count))
    size, known = max(1, len(hot_w)), Hot(hot_w)
    log_total, log_alpha = math.log10(max(1, total)), math.log10(alpha)

    def one_block(number, ids, lengths, v):
        """kind 0: documents (ids, which are null, lengths, sums so far); kind 1: pairs. What it holds goes when it ends."""
        doc = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
        y = known.places(v)
        x = _before(lengths, y, known.places(np.array([START], np.uint64))[0])
        n = np.zeros(len(v), np.uint64)
        both = np.flatnonzero((x > 0) & (y > 0))
        n[both] = _look(pair_codes, pair_n, (x[both].astype(np.uint64) - np.uint64(1)) * np.uint64(size) + y[both] - np.uint64(1))
        done = n > 0
        sums = np.zeros(len(lengths))
        if done.any():
            s = np.log10(n[done].astype(float)) - np.log10(hot_n[x[done].astype(np.int64) - 1].astype(float))
            sums = np.bincount(doc[done].astype(np.int64), weights=s, minlength=len(lengths))
        null = np.array([i is None for i in ids])
        yield _rows([(number % parts, 0, number, np.array([i or 0 for i in ids], np.int64).tobytes(), np.packbits(null).tobytes(),
                      planes(lengths.astype(np.uint32)), sums.tobytes())])
        if not len(v) or done.all():
            return
        names, code = np.unique(np.append(v, np.uint64(START)), return_inverse=True)
        code = code.astype(np.uint64)
        cv, cu, doc = code[:-1][~done], _before(lengths, code[:-1], code[-1])[~done], doc[~done]
        d, k = np.uint64(len(lengths)), np.uint64(len(names))
        entry, times = np.unique((cv * k + cu) * d + doc, return_counts=True)
        pair, first, n_docs = np.unique(entry // d, return_index=True, return_counts=True)
        pv, pu = names[(pair // k).astype(np.int64)], names[(pair % k).astype(np.int64)]
        part = _pair_part(pv, pu, hot_w, parts)
        order = np.argsort(part, kind="stable")
        inner = np.repeat(first[order] - np.append(0, np.cumsum(n_docs[order])[:-1]), n_docs[order]) + np.arange(len(entry))
        docs_of, times_of = (entry % d)[inner].astype(np.uint16), np.minimum(times[inner], 0xFFFFFFFF).astype(np.uint32)
        stops = np.append(0, np.cumsum(n_docs[order]))
        rows = []
        for p, i, j in _slices(part[order], parts):
            o, (s, t) = order[i:j], (stops[i], stops[j])
            before, place = np.unique(pu[o], return_inverse=True)
            rows.append((p, 1, number, ascending(pv[o]), planes(place.astype(np.uint32)), planes(n_docs[o].astype(np.uint32)), planes(docs_of[s:t]),
                         planes(times_of[s:t]), ascending(before)))
        yield _rows(rows)

    def explode(batches):
        for at in _blocks(batches):
            yield from one_block(*at)

    def grams(pdf: pd.DataFrame) -> pd.DataFrame:
        """Scores of pairs. kind 0 passes; kind 2: partial sums (documents, sums) of a block; kind 3: log10 c(u) due (u, blocks, documents, times) in any block."""
        out = [tuple(r) for r in pdf[pdf["kind"] == 0][_NAMES].itertuples(index=False)]
        rows = pdf[pdf["kind"] == 1]
        if len(rows):
            v = [ascended(x) for x in rows["a"]]
            ends = np.cumsum([len(x) for x in v])
            v, u = np.concatenate(v), np.concatenate([ascended(y)[unplaned(x, np.uint32)] for x, y in zip(rows["b"], rows["f"])])
            n_docs = [unplaned(x, np.uint32).astype(np.int64) for x in rows["c"]]
            doc = [unplaned(x, np.uint16) for x in rows["d"]]
            times = [unplaned(x, np.uint32) for x in rows["e"]]
            held = np.concatenate([np.add.reduceat(t, np.append(0, np.cumsum(n)[:-1])) for t, n in zip(times, n_docs)]).astype(float)
            at = np.unique(v, return_inverse=True)[1]
            word_count = np.bincount(at, weights=held)[at]
            known = _look(hot_w, hot_n, v)
            s = log_alpha + np.log10(np.where(known > 0, known, word_count)) - log_total
            at = np.unique(v * np.uint64(0x9E3779B97F4A7C15) + u * np.uint64(0xC2B2AE3D27D4EB4F), return_inverse=True)[1]  # of a 64-bit hash
            del v, known, word_count
            pair_count = np.bincount(at, weights=held)[at]
            hit, before = pair_count >= min_count, _look(hot_w, hot_n, u)
            s[hit] = np.log10(pair_count[hit]) - np.log10(np.maximum(before[hit], 1).astype(float))
            due, owing = hit & (before == 0), []
            del at, held, pair_count, hit, before
            for k, (i, j) in enumerate(zip(np.append(0, ends[:-1]), ends)):
                block = int(rows["block"].iloc[k])
                each = np.repeat(np.arange(i, j), n_docs[k])
                d = doc[k].astype(np.int64)
                some = np.flatnonzero(np.bincount(d))
                out.append((block % parts, 2, block, *_partial(some, np.bincount(d, weights=s[each] * times[k])[some])))
                owed = np.flatnonzero(due[each])
                if len(owed):
                    owing.append((u[each[owed]], np.full(len(owed), block, np.int64), doc[k][owed], times[k][owed]))
            if owing:
                ou, ob, od, ot = (np.concatenate(x) for x in zip(*owing))
                order = np.lexsort((od, ob, ou))
                ou, ob, od, ot = ou[order], ob[order], od[order], ot[order]
                for p, a, b in _slices(_part(ou, parts), parts):
                    numbers, place = np.unique(ob[a:b], return_inverse=True)
                    out.append((p, 3, -1, ascending(ou[a:b]), planes(place.astype(np.uint32)), planes(od[a:b]), planes(ot[a:b]), numbers.tobytes()))
        return _frame(out)

    def settle(pdf: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        """What is due becomes partial sums."""
        out = [tuple(r) for r in pdf[pdf["kind"] != 3][_NAMES].itertuples(index=False)]
        rows = pdf[pdf["kind"] == 3]
        if len(rows):
            u, c = ascended(words["words"].iloc[0]), unplaned(words["counts"].iloc[0], np.uint64)
            block = np.concatenate([np.frombuffer(y, np.int64)[unplaned(x, np.uint32)] for x, y in zip(rows["b"], rows["e"])])
            d = np.concatenate([unplaned(x, np.uint16) for x in rows["c"]]).astype(np.int64)
            n = np.concatenate([_look(u, c, ascended(x)) for x in rows["a"]]).astype(float)
            owed = -np.log10(n) * np.concatenate([unplaned(x, np.uint32) for x in rows["d"]])
            numbers, place = np.unique(block, return_inverse=True)
            key, at = np.unique(place * (1 << 16) + d, return_inverse=True)
            sums = np.bincount(at, weights=owed)
            for k, a, b in _slices(key >> 16, len(numbers)):
                out.append((int(numbers[k]) % parts, 2, int(numbers[k]), *_partial(key[a:b] & 0xFFFF, sums[a:b])))
        return _frame(out)

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["kind"] == 0].iloc[0]
        ids, lengths = np.frombuffer(head["a"], np.int64), unplaned(head["c"], np.uint32).astype(np.int64)
        null = np.unpackbits(np.frombuffer(head["b"], np.uint8))[:len(ids)].astype(bool)
        sums = np.frombuffer(head["d"], float).copy()
        for r in pdf[pdf["kind"] == 2].sort_values(["a", "b"]).itertuples():
            some, values = _partials(r.a, r.b)
            sums[some] += values
        return pd.DataFrame({"doc_id": pd.array([None if x else int(i) for x, i in zip(null, ids)], "Int64"),
                             "n_words": lengths, "log10_score": sums,
                             "mean_log10": pd.array([s / n if n else None for s, n in zip(sums, lengths)], "Float64")})

    ship(spark)
    scored = (docs.mapInArrow(explode, _ROW).groupBy("part").applyInPandas(grams, _ROW).groupBy("part")
              .cogroup(counts.select(F.col("part").alias("words_part"), "words", "counts").groupBy("words_part")).applyInPandas(settle, _ROW))
    return scored.groupBy("block").applyInPandas(finish, "doc_id long, n_words long, log10_score double, mean_log10 double")


_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
     grams AS (SELECT r, unnest(list_prepend('', w[:-2])) AS u, unnest(w) AS v FROM docs WHERE len(w) > 0),
     pairs AS (SELECT u, v, count(*) AS n FROM grams GROUP BY u, v),
     words AS (SELECT v AS w, count(*) AS n FROM grams GROUP BY v),
     befores AS (SELECT w AS u, n FROM words UNION ALL SELECT '', count(*) FROM docs WHERE len(w) > 0),
     scores AS (SELECT pairs.u, pairs.v, CASE WHEN pairs.n >= 2 THEN log10(pairs.n) - log10(befores.n)
        ELSE log10(0.4) + log10(words.n) - log10((SELECT sum(n) FROM words)) END AS s
        FROM pairs JOIN words ON pairs.v = words.w JOIN befores ON pairs.u = befores.u),
     sums AS (SELECT r, sum(s) AS s FROM grams JOIN scores USING (u, v) GROUP BY r)
SELECT doc_id, len(w) AS n_words, round(coalesce(s, 0), 4) AS log10_score, round(s / len(w), 4) AS mean_log10
FROM docs LEFT JOIN sums USING (r)
"""


@query("op1_lm_score", _SQL)
def op1_lm_score(spark, sf_dir):
    """Stupid-backoff score of every document under the corpus's own bigram counts."""
    return score(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("log10_score", 4).alias("log10_score"), F.round("mean_log10", 4).alias("mean_log10"))
