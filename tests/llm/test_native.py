"""Fingerprints, pseudonyms, secrets, quality rules and mixing against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loadtide.llm import line_rules, mixing, pii, secrets, syncmers, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def test_sums_before(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        values = [(i * 7) % 11 for i in range(n)]
        got = spark.createDataFrame([(values,)], "v array<int>").select(text.sums_before(F.col("v"), 256)).first()[0]
        assert got == [sum(values[:i]) for i in range(n)]


def test_permutations_are_bijections(spark):
    for n in (1, 2, 3, 7, 100, 1023):
        rows = spark.range(n).select(text.permuted_index(F.col("id"), F.lit(n), lambda h, i: F.xxhash64(F.lit("k"), i, h)).alias("x")).collect()
        assert sorted(r.x for r in rows) == list(range(n))


# fingerprints

def _edited(rows):
    """For rows with different ids: id -> edited text."""
    ids = sorted(rows, reverse=True)
    out = {}
    for a, b in zip(ids, ids[1:] + ids[:1]):
        k = len(rows[a]) // 3
        out[a] = rows[a][:len(rows[a]) - k] + rows[b][:k]
    return out


def test_fingerprints_of_edited_texts(documents):
    got = syncmers.compare_with_edited(documents).collect()
    rows = {r.doc_id: r.text or "" for r in documents.collect()}
    want = _edited(rows)
    assert len(got) == len(rows)
    assert all(r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest() and r.n_chars == len(rows[r.doc_id]) for r in got)
    by_text = defaultdict(set)
    for r in got:
        by_text[rows[r.doc_id]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited for r in long) / len(long) > 0.55
    assert sum(r.near_next for r in long) / len(long) < 0.05
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


def test_anchors_do_not_depend_on_what_stands_around(spark):
    rows = [(1, "aa bb cc dd ee ff gg hh ii jj kk ll mm"), (2, "xx yy aa bb cc dd ee ff gg hh ii jj kk ll mm zz")]
    sets = {r.doc_id: set(r.s) for r in spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", syncmers.sketch(F.col("text")).alias("s")).collect()}
    own, other = sets[1], sets[2]
    assert len(own & other) >= len(own) - 4  # all but those that reach into the filled-up start


def test_fingerprints_of_odd_rows(odd, empty):
    got = syncmers.compare_with_edited(odd).collect()
    assert len(got) == odd.count() and syncmers.compare_with_edited(empty).count() == 0
    assert {r.fingerprint for r in got if r.n_chars == 0} == {""}
    one = syncmers.compare_with_edited(odd.where("doc_id = 4")).collect()
    assert one[0].near_next == 1.0  # the first is its own next


# pseudonyms

def test_pseudonyms_keep_format_links_and_check_digits(spark):
    rows = [(1, "card 4111111111111111 and 4111-1111-1111-1111, not 4111111111111112; 2024-02-29 2023-02-29 31.12.1999"),
            (2, "again 4111111111111111 4111111111111111 a.b7@x.org 10.0.0.255 10.0.0.256 +1 (402) 555-7713 97.51.17.173"),
            (3, "SSN 123-45-6789 000-12-3456 DE89370400440532013000 GB82 WEST 1234 5698 7654 32 end 2024-02-29"), (4, None), (5, "")]
    got = {r.doc_id: r for r in pii.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[4].text is None and got[5].text == "" and got[5].pii_kinds == []
    assert got[1].pii_kinds == ["card", "card", "date", "date"]
    assert got[2].pii_kinds == ["card", "card", "email", "ip", "phone", "ip"]
    assert got[3].pii_kinds == ["ssn", "iban", "iban", "date"]
    card = re.search(r"\d{16}", got[1].text)[0]
    assert got[2].text.count(card) == 2 and card != "4111111111111111" and "4111111111111112" in got[1].text
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert "2023-02-29" in got[1].text and "10.0.0.256" in got[2].text and "000-12-3456" in got[3].text
    for iban in re.findall(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?", got[3].text):
        s = iban.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    date = re.search(r"\d{4}-\d\d-\d\d", got[1].text)[0]
    assert got[3].text.endswith(date)
    other = pii.replaced(spark.createDataFrame(rows[:1], "doc_id long, text string"), "another").first()
    assert other.text != got[1].text


def test_pseudonyms_are_injective(spark):
    df = spark.range(2000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("s"))
    got = df.select(pii.permuted_symbols(F.col("s"), "k", F.lit("x")).alias("p")).distinct().count()
    days = spark.range(0, 73_051, 7).select(F.date_format(F.expr("date_add(date'1900-01-01', int(id))"), "yyyy-MM-dd").alias("s"))
    dates = days.select(pii.pseudonym(F.col("s"), F.lit("date"), "k").alias("p")).where("p IS NOT NULL").distinct().count()
    assert got == 2000 and dates == days.where("s < '2100-01-01'").count()


def test_pseudonyms_leave_other_texts_alone(documents, odd, empty):
    got = {r.doc_id: r for r in pii.replaced(documents, "k").collect()}
    for r in documents.collect():
        if not got[r.doc_id].pii_kinds:
            assert got[r.doc_id].text == r.text
    assert pii.replaced(odd, "k").count() == odd.count() and pii.replaced(empty, "k").count() == 0
    assert pii.replaced(odd, "k").columns == odd.columns + ["pii_kinds"]


# secrets

def _base(t):
    t, out = t or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def test_base_spans(documents, odd, empty):
    for docs in (documents, odd):
        rows = Counter((r.doc_id, r.text, tuple(tuple(s) for s in r.base_spans)) for r in secrets.scan(docs).collect())
        assert rows == Counter((r.doc_id, r.text, tuple(_base(r.text))) for r in docs.collect())
    assert secrets.scan(empty).count() == 0 and secrets.masked(empty).columns == empty.columns


def _p(f, a):
    tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    x, n, k = [a.index(c) for c in f], len(f), len(a)
    chi = sum(f.count(c) ** 2 for c in a) * k / n - n
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    hi = sum(v * 2 >= k for v in x)
    lo, turns = n - hi, sum((p * 2 >= k) != (q * 2 >= k) for p, q in zip(x, x[1:]))
    pr = 2 * hi * lo
    var = pr * (pr - n) / (n * n * (n - 1)) if hi and lo else 0
    runs = 0 if not (hi and lo) else 1 if var <= 0 else 2 * tail(abs(turns + 1 - (1 + pr / n)) / math.sqrt(var))
    m = (k - 1) / 2
    serial = 2 * tail(abs(sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / ((k * k - 1) / 12 * math.sqrt(n - 1))))
    return min(1, 3 * min(1 if z <= 0 else tail(z), runs, serial))


def test_battery(spark):
    strings = ["thewordsareverylonginthistext1", "0f3a9b7c" * 5, "A" * 30 + "1", "Zq81Lm0xVt7RbKp3Ws9Yc2Hd"]
    rows = spark.createDataFrame([(s,) for s in strings], "f string").select(
        "f", secrets.encoding(F.col("f")).alias("e"), secrets.p_value(F.col("f"), secrets.encoding(F.col("f"))).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(_p(r.f, secrets.ENCODINGS[r.e][2]), rel=5e-3, abs=1e-12)


def test_random_strings_are_found_and_masked(spark):
    import random
    rnd = random.Random(5)
    key = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(48))
    rows = [(1, f"é🎉 here {key} stands", 60), (2, "see " + "xy12" * 10 + " end", 48), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    assert [(s.start, s.stop) for s in got[1].random_spans] == [(8, 56)] and got[2].random_spans == []
    clean = {r.doc_id: r for r in secrets.masked(df).collect()}
    assert clean[1].text == "é🎉 here [SECRET] stands" and clean[1].n_chars == len(clean[1].text)
    assert clean[2].text == rows[1][1] and clean[3].text is None


def test_ordinary_strings_do_not_hide_random_ones(spark):
    """Among very many strings of words no more random ones are set aside than the level lets through."""
    import random
    rnd = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["a1" + "".join(rnd.choice(letters) for _ in range(38)) for _ in range(200)]
    rows = [(i, k) for i, k in enumerate(keys)] + [(1000 + i, f"Thename{i}ofathingthatisnotasecret{i}inanyway") for i in range(4000)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).where("doc_id < 1000")
    assert got.where(F.size("random_spans") == 1).count() >= 199


# quality rules

def _measures(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    c, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if c[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(covered)


def test_measures(documents, odd, empty):
    for docs in (documents, odd):
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in line_rules.judge(docs).collect())
        assert got == Counter((r.doc_id, *_measures(r.text)) for r in docs.collect())
    assert line_rules.judge(empty).count() == 0 and line_rules.passing(empty).columns == empty.columns


def test_normalised_lines(spark):
    t = " A  b\tc \n\n a b C\r\nX\n  \x0b\nx y"
    got = spark.createDataFrame([(t,), ("",), (" \n ",)], "t string").select(line_rules.distinct_lines(F.col("t"))).collect()
    assert [r[0] for r in got] == [["a b c", "x", "x y"], [], []]


def test_line_rule(spark):
    """A line of 30 documents of one host is boilerplate there, not elsewhere, and not for copies of one text."""
    prose = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    menu = " ".join(f"entry{j}" for j in range(60))
    rows = [(i, menu + "\n" + prose(i, 60), "a") for i in range(30)]
    rows += [(100 + i, menu + "\n" + prose(i + 100, 8), "a") for i in range(2)]
    rows += [(200, menu + "\n" + prose(500, 5), "b")]
    rows += [(300 + i, "\n".join(prose(900 + k, 20) for k in range(5)) + f"\nlast {i}", "c") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in line_rules.judge(docs).collect()}
    assert all(got[i].kept and got[i].n_boiler == 60 for i in range(30))
    assert not got[100].base_failed and not got[100].kept and not got[101].kept
    assert got[200].kept and all(got[300 + i].kept for i in range(40))
    assert sorted(r.doc_id for r in line_rules.passing(docs).collect()) == sorted(i for i, r in got.items() if r.kept)
    texts = {r[0]: r[1] for r in rows}
    clean = {r.doc_id: r for r in line_rules.passing(docs.withColumn("n_chars", F.length("text")), remove_lines=True).collect()}
    assert set(clean) == {i for i, r in got.items() if r.kept}
    assert all(r.text == (prose(i, 60) if i < 30 else texts[i]) and r.n_chars == len(r.text) for i, r in clean.items())


def test_line_rule_counts_documents_that_share_a_word(spark):
    """Unrelated texts with the same few common words count each; near copies of one count once, for the line and the host."""
    word = lambda i, j: f"w{(i * 7919 + j * j * 31 + i * j) % 997}"
    prose = lambda i: " ".join("the of and".split() + [word(i, j) for j in range(60)])
    rows = [(i, "a line of the host\n" + prose(i), "a") for i in range(300)]
    rows += [(1000 + i, "a line of copies\n" + prose(5000) + f" last{i}", "a") for i in range(200)]
    rows += [(2000 + i, prose(9000 + i), "a") for i in range(100)]
    lines = line_rules.line_table(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    counts = lines.select("label", F.explode("lines.line").alias("line")).groupBy("line").agg(F.countDistinct("label").alias("n"))
    assert sorted(r.n for r in counts.collect())[-2:] == [1, 300]
    assert [(r.host, r.n_docs) for r in line_rules.boilerplate(lines).collect()] == [("a", 300)]
    assert [r.n_docs for r in line_rules.boilerplate(lines, max_share=0.74).collect()] == [300]  # of 401 documents, not of 600 rows


def _alike(s, t, most=128):
    limit = min([x[-1] for x in (s, t) if len(x) == most], default=float("inf"))
    a, b = ({v for v in x if v <= limit} for x in (s, t))
    return len(a & b) >= 0.8 * len(a | b)


def test_copies_lose_no_link(spark):
    """Pairs of near copies that share a long passage with many others, and short texts that differ in a line: classes as by brute force."""
    rnd = random.Random(5)
    prose = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    shared, texts = prose(400), []
    for _ in range(150):
        own = prose(110)
        texts.append(own + shared)
        for i in rnd.sample(range(110), 4):
            own = own[:i] + prose(1) + own[i + 1:]
        texts.append(own + shared)
    short = [prose(6) for _ in range(30)]
    texts += [sum(rnd.sample(short, k), []) for k in (9, 10, 11, 12) for _ in range(30)]
    docs = spark.createDataFrame([(i, " ".join(t), "a") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = line_rules.document_table(docs)
    sketch = {bytes(r.node): list(r.sketch) for r in rows.collect()}
    up = {k: k for k in sketch}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sketch)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if top(a) != top(b) and _alike(sketch[a], sketch[b]):
                up[top(a)] = top(b)
    label = {bytes(r.node): bytes(r.label) for r in line_rules.copies(rows).collect()}
    classes = lambda name: Counter(frozenset(g) for g in _grouped(keys, name))
    assert classes(lambda k: label.get(k, k)) == classes(top)
    assert len({top(k) for k in keys}) < len(keys) - 100


def test_variants_of_a_text_are_not_all_paired(spark, monkeypatch):
    """Of a text's many variants, some of them cut or drawn out, few pairs are compared, and the classes are those of all pairs."""
    rnd = random.Random(11)
    prose = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    base, texts, tried, linked = prose(220), [], [], line_rules._linked
    for i in range(260):
        own = list(base)
        for at in rnd.sample(range(220), rnd.randrange(1, 14)):
            own[at] = prose(1)[0]
        texts.append(own[:rnd.randrange(60, 140)] if i % 13 == 0 else own + prose(rnd.randrange(40)) if i % 7 == 0 else own)
    docs = spark.createDataFrame([(i, " ".join(t), "a") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = line_rules.document_table(docs)
    sketch = {bytes(r.node): list(r.sketch) for r in rows.collect()}
    monkeypatch.setattr(line_rules, "_linked", lambda pairs, *rest: (tried.append(pairs.distinct().count()), linked(pairs, *rest))[1])
    label = {bytes(r.node): bytes(r.label) for r in line_rules.copies(rows).collect()}
    groups = {k: {k} for k in sketch}
    for a in sketch:
        for b in sketch:
            if a < b and groups[a] is not groups[b] and _alike(sketch[a], sketch[b]):
                groups[a] |= groups[b]
                for k in groups[b]:
                    groups[k] = groups[a]
    assert {frozenset(g) for g in _grouped(sketch, lambda k: label.get(k, k))} == {frozenset(g) for g in groups.values()}
    assert len({id(g) for g in groups.values()}) > 60 and tried[-1] < len(sketch) ** 2 / 2 / 10


def _grouped(keys, name):
    groups = {}
    for k in keys:
        groups.setdefault(name(k), []).append(k)
    return groups.values()


# mixing

def test_targets():
    assert mixing.targets([10, 100], (5, 2, 1), 1.5, 2.0) == [20.0, 145.0]
    assert mixing.targets([], (5, 2, 1), 1.5, 2.0) == [] and mixing.targets([0, 0], (5, 2, 1), 1.5, 2.0) == [0.0, 0.0]


def test_mix(documents):
    got = mixing.mix(documents).documents.collect()
    sizes = {r.doc_id: len(words(r.text)) for r in documents.collect()}
    source = {r.doc_id: r.source for r in documents.collect()}
    assert {r.doc_id: r["size"] for r in got} == sizes
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    want, taken, total = {}, Counter(), Counter()
    for r in got:
        want[source[r.doc_id]] = r.target
        taken[source[r.doc_id]] += r.taken
        total[source[r.doc_id]] += r["size"]
    names = sorted(want)
    assert [want[s] for s in names] == pytest.approx(mixing.targets([total[s] for s in names], (5, 2, 1), 1.5, 2.0))
    assert all(abs(taken[s] - want[s]) <= 3 * 64 for s in names)
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(documents).documents.collect()) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mix(odd).documents.collect()
    assert len(got) == odd.count() and all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix(empty).documents.count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns and mixing.mixed_documents(empty).count() == 0


def test_blocks_of_a_pass_are_taken_once(documents):
    m = mixing.mix(documents, block_words=16)
    times = m.slots.groupBy("source_no", "block").count().agg(F.max("count")).first()[0]
    assert times <= 2
    assert m.slots.count() == m.slots.select("shard", "source_no", "slot").distinct().count()
