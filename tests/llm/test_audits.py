"""Source divergence, whitening and chat formatting against brute force, and the template language."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from loadtide.llm import chat_format, source_audit, whitening
from loadtide.llm.template import Template, TemplateError, fold_all, parse

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# sources

def _audit(rows, min_docs=3, best=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang, seen in docs.items():
        kept = [t for t, n in seen.items() if n >= min_docs]
        groups = {s: c for (a, s), c in counts.items() if a == lang}

        def priced(c):
            size = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // size for t in kept}

        p, q = {s: priced(c) for s, c in groups.items()}, priced(sum(groups.values(), Counter()))
        for s in groups:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= best:
                        out.append((lang, s, part, item, value, rank))
    return sorted(out)


@pytest.mark.parametrize("width", [256, 3])
def test_audit(spark, odd, empty, documents, width, monkeypatch):
    monkeypatch.setattr(source_audit, "ROWS", 500)
    for docs in (odd, documents):
        got = sorted(tuple(r) for r in source_audit.audit(docs, width=width).collect())
        assert got == _audit([(r.text, r.lang, r.source) for r in docs.collect()])
    assert source_audit.audit(empty).count() == 0


def test_audit_of_few_columns_and_counts_handed_on(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60))), rnd.choice(["x", None, ""]), rnd.choice("pqrst")) for _ in range(200)]
    rows += [("only once", "alone", "p"), (None, "alone", None), ("x", "none kept", "p"), ("y", "none kept", "q")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(source_audit, "COLUMNS", 7)
    monkeypatch.setattr(source_audit, "HELD", 20)
    monkeypatch.setattr(source_audit, "SLICE", 5)
    tile = source_audit.Tile({"p": 5, "q": 3}, 2, 8, {"p": 0, "q": 0}, True, True, 3)
    assert tile.sums.shape == (2, 2)
    assert sorted(tuple(r) for r in source_audit.audit(docs, best=4).collect()) == _audit(rows, best=4)


def test_terms_of_long_texts_in_slices():
    text = "Ab-" * 900_000 + "é" * 10 + "Z" * (3 << 20)
    parts = list(source_audit.terms(text))
    assert len(parts) > 1 and Counter(w for p in parts for w in p) == Counter(w.encode() for w in TERM.findall(text.translate(LOWER)))


def test_long_division_is_exact():
    count, size = 999_999_999_999, 9_007_199_254_740_881
    assert source_audit.probability(np.array([count]), np.array([size]))[0] == 1 + 10 ** 9 * (count + 1) // size


# whitening

def _whole(rows):
    ok = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    return [i for i, _ in ok], [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in ok]


def _check(spark, rows, kind="float", count=8):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n int").repartition(3)
    got = whitening.whiten(df, count=count).collect()
    ids, x = _whole([(r.vec_id, r.embedding) for r in df.collect()])
    n, dims = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dims)]
    assert len(got) == n * min(count, dims)
    deviation = Counter((i, sum((n * r[j] - sums[j]) ** 2 for j in range(dims))) for i, r in zip(ids, x))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == deviation
    return got, np.array(x, float)


def test_whitening(spark):
    rnd = np.random.default_rng(5)
    mix = rnd.normal(size=(6, 6))
    rows = [(i % 90, [float(np.float32(c)) for c in rnd.normal(size=6) @ mix * 3], 1, 2) for i in range(3000)]
    rows += [(None, rows[0][1], 1, 2), (1, None, 1, 2), (2, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, 2), (3, [1.0, float("nan")] * 3, 1, 2),
             (4, [float("inf")] * 6, 1, 2), (5, [], 1, 2), (6, [1.0], 1, 2)]
    got, x = _check(spark, [r for r in rows if r[0] != 6 or len(r[1]) > 1], count=4)
    assert {r.n for r in got} == {3001} and {r.n for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, l int, k int")).collect()} == {3001}
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    w = ((x - x.mean(0)) @ vectors[:, ::-1][:, :4] / np.sqrt(values[::-1][:4]))
    for k in range(4):
        mine = sorted(r.whitened for r in got if r.component == k + 1)
        assert min(np.abs(np.sort(s * w[:, k]) - mine).max() for s in (1, -1)) < 1e-9
        assert abs(next(r.explained for r in got if r.component == k + 1) - values[::-1][k] / values.sum()) < 1e-9
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_without_variance_or_rows(spark):
    got, _ = _check(spark, [(i, [1.0, 2.0, float(i % 2)], 1, 2) for i in range(9)], count=3)
    assert {r.whitened for r in got if r.component > 1} == {0.0} and max(r.identity_error for r in got) < 1e-9
    assert {r.whitened for r in _check(spark, [(1, [0.5], 0, 0)])[0]} == {0.0}
    assert whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("reach", [3, 5_000_000, 1 << 40])
def test_cross_products_are_exact(spark, reach):
    rnd = random.Random(reach)
    rows = [[rnd.randint(-reach, reach), 7, rnd.randint(0, 3)] for _ in range(700)]
    x = spark.createDataFrame([(r,) for r in rows], "x array<long>").repartition(4)
    n, low, high, sums = whitening.ranges(x)
    assert (n, sums) == (700, [sum(c) for c in zip(*rows)])
    got = whitening.cross_products(x, low, high)
    assert got == [[sum((r[i] - low[i]) * (r[j] - low[j]) for r in rows) for j in range(3)] for i in range(3)]


# templates

def test_template_language():
    t = Template("{# c #}{% set k = 2 * 3 - 1 %}{% for m in items -%}  {{ loop.index }}/{{ loop.length }}:{{ m.a | upper }}"
                 "{% if loop.last %}!{% elif m.a == 'x' and not loop.first %}?{% else %},{% endif %}{% endfor %}{{ k ~ missing ~ [1][0] }}")
    assert t.render(items=[{"a": "q"}, {"a": "x"}, {"a": "z"}])[0] == "1/3:Q,2/3:X?3/3:Z!51"
    assert Template("{{ 'a' if 3 > 2 else b }}{{ x['k'] | default('none') }}{{ 'b' in 'abc' }}").render(x={})[0] == "anonetrue"
    text, spans = Template("a{% generation %}b{{ c }}{% endgeneration %}d{% generation %}{% endgeneration %}").render(c="\n€")
    assert (text, spans) == ("ab\n€d", [(1, 4), (5, 5)])


def test_constants_are_folded():
    tree = fold_all(parse("a{{ 1 + 2 * 3 }}{% if 'x' == 'x' %}b{{ 'c' | upper }}{% else %}{{ y }}{% endif %}{% for i in [] %}z{% endfor %}{{ true and z }}"),
                    {"upper": str.upper})
    assert tree == [("text", "a7bC"), ("print", ("name", "z"))]


@pytest.mark.parametrize("source", [
    "{{ a.__class__ }}", "{{ x.keys }}", "{{ [].append }}"])
def test_no_attributes(source):
    assert Template(source).render(a="s", x={"b": 1})[0] == ""


@pytest.mark.parametrize("source", [
    "{{ f() }}", "{% if a %}", "{% for x in 5 %}{% endfor %}", "{{ 'a' * 9 }}", "{{ 1 // 0 }}", "{{ a | nothing }}", "{{ 'a' < 1 }}", "{% import os %}",
    "{{ " + "(" * 500 + "1" + ")" * 500 + " }}", "{{ [1] }}", "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ 1 ! 2 }}",
    "{{ " + "not " * 3 + "}}", "{{ " + "-" * 5000 + "1 }}", "{{ " + "a ~ " * 5000 + "1 }}"])
def test_errors(source):
    with pytest.raises(TemplateError):
        Template(source).render(a=1)


# chats

def _chats(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((-1 << 62 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        text, spans = chat_format.compiled().render(messages=[{"role": r, "text": t} for _, r, t in turns])
        assert "".join(chat_format.unquote(text[a:b]) for a, b in spans) == learned
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest(), len(text))
    return out


ODD = [(1, 0, "user", None), (1, 1, "assistant", ""), (None, 5, "assistant", "a ## ### #### </turn>\\"), (None, None, None, "</turn>\n### user: x"),
       (2, 3, "a:b\\", "same"), (2, 3, "a:b\\", "same"), (2, 3, "assistant", "tie"), (2, -400, "system", "<\\/turn>"), (3, 0, "assistant", "é🎉" * 700_000),
       (3, 1, "assistant", "#</turn></turn>##"), (-7, 0, "user", chat_format.PLANTED), (-7, 1, "assistant", chat_format.PLANTED)]


def test_chats(spark):
    rnd = random.Random(2)
    bits = ["#", "##", "\\", "</turn>", "<", "/turn>", "\n", "### user: ", ":", "a", "é"]
    rows = ODD + [(50 + k % 40, rnd.randint(0, 9), rnd.choice(["user", "assistant", ":#"]), "".join(rnd.choices(bits, k=rnd.randint(0, 12)))) for k in range(600)]
    rows += [(9, k, ["user", "assistant"][k % 2], f"{k}#") for k in range(2000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, piece string").repartition(5)
    pieces = chat_format.format_chats(df, chars=5000).cache()
    assert pieces.filter("conv_id = 9").count() >= 8
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.read_chats(pieces).collect()}
    assert got == _chats(rows)
    assert chat_format.read_chats(chat_format.format_chats(df.limit(0))).count() == 0


def test_pieces_are_one_rendering(spark):
    source = "<{% for m in messages %}{{ loop.index0 }}{% if loop.first %}F{% endif %}{{ m.text }}{% if loop.last %}L{% endif %}{% endfor %}>"
    df = spark.createDataFrame([(1, k, "r", chr(97 + k % 26)) for k in range(70)] + [(2, 0, "r", "x")], "conv_id long, turn long, role string, text string")
    whole = Template(source)
    texts = defaultdict(str)
    for r in chat_format.format_chats(df, source, piece=8).orderBy("conv_id", "piece").collect():
        texts[r.conv_id] += r.text
    assert texts[1] == whole.render(messages=[{"text": chr(97 + k % 26)} for k in range(70)])[0]
    assert texts[2] == "<0FxL>"
    with pytest.raises(TemplateError):
        chat_format.format_chats(df, "{{ messages | length }}")
