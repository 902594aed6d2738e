"""Scores, pages, records, near duplicates and pieces against brute force and the libraries."""

import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadtide.llm import html_main, lm_scoring, near_dedup, pieces, records

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def split(t):
    return (t or "").encode().lower().split()


# scores

def _scores(rows, alpha=0.4, min_count=2):
    texts = [split(t) for _, t in rows]
    one = Counter(w for ws in texts for w in ws)
    total = sum(one.values())
    one[b""] = sum(1 for ws in texts if ws)
    two = Counter(g for ws in texts for g in zip([b"", *ws], ws))
    return sorted((-1 if i is None else i, len(ws), round(sum(
        math.log10(two[u, v]) - math.log10(one[u]) if two[u, v] >= min_count else math.log10(alpha) + math.log10(one[v]) - math.log10(total)
        for u, v in zip([b"", *ws], ws)), 3)) for (i, _), ws in zip(rows, texts))


@pytest.mark.parametrize("hot", [3, 2000])
def test_scores(documents, odd, empty, hot):
    for docs in (documents, odd):
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, round(r.log10_score, 3)) for r in lm_scoring.score(docs, hot=hot).collect())
        want = _scores([(r.doc_id, r.text) for r in docs.collect()])
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(abs(g[2] - w[2]) < 2e-3 for g, w in zip(got, want))
    assert lm_scoring.score(empty).count() == 0


def test_no_partition_gets_all_pairs_of_a_hot_context():
    """Pairs of two hot words are dealt by the pair; others by the word that is not hot, the predicted one first."""
    hot = np.sort(np.array([i * 0x9E3779B97F % (1 << 48) for i in range(1, 1301)], np.uint64))
    v, u = np.tile(hot, 2), np.repeat(hot[[7, 8]], len(hot))
    sizes = np.bincount(lm_scoring._pair_part(v, u, hot, 20), minlength=20)
    assert sizes.min() > 80 and sizes.max() < 200
    rare = np.array([5 << 40, 9 << 40, 200 << 40], np.uint64)
    assert list(lm_scoring._pair_part(rare, hot[:3], hot, 20)) == list(lm_scoring._part(rare, 20))
    assert list(lm_scoring._pair_part(hot[:3], rare, hot, 20)) == list(lm_scoring._part(rare, 20))
    assert list(lm_scoring._pair_part(rare, rare[::-1], hot, 20)) == list(lm_scoring._part(rare, 20))
    assert list(lm_scoring._pair_part(rare, rare, hot[:0], 20)) == list(lm_scoring._part(rare, 20))


# pages

def _article(page):
    inner = page[page.index("<article>") + 9:]
    inner = re.sub(r"</?b>", "", inner.partition("</article>")[0])
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", inner))
    return "\n".join(b for b in blocks if b)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_main.extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == _article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_pages_without_marks():
    long = "a sentence of some length that goes on and on, " * 8
    page = (f"<body><div id=wrap><div class='nav'><a href=x>menu</a></div><ul><li><a href=1>one</a><li><a href=2>two</a></ul><div><h1>Title</h1><p>{long}</p><p>short</p>"
            f"<div class='cookie-notice'>{long}</div><p>{long} &eacute;&#128512;</p></div><section id=comments><p>{long}</p></section><form>{long}</form><div class=footer>f</div></div>")
    want = long.strip()
    assert html_main.main_text(page) == f"Title\n{want}\nshort\n{want} é😀"


def test_pages_with_parts_inside_the_article():
    page = "<article><header><h1>T</h1></header><p>x&nbsp;y <aside>no</aside><div class='ad'>no</div><p>z<br>w<script>a</script></p><section class='comments'><p>c</p></section></article><article class=comment>d</article>"
    assert html_main.main_text(page) == "T\nx y\nz w"


def test_marks_and_names_are_evidence():
    """Teaser articles don't replace a text in plain divs, nor do names of a wrapper empty the page."""
    long = "a sentence of some length that goes on and on, " * 8
    want = long.strip()
    cards = "".join(f"<article class=teaser><h3><a href={i}>title {i}</a></h3><p>short {i}</p></article>" for i in range(4))
    body = f"<div><h1>Title</h1><div>{long}</div><div>{long}</div></div>"
    assert html_main.main_text(f"<body>{body}<div>{cards}</div></body>") == f"Title\n{want}\n{want}"
    assert html_main.main_text(f"<body><div class='has-sidebar'>{body}</div></body>") == f"Title\n{want}\n{want}"
    assert html_main.main_text(f"<body><div class='layout-sidebar'>{body}</div></body>") == f"Title\n{want}\n{want}"
    marked = f"<article><h1>T</h1><p>{long}</p><p>end</p></article>"
    assert html_main.main_text(f"<body><main>{marked}<div>{cards}</div></main></body>") == f"T\n{want}\nend"


def test_odd_pages(spark):
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<p a=1 <x> <<p>> </ p> <!-- c <![CDATA[ x"), (2, "u", "<p>" * 3000 + "deep" + "</div>" * 50)]
    got = html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 4 and [r.text for r in got[:2]] == ["", ""] and got[3].text == "deep"


def test_threshold_and_smoothing():
    assert html_main.threshold([1, 1, 9, 11]) == pytest.approx(5.5)
    assert html_main.smoothed([2, 2, 2], 1.0) == pytest.approx([2, 2, 2])


# records

def test_checksums():
    assert records.crc32c([b"123456789"]).tolist() == [0xE3069283]
    def slow(b):
        v = 0xFFFFFFFF
        for x in b:
            v = int(records._T[(v ^ x) & 255]) ^ (v >> 8)
        return v ^ 0xFFFFFFFF
    rnd = random.Random(1)
    parts = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 1, 3, 4, 5, 511, 512, 513, 1500)]
    assert records.crc32c(parts).tolist() == [slow(p) for p in parts]


def test_damage_is_seen():
    data = b"".join(records.framed([b"abc", b"defgh" * 9]))
    assert records.unframed(data, [19, 0]) == [b"defgh" * 9, b"abc"]
    with pytest.raises(ValueError):
        records.unframed(data[:20] + b"!" + data[21:], [0, 19])


def _order(r):
    return (r[0] is not None, r[0] or 0)


def test_records(spark, documents, odd, empty, tmp_path):
    library = Tokenizer.from_file(BYTES)
    for k, docs in enumerate((documents, odd, empty)):
        records.write_records(docs, str(tmp_path / f"r{k}"), BYTES, max_file_bytes=50_000)
        got = sorted(records.read_records(spark, str(tmp_path / f"r{k}")).collect(), key=lambda r: r.start)
        assert [_order(r) for r in got] == sorted(_order(r) for r in docs.collect())
        start = 0
        texts = defaultdict(list)
        for r in docs.collect():
            texts[r.doc_id].append(library.encode(r.text or "", add_special_tokens=False).ids + [0])
        for r in got:
            assert r.ids in texts[r.doc_id] and r.start == start and r.n_tokens == len(r.ids)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            start += len(r.ids)
        shuffled = records.read_records(spark, str(tmp_path / f"r{k}"), seed=5).collect()
        assert Counter(tuple(r.ids) for r in shuffled) == Counter(tuple(r.ids) for r in got)


def test_words_give_the_librarys_ids():
    encoder, library, rnd = records.Encoder(open(BYTES).read(), keep=100), Tokenizer.from_file(BYTES), random.Random(1)
    parts = ["a", " ", "  ", "\n", "\t", "the", ".", ",", "'s", "é", "1", " ", "　", "🎉", "<|endoftext|>", "Xy"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == want


# near duplicates

def _groups(rows, t):
    sets = []
    for _, x in rows:
        w = split(x)
        sets.append(frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)))
    held = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            held[g].append(k)
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for k, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in held[g] if j > k).items():
            if 1000 * n >= round(1000 * t) * (len(s) + len(sets[j]) - n):
                up[top(k)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted((-1 if i is None else i, len(sets[k]), least.get(top(k), -1)) for k, (i, _) in enumerate(rows)), len({top(k) for k in range(len(sets))})


def _chain(rnd, n, words):
    """Texts of which neighbours differ by one word: one group, though its ends are unlike."""
    w, out = [f"w{rnd.randrange(10**6)}" for _ in range(words)], []
    for i in range(n):
        w[(7 * i) % words] = f"n{i}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_near_duplicates(spark, documents, odd, empty, threshold):
    rnd = random.Random(3)
    chained = spark.createDataFrame([(i, t) for i, t in enumerate(_chain(rnd, 60, 120) + _chain(rnd, 60, 90))], "doc_id long, text string")
    for docs in (documents, odd, chained):
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                     for r in near_dedup.near_duplicates(docs, threshold).collect())
        want, n = _groups([(r.doc_id, r.text) for r in docs.collect()], threshold)
        assert got == want
        kept = near_dedup.deduplicated(docs, threshold)
        assert kept.count() == n and kept.columns == docs.columns
    assert near_dedup.near_duplicates(empty, threshold).count() == 0 and near_dedup.deduplicated(empty, threshold).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(f"{rnd.randrange(300):04d}".encode(), f"{rnd.randrange(300):04d}".encode()) for _ in range(200)] + [(f"c{i:03d}".encode(), f"c{i + 1:03d}".encode()) for i in range(64)]
    got = {bytes(r.node): bytes(r.label) for r in near_dedup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        up[top(a)] = top(b)
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    assert set(got) == set(nodes)
    assert all((got[x] == got[y]) == (top(x) == top(y)) for x in nodes for y in nodes[:40])


def test_bands_and_pruning():
    for t in (0.8, 0.85, 0.95):
        assert (1 - t ** near_dedup.rows_per_band(t)) ** near_dedup.BANDS <= 5e-6
    steps = near_dedup.least_matches(0.85, 224, 1e-6)
    assert [n for n, _ in steps] == list(range(32, 225, 32)) and all(0 < m < 0.85 * n for n, m in steps)
    rnd = np.random.default_rng(1)
    lost = sum(any(np.cumsum(rnd.random(224) < 0.85)[n - 1] < m for n, m in steps) for _ in range(2000))
    assert lost == 0


# pieces

@pytest.fixture(scope="module")
def coder():
    return pieces.PrefixTable(open(PIECES, "rb").read(), keep=500)


def test_pieces_of_random_strings(coder):
    rnd = random.Random(1)
    parts = [" ", "  ", "▁", "\n", "a", "the", "tion", "é", "🎉", "x.", "..", "--", "123", "\t", "ß", "的", "\r\n", "<s>", "=====", "ing", "'s", "́"]
    for k in range(6000):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        assert coder.encode(s) == coder.library.encode(s)
    for k in range(200):
        s = " " * rnd.randint(0, 60) + "a" * rnd.randint(0, 3) + " " * rnd.randint(0, 40) + "".join(rnd.choice("abcdehnorst") for _ in range(rnd.randint(0, 300)))
        assert coder.encode(s) == coder.library.encode(s)


def test_pieces_of_documents(coder, documents, odd, empty):
    import hashlib
    for docs in (documents, odd):
        want = Counter()
        for r in docs.collect():
            ids = coder.library.encode(r.text or "")
            want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(coder.library.decode(ids).encode()).hexdigest()] += 1
        assert Counter(tuple(r) for r in pieces.encode(docs, PIECES).collect()) == want
    assert pieces.encode(empty, PIECES).count() == 0
    assert Counter((r.doc_id, tuple(r.ids)) for r in pieces.token_ids(odd, PIECES).collect()) == Counter((r.doc_id, tuple(coder.library.encode(r.text or ""))) for r in odd.collect())
