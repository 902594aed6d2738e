"""Secrets in texts: known shapes, and strings that a battery of randomness tests takes for random.

A candidate is a long run of key characters with a digit and a letter. Its encoding is inferred from
its characters; under "symbols independent and uniform over that alphabet" it gets three p-values:
chi-squared of the symbol counts, runs above and below the middle of the alphabet, and the serial
correlation of neighbours. Strings of words fail at least one of them. The smallest, times three, is
the string's p-value. Which strings are *not* random is decided for the whole corpus at once, with
the step-up procedure of Benjamini and Hochberg in every stratum of encoding and length (lengths by
powers of two), so that of the strings set aside at most the share `rate` are random after all. No string
is set aside above the p-value `LEVEL`, however many others are: a random one is lost with about that chance at most.
What remains and holds `min_bits` or more is a secret.

The strata and p-value bins are a fixed number of cells; only their counts reach the driver.
Null texts count as empty. Rows that repeat get equal results, and count as often as they stand
there. Empty tables give empty results. All places count code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .text import chars, let, matches, text_of, upto

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
MASK = "[SECRET]"

# name, what its strings look like, alphabet
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("rand_hex", "[0-9a-f]+", _DIGITS + "abcdef"),
    ("rand_hexu", "[0-9A-F]+", _DIGITS + "ABCDEF"),
    ("rand_b32", "[A-Z2-7]+", _UPPER + "234567"),
    ("rand_low", "[a-z0-9]+", _DIGITS + _LOWER),
    ("rand_up", "[A-Z0-9]+", _DIGITS + _UPPER),
    ("rand_alnum", "[A-Za-z0-9]+", _DIGITS + _UPPER + _LOWER),
    ("rand_b64", "[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    ("rand_b64url", "[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
    ("rand_mixed", ".+", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
KINDS = ("assign", "access", "hex") + tuple(e[0] for e in ENCODINGS)
BIN, BINS = 0.25, 80  # p-values by steps of a quarter of a power of ten, down to 1e-20
LEVEL = 1e-4

SPAN = "struct<start:bigint,rank:int,kind:string,stop:bigint>"


def upper_tail(z: Column) -> Column:
    """P(N > z) for z >= 0 (Abramowitz and Stegun 26.2.17)."""
    t = F.lit(1.0) / (F.lit(1.0) + 0.2316419 * z)
    poly = F.lit(0.0)
    # fixed values of the approximation, highest power first
    for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = (poly + c) * t
    return F.exp(-z * z / 2.0) / math.sqrt(2 * math.pi) * poly


def encoding(found: Column) -> Column:
    """The number of the first encoding that the string's characters allow."""
    out = F.lit(len(ENCODINGS) - 1)
    for i in reversed(range(len(ENCODINGS) - 1)):
        out = F.when(F.regexp_like(found, F.lit(f"^{ENCODINGS[i][1]}$")), F.lit(i)).otherwise(out)
    return out


def _alphabet(enc: Column) -> Column:
    return F.get(F.array(*[F.lit(e[2]) for e in ENCODINGS]), enc)


def p_value(found: Column, enc: Column) -> Column:
    """The battery's p-value of a string under its encoding; small where it is not random."""
    def battery(s: Column) -> Column:
        idx, a, n = s["x"], s["a"], F.size(s["x"]).cast("double")
        size = F.length(a).cast("double")
        squares = F.aggregate(chars(a), F.lit(0.0), lambda t, c: t + F.pow(
            (F.length(s["f"]) - F.length(F.replace(s["f"], c))).cast("double"), F.lit(2.0)))
        free = size - 1.0
        chi = squares * size / n - n
        chi_z = (F.cbrt(F.greatest(chi, F.lit(0.0)) / free) - (1.0 - 2.0 / (9.0 * free))) / F.sqrt(2.0 / (9.0 * free))
        chi_p = F.when(chi_z <= 0, F.lit(1.0)).otherwise(upper_tail(chi_z))
        # runs above and below the middle
        high = F.size(F.filter(idx, lambda x: x * 2 >= size)).cast("double")
        low = n - high
        turns = F.size(F.filter(upto(F.size(idx) - 1), lambda i: (F.get(idx, i) * 2 >= size) != (F.get(idx, i + 1) * 2 >= size)))
        pairs = 2.0 * high * low
        var = pairs * (pairs - n) / (n * n * (n - 1.0))
        run_z = F.abs(turns + 1.0 - (1.0 + pairs / n)) / F.sqrt(var)
        run_p = F.when((high < 1) | (low < 1), F.lit(0.0)).when(var <= 0, F.lit(1.0)).otherwise(2.0 * upper_tail(run_z))
        # correlation of neighbours, against the alphabet's own mean and variance
        mean, spread = (size - 1.0) / 2.0, (size * size - 1.0) / 12.0
        cross = F.aggregate(upto(F.size(idx) - 1), F.lit(0.0),
                            lambda t, i: t + (F.get(idx, i) - mean) * (F.get(idx, i + 1) - mean))
        ser_p = 2.0 * upper_tail(F.abs(cross / (spread * F.sqrt(n - 1.0))))
        return F.least(F.lit(1.0), 3.0 * F.least(chi_p, run_p, ser_p))

    alphabet = _alphabet(enc)
    return let(F.struct(found.alias("f"), alphabet.alias("a")), lambda s: let(
        F.struct(s["f"].alias("f"), s["a"].alias("a"),
                 F.transform(chars(s["f"]), lambda c: F.instr(s["a"], c) - 1).alias("x")),
        battery))


def candidates(text: Column) -> Column:
    """Array of (start, stop, found, enc, octave, bin) for all strings to be tested."""
    raw = F.filter(matches(text, CANDIDATE), lambda m: F.regexp_like(m["found"], F.lit("[0-9]")) & F.regexp_like(m["found"], F.lit("[A-Za-z]")))

    def tested(m: Column) -> Column:
        return let(encoding(m["found"]), lambda enc: F.struct(
            m["start"].alias("start"), m["stop"].alias("stop"), m["found"].alias("found"), enc.alias("enc"),
            F.floor(F.log2(F.length(m["found"]).cast("double"))).cast("int").alias("octave"),
            F.least(F.lit(BINS), F.floor(-F.log10(F.greatest(p_value(m["found"], enc), F.lit(1e-300))) / BIN)).cast("int").alias("bin")))

    return F.transform(raw, tested)


def not_random(docs: DataFrame, rate: float = 0.2) -> dict[tuple[int, int], int]:
    """For every stratum (encoding, octave of length) the p-value bin from which strings are set aside."""
    cells = (docs.select(F.inline(candidates(text_of("text")))).groupBy("enc", "octave", "bin").agg(F.count(F.lit(1)).alias("n"))).collect()
    out: dict[tuple[int, int], int] = {}
    first = math.ceil(-math.log10(LEVEL) / BIN - 1e-9)
    for stratum in {(c["enc"], c["octave"]) for c in cells}:
        counts = {c["bin"]: c["n"] for c in cells if (c["enc"], c["octave"]) == stratum}
        total, below = sum(counts.values()), 0
        for b in sorted((b for b in counts if b >= first), reverse=True):
            below += counts[b]
            if 10 ** (-b * BIN) * total <= rate * below:  # the bin's largest p-value
                out[stratum] = b
    return out


def _base(text: Column) -> Column:
    """Spans of the known shapes in order."""
    def spans(found: Column, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                     F.lit(kind).alias("kind"), m["stop"].alias("stop")))

    return F.array_sort(F.concat(
        spans(F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 8), "assign"),
        spans(F.filter(matches(text, ACCESS), lambda m: F.length(m["found"]) >= 16), "access"),
        spans(matches(text, HEX), "hex")).cast(f"array<{SPAN}>"))


def _random(text: Column, aside: dict[tuple[int, int], int], min_bits: float) -> Column:
    """(start, stop, found, rank) of the strings that the battery takes for random."""
    bits = F.array(*[F.lit(math.log2(len(e[2]))) for e in ENCODINGS])
    limits = F.create_map(*[x for (enc, octave), b in sorted(aside.items()) for x in (F.lit(enc * 100 + octave), F.lit(b))]) if aside else None

    def kept(m: Column) -> Column:
        enough = F.length(m["found"]) * F.get(bits, m["enc"]) >= min_bits
        if limits is None:
            return enough
        return enough & (m["bin"] < F.coalesce(F.try_element_at(limits, m["enc"] * 100 + m["octave"]), F.lit(BINS + 1)))

    return F.filter(candidates(text), kept)


def scan(docs: DataFrame, rate: float = 0.2, min_bits: float = 100.0, aside: dict[tuple[int, int], int] | None = None) -> DataFrame:
    """All columns of the input, then `base_spans` and `random_spans`: arrays of (start, rank, kind, stop).

    Random strings that touch a known shape are left out: they are found already. `aside` is what
    `not_random` gave for this corpus.
    """
    aside = not_random(docs, rate) if aside is None else aside
    names = F.array(*[F.lit(k) for k in KINDS])

    def added(s: Column) -> Column:
        fresh = F.filter(s["r"], lambda m: ~F.exists(s["b"], lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
        return F.struct(s["b"].alias("base"), F.transform(fresh, lambda m: F.struct(
            m["start"].alias("start"), (m["enc"] + 3).alias("rank"), F.get(names, m["enc"] + 3).alias("kind"),
            m["stop"].alias("stop"))).cast(f"array<{SPAN}>").alias("random"))

    text = text_of("text")
    row = docs.select(F.struct(*docs.columns).alias("row"), let(
        F.struct(_base(text).alias("b"), _random(text, aside, min_bits).alias("r")), added).alias("s"))
    return row.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("base_spans", "random_spans")],
                      F.col("s.base").alias("base_spans"), F.col("s.random").alias("random_spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def masked(docs: DataFrame, rate: float = 0.2, min_bits: float = 100.0) -> DataFrame:
    """The documents with every secret in their text replaced by `MASK` and `n_chars` counted anew; no row is dropped.

    Values of assignments keep their name. Null texts stay null.
    """
    aside = not_random(docs, rate)
    text = F.col("row.text")

    def replaced(t: Column) -> Column:
        known = F.regexp_replace(t, "(" + ASSIGN.rpartition("(")[0] + r")[A-Za-z0-9+/_.=-]{8,}", "$1" + MASK)
        known = F.regexp_replace(F.regexp_replace(known, ACCESS.replace("+", "{12,}"), MASK), HEX, MASK)
        return let(known, lambda k: F.aggregate(
            F.array_distinct(F.transform(_random(k, aside, min_bits), lambda m: m["found"])), k,
            lambda out, found: F.replace(out, found, F.lit(MASK))))

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.select("row", replaced(text).alias("clean"))
    return rows.select(*[F.col("clean").alias(c) if c == "text" else
                         F.when(text.isNull() | (text == F.col("clean")), F.col("row.n_chars")).otherwise(F.length("clean")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                         F.col(f"row.`{c}`").alias(c) for c in docs.columns])


@query("op4_secrets")
def op4_secrets(spark, sf_dir):
    """Known secret shapes and random strings in every whole text."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base_spans", "random_spans"))).alias("spans"),
        F.size("random_spans").cast("long").alias("n_random"))
