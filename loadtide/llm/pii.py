"""Personal data replaced by format-preserving pseudonyms.

Strings of known shapes are found and validated: card numbers (Luhn), IBANs (mod 97), phone numbers, social
security numbers, IPv4 addresses, dates that exist, and e-mail addresses. The digits (letters, octets, day
number) of a valid one go through a keyed Feistel network over symbols: each round shifts every
symbol of one half by a keyed hash of the other half, within the symbol's own range. So a pseudonym has the
format of its original (check digits are computed anew), the same key gives equal values equal pseudonyms in
every document, and different values stay different. Separators, country codes and mail domains stay.

Every shape has a left boundary and a greatest length (64 characters before an @), so a very long text costs its length, also where it
is one token without a space. Ties: of shapes that begin at one place the first in the list wins, and a string belongs to one shape.
Null texts stay null and hold nothing; empty ones stay empty. Rows that repeat get equal results. Empty tables
give empty results. `replaced` keeps all other columns. Places count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .text import chars, let, matches, permuted

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,63}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[0-9]{1,3})?)(?![A-Za-z0-9])"
IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?!(?!T[0-9]{2}:)[0-9A-Za-z])"
PHONE = (r"(?<![0-9A-Za-z])(?:\+1[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}"
         r"|\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9](?:[\x20.-]?[0-9]){5,12}"
         r"|(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])")
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"
CARD = (r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|(?:[0-9]{4}-){3}[0-9]{4}|(?:[0-9]{4}\x20){3}[0-9]{4}"
        r"|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{4}\x20[0-9]{6}\x20[0-9]{5})(?![0-9A-Za-z])")
SHAPES = {"email": EMAIL, "iban": IBAN, "ip": IP, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
KINDS = tuple(SHAPES)
ANY = "|".join(f"(?:{p})" for p in SHAPES.values())
DIGITS, LOWERS, UPPERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, SPANS = "1900-01-01", (319, 229)  # 319 x 229 days: up to 2099-12-31


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn weights of a string of digits, the last one with weight one."""
    return let(F.reverse(chars(digits)), lambda d: F.aggregate(
        F.transform(d, lambda c, i: let(c.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v))),
        F.lit(0), lambda t, x: t + x))


def mod97(s: Column) -> Column:
    """Remainder by 97 of letters and digits read as an IBAN's number (A is 10)."""
    return F.aggregate(chars(s), F.lit(0), lambda t, c: let(
        F.instr(F.lit(DIGITS + UPPERS), c) - 1, lambda v: F.when(v > 9, (t * 100 + v) % 97).otherwise((t * 10 + v) % 97)))


def _iban_number(s: Column) -> Column:
    plain = F.replace(s, F.lit(" "), F.lit(""))
    return F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))


def _day(s: Column) -> Column:
    """Days since the first one, null for dates that don't exist or lie outside."""
    iso = F.try_to_timestamp(s, F.lit("yyyy-MM-dd"))
    dots = F.try_to_timestamp(F.translate(s, "/", "."), F.lit("dd.MM.yyyy"))
    day = F.datediff(F.coalesce(iso, dots).cast("date"), F.lit(FIRST_DAY).cast("date"))
    return F.when((day >= 0) & (day < SPANS[0] * SPANS[1]), day)


def kind_of(s: Column) -> Column:
    """The kind of a found string, null where it isn't valid."""
    whole = lambda k: F.regexp_like(s, F.lit(f"^(?:{SHAPES[k]})$"))
    octets = F.forall(F.split(s, r"\."), lambda o: o.cast("int") <= 255)
    ssn = F.regexp_like(s, F.lit("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"))
    n = F.length(_digits(s))
    return (F.when(whole("email"), F.lit("email"))
            .when(whole("ip"), F.when(octets, F.lit("ip")))
            .when(whole("date"), F.when(_day(s).isNotNull(), F.lit("date")))
            .when(whole("ssn"), F.when(ssn, F.lit("ssn")))
            .when(whole("card") & (luhn_sum(_digits(s)) % 10 == 0) & ~F.regexp_like(_digits(s), F.lit("^(.)\\1+$")), F.lit("card"))
            .when(whole("phone"), F.when(n.between(7, 15), F.lit("phone")))
            .when(whole("iban"), F.when(mod97(_iban_number(s)) == 1, F.lit("iban"))))


def _hash(key: str, kind: Column, *parts: Column) -> Column:
    """A keyed 60-bit number."""
    return F.conv(F.substr(F.sha2(F.concat_ws("|", F.lit(key), kind, *[p.cast("string") for p in parts]), 256), F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def permuted_symbols(s: Column, key: str, kind: Column, rounds: int = 6) -> Column:
    """Digits, small and large letters of a string keyed-permuted, each within its own range; the rest stays in place."""
    def shifted(half: Column, other: Column, i: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            move = lambda ranged, size: F.substr(
                F.lit(ranged), (F.pmod(F.instr(F.lit(ranged), c) - 1 + F.pmod(_hash(key, kind, i, j, F.array_join(other, "")), F.lit(size)), F.lit(size)) + 1).cast("int"), F.lit(1))
            return (F.when(F.regexp_like(c, F.lit("^[0-9]$")), move(DIGITS, 10)).when(F.regexp_like(c, F.lit("^[a-z]$")), move(LOWERS, 26))
                    .when(F.regexp_like(c, F.lit("^[A-Z]$")), move(UPPERS, 26)).otherwise(c))

        return F.transform(half, one)

    def run(c: Column) -> Column:
        half = F.floor(F.size(c) / 2).cast("int")
        start = F.struct(F.slice(c, F.lit(1), half).alias("l"), F.slice(c, half + 1, F.size(c) - half).alias("r"))
        done = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda a, i: F.struct(
            F.when(i % 2 == 1, shifted(a["l"], a["r"], i)).otherwise(a["l"]).alias("l"),
            F.when(i % 2 == 0, shifted(a["r"], a["l"], i)).otherwise(a["r"]).alias("r")))
        return let(done, lambda d: F.array_join(F.concat(d["l"], d["r"]), ""))

    return let(chars(s), run)


def _refill(shape: Column, digits: Column) -> Column:
    """The characters of `digits` in the places of the digits and letters of `shape`."""
    step = F.aggregate(chars(shape), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")), lambda a, c: F.when(
        F.regexp_like(c, F.lit("[0-9A-Za-z]")), F.struct(F.concat(a["t"], F.substr(digits, a["i"], F.lit(1))).alias("t"), (a["i"] + 1).alias("i"))).otherwise(
        F.struct(F.concat(a["t"], c).alias("t"), a["i"].alias("i"))))
    return step["t"]


def pseudonym(s: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid string of the given kind."""
    k = lambda name: F.lit(name)
    at = F.instr(s, "@")
    mail = F.concat(permuted_symbols(F.substr(s, F.lit(1), at - 1), key, k("email")), F.substr(s, at))
    octets = F.transform(F.split(s, r"\."), lambda o: o.cast("bigint"))
    ip = let(octets, lambda o: let(
        permuted(F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), F.lit(65536), F.lit(65536),
                 lambda h, i: _hash(key, k("ip"), i, h)),
        lambda p: F.concat_ws(".", *[x.cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256)])))
    day = let(_day(s), lambda d: let(
        permuted(F.floor(d / SPANS[1]), d % SPANS[1], F.lit(SPANS[0]), F.lit(SPANS[1]), lambda h, i: _hash(key, k("date"), i, h)),
        lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * SPANS[1] + p["r"]).cast("int"))))
    date = F.when(F.contains(s, F.lit("-")), F.date_format(day, "yyyy-MM-dd")).otherwise(
        F.when(F.contains(s, F.lit("/")), F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy")))
    body = let(_digits(s), lambda d: permuted_symbols(F.substr(d, F.lit(1), F.length(d) - 1), key, k("card")))
    card = let(body, lambda b: _refill(s, F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"))))
    # the digits alone, so that a number stays linked however it is written; +1 is told by its eleven digits
    country = F.when(F.regexp_like(_digits(s), F.lit("^1[0-9]{10}$")) & F.startswith(s, F.lit("+")), 1).otherwise(
        F.length(_digits(F.regexp_extract(s, r"^(\+[0-9]{1,3}[ .-]|\+[0-9]{2})?", 1))))
    phone = let(F.struct(_digits(s).alias("d"), country.alias("n")), lambda p: _refill(s, F.concat(
        F.substr(p["d"], F.lit(1), p["n"]), permuted_symbols(F.substr(p["d"], p["n"] + 1), key, k("phone")))))
    account = let(F.replace(s, F.lit(" "), F.lit("")), lambda p: let(
        permuted_symbols(F.substr(p, F.lit(5)), key, k("iban")),
        lambda b: _refill(s, F.concat(F.substr(p, F.lit(1), F.lit(2)), F.lpad(
            (98 - mod97(F.concat(b, F.substr(p, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0"), b))))
    return (F.when(kind == "email", mail).when(kind == "ip", ip).when(kind == "date", date).when(kind == "card", card)
            .when(kind == "phone", phone).when(kind == "iban", account).when(kind == "ssn", permuted_symbols(s, key, k("ssn"))))


def found(text: Column, key: str) -> Column:
    """Array of (start, stop, kind, pseudonym) of all valid strings in a text, in order."""
    one = F.transform(matches(text, ANY), lambda m: let(kind_of(m["found"]), lambda k: F.struct(
        m["start"].alias("start"), m["stop"].alias("stop"), k.alias("kind"), pseudonym(m["found"], k, key).alias("pseudonym"))))
    none = F.array().cast("array<struct<start:bigint,stop:bigint,kind:string,pseudonym:string>>")
    return F.when(F.regexp_like(text, F.lit("[0-9@]")), F.filter(one, lambda m: m["kind"].isNotNull())).otherwise(none)


def _rewritten(text: Column, key: str) -> Column:
    """The text with pseudonyms, and the kinds found, as struct (t, kinds)."""
    pattern = F.lit(f"(?s)\\G(.*?)({ANY})")
    hits = lambda t: F.arrays_zip(F.regexp_extract_all(t, pattern, F.lit(1)).alias("g"),
                                  F.regexp_extract_all(t, pattern, F.lit(2)).alias("h"))

    def change(t: Column) -> Column:
        parts = F.transform(hits(t), lambda z: let(kind_of(z["h"]), lambda k: F.struct(
            z["g"].alias("g"), z["h"].alias("h"), k.alias("k"), pseudonym(z["h"], k, key).alias("p"))))
        return let(parts, lambda p: let(
            F.aggregate(p, F.lit(0), lambda n, x: n + F.length(x["g"]) + F.length(x["h"])), lambda used: F.struct(
                F.concat(F.array_join(F.transform(p, lambda x: F.concat(x["g"], F.coalesce(x["p"], x["h"]))), ""),
                         F.substr(t, used + 1)).alias("t"),
                F.filter(F.transform(p, lambda x: x["k"]), lambda k: k.isNotNull()).alias("kinds"))))

    plain = F.struct(text.alias("t"), F.array().cast("array<string>").alias("kinds"))
    return F.when(text.isNull() | ~F.regexp_like(text, F.lit("[0-9@]")), plain).otherwise(let(text, change))


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """All columns, with the text's personal data replaced, and `pii_kinds`: the kinds found, in order."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), _rewritten(F.col("text"), key).alias("new"))
    return rows.select(*[F.col("new.t").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
                         for c in docs.columns if c != "pii_kinds"], F.col("new.kinds").alias("pii_kinds"))


@query("op3_pii")
def op3_pii(spark, sf_dir):
    """Every document with its personal data replaced by linked pseudonyms.

    The key is a setting of the session, `loadtide.pii.key`; without it a fixed test key is taken.
    """
    done = replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get("loadtide.pii.key", "test key"))
    count = lambda k: F.size(F.filter("pii_kinds", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return done.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_found"), *[count(k) for k in KINDS])
