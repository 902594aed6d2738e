"""Very long tokens and chains, in time that follows their length; links of differently written values."""

import random
import string
import time

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from loadtide.llm import pieces, pii


def test_pieces_of_chains_of_marks(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    with open(model, "rb") as f:
        coder = pieces.PrefixTable(f.read())
    for text in ("x " + ".!" * 520, "." * 3000, "a" + "?!:;" * 5000, ".! " * 900):
        assert coder.encode(text) == library.encode(text)


def test_personal_data_in_one_long_token(spark):
    rnd = random.Random(5)
    blob = "".join(rnd.choices(string.ascii_letters + string.digits, k=1_000_000))
    rows = [(1, blob), (2, blob[:300_000] + " a.b@example.org " + "x@" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    pii.replaced(df.limit(1), "k").count()
    started = time.time()
    got = {r.doc_id: r for r in pii.replaced(df, "k").collect()}
    assert time.time() - started < 60
    assert got[1].text == blob and got[2].pii_kinds == ["email"]


def test_phones_are_linked_by_their_digits(spark):
    same = ["+1-555-123-4567", "+1 555 123 4567", "+1 (555) 123-4567", "+15551234567"]
    df = spark.createDataFrame([(i, f"call {s} now") for i, s in enumerate(same)] + [(9, "on 2024-01-15T10:00 and 2024-01-15")], "doc_id int, text string")
    got = {r.doc_id: r for r in pii.replaced(df, "k").collect()}
    digits = {"".join(c for c in got[i].text if c.isdigit()) for i in range(len(same))}
    assert len(digits) == 1 and digits != {"15551234567"}
    assert [got[i].text[5 + k] for i, s in enumerate(same) for k, c in enumerate(s) if not c.isdigit()] == [c for s in same for c in s if not c.isdigit()]
    words = got[9].text.split()
    assert got[9].pii_kinds == ["date", "date"] and words[1][:10] == words[3] != "2024-01-15" and words[1][10:] == "T10:00"
    assert df.select(F.lit(1)).count() == 5
