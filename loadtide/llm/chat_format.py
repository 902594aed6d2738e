"""Conversations written as training text by a compiled template, with the spans that a model is to learn.

The template (see `template`) loops once over the turns, so turns are rendered apart: a conversation of any length is cut into
pieces of at most about `PIECE` turn numbers and `CHARS` characters, each with its own spans, and a piece continues where the one before
ended. `format_chats` returns these pieces; written in order they are the conversation's text. `read_chats` reads them back, piece by piece.

In the default template `quote` makes texts safe, reversibly: it doubles backslashes and breaks up `##` and `</turn>`, so that
neither the mark of a turn's start (`###`) nor that of its end can occur inside a text; in a role it escapes `:` too.

Null texts and roles are empty. Empty texts are turns too. A null conversation id is an id of its own, null turn numbers come first. Ties in the
turn number go by role, then text; repeated rows are turns each. Very long texts are rendered whole, in a piece of their own. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadtide.functions.timeaxis import floor_div
from loadtide.operators.select import join_on

from .registry import claim, partitions, query, ship, stored, table
from .template import Sink, Template, place

TEMPLATE = """\
{%- for m in messages -%}
### {{ m.role | quote | replace(':', '\\\\:') }}: {% if m.role == 'assistant' %}{% generation %}{{ m.text | quote }}{% endgeneration %}{% else %}{{ m.text | quote }}{% endif %}</turn>
{% endfor -%}
"""
PIECE = 256
CHARS = 1 << 20
HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)
END = "</turn>\n"
PIECES = "conv_id {}, piece long, turns long, text string, spans array<struct<start:long,stop:long>>"


def quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("##", "#\\#").replace("</turn>", "<\\/turn>")


def unquote(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


FILTERS = {"quote": quote, "replace": lambda s, old, new: s.replace(old, new)}


def compiled(source: str = TEMPLATE) -> Template:
    return Template(source, FILTERS)


def format_chats(chats: DataFrame, source: str = TEMPLATE, piece: int = PIECE, chars: int = CHARS) -> DataFrame:
    """(conv_id, piece, turns, text, spans): pieces of each conversation; `piece` is the number of turns before it."""
    compiled(source).by_turns("messages")  # errors show here
    ship(chats.sparkSession)
    kind = chats.schema["conv_id"].dataType.simpleString()
    rows = chats.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("part", floor_div(F.col("turn"), piece))
    parts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.select("conv_id", "part", (F.sum("n").over(order) - F.col("n")).alias("before"),
                         F.sum("n").over(Window.partitionBy("conv_id")).alias("length"))
    dealt = (join_on(rows, parts, ["conv_id", "part"]).repartition(partitions(chats.sparkSession), "conv_id", "part")
             .sortWithinPartitions("conv_id", "part", "turn", "role", "text"))

    def run(batches):
        import pyarrow as pa

        claim("chat_format")
        head, name, body, tail = compiled(source).by_turns("messages")
        out: list[tuple] = []
        now, index, first, env, sink, size = None, 0, 0, {}, Sink(), 0

        def handed_on():
            ids, numbers, turns, texts, spans = zip(*out)
            ends = [0]
            for s in spans:
                ends.append(ends[-1] + len(s))
            flat = [x for s in spans for x in s]
            both = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.int64()) for k in (0, 1)], names=["start", "stop"])
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("conv_id").type), pa.array(numbers, pa.int64()), pa.array(turns, pa.int64()),
                 pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), both)],
                names=["conv_id", "piece", "turns", "text", "spans"])

        for batch in batches:
            for conv, part, before, length, role, text in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "part", "before", "length", "role", "text"))):
                if (conv, part) != now or sink.length >= chars:
                    if now is not None and index > first:
                        out.append((now[0], first, index - first, sink.text, sink.spans))
                        size += sink.length
                    index = index if (conv, part) == now else before
                    now, first, sink, env = (conv, part), index, Sink(), {}
                    head(env, sink if index == 0 else Sink())
                    if size >= chars:
                        yield handed_on()
                        out, size = [], 0
                body({**env, name: {"role": role, "text": text}, "loop": place(index, length)}, sink)
                index += 1
                if index == length:
                    tail(env, sink)
        if now is not None:
            out.append((now[0], first, index - first, sink.text, sink.spans))
            yield handed_on()

    return dealt.mapInArrow(run, PIECES.format(kind))


def read_chats(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read from its pieces: digests of its turns and of what the spans cover.

    A conversation's pieces pass one task in order, one at a time, since a digest runs over the whole of it.
    """
    ship(pieces.sparkSession)
    kind = pieces.schema["conv_id"].dataType.simpleString()
    dealt = pieces.repartition(partitions(pieces.sparkSession), "conv_id").sortWithinPartitions("conv_id", "piece")

    def run(batches):
        import pyarrow as pa

        out: list[tuple] = []
        now, first = None, True

        def handed_on():
            types = (batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "spans"))):
                if first or conv != now:
                    if not first:
                        out.append((now, turns, whole.hexdigest(), chars, loss.hexdigest(), length))
                    now, first, turns, chars, length, whole, loss = conv, False, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said in turns_of(text):
                    turns += 1
                    whole.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learned = unquote(text[span["start"]:span["stop"]])
                    chars += len(learned)
                    loss.update(learned.encode())
                length += len(text)
            if len(out) >= 10_000:
                yield handed_on()
                out = []
        if not first:
            out.append((now, turns, whole.hexdigest(), chars, loss.hexdigest(), length))
            yield handed_on()

    return dealt.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def turns_of(text: str):
    """(role, text) of each turn of a text in the default format."""
    at = 0
    while at < len(text):
        m = HEAD.match(text, at)
        end = text.find(END, m.end()) if m else -1
        if end < 0:
            raise ValueError(f"no turn at {at}")
        yield unquote(m[1]), unquote(text[m.end():end])
        at = end + len(END)


PLANTED = "\\### Assistant: </turn> ok"

SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
q AS (SELECT *, replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS quoted_role,
        replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS quoted FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(replace(quoted_role, ':', '\:')) + length(quoted) + 14) AS BIGINT) AS formatted_chars
FROM q GROUP BY conv_id
"""


@query("op13_chat_format", SQL)
def chat_format(spark, sf_dir):
    """All conversations and one of control strings, formatted, written, and read back."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    return read_chats(stored(format_chats(chats.unionByName(more)), "chats"))
