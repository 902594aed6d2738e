"""SentencePiece encoding and decoding with a table over prefixes.

For every prefix of a string the table holds the one token that ends the prefix's encoding. Pieces that end at a
place come from an Aho-Corasick automaton; such a piece is the last token if it follows the last token of the prefix
before it, that is, if merging the two tokens' characters gives these two tokens again (tested by
replaying the merges of both). Reading the table backwards from
the end gives the ids. This takes time linear in the string, however long it is.

No merge crosses two neighbouring characters that no piece holds side by side, so a text falls into strings that are
encoded alone: words, with the mark for the space before them. The ids of frequent strings are kept in a bounded
table in each worker. Characters that are no piece become byte pieces.

Null texts count as empty and have no ids. Rows that repeat get equal results, one each. Other columns are
ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import claim, held, query, ship, table

SPACE = "▁"
NEVER = float("-inf")


def _oldest(table: dict, n: int) -> dict:
    """The first entries of a table: frequent strings come early."""
    return dict(islice(table.items(), n))


MARKS = ".,;:!?"


class PrefixTable:
    """Encoder for one model. `keep` bounds the table of strings encoded before."""

    def __init__(self, model: bytes, keep: int = 700_000):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        plain = [i for i in range(n) if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))]
        self.text = {i: self.library.id_to_piece(i) for i in plain}
        self.score = {p: self.library.get_score(i) for i, p in self.text.items()}
        self.byte = {int(self.library.id_to_piece(i)[3:5], 16): i for i in range(n) if self.library.is_byte(i)}
        self.side_by_side = {p[j:j + 2] for p in self.score for j in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        self.merges = {i: self.history(p) for i, p in self.text.items()}
        for i, p in self.text.items():
            if self.merges[i][1][-1] == p:  # only pieces that their own characters merge to occur
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}  # ids as numbers of `kind`
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.decimal = [str(i) for i in range(n)]
        self.keep = keep

    def history(self, s: str) -> tuple[list[float], list[str], list[str]]:
        """How a short string merges: score of each merge, and the first and last symbol before each and at the end.

        The best score goes first, the leftmost among equals.
        """
        parts, scores, first, last = list(s), [], [s[0]], [s[-1]]
        while len(parts) > 1:
            best = max(((self.score[parts[j] + parts[j + 1]], -j) for j in range(len(parts) - 1) if parts[j] + parts[j + 1] in self.score),
                       default=None)
            if best is None:
                break
            j = -best[1]
            parts[j:j + 2] = [parts[j] + parts[j + 1]]
            scores.append(best[0])
            first.append(parts[0])
            last.append(parts[-1])
        return scores, first, last

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may come right after token a: no merge across their border ever comes first.

        Both tokens' merges are replayed in turn, the better one first, the left one among equals.
        """
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= 400_000:
                self.pairs = _oldest(self.pairs, 100_000)
            found = self.pairs[a, b] = self._follows(a, b)
        return found

    def _follows(self, a: int, b: int) -> bool:
        (left, _, ends), (right, starts, _) = self.merges[a], self.merges[b]
        i = j = 0
        while True:
            mine = left[i] if i < len(left) else NEVER
            other = right[j] if j < len(right) else NEVER
            across = self.score.get(ends[i] + starts[j], NEVER)
            if across > mine and across >= other:
                return False
            if mine == NEVER and other == NEVER:
                return True
            if mine >= other:
                i += 1
            else:
                j += 1

    def encode_string(self, s: str) -> list[int]:
        """Ids of a string in which spaces are marks already."""
        last: list[int] = [-1] * (len(s) + 1)  # -1: the character before this place is no piece
        width = [1] * (len(s) + 1)
        place = 0
        for end, (token, length) in self.automaton.iter(s):
            place = end + 1
            if last[place] < 0:
                before = last[place - length]
                if place == length or before < 0 or self.follows(before, token):
                    last[place], width[place] = token, length
        ids: list[int] = []
        place = len(s)
        while place > 0:
            if last[place] >= 0:
                ids.append(last[place])
            else:
                ids.extend(self.byte[b] for b in reversed(s[place - 1].encode()))
            place -= width[place]
        ids.reverse()
        return ids

    def lookup(self, s: str) -> bytes:
        """Ids of a string."""
        found = self.known.get(s)
        if found is not None:
            return found
        end = len(s)
        while end > 2 and s[end - 1] in MARKS and s[end - 2:end] not in self.side_by_side:  # no entry for each form of a word
            end -= 1
        if end < len(s):
            return self.lookup(s[:end]) + b"".join(map(self.lookup, s[end:]))
        found = np.array(self.encode_string(s), self.kind).tobytes()
        if len(s) <= 64:
            self.known[s] = found
        return found

    def trim(self, keep: int) -> None:
        """Cut the tables down if they hold more than `keep` strings."""
        if len(self.known) > keep:
            self.known = _oldest(self.known, keep // 4)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        self.trim(self.keep)
        return np.frombuffer(b"".join(self.parts(text)), self.kind).tolist()

    def parts(self, text: str) -> Iterator[bytes]:
        """The encodings of the strings that the text falls into, in order."""
        if not text:
            return
        get, lookup = self.known.get, self.lookup
        newline = lookup("\n") if "\n" not in self.score else None
        lines = text.replace(SPACE, " ").split("\n") if newline else [text.replace(SPACE, " ")]
        for i, line in enumerate(lines):
            if i:
                yield newline
                if not line:
                    continue
                first, words = line.split(" ", 1) if " " in line else (line, None)
                if first:
                    yield get(first) or lookup(first)
                if words is None:
                    continue
            else:
                words = line
            marks = SPACE
            for w in words.split(" "):
                if w:
                    s = marks + w
                    yield get(s) or lookup(s)
                    marks = SPACE
                else:
                    marks += SPACE
            if len(marks) > 1:  # spaces at the end
                s = marks[:-1]
                yield get(s) or lookup(s)


_loaded: dict[bytes, PrefixTable] = held("pieces", {})


def _table(model: bytes) -> PrefixTable:
    """The worker's table for a model."""
    claim("pieces")
    key = hashlib.sha256(model).digest()
    if key not in _loaded:
        _loaded[key] = PrefixTable(model)
    return _loaded[key]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row; the model file's bytes travel to the workers."""
    with open(model_file, "rb") as f:
        model = f.read()
    ship(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        coder = _table(model)
        decimal = coder.decimal.__getitem__
        for batch in batches:
            counts, sums, texts = [], [], []
            for text in batch.column("text").to_pylist():
                ids = coder.encode(text or "")
                counts.append(len(ids))
                sums.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                texts.append(hashlib.sha256(coder.library.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        coder.trim(400_000)  # what stays between tasks, which may be other jobs'

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids): the ids themselves."""
    with open(model_file, "rb") as f:
        model = f.read()
    ship(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        coder = _table(model)
        for batch in batches:
            ids = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


@query("op10_sentencepiece")
def op10_sentencepiece(spark, sf_dir):
    """Ids of every whole text, and the text that they decode to, as digests."""
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
