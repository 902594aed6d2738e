"""Token ids in files of length-delimited binary records, with an index of offsets.

A record is: length of the body (8 bytes, little endian), masked CRC-32C of these 8 bytes (4), the body,
masked CRC-32C of the body (4). The body is the document's id (8; the smallest number stands for null), the
width of an id in bytes (1: 2 or 4) and the ids, little endian. Beside each file `x.records` lies
`x.index`: the offset of every record (8 bytes each), so that a reader can go to any record, in any order. A manifest
in Parquet lists the files in the order of their ids.

Documents are dealt out by ranges of ids, one or more files per range, so that files and the records in
them ascend. Tasks write under names of their own and rename the finished file, so that a task that runs twice leaves the
same file. Files are opened by their address through Arrow's file systems; no task writes to its own disk.

Null texts count as empty; every document ends with the end id, so none has no ids. Rows with the same id
stand side by side, ordered by text; null ids come first. Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.sources.scratch import fresh_path

from .registry import claim, file_system, held, partitions, query, ship, table

NULL_ID = -(1 << 63)
CHUNK = 512  # bytes of a body that are summed side by side with others
_POLY, _DELTA, _ALL = 0x82F63B78, 0xA282EAD8, 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLY), t >> 1)
    return t


_T = _byte_table()


def _after(n: int) -> np.ndarray:
    """Tables (4 x 256) that advance a sum over n zero bytes."""
    out = np.zeros((4, 256), np.uint32)
    for k in range(4):
        v = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(n):
            v = _T[v & 0xFF] ^ (v >> 8)
        out[k] = v
    return out


_SKIP = _after(CHUNK)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of many byte strings at once.

    Each string is cut into chunks, filled up in front with zeros (which a sum that starts with 0 doesn't see); all chunks are
    summed side by side, byte by byte, then each string's chunks are put together. The start value is put into the
    first four bytes; shorter strings are done one by one.
    """
    out = np.zeros(len(parts), np.uint32)
    longer = [i for i, p in enumerate(parts) if len(p) >= 4]
    for i, p in enumerate(parts):
        if len(p) < 4:
            v = _ALL
            for b in p:
                v = int(_T[(v ^ b) & 0xFF]) ^ (v >> 8)
            out[i] = v ^ _ALL
    if not longer:
        return out
    counts = np.array([-(-len(parts[i]) // CHUNK) for i in longer])
    stops = np.cumsum(counts)
    grid = np.zeros((int(stops[-1]), CHUNK), np.uint8)
    flat = grid.reshape(-1)
    for i, n, stop in zip(longer, counts, stops):
        p = np.frombuffer(parts[i], np.uint8)
        at = stop * CHUNK - len(p)
        flat[at:stop * CHUNK] = p
        flat[at:at + 4] ^= 0xFF
    sums = np.zeros(len(grid), np.uint32)
    for column in np.ascontiguousarray(grid.T):
        sums = _T[(sums ^ column) & 0xFF] ^ (sums >> 8)
    starts, total = stops - counts, np.zeros(len(longer), np.uint32)
    order = np.argsort(-counts, kind="stable")
    left = len(order)
    for step in range(int(counts.max())):
        while counts[order[left - 1]] <= step:
            left -= 1
        who = order[:left]
        v = total[who]
        total[who] = _SKIP[0][v & 0xFF] ^ _SKIP[1][(v >> 8) & 0xFF] ^ _SKIP[2][(v >> 16) & 0xFF] ^ _SKIP[3][v >> 24] ^ sums[starts[who] + step]
    out[longer] = total ^ np.uint32(_ALL)
    return out


def masked(sums: np.ndarray) -> np.ndarray:
    return ((sums >> np.uint32(15)) | (sums << np.uint32(17))) + np.uint32(_DELTA)


def framed(bodies: list[bytes]) -> list[bytes]:
    """Records of bodies."""
    heads = [len(b).to_bytes(8, "little") for b in bodies]
    sums = masked(crc32c(heads + bodies)).astype("<u4").view("V4")
    n = len(bodies)
    return [b"".join((h, sums[i].tobytes(), b, sums[n + i].tobytes())) for i, (h, b) in enumerate(zip(heads, bodies))]


def unframed(data: bytes, offsets: list[int]) -> list[bytes]:
    """Bodies of the records at the given offsets; raises where a sum is wrong."""
    heads = [data[o:o + 8] for o in offsets]
    bodies = [data[o + 12:o + 12 + int.from_bytes(h, "little")] for o, h in zip(offsets, heads)]
    sums = masked(crc32c(heads + bodies)).tolist()
    n = len(offsets)
    for i, (o, b) in enumerate(zip(offsets, bodies)):
        if int.from_bytes(data[o + 8:o + 12], "little") != sums[i] or int.from_bytes(data[o + 12 + len(b):o + 16 + len(b)], "little") != sums[n + i]:
            raise ValueError(f"damaged record at {o}")
    return bodies


class Encoder:
    """Ids of texts by the tokenizers library, as bytes.

    Byte-level models split a text before every space that a non-space follows, whatever comes before it, and around a newline
    between two non-spaces; so words are encoded by the library once and kept in a bounded table. Texts with other white space, with
    white space side by side, or with a special token's string, go to the library whole.
    """

    def __init__(self, model: str, keep: int = 1_900_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        self.known: dict[str, bytes] = {}  # ids of a space and the word
        self.starts: dict[str, bytes] = {}  # ids of a word that starts a line
        self.keep = keep
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        plain = re.sub(r"\s", "", model)
        by_words = '"pre_tokenizer":{"type":"ByteLevel","add_prefix_space":false' in plain and '"normalizer":null' in plain
        self.special = special
        # white space but for the space and the newline; any text if words can't be told apart this way
        self.odd = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]" if by_words else "")
        # in a byte-level vocabulary a token has a character for each of its bytes
        self.lengths = np.array([len(self.library.id_to_token(i) or "") for i in range(self.library.get_vocab_size(with_added_tokens=True))])

    def whole(self, t: str) -> bool:
        """Whether a text goes to the library whole."""
        return ("  " in t or "\n " in t or " \n" in t or "\n\n" in t or t.endswith((" ", "\n")) or any(s in t for s in self.special)
                or self.odd.search(t) is not None)

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, f"<u{self.width}").tobytes()

    def _encode_words(self, words: list[str], table: dict[str, bytes], between: str) -> None:
        """Ids of many words from one call, each with a space before it or, between newlines, without: a word's ids end where their bytes do."""
        for s in range(0, len(words), 20_000):
            some = words[s:s + 20_000]
            line = between + between.join(some)
            ids = np.array(self.library.encode_batch_fast([line], add_special_tokens=False)[0].ids)
            line = np.frombuffer(line.encode(), np.uint8)
            ends = np.append(np.flatnonzero(line == ord(between))[1:], len(line))  # no word has one in it
            stops = ((np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1) * self.width).tolist()
            data, start = self._bytes(ids), 0
            for w, stop in zip(some, stops):
                table[w] = data[start + (self.width if between == "\n" else 0):stop]  # a newline is one token
                start = stop

    def _fill(self, missing: set[str]) -> None:
        """Encode words not seen before. A full stop or comma after a letter is encoded apart; so is what follows a newline."""
        known, starts, stops = self.known, self.starts, self.stops
        broken = {w: w.split("\n") for w in missing if "\n" in w}
        heads = {p for parts in broken.values() for p in parts[1:]}
        missing = missing.difference(broken) | {parts[0] for parts in broken.values()}
        new, first = [], []
        for table, wanted, plain in ((known, missing, new), (starts, heads, first)):
            wanted = wanted.difference(table.keys() & wanted)
            ends = {w: w[:-1] for w in wanted if len(w) > 1 and w[-1] in ".," and w[-2].isalpha()}
            plain.extend(w for w in {*wanted.difference(ends), *ends.values()} if w not in table)
            self._encode_words(plain, table, " " if table is known else "\n")
            for w, base in ends.items():
                table[w] = table[base] + stops[w[-1]]
        for w, parts in broken.items():
            known[w] = known[parts[0]] + b"".join([stops["\n"] + starts[p] for p in parts[1:]])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian numbers of `width` bytes."""
        if len(self.known) > self.keep:  # frequent words come early
            self.known = dict(islice(self.known.items(), self.keep // 4))
            self.starts = dict(islice(self.starts.items(), self.keep // 8))
        self.stops = {c: self._bytes(self.library.encode(c, add_special_tokens=False).ids) for c in ".,\n"}
        get, out, late = self.known.get, [None] * len(texts), []
        whole, heads, missing = [], [], set()
        for i, t in enumerate(texts):
            if self.whole(t):
                whole.append(i)
                continue
            words = t.split(" ")
            heads.append((i, words.pop(0)))
            found = list(map(get, words))
            if None in found:
                gaps, k = [], -1
                for _ in range(found.count(None)):
                    k = found.index(None, k + 1)
                    gaps.append(k)
                names = [words[k] for k in gaps]
                late.append((i, found, gaps, names))
                missing.update(names)
            else:
                out[i] = b"".join(found)
        self._fill(missing)
        for i, found, gaps, names in late:
            for k, w in zip(gaps, names):
                found[k] = get(w)
            out[i] = b"".join(found)
        alone = self.library.encode_batch_fast([h for _, h in heads] + [texts[i] for i in whole], add_special_tokens=False)
        for (i, _), e in zip(heads, alone):
            out[i] = self._bytes(e.ids) + out[i]
        for i, e in zip(whole, alone[len(heads):]):
            out[i] = self._bytes(e.ids)
        return out


_loaded: dict[bytes, Encoder] = held("records", {})


def _encoder(model: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    claim("records")
    key = hashlib.sha256(model.encode()).digest()
    if key not in _loaded:
        _loaded[key] = Encoder(model)
    return _loaded[key]


_FILES = "name string, part int, seq int, n_records long, n_ids long"


def write_records(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, max_file_bytes: int = 256 << 20) -> None:
    """Encode all texts and write them, ascending by id, to files below `path`; the manifest goes to `path`/manifest."""
    with open(tokenizer_file, encoding="utf-8") as f:
        model = f.read()

    def run(batches):
        import os
        import pyarrow as pa
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        coder, tail = _encoder(model), None
        files, place = [], f"{path}/files"
        system, base = file_system(place)
        system.create_dir(base, recursive=True)

        class File:
            def __init__(self, seq: int):
                self.seq, self.name, self.size, self.offsets, self.ids = seq, f"part-{part:06d}-{seq:04d}", 0, [], 0
                self.out = system.open_output_stream(f"{base}/.{self.name}.{attempt}.records")

            def add(self, record: bytes, ids: int) -> None:
                self.offsets.append(self.size)
                self.out.write(record)
                self.size += len(record)
                self.ids += ids

            def close(self) -> None:
                self.out.close()
                with system.open_output_stream(f"{base}/.{self.name}.{attempt}.index") as o:
                    o.write(np.asarray(self.offsets, "<u8").tobytes())
                for kind in ("records", "index"):
                    system.move(f"{base}/.{self.name}.{attempt}.{kind}", f"{base}/{self.name}.{kind}")
                files.append((self.name, part, self.seq, len(self.offsets), self.ids))

        now = None
        for batch in batches:
            tail = np.asarray([end_id], f"<u{coder.width}").tobytes()
            for s in range(0, batch.num_rows, 800):
                piece = batch.slice(s, 800)
                texts = [t or "" for t in piece.column("text").to_pylist()]
                ids = [x for k in range(0, len(texts), 200) for x in coder.encode(texts[k:k + 200])]  # few texts' words stay in the cache
                head = bytes([coder.width])
                bodies = [b"".join(((NULL_ID if d is None else d).to_bytes(8, "little", signed=True), head, b, tail))
                          for d, b in zip(piece.column("doc_id").to_pylist(), ids)]
                for record, b in zip(framed(bodies), ids):
                    if now is None or now.size > max_file_bytes:
                        if now is not None:
                            now.close()
                        now = File(0 if now is None else now.seq + 1)
                    now.add(record, len(b) // coder.width + 1)
        if now is not None:
            now.close()
        yield pa.RecordBatch.from_pylist([dict(zip(("name", "part", "seq", "n_records", "n_ids"), f)) for f in files],
                                         pa.schema([("name", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_records", pa.int64()), ("n_ids", pa.int64())]))

    spark = docs.sparkSession
    ship(spark)
    ranged = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
              .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    ranged.mapInArrow(run, _FILES).write.parquet(f"{path}/manifest")


def _read_file(place: str, name: str, shuffle: int | None, block: int = 32 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """(numbers of records, their bodies), some records at a time; `shuffle` is the seed of a random order of blocks of records."""
    system, base = file_system(place)
    with system.open_input_stream(f"{base}/{name}.index") as f:
        offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
    with system.open_input_file(f"{base}/{name}.records") as f:
        ends = np.append(offsets[1:], f.size())
        starts = [0]
        for i in range(len(offsets)):
            if ends[i] - offsets[starts[-1]] > block and i > starts[-1]:
                starts.append(i)
        groups = list(zip(starts, [*starts[1:], len(offsets)]))
        if shuffle is not None:
            groups = [groups[i] for i in np.random.default_rng(shuffle).permutation(len(groups))]
        for a, b in groups:
            if b > a:
                data = f.read_at(int(ends[b - 1] - offsets[a]), int(offsets[a]))
                who = np.arange(a, b) if shuffle is None else a + np.random.default_rng(shuffle + a).permutation(b - a)
                yield who.tolist(), unframed(data, [int(offsets[i] - offsets[a]) for i in who])


def read_records(spark: SparkSession, path: str, seed: int | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every record, the last column on request; every checksum is tested.

    `start` is the number of ids in all records before. With a seed each file's records come in a random order, by
    way of the index. Files are read by their own tasks; of the manifest only a running sum over parts is sorted in one task.
    """
    ship(spark)
    manifest = spark.read.schema(_FILES).parquet(f"{path}/manifest")
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS part_start")
    listed = (manifest.selectExpr("*", "sum(n_ids) OVER (PARTITION BY part ORDER BY seq) - n_ids AS file_start").join(parts, "part")
              .select("name", (F.col("part_start") + F.col("file_start")).alias("start")))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                run_at = start
                for who, bodies in _read_file(f"{path}/files", name, seed):
                    arrays = [np.frombuffer(b, f"<u{b[8]}", offset=9).astype("<u4") for b in bodies]
                    if seed is None:
                        lengths = np.array([len(a) for a in arrays])
                        begins = (run_at + np.cumsum(lengths) - lengths).tolist()
                        run_at += int(lengths.sum())
                    else:
                        begins = [None] * len(arrays)
                    ids = [int.from_bytes(b[:8], "little", signed=True) for b in bodies]
                    for s in range(0, len(arrays), 2000):
                        some = arrays[s:s + 2000]
                        columns = [pa.array([None if i == NULL_ID else i for i in ids[s:s + 2000]], pa.int64()), pa.array(begins[s:s + 2000], pa.int64()),
                                   pa.array([len(a) for a in some], pa.int64()), pa.array([zlib.crc32(a) for a in some], pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(a) for a in some])), pa.int32()),
                                                                    pa.array(np.concatenate(some).view("<i4"))))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return listed.repartition(partitions(spark), "name").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


@query("op7_token_records")
def op7_token_records(spark, sf_dir):
    """All texts as token ids in record files, read back."""
    import public_tokenizers

    path = fresh_path(spark, "records")
    write_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_records(spark, path, with_ids=False)
