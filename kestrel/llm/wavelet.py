"""Token ids in wavelet matrices, one compressed file per shard.

A shard holds the token ids of whole documents, in ascending order of the
document key, as a wavelet matrix: one plane of bits for each bit of an id,
the highest first; each plane lists the ids in the order that the planes
above leave (zeros first, stably).  Planes are packed and compressed in chunks,
beside a directory of the ones before each chunk, so access, rank and select
read only the chunks they touch:

* ``access(i)``: the id at position i;
* ``rank(c, i)``: how often id c occurs before position i;
* ``select(c, k)``: the position of the k-th occurrence of c (from 0);
* ``count(c)``, ``positions(c)``: occurrences of c.

Shards come from a range partitioning by document key; a task closes a shard
at ``SHARD_TOKENS`` ids (a document is never cut, so only a document longer
than that makes a longer shard).  File names carry the task attempt, and
only files in the stored manifest are read.

Defined results: a null text is an empty one and yields the end id alone; a
null key sorts first; rows that share a key are ordered by the hash of their
text; texts of any length are one document of one shard; an empty table gives no
shards and no rows; only the key and the text are read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import open_in, open_out, release, stored, work_dir
from kestrel.llm.pieces import CACHED, GROUP_BYTES, PieceIds

END_ID = 0
SHARD_TOKENS = 1 << 20
CHUNK = 1 << 15                    # bytes of a packed plane that are compressed together
MAGIC = b"KWM1"

# Within this alphabet, and without apostrophes (contractions), the split below
# is the tokenizer's own; other texts are handed to the library whole.
_PLAIN = re.compile("[\t\n\r -&(-~¡-ɏ]*")
_LETTER, _DIGIT, _SPACE, _OTHER, _END = range(5)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte, and of each second byte after 0xC2."""
    one = np.full(256, _OTHER, np.uint8)
    for c in range(1, 128):
        ch = chr(c)
        one[c] = _LETTER if ch.isalpha() else _DIGIT if ch.isdigit() else _SPACE if ch in "\t\n\r " else _OTHER
    one[0], one[128:] = _END, _LETTER
    two = np.full(256, _OTHER, np.uint8)
    for ch in "ªµº":
        two[ch.encode()[1]] = _LETTER
    for ch in "²³¹¼½¾":
        two[ch.encode()[1]] = _DIGIT
    return one, two


_ONE, _TWO = _classes()


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Where the pieces of plain texts start; ``data`` is their UTF-8, a zero after each.

    A piece is a run of letters, digits or signs with one space before it if
    there is one; white space before that is a piece, as is a last white-space
    character that is no space; white space that ends a text is one piece."""
    kind = _ONE[data]
    at = np.flatnonzero(data == 0xC2)
    kind[at] = kind[at + 1] = _TWO[data[at + 1]]
    at = np.flatnonzero(data == 0xC3)
    at = at[(data[at + 1] == 0x97) | (data[at + 1] == 0xB7)]          # × and ÷
    kind[at] = kind[at + 1] = _OTHER
    space = kind == _SPACE
    start = np.empty(len(data), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[1:] |= kind[1:] == _END
    start[:-1] |= space[:-1] & ~space[1:] & (kind[1:] != _END)
    start[1:] &= ~((data[:-1] == 0x20) & ~space[1:] & (kind[1:] != _END))
    return np.flatnonzero(start)


class Encoder:
    """Token ids of texts by a byte-level tokenizers file.

    The library splits a text into pieces and encodes each by itself.  Plain
    texts are split here, many at a time, and the library is asked for pieces
    that are not remembered only; other texts go to it whole.  ``special``:
    whether the special tokens' strings in a text stand for these tokens."""

    def __init__(self, path: str, cached: int = CACHED, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks fill the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.pieces = PieceIds(self._learn, cached)

    def _learn(self, pieces: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(
            [p.decode().rstrip("\0") for p in pieces], add_special_tokens=False)]

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        starts = piece_starts(data)
        ids, into = self.pieces.ids(data, starts)
        return np.split(ids, into[data[starts] == 0])[:-1]

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; ``GROUP_BYTES`` of texts are held at a time."""
        out: list[np.ndarray | None] = []
        held, size = [], 0
        for text in texts:
            if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
                out.append(np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            held.append((len(out), text.encode()))
            size += len(held[-1][1])
            out.append(None)
            if size >= GROUP_BYTES:
                yield from self._filled(out, held)
                out, held, size = [], [], 0
        yield from self._filled(out, held)

    def _filled(self, out: list, held: list[tuple[int, bytes]]) -> list[np.ndarray]:
        if held:
            for (k, _), ids in zip(held, self._plain([t for _, t in held])):
                out[k] = ids
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which tasks share one after another."""
    return Encoder(path)


# --- the matrix -------------------------------------------------------------

def pack(ids: np.ndarray, keys: list, lengths: list[int]) -> bytes:
    """The file of a shard: header, directories, compressed document index and planes."""
    ids = np.ascontiguousarray(ids, np.uint32)
    bits = max(1, int(ids.max(initial=0)).bit_length())
    if bits <= 16:
        ids = ids.astype(np.uint16)
    zeros, ones, sizes, blobs, packer = [], [], [], [], zstandard.ZstdCompressor(1)
    for level in range(bits - 1, -1, -1):
        plane = ids & ids.dtype.type(1 << level) != 0
        packed = np.packbits(plane)
        ones += np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), CHUNK), dtype=np.int64).tolist() if len(packed) else []
        packed = packed.tobytes()
        chunks = [packed[i:i + CHUNK] for i in range(0, len(packed), CHUNK)]
        small = [packer.compress(c) for c in chunks]
        sizes += map(len, small)
        blobs += small
        zero = ids.take(np.flatnonzero(~plane))
        zeros.append(len(zero))
        ids = np.concatenate([zero, ids.take(np.flatnonzero(plane))])
    index = zlib.compress(np.asarray(lengths, "<i8").tobytes() + b"".join(
        struct.pack("<?q", k is not None, k or 0) for k in keys), 6)
    head = struct.pack("<4sBxxxqqq", MAGIC, bits, len(ids), len(lengths), len(index))
    return b"".join([head, np.asarray(zeros, "<i8").tobytes(), np.asarray(ones, "<i4").tobytes(),
                     np.asarray(sizes, "<i4").tobytes(), index, *blobs])


class WaveletMatrix:
    """Reads a shard from a random-access binary file."""

    def __init__(self, file):
        self.file, self.unpacker = file, zstandard.ZstdDecompressor()
        size = struct.calcsize("<4sBxxxqqq")
        magic, self.bits, self.n, self.docs, index = struct.unpack("<4sBxxxqqq", file.read(size))
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.chunks = -(-((self.n + 7) // 8) // CHUNK)
        count = self.bits * self.chunks
        self.zeros = np.frombuffer(file.read(8 * self.bits), "<i8")
        ones = np.frombuffer(file.read(4 * count), "<i4").reshape(self.bits, self.chunks)
        self.ones = np.concatenate([np.zeros((self.bits, 1), np.int64), np.cumsum(ones, axis=1)], axis=1)
        self.sizes = np.frombuffer(file.read(4 * count), "<i4")
        raw = zlib.decompress(file.read(index))
        self.lengths = np.frombuffer(raw[:8 * self.docs], "<i8")
        self.keys = [k if there else None for there, k in struct.iter_unpack("<?q", raw[8 * self.docs:])]
        self.offsets = file.tell() + np.concatenate([[0], np.cumsum(self.sizes)])
        self.held: dict[tuple[int, int], np.ndarray] = {}

    def _chunk(self, level: int, c: int) -> np.ndarray:
        if (level, c) not in self.held:
            if len(self.held) > 64:
                self.held.clear()
            k = level * self.chunks + c
            self.file.seek(int(self.offsets[k]))
            self.held[level, c] = np.frombuffer(self.unpacker.decompress(self.file.read(int(self.sizes[k]))), np.uint8)
        return self.held[level, c]

    def _bit(self, level: int, i: int) -> int:
        c, at = divmod(i, 8 * CHUNK)
        return int(self._chunk(level, c)[at >> 3] >> (7 - (at & 7))) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        c, at = divmod(i, 8 * CHUNK)
        if not at:
            return int(self.ones[level, c])
        part = self._chunk(level, c)[:(at + 7) >> 3].tobytes()
        return int(self.ones[level, c]) + (int.from_bytes(part) >> (-at % 8)).bit_count()

    def _find(self, level: int, bit: int, ks: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) given bits of a plane; each chunk is unpacked once."""
        before = self.ones[level] if bit else np.minimum(
            np.arange(self.chunks + 1) * 8 * CHUNK, self.n) - self.ones[level]
        chunk = np.searchsorted(before, ks, side="right") - 1
        out = np.empty(len(ks), np.int64)
        for c in np.unique(chunk).tolist():
            mine = chunk == c
            there = np.flatnonzero(np.unpackbits(self._chunk(level, c)) == bit)
            out[mine] = c * 8 * CHUNK + there[ks[mine] - before[c]]
        return out

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for level in range(self.bits):
            one = self._ones(level, i)
            bit = self._bit(level, i)
            i = int(self.zeros[level]) + one if bit else i - one
            out = out << 1 | bit
        return out

    def _range(self, c: int, i: int) -> tuple[int, int]:
        """The range of the ids c before position i, below the last plane."""
        low = 0
        if c >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, i)
            if c >> (self.bits - 1 - level) & 1:
                low, i = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, i = low - a, i - b
        return low, i

    def rank(self, c: int, i: int) -> int:
        low, high = self._range(c, min(i, self.n))
        return high - low

    def count(self, c: int) -> int:
        return self.rank(c, self.n)

    def _select(self, c: int, first: int, last: int) -> np.ndarray:
        """Positions of the occurrences of c from ``first`` to before ``last``, up the planes together."""
        low, _ = self._range(c, self.n)
        at = np.arange(low + first, low + last)
        for level in range(self.bits - 1, -1, -1):
            bit = c >> (self.bits - 1 - level) & 1
            at = self._find(level, bit, at - int(self.zeros[level]) if bit else at)
        return at

    def select(self, c: int, k: int) -> int:
        if not 0 <= k < self.count(c):
            raise IndexError(k)
        return int(self._select(c, k, k + 1)[0])

    def positions(self, c: int) -> list[int]:
        return self._select(c, 0, self.count(c)).tolist()

    def ids(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            plane = np.concatenate([self._chunk(level, c) for c in range(self.chunks)]) if self.n else np.zeros(0, np.uint8)
            ones = np.unpackbits(plane, count=self.n).view(bool)
            zero, up = int(self.zeros[level]), np.empty(self.n, kind)
            up[~ones] = out[:zero]
            up[ones] = out[zero:] | kind(1 << (self.bits - 1 - level))
            out = up
        return out


# --- Spark ------------------------------------------------------------------

def write_shards(docs: DataFrame, tokenizer_path: str, out_dir: str, id_col="doc_id",
                 text_col="text", end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode ``docs`` into shard files; returns the stored manifest
    (part, shard, path, docs, tokens), in key order by (part, shard)."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        encode_all, end = encoder(tokenizer_path).encode_all, np.asarray([end_id], np.uint32)
        held, keys, lengths, done, tokens = [], [], [], [], 0

        def close() -> None:
            path = f"{out_dir}/shards/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):05d}.kwm"
            with open_out(path) as out:
                out.write(pack(np.concatenate(held), keys, lengths))
            done.append((task.partitionId(), len(done), path, len(lengths), sum(lengths)))
            held.clear(), keys.clear(), lengths.clear()

        for part in parts:
            for key, ids in zip(part["key"].array, encode_all(part["text"].tolist())):
                ids = np.concatenate([ids, end])
                if lengths and tokens + len(ids) > shard_tokens:
                    close()
                    tokens = 0
                tokens += len(ids)
                held.append(ids)
                keys.append(None if pd.isna(key) else int(key))
                lengths.append(len(ids))
        if lengths:
            close()
        release()
        yield pd.DataFrame(done, columns=["part", "shard", "path", "docs", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("key", "tie")
            .sortWithinPartitions("key", "tie").select("key", "text"))
    return stored(rows.mapInPandas(write, "part int, shard int, path string, docs long, tokens long"),
                  f"{out_dir}/manifest", files=4)


def read_shards(manifest: DataFrame, task_tokens: int = 4 * SHARD_TOKENS) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, base in zip(part.path, part.base):
                with open_in(path) as file:
                    matrix = WaveletMatrix(file)
                    ids = matrix.ids().astype("<u4")
                ends = np.cumsum(matrix.lengths)
                yield pd.DataFrame({
                    "doc_id": pd.array(matrix.keys, "Int64"),
                    "start": int(base) + ends - matrix.lengths, "n_tokens": matrix.lengths,
                    "ids_crc32": [zlib.crc32(ids[e - n:e]) for e, n in zip(ends, matrix.lengths)]})
        release()

    # ids before a shard: running sums inside its task's shards, and over the
    # sums of the writing tasks (one number each)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = manifest.groupBy("part").agg(F.sum("tokens").alias("sum"))
    tasks = tasks.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    placed = manifest.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    placed = placed.join(tasks, "part").select("path", (F.col("before") + F.col("inside")).alias("base"))
    tasks = 1 + (manifest.agg(F.sum("tokens")).first()[0] or 0) // task_tokens
    return placed.repartition(tasks).mapInPandas(
        scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, tokenizer_path: str, out_dir: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` and read every document back."""
    out_dir = out_dir or work_dir(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, tokenizer_path, out_dir))
