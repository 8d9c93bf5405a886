"""Encoding and decoding by a SentencePiece BPE model, in vectorised merge rounds.

A text is one space and itself (an empty text stays empty), spaces written as
U+2581.  It is cut into words where no piece of the model spans two neighbouring
characters: before a run of spaces, and inside a word at pairs of characters
that no piece holds.  Merges never cross such a cut, so words are independent.

New words are encoded many at a time over flat arrays, a symbol per character:

* every pair of neighbouring symbols has the rank of the piece it would make;
* in each round every word finds its least rank (a segmented minimum) and merges
  its leftmost pair of that rank, all words at once;
* merged symbols are compacted, only the pairs beside them are ranked anew, and
  words without a pair leave.  Rounds go on until no pair remains.

A word takes more than one merge of a round only where this equals taking them
one after another: all pairs of a piece that no better-ranked piece can grow from,
and for any other piece the pairs whose distance from the one before is over
twice the longest piece, since what a merge sets off stays inside one piece.

Words are remembered by their bytes (:mod:`kestrel.llm.pieces`).  Characters
outside the model become their UTF-8 bytes.  Decoding maps ids to bytes, drops one
leading space and writes U+FFFD for each byte that is not UTF-8.

Defined results: a null text is an empty one (begin and end id only, decoded
empty); texts of any length are encoded whole, one at a time in memory; each row is
encoded by itself, so repeated rows and null keys stay; an empty table gives
no rows; other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import release
from kestrel.llm.pieces import CACHED, GROUP_BYTES, PieceIds

_SPACE = "▁"
_NONE = np.int32(1 << 30)          # the rank of a pair that makes no piece
_BREAK = 0xFF                      # stands between texts: never a byte of UTF-8
GROUP_ROWS = 1024                  # documents of a frame that a task returns


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("kestrel-each-byte", _each_byte)


class Model:
    """The tables of a model file: pieces, ranks of mergeable pairs, bytes of ids."""

    def __init__(self, path: str):
        import sentencepiece
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = lib.get_piece_size()
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        # whose leading space is no word start: the unknown token and the byte 0x20
        self.spaceless = {lib.unk_id(), *(i for i in range(n) if lib.is_byte(i))}
        pieces = [lib.id_to_piece(i) for i in range(n)]
        odd = {i for i in range(n) if lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)}
        self.byte_ids = np.zeros(256, np.uint32)
        text = []
        for i, piece in enumerate(pieces):
            if lib.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                text.append(bytes([int(piece[3:5], 16)]))
                odd.add(i)
            elif lib.is_unknown(i):
                text.append(lib.decode([i]).encode())
            else:
                text.append(b"" if i in odd else piece.replace(_SPACE, " ").encode())
        self.bytes, self.byte_starts = _table(text)
        normal = {p: i for i, p in enumerate(pieces) if i not in odd}
        if any(not p for p in normal) or len(np.unique(self.byte_ids)) != 256:
            raise ValueError("a BPE model with byte fallback is needed")
        self.longest = max(map(len, normal))
        # ids of single characters
        self.char_ids = np.zeros(0x110000, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        # a higher score is a better (smaller) rank; equal scores share one
        _, rank = np.unique([-lib.get_score(i) for i in range(n)], return_inverse=True)
        rank = rank.astype(np.int32)
        shared = set(np.flatnonzero(np.bincount(rank[list(normal.values())]) > 1).tolist())
        pairs, self.simple = {}, np.ones(int(rank.max()) + 1, bool)
        self.simple[list(shared)] = False
        inside = set()
        for p, i in normal.items():
            for k in range(1, len(p)):
                inside.add(ord(p[k - 1]) << 21 | ord(p[k]))
                a, b = normal.get(p[:k]), normal.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
                    for part in (a, b):              # a better piece can grow from this part
                        if rank[i] <= rank[part]:
                            self.simple[rank[part]] = False
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], np.int32)
        self.ranks = rank[self.merged]
        self.inside = np.array(sorted(inside), np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The row in ``pairs`` of neighbouring symbols, -1 where they make no piece."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, -1).astype(np.int32)


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Entries one after another, and where each starts (and the last one ends)."""
    starts = np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), starts


def gathered(table: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``rows`` one after another, and where each ends."""
    begin = starts[rows]
    count = starts[rows + 1] - begin
    into = np.cumsum(count)
    total = int(into[-1]) if len(into) else 0
    return table[np.arange(total) + np.repeat(begin - into + count, count)], into


def merge_rounds(model: Model, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the words that start at ``starts`` until no pair remains.

    Returns the symbols left, word by word, and the number of each word's."""
    n = len(starts)
    word = np.repeat(np.arange(n), np.diff(np.append(starts, len(symbols))))
    place = np.arange(len(symbols))              # of a symbol's first character
    found = np.full(len(symbols), -1, np.int32)  # pair of a symbol with the next one
    inner = np.flatnonzero(word[1:] == word[:-1])
    found[inner] = model.pair(symbols[inner], symbols[inner + 1])
    rank = np.where(found >= 0, model.ranks[found], _NONE)
    done = []
    reach = 2 * model.longest + 1
    while len(symbols):
        head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least = np.minimum.reduceat(rank, head)
        count = np.diff(np.append(head, len(symbols)))
        least = np.repeat(least, count)
        over = least == _NONE                    # words without a pair leave
        if over.any():
            done.append((place[over], symbols[over], word[over]))
            stay = ~over
            symbols, word, place, rank, found, least = (
                x[stay] for x in (symbols, word, place, rank, found, least))
            if not len(symbols):
                break
        at = np.flatnonzero(rank == least)
        simple = model.simple[rank[at]]
        gap = np.append(reach + 1, np.diff(at))
        gap[1:][word[at[1:]] != word[at[:-1]]] = reach + 1
        run = np.flatnonzero(gap > 1)            # of pairs that overlap every second one is merged
        odd = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) & 1
        at = at[np.where(simple, odd == 0, gap > reach)]
        symbols[at] = model.merged[found[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, word, place, rank, found = (x[stay] for x in (symbols, word, place, rank, found))
        at -= np.arange(len(at))                 # each merge before moves it by one
        touched = np.concatenate([at, at[at > 0] - 1])
        touched = touched[touched < len(symbols) - 1]
        same = word[touched] == word[touched + 1]
        found[at], rank[at] = -1, _NONE
        touched = touched[same]
        found[touched] = pair = model.pair(symbols[touched], symbols[touched + 1])
        rank[touched] = np.where(pair >= 0, model.ranks[pair], _NONE)
    place, symbols, word = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, int),) * 3
    return symbols[np.argsort(place, kind="stable")], np.bincount(word, minlength=n)


class Encoder:
    """Encodes and decodes texts; equals the library's ``encode`` and ``decode``."""

    def __init__(self, path: str, cached: int = CACHED):
        self.model = Model(path)
        self.words = PieceIds(self._learn, cached)

    def _learn(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of words; a break has none."""
        texts = ["" if w[0] == _BREAK else w.decode().replace(" ", _SPACE) for w in words]
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        if not len(chars):
            return [np.zeros(0, np.uint32)] * len(words)
        # cut where no piece spans two characters
        cut = np.ones(len(chars), bool)
        key = chars[:-1] << 21 | chars[1:]
        at = np.minimum(np.searchsorted(self.model.inside, key), len(self.model.inside) - 1)
        cut[1:] = self.model.inside[at] != key
        cut[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        starts = np.flatnonzero(cut)
        symbols, count = merge_rounds(self.model, self.model.char_ids[chars], starts)
        # characters outside the model: their bytes
        outside = np.flatnonzero(symbols == 0)
        symbols, per = symbols.astype(np.uint32), np.ones(len(symbols), np.int64)
        if len(outside):
            strange = chars[starts[np.searchsorted(np.cumsum(count), outside, side="right")]]
            kinds, which = np.unique(strange, return_inverse=True)
            table, begins = _table([chr(c).encode() for c in kinds.tolist()])
            per[outside] = np.diff(begins)[which]
            ids = np.repeat(symbols, per)
            ids[np.repeat(symbols == 0, per)] = self.model.byte_ids[gathered(table, begins, which)[0]]
            symbols = ids
        # how many ids each cut part, then each word has
        ends = np.append(0, np.cumsum(per))[np.append(0, np.cumsum(count))]
        parts = np.append(0, np.cumsum(np.bincount(
            np.repeat(np.arange(len(words)), lengths)[starts], minlength=len(words))))
        return np.split(symbols, ends[parts][1:-1])

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order, without begin and end."""
        held, size = [], 0
        for text in texts:
            held.append(b" " + text.replace(_SPACE, " ").encode() if text else b"")
            size += len(held[-1])
            if size >= GROUP_BYTES:
                yield from self._encoded(held)
                held, size = [], 0
        if held:
            yield from self._encoded(held)

    def _encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
        space = data == 0x20
        stop = data == _BREAK
        start = stop.copy()
        start[0] = True
        start[1:] |= stop[:-1]
        start[1:] |= space[1:] & ~space[:-1]
        starts = np.flatnonzero(start)
        ids, into = self.words.ids(data, starts)
        return np.split(ids, into[data[starts] == _BREAK])[:-1]

    def token_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the tokens (U+2581 as a space) one after another, and where each ends."""
        return gathered(self.model.bytes, self.model.byte_starts, ids)

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids: control ids have none, one leading space goes."""
        ids = np.asarray(ids, np.int64)
        size = np.diff(self.model.byte_starts)[ids]
        silent = np.flatnonzero(size == 0)
        ids = np.delete(ids, silent)
        text, ends = self.token_bytes(ids)
        # the bytes of one character are neighbours: a control id between them breaks it
        breaks = np.unique(silent - np.arange(len(silent)))
        breaks = breaks[(breaks > 0) & (breaks < len(ids))]
        if len(ids) and ids[0] not in self.model.spaceless and text[0] == 0x20:
            text, ends = text[1:], ends - 1
        return "".join(part.tobytes().decode("utf-8", "kestrel-each-byte")
                       for part in np.split(text, ends[breaks - 1]))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which tasks share one after another."""
    return Encoder(path)


def encoded(docs: DataFrame, model_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (begin, tokens, end, as little-endian
    unsigned 32-bit integers) and ``decoded``, the text that these ids stand for."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(model_path)
        begin, end = np.uint32([coder.model.begin]), np.uint32([coder.model.end])
        for part in parts:
            for at in range(0, len(part), GROUP_ROWS):
                rows = part.iloc[at:at + GROUP_ROWS]
                ids = [np.concatenate([begin, x, end]) for x in coder.encode_all(rows["text"].tolist())]
                yield pd.DataFrame({"doc_id": rows["doc_id"].array, "ids": [x.astype("<u4").tobytes() for x in ids],
                                    "decoded": [coder.decode(x) for x in ids]})
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # one group of columns for the worker; a null key stays null
    return rows.mapInPandas(_null_keys(run), "doc_id long, ids binary, decoded string")


def _null_keys(run):
    def keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return run(part.assign(doc_id=part["doc_id"].astype("Int64")) for part in parts)
    return keyed


def encoding_report(docs: DataFrame, model_path: str) -> DataFrame:
    """Digest columns of :func:`encoded`: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded(docs, model_path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
