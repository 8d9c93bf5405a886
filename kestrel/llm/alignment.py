"""Alignment of two tokenizers' tokens over the same bytes.

Every text, with one space before it, is cut into tokens by a byte-level model (A)
and by a SentencePiece model (B).  Both cuts tile the same bytes, so tokens that
overlap form chains; a chain ends where tokens of both sides end together.

Chains are found by pointer jumping over many texts at a time: each token points
to the farthest-right token of the other side that overlaps it (a token of B
that ends together with one of A points to itself), and the pointers are doubled,
``to = to[to]``, until none changes.  Every token then points to the last token of its
group; after k rounds chains of 2^k tokens are settled.

The last tokens of a group end together and are a *link* of an A id and a B id.
Of two tokens that end together the shorter one's bytes are a suffix of the
longer one's, so at most one pair exists for each suffix of each vocabulary
entry: ``most_pairs`` (about half a million here, whatever the corpus) bounds
the table of pair counts, which is therefore sent to the tasks; counts are
summed inside each task first.

Defined results: a null or empty text, and one whose tokens do not give its
bytes back (U+2581 in it), has no tokens: zeros and an empty digest.  Texts of any
length are aligned whole, one at a time in memory.  Rows are aligned one by one, so
repeated rows count repeatedly and null keys stay; an empty table gives
no rows; only the key and the text are read, whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import sentences, wavelet
from kestrel.llm.common import release, stored, work_dir
from kestrel.llm.pieces import CACHED
from kestrel.llm.sentences import _table, gathered

GROUP_BYTES = 1 << 19              # of texts that are aligned together
GROUP_ROWS = 512                   # rows of a frame that a task returns
HELD_LINKS = 1 << 20               # links that a task holds before it counts them


def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes of each entry of a byte-level model: printable bytes stand for
    themselves, the others for the characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {chr(b): b for b in shown}
    of.update({chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))})
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    entries = dict(model["model"]["vocab"])
    out = [b""] * (max(entries.values()) + 1)
    for piece, i in entries.items():
        out[i] = bytes(of[c] for c in piece) if all(c in of for c in piece) else piece.encode()
    return out


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = wavelet.Encoder(path_a, CACHED // 2, False), sentences.Encoder(path_b, CACHED // 2)
        self.bytes_a, self.starts_a = _table(byte_level_bytes(path_a))
        self.bytes_b, self.starts_b = self.b.model.bytes, self.b.model.byte_starts

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of A and B of each text, none where they do not give its bytes."""
        spaced = [" " + t if t else "" for t in texts]
        none = np.zeros(0, np.uint32)
        for text, a, b in zip(spaced, self.a.encode_all(spaced), self.b.encode_all(texts), strict=True):
            whole = text.encode()
            same = all(gathered(table, starts, ids)[0].tobytes() == whole for table, starts, ids in (
                (self.bytes_a, self.starts_a, a), (self.bytes_b, self.starts_b, b)))
            yield (a, b) if same else (none, none)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group (from 0) of each token of A and of B, over the same bytes."""
        return overlap_groups(np.diff(self.starts_a)[a], np.diff(self.starts_b)[b])


def overlap_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (from 0) of each token, from the two sides' token lengths."""
    n, end_a, end_b = len(a), np.cumsum(a), np.cumsum(b)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # nodes: tokens of A, then those of B; the last token of the other side
    # that starts before this one ends is the farthest-right one to overlap it
    last_b = np.searchsorted(end_b - b, end_a) - 1
    last_a = np.searchsorted(end_a - a, end_b) - 1
    closes = end_a[last_a] == end_b
    to = np.concatenate([n + last_b, np.where(closes, n + np.arange(len(b)), last_a)])
    while True:
        further = to[to]
        if (further == to).all():
            break
        to = further
    label = np.cumsum(closes) - 1
    return label[to[:n] - n], label[to[n:] - n]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker, which tasks share one after another."""
    return Aligner(path_a, path_b)


def _groups(parts: Iterator[pd.DataFrame], both: Aligner) -> Iterator[tuple]:
    """For texts of about ``GROUP_BYTES`` together: their keys, the ids of A and B of
    each, how many tokens of A and of B the groups have, and how many groups each text has."""

    def of(keys: list, pairs: list) -> tuple:
        a, b = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        of_a, of_b = both.groups(a, b)
        groups = int(of_b[-1]) + 1 if len(of_b) else 0
        # a text ends with a group: the one of its last token
        ends = np.cumsum([len(p[1]) for p in pairs])
        upto = np.append(0, of_b + 1)[ends]
        return (pd.array(keys, "Int64"), pairs, a, b, np.bincount(of_a, minlength=groups),
                np.bincount(of_b, minlength=groups), np.diff(np.append(0, upto)))

    for part in parts:
        for at in range(0, len(part), GROUP_ROWS):
            rows = part.iloc[at:at + GROUP_ROWS]
            keys, pairs, size = [], [], 0
            for key, text, pair in zip(rows["key"].array, rows["text"], both.tokens(rows["text"].tolist())):
                keys.append(None if pd.isna(key) else int(key))
                pairs.append(pair)
                size += len(text)
                if size >= GROUP_BYTES:
                    yield of(keys, pairs)
                    keys, pairs, size = [], [], 0
            if keys:
                yield of(keys, pairs)
        release()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: ``doc_id``, the ids ``a_ids`` and ``b_ids``, and
    ``a_groups`` and ``b_groups``, how many tokens of each side a group has (all
    as little-endian unsigned 32-bit integers)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed = lambda rows: [x.astype("<u4").tobytes() for x in rows]
        for keys, pairs, _, _, in_a, in_b, n in _groups(parts, aligner(path_a, path_b)):
            cuts = np.cumsum(n)[:-1]
            yield pd.DataFrame({
                "doc_id": keys, "a_ids": packed(p[0] for p in pairs), "b_ids": packed(p[1] for p in pairs),
                "a_groups": packed(np.split(in_a, cuts)), "b_groups": packed(np.split(in_b, cuts))})

    return _texts(docs, id_col, text_col).mapInPandas(
        run, "doc_id long, a_ids binary, b_ids binary, a_groups binary, b_groups binary")


_DIGITS = _table([b"%d," % i for i in range(1 << 17)])


def written_groups(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text, from the ids of all texts, their groups'
    numbers of tokens and the texts' numbers of groups."""
    # the tokens in the order they are written: of each group A's, then B's
    ends_a, ends_b = np.cumsum(in_a), np.cumsum(in_b)
    ids = np.empty(len(a) + len(b), np.int32)
    ids[np.arange(len(a)) + np.repeat(ends_b - in_b, in_a)] = a
    ids[np.arange(len(b)) + np.repeat(ends_a, in_b)] = b
    text, into = gathered(*_DIGITS, ids)
    if len(ids):
        text[into[ends_a + ends_b - in_b - 1] - 1] = ord("|")
        text[into[ends_a + ends_b - 1] - 1] = ord(";")
    last = np.append(0, into)[np.append(0, ends_a + ends_b)[np.append(0, np.cumsum(n))]]
    return [text[s:max(s, e - 1)].tobytes() for s, e in zip(last[:-1].tolist(), last[1:].tolist())]


def links(docs: DataFrame, path_a: str, path_b: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Digests and links of the aligned documents: doc_id, n_a, n_b, n_groups,
    groups_sha256, and ``links``, of each group A's last id times 2^32 plus B's
    (little-endian 64-bit integers)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, pairs, a, b, in_a, in_b, n in _groups(parts, aligner(path_a, path_b)):
            last = a[np.cumsum(in_a) - 1].astype(np.int64) << 32 | b[np.cumsum(in_b) - 1]
            yield pd.DataFrame({
                "doc_id": keys, "n_a": [len(p[0]) for p in pairs], "n_b": [len(p[1]) for p in pairs], "n_groups": n,
                "groups_sha256": [hashlib.sha256(w).hexdigest() if w else "" for w in
                                  written_groups(a, b, in_a, in_b, n)],
                "links": [x.astype("<i8").tobytes() for x in np.split(last, np.cumsum(n)[:-1])]})

    return _texts(docs, id_col, text_col).mapInPandas(
        run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary")


def link_counts(linked: DataFrame) -> DataFrame:
    """How many links of all documents hold each pair: pair, count, and ``best``,
    whether no other A id has more links with the B id (ties are all best)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds, counts, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def counted() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            both, which = np.unique(np.concatenate([kinds, new]), return_inverse=True)
            return both, np.bincount(which, np.concatenate([counts, n]), len(both)).astype(np.int64)

        for part in parts:
            for x in part["links"]:
                held.append(np.frombuffer(x, "<i8"))
                size += len(held[-1])
                if size >= HELD_LINKS:
                    kinds, counts = counted()
                    held, size = [], 0
        kinds, counts = counted()
        yield pd.DataFrame({"pair": kinds, "count": counts})
        release()

    counts = linked.select("links").mapInPandas(run, "pair long, count long")
    counts = counts.groupBy("pair").agg(F.sum("count").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def most_pairs(path_a: str, path_b: str) -> int:
    """Pairs that can end together: one for each suffix of each entry."""
    return sum(map(len, byte_level_bytes(path_a))) + len(sentences.Model(path_b).bytes)


def scored(linked: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """The rows of :func:`links` with n_links, n_best and count_sum.  ``counts``
    has at most ``most`` rows (of 17 bytes) and is sent to every task."""
    table = counts.toPandas().sort_values("pair")
    if len(table) > most:
        raise ValueError(f"{len(table)} pairs, of {most} that tokens can make")
    sent = linked.sparkSession.sparkContext.broadcast(
        (table["pair"].to_numpy(np.int64), table["count"].to_numpy(np.int64), table["best"].to_numpy(bool)))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, count, best = sent.value
        for part in parts:
            rows = [np.searchsorted(pair, np.frombuffer(x, "<i8")) for x in part["links"]]
            yield part.drop(columns="links").assign(
                doc_id=part["doc_id"].astype("Int64"), n_links=[len(r) for r in rows],
                n_best=[int(best[r].sum()) for r in rows], count_sum=[int(count[r].sum()) for r in rows])
        release()

    kept = [c for c in linked.columns if c != "links"]
    schema = ", ".join(f"{c} {linked.schema[c].dataType.simpleString()}" for c in kept)
    return linked.mapInPandas(run, f"{schema}, n_links long, n_best long, count_sum long")


def alignment_report(docs: DataFrame, path_a: str, path_b: str, out_dir: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    out_dir = out_dir or work_dir(docs.sparkSession, "alignment")
    linked = stored(links(docs, path_a, path_b), f"{out_dir}/links", compression="zstd")
    counts = stored(link_counts(linked), f"{out_dir}/counts", files=1)
    return scored(linked, counts, most_pairs(path_a, path_b)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
