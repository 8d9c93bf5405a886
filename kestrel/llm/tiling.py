"""Benchmark decontamination by greedy string tiling.

1. Words (letters, digits and underscores, lower-cased) are hashed, and runs of
   ``TILE`` words by a running Karp-Rabin hash (an item shorter than that is one
   run).  Documents meet items where a run's hash is equal: a seed (i, j) is a
   place in the item and one in the document.  While the benchmark's runs are
   at most ``MOST_BROADCAST`` they are sent to the tasks, each of which then
   reads its documents once, ``SEEDS_AT_ONCE`` seeds at a time: what a repetitive
   text keeps is its matches, not its seeds.  Beyond that seeds come from a join
   on the hash.
2. Pairs whose seeds cannot reach the threshold, even if no two tiles competed
   for a word, are dropped.
3. Tiling: seeds that follow one another on a diagonal j - i are a match; the
   longest match whose words are all free becomes a tile and marks its words
   on both sides; a partly marked match is cut to its free stretches and comes
   back in its turn; matches end at ``TILE`` words.  Passages may stand in any
   order in the document, and no word serves twice.
4. A pair is contaminated if tiles cover at least ``COVERAGE`` of the item.

Defined results: null or empty texts and items are contaminated with nothing;
several items of one item_id are told apart by their text; repeated documents
are reported once for each different (doc_id, text); rows with a null doc_id
or item_id are reported with it; texts of any length are read whole; an empty table of
either kind gives no rows; only keys and texts are read (``without_contaminated``
returns all columns, whatever their names).  Words and runs are told by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import release, stored, unused, work_dir

TILE = 5
COVERAGE = 0.8
MOST_BROADCAST = 1 << 20         # runs of the benchmark: 32 MB in a task
SEEDS_AT_ONCE = 1 << 20
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def word_hashes(text: str) -> np.ndarray:
    found = _WORD.findall(text.lower())
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` words."""
    out = np.full(max(0, len(words) - length + 1), length, np.uint64)
    for k in range(length):
        out = out * _BASE + words[k:k + len(out)]
    return (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def matches(i: np.ndarray, j: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(item place, document place, seeds) of the maximal matches on the diagonals, from seeds,
    or from shorter matches of ``n`` seeds each that do not overlap."""
    n = np.ones(len(i), np.int64) if n is None else np.asarray(n, np.int64)
    i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
    order = np.lexsort((i, j - i))
    i, j, n = i[order], j[order], n[order]
    first = np.concatenate([[True], (np.diff(j - i) != 0) | (i[1:] != i[:-1] + n[:-1])]) if len(i) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    return i[start], j[start], np.add.reduceat(n, start) if len(start) else n


def covered(i: np.ndarray, n: np.ndarray, length: int, words: int) -> int:
    """Words of the item inside any match: what tiles can cover at most."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, i, 1)
    np.add.at(edge, i + n + length - 1, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def tiles(i: np.ndarray, j: np.ndarray, length: int, n: np.ndarray | None = None,
          words: int | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles (item place, document place, words) from seeds of ``length`` words, or
    from matches of ``n`` seeds; ``words`` of the item: once they are all marked nothing follows."""
    i, j, n = matches(i, j, n)
    heap = [(-int(k) - length + 1, int(a), int(b)) for k, a, b in zip(n, i, j)]
    heapq.heapify(heap)
    item, doc, out = set(), set(), []
    while heap and (words is None or words - len(item) >= length):
        n, a, b = heapq.heappop(heap)
        free = [a + k not in item and b + k not in doc for k in range(-n)]
        if all(free):
            out.append((a, b, -n))
            item.update(range(a, a - n))
            doc.update(range(b, b - n))
            continue
        at = 0
        for k in range(-n + 1):
            if k == -n or not free[k]:
                if k - at >= length:
                    heapq.heappush(heap, (at - k, a + at, b + at))
                at = k + 1
    return out


def _item_runs(items: DataFrame, id_col: str, text_col: str, tile: int) -> DataFrame:
    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for item, key, text in zip(part["item_id"], part["item_key"], part["text"]):
                w = word_hashes(text)
                length = min(tile, len(w))
                if length:
                    out += [(item, key, len(w), length, i, h) for i, h in enumerate(run_hashes(w, length).view(np.int64))]
            yield pd.DataFrame(out, columns=["item_id", "item_key", "words", "length", "i", "hash"]).astype({"item_id": "Int64"})

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("item_key", F.xxhash64("item_id", "text")).dropDuplicates(["item_key"])
    return rows.mapInPandas(scan, "item_id long, item_key long, words int, length int, i int, hash long")


SEEDS = ("doc_id long, text_hash long, item_id long, item_key long, words int, length int, "
         "i array<int>, j array<int>, n array<int>")


def _met(hashes: np.ndarray, h: np.ndarray, of: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """(item, item place, document place, seeds) of the matches of a document's runs ``h`` with
    the sorted ``hashes`` of items' runs; ``of`` and ``places`` tell the item and the place."""
    low, high = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
    there = np.flatnonzero(high > low)
    many = high[there] - low[there]
    upto = np.cumsum(many)
    kept, at = [], 0
    while at < len(there):
        # as many places of the document as have so many seeds, at least one
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SEEDS_AT_ONCE, side="right")))
        j = np.repeat(there[at:end], many[at:end])
        row = np.arange(len(j)) - np.repeat(np.cumsum(many[at:end]) - many[at:end], many[at:end]) + np.repeat(
            low[there[at:end]], many[at:end])
        kept.append(_of_items(of[row], places[row], j, np.ones(len(j), np.int64)))
        at = end
    if not kept:
        return (np.zeros(0, np.int64),) * 4
    return kept[0] if len(kept) == 1 else _of_items(*map(np.concatenate, zip(*kept)))


def _of_items(item: np.ndarray, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`matches` of many items at once."""
    order = np.lexsort((i, j - i, item))
    item, i, j, n = item[order], i[order], j[order], n[order]
    first = np.append(True, (item[1:] != item[:-1]) | (np.diff(j - i) != 0) | (i[1:] != i[:-1] + n[:-1]))
    start = np.flatnonzero(first)
    return item[start], i[start], j[start], np.add.reduceat(n, start)


def _seeds_in_tasks(docs: DataFrame, runs: pd.DataFrame, coverage: float) -> DataFrame:
    """Matches of each pair that can reach the coverage, by looking up each document's runs in ``runs``."""
    # by length: the sorted hashes, of which item each is, its place; and the items
    tables = {}
    for length, rows in runs.groupby("length"):
        rows = rows.sort_values("hash", ignore_index=True)
        items = rows.drop_duplicates("item_key")[["item_key", "item_id", "words"]].reset_index(drop=True)
        number = pd.Series(items.index, items["item_key"])
        names = [None if pd.isna(i) else int(i) for i in items["item_id"]]
        tables[int(length)] = (rows["hash"].to_numpy(), number[rows["item_key"]].to_numpy(np.int64),
                               rows["i"].to_numpy(np.int64), list(zip(items["item_key"].tolist(), names, items["words"].tolist())))
    sent = docs.sparkSession.sparkContext.broadcast((tables, coverage))

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables, least = sent.value
        for part in parts:
            out = []
            for doc_id, key, text in zip(part["doc_id"], part["text_hash"], part["text"]):
                w = word_hashes(text)
                for length, (hashes, of, places, items) in tables.items():
                    item, i, j, n = _met(hashes, run_hashes(w, length).view(np.int64), of, places)
                    cut = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else []
                    for s, e in zip(cut, np.append(cut[1:], len(item))):
                        item_key, name, size = items[item[s]]
                        if covered(i[s:e], n[s:e], length, size) >= least * size:
                            out.append((doc_id, key, name, item_key, size, length, i[s:e], j[s:e], n[s:e]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SEEDS.split(", ")]).astype(
                {"doc_id": "Int64", "item_id": "Int64"})
        _hashes.clear()
        release()

    return docs.mapInPandas(scan, SEEDS)


def _seeds_by_join(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The same seeds, by a join on the hash."""
    lengths = [r["length"] for r in runs.select("length").distinct().collect()]    # 1 to TILE

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for doc_id, key, text in zip(part["doc_id"], part["text_hash"], part["text"]):
                w = word_hashes(text)
                for length in lengths:
                    h = run_hashes(w, length).view(np.int64)
                    yield pd.DataFrame({"doc_id": pd.array([doc_id] * len(h), "Int64"), "text_hash": key,
                                        "length": length, "j": np.arange(len(h), dtype=np.int32), "hash": h})

    places = docs.mapInPandas(scan, "doc_id long, text_hash long, length int, j int, hash long")
    met = places.join(runs, ["length", "hash"]).groupBy(
        "doc_id", "text_hash", "item_id", "item_key", "words", "length").agg(
        F.array_sort(F.collect_set(F.struct("i", "j"))).alias("s"))
    return met.select("doc_id", "text_hash", "item_id", "item_key", "words", "length",
                      F.col("s.i").alias("i"), F.col("s.j").alias("j"),
                      F.array_repeat(F.lit(1), F.size("s")).alias("n"))


def contaminated(docs: DataFrame, items: DataFrame, tile: int = TILE, coverage: float = COVERAGE,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", most_broadcast: int = MOST_BROADCAST,
                 path: str | None = None) -> DataFrame:
    """doc_id, text_hash, item_id, tiles, matched_words, item_words, coverage of the
    contaminated pairs."""
    path = path or work_dir(docs.sparkSession, "tiling")
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    runs = stored(_item_runs(items, item_col, item_text_col, tile), f"{path}/runs")
    few = runs.count() <= most_broadcast
    seeds = _seeds_in_tasks(given, runs.toPandas(), coverage) if few else _seeds_by_join(given, runs)

    def tiled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "text_hash", "item_id", "tiles", "matched_words", "item_words", "coverage"]
        for part in parts:
            out = []
            for r in part.itertuples():
                i, j, n = matches(r.i, r.j, r.n)
                if covered(i, n, r.length, r.words) < coverage * r.words:
                    continue
                found = tiles(i, j, r.length, n, r.words)
                matched = sum(n for _, _, n in found)
                if matched >= coverage * r.words:
                    out.append((r.doc_id, r.text_hash, r.item_id, len(found), matched, r.words, matched / r.words))
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64", "item_id": "Int64"})

    pairs = seeds.mapInPandas(tiled, "doc_id long, text_hash long, item_id long, tiles long, "
                                     "matched_words long, item_words long, coverage double")
    return pairs.dropDuplicates()


def without_contaminated(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", **kw) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay."""
    bad = contaminated(docs, items, id_col=id_col, text_col=text_col, **kw)
    key, digest, own = unused(docs.columns, "__id", "__hash", "__text")
    bad = stored(bad.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest)).distinct(),
                 f"{work_dir(docs.sparkSession, 'contaminated')}/ids")
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.join(bad, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(digest)), "left_anti").drop(own)
