"""Removal of repeated strings by suffix sorting in shards.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed.  Two equal windows must meet, wherever they lie:

1. A window is filed under the least hash of the ``SEED``-byte strings inside
   it.  Neighbouring windows mostly share it; they form one segment.
2. Only hashes that occur more than once matter, in several segments or at
   several places of one, and equal segments are counted instead of kept: a
   segment that occurs twice is repeated throughout.  One owner of each
   different segment goes on, if its hash has others or repeats inside it.
3. Segments are dealt by hash to tasks, which take them, in the order of their
   hashes, in shards of whole hashes and at most ``SHARD_BYTES`` positions; a
   shard's suffixes are sorted by induction (below), which leaves with each
   suffix the length of the prefix it shares with its neighbour.  Windows that
   share all ``length`` bytes with a neighbour are repeated.  A hash with more
   positions than a shard (a phrase in many contexts) is split: each of its
   windows is filed again under a 128-bit hash of the whole window and counted.
4. Windows found are joined back to the documents.

Induced sorting: suffixes are of type L (larger than their successor) or S;
the leftmost S suffixes (LMS) are sorted first; scanning upward induces all L
suffixes from them, scanning downward all S suffixes from those.  Scans take
from queues ordered by first symbol, which hold (position, common prefix)
tuples and move to files of the shared folder when they outgrow
``QUEUE_BYTES``; the common prefix of an induced suffix with the one queued
before it is one more than the least between their sources.  LMS suffixes are
sorted by the order that a first induction gives their substrings; the string
of those names is then sorted by doubling, as deep as ``length`` bytes need
(equal windows may stay in any order).  Tuples are in files; the text, types,
LMS order and names of a shard are in memory: 46 bytes per position at the peak,
measured on prose, so a shard of ``SHARD_BYTES`` takes about 400 MB.

Defined results: a null text is an empty one; texts shorter than ``length``
are kept whole, longer ones of any size are cut into segments; repeated rows
count as other places; an empty table gives no rows; only the key and the text
are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import filesystem, open_in, open_out, release, stored, work_dir

LENGTH = 200
SEED = 32                        # bytes; windows share the least hash of these
MOST_RUN = 1 << 14               # windows of one segment
SHARD_BYTES = 8 << 20            # positions sorted at once
QUEUE_BYTES = 64 << 20           # tuples that a sort holds in memory
BATCH = 1 << 16                  # suffixes scanned at once

_rng = np.random.default_rng(5)
_BYTE = _rng.integers(0, 1 << 63, 256, np.uint64) << np.uint64(1) | np.uint64(1)
_POWER = [np.uint64(int(x)) for x in _rng.integers(0, 1 << 63, 8, np.uint64) << np.uint64(1) | np.uint64(1)]


# --- step 1: segments -------------------------------------------------------

def window_hashes(data: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every seed, and for every window of ``length`` bytes the least inside it."""
    value, width = _BYTE[data], 1
    while width < seed:
        value = value[:-width] * _POWER[width.bit_length()] + value[width:]
        width *= 2
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    seeds = value = value ^ (value >> np.uint64(32))
    span, width = length - seed + 1, 1
    while 2 * width <= span:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    return seeds, np.minimum(value[:len(value) - (span - width)], value[span - width:])


def segments(data: bytes, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, hash, whether the hash has several places
    inside) of the segments of a text."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    seeds, least = window_hashes(np.frombuffer(data, np.uint8), length, seed)
    start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    run = np.diff(np.concatenate([start, [len(least)]]))
    if run.max() > MOST_RUN:
        pieces = -(-run // MOST_RUN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = np.repeat(start + run, pieces)
        start = np.repeat(start, pieces) + nth * MOST_RUN
        run = np.minimum(end - start, MOST_RUN)
    # a window can only repeat inside its own segment if the hash has two places
    # there that are least in the window starting or in the one ending with them
    span = length - seed + 1
    edge = np.zeros(len(seeds), bool)
    edge[:len(least)] = seeds[:len(least)] == least
    edge[span - 1:] |= seeds[span - 1:] == least
    edge = np.flatnonzero(edge)
    low, high = np.searchsorted(edge, start), np.searchsorted(edge, start + run + span - 1)
    near = high - low
    at = np.cumsum(near) - near
    same = seeds[edge[np.arange(near.sum()) - np.repeat(at - low, near)]] == np.repeat(least[start], near)
    hits = np.bincount(np.repeat(np.arange(len(start)), near), same, len(start))
    return start, run, least[start].view(np.int64), hits > 1


# --- step 3: induced sorting ------------------------------------------------

class Queues:
    """First-in first-out queues of (position, common prefix) by symbol, which
    move to files below ``folder`` when all of them together grow too long."""

    def __init__(self, folder: str, limit: int = QUEUE_BYTES):
        self.folder, self.limit = folder, limit
        self.parts: dict[int, list] = defaultdict(list)
        self.held, self.files = 0, []

    def put(self, symbol: int, position: np.ndarray, common: np.ndarray) -> None:
        self.parts[symbol].append((position, common))
        self.held += position.nbytes + common.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        path = f"{self.folder}/{len(self.files):05d}"
        at = 0
        with open_out(path) as out:
            for parts in self.parts.values():
                for k, part in enumerate(parts):
                    if isinstance(part[0], np.ndarray):
                        out.write(part[0].tobytes() + part[1].tobytes())
                        parts[k] = (path, at, len(part[0]))
                        at += len(part[0]) * 5
        self.files.append(path)
        self.held = 0

    def _load(self, part) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            self.held -= part[0].nbytes + part[1].nbytes
            return part
        path, at, count = part
        with open_in(path) as file:
            file.seek(at)
            raw = file.read(5 * count)
        return np.frombuffer(raw, np.uint32, count), np.frombuffer(raw, np.uint8, count, 4 * count)

    def take(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is queued, and what is put meanwhile, in batches."""
        while parts := self.parts.pop(symbol, None):
            held, size = [], 0
            for part in parts:
                held.append(self._load(part))
                size += len(held[-1][0])
                if size >= BATCH:
                    yield tuple(map(np.concatenate, zip(*held)))
                    held, size = [], 0
            if held:
                yield tuple(map(np.concatenate, zip(*held)))

    def take_back(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Batches from the last to the first, each in its own order."""
        for part in reversed(self.parts.pop(symbol, [])):
            yield self._load(part)

    def close(self) -> None:
        for path in self.files:
            fs, name = filesystem(path)
            fs.delete_file(name)


class InducedSort:
    """Sorts the suffixes of ``text``: symbols below 300, the last one 0 and unique."""

    def __init__(self, text: np.ndarray, folder: str, cap: int = LENGTH, limit: int = QUEUE_BYTES):
        self.text, self.cap, self.folder, self.limit = text, cap, folder, limit
        n = len(text)
        after = text[1:] > text[:-1]
        # a run of equal symbols has the type of its last one
        last = np.where(text[1:] != text[:-1], np.arange(n - 1), n)
        last = np.minimum.accumulate(last[::-1])[::-1]
        self.small = np.append(after[np.minimum(last, n - 2)] & (last < n), True)
        self.lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        self.padded = np.append(text, np.zeros(cap + 8, text.dtype))
        self.symbols = int(text.max()) + 1

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at a and b, up to ``cap``."""
        out, live = np.zeros(len(a), np.int64), np.arange(len(a))
        view = np.lib.stride_tricks.sliding_window_view(self.padded, 8)
        for k in range(0, self.cap, 8):
            same = view[a[live] + k] == view[b[live] + k]
            whole = same.all(axis=1)
            out[live] += np.where(whole, 8, np.argmin(same, axis=1))
            live = live[whole]
            if not len(live):
                break
        return np.minimum(out, self.cap).astype(np.uint8)

    def _induce(self, queues: Queues, state: tuple, position, common, small: bool) -> None:
        """Queue the predecessors of scanned suffixes that are of the wanted type,
        with common prefixes unless ``state`` is None."""
        if state is None:
            before = position.astype(np.int64) - 1
            before = before[(before >= 0) & (self.small[before] == small)]
            symbol = self.text[before]
            order = np.argsort(symbol, kind="stable")
            put, symbol = before[order].astype(np.uint32), symbol[order]
            start = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]])) if len(put) else ()
            for s, e in zip(start, np.append(start[1:], len(put))):
                queues.put(int(symbol[s]), put[s:e], np.zeros(e - s, np.uint8))
            return
        least, touched = state
        before = position.astype(np.int64) - 1
        at = np.flatnonzero((before >= 0) & (self.small[before] == small))
        falling = np.minimum.accumulate(common)
        if len(at):
            symbol = self.text[before[at]]
            order = np.argsort(symbol, kind="stable")
            at, symbol = at[order], symbol[order]
            first = np.concatenate([[True], symbol[1:] != symbol[:-1]])
            start = np.flatnonzero(first)
            # least common prefix since the suffix queued before for the symbol
            low = np.empty(len(at), np.int64)
            low[start] = np.minimum(least[symbol[start]], falling[at[start]])
            rest = np.flatnonzero(~first)
            low[rest] = self._range_least(common, at[rest - 1] + 1, at[rest])
            new = np.minimum(low + 1, self.cap).astype(np.uint8)
            new[start[~touched[symbol[start]]]] = 0
            rising = np.minimum.accumulate(common[::-1])[::-1]
            end = np.append(start[1:], len(at))
            least[:] = np.minimum(least, falling[-1])
            tail = at[end - 1] + 1
            least[symbol[start]] = np.where(tail < len(common), rising[np.minimum(tail, len(common) - 1)], self.cap)
            touched[symbol[start]] = True
            put = before[at].astype(np.uint32)
            for s, e in zip(start, end):
                queues.put(int(symbol[s]), put[s:e], new[s:e])
        else:
            least[:] = np.minimum(least, falling[-1])

    @staticmethod
    def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of values[low..high], both ends included, for many ranges."""
        out = np.empty(len(low), values.dtype)
        level = np.frexp(high - low + 1)[1] - 1
        table, width = values, 1
        for k in range(int(level.max(initial=0)) + 1):
            if k:
                table = np.minimum(table[:-width], table[width:])
                width *= 2
            here = level == k
            out[here] = np.minimum(table[low[here]], table[high[here] - width + 1])
        return out

    def scan(self, lms: np.ndarray, common: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes from the largest to the smallest, in batches, each with the
        common prefix with the suffix before it, from LMS suffixes in order.
        Without ``common`` no common prefixes are carried."""
        plain = common is None
        common = np.zeros(len(lms), np.uint8) if plain else common
        fresh = lambda: None if plain else (np.full(self.symbols, self.cap, np.int64), np.zeros(self.symbols, bool))
        queue, large = Queues(f"{self.folder}/l", self.limit), Queues(f"{self.folder}/o", self.limit)
        bounds = np.searchsorted(self.text[lms], np.arange(self.symbols + 1))
        state = fresh()
        for c in range(self.symbols):
            end = None
            for position, shared in queue.take(c):
                large.put(c, position, shared)
                self._induce(queue, state, position, shared, False)
                end = position[-1:]
            for at in range(bounds[c], bounds[c + 1], BATCH):
                part = slice(at, min(at + BATCH, bounds[c + 1]))
                shared = common[part].copy()
                if at == bounds[c] and not plain:
                    shared[0] = 0 if end is None else self.common(end.astype(np.int64), lms[at:at + 1])[0]
                self._induce(queue, state, lms[part].astype(np.uint32), shared, False)
        queue.close()
        queue, state = Queues(f"{self.folder}/s", self.limit), fresh()
        queue.put(0, np.array([len(self.text) - 1], np.uint32), np.zeros(1, np.uint8))
        if not plain:
            state[1][0] = True
        for c in range(self.symbols - 1, -1, -1):
            end = None
            for position, shared in queue.take(c):
                yield position, shared
                self._induce(queue, state, position, shared, True)
                end = position[-1:]
            follow = None                              # common prefix with the larger L suffix
            for position, shared in large.take_back(c):
                if follow is None:
                    follow = 0 if end is None or plain else self.common(end.astype(np.int64), position[-1:].astype(np.int64))[0]
                back = np.concatenate([[follow], shared[:0:-1]]).astype(np.uint8)
                follow = shared[0]
                position = position[::-1]
                yield position, back
                self._induce(queue, state, position, back, True)
        queue.close()
        large.close()

    def sorted_lms(self) -> np.ndarray:
        """LMS positions in the order of their suffixes, as deep as ``cap``."""
        lms = self.lms
        first = lms[np.argsort(self.text[lms], kind="stable")]
        is_lms = np.zeros(len(self.text), bool)
        is_lms[lms] = True
        found = [p[is_lms[p]] for p, _ in self.scan(first, None)]
        order = np.concatenate(found)[::-1].astype(np.int64)
        # substrings that are equal get one name
        index = (np.cumsum(is_lms, dtype=np.int32) - 1)[order]
        length = np.append(np.diff(lms), 0)[index] + 1
        same = length[1:] == length[:-1]
        live = np.flatnonzero(same)
        view = np.lib.stride_tricks.sliding_window_view(self.padded, 8)
        k = 0
        while len(live):
            rest = np.minimum(length[live] - k, 8)[:, None]
            a, b = (np.minimum(order[live + d] + k, len(view) - 1) for d in (0, 1))
            equal = ((view[a] == view[b]) | (np.arange(8) >= rest)).all(axis=1)
            same[live[~equal]] = False
            k += 8
            live = live[equal & (length[live] > k)]
        rank = np.empty(len(lms), np.int64)
        rank[index] = np.concatenate([[0], np.cumsum(~same)])
        step = 1
        # a name spans two bytes or more, so ``step`` names reach 2 * step bytes deep
        while 2 * step < self.cap + 2 and rank.max() + 1 < len(rank):
            key = rank * (len(rank) + 1) + np.append(rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64))
            order_now = np.argsort(key)              # equal keys may come in any order
            fresh = np.concatenate([[0], np.cumsum(key[order_now][1:] != key[order_now][:-1])])
            rank[order_now] = fresh
            step *= 2
        return lms[np.argsort(rank)]

    def repeated(self) -> np.ndarray:
        """Whether each suffix shares its first ``cap`` symbols with another."""
        lms = self.sorted_lms()
        common = np.zeros(len(lms), np.uint8)
        for at in range(1, len(lms), BATCH):
            part = lms[at - 1:at + BATCH]
            common[at:at + len(part) - 1] = self.common(part[:-1], part[1:])
        out = np.zeros(len(self.text), bool)
        last = None
        for position, shared in self.scan(lms, common):
            hit = shared >= self.cap
            out[position[hit]] = True
            out[position[:-1][hit[1:]]] = True
            if last is not None and hit[0]:
                out[last] = True
            last = position[-1]
        return out


def repeated_windows(parts: list[bytes], folder: str, length: int = LENGTH,
                     limit: int = QUEUE_BYTES) -> list[np.ndarray]:
    """For each part, whether its windows of ``length`` bytes occur again in any."""
    if not parts:
        return []
    sizes = np.array([len(p) + 1 for p in parts])
    text = np.empty(sizes.sum() + 1, np.uint16)
    ends = np.cumsum(sizes)
    for part, end in zip(parts, ends):
        text[end - 1 - len(part):end - 1] = np.frombuffer(part, np.uint8)
    text[:-1] += 2
    text[ends - 1], text[-1] = 1, 0                 # the end of a part; the end of the text
    found = InducedSort(text, folder, length, limit).repeated()
    return [found[e - s:e - 1 - (length - 1)] if s > length else np.zeros(0, bool) for s, e in zip(sizes, ends)]


# --- Spark ------------------------------------------------------------------

def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shards(parts: Iterator[pd.DataFrame], most: int = SHARD_BYTES) -> Iterator[pd.DataFrame]:
    """Rows (hash, data, ...) in the order of their hashes, cut into frames of whole
    hashes with up to ``most`` positions (more only for a single hash)."""
    rest = None
    for part in parts:
        rows = part if rest is None else pd.concat([rest, part], ignore_index=True)
        if not len(rows):
            continue
        hashes = rows["hash"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        sizes = np.add.reduceat(np.fromiter((len(d) + 1 for d in rows["data"]), np.int64, len(rows)), first)
        start = held = 0
        for at, size in zip(first.tolist(), sizes.tolist()):
            if held and held + size > most:
                yield rows.iloc[start:at]
                start, held = at, 0
            held += size
        rest = rows.iloc[start:]
    if rest is not None and len(rest):
        yield rest


def repeated_starts(docs: DataFrame, path: str, length: int = LENGTH, most: int = SHARD_BYTES) -> DataFrame:
    """(id, key, first, last): ranges of window starts (last excluded) in the
    documents (id, key, data) whose windows also start elsewhere."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            ids, keys, hashes, digests, starts, runs, own = [], [], [], [], [], [], []
            for i, key, data in zip(part["id"], part["key"], part["data"]):
                start, run, least, several = segments(data, length)
                view = memoryview(data)
                ids.append(np.full(len(start), i))
                keys.append(np.full(len(start), key))
                hashes.append(least)
                digests += [xxhash.xxh3_64_intdigest(view[s:s + r + length - 1])
                            for s, r in zip(start.tolist(), run.tolist())]
                starts.append(start)
                runs.append(run)
                own.append(several)
            if ids:
                yield pd.DataFrame({"id": np.concatenate(ids), "key": np.concatenate(keys),
                                    "hash": np.concatenate(hashes),
                                    "digest": np.array(digests, np.uint64).view(np.int64),
                                    "start": np.concatenate(starts), "run": np.concatenate(runs),
                                    "several": np.concatenate(own)})

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [segments(data, length)[2:] for data in part["data"]]
            if found:
                # counted per batch, so that a text's many copies cost few rows
                yield pd.DataFrame({"hash": np.concatenate([f[0] for f in found]), "several": np.concatenate(
                    [f[1] for f in found])}).groupby("hash", as_index=False).agg(
                    n=("several", "size"), several=("several", "max"))

    schema = "id long, key long, hash long, digest long, start int, run int, several boolean"
    cuts = docs.mapInPandas(cut, schema)
    again = stored(docs.select("data").mapInPandas(hashed, "hash long, n long, several boolean").groupBy("hash").agg(
        F.sum("n").alias("n"), F.max("several").alias("several")).where("n > 1 or several").select("hash"),
        f"{path}/again")
    met = stored(cuts.join(again, "hash", "left_semi"), f"{path}/met")
    one = met.groupBy("hash", "digest", "run").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "key", "start")).alias("owner"),
        F.max("several").alias("several"))
    one = stored(one.select("hash", "digest", "run", "copies", "several", "owner.*"), f"{path}/segments")
    contested = one.groupBy("hash").agg(F.count("*").alias("kinds"), F.max(
        F.col("several") & (F.col("copies") == 1)).alias("several"), F.sum(F.col("run") + length).alias("positions"))
    contested = stored(contested.where("kinds > 1 or several").select(
        "hash", (F.col("positions") > most).alias("hot")), f"{path}/contested")
    owner = one.join(contested, "hash").groupBy("id", "key").agg(
        F.collect_list(F.struct("hash", "start", "run", "copies", "hot")).alias("segments"))

    def slices(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(
                [(i, key, s["hash"], s["start"], s["copies"], s["hot"], data[s["start"]:s["start"] + s["run"] + length - 1])
                 for i, key, data, found in zip(part["id"], part["key"], part["data"], part["segments"]) for s in found],
                columns=["id", "key", "hash", "start", "copies", "hot", "data"])

    texts = docs.join(owner, ["id", "key"]).dropDuplicates(["id", "key"])
    sliced = texts.mapInPandas(slices, "id long, key long, hash long, start int, copies long, hot boolean, data binary")

    def sort(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        for n, rows in enumerate(shards(parts, most)):
            found = repeated_windows(list(rows["data"]),
                                     f"{path}/spill/{task.stageId()}-{task.taskAttemptId()}-{n}", length)
            out = []
            for i, key, start, copies, flags in zip(rows["id"], rows["key"], rows["start"], rows["copies"], found):
                if copies == 1:
                    out += [(i, key, start + a, start + b) for a, b in zip(*_spans(flags))]
            yield pd.DataFrame(out, columns=["id", "key", "first", "last"])
            release()

    def windows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", "key", "hash", "copies", "at", "window"]
        out = []
        for part in parts:
            for i, key, least, copies, start, data in zip(
                    part["id"], part["key"], part["hash"], part["copies"], part["start"], part["data"]):
                view = memoryview(data)
                out += [(i, key, least, copies, start + k, xxhash.xxh3_128_digest(view[k:k + length]))
                        for k in range(len(data) - length + 1)]
                if len(out) >= BATCH:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        yield pd.DataFrame(out, columns=names)

    inside = sliced.where("not hot").repartition("hash").sortWithinPartitions("hash").mapInPandas(
        sort, "id long, key long, first int, last int")
    if not contested.where("hot").isEmpty():
        wide = stored(sliced.where("hot").mapInPandas(
            windows, "id long, key long, hash long, copies long, at int, window binary"), f"{path}/windows")
        twice = wide.groupBy("hash", "window").agg(F.sum("copies").alias("n")).where("n > 1")
        hit = wide.where("copies = 1").join(twice, ["hash", "window"], "left_semi")
        # neighbouring places become one range
        hit = hit.withColumn("island", F.col("at") - F.row_number().over(Window.partitionBy("id", "key").orderBy("at")))
        inside = inside.unionByName(hit.groupBy("id", "key", "island").agg(
            F.min("at").alias("first"), (F.max("at") + 1).alias("last")).drop("island"))
    copied = met.join(one.where("copies > 1").select("hash", "digest", "run"), ["hash", "digest", "run"]).select(
        "id", "key", F.col("start").alias("first"), (F.col("start") + F.col("run")).alias("last"))
    return inside.unionByName(copied)


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                    path: str | None = None, most: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256: one row per document."""
    path = path or work_dir(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(text, "UTF-8").alias("data"))
    given = given.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id"),
                         F.xxhash64(F.col("doc_id").isNull(), "data").alias("key"), "data")
    ranges = repeated_starts(given.select("id", "key", "data"), path, length, most)
    marks = stored(ranges.groupBy("id", "key").agg(F.collect_set(F.struct("first", "last")).alias("ranges")),
                   f"{path}/ranges")

    def remove(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for doc_id, data, ranges in zip(part["doc_id"], part["data"], part["ranges"]):
                gone = np.zeros(len(data) + 1, np.int32)
                for r in (ranges if ranges is not None else ()):
                    gone[r["first"]] += 1
                    gone[r["last"] + length - 1] -= 1
                removed = np.cumsum(gone[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~removed].tobytes()
                out.append((None if pd.isna(doc_id) else int(doc_id), len(data), int(removed.sum()),
                            len(_spans(removed)[0]), kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
                               ).astype({"doc_id": "Int64"})

    return given.join(marks, ["id", "key"], "left").select("doc_id", "data", "ranges").mapInPandas(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
