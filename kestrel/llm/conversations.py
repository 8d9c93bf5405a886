"""Repair of damaged conversations: the cheapest edits that leave turns in order.

A conversation is its rows by turn (nulls first; rows of one turn by role, then by
the first ``TIE`` characters and the SHA-256 of their text).  A null role or text is one
space.  Each row's first fault counts: ``blank`` (no character but white space),
``duplicate`` (role and text stood earlier in the conversation), ``truncated`` (the last
character that is not white space is none of ``. ! ?``).  The edits are those of
:mod:`kestrel.llm.auction`: they give roles whose initials read ``(s?(ua)+)?``, and of
the cheapest ones the least in the order of their letters is taken.

How it scales: equal rows of one turn become one row with a count before any
shuffle of theirs, and the text stays behind as a digest.  Rows are dealt by range of
their order, so a conversation of any length spreads over tasks; a task cuts its rows into
chunks of ``CHUNK`` rows, each a word of one letter a row.  Conversations that lie in one chunk
are solved at once.  Of the others each chunk becomes a table of 16 costs; the tables are
joined per task and conversation, then per conversation (a row for each task
that holds some of it), and the states found on the way down fix every chunk.  The
edits then meet their texts again by the rows' digest.

What must be one value of one conversation, its list of edits and the hash of its whole
text, is put together by one task per conversation, which streams the rows and holds one
batch of them; the operator's own output, :func:`repaired`, does not need this.

Defined results: a null key is a conversation of its own; an empty role has no initial and
is never kept; roles are told by their initial only and kept whole; texts of any length
are read whole; repeated rows are duplicates; an empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import auction
from kestrel.llm.common import release, stored, work_dir

CHUNK = 4096                       # rows of one task and conversation that are one word
TIE = 64                           # characters that order the texts of a turn
_WHITE = "\x20\x09\x0A\x0B\x0C\x0D"
_LEGAL = ("su", "ua", "au")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) with faults that the crc32 of
    ``conv_id:turn`` modulo 20 chooses: 0 drops the row, 1 empties its text, 2 takes its full
    stops, exclamation and question marks out, 3 repeats it, 4 makes it the user's."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(name("conv_id"), F.lit(":"), name("turn")), "UTF-8")) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(name("text"), "[.!?]", ""))
            .otherwise(name("text")))
    again = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(name("role")).alias("role"),
        text.alias("text"), F.explode(again).alias("__copy")).drop("__copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """The rows with a digest of all that tells a row from another."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    whole = F.concat_ws(":", name("conv_id"), name("turn"), F.length(name("role")), name("role"), name("text"))
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), name("role").alias("role"),
        name("text").alias("text"), F.unhex(F.sha2(whole, 256)).alias("row"))


def _marked(keyed: DataFrame) -> DataFrame:
    """A row for each different row: its number of copies and its faults."""
    end = F.rtrim(F.col("text"), F.lit(_WHITE))
    slim = keyed.select(
        "conv_id", "turn", "role", "row", F.unhex(F.sha2("text", 256)).alias("said"),
        F.substring("text", 1, TIE).alias("head"), (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"))
    slim = slim.groupBy("conv_id", "turn", "role", "row", "said", "head", "blank", "cut").agg(
        F.count(F.lit(1)).alias("copies"))
    # what stands in several turns, and the first of them (nulls first)
    order = F.struct(F.col("turn").isNotNull().alias("there"), F.col("turn"))
    again = slim.where(~F.col("blank")).groupBy("conv_id", "role", "said").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    again = again.select(F.col("conv_id").alias("__conv"), F.col("role").alias("__role"),
                         F.col("said").alias("__said"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (
        F.col("said") == F.col("__said"))
    later = F.col("first").isNotNull() & ~F.col("blank") & (F.col("first") != order)
    return slim.join(again, same, "left").select(
        "conv_id", "turn", "role", "head", "said", "row", "copies", "blank", "cut",
        F.coalesce(later, F.lit(False)).alias("again"))


_CHUNKS = """conv_id long, part int, run int, chunk int, alone boolean, letters string, turns array<long>,
    roles array<string>, row array<binary>, copies array<long>, blank long, duplicate long, truncated long,
    illegal long, first_role string, last_role string, least long, most long, different long,
    first_turn long, last_turn long"""


class _Chunk:
    """The rows of one conversation that a task has read since the last cut."""

    def __init__(self) -> None:
        self.turns, self.roles, self.row, self.copies, self.letters = [], [], [], [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role, row, copies, blank, cut, again) -> None:
        initial = role[:1]
        if self.roles:
            self.illegal += self.roles[-1][:1] + initial not in _LEGAL
        self.illegal += copies - 1                       # no role may follow itself
        gone = blank or again
        letter = "x" if gone else initial if initial in ("s", "u", "a") else "o"
        self.letters.append((letter.upper() if cut and not gone else letter) + "x" * (copies - 1))
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - 1 + again
        self.truncated += cut and not gone
        self.turns.append(turn)
        self.roles.append(role)
        self.row.append(row)
        self.copies.append(copies)

    def record(self, conv, part, run, chunk, alone) -> tuple:
        known = [t for t in self.turns if t is not None]
        return (conv, part, run, chunk, alone, "".join(self.letters), self.turns, self.roles, self.row, self.copies,
                self.blank, self.duplicate, self.truncated, self.illegal, self.roles[0][:1], self.roles[-1][:1],
                min(known, default=None), max(known, default=None), len(set(known)),
                self.turns[0], self.turns[-1])


def chunks(rows: DataFrame) -> DataFrame:
    """The rows of :func:`_marked` in order, cut into words of at most ``CHUNK`` rows.

    ``part`` and ``run`` number the task and the conversation inside it; ``alone``: the chunk
    is the whole conversation (which a task's first and last ones may not be)."""
    names = ["conv_id", "part", "run", "chunk", "alone", "letters", "turns", "roles", "row", "copies", "blank",
             "duplicate", "truncated", "illegal", "first_role", "last_role", "least", "most", "different",
             "first_turn", "last_turn"]

    def frame(records: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(records, columns=names)
        whole = ("conv_id", "least", "most", "first_turn", "last_turn")
        return out.assign(**{c: pd.array(out[c].tolist(), "Int64") for c in whole})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, run, chunk, held, conv, out = TaskContext.get().partitionId(), 0, 0, _Chunk(), None, []
        for rows in parts:
            convs, turns = (rows[c].astype("Int64").astype(object).where(rows[c].notna(), None).tolist()
                            for c in ("conv_id", "turn"))
            columns = [rows[c].tolist() for c in ("role", "row", "copies", "blank", "cut", "again")]
            for key, turn, role, row, copies, blank, cut, again in zip(convs, turns, *columns):
                if held.roles and (key != conv or len(held.roles) >= CHUNK):
                    over = key != conv
                    out.append(held.record(conv, part, run, chunk, over and not chunk and run > 0))
                    held = _Chunk()
                    run, chunk = (run + 1, 0) if over else (run, chunk + 1)
                    if len(out) >= 1024:
                        yield frame(out)
                        out = []
                conv = key
                held.add(turn, role, row, copies, blank, cut, again)
        if held.roles:
            out.append(held.record(conv, part, run, chunk, False))
        if out:
            yield frame(out)
        release()

    order = ["conv_id", "turn", "role", "head", "said"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "row", "copies", "blank", "cut", "again")
            .mapInPandas(run, _CHUNKS))


# --- conversations of several chunks ------------------------------------------

_ELEMENT = "cost array<long>, place array<int>"


def _packed(e: auction.Element) -> tuple[list[int], list[int]]:
    return [x for r in e[0] for x in r], [x for r in e[1] for x in r]


def _unpacked(rows: pd.DataFrame) -> list[auction.Element]:
    four = lambda x: [[int(v) for v in x[i:i + 4]] for i in range(0, 16, 4)]
    return [(four(c), four(p)) for c, p in zip(rows["cost"], rows["place"])]


def _ends_of_chunks(linked: DataFrame) -> DataFrame:
    """part, run, chunk, entry, last, ends: the states before and after each chunk, and
    whether its conversation ends with it."""

    def elements(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            packed = [_packed(auction.element(x)) for x in part["letters"]]
            yield part.drop(columns="letters").assign(
                conv_id=part["conv_id"].astype("Int64"), cost=[p[0] for p in packed], place=[p[1] for p in packed])

    def of_run(rows: pd.DataFrame) -> pd.DataFrame:
        cost, place = _packed(auction.joined(_unpacked(rows.sort_values("chunk"))))
        return rows.iloc[:1].assign(conv_id=rows["conv_id"].iloc[:1].astype("Int64"), cost=[cost], place=[place])[
            ["conv_id", "part", "run", "cost", "place"]]

    def of_conversation(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "run"])
        way = auction.states(_unpacked(rows), 0)
        return pd.DataFrame({"part": rows["part"].array, "run": rows["run"].array, "entry": way[:-1],
                             "last": way[1:], "ends": np.arange(len(rows)) == len(rows) - 1})

    def of_chunks(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        way = auction.states(_unpacked(rows), int(rows["entry"].iloc[0]), int(rows["last"].iloc[0]))
        ends = np.zeros(len(rows), bool)
        ends[-1] = rows["ends"].iloc[0]
        return pd.DataFrame({"part": rows["part"].array, "run": rows["run"].array, "chunk": rows["chunk"].array,
                             "entry": way[:-1], "last": way[1:], "ends": ends})

    tables = linked.select("conv_id", "part", "run", "chunk", "letters").mapInPandas(
        elements, f"conv_id long, part int, run int, chunk int, {_ELEMENT}")
    runs = tables.groupBy("part", "run").applyInPandas(of_run, f"conv_id long, part int, run int, {_ELEMENT}")
    found = runs.groupBy("conv_id").applyInPandas(
        of_conversation, "part int, run int, entry int, last int, ends boolean")
    return tables.drop("conv_id").join(found, ["part", "run"]).groupBy("part", "run").applyInPandas(
        of_chunks, "part int, run int, chunk int, entry int, last int, ends boolean")


def solved(parts: DataFrame) -> DataFrame:
    """The chunks with ``entry`` (the state before them), ``audit`` and ``cost``."""
    alone = parts.where("alone").select("*", F.lit(0).alias("entry"), F.lit(None).cast("int").alias("last"),
                                        F.lit(True).alias("ends"))
    linked = parts.where("not alone")
    linked = linked.join(_ends_of_chunks(linked), ["part", "run", "chunk"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            audit = [auction.edits(x, int(q), None if pd.isna(e) else int(e), bool(z)) for x, q, e, z in zip(
                rows["letters"], rows["entry"], rows["last"], rows["ends"])]
            whole = ("conv_id", "least", "most", "first_turn", "last_turn")
            yield rows.drop(columns=["last", "ends"]).assign(
                **{c: rows[c].astype("Int64") for c in whole},
                turns=[[None if pd.isna(t) else int(t) for t in x] for x in rows["turns"]],
                audit=audit, cost=[auction.cost_of(x, a) for x, a in zip(rows["letters"], audit)])
        release()

    names = [n for n in parts.columns]
    both = alone.unionByName(linked).select(*names, "entry", "last", "ends")
    return both.mapInPandas(run, f"{_CHUNKS}, entry int, audit string, cost long")


# --- rows and digests ---------------------------------------------------------

def _edit_rows(chunked: DataFrame) -> DataFrame:
    """A row for each edit: conv_id, part, run, chunk, place, edit, turn, role, row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "part", "run", "chunk", "place", "edit", "turn", "role", "row"]
        for rows in frames:
            out = []
            for conv, part, run, chunk, letters, audit, entry, turns, roles, row, copies in zip(*(
                    rows[c] for c in ("conv_id", "part", "run", "chunk", "letters", "audit", "entry", "turns",
                                      "roles", "row", "copies"))):
                of = np.repeat(np.arange(len(copies)), np.asarray(copies, np.int64)).tolist()
                for place, (edit, k, role) in enumerate(auction.walk(letters, audit, int(entry))):
                    k = None if k is None else of[k]
                    out.append((conv, part, run, chunk, place, edit, None if k is None else turns[k],
                                role or roles[k], None if k is None else row[k]))
                    if len(out) >= 1 << 15:
                        yield frame(out, names)
                        out = []
            yield frame(out, names)
        release()

    def frame(out: list[tuple], names: list[str]) -> pd.DataFrame:
        made = pd.DataFrame(out, columns=names)
        return made.assign(**{c: pd.array([None if pd.isna(v) else int(v) for v in made[c]], "Int64")
                              for c in ("conv_id", "turn")})

    return chunked.select(
        "conv_id", "part", "run", "chunk", "letters", "audit", "entry", "turns", "roles", "row", "copies",
    ).mapInPandas(run, "conv_id long, part int, run int, chunk int, place int, edit string, turn long, "
                       "role string, row binary")


def repaired(rows: DataFrame, chunked: DataFrame) -> DataFrame:
    """A row for each edit of each conversation, in the order of (part, run, chunk, place):
    its letter, and the turn, role and text of the row that stays (K, R), goes (D) or is
    inserted (I: no turn, empty text)."""
    edit = _edit_rows(chunked)
    texts = _keyed(rows).select("row", "text").dropDuplicates(["row"])
    mine = edit.where(F.col("row").isNotNull()).join(texts, "row").drop("row")
    new = edit.where(F.col("row").isNull()).drop("row").withColumn("text", F.lit(""))
    return mine.unionByName(new)


def _hashes(lines: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines, streamed in order."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, conv, out = None, None, []
        for rows in parts:
            for key, line in zip(rows["conv_id"].astype("Int64"), rows["line"]):
                key = None if pd.isna(key) else int(key)
                if digest is None or key != conv:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    digest, conv = hashlib.sha256(line.encode()), key
                else:
                    digest.update(b"\n" + line.encode())
        if digest is not None:
            out.append((conv, digest.hexdigest()))
        yield pd.DataFrame({"conv_id": pd.array([o[0] for o in out], "Int64"), "sha": [o[1] for o in out]})
        release()

    order = ["conv_id", "part", "run", "chunk", "place"]
    return (lines.repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "line").mapInPandas(run, "conv_id long, sha string"))


def _pairs(items: Column, test) -> Column:
    """How many neighbours of a list meet the test."""
    n = F.size(items)
    return F.aggregate(
        F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(F.array().cast("array<int>")), F.lit(0).cast("long"),
        lambda sum, i: sum + F.when(test(F.element_at(items, i - 1), F.element_at(items, i)), 1).otherwise(0))


def repair_report(rows: DataFrame, originals: DataFrame | None = None, out_dir: str | None = None) -> DataFrame:
    """One row per conversation of ``originals`` (or of ``rows``): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.  One without rows
    has zeros, no edits and the hash of the empty text."""
    out_dir = out_dir or work_dir(rows.sparkSession, "conversations")
    parts = stored(chunks(_marked(_keyed(rows))), f"{out_dir}/chunks")
    done = stored(solved(parts), f"{out_dir}/solved")
    lines = repaired(rows, done).where("edit != 'D'").select(
        "conv_id", "part", "run", "chunk", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    sums = ["blank", "duplicate", "truncated", "illegal", "cost", "different"]
    piece = F.struct("part", "run", "chunk", "audit", "first_role", "last_role", "first_turn", "last_turn")
    no = lambda *names: [F.lit(None).alias(c) for c in names]
    all_of = (originals if originals is not None else rows).select(
        F.col("conv_id").cast("long"), *no(*sums, "least", "most", "piece", "sha"))
    all_of = all_of.unionByName(done.select(
        "conv_id", *sums, "least", "most", piece.alias("piece"), *no("sha")))
    all_of = all_of.unionByName(_hashes(lines).select("conv_id", *no(*sums, "least", "most", "piece"), "sha"))
    by = all_of.groupBy("conv_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in sums], F.min("least").alias("least"),
        F.max("most").alias("most"), F.sort_array(F.collect_list("piece")).alias("pieces"), F.max("sha").alias("sha"))
    pieces = F.col("pieces")
    # a turn that two neighbouring chunks share was counted in both
    turns = F.col("different") - _pairs(pieces, lambda a, b: a.last_turn == b.first_turn)
    joins = _pairs(pieces, lambda a, b: ~F.concat(a.last_role, b.first_role).isin(*_LEGAL))
    return by.select(
        "conv_id", F.coalesce(F.col("most") - F.col("least") + 1 - turns, F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("illegal") + joins).alias("illegal"), "cost",
        F.array_join(F.transform(pieces, lambda p: p.audit), "").alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
