"""Mixing sources to target weights by Sainte-Lague apportionment. DataFrame
operations only.

* ``targets``: sources in code-point order (null last) weigh 1, 2, 3,
  repeating, and share all words by weight; a target stops at ``MAX_REPEATS``
  times its source's words and the excess is shared again by weight.  The
  share per unit of weight is raised, an aggregate a step, until the sources
  that are full no longer change.
* ``apportioned``: seats by highest quotient target / (2 i - 1).  The seats of a divisor
  d are target / d, rounded; one aggregate tries ``TRIES`` divisors at a time until
  the two that enclose the number of seats differ by few seats, and only those are ranked.
* ``seats``: the mix is cut into blocks of equal word counts; the blocks that each
  source gets are ranked by quotient, in ranges, and ``blocks_per_shard`` of them in turn
  are a shard.  ``quotas`` counts them: each shard's integer quota per source.
* ``selected``: documents of a source in seeded order form one stream, repeated as
  often as needed, and its blocks come in that order; a quota's blocks are met with the
  documents that lie in them.
* What a source lacks after the blocks within its target, mostly less than
  a block, is apportioned in the same way in single words, which its stream
  gives next.  So sources smaller than a block are in the mix, and every source
  is within a few words of its target at every corpus size.

No task holds all sources, blocks or documents: sources and blocks are ranked in
ranges whose offsets are one number a task, and the stream's offsets come from sums
per (source, slice of the hash range) and running sums inside a slice, so a source
with a third of all documents is spread over ``2 ** SLICE_BITS`` groups.

Defined results: a null or empty text has size 0, is never taken and has its
source's target; texts of any length are counted whole; a null doc_id is a
document like any other; repeated rows are separate documents; without any
words every target is 0; an empty table gives no rows; columns that are not named
are not read (``drawn`` returns them as they are, whatever their names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import WORD, stored, unused, work_dir

MAX_REPEATS = 3
SEED = 20240101
BLOCK_WORDS = 1024               # of a block, for corpora of ten million words and more
LEAST_BLOCKS = 10_000            # smaller corpora get smaller blocks, so this many
BLOCKS_PER_SHARD = 1 << 14
TRIES = 31                       # divisors that one aggregate tries
RANKED = 4096                    # seats between two divisors that are few enough to rank
PIECE = 4096                     # blocks of a source that one row is expanded to
SLICE_BITS = 12                  # 2 ** bits hash slices of each source's documents


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """doc_id, text_hash, source, size: words of the text."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def ranked(df: DataFrame, path: str, *order) -> DataFrame:
    """``df``, stored, with ``rank`` (from 0) in an order that no two rows share; ranges are
    numbered inside, and offset by the numbers of rows of the tasks before."""
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__at", F.monotonically_increasing_id()), path)
    ranged = ranged.withColumn("__part", F.shiftright("__at", 33))
    tasks = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(tasks, "__part").withColumn("rank", F.col("__before") + inside).drop("__at", "__part", "__before")


_BY_NAME = "source IS NULL", "source"        # code-point order, null last


def targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS, path: str | None = None) -> DataFrame:
    """source, source_size, weight, total, target: one row per source."""
    path = path or work_dir(sizes.sparkSession, "targets")
    src = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), f"{path}/sources",
                 *map(F.expr, _BY_NAME))
    src = src.select("source", "source_size", (1 + F.col("rank") % 3).alias("weight"),
                     (max_repeats * F.col("source_size")).alias("limit"))
    total, weights = src.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (total or 0) / (weights or 1), -1
    while total:
        # the sources that this level fills leave more for the others
        held = src.where(F.col("limit") <= F.col("weight") * F.lit(level)).agg(
            F.count(F.lit(1)), F.sum("limit"), F.sum("weight")).first()
        if held[0] == full:
            break
        full, level = held[0], (total - (held[1] or 0)) / (weights - (held[2] or 0))
    goal = F.col("weight") * F.lit(level)
    return src.select("source", "source_size", "weight", F.lit(total or 0).cast("long").alias("total"),
                      F.when(F.col("limit") <= goal, F.col("limit").cast("double")).otherwise(goal).alias("target"))


def block_words(total: int) -> int:
    """Words of a block for a corpus of ``total`` words."""
    return max(1, min(BLOCK_WORDS, total // LEAST_BLOCKS))


def apportioned(goals: DataFrame, count: int, path: str) -> DataFrame:
    """``goals`` (source, target, cap: most seats) with ``seats``: ``count`` seats in all, or as
    many as the caps allow, each to the highest quotient; ties to the first source."""
    def at(divisor: float) -> Column:
        return F.least("cap", F.floor(F.col("target") / F.lit(divisor) + 0.5)).cast("long")

    able = goals.where("target > 0 and cap > 0")
    most, least, top = able.agg(F.sum("cap"), F.min(F.col("target") / F.col("cap")), F.max("target")).first()
    none = F.when((F.col("target") > 0) & (F.col("cap") > 0), F.col("cap")).otherwise(0)
    if not most or count <= 0:
        return goals.withColumn("seats", F.lit(0).cast("long"))
    if most <= count:
        return goals.withColumn("seats", none.cast("long"))
    low, high = (least, most), (3.0 * top, 0)             # (divisor, its seats): too many, too few
    while low[1] - high[1] > RANKED and high[0] > low[0] * (1 + 1e-15):
        grid = [low[0] * (high[0] / low[0]) ** (k / (TRIES + 1)) for k in range(1, TRIES + 1)]
        sums = able.agg(*[F.sum(at(d)).alias(f"s{k}") for k, d in enumerate(grid)]).first()
        found = [low, *zip(grid, sums), high]
        now = max((f for f in found if f[1] >= count), key=lambda f: f[0]), min(
            (f for f in found if f[1] <= count), key=lambda f: f[0])
        if now == (low, high):
            break
        low, high = now
        if low[0] >= high[0]:                              # a divisor gives just as many
            high = low
    have, upto = at(high[0]), at(low[0])
    near = able.select("source", "target", have.alias("have"), upto.alias("upto")).where("upto > have").select(
        "source", "target", F.explode(F.expr("sequence(have + 1, upto)")).alias("seat"))
    near = near.withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1))
    won = ranked(near, f"{path}/near", F.desc("quotient"), *map(F.expr, _BY_NAME), "seat").where(
        F.col("rank") < count - high[1]).groupBy(F.col("source").alias("__source")).agg(F.count(F.lit(1)).alias("__won"))
    granted = F.when(none > 0, have).otherwise(0)
    return goals.join(won, F.col("source").eqNullSafe(F.col("__source")), "left").select(
        *goals.columns, (granted + F.coalesce("__won", F.lit(0))).cast("long").alias("seats"))


def seats(goals: DataFrame, path: str, max_repeats: int = MAX_REPEATS,
          blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """shard, source, block, block_words: the blocks that each source gives, from its first
    one on, and the shard that each falls to by its quotient."""
    total = (goals.select("total").first() or [0])[0]
    words = block_words(total)
    goal = goals.withColumn("cap", F.expr(f"({max_repeats} * source_size) div {words}"))
    won = apportioned(goal, total // words, f"{path}/seats").where("seats > 0")
    piece = F.explode(F.expr(f"sequence(0, (seats - 1) div {PIECE})")).alias("piece")
    rows = won.select("source", "target", "seats", piece).repartition("source", "piece")
    rows = rows.select("source", "target", F.explode(F.expr(
        f"sequence(piece * {PIECE}, least(seats, (piece + 1) * {PIECE}) - 1)")).alias("block"))
    rows = rows.select("source", "block", (F.col("target") / (2 * F.col("block") + 1)).alias("quotient"))
    placed = ranked(rows, f"{path}/blocks", F.desc("quotient"), *map(F.expr, _BY_NAME), "block")
    return placed.select(F.expr(f"rank div {blocks_per_shard}").alias("shard"), "source", "block",
                         F.lit(words).cast("long").alias("block_words"))


def quotas(goals: DataFrame, max_repeats: int = MAX_REPEATS, blocks_per_shard: int = BLOCKS_PER_SHARD,
           path: str | None = None) -> DataFrame:
    """shard, source, first, blocks, block_words: each shard's quota of each source that has
    one, and the source's first block in it."""
    path = path or work_dir(goals.sparkSession, "quotas")
    return seats(goals, path, max_repeats, blocks_per_shard).groupBy("shard", "source").agg(
        F.min("block").alias("first"), F.count(F.lit(1)).alias("blocks"), F.max("block_words").alias("block_words"))


def source_words(goals: DataFrame, blocks: DataFrame, path: str, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``goals`` with ``whole``, the words of its ``blocks`` (rows of :func:`seats`) that lie within
    its target, and ``words``, those and its part of the other words."""
    words = block_words((goals.select("total").first() or [0])[0])
    held = blocks.groupBy(F.col("source").alias("__source")).agg(F.count(F.lit(1)).alias("__blocks"))
    goal = goals.join(held, F.col("source").eqNullSafe(F.col("__source")), "left").select(
        *goals.columns, (F.least(F.coalesce("__blocks", F.lit(0)), F.floor(F.col("target") / words)) * words)
        .cast("long").alias("whole"))
    goal = stored(goal, f"{path}/whole")
    total, whole = goal.agg(F.max("total"), F.sum("whole")).first()
    lacking = goal.select("source", (F.col("target") - F.col("whole")).alias("target"),
                          (max_repeats * F.col("source_size") - F.col("whole")).alias("cap"))
    last = apportioned(lacking, (total or 0) - (whole or 0), f"{path}/rest").select(
        F.col("source").alias("__source"), "seats")
    return goal.join(last, F.col("source").eqNullSafe(F.col("__source"))).select(
        *goal.columns, (F.col("whole") + F.col("seats")).alias("words"))


def selected(stream: DataFrame, goals: DataFrame, blocks: DataFrame) -> DataFrame:
    """shard, source, start, round, size, words: what each shard takes of each copy of a document of
    :func:`streamed` (``start`` and source name it).  ``goals`` is :func:`source_words`; the last
    words of a source, in no block, have a null shard."""
    words = block_words((goals.select("total").first() or [0])[0])
    held = goals.select(F.col("source").alias("__source"), "source_size", "whole", F.col("words").alias("all"))
    copies = stream.where("size > 0").join(held, F.col("source").eqNullSafe(F.col("__source"))).select(
        "source", "start", "size", "source_size", "whole", "all",
        F.explode(F.expr("sequence(0, all div source_size)")).alias("round"))
    copies = copies.withColumn("begin", F.col("round") * F.col("source_size") + F.col("start")).where("begin < all")
    inside = copies.where("begin < whole").withColumn("block", F.explode(F.expr(
        f"sequence(begin div {words}, (least(begin + size, whole) - 1) div {words})")))
    taken = blocks.select(F.col("source").alias("__from"), F.col("block").alias("__block"), "shard")
    inside = inside.join(taken, F.col("source").eqNullSafe(F.col("__from")) & (F.col("block") == F.col("__block"))).select(
        "shard", "source", "start", "round", "size",
        (F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * words)
         - F.greatest("begin", F.col("block") * words)).alias("words"))
    last = copies.where("begin + size > whole").select(
        F.lit(None).cast("long").alias("shard"), "source", "start", "round", "size",
        (F.least(F.col("begin") + F.col("size"), F.col("all")) - F.greatest("begin", "whole")).alias("words"))
    return inside.unionByName(last.where("words > 0"))


def streamed(docs: DataFrame, seed: int = SEED, slice_bits: int = SLICE_BITS) -> DataFrame:
    """``docs`` (doc_id, text_hash, source, size) with ``start``: the words of the
    source's documents before it, in seeded order."""
    docs = docs.withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
    docs = docs.withColumn("slice", F.shiftright("place", 64 - slice_bits))
    slices = docs.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    inside = (Window.partitionBy("source", "slice").orderBy("place", "doc_id", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = docs.alias("d").join(slices.alias("s"), F.expr("d.source <=> s.source and d.slice = s.slice"))
    return joined.select("d.*", (F.col("before") + F.col("inside")).alias("start")).drop(
        "place", "slice", "inside")


def mixed(docs: DataFrame, path: str | None = None, seed: int = SEED, id_col="doc_id",
          text_col="text", source_col="source") -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, rounds (whole copies),
    rest (words of one more) and taken (words in all): one row per document."""
    path = path or work_dir(docs.sparkSession, "mixing")
    sizes = stored(sized(docs, id_col, text_col, source_col), f"{path}/sizes")           # texts are read once
    goals = stored(targets(sizes, path=path), f"{path}/targets")      # a row per source
    blocks = stored(seats(goals, path), f"{path}/shards")
    goals = stored(source_words(goals, blocks, path), f"{path}/words")
    stream = stored(streamed(sizes, seed), f"{path}/stream")
    copies = selected(stream, goals, blocks).groupBy("source", "start", "round").agg(
        F.sum("words").alias("words"), F.max("size").alias("size"))
    # the last words of a document that the mix takes whole are a copy like the others
    of = copies.groupBy(F.col("source").alias("__source"), F.col("start").alias("__start")).agg(
        F.sum((F.col("words") == F.col("size")).cast("long")).alias("rounds"),
        F.sum(F.when(F.col("words") < F.col("size"), F.col("words"))).alias("rest"))
    goals = goals.select(F.col("source").alias("__name"), "source_size", "target")
    out = stream.join(goals, F.col("source").eqNullSafe(F.col("__name"))).join(
        of, F.col("source").eqNullSafe(F.col("__source")) & (F.col("start") == F.col("__start")) & (F.col("size") > 0), "left")
    rounds, rest = (F.coalesce(c, F.lit(0)) for c in ("rounds", "rest"))
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", rounds.alias("rounds"),
                      rest.alias("rest"), (rounds * F.col("size") + rest).alias("taken"))


def first_words(text, count):
    """The text up to the end of its ``count``-th word."""
    sizes = lambda parts: F.aggregate(F.transform(F.slice(parts, 1, count), F.length), F.lit(0), lambda a, x: a + x)
    return F.substring(text, F.lit(1), sizes(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
                       + sizes(F.split(text, WORD, -1)))


def drawn(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
          length_col: str | None = "n_chars") -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a row for each whole copy
    that the mix takes of a document, and one, its text cut, for a last part.
    Repeated rows are drawn together."""
    path = work_dir(docs.sparkSession, "drawn")
    key, digest, name, rounds, rests, own, words = unused(
        docs.columns, "__id", "__hash", "__source", "__rounds", "__rests", "__text", "__words")
    plan = mixed(docs, f"{path}/plan", id_col=id_col, text_col=text_col, source_col=source_col)
    plan = stored(plan.where("taken > 0").groupBy(
        F.col("doc_id").alias(key), F.col("text_hash").alias(digest), F.col("source").alias(name)).agg(
        F.sum("rounds").alias(rounds), F.collect_list(F.when(F.col("rest") > 0, F.col("rest"))).alias(rests)),
        f"{path}/taken")
    columns = docs.columns
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = rows.dropDuplicates([id_col, own, source_col]).join(
        plan, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(digest))
        & F.col(source_col).eqNullSafe(F.col(name)))
    rows = rows.withColumn(words, F.explode(F.concat(
        F.array_repeat(F.lit(-1).cast("long"), F.col(rounds).cast("int")), rests)))
    rows = rows.withColumn(text_col, F.when(F.col(words) < 0, F.col(text_col)).otherwise(
        first_words(F.col(text_col), F.col(words).cast("int"))))
    if length_col in columns:
        rows = rows.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return rows.select(*columns)
