"""Nearest neighbours by a block matrix join.

Vectors are scaled to length one and kept twice: as int8 codes with the length
of what the codes lose, and as given.  Queries and candidates are packed into
blocks; a tile is one block of each.  In a tile the product of the codes gives
every cosine up to an error of at most e_q + (1 + e_q) e_c, from the two
lengths lost.  A candidate survives if its highest possible cosine reaches the
k-th largest of the query's lowest possible ones, so none of the true nearest
is lost; survivors are computed again in double precision on the given
vectors.  The tiles' sorted lists are merged by heaps, a query at a time.

Vectors are multiplied by powers of two first, so components of any finite size
give finite products.  Every candidate meets every query: the result is exact.  Tiles bound the
memory of a task, and their number is the product of the numbers of blocks.

Defined results: vectors that are null, empty, all zero or hold a null or
non-finite component take no part, as query or candidate; vectors of another
length are never compared; a row without vec_id takes no part; rows sharing
the query's vec_id are the query's own; equal scores go to the smaller vec_id;
with fewer candidates all are returned; an empty table, or one without
queries, gives no rows; only the id and the vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored, work_dir

QUERY_BLOCK = 1024
BLOCK = 4096
MOST_TASKS = 20_000              # of the tiles' stage
EXACT_AT_ONCE = 1 << 16          # pairs computed in double precision at a time
DIMS_AT_ONCE = 1024              # of a code product that single precision holds exactly

PACKED = "dim int, block long, ids array<long>, given binary, codes binary, scale binary, lost binary"


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part."""
    v = df.select(F.col(id_col).cast("long").alias("vec_id"),
                  F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(finite).where(
        F.exists("vector", lambda x: x != 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: exact, no
    cosine changes, and neither large nor small components leave the range when squared."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _short(given: np.ndarray) -> np.ndarray:
    """The vectors in single precision if that is exact, as for tables of floats."""
    with np.errstate(over="ignore", under="ignore"):
        single = given.astype(np.float32)
    return single if (single == given).all() else given


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", ignore_index=True)
    given = _scaled(np.vstack(rows["vector"].to_numpy()))
    unit = given / np.sqrt(np.square(given).sum(axis=1))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = np.sqrt(np.square(unit - codes * scale[:, None]).sum(axis=1)) + 1e-9
    return pd.DataFrame({"dim": [given.shape[1]], "block": [rows["block"].iat[0]],
                         "ids": [rows["vec_id"].to_numpy()], "given": [_short(given).tobytes()],
                         "codes": [codes.tobytes()], "scale": [scale.tobytes()], "lost": [lost.tobytes()]})


def packed(rows: DataFrame, per_block: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of about ``per_block`` vectors, and their number for each length."""
    rows = rows.withColumn("dim", F.size("vector"))
    blocks = rows.groupBy("dim").agg(F.ceil(F.count("*") / per_block).alias("blocks"))
    dealt = rows.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
    return dealt.select("dim", "block", "vec_id", "vector").groupBy("dim", "block").applyInPandas(_pack, PACKED), blocks


class _Block:
    def __init__(self, row):
        self.ids = np.asarray(row.ids)
        shape = (len(self.ids), row.dim)
        single = len(row.given) == 4 * shape[0] * shape[1]
        self.given = np.frombuffer(row.given, np.float32 if single else np.float64).reshape(shape).astype(np.float64)
        self.codes = np.frombuffer(row.codes, np.int8).reshape(shape).astype(np.float32)
        self.scale, self.lost = np.frombuffer(row.scale), np.frombuffer(row.lost)
        self.length = np.sqrt(np.square(self.given).sum(axis=1))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.zeros((len(q), len(c)))
    for d in range(0, q.shape[1], DIMS_AT_ONCE):
        out += q[:, d:d + DIMS_AT_ONCE] @ c[:, d:d + DIMS_AT_ONCE].T
    return out


def _tile(k: int):
    def nearest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = list(rows.itertuples())
        queries = [_Block(r) for r in rows if r.query]
        if not queries or len(rows) == len(queries):
            return pd.DataFrame({"query_id": [], "scores": [], "vec_ids": []})
        q, c = queries[0], next(_Block(r) for r in rows if not r.query)
        out = []
        for at in range(0, len(q.ids), 256):
            part = slice(at, at + 256)
            rough = _products(q.codes[part], c.codes) * q.scale[part, None] * c.scale
            slack = q.lost[part, None] + (1 + q.lost[part, None]) * c.lost
            own = q.ids[part, None] == c.ids
            low = np.where(own, -np.inf, rough - slack)
            least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
            qi, ci = np.nonzero((rough + slack >= least[:, None]) & ~own)
            score = np.empty(len(qi))
            for s in range(0, len(qi), EXACT_AT_ONCE):
                a, b = qi[s:s + EXACT_AT_ONCE] + at, ci[s:s + EXACT_AT_ONCE]
                score[s:s + EXACT_AT_ONCE] = (q.given[a] * c.given[b]).sum(axis=1) / (q.length[a] * c.length[b])
            order = np.lexsort((c.ids[ci], -score, qi))
            qi, ci, score = qi[order], ci[order], score[order]
            starts = np.searchsorted(qi, np.arange(len(low) + 1))
            for i in range(len(low)):
                best = slice(starts[i], min(starts[i] + k, starts[i + 1]))
                if starts[i] < starts[i + 1]:
                    out.append((q.ids[at + i], score[best], c.ids[ci[best]]))
        return pd.DataFrame(out, columns=["query_id", "scores", "vec_ids"])

    return nearest


def _merge(k: int):
    def merged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for part in parts for r in zip(part.query_id, part.scores, part.vec_ids))
        out = []
        for query, lists in groupby(rows, key=lambda r: r[0]):
            # each tile's list is sorted; the heap holds one entry of each
            best = heapq.merge(*[list(zip(-s, i)) for _, s, i in lists])
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(islice(best, k), 1)]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
                out = []
        yield pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])

    return merged


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5, path: str | None = None,
            query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` candidates of the largest cosine for
    each query, from (vec_id, vector) rows of :func:`vectors`."""
    path = path or work_dir(candidates.sparkSession, "neighbours")
    cand, cand_blocks = packed(candidates, block)
    quer, quer_blocks = packed(queries, query_block)
    cand, quer = stored(cand, f"{path}/candidates"), stored(quer, f"{path}/queries")
    both = lambda df, blocks, mine, other, flag: df.join(blocks, "dim").withColumn(
        other, F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        F.lit(flag).alias("query"), F.col("block").alias(mine), other, "dim", "ids", "given", "codes", "scale", "lost")
    tiles = both(quer, cand_blocks, "q", "c", True).unionByName(both(cand, quer_blocks, "c", "q", False))
    # as many tasks as tiles, up to a bound: their work, not their bytes, is what counts
    count = cand_blocks.alias("a").join(quer_blocks.alias("b"), "dim").agg(F.sum(F.expr("a.blocks * b.blocks"))).first()[0]
    tiles = tiles.repartition(int(max(1, min(count or 1, MOST_TASKS))), "dim", "q", "c")
    lists = tiles.groupBy("dim", "q", "c").applyInPandas(
        _tile(k), "query_id long, scores array<double>, vec_ids array<long>")
    return (lists.repartition("query_id").sortWithinPartitions("query_id")
            .mapInPandas(_merge(k), "query_id long, rank int, vec_id long, score double"))


def search_multiples(df: DataFrame, every: int, k: int = 5, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """The rows whose id is divisible by ``every``, searched for among all rows."""
    rows = vectors(df, id_col, vector_col)
    return nearest(rows.where(F.col("vec_id") % every == 0), rows, k)
