"""Connected components by alternating large-star and small-star rounds.

Each round replaces the links by links to smaller neighbours, with joins and
pre-aggregated minima only, so a node with very many links costs no single
task; the links of a round are written to the shared folder, which cuts the
lineage.  Only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored

MOST_ROUNDS = 64       # rounds needed grow with the logarithm of a component's size


def _pairs(df: DataFrame, *pairs) -> DataFrame:
    """A row (a, b) for each of ``pairs`` of columns of a row, from one pass."""
    both = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])
    return df.select(F.explode(both).alias("p")).select("p.a", "p.b")


def _large_star(links: DataFrame) -> DataFrame:
    both = _pairs(links, ("a", "b"), ("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    return _pairs(links.join(least, "b"), ("m", "b"), ("m", "a")).where("a < b").distinct()


def components(links: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the component's
    smallest node.  Links with a = b or repeated links change nothing.
    ``rows``: about how many rows ``links`` are made from."""
    state = stored(links.where("a != b").select(F.least("a", "b").alias("a"),
                                               F.greatest("a", "b").alias("b")).distinct(), f"{path}/links", rows=rows)
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    seen = mark(state)
    for k in range(MOST_ROUNDS):
        if not seen[0]:
            break
        state = stored(_small_star(_large_star(state)), f"{path}/round-{k}", rows=2 * seen[0])
        if (now := mark(state)) == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
    return state.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
