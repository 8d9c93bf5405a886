"""Quality classifier: random-indexing word vectors and a two-layer network.

* Words, runs of digits and letters or of signs, are hashed into ``WORDS``
  rows.  Each row has a sparse random index vector (``NONZEROS`` entries of
  +1 or -1 in ``DIMS`` places); a row's context vector is the sum of the index
  vectors around its occurrences, over all documents.  Tasks sum their own
  documents; the sums of all tasks are added block by block, in ``LANES`` first.
  They are whole numbers, so their order changes nothing and reruns agree.  The
  table has WORDS x DIMS numbers at any size of the corpus (4 MB), which bounds what is
  broadcast.
* A document is pooled into the mean and the spread of the vectors of its
  words, with its length and its share of different words.
* A network of one hidden layer is fitted on at most ``TRAINING_ROWS`` labelled
  rows (those of the smallest seeded hash), a fifth of which set aside to
  calibrate its temperature: score = sigmoid(logit / temperature).

Rows with crc32(doc_id as text) mod 5 = 0 are held out and never fitted on.
Labels, language, source and id are no inputs of a score.

Defined results: a null text is an empty one, pooled into zeros and scored; a
null doc_id counts as the empty text for ``held_out``; several labels of a
document count as their mean, half or more being 1; without labels every score
is 0.5, and with labels of one kind it is their smoothed share; texts of any length
are read whole; repeated rows are scored alike; an empty table gives no rows; other
columns are not read (``scored`` returns them all).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import release, stored, work_dir

WORDS, DIMS, NONZEROS = 1 << 14, 64, 4
AROUND = (1, 2)                   # distances of the words that give context
BLOCK_ROWS = 512                  # of the context table, summed together
LANES = 256                        # in which the tasks' tables are first added up
TRAINING_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
SEED = 11
THRESHOLD = 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Rows(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % WORDS
        return value


_rows = _Rows()


def words(text: str) -> np.ndarray:
    found = _TOKEN.findall(text)
    return np.fromiter(map(_rows.__getitem__, found), np.int32, len(found))


def index_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each row's index vector."""
    rng = np.random.default_rng(seed)
    return (np.argsort(rng.random((WORDS, DIMS)), axis=1)[:, :NONZEROS].astype(np.int32),
            rng.choice(np.array([-1.0, 1.0]), (WORDS, NONZEROS)))


def context_vectors(docs: DataFrame, path: str, text_col: str = "text") -> np.ndarray:
    """The summed context vectors of all documents, WORDS x DIMS."""

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors()
        total, held, size = np.zeros(WORDS * DIMS), [], 0

        def add() -> None:
            row, near = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            for e in range(NONZEROS):
                total[:] += np.bincount(row * DIMS + places[near, e], signs[near, e], WORDS * DIMS)
            held.clear()

        for part in parts:
            for text in part["text"]:
                w = words(text)
                for d in AROUND:
                    if len(w) > d:
                        held += [(w[:-d], w[d:]), (w[d:], w[:-d])]
                        size += 2 * len(w)
                if size > 1 << 21:
                    add()
                    size = 0
        if held:
            add()
        table = total.reshape(-1, BLOCK_ROWS * DIMS)
        _rows.clear()
        release()
        yield pd.DataFrame({"block": np.arange(len(table)), "lane": TaskContext.get().partitionId() % LANES,
                            "sums": [r.tobytes() for r in table]})

    def add_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # sums of whole numbers: exact, in whatever order they come
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for block, raw in zip(part["block"], part["sums"]):
                if block in sums:
                    sums[block] += np.frombuffer(raw)
                else:
                    sums[block] = np.frombuffer(raw).copy()
        yield pd.DataFrame({"block": list(sums), "sums": [s.tobytes() for s in sums.values()]})

    text = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # in two levels, so that the tables of very many tasks do not meet in a few
    sums = text.mapInPandas(gather, "block int, lane int, sums binary").repartition("block", "lane").mapInPandas(
        add_up, "block int, sums binary").repartition("block").mapInPandas(add_up, "block int, sums binary")
    table = np.zeros((WORDS // BLOCK_ROWS, BLOCK_ROWS * DIMS))
    for row in stored(sums, f"{path}/context").collect():      # WORDS x DIMS numbers in all
        table[row["block"]] += np.frombuffer(row["sums"])
    return table.reshape(WORDS, DIMS)


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Context vectors without their common direction, at length one."""
    length = np.linalg.norm(context, axis=1, keepdims=True)
    unit = context / np.maximum(length, 1e-12)
    unit = unit - unit[length[:, 0] > 0].mean(axis=0) if (length > 0).any() else unit
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors, log length, share of different words."""
    w = words(text)
    out = np.zeros(2 * DIMS + 2, np.float32)
    if len(w):
        row, count = np.unique(w, return_counts=True)
        share, found = (count / len(w)).astype(np.float32), vectors[row]
        mean = share @ found
        out[:DIMS] = mean
        out[DIMS:2 * DIMS] = np.sqrt(np.maximum(share @ np.square(found) - np.square(mean), 0))
        out[2 * DIMS] = np.log1p(len(w))
        out[2 * DIMS + 1] = len(row) / len(w)
    return out


# --- the network ------------------------------------------------------------

class Network:
    """Logits of pooled documents; ``constant`` where there is nothing to fit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        self.constant = None
        if len(y) == 0 or y.min() == y.max():
            self.constant = float((y.sum() + 1) / (len(y) + 2))
            return
        rng = np.random.default_rng(seed)
        held = rng.permutation(len(y)) < len(y) // 5
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.mean) / self.spread
        n = z.shape[1]
        self.p = [rng.normal(0, n ** -0.5, (n, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
        self._fit(z[~held], y[~held], rng)
        self.temperature = self._calibrated(self._logits(z[held]), y[held]) if held.any() else 1.0

    def _logits(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def _fit(self, z: np.ndarray, y: np.ndarray, rng) -> None:
        m, v, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                i = order[at:at + BATCH]
                hidden = np.tanh(z[i] @ self.p[0] + self.p[1])
                out = hidden @ self.p[2] + self.p[3]
                d = (1 / (1 + np.exp(-np.clip(out, -60, 60))) - y[i]) / len(i)
                back = np.outer(d, self.p[2]) * (1 - hidden ** 2)
                grads = [z[i].T @ back + DECAY * self.p[0], back.sum(axis=0),
                         hidden.T @ d + DECAY * self.p[2], d.sum()]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    @staticmethod
    def _calibrated(logits: np.ndarray, y: np.ndarray) -> float:
        """The temperature of the least log loss, on a grid over 1/8 to 8."""
        loss = lambda t: np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t).mean()
        return float(min(np.exp2(np.linspace(-3, 3, 121)), key=loss))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logits = self._logits((x - self.mean) / self.spread) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


# --- Spark ------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fitted(docs: DataFrame, labels: DataFrame, path: str, training_rows: int = TRAINING_ROWS,
           id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, Network]:
    """Word vectors of all of ``docs`` and the network fitted on labelled ones."""
    vectors = word_vectors(context_vectors(docs, path, text_col))
    label = (labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).alias("y"))
             .where("__id is not null and y is not null").where(~held_out(F.col("__id")))
             .groupBy("__id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    text = docs.select(F.col(id_col).cast("long").alias("__id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chosen = (text.select("__id").join(label, "__id").withColumn("place", F.xxhash64(F.lit(SEED), "__id"))
              .orderBy("place", "__id").limit(training_rows).select("__id", "y"))
    chosen = stored(chosen.distinct(), f"{path}/chosen")

    def pool(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"id": part["__id"], "y": part["y"],
                                "x": [pooled(t, vectors).tobytes() for t in part["text"]]})

    rows = stored(text.join(chosen, "__id").mapInPandas(pool, "id long, y int, x binary"), f"{path}/training")
    rows = rows.orderBy("id", "x").limit(training_rows).collect()
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64).reshape(len(rows), 2 * DIMS + 2)
    return vectors, Network(x, np.array([r["y"] for r in rows], np.float64))


def scored(docs: DataFrame, labels: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; all columns stay."""
    path = path or work_dir(docs.sparkSession, "quality")
    vectors, network = fitted(docs, labels, path, id_col=id_col, text_col=text_col, label_col=label_col)
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))     # WORDS x DIMS numbers

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors, network = model.value
        for texts in parts:
            x = np.array([pooled(t, vectors) for t in texts], np.float64).reshape(len(texts), 2 * DIMS + 2)
            yield pd.Series(network.score(x))
        _rows.clear()
        release()

    out = docs.withColumn("score", score(F.coalesce(F.col(text_col), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"), labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
