"""Near-duplicate documents by an inverted join of signature coordinates.

1. Each text becomes the set of its hashed word shingles and ``COORDINATES``
   min-hash values of the set, whose lowest bits hold the coordinate: so one
   number names a coordinate-value pair.  Documents with equal sets are one class, which
   stands for all its copies from here on.
2. Every class is posted under each of its coordinate values.  Values that one
   class holds alone are dropped; a class left with fewer than ``least``
   values can match nobody.  Of the rest, sorted by how many classes share
   them, a class joins with its first ``shared - least + 1`` lists only: two
   classes with ``least`` values in common meet in one of those (prefix).
3. The lists that name the same least class form a candidate group; its members
   are dealt into blocks of bounded size, and a task takes two blocks.  There the short prefix lists are merged into candidates, and the long lists
   are skipped: their collisions are counted by comparing the candidate's
   coordinates.  Candidates with ``least`` collisions are confirmed on the full
   sets; candidates already connected are not.  Tasks return the links of a
   spanning forest, never all pairs.
4. Connected components of the confirmed links give the result.

``least`` is the largest number of collisions that a pair at the threshold
misses with a probability below ``MISS``; the test of step 3 then decides.

Defined results: a null text, or one without words, has no shingles, is linked
with nothing and is its own component; texts with fewer words than a shingle
have one shingle, the whole sequence; a component's id is the smallest doc_id
that is not null (null if all are); a document is kept if its doc_id is that
id, nulls being equal.  Texts of any length are read whole; repeated rows are copies of
one another; an empty table gives no rows; only the key and the text are read
(``one_of_each`` returns all columns, whatever their names).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import release, stored, unused, work_dir
from kestrel.llm.components import components

COORDINATES = 48
MISS = 1e-5
BLOCK_SHINGLES = 1 << 20           # of all members of a block: 8 MB
KNOWN_WORDS = 1 << 17              # word hashes that a task remembers
SEED = 7


def least_collisions(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    below, least = 0.0, 0
    while True:
        below += math.comb(coordinates, least) * similarity ** least * (1 - similarity) ** (coordinates - least)
        if below > miss:
            return max(1, least)
        least += 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case."""
    words = text.encode("utf-8", "surrogatepass").lower().split()   # on the six ASCII separators
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` words, in text order; of all words if fewer."""
    length = min(length, len(words))
    out = np.full(max(0, len(words) - length + 1) if length else 0, length, np.uint64)
    for k in range(length):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(out)])
    return out


def _signature(shingles: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.full(len(masks), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        out = np.minimum(out, ((shingles[at:at + 4096, None] ^ masks) * factors).min(axis=0))
    low = np.uint64((1 << (len(masks) - 1).bit_length()) - 1)
    return out & ~low | np.arange(len(masks), dtype=np.uint64)


def features(docs: DataFrame, words: int, coordinates: int = COORDINATES, seed: int = SEED) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id (16 bytes, null without shingles), signature."""

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(seed)
        masks = rng.integers(0, 1 << 63, coordinates, np.uint64) << np.uint64(1)
        factors = rng.integers(0, 1 << 63, coordinates, np.uint64) << np.uint64(1) | np.uint64(1)
        for part in parts:
            sizes, ids, signatures = [], [], []
            for text in part.pop("text"):
                shingles = np.unique(shingle_hashes(word_hashes(text), words))
                sizes.append(len(shingles))
                ids.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                signatures.append(_signature(shingles, masks, factors).view(np.int64) if len(shingles) else None)
            yield part.assign(n_shingles=sizes, set_id=ids, signature=signatures)
        _hashes.clear()
        release()

    return docs.mapInPandas(scan, "doc_id long, text_hash long, n_shingles long, set_id binary, "
                                  "signature array<long>")


def _group_links(least: int, num: int, den: int):
    """The task of step 3 over the rows of one or two blocks."""

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("set_id").sort_values("set_id", ignore_index=True)
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        size = np.array([len(s) for s in sets])
        two = rows["x"].iat[0] != rows["y"].iat[0]
        side = (rows["block"] == rows["x"]).to_numpy()
        signature = np.vstack(rows["signature"].to_numpy())
        count, width = signature.shape
        # posting lists of the rows' prefixes, values in the order of their frequency
        _, value, often = np.unique(signature, return_inverse=True, return_counts=True)
        value = value.reshape(count, width)
        order = np.lexsort((value, often[value]), axis=1)[:, :width - least + 1]
        prefix = np.take_along_axis(value, order, axis=1)
        by_value = np.argsort(prefix, axis=None, kind="stable")
        holder = by_value // prefix.shape[1]
        starts = np.searchsorted(prefix.ravel()[by_value], np.arange(len(often) + 1))
        group = np.arange(count)
        out = []
        for i in range(count):
            met = np.unique(np.concatenate([holder[starts[v]:starts[v + 1]] for v in prefix[i]]))
            met = met[(met < i) & (group[met] != group[i])]
            if two:
                met = met[side[met] != side[i]]
            met = met[(den * size[met] >= num * size[i]) & (den * size[i] >= num * size[met])]
            hits = (signature[met] == signature[i]).sum(axis=1)
            met = met[np.argsort(-hits, kind="stable")][:np.count_nonzero(hits >= least)]
            while len(met):
                j = met[0]
                small, large = (i, j) if size[i] < size[j] else (j, i)
                at = np.searchsorted(sets[large], sets[small])
                common = np.count_nonzero(sets[large][np.minimum(at, size[large] - 1)] == sets[small])
                if den * common >= num * (size[i] + size[j] - common):
                    out.append((rows["set_id"].iat[i], rows["set_id"].iat[j]))
                    group[group == group[j]] = group[i]
                    met = met[group[met] != group[i]]
                else:
                    met = met[1:]
        return pd.DataFrame(out, columns=["a", "b"])

    return link


def near_duplicates(docs: DataFrame, words: int = 3, num: int = 85, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept: one row per document.

    Two documents are linked if den * |common shingles| >= num * |all shingles|."""
    path = path or work_dir(docs.sparkSession, "neardup")
    least = least_collisions(num / den)
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        text.alias("text"))
    doc = stored(features(given, words), f"{path}/features")
    # tasks by what they hold: about as many of these as of documents of a hundred shingles
    count, shingles = doc.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = stored(doc.where("set_id is not null").groupBy("set_id").agg(
        first.alias("first"), F.first("signature").alias("signature"))
        .select("set_id", "signature", "first.doc_id", "first.text_hash"), f"{path}/classes", rows=count)

    posting = classes.select("set_id", F.explode("signature").alias("value"))
    often = posting.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    lists = (posting.join(often, "value").groupBy("set_id")
             .agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("lists")))
    prefix = stored(lists.where(F.size("lists") >= least).select("set_id", F.explode(F.expr(
        f"slice(lists, 1, size(lists) - {least} + 1)")).alias("l")).select("set_id", "l.value"), f"{path}/prefix", rows=count)
    # a list's group is named by its least class, so lists of one family share groups
    hubs = prefix.groupBy("value").agg(F.min("set_id").alias("grp"), F.count("*").alias("n")).where("n > 1")
    met = stored(prefix.join(hubs, "value").select("grp", "set_id").distinct(), f"{path}/groups", rows=count)

    # shingle sets of the candidates, from one text of each class
    wanted = classes.join(met.select("set_id").distinct(), "set_id").select(
        "set_id", "signature", F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash"))
    texts = (given.join(wanted, (F.col("doc_id").eqNullSafe(F.col("first_id")))
                        & (F.col("text_hash") == F.col("first_hash")))
             .groupBy("set_id").agg(F.first("signature").alias("signature"), F.first("text").alias("text")))

    def shingled(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sets = [np.unique(shingle_hashes(word_hashes(t), words)) for t in part.pop("text")]
            yield part.assign(size=[len(s) for s in sets], shingles=[s.tobytes() for s in sets])
        _hashes.clear()
        release()

    member = stored(texts.mapInPandas(shingled, "set_id binary, signature array<long>, size long, shingles binary"),
                    f"{path}/members", rows=max(count, shingles // 100))
    blocks = met.join(member.select("set_id", "size"), "set_id").groupBy("grp").agg(
        F.sum("size").alias("all")).select("grp", F.expr(f"1 + all div {BLOCK_SHINGLES}").alias("blocks"))
    # stored, so that a hot group's rows meet it by a broadcast or a join that AQE splits
    blocks = stored(blocks, f"{path}/blocks", rows=count)
    dealt = met.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("set_id"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "grp", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "set_id")
    paired = dealt.join(member.select("set_id", "signature", "shingles"), "set_id")
    links = paired.groupBy("grp", "x", "y").applyInPandas(_group_links(least, num, den), "a binary, b binary")
    found = components(links, f"{path}/links", rows=count)

    cls = (classes.join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
           .select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root")))
    named = cls.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stored(cls.join(named, "root").select("set_id", "component_id"), f"{path}/components", rows=count)
    doc = doc.select("doc_id", "text_hash", "n_shingles", "set_id")
    out = (doc.where("set_id is not null").join(named, "set_id")
           .select("doc_id", "text_hash", "n_shingles", "component_id")
           .unionByName(doc.where("set_id is null").select(
               "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: one document of each component,
    repeated rows once.  All columns stay."""
    marked = near_duplicates(docs, words, num, den, id_col, text_col)
    key, digest, own = unused(docs.columns, "__id", "__hash", "__text")
    kept = marked.where("kept").select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest)).distinct()
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return (rows.join(kept, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(digest)), "left_semi")
            .dropDuplicates([id_col, own]).drop(own))


ORACLE = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM w UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.node = w.doc_id
"""
