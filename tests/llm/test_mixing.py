import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from kestrel.llm import mixing
from kestrel.llm.queries import op4_sainte_lague_mix

WORDS = re.compile("[^\x20\x09-\x0d]+")


def _targets(sizes):
    """Share by weight, stop full sources, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    out, left, free = {s: 0.0 for s in sizes}, float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if out[s] + unit * weight[s] >= 3 * sizes[s]}
        for s in free:
            out[s] += unit * weight[s]
        left = sum(out[s] - 3 * sizes[s] for s in full)
        for s in full:
            out[s] = 3.0 * sizes[s]
        free -= full
        if not full:
            break
    return out


def _seats(target, total, cap, seats):
    """Block after block to the highest quotient."""
    got, order = Counter(), sorted(target, key=lambda s: (s is None, s or ""))
    for _ in range(seats):
        can = [s for s in order if got[s] < cap[s] and target[s] > 0]
        if not can:
            break
        got[max(can, key=lambda s: (target[s] / (2 * got[s] + 1), -order.index(s)))] += 1
    return got


def _rows(rng, n=300):
    names = [None, "a", "B", "é", "z" * 40, "src1", "src10", "empty", "tiny"]
    rows = []
    for i in range(n):
        s = "src1" if rng.random() < 0.35 else rng.choice(names)
        text = rng.choice([None, "", " \n"]) if s == "empty" else "one" if s == "tiny" else " ".join(["w"] * rng.randrange(60))
        rows.append((i, text, s))
    return rows


def test_op4_against_brute_force(spark, docs_of, written):
    rows = [*_rows(random.Random(1)), (7, "same row", "a"), (7, "same row", "a"), (None, "no id", "a")]
    folder = written(documents=docs_of(rows))
    got = op4_sainte_lague_mix(spark, folder).collect()
    count = lambda t: len(WORDS.findall(t or ""))
    rows.append((None, None, None))
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += count(t)
    target = _targets(size)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, count(t)) for i, t, _ in rows)
    by_target = defaultdict(float)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_target[round(r.target, 6)] += r.taken
    expected = defaultdict(float)
    for s, t in target.items():
        expected[round(t, 6)] += t
    assert by_target.keys() == expected.keys()
    total = sum(size.values())
    block = max(1, min(mixing.BLOCK_WORDS, total // mixing.LEAST_BLOCKS))
    for t in expected:
        assert abs(by_target[t] - expected[t]) <= 3 * block * len(size)
    again = op4_sainte_lague_mix(spark, folder).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert op4_sainte_lague_mix(spark, written(documents=docs_of([]))).count() == 0


def test_quotas_are_sainte_lague_in_every_shard(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BLOCKS", 200)
    rng = random.Random(3)
    sizes = {f"s{k}": rng.choice([0, 3, 90, 400, 2500]) for k in range(12)} | {None: 700}
    frame = spark.createDataFrame([(0, s, n) for s, n in sizes.items()], "doc_id long, source string, size long")
    goals = mixing.targets(frame)
    rows = mixing.quotas(goals, blocks_per_shard=37).collect()
    target = {r.source: r.target for r in goals.collect()}
    expected = _targets(sizes)
    assert all(abs(target[s] - expected[s]) < 1e-6 for s in sizes)
    total, block = sum(sizes.values()), rows[0].block_words
    seats = total // block
    for end in range(37, seats + 37, 37):
        want = _seats(target, total, {s: 3 * n // block for s, n in sizes.items()}, min(end, seats))
        got = Counter()
        for r in rows:
            if (r.shard + 1) * 37 <= end:
                got[r.source] += r.blocks
        assert +got == want
    assert all(r.blocks >= 0 for r in rows)


def test_shards_hold_their_quotas(spark, docs_of, monkeypatch, tmp_path):
    """The words that a shard takes of a source are its blocks, and a document's parts add up."""
    monkeypatch.setattr(mixing, "LEAST_BLOCKS", 300)
    docs = docs_of(_rows(random.Random(9), 400))
    sizes = mixing.stored(mixing.sized(docs), f"{tmp_path}/sizes")
    goals = mixing.stored(mixing.targets(sizes), f"{tmp_path}/goals")
    blocks = mixing.stored(mixing.seats(goals, str(tmp_path), blocks_per_shard=50), f"{tmp_path}/held")
    words = mixing.stored(mixing.source_words(goals, blocks, str(tmp_path)), f"{tmp_path}/given")
    stream = mixing.stored(mixing.streamed(sizes), f"{tmp_path}/stream")
    rows = mixing.selected(stream, words, blocks).collect()
    block = blocks.first().block_words
    whole = {r.source: r.whole for r in words.collect()}
    quota = Counter()
    for r in blocks.collect():
        if (r.block + 1) * block <= whole[r.source]:
            quota[r.shard, r.source] += block
    got = Counter()
    for r in rows:
        if r.shard is not None:
            got[r.shard, r.source] += r.words
    assert got == quota and len({k for k, _ in quota}) > 3
    assert sum(r.words for r in rows) == sum(r.words for r in words.collect())
    assert all(0 < r.words <= r.size for r in rows)


def test_very_many_sources(spark, tmp_path):
    """Tens of thousands of sources, nearly all of one size: seats by divisor, ties ranked in ranges."""
    n = 30_000
    frame = spark.range(n).select(F.format_string("s%06d", F.col("id")).alias("source"),
                                  (50 + F.when(F.col("id") < 9, F.col("id") * 100_000).otherwise(0)).alias("size"))
    goals = mixing.stored(mixing.targets(frame), f"{tmp_path}/goals")
    total = goals.first().total
    rows = mixing.apportioned(goals.withColumn("cap", 3 * F.col("source_size")), total, str(tmp_path)).collect()
    assert sum(r.seats for r in rows) == total and len(rows) == n
    assert all(abs(r.seats - r.target) < 1 + 1e-6 and r.seats <= r.cap for r in rows)


def test_drawn_rows(spark, docs_of):
    rows = _rows(random.Random(5), 120)
    docs = docs_of(rows)
    drawn = mixing.drawn(docs)
    assert drawn.columns == docs.columns
    planned = {r.doc_id: r.taken for r in mixing.mixed(docs).collect()}
    words, texts = Counter(), {i: t for i, t, _ in rows}
    for r in drawn.collect():
        words[r.doc_id] += len(WORDS.findall(r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert +words == +Counter(planned)


def test_first_words(spark):
    text = "  ab\x0b c\n\n dé  f "
    for k, expected in ((0, "  "), (1, "  ab\x0b "), (3, "  ab\x0b c\n\n dé  "), (4, text), (9, text)):
        cut = spark.createDataFrame([(text,)], "t string").select(mixing.first_words(F.col("t"), F.lit(k))).first()[0]
        assert WORDS.findall(cut) == WORDS.findall(expected) and text.startswith(cut)
