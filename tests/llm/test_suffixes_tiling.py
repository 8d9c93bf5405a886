import hashlib
import random
from collections import Counter

import numpy as np

from kestrel.llm import suffixes, tiling
from kestrel.llm.queries import op6_string_tiling, op7_induced_suffixes


def _repeated(parts, n):
    seen = Counter(p[i:i + n] for p in parts for i in range(len(p) - n + 1))
    return [[seen[p[i:i + n]] > 1 for i in range(len(p) - n + 1)] for p in parts]


def test_induced_sort_against_counting(tmp_path):
    rng = random.Random(1)
    for trial in range(150):
        n, letters = rng.choice([2, 3, 5, 8, 20]), rng.choice([b"a", b"ab", b"abc", bytes(range(256)), b"\x00\xff"])
        base = bytes(rng.choices(letters, k=60))
        parts = []
        for _ in range(rng.randrange(6)):
            s = rng.randrange(60)
            parts.append(bytes(rng.choices(letters, k=rng.randrange(40))) + base[s:s + rng.randrange(40)])
        limit = rng.choice([64, 1 << 20])       # 64: every queue lives in files
        got = suffixes.repeated_windows(parts, str(tmp_path / str(trial)), n, limit)
        assert [list(map(bool, g)) for g in got] == _repeated(parts, n)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_a_large_shard_spills_below_its_limit(tmp_path, monkeypatch):
    """Four megabytes with queues of eight: they move to files, and the result is that of counting."""
    limit = 8 << 20
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) + b" " for _ in range(3000)]
    text = b"".join(words[k] for k in rng.integers(0, 3000, 640_000))[:4 << 20]
    text = text[:2 << 20] + text[100:5000] + text[2 << 20:]
    spilled, spill = [], suffixes.Queues._spill
    monkeypatch.setattr(suffixes.Queues, "_spill", lambda self: (spilled.append(self.held), spill(self)))
    got, = suffixes.repeated_windows([text], str(tmp_path), 64, limit)
    assert len(text) < suffixes.SHARD_BYTES and len(spilled) > 0 and min(spilled) > limit
    assert max(spilled) < limit + (4 << 20)
    data = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), 64)
    weights = rng.integers(1, 1 << 62, 64, np.int64) | 1
    sums = np.concatenate([(data[at:at + 100_000].astype(np.int64) * weights).sum(axis=1) for at in range(0, len(data), 100_000)])
    _, which, count = np.unique(sums, return_inverse=True, return_counts=True)
    assert (got == (count[which] > 1)).all() and got.sum() > 9000
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_segments_cover_each_window_once():
    rng = random.Random(2)
    for size in (0, 199, 200, 201, 5000, 40_000):
        data = bytes(rng.choices(b"abcdefgh ", k=size)) if size != 40_000 else b"ab" * 20_000
        start, run, _, several = suffixes.segments(data)
        windows = [w for s, r in zip(start, run) for w in range(s, s + r)]
        assert windows == list(range(max(0, size - 199))) and run.max(initial=0) <= suffixes.MOST_RUN
        assert size != 40_000 or several.any()


def test_op7_against_counting(spark, docs_of, written):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdéß ", k=9))
    shared = " ".join(word() for _ in range(60))
    prose = [" ".join(word() for _ in range(rng.randrange(120))) for _ in range(40)]
    texts = [p + (shared[rng.randrange(99):][:rng.randrange(600)] if k % 3 else "") for k, p in enumerate(prose)]
    texts += ["", None, "q" * 199, "q" * 200, "r" * 201, "tick tock " * 900, shared, shared, "é" * 99 + "x" * 3,
              shared[:250] + "#" + shared[50:]]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(3, texts[3], "s"), (3, "other " + texts[3], "s")]
    got = op7_induced_suffixes(spark, written(documents=docs_of(rows))).collect()
    data = [(t or "").encode() for _, t, _ in [*rows, (None, None, None)]]
    expected = []
    for (i, *_), raw, flags in zip([*rows, (None, None, None)], data, _repeated(data, 200)):
        gone = np.zeros(len(raw), bool)
        for k in np.flatnonzero(flags):
            gone[k:k + 200] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert Counter(map(tuple, got)) == Counter(expected)
    assert sum(e[2] for e in expected) > 10_000
    assert op7_induced_suffixes(spark, written(documents=docs_of([]))).count() == 0


# --- tiling -----------------------------------------------------------------

def _tiles(item, doc, least):
    """Greedy string tiling by comparing every pair of places."""
    used_i, used_j, out = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and i + n not in used_i and j + n not in used_j):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (i, j, n)
        if best is None:
            return out
        out.append(best)
        used_i |= set(range(best[0], best[0] + best[2]))
        used_j |= set(range(best[1], best[1] + best[2]))


def test_very_long_repetitive_documents(spark, docs_of):
    """Two hundred equal words against a hundred thousand: twenty million seeds, a few matches."""
    items = spark.createDataFrame([(1, "tick " * 200), (2, " ".join(f"w{k}" for k in range(40)))], "item_id long, text string")
    doc = "tick " * 100_000 + " ".join(f"w{k}" for k in range(40))
    got = tiling.contaminated(docs_of([(7, doc, "s"), (8, "tick " * 150, "s"), (9, "tock " * 500, "s")]), items).collect()
    assert sorted((r.doc_id, r.item_id, r.tiles, r.matched_words) for r in got) == [(7, 1, 1, 200), (7, 2, 1, 40)]


def test_matches_of_any_cut(monkeypatch):
    """Seeds read in pieces of any size give the same matches."""
    rng = np.random.default_rng(6)
    for trial in range(60):
        words, runs = rng.integers(0, 3, 60), rng.integers(0, 3, 25)
        hashes = np.sort(runs)
        places = np.argsort(runs, kind="stable")
        of = rng.integers(0, 2, 25)
        of = of[places]
        found = []
        for at_once in (1, 7, 1 << 20):
            monkeypatch.setattr(tiling, "SEEDS_AT_ONCE", at_once)
            found.append([x.tolist() for x in tiling._met(hashes, words, of, places)])
        assert found[0] == found[1] == found[2]
        assert sum(found[0][3]) == sum((runs == w).sum() for w in words)


def test_tiles_against_all_places():
    rng = random.Random(5)
    for _ in range(200):
        least, letters = rng.choice([1, 2, 3]), rng.choice(["ab", "abcd"])
        item, doc = (rng.choices(letters, k=rng.randrange(least, 14)) for _ in range(2))
        seeds = [(i, j) for i in range(len(item) - least + 1) for j in range(len(doc) - least + 1)
                 if item[i:i + least] == doc[j:j + least]]
        if seeds:
            assert tiling.tiles(*np.array(seeds).T, least) == _tiles(item, doc, least)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def test_contaminated_documents(spark, docs_of):
    w = ITEM.split()
    rows = [(1, f"before {ITEM.upper()}! after", "s"), (2, " ".join(w[8:] + ["noise"] * 4 + w[:8]), "s"),
            (3, " ".join(w[:8]), "s"), (4, " ".join(w[::-1]), "s"), (5, None, "s"), (6, "", "s"), (7, "hi there", "s"),
            (8, "say hi, there now", "s"), (9, ("filler " * 50 + ITEM + "\n") * 300, "s"), (9, "clean", "s")]
    items = spark.createDataFrame([(70, ITEM, 1), (71, "Hi there", 2), (72, None, 3), (73, "", 4), (None, "clean", 5)],
                                  "item_id long, text string, doc_id int")
    for most in (1 << 20, 0):
        got = tiling.contaminated(docs_of(rows), items, most_broadcast=most).collect()
        assert sorted(((r.doc_id, r.item_id, r.tiles) for r in got), key=str) == sorted(
            [(1, 70, 1), (2, 70, 2), (7, 71, 1), (8, 71, 1), (9, 70, 1), (9, None, 1)], key=str)
        assert all(r.coverage == 1 for r in got)
    left = tiling.without_contaminated(docs_of(rows), items)
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([3, 4, 5, 6, None], key=str)
    assert left.columns == docs_of(rows).columns


def test_op6_empty_tables(spark, docs_of, written):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    for docs, items in ((docs_of([]), one), (docs_of([(1, ITEM, "s")]), none)):
        assert op6_string_tiling(spark, written(documents=docs, benchmark=items)).count() == 0


def test_segments_that_repeat_inside_are_marked():
    rng = random.Random(9)
    marked = 0
    for _ in range(400):
        unit = bytes(rng.choices(b"abcdefgh", k=rng.randrange(1, 30)))
        data = bytes(rng.choices(b"abcdefgh", k=rng.randrange(30))) + unit * rng.randrange(1, 12) + unit[:3]
        data += bytes(rng.choices(b"abcdefgh", k=rng.randrange(60)))
        for s, r, _, several in zip(*suffixes.segments(data, 24, 8)):
            windows = [data[w:w + 24] for w in range(s, s + r)]
            assert several or len(set(windows)) == len(windows)
            marked += several
    assert marked
