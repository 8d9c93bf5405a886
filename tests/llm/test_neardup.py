import random

import pytest

from kestrel.llm import neardup
from kestrel.llm.components import components
from kestrel.llm.queries import op3_minhash_postings


def _set(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def _components(rows, words, num, den):
    sets = [_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    out = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            out[find(i)] = min(doc, out.get(find(i), doc))
    return [(doc, len(sets[i]), out.get(find(i)), doc == out.get(find(i))) for i, (doc, _) in enumerate(rows)]


def _corpus(rng, families=12, copies=14):
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows, at = [], 0
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.choice([2, 4, 9, 40, 150])) + (passage if rng.random() < .4 else [])
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((at, rng.choice([" ", "\n", "\x0b "]).join(w).swapcase() if at % 3 else " ".join(w)))
            at += 1
    rng.shuffle(rows)
    return rows


def test_op3_against_all_pairs(spark, docs_of, written):
    rows = _corpus(random.Random(4)) + [(900, ""), (901, None), (902, " \t\n"), (903, "one"), (904, "ONE"),
                                        (905, "éa B c"), (906, "éa b C"), (907, "ÉA b c"), (908, "x y z " * 9000),
                                        (909, "x y z " * 9000)]
    expected = _components([*rows, (None, None)], 3, 85, 100)
    expected[-1] = (None, 0, None, True)
    got = op3_minhash_postings(spark, written(documents=docs_of([(i, t, "s") for i, t in rows]))).collect()
    key = lambda r: (r[0] is None, r[0])
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert op3_minhash_postings(spark, written(documents=docs_of([]))).count() == 0


def test_blocks_of_a_group_lose_no_link(spark, docs_of, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 400)
    rows = _corpus(random.Random(8), families=4, copies=40)
    got = neardup.near_duplicates(docs_of([(i, t, "s") for i, t in rows], extra=False), 5, 4, 5)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()) == sorted(_components(rows, 5, 4, 5))


def test_one_of_each_keeps_rows_and_columns(spark, docs_of):
    rows = [(1, "a b c d e f g h", "s"), (2, "a b c d e f g h", "t"), (1, "a b c d e f g h", "s"), (3, "p q", "s"),
            (None, "u v w", "s"), (5, "", "s")]
    docs = docs_of(rows)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "a b c d e f g h"), (3, "p q"), (None, "u v w"), (5, ""), (None, None)], key=str)


def test_least_collisions_misses_little():
    for s in (0.8, 0.85):
        least = neardup.least_collisions(s)
        assert 0.4 * neardup.COORDINATES < least < s * neardup.COORDINATES


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(40)],
                                   [(0, k) for k in range(1, 30)] + [(100, 101), (101, 100), (100, 102)]])
def test_components(spark, tmp_path, links):
    got = components(spark.createDataFrame(links, "a long, b long"), str(tmp_path)).collect()
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert {r.node: r.root for r in got} == {n: 0 if n < 100 and len(links) != 1 else 100 for n in nodes}
    assert len(got) == len(nodes)
