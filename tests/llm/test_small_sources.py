from collections import Counter

from kestrel.llm import mixing


def test_sources_below_a_block_reach_their_targets(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BLOCKS", 20)     # blocks of 1024 words, as of large corpora
    sizes = {f"site{k:03d}": 7 * k + 5 for k in range(90)} | {"large": 300, "larger": 900}
    rows, docs_per = [], {"large": 60, "larger": 40}
    for source, n in sizes.items():
        rows += [(len(rows) + i, " ".join(["w"] * n), source) for i in range(docs_per.get(source, 1))]
    out = mixing.mixed(docs_of(rows, extra=False)).collect()
    target, size, taken = {}, {}, Counter()
    for r in out:
        target[r.source], size[r.source] = r.target, r.source_size
        taken[r.source] += r.taken
    total = sum(size.values())
    assert total // 20 > mixing.BLOCK_WORDS and sum(taken.values()) == total
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 2 and taken[source] <= 3 * size[source]
