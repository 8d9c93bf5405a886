import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from kestrel.llm import suffixes


def test_shards_hold_whole_hashes_and_are_bounded():
    rng = random.Random(1)
    rows = pd.DataFrame({"hash": sorted(rng.randrange(60) for _ in range(500)),
                         "data": [b"x" * rng.randrange(40) for _ in range(500)]})
    parts = [rows.iloc[a:a + 37] for a in range(0, 500, 37)]
    got = list(suffixes.shards(iter(parts), 900))
    assert pd.concat(got).reset_index(drop=True).equals(rows)
    assert all(not set(a["hash"]) & set(b["hash"]) for a, b in zip(got, got[1:]))
    assert len(got) > 5 and all(g["data"].str.len().sum() + len(g) <= 900 for g in got)
    assert not list(suffixes.shards(iter([rows.iloc[:0]]), 900))


@pytest.mark.parametrize("most", [1, 3000])
def test_split_hashes_against_counting(spark, tmp_path, most):
    """A phrase in many contexts, with every hash split and with only the large ones."""
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    phrase, shared = prose(120), prose(700)
    texts = [prose(150) + phrase + prose(150) for _ in range(30)] + ["tick tock " * 300, "", None]
    texts += [prose(50) + shared[k * 20:k * 20 + 320] + prose(90) for k in range(12)] + [shared, shared]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = str(tmp_path)
    got = {r.doc_id: bytes(r.kept) for r in suffixes.without_repeats(docs, path=path, most=most).collect()}
    hot = [r.hot for r in spark.read.parquet(f"{path}/contested").collect()]
    assert any(hot) and (most == 1) == all(hot)
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    for k, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i:i + 200]] > 1:
                gone[i:i + 200] = True
        assert got[k] == np.frombuffer(d, np.uint8)[~gone].tobytes()
