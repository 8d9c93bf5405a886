import zlib

import duckdb
import numpy as np

from kestrel.llm import neighbours, quality
from kestrel.llm.queries import op5_block_neighbours, op9_quality_scores

SF001 = "/root/testdata/sf0.01"


def _nearest(rows, k=5, every=50):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % every:
            continue
        near = sorted((-(q * v).sum() / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum())), j) for j, v in ok if j != i and len(v) == len(q))
        for rank, (s, j) in enumerate(near[:k], 1):
            out[i, rank] = (j, -s)
    return out


def _check(got, expected):
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}
    assert got.keys() == expected.keys()
    for key, (j, s) in expected.items():
        assert abs(got[key][1] - s) < 1e-12
        assert got[key][0] == j, (key, got[key], j, s)


def test_op5_against_all_pairs(spark, written):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 24))
    rows = [(k, [float(x) for x in (centre[k % 6] + rng.normal(size=24) * 0.2).astype(np.float32)]) for k in range(260)]
    rows += [(k, rows[3][1]) for k in range(300, 400)]                       # a hundred copies of one vector
    rows += [(500, None), (550, []), (600, [0.0] * 24), (650, [float("nan")] + [1.0] * 23), (700, [None] + [1.0] * 23),
             (750, [float("inf")] + [1.0] * 23), (None, [1.0] * 24), (800, [1.0, 2.0]), (801, [2.0, 1.0]), (850, [1.0, 2.0, 3.0]),
             (900, [1e-30] * 24), (901, [1e30] * 24), (-50, [-1.0] * 24)]
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    stored = [(r.vec_id, r.embedding) for r in frame.collect()]
    folder = written(embeddings=frame)
    _check(op5_block_neighbours(spark, folder).collect(), _nearest(stored))
    vectors = neighbours.vectors(frame)
    small = neighbours.nearest(vectors.where("vec_id % 50 = 0"), vectors, 3, query_block=5, block=16)
    _check(small.collect(), _nearest(stored, 3))
    assert op5_block_neighbours(spark, written(embeddings=frame.limit(0))).count() == 0


def test_op5_components_of_any_finite_size(spark, written):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1.0, 2.0]), (3, [-1.7e308, 1.7e308]), (4, [1e-300, 3e-300]),
            (5, [5e-324, 0.0]), (50, [1.7e308, 1.7e308]), (100, [5e-324, 5e-324])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in op5_block_neighbours(spark, written(embeddings=frame)).collect()}
    # the cosines by hand: vectors scaled to a largest component of one
    unit = {i: np.array(v) / max(map(abs, v)) for i, v in rows}
    cosine = lambda a, b: float(a @ b / np.sqrt((a @ a) * (b @ b)))
    for q in (0, 50, 100):
        want = sorted((-round(cosine(unit[q], unit[i]), 9), i) for i in unit if i != q)[:5]
        assert [round(got[q, k][1], 9) for k in range(1, 6)] == [-s for s, _ in want]
        assert all(round(cosine(unit[q], unit[i]), 9) == round(s, 9) for i, s in (got[q, k] for k in range(1, 6)))


def test_op9_on_held_out_documents(spark):
    rows = op9_quality_scores(spark, SF001).collect()
    docs = duckdb.sql(f"select doc_id from '{SF001}/documents.parquet'").fetchall()
    label = dict(duckdb.sql(f"select doc_id, quality from '{SF001}/labels.parquet'").fetchall())
    assert sorted(r.doc_id for r in rows) == sorted(d for d, in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([p == y for p, y in held]) > 0.95
    again = op9_quality_scores(spark, SF001).collect()
    assert all(abs(a.score - b.score) < 1e-6 for a, b in zip(sorted(rows), sorted(again)))


def test_op9_odd_tables(spark, docs_of, written):
    rows = [(k, "good words here " * 9 if k % 2 else "bad*** &&& %%% " * 9, "s") for k in range(60)] + [(99, "", "s"), (1, "again", "s")]
    labels = spark.createDataFrame([(k, k % 2, 0, "x") for k in range(60)] + [(None, 1, 0, "x"), (3, None, 0, "x"), (3, 1, 0, "x"), (777, 1, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = op9_quality_scores(spark, written(documents=docs_of(rows), labels=labels)).collect()
    assert len(got) == len(rows) + 1
    seen = {r.doc_id: r.predicted for r in got if r.doc_id not in (None, 1, 99)}
    assert all(seen[k] == k % 2 for k in seen)
    for quality_label, score in ((None, 0.5), (1, 49 / 50)):
        few = labels.where("doc_id < 60").selectExpr("doc_id", f"cast({quality_label or 'null'} as int) quality", "toxic")
        got = op9_quality_scores(spark, written(documents=docs_of(rows), labels=few)).collect()
        assert all((r.score > 0.9) if quality_label else r.score == score for r in got)
    assert op9_quality_scores(spark, written(documents=docs_of([]), labels=labels)).count() == 0


def test_network_is_calibrated():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 4))
    y = (rng.random(6000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    score = quality.Network(x, y).score(x)
    for low in (0.1, 0.3, 0.5, 0.7):
        here = (score >= low) & (score < low + 0.2)
        assert abs(score[here].mean() - y[here].mean()) < 0.07
