"""Each stage of the pipeline against a brute-force version on its own input."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from kestrel.llm import quality
from kestrel.llm.common import read, stored, work_dir
from kestrel.llm.queries import tokenizer_path
from tests.llm.test_mixing import WORDS, _targets
from tests.llm.test_neardup import _components
from tests.llm.test_suffixes_tiling import _tiles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage and the last output."""
    path, out = work_dir(spark, "test-pipeline"), [read(spark, SF, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(stored(stage(spark, out[-1], SF), f"{path}/{k}"))
    return out


def _rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages_are_the_dealt_ones(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights", "token-ID / binary output"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage_drops_what_it_rejects(spark, stages):
    scored = quality.scored(stages[0], read(spark, SF, "labels")).collect()
    assert Counter(_rows(stages[1])) == Counter((r.doc_id, r.text, r.source) for r in scored if r.score >= 0.3)
    label = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    good = [d for d, q in label.items() if q == 1]
    assert np.mean([d in kept for d in good]) > 0.97


def test_one_document_of_each_group_stays(stages):
    rows = _rows(stages[1])
    marked = _components([(i, t) for i, t, _ in rows], 5, 4, 5)
    want = Counter(row for row, (_, n, _, kept) in zip(rows, marked) if kept or n == 0)
    assert Counter(_rows(stages[2])) == want and len(want) < len(rows)


def test_contaminated_documents_go(stages):
    import re
    items = [re.findall(r"\w+", t.lower()) for t, in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    starts = defaultdict(set)
    for k, item in enumerate(items):
        for i in range(len(item) - 4):
            starts[tuple(item[i:i + 5])].add(k)

    def clean(text):
        words = re.findall(r"\w+", text.lower())
        near = {k for j in range(len(words) - 4) for k in starts.get(tuple(words[j:j + 5]), ())}
        return all(sum(n for *_, n in _tiles(items[k], words, 5)) < 0.8 * len(items[k]) for k in near)

    rows = _rows(stages[2])
    assert Counter(_rows(stages[3])) == Counter(r for r in rows if clean(r[1]))
    assert stages[3].count() < len(rows)


def test_mix_follows_the_targets(stages):
    text = {i: (t, s) for i, t, s in _rows(stages[3])}
    size, took, each = defaultdict(int), defaultdict(int), Counter()
    for t, s in text.values():
        size[s] += len(WORDS.findall(t))
    for i, t, s in _rows(stages[4]):
        assert text[i][0].startswith(t) and text[i][1] == s
        took[s] += len(WORDS.findall(t))
        each[i] += len(WORDS.findall(t))
    target = _targets(size)
    assert all(abs(took[s] - target[s]) <= 3 * (1 + sum(size.values()) // 10_000) * len(size) for s in size)
    assert all(n <= 3 * len(WORDS.findall(text[i][0])) for i, n in each.items())


def test_tokens_of_the_mix(spark, stages):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t, _ in _rows(stages[4]):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want[i, len(ids), zlib.crc32(ids)] += 1
    got = stages[5].orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, stages[5].collect()))


def test_run_on_odd_documents(spark, docs_of, written):
    docs = docs_of([(1, "", "s"), (2, None, None), (3, "word " * 40, "s"), (3, "word " * 40, "s"), (4, "x " * 20_000, "t")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, None), (None, "")], "item_id long, text string")
    got = corpus_pipeline.run(spark, written(documents=docs, labels=labels, benchmark=items)).collect()
    assert {r.doc_id for r in got} <= {3, 4} and got
    empty = written(documents=docs.limit(0), labels=labels, benchmark=items)
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages_keep_columns_of_any_name(spark, docs_of, written):
    """Names that the stages use themselves, and a null in every column."""
    from pyspark.sql import functions as F

    names = ["score", "Predicted", "__id", "__hash", "__text", "__source", "__rounds", "__rests", "__words", "score_", "y", "place"]
    rows = [(k, " ".join(f"w{(k * 7 + i) % 50}" for i in range(40)), "s" if k % 3 else None) for k in range(40)]
    docs = docs_of(rows).drop("score", "kept", "size")
    docs = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    folder = written(labels=spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int"),
                     benchmark=spark.createDataFrame([(1, rows[0][1])], "item_id long, text string"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert all(r[n] in (f"own {n}", None) for r in out.collect() for n in names), name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
