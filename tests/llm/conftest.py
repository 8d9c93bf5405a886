import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with a null in every column, extra and clashing columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, kept string"

    def make(rows, extra=True):
        full = [(i, t, "en", s, None if t is None else len(t), -1, 9.0, "x") for i, t, s in rows]
        if extra and rows:
            full.append((None, None, None, None, None, None, None, None))
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def written(tmp_path_factory):
    """Write frames as the tables of a data folder."""
    def write(**tables):
        folder = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)
    return write
