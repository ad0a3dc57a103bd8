import pytest


@pytest.fixture
def table(spark):
    """documents as a frame: (doc_id, text) rows, with extra columns of clashing names."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, 7, "k", None) for i, t in rows],
                                     "doc_id long, text string, hits string, size int, id string, bucket int")
    return make


@pytest.fixture
def corpus(spark, tmp_path):
    """A small folder of tables; returns (folder, rows)."""
    def make(rows, **tables):
        spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                              "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
        for name, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
