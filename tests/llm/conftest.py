import pytest


@pytest.fixture
def frame(spark, tmp_path):
    """Write rows as the table of a data folder and give the folder."""

    def make(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(frame):
    def make(texts, ids=None, **more):
        ids = ids or range(len(texts))
        return frame(documents=([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCS), **more)

    return make
