import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text, lang, source) to a documents table."""

    def make(*rows):
        padded = [(*r, *(None, None, None)[: 4 - len(r)]) for r in rows]
        return spark.createDataFrame(padded, "doc_id long, text string, lang string, source string")

    return make


@pytest.fixture
def folder(tmp_path):
    """A frame written as a table of a data folder, for the registered queries."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
