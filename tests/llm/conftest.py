import pytest

from ledgerlens.llm.common import tokenizer_path


@pytest.fixture
def docs(spark):
    """A documents frame from (doc_id, text) pairs, with an extra column whose
    name operators use themselves."""

    def make(rows, partitions=3):
        data = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, rid string")
        return df.repartition(partitions) if rows else df

    return make


@pytest.fixture(scope="session")
def byte_bpe():
    return tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def pieces():
    return tokenizer_path("piece_bpe_32k.model")
