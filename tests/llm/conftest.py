import os

import pytest

import __spark_entry__


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    __spark_entry__._shipped(lambda s, d: None)(spark, "")


@pytest.fixture
def docs(spark):
    """A table of documents from (id, text) pairs, with extra columns of clashing names."""

    def make(rows):
        rows = [(i, t, "en", "s", -1, "x", 7, "y") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "keep_id string, _id int, _text string")

    return make


def path(name: str, sf: str = "sf0.001") -> str:
    return os.path.join("/root/testdata", sf, name + ".parquet")
