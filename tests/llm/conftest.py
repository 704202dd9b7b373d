import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from aerotrace.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="aerotrace-llm-tests",
                  extra={"spark.driver.memory": "4g"})
    yield s


ODD_TEXTS = [None, "", "   \n\t ", "word", "a b", "été   wide", "x" * 5000,
             " ".join(f"w{i}" for i in range(6000)), "emoji \U0001f600 text", "tie tie tie tie tie tie tie tie"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s1" if i % 2 else None, None, i, "clash") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a text without an id " * 12, None, None, None, None, None)]
    rows += [(100 + i, "the same text of a repeated group of documents here", None, "s2", 3, 1, "k") for i in range(4)]
    rows += [rows[-1]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, bucket string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
