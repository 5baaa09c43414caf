import pytest
from pyspark import cloudpickle

import articleloom

cloudpickle.register_pickle_by_value(articleloom)

DOCUMENTS = "doc_id long, text string"

# Null ids and texts, texts without words, one very long word, repeated rows, ties and odd white space.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (None, "a null id"), (None, None), (4, "same row"), (4, "same row"), (4, "same id"),
    (5, "x" * 50_000), (6, "one"), (7, "é ü \U0001f600 日本"), (8, "line\nline\n\nline\r\nend"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Documents with every odd case, an extra column of each name that results have, and a null column."""
    frame = spark.createDataFrame(EDGES, DOCUMENTS)
    extra = ["shard", "slot", "score", "n_tokens", "spans", "kept", "rank", "mix_copy", "sequence_id", "component_id", "text_hash", "line", "source"]
    for name in extra:
        frame = frame.selectExpr("*", f"'other' AS {name}")
    return frame.selectExpr("*", "CAST(NULL AS string) AS lang")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS + ", source string")
