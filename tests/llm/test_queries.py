"""The queries that SQL can express, on the smallest tables, and the rows that the others must give."""

from pathlib import Path

import duckdb
import pytest

from articleloom.llm.oracles import ORACLES
from articleloom.llm.queries import QUERIES
from compare import SQL_TYPES, _rows

DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DIR.exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    oracle = duck.execute(ORACLES[name])
    columns = [column[0] for column in oracle.description]
    result = QUERIES[name](spark, str(DIR))
    assert {column[0]: str(column[1]) for column in oracle.description} == {
        column: SQL_TYPES.get(kind) for column, kind in result.dtypes}
    assert _rows(result.columns, [tuple(row) for row in result.collect()]) == _rows(columns, oracle.fetchall())


CONTRACTS = {
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op4_personal_data": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                          "base_sha256": "string", "spans": "string"},
    "op5_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                          "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op6_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op8_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                             "sequence_id": "bigint", "offset": "bigint"},
    "op9_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_of_the_contract(spark, name):
    result = QUERIES[name](spark, str(DIR))
    assert CONTRACTS[name].items() <= dict(result.dtypes).items()
    if "doc_id" in result.columns:
        documents = spark.read.parquet(f"{DIR}/documents.parquet")
        assert documents.join(result, "doc_id", "left_anti").count() == 0
