"""Files of differing schemas, and keys in buckets."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articleloom.sources import mixed
from articleloom.sources.keys import KeySet, keep_unknown


@pytest.mark.parametrize("left, right, wanted", [
    (T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), T.FloatType(), T.DoubleType()), (T.ByteType(), T.ShortType(), T.ShortType()),
    (T.FloatType(), T.DoubleType(), T.DoubleType()), (T.IntegerType(), T.FloatType(), T.DoubleType()), (T.LongType(), T.StringType(), T.StringType()),
    (T.BooleanType(), T.LongType(), T.StringType()), (T.DateType(), T.DateType(), T.DateType()), (T.ArrayType(T.LongType()), T.LongType(), T.StringType()),
    (T.NullType(), T.LongType(), T.LongType()),
])
def test_wider_types(left, right, wanted):
    assert mixed.wider(left, right) == wanted == mixed.wider(right, left)


def test_files_of_differing_schemas(spark, tmp_path):
    path = str(tmp_path / "tree")
    frames = {
        "a": "SELECT 1 AS id, 'x' AS text, CAST(2 AS FLOAT) AS size, 7 AS `odd name`",
        "a2": "SELECT 'y' AS text, 2 AS id, CAST(NULL AS FLOAT) AS size, 8 AS `odd name`",
        "deep/b": "SELECT 3000000000 AS id, 4 AS size, true AS flag",
        "deep/er/c": "SELECT CAST(NULL AS LONG) AS id, array(1, 2) AS text, named_struct('k', 1) AS flag",
    }
    for name, sql in frames.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{path}/{name}")
    (tmp_path / "tree" / "broken.parquet").write_bytes(b"no Parquet file")
    (tmp_path / "tree" / "notes.txt").write_text("not read")
    tree = mixed.read_mixed_tree(spark, path)
    assert dict(tree.rows.dtypes) == {"id": "bigint", "odd name": "int", "size": "double", "text": "string", "flag": "string"}
    rows = {(row["id"], row["text"], row["size"], row["odd name"], row["flag"]) for row in tree.rows.collect()}
    assert rows == {(1, "x", 2.0, 7, None), (2, "y", None, 8, None), (3000000000, None, 4.0, None, "true"), (None, "[1,2]", None, None, '{"k":1}')}
    unread = tree.unread.collect()
    assert [row["path"].rsplit("/", 1)[1] for row in unread] == ["broken.parquet"] and unread[0]["problem"]
    widened = {(row["column"], row["found"], row["common"], row["files"]) for row in tree.widened.collect()}
    assert widened == {("id", "int", "bigint", 2), ("size", "float", "double", 2), ("size", "int", "double", 1),
                       ("text", "array<int>", "string", 1), ("flag", "boolean", "string", 1), ("flag", "struct<k:int>", "string", 1)}


def test_columns_are_pruned_and_filters_pushed_in_every_group(spark, tmp_path):
    path = str(tmp_path / "tree")
    spark.sql("SELECT 1 AS id, 'x' AS text, 1 AS size").write.parquet(f"{path}/a")
    spark.sql("SELECT 2 AS id, 'y' AS text, 2L AS size").write.parquet(f"{path}/b")
    plan = plan_of(mixed.read_mixed_tree(spark, path).rows.filter("id > 1").select("id", "size"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("GreaterThan(id,1)" in line and "text" not in line for line in scans)


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "broken.parquet").write_bytes(b"no")
    with pytest.raises(ValueError, match="could be read"):
        mixed.read_mixed_tree(spark, str(tmp_path))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "pmid string, ref_id string")


def test_first_run_of_a_key_wins(spark, tmp_path):
    path = str(tmp_path / "it's here")
    known = KeySet.open(spark, path, buckets=4)
    first = keep_unknown(rows(spark, ("1", "b"), ("1", "a"), ("2", "c")), known, [F.col("ref_id")])
    known.add(first)
    # Another session: the table is declared again, and the number of buckets is the one of the set.
    spark.sql(f"DROP TABLE {known.table}")
    known = KeySet.open(spark, path, buckets=99)
    assert known.buckets == 4 and known.keys().count() == 2
    second = keep_unknown(rows(spark, ("1", "0"), ("3", "z"), ("3", "y"), (None, "n")), known, [F.col("ref_id")])
    assert sorted(map(tuple, second.collect()), key=str) == [("3", "y"), (None, "n")]
    known.add(second.filter("pmid IS NOT NULL"))
    assert known.unknown(rows(spark, ("1", "a"), ("2", "a"), ("3", "a"))).count() == 0
    assert known.keys().count() == 3


def test_the_set_is_not_shuffled(spark, tmp_path):
    known = KeySet.open(spark, str(tmp_path / "keys"), buckets=4)
    known.add(spark.range(1000).select(F.col("id").cast("string").alias("pmid")))
    spark.range(500, 1500).select(F.col("id").cast("string").alias("pmid"), F.lit("r").alias("ref_id")).write.parquet(str(tmp_path / "new"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keep_unknown(spark.read.parquet(str(tmp_path / "new")), known, [F.col("ref_id")])
        assert found.count() == 500
        plan = plan_of(found)
        assert plan.count("Exchange") == 1  # of the new rows, for the join and the ranking both
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "Bucketed: true" in line)
        assert "keys" in scan and "4 out of 4" in scan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
