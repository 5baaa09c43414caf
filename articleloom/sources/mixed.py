"""A tree of Parquet files of differing schemas as one table.

The footers of all files are read by tasks. Files are grouped by their schema, each group is read as it is, and its columns are cast
to types that hold those of every group. What cannot be read, and what is widened, is reported; no file is left out for its type.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from articleloom.sources.tables import union_sources

# From narrow to wide; a type holds all before it.
NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
WHOLE = 4  # of them: a whole number and a float need a double
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type that holds both: the same, the wider number, double for whole numbers beside fractions, else text."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if left in NUMBERS and right in NUMBERS:
        low, high = sorted((NUMBERS.index(left), NUMBERS.index(right)))
        return T.DoubleType() if low < WHOLE <= high else NUMBERS[high]
    return T.StringType()


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """A column of each name in order of first occurrence, of the narrowest type that holds all its types."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            found[field.name] = wider(found[field.name], field.dataType) if field.name in found else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def _as(field: T.StructField, kind: T.DataType) -> Column:
    column = F.col(f"`{field.name}`")
    if field.dataType == kind:
        return column
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column).alias(field.name)
    return column.cast(kind).alias(field.name)


def read_footer(path: str) -> str:
    """The schema in a file's footer as JSON: the one Spark wrote, else that of its Arrow types."""
    files, local = FileSystem.from_uri(path)
    with files.open_input_file(local) as file:
        arrow = pq.ParquetFile(file).schema_arrow
    written = (arrow.metadata or {}).get(SPARK_SCHEMA)
    schema = T.StructType.fromJson(json.loads(written)) if written else from_arrow_schema(arrow, prefer_timestamp_ntz=False)
    # Neither the order of columns nor whether they may be null makes another group.
    fields = sorted((T.StructField(field.name, field.dataType) for field in schema), key=lambda field: field.name)
    return T.StructType(fields).json()


def footers(spark: SparkSession, path: str) -> DataFrame:
    """``path, schema, problem`` of each ``*.parquet`` file below a folder; a footer that cannot be read is a problem."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        .select(F.col("path"), F.col("length")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schemas, problems = [], []
            for name in batch["path"].to_pylist():
                try:
                    schemas.append(read_footer(name))
                    problems.append(None)
                except Exception as error:  # whatever is wrong with one file is reported and must not end the run
                    schemas.append(None)
                    problems.append(f"{type(error).__name__}: {error}"[:500])
            yield pa.RecordBatch.from_arrays(
                [batch["path"], pa.array(schemas, pa.string()), pa.array(problems, pa.string())], ["path", "schema", "problem"])

    return listed.select("path").mapInArrow(read, "path string, schema string, problem string")


@dataclass
class MixedTree:
    """``rows`` of all readable files; ``unread``: path and problem of the others; ``widened``: column, its type in some files, the common type, files."""

    rows: DataFrame
    unread: DataFrame
    widened: DataFrame


def read_mixed_tree(spark: SparkSession, path: str) -> MixedTree:
    """Every ``*.parquet`` file anywhere below ``path``, whatever the files' schemas.

    A column that a file lacks is null in its rows. Types are widened as by ``wider``; nested values beside others become JSON
    text. Names are told apart by case only if the session does so. Directory names are not read as columns. If no file can be read
    it is an error. The driver holds the list of files, as a reader of Spark does, and a schema for each group of them.
    """
    found = footers(spark, path).collect()
    groups: dict[str, list[str]] = defaultdict(list)
    for row in found:
        if row["problem"] is None:
            groups[row["schema"]].append(row["path"])
    if not groups:
        raise ValueError(f"no file below {path} could be read")
    # The order of columns is that of the largest group, whichever way the files were listed.
    ordered = sorted(groups, key=lambda schema: (-len(groups[schema]), schema))
    schemas = {schema: T.StructType.fromJson(json.loads(schema)) for schema in ordered}
    common = common_schema(list(schemas.values()))
    parts, widened = [], defaultdict(int)
    for schema, fields in schemas.items():
        rows = spark.read.schema(fields).parquet(*sorted(groups[schema]))
        parts.append(rows.select(*(_as(field, common[field.name].dataType) for field in fields)))
        for field in fields:
            if field.dataType != common[field.name].dataType:
                widened[field.name, field.dataType.simpleString(), common[field.name].dataType.simpleString()] += len(groups[schema])
    unread = [(row["path"], row["problem"]) for row in found if row["problem"] is not None]
    return MixedTree(
        union_sources(parts).select(*(f"`{name}`" for name in common.names)),
        spark.createDataFrame(unread, "path string, problem string"),
        spark.createDataFrame([(*key, files) for key, files in sorted(widened.items())], "column string, found string, common string, files int"))
