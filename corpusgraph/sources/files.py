"""File formats: CSV in and out, JSON items, and table exports."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPORT_FORMATS = ("parquet", "csv", "json", "ndjson")

_EMPTY = "\x01"
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


@dataclass(frozen=True)
class FileStats:
    """What a sink wrote."""

    path: str
    rows: int
    size_bytes: int


def _file_system(spark: SparkSession, path: str):
    """The file system a path belongs to, and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    system, target = _file_system(spark, path)
    return int(system.getContentSummary(target).getLength())


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder was committed."""
    system, mark = _file_system(spark, f"{path}/_SUCCESS")
    return system.exists(mark)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    found = system.listStatus(target)
    return [f.getPath().toString() for f in found if f.isDirectory()]


def delete_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and quoted line breaks, read in one pass by a known schema.

    A bare empty field is NULL and a quoted one an empty text. The reader takes both
    for NULL unless empty texts get a mark of their own.
    """
    reader = spark.read.schema(schema).options(**_CSV).option("emptyValue", _EMPTY)
    raw = reader.option("multiLine", "true").option("enforceSchema", "false").csv(path)
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    return raw.replace(_EMPTY, "", subset=texts) if texts else raw


def read_items(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON, one object per line; absent fields become NULL."""
    return spark.read.schema(schema).json(path)


def _json_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frame the JSON rows of one partition as one array."""
    previous = "["
    separator = ""
    for batch in batches:
        lines = []
        for value in batch.column(0).to_pylist():
            lines.append(previous)
            previous = separator + value
            separator = ","
        yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
    yield pa.RecordBatch.from_pydict({"value": pa.array([previous, "]"], pa.string())})


def export(df: DataFrame, path: str, fmt: str) -> FileStats:
    """Write a frame as parquet, csv, json (one array per file) or ndjson."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown format {fmt!r}; use one of {EXPORT_FORMATS}")
    if fmt == "json":
        fields = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        seen = Observation()
        counted = df.select(fields.alias("value")).observe(
            seen, F.count(F.lit(1)).alias("rows")
        )
        counted.mapInArrow(_json_arrays, "value string").write.text(path)
    else:
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        if fmt == "parquet":
            writer.parquet(path)
        elif fmt == "csv":
            writer.options(**_CSV).csv(path)
        else:
            writer.option("ignoreNullFields", "false").json(path)
    size = folder_size(df.sparkSession, path)
    return FileStats(path, int(seen.get["rows"]), size)
