"""Tables in and out. Spark's own readers do the work; CSV has no arrays, so they are written as JSON text."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: StructType | str | None = None, **options) -> DataFrame:
    """A table of parquet, csv (with a header, all columns as text unless a schema is given), json, orc or text."""
    reader = spark.read.format(kind).options(**({"header": True} if kind == "csv" else {}) | options)
    return (reader.schema(schema) if schema else reader).load(path)


def flat(df: DataFrame) -> DataFrame:
    """df with arrays, maps and structs as JSON text."""
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, ArrayType | MapType | StructType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def write(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists", partition_by: tuple[str, ...] = (), **options) -> None:
    out = flat(df) if kind == "csv" else df
    writer = out.write.format(kind).mode(mode).options(**({"header": True} if kind == "csv" else {}) | options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def verify_files(spark: SparkSession, folder: str, expected: dict[str, tuple[int, str]]) -> DataFrame:
    """name, found, same_size, same_hash of model files against expected sizes and SHA-256 sums, hashed where the files are read."""
    want = spark.createDataFrame([(n, s, h.lower()) for n, (s, h) in expected.items()], "name string, size long, hash string")
    have = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    have = have.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("length"), F.sha2("content", 256).alias("sha"))
    out = want.join(F.broadcast(have), "name", "left")
    return out.select("name", F.col("sha").isNotNull().alias("found"), F.coalesce(F.col("length") == F.col("size"), F.lit(False)).alias("same_size"), F.coalesce(F.col("sha") == F.col("hash"), F.lit(False)).alias("same_hash"))


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """folder (its last name), name, size and sha256 of the files below a path whose names fit the pattern, hashed where they are read; a file must fit in a task's memory, and Spark leaves empty files out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    parts = F.split("path", "/")
    return found.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


LEAST_WEIGHTS = 1_000_000


def check_model_folder(folder: str) -> Path:
    """The folder, if it holds a config and weights that are more than a pointer to weights."""
    path = Path(folder)
    if not (path / "config.json").is_file():
        raise FileNotFoundError(f"{path} has no config.json")
    weights = path / "model.safetensors"
    if not weights.is_file() or weights.stat().st_size < LEAST_WEIGHTS:
        raise RuntimeError(f"{weights} is missing or only a pointer to weights")
    return path


def file_hash(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
