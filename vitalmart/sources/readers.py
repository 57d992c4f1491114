"""Table scans. Jobs declare schemas; inference is there for exploration."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with a declared schema (bad values become NULL) or, without one, inferred types."""
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("mode", "PERMISSIVE").csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Format by suffix; anything but .csv and .parquet is an error."""
    clean = path.rstrip("/")
    if clean.endswith(".csv"):
        return read_csv(spark, path, schema)
    if clean.endswith(".parquet"):
        return read_parquet(spark, path)
    raise ValueError(f"unsupported file format: {path}")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None,
              partitions: int = 16, **options: str) -> DataFrame:
    """Warehouse read; with key and bounds it is split into ranges read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    return reader.load()


def sequence(spark: SparkSession, first: int, last: int, name: str = "id") -> DataFrame:
    """first..last, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small fixed rows (reference lists, fixtures)."""
    return spark.createDataFrame(rows, schema)


def route_files(paths: list[str], routes: dict[str, str]) -> dict[str, list[str]]:
    """File paths per target table, by the first matching name pattern."""
    out: dict[str, list[str]] = {}
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1].lower()
        for pattern, table in routes.items():
            if fnmatch(name, pattern):
                out.setdefault(table, []).append(path)
                break
    return out


def read_routed(spark: SparkSession, paths: list[str], routes: dict[str, str], schemas: dict[str, T.StructType],
                names: dict[str, dict[str, str]]) -> dict[str, DataFrame]:
    """One DataFrame per target table over all its files, renamed and with the file name."""
    out = {}
    for table, files in route_files(paths, routes).items():
        df = spark.read.option("header", True).schema(schemas[table]).csv(files)
        file_name = F.element_at(F.split(F.input_file_name(), "/"), -1)
        out[table] = df.withColumn("file_name", file_name).withColumnsRenamed(names.get(table, {}))
    return out
