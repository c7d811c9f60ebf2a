"""Typed readers and sinks for cards, transaction logs and scores."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom import schemas
from cardloom.operators.calendar import parse_dates
from cardloom.sources.staging import stage_read, stage_write


HEADER = "__header"


def _csv_groups(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """``(files, column names)`` of the parts of a CSV folder, one entry per different
    header. The first lines are found by tasks, which read the files once for it."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        F.monotonically_increasing_id().alias("line"),
    )
    # A file's first line has the smallest number in its first block.
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "line").alias(HEADER))
    kinds = first.groupBy(HEADER).agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(r["files"], next(csv.reader([r[HEADER]]))) for r in kinds.orderBy(HEADER).collect()]


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, mixed: bool) -> DataFrame:
    """Columns go by the names in the header, whatever their order; others are not
    parsed. Text that is not of the column's type becomes NULL."""
    if mixed:
        groups = _csv_groups(spark, path)
    else:
        groups = [([path], spark.read.csv(path, header=True, inferSchema=False).columns)]
    parts = []
    for files, names in groups:
        if missing := [f.name for f in schema if f.name not in names]:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        # Not enforced: a file whose header has other names there is an error, not misread.
        df = spark.read.schema(text).csv(files, header=True, enforceSchema=False)
        parts.append(
            df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
        )
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _read(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str, mixed: bool = False
) -> DataFrame:
    if fmt == "csv":
        return _read_csv(spark, path, schema, mixed)
    if fmt == "parquet":
        # A part of the columns will do; one that is used and lacking is an error there.
        df = spark.read.parquet(path)
        present = [f for f in schema if f.name in df.columns]
        wrong = [
            f"{f.name} is {df.schema[f.name].dataType.simpleString()}, expected {f.dataType.simpleString()}"
            for f in present
            if not _fits(df.schema[f.name].dataType, f.dataType)
        ]
        if wrong or not present:
            raise ValueError(f"{path}: {'; '.join(wrong) or 'none of the columns'}")
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in present])
    raise ValueError(f"unknown format {fmt!r}")


def _fits(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of the found type is one of the wanted type. Months may
    be text or dates, times have a zone or not."""
    times = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(wanted, T.StringType):
        return isinstance(found, times)
    if isinstance(wanted, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(found, times[1:])
    if isinstance(wanted, whole):
        return isinstance(found, whole)
    if isinstance(wanted, (T.DoubleType, T.FloatType)):
        return isinstance(found, (*whole, T.FloatType, T.DoubleType, T.DecimalType))
    return found == wanted


def read_cards(
    spark: SparkSession, path: str, fmt: str = "csv", test: bool = False, mixed: bool = False
) -> DataFrame:
    """Cards with ``first_active_month`` as a date. Accepts yyyy-MM and yyyy-MM-dd.
    Test cards have no target in their file and get a null one.

    A CSV folder has one header in all its files; another one in some file is an error when
    that file is read. With ``mixed`` each file goes by its own header, at the price of
    reading the folder once more. Parquet columns of a type that does not fit are an error.
    """
    df = _read(spark, path, schemas.TEST_CARDS if test else schemas.CARDS, fmt, mixed)
    if test:
        df = df.withColumn("target", F.lit(None).cast("double"))
    if isinstance(df.schema["first_active_month"].dataType, T.StringType):
        df = parse_dates(df, "first_active_month", "date")
    return df


def read_transactions(
    spark: SparkSession, path: str, fmt: str = "csv", mixed: bool = False
) -> DataFrame:
    """A transaction log. NaN amounts become NULL so aggregates skip them. Files as in
    ``read_cards``."""
    df = _read(spark, path, schemas.TRANSACTIONS, fmt, mixed)
    for c in ("purchase_amount", "category_2"):
        df = df.withColumn(c, F.nanvl(F.col(c), F.lit(None).cast("double")))
    return df


def read_limited(df: DataFrame, n: int | None) -> DataFrame:
    """First n rows for a trial run; all rows when n is None."""
    return df if n is None else df.limit(n)


def read_columns_for_ids(df: DataFrame, columns: Sequence[str] = ("card_id",)) -> DataFrame:
    return df.select(*columns)


def by_merchant(df: DataFrame) -> DataFrame:
    """Rows clustered by merchant, so that a reader of a merchant range touches few files."""
    return df.repartitionByRange("merchant_id").sortWithinPartitions("merchant_id")


def merchant_store(df: DataFrame, path: str) -> str:
    """Keep a merchant profile for later joins."""
    return stage_write(by_merchant(df), path)


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    return stage_read(spark, path)


def write_scores_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    df.select("card_id", "target").write.mode(mode).csv(path, header=True)
    return path
