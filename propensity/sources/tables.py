"""Scans of the input tables and the generic labelled-table reader (A1)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, NaN as NULL; Parquet gives column pruning and filter pushdown for free."""
    return normalise(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def normalise(df: DataFrame) -> DataFrame:
    """Load-time hygiene: dots in names become underscores (a dot means struct access in Spark) and
    floating NaN becomes NULL, so ``count``, ``avg`` and percentiles skip it like pandas does."""
    renamed = df.toDF(*[c.replace(".", "_") for c in df.columns])
    fixes = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in renamed.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return renamed.withColumns(fixes) if fixes else renamed


def read_labelled_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV with an id column (A1). Pass a schema in production; inference is for exploration."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return normalise(reader.csv(path))
