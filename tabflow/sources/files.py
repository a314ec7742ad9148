"""File scans: CSV (fixed or inferred schema) and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The explicit bronze schema of the raw attrition CSV
# (21 fields; columns are matched by position, so this also renames them).
RAW_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("seniorCitizen", T.DoubleType()),
    T.StructField("partner", T.StringType()),
    T.StructField("dependents", T.StringType()),
    T.StructField("tenure", T.DoubleType()),
    T.StructField("phoneService", T.StringType()),
    T.StructField("multipleLines", T.StringType()),
    T.StructField("internetService", T.StringType()),
    T.StructField("onlineSecurity", T.StringType()),
    T.StructField("onlineBackup", T.StringType()),
    T.StructField("deviceProtection", T.StringType()),
    T.StructField("techSupport", T.StringType()),
    T.StructField("streamingTV", T.StringType()),
    T.StructField("streamingMovies", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("paperlessBilling", T.StringType()),
    T.StructField("paymentMethod", T.StringType()),
    T.StructField("monthlyCharges", T.DoubleType()),
    T.StructField("totalCharges", T.DoubleType()),
    T.StructField("churnString", T.StringType()),
])


def read_csv_fixed(spark: SparkSession, path: str, schema: T.StructType | str = RAW_CUSTOMER_SCHEMA,
                   header: bool = True) -> DataFrame:
    """CSV with an explicit schema, matched by position. PERMISSIVE mode:
    a value that does not parse as its type becomes null. Splittable, so a
    large file is read by many tasks (spark.sql.files.maxPartitionBytes)."""
    return (spark.read.format("csv").schema(schema)
            .option("header", str(header).lower()).option("mode", "PERMISSIVE").load(path))


def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with inferred types. Inference costs an extra pass over the file
    (or the sampled share of it); prefer ``read_csv_fixed`` for big inputs."""
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .option("samplingRatio", str(sampling_ratio)).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; filters and projections reach the reader."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)
