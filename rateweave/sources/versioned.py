"""Date-versioned tables.

Versions are ``version_date=YYYY-MM-DD`` partition folders.  Writes use
*dynamic* partition overwrite as a writer option (not a session setting), so
rewriting a date replaces only that date (no duplicates, D7) and older dates
are kept (D8).  Reads declare ``version_date`` as DATE (D17); the latest
version is selected with a scalar subquery, which Spark evaluates before
listing files, so only the latest partition is scanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..session import fresh_path


def write_versioned(df: DataFrame, path: str, version_date: str,
                    cluster_by: list[str] | None = None) -> str:
    """Write ``df`` as version ``version_date`` of the table at ``path``.

    ``cluster_by`` (e.g. ``["user"]``) range-partitions and sorts the rows by
    those columns, so each file and row group covers a narrow key range and a
    look-up ``where user = x`` skips the rest by parquet min/max statistics
    (the serving tier's "index").  Without it the upstream partitioning is
    kept, instead of a ``coalesce`` that would throttle the upstream stage.
    """
    if cluster_by:
        df = materialize(df, "to-cluster")  # a range partitioning reads its input twice
    out = df.withColumn("version_date", F.to_date(F.lit(version_date)))
    if cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    (out.write.partitionBy("version_date").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


# Buckets of a stored user table, the same for all so that they lie together.
BUCKETS = 32


def write_bucketed(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` in buckets of ``keys``, sorted, and read it back.

    Tables with equal keys and buckets join and aggregate by them without an
    exchange.  The catalogue entry lasts as long as its session; the files lie
    in the shared folder.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "bucketed")
    name = "rateweave_" + path.rpartition("-")[2]
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path).bucketBy(
        buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def write_table(df: DataFrame, path: str) -> str:
    """Plain idempotent overwrite (silver tables)."""
    df.write.mode("overwrite").parquet(path)
    return path


def read_versioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read all versions; ``schema`` is the data schema without ``version_date``."""
    full = StructType(list(schema.fields) + [StructField("version_date", DateType())])
    return spark.read.schema(full).parquet(path)


def latest_version(df: DataFrame, column: str = "version_date") -> DataFrame:
    """Rows of the newest version only; an empty table gives an empty result."""
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream joins) and, unlike an RDD checkpoint, keeps a columnar table:
    later scans prune columns and push filters, and AQE sees real sizes.
    Used where a plan would otherwise compute the same input in several
    branches (a scalar-subquery total next to the rows, training next to
    scoring).
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.materialized_path = path  # for release()
    return out


def release(materialized: DataFrame) -> None:
    """Free a table written by ``materialize`` once nothing reads it any more.

    Spark-native: the folder is overwritten with an empty DataFrame of the
    same schema, which removes the data files.  Call it after the results
    that read the table have been written (plans are lazy).
    """
    path = getattr(materialized, "materialized_path", None)
    if path is None:
        raise ValueError("not a DataFrame returned by materialize()")
    spark = materialized.sparkSession
    spark.createDataFrame([], materialized.schema).write.mode("overwrite").parquet(path)
