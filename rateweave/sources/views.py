"""Driver tables and the ratings / items views derived from them.

The driver ships TPC-H-like tables, not a ratings table.  The ratings view
maps an order line onto a rating:

    user_id  = o_custkey
    item_id  = l_partkey, or l_partkey mod a number of items that is passed
    rating   = least(5, floor((l_quantity - 1) / 10) + 1)
    rated_at = l_shipdate

and keeps the latest line per (user, item), ordered by
(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity) descending.

The order and the rating are packed into one decimal, so "latest per key" is a
plain ``max`` that Spark plans as a hash aggregate with a map-side partial
step: a customer holding a third of all lines collapses to one row per item
inside each map task, and nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# Packed order: day (16 bits), order key (40), line number (4) | part key (40), rating (3).
LOW = 1 << 43
DAY_ZERO = "DATE'1970-01-01'"


def item_of(part: str, items: int | None):
    """Item of a part key: the key itself, or its residue among ``items`` items."""
    key = F.col(part).cast("bigint")
    return key if items is None else key % items


def ratings_from_orders(lineitem: DataFrame, orders: DataFrame, items: int | None = None) -> DataFrame:
    """(user_id bigint, item_id bigint, rating int, rated_at timestamp_ntz)."""
    day = F.date_diff(F.col("l_shipdate").cast("date"), F.expr(DAY_ZERO))
    rating = F.least(F.lit(5), F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("bigint")
    fits = (day.between(0, (1 << 16) - 1) & F.col("l_orderkey").between(0, (1 << 40) - 1)
            & F.col("l_linenumber").between(0, 15) & F.col("l_partkey").between(0, (1 << 40) - 1)
            & rating.between(0, 7)
            & (F.col("l_shipdate").cast("date").cast("timestamp_ntz") == F.col("l_shipdate").cast("timestamp_ntz")))
    high = (day.cast("bigint") * (1 << 44) + F.col("l_orderkey") * 16 + F.col("l_linenumber"))
    low = F.col("l_partkey") * 8 + rating
    packed = high.cast("decimal(19,0)") * F.lit(LOW).cast("decimal(14,0)") + low.cast("decimal(14,0)")
    lines = lineitem.select(
        "l_orderkey", item_of("l_partkey", items).alias("item_id"),
        F.when(fits, packed).otherwise(F.raise_error(F.lit("an order line is out of the packed range")).cast("decimal(34,0)"))
        .alias("line"))
    heads = orders.select("o_orderkey", "o_custkey")
    joined = lines.join(heads, lines.l_orderkey == heads.o_orderkey)
    latest = joined.groupBy(F.col("o_custkey").alias("user_id"), "item_id").agg(F.max("line").alias("line"))
    return latest.select(
        "user_id", "item_id",
        F.expr(f"CAST(CAST(line % {LOW} AS BIGINT) % 8 AS INT)").alias("rating"),
        F.expr(f"CAST(date_add({DAY_ZERO}, CAST((line div {LOW}) div {1 << 44} AS INT)) AS TIMESTAMP_NTZ)").alias("rated_at"))


def items_from_parts(part: DataFrame, ratings: DataFrame | None = None, items: int | None = None) -> DataFrame:
    """(item_id bigint, year int, title string).

    title = p_name of the lowest p_partkey of the item; year = year of the
    item's first rating (a release-year stand-in), null when unrated.
    """
    titles = part.groupBy(item_of("p_partkey", items).alias("item_id")).agg(
        F.min_by("p_name", "p_partkey").alias("title"))
    if ratings is None:
        return titles.select("item_id", F.lit(None).cast("int").alias("year"), "title")
    first = ratings.groupBy("item_id").agg(
        F.year(F.min("rated_at")).cast("int").alias("year"))
    return titles.join(first, "item_id", "left").select("item_id", "year", "title")


def load_ratings(spark: SparkSession, sf_dir: str, items: int | None = None) -> DataFrame:
    return ratings_from_orders(read_table(spark, sf_dir, "lineitem"),
                               read_table(spark, sf_dir, "orders"), items)


def load_items(spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None,
               items: int | None = None) -> DataFrame:
    if ratings is None:
        ratings = load_ratings(spark, sf_dir, items)
    return items_from_parts(read_table(spark, sf_dir, "part"), ratings, items)
