"""Registered queries: text ingestion (bronze -> silver) and versioned sinks.

The driver ships no raw text, so each text query first renders the ratings /
items views derived from the driver tables into the shared scratch folder
(``spark.checkpoint.dir``) with a Spark write, then scans that text back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import DEFAULT_VERSION_NEW, DEFAULT_VERSION_OLD, QUERY_BLOCKS
from ..operators.stats import merge_moments, normalize_ratings, stats_of_moments, user_moments, user_stats
from ..session import fresh_path
from ..sources import text as T
from ..sources import versioned as V
from ..sources.versioned import materialize as written
from .registry import Ctx, register, rounded
from .train import model_versions, recommend_all


def _bronze(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    path = T.render_header_blocks(c.ratings, fresh_path(spark, "bronze-ratings"))
    return T.scan_ratings_text(spark, path), path


@register("scan_ratings_text")
def q_scan_ratings_text(spark, sf_dir):
    raw, _ = _bronze(spark, sf_dir)
    return raw.select("user_raw", "rating", "rated_on")


@register("split_line_fields")
def q_split_line_fields(spark, sf_dir):
    _, path = _bronze(spark, sf_dir)
    return T.split_line_fields(spark, path)


@register("parse_header_blocks")
def q_parse_header_blocks(spark, sf_dir):
    raw, _ = _bronze(spark, sf_dir)
    return T.parse_header_blocks(raw)


@register("parse_header_cumsum")
def q_parse_header_cumsum(spark, sf_dir):
    raw, _ = _bronze(spark, sf_dir)
    return T.parse_header_cumsum(raw)


def _silver(spark, sf_dir, faulty=False):
    """C1 + K1: parse, type, and write both the valid rows and the rejects."""
    path = T.render_header_blocks(Ctx(spark, sf_dir).ratings, fresh_path(spark, "bronze-ratings"), faulty=faulty)
    good, bad = fresh_path(spark, "silver-ratings"), fresh_path(spark, "rejected-ratings")
    counts = T.write_silver(T.parse_header_blocks(T.scan_ratings_text(spark, path)), good, bad)
    return good, bad, counts


@register("silver_ratings")
def q_silver_ratings(spark, sf_dir):
    return spark.read.parquet(_silver(spark, sf_dir)[0])


@register("silver_rejects")
def q_silver_rejects(spark, sf_dir):
    """The lines that K1 could not type: spoiled inside their blocks, beside good ones, in the whole table."""
    return spark.read.parquet(_silver(spark, sf_dir, faulty=True)[1])


@register("silver_counts")
def q_silver_counts(spark, sf_dir):
    """What the silver job reports of its own write."""
    counts = _silver(spark, sf_dir, faulty=True)[2]
    return spark.createDataFrame([tuple(counts[c] for c in ("lines", "valid", "rejected"))],
                                 "lines long, valid long, rejected long")


@register("ingest_new_files")
def q_ingest_new_files(spark, sf_dir):
    """S3 + K1 in two runs: the files there are, then those added since, into one table."""
    ratings = Ctx(spark, sf_dir, True).ratings
    source, table, state = (fresh_path(spark, x) for x in ("incoming", "ingested", "ingest-state"))
    old = F.col("rated_at") < F.lit(DEFAULT_VERSION_OLD).cast("timestamp_ntz")
    for run, rows in enumerate((ratings.where(old), ratings.where(~old))):
        T.render_header_blocks(rows, f"{source}/delivery-{run}")
        T.ingest_new_files(spark, f"{source}/*", table, state, str(run))
    return T.ingested_ratings(spark, table).where("ok").select(
        "user_id", "item_id", "rating", "rated_at", F.col("run").cast("int").alias("run"))


@register("peek_raw_lines")
def q_peek_raw_lines(spark, sf_dir):
    """S6 on raw text: the first lines in a total order, with their number of fields."""
    _, path = _bronze(spark, sf_dir)
    return T.peek_lines(spark, path, 10)


def _items_file(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return T.render_items_csv(c.items, fresh_path(spark, "bronze-items"))


@register("scan_items_csv")
def q_scan_items_csv(spark, sf_dir):
    return T.scan_items_csv(spark, _items_file(spark, sf_dir))


@register("silver_items")
def q_silver_items(spark, sf_dir):
    """C2 + K2: robust titles parse, overwrite silver parquet, read it back."""
    parsed = T.parse_items_text(spark, _items_file(spark, sf_dir))
    out = V.write_table(parsed, fresh_path(spark, "silver-items"))
    return spark.read.parquet(out)


def _stats_versions(spark, sf_dir):
    """Two versions: stats as of the old date, then full stats (written twice)."""
    c = Ctx(spark, sf_dir, True)  # three passes over the ratings: read the view once
    path = fresh_path(spark, "gold-user-stats")
    old = c.ratings.where(F.col("rated_at") < F.lit(DEFAULT_VERSION_OLD).cast("timestamp_ntz"))
    V.write_versioned(user_stats(old), path, DEFAULT_VERSION_OLD)
    full = user_stats(c.ratings)
    V.write_versioned(full, path, DEFAULT_VERSION_NEW)
    V.write_versioned(full, path, DEFAULT_VERSION_NEW)  # rerun: replaces, no duplicates
    return V.read_versioned(spark, path, full.schema)


@register("versioned_stats")
def q_versioned_stats(spark, sf_dir):
    """C3 + K3: every stored version (history is kept)."""
    return rounded(_stats_versions(spark, sf_dir))


@register("latest_version")
def q_latest_version(spark, sf_dir):
    """P14 + A14: newest version only."""
    return rounded(V.latest_version(_stats_versions(spark, sf_dir)))


@register("merged_stats")
def q_merged_stats(spark, sf_dir):
    """A1 + K3 kept up by merging: the stored moments of the old date and those of the ratings since."""
    r = Ctx(spark, sf_dir, True).ratings
    old = F.col("rated_at") < F.lit(DEFAULT_VERSION_OLD).cast("timestamp_ntz")
    path = fresh_path(spark, "gold-user-moments")
    moments = user_moments(r.where(old))
    V.write_versioned(moments, path, DEFAULT_VERSION_OLD)
    stored = V.latest_version(V.read_versioned(spark, path, moments.schema)).drop("version_date")
    # written elsewhere first: the version is made from the table it goes to
    merged = written(merge_moments(stored, user_moments(r.where(~old))), "merged")
    V.write_versioned(merged, path, DEFAULT_VERSION_NEW)
    newest = V.latest_version(V.read_versioned(spark, path, merged.schema))
    return rounded(stats_of_moments(newest).withColumn("version_date", F.lit(DEFAULT_VERSION_NEW).cast("date")))


@register("stored_normalized")
def q_stored_normalized(spark, sf_dir):
    """J1 on stored tables that lie by user: ratings meet their statistics where they are."""
    r = Ctx(spark, sf_dir, True).ratings
    ratings = V.write_bucketed(r, ["user_id"])
    stats = V.write_bucketed(user_stats(r), ["user_id"])
    return rounded(normalize_ratings(ratings, stats))


@register("versioned_neighbors")
def q_versioned_neighbors(spark, sf_dir):
    """C4 + K4: every stored version of the neighbours, clustered by user for the service's look-up."""
    return model_versions(spark, Ctx(spark, sf_dir, True, dense=True).ratings)


@register("versioned_recommendations")
def q_versioned_recommendations(spark, sf_dir):
    """K3/K4 applied to the serving table: today's predictions for every user,
    clustered by user (the service's per-user look-up), latest version read back."""
    c = Ctx(spark, sf_dir, True, dense=True)
    recs = recommend_all(c.ratings, n_blocks=QUERY_BLOCKS, checkpoint_input=False).select("user", "item_id", "rating")
    path = fresh_path(spark, "gold-recommendations")
    V.write_versioned(recs, path, DEFAULT_VERSION_NEW, cluster_by=["user"])
    return rounded(V.latest_version(V.read_versioned(spark, path, recs.schema)))
