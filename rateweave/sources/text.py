"""Raw text formats: header-block ratings and the item titles file.

Header-block ratings text (no header line)::

    12:
    1,3,1996-01-02
    7,5,1997-03-04
    13:
    ...

A line ending in ``:`` opens the block of that item; the following data lines
``user,rating,date`` belong to it.

Forward fill at scale (W1)
--------------------------
The reference fills the item id down the file with ``last(ignorenulls)`` over
an *un-partitioned* window: every row of every file goes to one task.  Here
the order that matters is the line order inside each file, which Spark
preserves inside each input split:

1. scan with a digest of ``_metadata.file_path`` and
   ``_metadata.file_block_start`` (the split);
2. fill inside the split as the scan hands out its lines, in Arrow batches:
   no line of text is shuffled; at the end of a split a marker row with its
   last header follows its lines;
3. the filled lines and the markers are written once, as columns;
4. the carry-in of a split is the last header of the nearest earlier split
   of the same file that has one (window by file over the markers);
5. only lines before the first header of their split are joined to it.

The text is scanned once.  Work is parallel per split and nothing is gathered
per file.  Inputs must be
splittable (plain text); data rows before the first header of a file get a
null item and are reported as rejects, never silently dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import BLOCK_PIECES
from .versioned import materialize, write_table

RAW_RATINGS_SCHEMA = "user_raw STRING, rating INT, rated_on DATE"
RAW_ITEMS_SCHEMA = "item_id INT, year SMALLINT, title STRING"


# --- rendering (bronze fixtures derived from the ratings view) ----------------

def render_header_blocks(ratings: DataFrame, path: str, n_files: int | None = None,
                         pieces: int = BLOCK_PIECES, faulty: bool = False) -> str:
    """Write ratings as header-block text, up to ``pieces`` blocks per item.

    Rows are hash-partitioned by item and piece (user mod ``pieces``), so an
    item that most rows belong to is written by several tasks; inside each
    file a block's header comes first, then its users ascending.
    ``n_files`` defaults to the session's shuffle partition count, so the
    write is as parallel as any other stage.  ``faulty`` spoils lines where
    they lie, by their own rating: a user id that is no number at 1, none at
    2, a rating that is no number at 3.
    """
    user, rating = F.col("user_id").cast("string"), F.col("rating").cast("string")
    if faulty:
        user = F.when(F.col("rating") == 1, F.concat(F.lit("u"), user)).when(F.col("rating") == 2, F.lit("")).otherwise(user)
        rating = F.when(F.col("rating") == 3, F.lit("x")).otherwise(rating)
    if n_files is None:
        n_files = int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.pmod("user_id", F.lit(pieces)).alias("piece")
    heads = ratings.select("item_id", piece).distinct().select(
        "item_id", "piece", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("user_id"),
        F.concat(F.col("item_id").cast("string"), F.lit(":")).alias("value"))
    rows = ratings.select(
        "item_id", piece, F.lit(1).alias("kind"), "user_id",
        F.concat_ws(",", user, rating, F.date_format("rated_at", "yyyy-MM-dd")).alias("value"))
    lines = heads.unionByName(rows).repartition(n_files, "item_id", "piece") \
        .sortWithinPartitions("item_id", "piece", "kind", "user_id").select("value")
    lines.write.mode("overwrite").text(path)
    return path


def render_items_csv(items: DataFrame, path: str, n_files: int | None = None) -> str:
    """Write ``item_id,year,title`` lines; a missing year is the text ``NULL``."""
    year = F.coalesce(F.col("year").cast("string"), F.lit("NULL"))
    lines = items.select(F.concat_ws(",", F.col("item_id").cast("string"), year,
                                     F.col("title")).alias("value"))
    if n_files:
        lines = lines.repartition(n_files)
    lines.write.mode("overwrite").text(path)
    return path


# --- scans -------------------------------------------------------------------

def scan_ratings_text(spark: SparkSession, path: str, glob: str = "part-*") -> DataFrame:
    """Header-less CSV scan with an explicit schema (S1) over every matching file (S3).

    One scan for all files (``pathGlobFilter`` replaces the reference's driver
    loop over object names).  Adds file, split and in-split position.
    """
    df = (spark.read.schema(RAW_RATINGS_SCHEMA)
          .option("sep", ",").option("header", "false").option("mode", "PERMISSIVE")
          .option("dateFormat", "yyyy-MM-dd").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true")
          .csv(path))
    return df.select(
        "user_raw", "rating", "rated_on",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"))


def ingest_new_files(spark: SparkSession, source: str, table: str, checkpoint: str, run: str,
                     glob: str = "part-*") -> int:
    """Append the lines of files not taken before to ``table``; gives the number of lines read (K1).

    A stream with ``availableNow``: ``checkpoint`` remembers the files, the
    file sink's log the batches that are complete, so a run that was cut off
    and repeated writes nothing twice, and a run without new files nothing.
    The lines are stored as ``filled_lines`` with the name of the run; see
    ``ingested_ratings``.
    """
    lines = (spark.readStream.schema(RAW_RATINGS_SCHEMA)
             .option("sep", ",").option("header", "false").option("mode", "PERMISSIVE")
             .option("dateFormat", "yyyy-MM-dd").option("pathGlobFilter", glob).csv(source))
    raw = lines.select("user_raw", "rating", "rated_on", F.xxhash64("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("split"))
    query = (filled_lines(raw).withColumn("run", F.lit(run)).writeStream.format("parquet").partitionBy("run")
             .option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def ingested_ratings(spark: SparkSession, table: str) -> DataFrame:
    """``type_ratings`` of everything that ``ingest_new_files`` stored, with ``run``."""
    stored = carried(spark.read.schema(f"{FILLED}, run string").parquet(table))
    return type_ratings(stored, "run")


def split_line_fields(spark: SparkSession, path: str, glob: str = "part-*") -> DataFrame:
    """Split each raw line into three text fields on the first two commas."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
        .text(path)
    parts = F.split(F.col("value"), ",", 3)
    return lines.select(F.get(parts, 0).alias("user_raw"), F.get(parts, 1).alias("rating_raw"),
                        F.get(parts, 2).alias("date_raw"))


def peek_lines(spark: SparkSession, path: str, n: int, glob: str = "part-*") -> DataFrame:
    """The first ``n`` raw lines in order of their text, with their number of fields."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    return lines.orderBy("value").limit(n).withColumn("fields", F.size(F.split("value", ",")))


# --- header blocks -------------------------------------------------------------

def _headed(raw: DataFrame) -> DataFrame:
    """Header flag (P1; a line without a user is none) and header id."""
    is_header = F.coalesce(F.col("user_raw").endswith(":"), F.lit(False))
    return raw.select(
        "file", "split", "pos", "user_raw", "rating", "rated_on", is_header.alias("is_header"),
        F.when(is_header, F.regexp_replace("user_raw", ":", "")).alias("header"))


def _fill_fn():
    """mapInArrow function: forward-fill headers through each split, in scan order.

    A file scan hands every split to one task as a contiguous run of lines, in
    file order, so the fill needs no shuffle.  The fill restarts at every
    split boundary; a split's leading rows (before its first header) stay
    null here and get the carry-in.  Every split ends with a marker row: its
    last header, null if it has none.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    def fn(batches):
        last_key, last, schema = None, None, None
        for batch in batches:
            for part in cut(batch):
                key = (part.column("file")[0].as_py(), part.column("split")[0].as_py())
                if last_key is not None and key != last_key:
                    yield marker(schema, last_key, last)
                raw = part.column("user_raw")
                head = pc.fill_null(pc.ends_with(raw, ":"), False)
                item = pc.if_else(head, pc.replace_substring(raw, ":", ""), pa.scalar(None, pa.string()))
                if key == last_key and last is not None:
                    item = pa.concat_arrays([pa.array([last], pa.string()), item])
                    item = pc.fill_null_forward(item).slice(1)
                else:
                    item = pc.fill_null_forward(item)
                last_key, last = key, item[len(item) - 1].as_py()
                out = pa.RecordBatch.from_arrays(
                    [*part.columns, item, pa.array([False] * len(part))], names=[*part.schema.names, "local", "marker"])
                schema = out.schema
                yield out.filter(pc.invert(head))
        if last_key is not None:
            yield marker(schema, last_key, last)

    def marker(schema, key, last):
        values = {"file": key[0], "split": key[1], "local": last, "marker": True}
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def cut(batch):
        """A batch at its split boundaries."""
        if not len(batch):
            return
        same = pc.and_(pc.equal(batch.column("file").slice(1), batch.column("file").slice(0, len(batch) - 1)),
                       pc.equal(batch.column("split").slice(1), batch.column("split").slice(0, len(batch) - 1)))
        at = [0, *(i + 1 for i, x in enumerate(same.to_pylist()) if not x), len(batch)] if not pc.all(same).as_py() and len(same) \
            else [0, len(batch)]
        for a, b in zip(at, at[1:]):
            yield batch.slice(a, b - a)

    return fn


FILLED = "file bigint, split bigint, user_raw string, rating int, rated_on date, local string, marker boolean"


def filled_lines(raw: DataFrame) -> DataFrame:
    """The lines without headers, filled inside their splits, and the splits' markers (see FILLED)."""
    return raw.select("file", "split", "user_raw", "rating", "rated_on").mapInArrow(_fill_fn(), FILLED)


def carried(filled: DataFrame) -> DataFrame:
    """Written ``filled_lines`` with ``item_raw``: splits hand their last header on to the next.

    Lines before the first header of their split are joined to the markers,
    one row for each split; all others pass straight through.
    """
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carry = filled.where("marker").select(
        "file", "split", F.last("local", ignorenulls=True).over(earlier).alias("carry"))
    columns = [c for c in filled.columns if c not in ("file", "split", "local", "marker")]
    lines = filled.where("NOT marker")
    leading = lines.where("local IS NULL").join(carry, ["file", "split"], "left")
    return lines.where("local IS NOT NULL").select(*columns, F.col("local").alias("item_raw")).unionByName(
        leading.select(*columns, F.col("carry").alias("item_raw")))


def parse_header_blocks(raw: DataFrame) -> DataFrame:
    """Forward-fill the item id down each file and drop header rows.

    Output: user_raw, rating, rated_on, item_raw (text, before casts).  The
    text is scanned once: the lines are filled inside their scan tasks, not
    shuffled, and written with the markers of their splits.
    """
    return carried(materialize(filled_lines(raw), "filled"))


def _count_fn():
    """mapInArrow function: ``hno``, the headers of a line's split up to and with the line, in scan order (see ``_fill_fn``)."""
    import numpy as np
    import pyarrow as pa

    def fn(batches):
        last, count = None, 0
        for batch in batches:
            if not len(batch):
                continue
            file, split = batch.column("file").to_numpy(), batch.column("split").to_numpy()
            head = batch.column("is_header").to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (split[1:] != split[:-1])))
            total = np.cumsum(head)
            hno = total - np.repeat((total - head)[begins], np.diff(begins, append=len(batch)))
            if last == (file[0], split[0]):
                hno[:begins[1] if len(begins) > 1 else len(batch)] += count
            last, count = (file[-1], split[-1]), int(hno[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hno, pa.int64())], names=[*batch.schema.names, "hno"])

    return fn


COUNTED = "file bigint, split bigint, user_raw string, rating int, rated_on date, is_header boolean, header string, hno bigint"


def parse_header_cumsum(raw: DataFrame) -> DataFrame:
    """Notebook variant: running header count, then join rows to their header.

    The text is scanned once: the headers are counted inside their scan tasks
    and the lines written with their count.  This form then joins every line
    to its header by split and count; a split's count 0 is the carry-in.
    ``parse_header_blocks`` joins only such lines.
    """
    marked = _headed(raw).drop("pos")
    numbered = materialize(marked.mapInArrow(_count_fn(), COUNTED), "counted")
    heads = numbered.where("is_header").select("file", "split", "hno", F.col("header").alias("item_raw"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = numbered.groupBy("file", "split").agg(F.max_by("header", F.when(F.col("is_header"), F.col("hno"))).alias("last_header"))
    carry = splits.select("file", "split", F.lit(0).cast("bigint").alias("hno"),
                          F.last("last_header", ignorenulls=True).over(earlier).alias("item_raw"))
    rows = numbered.where(~F.col("is_header")).select("file", "split", "hno", "user_raw", "rating", "rated_on")
    return rows.join(heads.unionByName(carry), ["file", "split", "hno"], "left").select(
        "user_raw", "rating", "rated_on", "item_raw")


def type_ratings(parsed: DataFrame, *keep: str) -> DataFrame:
    """Typed silver columns with ``try_cast`` (D4) plus an ``ok`` flag (P6) and the columns to keep."""
    typed = parsed.select(
        F.expr("try_cast(user_raw AS BIGINT)").alias("user_id"),
        F.expr("try_cast(item_raw AS BIGINT)").alias("item_id"),
        F.col("rating"), F.col("rated_on").alias("rated_at"), *keep)
    ok = (F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
          & F.col("rating").isNotNull() & F.col("rated_at").isNotNull())
    return typed.withColumn("ok", ok)


def silver_ratings(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows): malformed ids, missing items and nulls are rejected."""
    return split_typed(type_ratings(parsed))


def write_silver(parsed: DataFrame, good_path: str, bad_path: str) -> dict[str, int]:
    """Write valid and rejected rows; their numbers are counted by the write itself.

    gives {"lines": ..., "valid": ..., "rejected": ...}: no pass of its own.
    """
    counts = Observation("silver")
    kept = F.col("ok").cast("bigint")
    typed = materialize(type_ratings(parsed).observe(
        counts, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(kept), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(1 - kept), F.lit(0)).alias("rejected")), "typed-ratings")
    good, bad = split_typed(typed)
    write_table(good, good_path)
    write_table(bad, bad_path)
    return counts.get


def split_typed(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``type_ratings`` as (valid, rejected)."""
    cols = ["user_id", "item_id", "rating", "rated_at"]
    return typed.where("ok").select(cols), typed.where("NOT ok").select(cols)


# --- items -----------------------------------------------------------------

def scan_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """The reference's titles read: CSV with schema, ``sep=','``.

    An unquoted comma inside a title truncates it; use ``parse_items_text``
    for the robust form (D9).
    """
    return spark.read.schema(RAW_ITEMS_SCHEMA).option("sep", ",") \
        .option("header", "false").option("mode", "PERMISSIVE").csv(path)


def parse_items_text(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Robust titles parse: split on the first two commas only; ``NULL`` year -> null.

    A title wrapped in double quotes is unquoted (and ``""`` becomes ``"``).
    """
    lines = spark.read.option("encoding", encoding).text(path)
    parts = F.split(F.col("value"), ",", 3)
    title = F.get(parts, 2)
    quoted = title.startswith('"') & title.endswith('"') & (F.length(title) >= 2)
    unq = F.regexp_replace(F.expr("substring(title_raw, 2, length(title_raw) - 2)"), '""', '"')
    return lines.select(
        F.expr("try_cast(trim(split(value, ',', 3)[0]) AS INT)").alias("item_id"),
        F.expr("try_cast(trim(get(split(value, ',', 3), 1)) AS SMALLINT)").alias("year"),
        title.alias("title_raw"), quoted.alias("_q"),
    ).select("item_id", "year",
             F.when(F.col("_q"), unq).otherwise(F.col("title_raw")).alias("title"))
