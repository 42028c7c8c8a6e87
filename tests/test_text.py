"""Text ingestion: header blocks parsed at several split sizes, titles file (FIXTURES 4, 5)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rateweave.sources import text as T
from rateweave.sources.views import load_ratings

SPLIT_SIZES = ["2k", "16k", "128m"]


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    r = load_ratings(spark, SF_SMALL)
    path = str(tmp_path_factory.mktemp("bronze") / "ratings")
    T.render_header_blocks(r, path, n_files=3)
    expected = sorted(tuple(x) for x in r.select(
        "user_id", "item_id", "rating", F.to_date("rated_at").alias("rated_at")).collect())
    return path, expected


@pytest.mark.parametrize("size", SPLIT_SIZES)
@pytest.mark.parametrize("variant", ["ffill", "cumsum"])
def test_parse_any_split_size(spark, bronze, size, variant):
    path, expected = bronze
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        raw = T.scan_ratings_text(spark, path)
        n_splits = raw.select("file", "split").distinct().count()
        parse = {"ffill": T.parse_header_blocks, "cumsum": T.parse_header_cumsum}[variant]
        good, bad = T.silver_ratings(parse(raw))
        got = sorted(tuple(x) for x in good.collect())
        assert bad.count() == 0
        assert got == expected
        if size == "2k":
            assert n_splits > 3  # blocks really were cut across splits
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", old_cost)


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_malformed_and_headerless_rows_are_rejected(spark, tmp_dir):
    _write(tmp_dir, "part-00000.txt", [
        "5,3,2005-09-06",          # before any header: null item
        "1:", "10,3,2005-09-06", "bad,4,2005-10-19", "11,5,2005-05-13",
        "2:", "10,4,2005-10-19",
    ])
    good, bad = T.silver_ratings(T.parse_header_blocks(T.scan_ratings_text(spark, tmp_dir)))
    assert sorted((r.user_id, r.item_id, r.rating) for r in good.collect()) == [
        (10, 1, 3), (10, 2, 4), (11, 1, 5)]
    rejects = {(r.user_id, r.item_id) for r in bad.collect()}
    assert rejects == {(None, 1), (5, None)}


def test_split_line_fields(spark, tmp_dir):
    _write(tmp_dir, "part-00000.txt", ["1:", "10,3,2005-09-06"])
    rows = sorted((r.user_raw, r.rating_raw, r.date_raw) for r in
                  T.split_line_fields(spark, tmp_dir).collect())
    assert rows == sorted([("1:", None, None), ("10", "3", "2005-09-06")])


def test_titles_file(spark, tmp_dir):
    _write(tmp_dir, "titles.csv", [
        "1,2003,Dinosaur Planet",
        "2,NULL,Isle of Man TT 2004 Review",
        "3,1997,Hello, World",
        '4,1999,"Quoted, Title"',
    ])
    robust = {r.item_id: (r.year, r.title) for r in T.parse_items_text(spark, tmp_dir).collect()}
    assert robust == {1: (2003, "Dinosaur Planet"), 2: (None, "Isle of Man TT 2004 Review"),
                      3: (1997, "Hello, World"), 4: (1999, "Quoted, Title")}
    # the reference's plain CSV read truncates an unquoted title at its comma
    plain = {r.item_id: (r.year, r.title) for r in T.scan_items_csv(spark, tmp_dir).collect()}
    assert plain[3] == (1997, "Hello") and plain[2][0] is None


@pytest.mark.parametrize("size", ["2k", "128m"])
def test_local_fill_across_arrow_batches(spark, bronze, size):
    """Tiny Arrow batches: runs of one split cross batch boundaries, and with
    large splits several files share one partition."""
    path, expected = bronze
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1k",
            "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        raw = T.scan_ratings_text(spark, path)
        good, bad = T.silver_ratings(T.parse_header_blocks(raw))
        assert bad.count() == 0
        assert sorted(tuple(x) for x in good.collect()) == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_parsers_agree_on_lines_without_a_user(spark, tmp_dir):
    _write(tmp_dir, "part-00000.txt", [
        "5,3,2005-09-06",
        "1:", "10,3,2005-09-06", "bad,4,2005-10-19", ",4,2000-01-02", "11,5,2005-05-13",
        "2:", "10,4,2005-10-19", ",,",
    ])
    raw = T.scan_ratings_text(spark, tmp_dir)
    a = T.silver_ratings(T.parse_header_blocks(raw))
    b = T.silver_ratings(T.parse_header_cumsum(raw))
    for x, y in zip(a, b):
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    assert a[0].count() == 3 and a[1].count() == 4


def test_inputs_are_chosen_by_name(spark, tmp_dir):
    _write(tmp_dir, "part-00000.txt", ["1:", "10,3,2005-09-06"])
    _write(tmp_dir, "part-00001.txt", ["2:", "11,4,2005-09-06"])
    _write(tmp_dir, "movie_titles.csv", ["1,2003,Dinosaur Planet"])
    _write(tmp_dir, "readme.txt", ["9:", "1,1,2000-01-01"])
    _write(os.path.join(tmp_dir, "deeper"), "part-9.txt", ["3:", "12,5,2005-09-06"])
    good, bad = T.silver_ratings(T.parse_header_blocks(T.scan_ratings_text(spark, tmp_dir)))
    assert sorted((r.user_id, r.item_id) for r in good.collect()) == [(10, 1), (11, 2), (12, 3)]
    assert bad.count() == 0
    only, _ = T.silver_ratings(T.parse_header_blocks(T.scan_ratings_text(spark, tmp_dir, "part-0000[1]*")))
    assert [(r.user_id, r.item_id) for r in only.collect()] == [(11, 2)]
    titles = spark.read.option("pathGlobFilter", "*titles*").text(tmp_dir)
    assert titles.count() == 1


def test_rendered_blocks_are_split(spark, tmp_dir):
    r = spark.range(0, 1000).selectExpr("id AS user_id", "CAST(7 AS BIGINT) AS item_id", "3 AS rating",
                                        "TIMESTAMP_NTZ'2001-01-01 00:00:00' AS rated_at")
    path = T.render_header_blocks(r, tmp_dir + "/hot", n_files=16)
    files = spark.read.text(path).select("value", F.input_file_name().alias("f"))
    assert files.select("f").distinct().count() > 3 and files.where("value = '7:'").count() == 8
    good, bad = T.silver_ratings(T.parse_header_blocks(T.scan_ratings_text(spark, path)))
    assert good.count() == 1000 and good.where("item_id = 7").count() == 1000 and bad.count() == 0
