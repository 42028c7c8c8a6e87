"""DuckDB oracle SQL for every registered query that SQL can express.

The driver registers the raw tables as views; each string below starts from
those and rebuilds the ratings / items views with CTEs.  Parameters come from
``rateweave.constants`` so query and oracle cannot drift apart.
"""

from __future__ import annotations

import re

from .. import constants as K

D = K.OUT_DIGITS



def ratings_sql(item: str) -> str:
    return f"""
ratings AS (
  SELECT user_id, item_id, rating, rated_at FROM (
    SELECT o_custkey AS user_id,
           CAST({item} AS BIGINT) AS item_id,
           CAST(least(5, floor((l_quantity - 1) / 10) + 1) AS INT) AS rating,
           l_shipdate AS rated_at,
           row_number() OVER (PARTITION BY o_custkey, {item}
             ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                      l_partkey DESC, l_quantity DESC) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
  WHERE rn = 1)"""


def items_sql(item: str) -> str:
    return f"""
items AS (
  SELECT p.item_id, f.year, p.title
  FROM (SELECT CAST({item} AS BIGINT) AS item_id,
               arg_min(p_name, p_partkey) AS title
        FROM part GROUP BY 1) p
  LEFT JOIN (SELECT item_id, CAST(year(min(rated_at)) AS INT) AS year
             FROM ratings GROUP BY 1) f USING (item_id))"""


RATINGS, ITEMS = ratings_sql("l_partkey"), items_sql("p_partkey")
# the fixture of the similarity queries: few items, which users share
DENSE = ratings_sql(f"l_partkey % {K.DENSE_ITEMS}")
DENSE_ITEMS = items_sql(f"p_partkey % {K.DENSE_ITEMS}")

STATS = """
stats AS (
  SELECT user_id, avg(rating) AS mean_rating, stddev_pop(rating) AS std_rating,
         max(rating) AS max_rating, min(rating) AS min_rating,
         CAST(count(*) AS BIGINT) AS rated_items
  FROM ratings GROUP BY user_id)"""

BLOCKED = f"""
blocked AS (
  SELECT r.user_id, r.item_id, r.rating, (mixed % {K.QUERY_BLOCKS} + {K.QUERY_BLOCKS}) % {K.QUERY_BLOCKS} AS block
  FROM (SELECT *, ((((user_id % {K.BLOCK_PRIME} + {K.BLOCK_PRIME}) % {K.BLOCK_PRIME}) * {K.BLOCK_MULT} + {K.BLOCK_ADD}) % {K.BLOCK_PRIME} + {K.BLOCK_PRIME}) % {K.BLOCK_PRIME}
                  AS mixed FROM ratings) r)"""

PAIRS = """
pairs AS (
  SELECT a.block, a.item_id, a.user_id AS "user", b.user_id AS neighbor,
         a.rating AS x, b.rating AS y
  FROM blocked a JOIN blocked b
    ON a.block = b.block AND a.item_id = b.item_id AND a.user_id < b.user_id)"""


def moments_sql(src: str, name: str, having: str) -> str:
    return f"""
{name} AS (
  SELECT "user", neighbor, CAST(count(*) AS BIGINT) AS n,
         CAST(sum(x) AS BIGINT) AS sum_x, CAST(sum(y) AS BIGINT) AS sum_y,
         CAST(sum(x * y) AS BIGINT) AS sum_xy,
         CAST(sum(x * x) AS BIGINT) AS sum_x2, CAST(sum(y * y) AS BIGINT) AS sum_y2
  FROM {src} GROUP BY "user", neighbor {having})"""


def corr_sql(src: str, name: str, where: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT "user", neighbor,
           round(CASE WHEN n * sum_x2 - sum_x * sum_x > 0 AND n * sum_y2 - sum_y * sum_y > 0
                 THEN CAST(n * sum_xy - sum_x * sum_y AS DOUBLE)
                      / (sqrt(CAST(n * sum_x2 - sum_x * sum_x AS DOUBLE))
                         * sqrt(CAST(n * sum_y2 - sum_y * sum_y AS DOUBLE))) END,
                 {K.CORR_DIGITS}) AS corr,
           n
    FROM {src}) c
  WHERE corr IS NOT NULL {where})"""


MOMENTS = moments_sql("pairs", "moments", f"HAVING count(*) >= {K.MIN_SUPPORT}")
CORRS = corr_sql("moments", "corrs", f"AND corr > {K.MIN_CORR}")
SYM = """
sym AS (
  SELECT "user", neighbor, corr FROM corrs
  UNION ALL
  SELECT neighbor AS "user", "user" AS neighbor, corr FROM corrs)"""
TOPK = f"""
topk AS (
  SELECT "user", neighbor, corr FROM (
    SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY corr DESC, neighbor ASC) AS rk
    FROM sym) s
  WHERE rk <= {K.K_NEIGHBORS})"""
NEIGHBOR_RATINGS = """
nbr AS (
  SELECT e."user", e.neighbor, e.corr, r.item_id, r.rating
  FROM topk e JOIN ratings r ON r.user_id = e.neighbor)"""
SCALE = f"CAST({10 ** K.CORR_DIGITS} AS DOUBLE)"
CU = f"CAST(round(corr * {SCALE}) AS BIGINT)"
RAW = f"""
raw AS (
  SELECT "user", item_id, CAST(score_u AS DOUBLE) / {SCALE} AS score,
         CAST(corr_sum_u AS DOUBLE) / {SCALE} AS corr_sum, support,
         CAST(score_u AS DOUBLE) / nullif(CAST(corr_sum_u AS DOUBLE), 0) AS raw_rating
  FROM (SELECT "user", item_id, CAST(sum(CAST(rating AS BIGINT) * {CU}) AS BIGINT) AS score_u,
               CAST(sum({CU}) AS BIGINT) AS corr_sum_u, CAST(count(rating) AS BIGINT) AS support
        FROM nbr GROUP BY "user", item_id) s)"""
PEN = f"""
pen AS (
  SELECT *, CASE WHEN shrunk IS NOT NULL
                 THEN greatest({float(K.RATING_MIN)}, least({float(K.RATING_MAX)}, shrunk)) END AS rating
  FROM (SELECT *, user_mean + (raw_rating - user_mean) * (support / (support + {float(K.SMOOTHING)})) AS shrunk
        FROM (SELECT *, avg(raw_rating) OVER (PARTITION BY "user") AS user_mean FROM raw) a) b)"""
RECS = """
recs AS (
  SELECT p.* FROM pen p
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = p."user" AND r.item_id = p.item_id))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def r(x: str) -> str:
    return f"round({x}, {D}) AS {x}"


TRAIN = (DENSE, BLOCKED, PAIRS, MOMENTS, CORRS, SYM, TOPK)
PRED = TRAIN + (NEIGHBOR_RATINGS, RAW, PEN)

ORACLE: dict[str, str] = {}

ORACLE["scan_ratings"] = with_(RATINGS) + "SELECT * FROM ratings"
ORACLE["user_stats"] = with_(RATINGS, STATS) + f"""
SELECT user_id, {r('mean_rating')}, {r('std_rating')}, max_rating, min_rating, rated_items
FROM stats"""
ORACLE["normalize_ratings"] = with_(RATINGS, STATS) + f"""
SELECT r.user_id, r.item_id,
       round(CASE WHEN s.std_rating <> 0 THEN (CAST(r.rating AS DOUBLE) - s.mean_rating) / s.std_rating
                  ELSE 0.0 END, {D}) AS z,
       r.rating, round(s.mean_rating, {D}) AS mean_rating, round(s.std_rating, {D}) AS std_rating
FROM ratings r LEFT JOIN stats s USING (user_id)"""
ORACLE["user_blocks"] = with_(RATINGS, BLOCKED) + "SELECT user_id, item_id, rating, block FROM blocked"
ORACLE["corated_pairs"] = with_(DENSE, BLOCKED, PAIRS) + "SELECT * FROM pairs"
ORACLE["pair_moments"] = with_(DENSE, BLOCKED, PAIRS, MOMENTS) + "SELECT * FROM moments"
ORACLE["user_correlations"] = with_(DENSE, BLOCKED, PAIRS, MOMENTS, CORRS) + "SELECT * FROM corrs"
ORACLE["symmetric_corr"] = with_(DENSE, BLOCKED, PAIRS, MOMENTS, CORRS, SYM) + "SELECT * FROM sym"
ORACLE["top_k_neighbors"] = with_(*TRAIN) + "SELECT * FROM topk"
# users with a row in the newest stored statistics, of which the older version has fewer
ORACLE["train_neighbors"] = ORACLE["top_k_neighbors"]
ORACLE["exact_neighbors"] = with_(
    DENSE, "\nblocked AS (SELECT *, 0 AS block FROM ratings)", PAIRS, MOMENTS, CORRS, SYM, TOPK) + "SELECT * FROM topk"
ORACLE["neighbor_ratings"] = with_(*TRAIN, NEIGHBOR_RATINGS) + "SELECT * FROM nbr"
ORACLE["predict_raw"] = with_(*TRAIN, NEIGHBOR_RATINGS, RAW) + f"""
SELECT "user", item_id, score, corr_sum, support, {r('raw_rating')} FROM raw"""
ORACLE["predict_penalized"] = with_(*PRED) + f"""
SELECT "user", item_id, support, {r('raw_rating')}, {r('user_mean')}, {r('rating')} FROM pen"""
ORACLE["exclude_rated"] = with_(*PRED, RECS) + f"""
SELECT "user", item_id, {r('rating')} FROM recs"""
ORACLE["recommend_all"] = with_(*PRED, RECS) + f"""
SELECT "user", item_id, score, corr_sum, support, {r('raw_rating')},
       {r('user_mean')}, {r('rating')} FROM recs"""
ORACLE["top_n_recommendations"] = with_(*PRED, RECS) + f"""
SELECT "user", item_id, rating, rank FROM (
  SELECT "user", item_id, round(rating, {D}) AS rating,
         CAST(row_number() OVER (PARTITION BY "user" ORDER BY round(rating, {D}) DESC, item_id ASC) AS INTEGER) AS rank
  FROM recs) t WHERE rank <= 10"""
ORACLE["distinct_users"] = with_(RATINGS) + "SELECT DISTINCT user_id FROM ratings ORDER BY user_id"
ORACLE["distinct_items"] = with_(RATINGS) + "SELECT DISTINCT item_id FROM ratings"
ORACLE["profile_ratings"] = with_(RATINGS) + "\n UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n,
       round(avg(CAST({c} AS DOUBLE)), {D}) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), {D}) AS stddev,
       round(min(CAST({c} AS DOUBLE)), {D}) AS min_value,
       round(max(CAST({c} AS DOUBLE)), {D}) AS max_value FROM ratings"""
    for c in ("user_id", "item_id", "rating"))
ORACLE["range_sum"] = with_(RATINGS) + """
SELECT CAST(n * (n + 1) // 2 AS BIGINT) AS total FROM (SELECT count(DISTINCT user_id) AS n FROM ratings) c"""
ORACLE["peek_rows"] = with_(RATINGS) + "SELECT * FROM ratings ORDER BY user_id, item_id LIMIT 10"

# --- serving, notebook form, look-ups ---------------------------------------

SUBJ = ", ".join(str(u) for u in K.DEFAULT_SUBJECT_USERS)
FITEMS = ", ".join(str(i) for i in K.DEFAULT_FILTER_ITEMS)
PS = K.PAGE_SIZE
LP = 2  # page requested by the list queries
RECS_ALL = PRED + (RECS,)

USERS_ALL = f"""
ua AS (
  SELECT user_id FROM ratings WHERE item_id IN ({FITEMS})
  GROUP BY user_id HAVING count(DISTINCT item_id) = {len(set(K.DEFAULT_FILTER_ITEMS))})"""


def per_user_pages(src: str, user: str, order: str) -> str:
    return f"""
SELECT *, {PS} AS page_size, (total_items + {PS - 1}) // {PS} AS total_pages,
       page * {PS} < total_items AS has_next, page > 1 AS has_prev
FROM (SELECT *, CAST(ceil(rank / {PS}.0) AS INTEGER) AS page FROM (
  SELECT s.*, CAST(row_number() OVER (PARTITION BY {user} ORDER BY {order}) AS INTEGER) AS rank,
         count(*) OVER (PARTITION BY {user}) AS total_items
  FROM {src} s) a) b"""


SUBJECT_PAIRS = f"""
sp AS (
  SELECT a.user_id AS "user", b.user_id AS neighbor, a.item_id, a.rating AS x, b.rating AS y
  FROM ratings a JOIN ratings b ON a.item_id = b.item_id AND a.user_id <> b.user_id
  WHERE a.user_id IN ({SUBJ}))"""
KNN = f"""
knn AS (
  SELECT "user", neighbor, corr, n FROM (
    SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY corr DESC, neighbor ASC) AS rk
    FROM nbc) s
  WHERE rk <= {K.NOTEBOOK_K})"""
ABSW = f"""
absw AS (
  SELECT "user", item_id, support, raw_prediction,
         raw_prediction * (support / (support + {float(K.NOTEBOOK_C)})) AS prediction
  FROM (SELECT "user", item_id, CAST(count(*) AS BIGINT) AS support,
               CAST(sum(CAST(r.rating AS BIGINT) * {CU}) AS DOUBLE)
                 / nullif(CAST(sum(abs({CU})) AS DOUBLE), 0) AS raw_prediction
        FROM knn e JOIN ratings r ON r.user_id = e.neighbor
        GROUP BY "user", item_id) g)"""
NB_CTES = (DENSE, SUBJECT_PAIRS, moments_sql("sp", "nbm", f"HAVING count(*) > {K.NOTEBOOK_MIN_SUPPORT}"),
           corr_sql("nbm", "nbc", ""), KNN)

# the listed items are those of the order with the smallest key; the page and
# the pair are of the users of the most rated item
LISTED = """
listed AS (
  SELECT DISTINCT CAST(l_partkey AS BIGINT) AS item_id FROM lineitem
  WHERE l_orderkey = (SELECT min(l_orderkey) FROM lineitem))"""
USERS_LISTED = """
ua AS (
  SELECT user_id FROM ratings JOIN listed USING (item_id)
  GROUP BY user_id HAVING count(DISTINCT item_id) = (SELECT count(*) FROM listed))"""
ANY_ITEM = """
ua AS (
  SELECT DISTINCT user_id FROM ratings
  WHERE item_id = (SELECT item_id FROM ratings GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 1))"""
ORACLE["users_rated_all"] = with_(RATINGS, LISTED, USERS_LISTED) + "SELECT user_id FROM ua"
ORACLE["users_page"] = with_(RATINGS, ANY_ITEM) + f"""
SELECT user_id, {LP} AS page, {PS} AS page_size, total AS total_users,
       (total + {PS - 1}) // {PS} AS total_pages,
       {(LP - 1) * PS + PS} < total AS has_next, {(LP - 1) * PS} > 0 AS has_prev
FROM ua CROSS JOIN (SELECT count(*) AS total FROM ua) t
ORDER BY user_id LIMIT {PS} OFFSET {(LP - 1) * PS}"""
ORACLE["users_rated_lists"] = with_(RATINGS) + """,
lists AS (SELECT DISTINCT l_orderkey AS list_id, CAST(l_partkey AS BIGINT) AS item_id FROM lineitem),
sizes AS (SELECT list_id, count(*) AS size FROM lists GROUP BY list_id)
SELECT list_id, user_id FROM lists JOIN ratings USING (item_id) JOIN sizes USING (list_id)
GROUP BY list_id, user_id, size HAVING count(*) = size"""
ORACLE["items_page"] = with_(RATINGS, ITEMS) + f"""
SELECT item_id, title, {LP} AS page, {PS} AS page_size, total AS total_items,
       (total + {PS - 1}) // {PS} AS total_pages,
       {LP * PS} < total AS has_next, {LP} > 1 AS has_prev
FROM items CROSS JOIN (SELECT count(*) AS total FROM items) t
ORDER BY item_id LIMIT {PS} OFFSET {(LP - 1) * PS}"""
ORACLE["rated_items_page"] = with_(
    RATINGS, ITEMS,
    "\nmine AS (SELECT r.user_id, r.item_id, r.rating, i.title FROM ratings r LEFT JOIN items i USING (item_id))"
) + per_user_pages("mine", "user_id", "item_id")
ORACLE["paged_recommendations"] = with_(
    *RECS_ALL, DENSE_ITEMS,
    f'\nrt AS (SELECT p."user", p.item_id, round(p.rating, {D}) AS rating, i.title '
    'FROM recs p LEFT JOIN items i USING (item_id))'
) + per_user_pages("rt", '"user"', "rating DESC, item_id ASC")
ORACLE["page_meta"] = with_(*RECS_ALL) + f"""
SELECT "user", count(*) AS total_items, (count(*) + {PS - 1}) // {PS} AS total_pages
FROM recs GROUP BY "user" """
ORACLE["attach_titles"] = with_(RATINGS, ITEMS) + """
SELECT r.user_id, r.item_id, r.rating, i.title FROM ratings r LEFT JOIN items i USING (item_id)"""
ORACLE["best_rated_items"] = with_(RATINGS, ITEMS) + f"""
SELECT r.user_id, r.item_id, r.rating, i.title,
       CAST(row_number() OVER (PARTITION BY r.user_id ORDER BY r.rating DESC, r.item_id ASC) AS INTEGER) AS rank
FROM ratings r JOIN items i USING (item_id) WHERE r.user_id IN ({SUBJ})"""
ORACLE["one_vs_all_pairs"] = with_(DENSE, SUBJECT_PAIRS) + "SELECT * FROM sp"
ORACLE["one_vs_all_corr"] = with_(DENSE, SUBJECT_PAIRS, moments_sql("sp", "m", ""),
                                  corr_sql("m", "c", "")) + "SELECT * FROM c"
ORACLE["one_vs_all_knn"] = with_(*NB_CTES) + "SELECT * FROM knn"
ORACLE["predict_abs_weighted"] = with_(*NB_CTES, ABSW) + f"""
SELECT "user", item_id, support, {r('raw_prediction')}, {r('prediction')} FROM absw"""
ORACLE["suggest_items"] = with_(*NB_CTES, ABSW, DENSE_ITEMS) + f"""
SELECT a."user", a.item_id, i.title, round(a.raw_prediction, {D}) AS raw_prediction, a.support,
       round(a.prediction, {D}) AS prediction,
       CAST(row_number() OVER (PARTITION BY a."user" ORDER BY round(a.prediction, {D}) DESC, a.item_id ASC)
            AS INTEGER) AS rank
FROM absw a JOIN items i USING (item_id)"""
ORACLE["subset_correlations"] = with_(
    DENSE, SUBJECT_PAIRS, moments_sql("sp", "m", f"HAVING count(*) >= {K.MIN_SUPPORT}"),
    corr_sql("m", "c", f"AND corr > {K.MIN_CORR}")) + "SELECT * FROM c"
ORACLE["both_users_items"] = with_(RATINGS, ANY_ITEM) + """,
pair AS (SELECT min(user_id) AS user1, (SELECT min(user_id) FROM ua WHERE user_id > (SELECT min(user_id) FROM ua)) AS user2 FROM ua)
SELECT a.item_id, user1, user2, a.rating AS rating1, b.rating AS rating2
FROM pair JOIN ratings a ON a.user_id = user1 JOIN ratings b ON b.user_id = user2 AND b.item_id = a.item_id"""
ORACLE["filter_user"] = with_(RATINGS) + f"SELECT * FROM ratings WHERE user_id = {K.DEFAULT_SUBJECT_USERS[0]}"
ORACLE["user_ratings_multi"] = with_(RATINGS) + f"SELECT * FROM ratings WHERE user_id IN ({SUBJ})"
_s = K.DEFAULT_SUBJECT_USERS
ORACLE["pair_lookup"] = with_(
    DENSE,
    f'\npl AS (SELECT * FROM (VALUES ({_s[0]}, {_s[1]}), ({_s[0]}, {_s[2]}), ({_s[1]}, {_s[2]})) v(pu, pn))',
    """
pp AS (SELECT a.user_id AS "user", b.user_id AS neighbor, a.rating AS x, b.rating AS y
       FROM ratings a JOIN ratings b ON a.item_id = b.item_id
       JOIN pl ON pl.pu = a.user_id AND pl.pn = b.user_id)""",
    moments_sql("pp", "m", ""),
    f"""
c AS (SELECT "user", neighbor, n,
             round(CASE WHEN n * sum_x2 - sum_x * sum_x > 0 AND n * sum_y2 - sum_y * sum_y > 0
                   THEN CAST(n * sum_xy - sum_x * sum_y AS DOUBLE)
                        / (sqrt(CAST(n * sum_x2 - sum_x * sum_x AS DOUBLE))
                           * sqrt(CAST(n * sum_y2 - sum_y * sum_y AS DOUBLE))) END, {K.CORR_DIGITS}) AS corr
      FROM m)""") + "SELECT * FROM c"

# --- text ingestion and versioned sinks ----------------------------------------

ORACLE["scan_ratings_text"] = with_(RATINGS) + f"""
SELECT CAST(item_id AS VARCHAR) || ':' AS user_raw, CAST(NULL AS INTEGER) AS rating,
       CAST(NULL AS DATE) AS rated_on
FROM (SELECT DISTINCT item_id, (user_id % {K.BLOCK_PIECES} + {K.BLOCK_PIECES}) % {K.BLOCK_PIECES} FROM ratings) h
UNION ALL
SELECT CAST(user_id AS VARCHAR), rating, CAST(rated_at AS DATE) FROM ratings"""
ORACLE["split_line_fields"] = with_(RATINGS) + f"""
SELECT CAST(item_id AS VARCHAR) || ':' AS user_raw, CAST(NULL AS VARCHAR) AS rating_raw,
       CAST(NULL AS VARCHAR) AS date_raw
FROM (SELECT DISTINCT item_id, (user_id % {K.BLOCK_PIECES} + {K.BLOCK_PIECES}) % {K.BLOCK_PIECES} FROM ratings) h
UNION ALL
SELECT CAST(user_id AS VARCHAR), CAST(rating AS VARCHAR), strftime(rated_at, '%Y-%m-%d') FROM ratings"""
ORACLE["parse_header_blocks"] = with_(RATINGS) + """
SELECT CAST(user_id AS VARCHAR) AS user_raw, rating, CAST(rated_at AS DATE) AS rated_on,
       CAST(item_id AS VARCHAR) AS item_raw
FROM ratings"""
ORACLE["parse_header_cumsum"] = ORACLE["parse_header_blocks"]
ORACLE["silver_rejects"] = with_(RATINGS) + """
SELECT CASE WHEN rating = 3 THEN user_id END AS user_id, item_id, CASE WHEN rating <> 3 THEN rating END AS rating,
       CAST(rated_at AS DATE) AS rated_at
FROM ratings WHERE rating <= 3"""
ORACLE["peek_raw_lines"] = with_(RATINGS) + f"""
SELECT value, CAST(len(string_split(value, ',')) AS INTEGER) AS fields FROM (
  SELECT CAST(item_id AS VARCHAR) || ':' AS value
  FROM (SELECT DISTINCT item_id, (user_id % {K.BLOCK_PIECES} + {K.BLOCK_PIECES}) % {K.BLOCK_PIECES} FROM ratings) h
  UNION ALL
  SELECT user_id || ',' || rating || ',' || strftime(rated_at, '%Y-%m-%d') FROM ratings) l
ORDER BY value LIMIT 10"""
ORACLE["silver_ratings"] = with_(RATINGS) + """
SELECT user_id, item_id, rating, CAST(rated_at AS DATE) AS rated_at FROM ratings"""
ORACLE["scan_items_csv"] = with_(RATINGS, ITEMS) + """
SELECT CAST(item_id AS INT) AS item_id, CAST(year AS SMALLINT) AS year, title FROM items"""
ORACLE["silver_items"] = ORACLE["scan_items_csv"]
_STATS_COLS = f"""user_id, {r('mean_rating')}, {r('std_rating')}, max_rating, min_rating, rated_items"""
_OLD_STATS = f"""
old_stats AS (
  SELECT user_id, avg(rating) AS mean_rating, stddev_pop(rating) AS std_rating,
         max(rating) AS max_rating, min(rating) AS min_rating, CAST(count(*) AS BIGINT) AS rated_items
  FROM ratings WHERE rated_at < TIMESTAMP '{K.DEFAULT_VERSION_OLD} 00:00:00' GROUP BY user_id)"""
ORACLE["latest_version"] = with_(RATINGS, STATS) + f"""
SELECT {_STATS_COLS}, DATE '{K.DEFAULT_VERSION_NEW}' AS version_date FROM stats"""
ORACLE["merged_stats"] = ORACLE["latest_version"]
ORACLE["stored_normalized"] = ORACLE["normalize_ratings"]
ORACLE["silver_counts"] = with_(RATINGS) + """
SELECT count(*) AS lines, CAST(count(*) FILTER (rating > 3) AS BIGINT) AS valid,
       CAST(count(*) FILTER (rating <= 3) AS BIGINT) AS rejected FROM ratings"""
ORACLE["users_page_seek"] = with_(RATINGS) + f"""
SELECT user_id, CAST((rank - 1) // {PS} + 1 AS BIGINT) AS page
FROM (SELECT user_id, row_number() OVER (ORDER BY user_id) AS rank, count(*) OVER () AS total
      FROM (SELECT DISTINCT user_id FROM ratings) u) t
WHERE (rank - 1) // {PS} = (total - 1) // {PS}"""
ORACLE["versioned_stats"] = with_(RATINGS, STATS, _OLD_STATS) + f"""
SELECT {_STATS_COLS}, DATE '{K.DEFAULT_VERSION_OLD}' AS version_date FROM old_stats
UNION ALL
SELECT {_STATS_COLS}, DATE '{K.DEFAULT_VERSION_NEW}' AS version_date FROM stats"""
def old_ctes() -> tuple[str, ...]:
    """TRAIN over the ratings before the old date, every name with ``_old``."""
    out = []
    for cte in TRAIN:
        for name in ("ratings", "blocked", "pairs", "moments", "corrs", "sym", "topk"):
            cte = re.sub(rf"\b{name}\b", f"{name}_old", cte)
        out.append(cte.replace("WHERE rn = 1", f"WHERE rn = 1 AND rated_at < TIMESTAMP '{K.DEFAULT_VERSION_OLD} 00:00:00'"))
    return tuple(out)


ORACLE["versioned_neighbors"] = with_(*TRAIN, *old_ctes()) + f"""
SELECT "user", neighbor, corr, DATE '{K.DEFAULT_VERSION_NEW}' AS version_date FROM topk
UNION ALL
SELECT "user", neighbor, corr, DATE '{K.DEFAULT_VERSION_OLD}' FROM topk_old"""
ORACLE["ingest_new_files"] = with_(RATINGS) + f"""
SELECT user_id, item_id, rating, CAST(rated_at AS DATE) AS rated_at,
       CASE WHEN rated_at < TIMESTAMP '{K.DEFAULT_VERSION_OLD} 00:00:00' THEN 0 ELSE 1 END AS run
FROM ratings"""
ORACLE["recommend_for_users"] = with_(*PRED, RECS) + f"""
SELECT "user", item_id, score, corr_sum, support, {r('raw_rating')},
       {r('user_mean')}, {r('rating')} FROM recs WHERE "user" IN ({SUBJ})"""
ORACLE["recommend_stored_model"] = ORACLE["recommend_all"]
ORACLE["users_pages_all"] = with_(RATINGS) + f"""
SELECT user_id, rank, page, {PS} AS page_size, total AS total_users,
       (total + {PS - 1}) // {PS} AS total_pages,
       (page - 1) * {PS} + {PS} < total AS has_next, (page - 1) * {PS} > 0 AS has_prev
FROM (SELECT user_id, rank, CAST(ceil(rank / {PS}.0) AS INTEGER) AS page, total
      FROM (SELECT user_id, row_number() OVER (ORDER BY user_id) AS rank,
                   count(*) OVER () AS total
            FROM (SELECT DISTINCT user_id FROM ratings) u) a) b"""
ORACLE["versioned_recommendations"] = with_(*PRED, RECS) + f"""
SELECT "user", item_id, {r('rating')}, DATE '{K.DEFAULT_VERSION_NEW}' AS version_date FROM recs"""
