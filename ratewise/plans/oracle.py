"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Each query is the bridge CTEs it needs plus a body.  Rounding and types
mirror the Spark side: doubles rounded to 6 digits, counts BIGINT, ranks
INTEGER.
"""

from __future__ import annotations

from ratewise.plans.bridge import PART_TAGS

# -- bridge CTEs, in dependency order ---------------------------------------------------

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = sql
    DEPS[name] = deps or []


cte("interactions", """
SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id,
       CAST(ceil(l.l_quantity / 10) AS INTEGER) AS rating,
       CAST(epoch(o.o_orderdate) AS BIGINT) AS "timestamp",
       l.l_orderkey, l.l_linenumber, l.l_quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

cte("clean", """
SELECT user_id, movie_id, rating, "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, movie_id
                               ORDER BY "timestamp", l_orderkey, l_linenumber, l_quantity) AS rn_
  FROM interactions
  WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL
    AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL
    AND rating BETWEEN 1 AND 5)
WHERE rn_ = 1""", ["interactions"])

cte("split", """
SELECT user_id, movie_id, rating, "timestamp",
       rn_ > n_ - greatest(1, CAST(round_even(n_ * 0.2, 0) AS BIGINT)) AS is_test
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", movie_id) AS rn_,
             count(*) OVER (PARTITION BY user_id) AS n_ FROM clean)""", ["clean"])

cte("train", "SELECT user_id, movie_id, rating, \"timestamp\" FROM split WHERE NOT is_test", ["split"])
cte("test", "SELECT user_id, movie_id, rating, \"timestamp\" FROM split WHERE is_test", ["split"])
cte("mean", "SELECT avg(rating) AS g FROM train", ["train"])
cte("item_bias", "SELECT movie_id, sum(rating - g) / (10.0 + count(*)) AS b FROM train CROSS JOIN mean GROUP BY movie_id",
    ["train", "mean"])
cte("rel", "SELECT DISTINCT user_id, movie_id FROM test WHERE rating >= 4", ["test"])

cte("items", """
SELECT p_partkey AS movie_id,
       CASE WHEN p_size % 2 = 0 THEN p_name || ' (' || CAST(1990 + p_size AS VARCHAR) || ')' ELSE p_name END AS title,
       replace(p_name, ' ', '|') AS genres
FROM part""")

cte("users", "SELECT c_custkey AS user_id, c_mktsegment AS segment, c_nationkey AS nation FROM customer")

RELEASE_YEAR = r"CAST(NULLIF(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') AS INTEGER)"
FLAGS = ",\n       ".join(
    f"CAST(coalesce(list_contains(string_split(genres, '|'), '{t}'), false) AS INTEGER) AS genre_{t}"
    for t in PART_TAGS)

cte("movie_dim", f"SELECT movie_id, title, genres, {RELEASE_YEAR} AS release_year,\n       {FLAGS}\nFROM items",
    ["items"])

cte("features", """
SELECT c.user_id, c.movie_id, c.rating, c."timestamp",
       CAST(year(epoch_ms(c."timestamp" * 1000)) AS INTEGER) AS rating_year,
       coalesce(ms.movie_rating_count, 0) AS movie_rating_count,
       coalesce(ms.movie_avg_rating, 0.0) AS movie_avg_rating,
       coalesce(us.user_rating_count, 0) AS user_rating_count,
       coalesce(us.user_avg_rating, 0.0) AS user_avg_rating,
       m.* EXCLUDE (movie_id, release_year), coalesce(m.release_year, 0) AS release_year,
       u.segment, u.nation
FROM clean c
LEFT JOIN (SELECT movie_id, count(rating) AS movie_rating_count, avg(rating) AS movie_avg_rating
           FROM clean GROUP BY movie_id) ms USING (movie_id)
LEFT JOIN (SELECT user_id, count(rating) AS user_rating_count, avg(rating) AS user_avg_rating
           FROM clean GROUP BY user_id) us USING (user_id)
JOIN movie_dim m ON m.movie_id = c.movie_id
JOIN users u ON u.user_id = c.user_id""", ["clean", "movie_dim", "users"])

cte("pop_train", """
SELECT movie_id, mean, cnt, row_number() OVER (ORDER BY mean DESC, movie_id) AS pos
FROM (SELECT movie_id, avg(rating) AS mean, count(*) AS cnt FROM train GROUP BY movie_id)
WHERE cnt >= 20""", ["train"])

cte("pop_recs", """
SELECT user_id, movie_id, CAST(rank_ AS INTEGER) AS rank, mean AS score FROM (
  SELECT u.user_id, p.movie_id, p.mean,
         row_number() OVER (PARTITION BY u.user_id ORDER BY p.pos) AS rank_
  FROM (SELECT DISTINCT user_id FROM rel) u CROSS JOIN pop_train p
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.movie_id = p.movie_id))
WHERE rank_ <= 10""", ["rel", "pop_train", "train"])


def with_ctes(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {parts}\n{body.strip()}"


# -- queries --------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["feature_table"] = with_ctes("""
SELECT * REPLACE (round(movie_avg_rating, 6) AS movie_avg_rating, round(user_avg_rating, 6) AS user_avg_rating)
FROM features""", "features")

SQL["clean_ratings_audit"] = with_ctes("""
SELECT 'ratings' AS table_name, step, stage, rows FROM (
  SELECT 0 AS step, 'raw' AS stage, count(*) AS rows FROM interactions
  UNION ALL
  SELECT 1, 'complete', count(*) FROM interactions
   WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL
     AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL
  UNION ALL
  SELECT 2, 'rating_in_range', count(*) FROM interactions
   WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL
     AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity IS NOT NULL
     AND rating BETWEEN 1 AND 5
  UNION ALL
  SELECT 3, 'deduplicated', count(*) FROM clean)""", "interactions", "clean")

SQL["parse_delimited"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders"""

SQL["release_year"] = with_ctes(f"SELECT movie_id, title, {RELEASE_YEAR} AS release_year FROM items", "items")

SQL["multi_hot_tags"] = with_ctes(
    "SELECT movie_id, " + ", ".join(f"genre_{t}" for t in PART_TAGS) + " FROM movie_dim", "movie_dim")

SQL["movie_stats"] = with_ctes("""
SELECT movie_id, count(rating) AS movie_rating_count, round(avg(rating), 6) AS movie_avg_rating
FROM clean GROUP BY movie_id""", "clean")

SQL["user_stats"] = with_ctes("""
SELECT user_id, count(rating) AS user_rating_count, round(avg(rating), 6) AS user_avg_rating
FROM clean GROUP BY user_id""", "clean")

SQL["rating_year_hist"] = with_ctes("""
SELECT CAST(year(epoch_ms("timestamp" * 1000)) AS INTEGER) AS rating_year, count(*) AS ratings,
       round(avg(rating), 6) AS avg_rating
FROM clean GROUP BY 1""", "clean")

SQL["null_audit"] = with_ctes("""
SELECT count(*) AS rows,
       CAST(sum((user_id IS NULL)::INT + (movie_id IS NULL)::INT + (rating IS NULL)::INT
           + ("timestamp" IS NULL)::INT + (rating_year IS NULL)::INT + (movie_rating_count IS NULL)::INT
           + (movie_avg_rating IS NULL)::INT + (user_rating_count IS NULL)::INT + (user_avg_rating IS NULL)::INT
           + (title IS NULL)::INT + (genres IS NULL)::INT + (release_year IS NULL)::INT
           + (segment IS NULL)::INT + (nation IS NULL)::INT) AS BIGINT) AS null_cells
FROM features""", "features")

SQL["catalog_distinct"] = with_ctes("SELECT movie_id, min(title) AS title FROM features GROUP BY movie_id",
                                    "features")

SQL["temporal_split"] = with_ctes("SELECT * FROM split", "split")
SQL["seen_items_long"] = with_ctes("SELECT DISTINCT user_id, movie_id FROM train", "train")
SQL["relevant_items_long"] = with_ctes("SELECT * FROM rel", "rel")

SQL["popularity_rank"] = with_ctes("""
SELECT movie_id, round(mean, 6) AS mean, rating_count,
       CAST(row_number() OVER (ORDER BY mean DESC, movie_id) AS INTEGER) AS pos
FROM (SELECT movie_id, avg(rating) AS mean, count(*) AS rating_count FROM clean GROUP BY movie_id)
WHERE rating_count >= 20""", "clean")

SQL["popularity_recommend"] = with_ctes(
    "SELECT user_id, movie_id, rank, round(score, 6) AS score FROM pop_recs", "pop_recs")

SQL["popularity_rating_error"] = with_ctes("""
SELECT round(sqrt(avg(power(t.rating - coalesce(im.m, gm.g), 2))), 6) AS rmse,
       round(avg(abs(t.rating - coalesce(im.m, gm.g))), 6) AS mae,
       count(*) AS n
FROM test t
LEFT JOIN (SELECT movie_id, avg(rating) AS m FROM train GROUP BY movie_id) im USING (movie_id)
CROSS JOIN (SELECT avg(rating) AS g FROM train) gm""", "test", "train")

SQL["popularity_ranking_metrics"] = with_ctes("""
SELECT round(coalesce(avg(CASE WHEN n_recs > 0 THEN hits / n_recs ELSE 0.0 END), 0.0), 6) AS precision_at_10,
       round(coalesce(avg(hits / n_relevant), 0.0), 6) AS recall_at_10,
       count(*) AS n_users
FROM (
  SELECT a.user_id, a.n_relevant, coalesce(b.n_recs, 0) AS n_recs, coalesce(c.hits, 0) AS hits
  FROM (SELECT user_id, count(*) AS n_relevant FROM rel GROUP BY user_id) a
  LEFT JOIN (SELECT user_id, count(*) AS n_recs FROM pop_recs GROUP BY user_id) b USING (user_id)
  LEFT JOIN (SELECT r.user_id, count(*) AS hits FROM pop_recs r JOIN rel USING (user_id, movie_id)
             GROUP BY r.user_id) c USING (user_id))""", "rel", "pop_recs")


# -- event log, concentration, drift -----------------------------------------------------

cte("events_log", """
SELECT CAST(epoch(o.o_orderdate) AS DOUBLE) AS "timestamp", o.o_custkey AS user_id,
       CAST(count(*) AS INTEGER) AS k, CAST(count(*) AS INTEGER) AS num_recommendations,
       list_sort(list(l.l_partkey)) AS movie_ids, o.o_totalprice / 1000 AS latency_ms
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_orderdate, o.o_custkey, o.o_totalprice""")

cte("rec_ids", "SELECT unnest(movie_ids) AS movie_id FROM events_log", ["events_log"])

cte("mstats", """
SELECT movie_id, min(movie_rating_count) AS movie_rating_count, min(movie_avg_rating) AS movie_avg_rating
FROM features GROUP BY movie_id""", ["features"])

cte("cur_pop", """
SELECT s.movie_rating_count, s.movie_avg_rating FROM rec_ids r JOIN mstats s USING (movie_id)""",
    ["rec_ids", "mstats"])

cte("freq", "SELECT movie_id, count(*) AS count FROM rec_ids GROUP BY movie_id", ["rec_ids"])

cte("conc", """
SELECT CAST(coalesce(sum(count), 0) AS BIGINT) AS total, count(*) AS distinct_items,
       CAST(coalesce(max(count), 0) AS BIGINT) AS top_count,
       CASE WHEN coalesce(sum(count), 0) > 0 THEN max(count) / sum(count) ELSE 0.0 END AS top_movie_share
FROM freq""", ["freq"])

cte("pops", """
SELECT 'movie_rating_count' AS feature, CAST(movie_rating_count AS DOUBLE) AS value, 'ref' AS origin FROM mstats
UNION ALL SELECT 'movie_avg_rating', movie_avg_rating, 'ref' FROM mstats
UNION ALL SELECT 'movie_rating_count', CAST(movie_rating_count AS DOUBLE), 'cur' FROM cur_pop
UNION ALL SELECT 'movie_avg_rating', movie_avg_rating, 'cur' FROM cur_pop""", ["mstats", "cur_pop"])

cte("drift_totals", """
SELECT feature, count(*) FILTER (WHERE origin = 'ref') AS n_ref, count(*) FILTER (WHERE origin = 'cur') AS n_cur,
       stddev_pop(value) FILTER (WHERE origin = 'ref') AS ref_std,
       min(value) FILTER (WHERE origin = 'ref') AS ref_min, max(value) FILTER (WHERE origin = 'ref') AS ref_max
FROM pops GROUP BY feature""", ["pops"])

cte("drift_pv", """
SELECT s.feature, t.n_ref, t.n_cur, t.ref_std, s.r, s.c,
       abs(s.cum_r / t.n_ref - s.cum_c / t.n_cur) AS gap,
       abs(s.cum_r / t.n_ref - s.cum_c / t.n_cur) * coalesce(s.next_value - s.value, 0.0) AS area,
       CASE WHEN t.ref_max - t.ref_min > 0
            THEN least(9, greatest(0, floor((s.value - t.ref_min) / (t.ref_max - t.ref_min) * 10))) ELSE 0 END AS bin
FROM (SELECT feature, value, r, c,
             sum(r) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum_r,
             sum(c) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum_c,
             lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value
      FROM (SELECT feature, value, count(*) FILTER (WHERE origin = 'ref') AS r,
                   count(*) FILTER (WHERE origin = 'cur') AS c
            FROM pops GROUP BY feature, value)) s
JOIN drift_totals t USING (feature)""", ["pops", "drift_totals"])

cte("drift_tests", """
SELECT feature, n_ref, n_cur, ks,
       CASE WHEN lam < 0.2 THEN 1.0
            ELSE least(1.0, greatest(0.0, 2.0 * (SELECT sum(power(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))
                                                 FROM range(1, 101) rr(j)))) END AS ks_pvalue,
       wasserstein,
       CASE WHEN ref_std > 0 THEN wasserstein / ref_std ELSE wasserstein END AS wasserstein_norm,
       coalesce(psi, 0.0) AS psi,
       CASE WHEN n_ref <= 1000 THEN 'ks' ELSE 'wasserstein' END AS method
FROM (
  SELECT a.*, p.psi,
         (sqrt(a.n_ref * a.n_cur / (a.n_ref + a.n_cur)) + 0.12
          + 0.11 / sqrt(a.n_ref * a.n_cur / (a.n_ref + a.n_cur))) * a.ks AS lam
  FROM (SELECT feature, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur, max(gap) AS ks,
               sum(area) AS wasserstein, any_value(ref_std) AS ref_std
        FROM drift_pv GROUP BY feature) a
  LEFT JOIN (SELECT feature, sum((pc - pr) * ln(pc / pr)) AS psi FROM (
               SELECT feature, greatest(sum(r) / any_value(n_ref), 1e-4) AS pr,
                      greatest(sum(c) / any_value(n_cur), 1e-4) AS pc
               FROM drift_pv GROUP BY feature, bin) GROUP BY feature) p USING (feature))""", ["drift_pv"])

cte("drift_verdicts", """
SELECT *, (CASE WHEN method = 'ks' THEN ks_pvalue < 0.05 ELSE wasserstein_norm >= 0.1 END) AND n_cur > 0 AS drifted
FROM drift_tests""", ["drift_tests"])

cte("drift_state", """
SELECT CASE WHEN n_samples >= 30 THEN n_drifted / 2.0 >= 0.5 ELSE false END AS dataset_drift,
       CASE WHEN n_samples >= 30 THEN n_drifted / 2.0 ELSE 0.0 END AS drift_share,
       CAST(CASE WHEN n_samples >= 30 THEN n_drifted ELSE 0 END AS INTEGER) AS number_of_drifted_columns,
       n_samples,
       CASE WHEN n_samples >= 30 THEN 'ok' ELSE 'insufficient_data' END AS status
FROM (SELECT CAST(coalesce(max(n_cur), 0) AS BIGINT) AS n_samples, count(*) FILTER (WHERE drifted) AS n_drifted
      FROM drift_verdicts)""", ["drift_verdicts"])

SQL["rec_frequency"] = with_ctes("SELECT * FROM freq", "freq")
SQL["rec_concentration"] = with_ctes(
    "SELECT total, distinct_items, top_count, round(top_movie_share, 6) AS top_movie_share FROM conc", "conc")
SQL["drift_populations"] = with_ctes("""
SELECT 'reference' AS origin, movie_rating_count, round(movie_avg_rating, 6) AS movie_avg_rating FROM mstats
UNION ALL
SELECT 'current', movie_rating_count, round(movie_avg_rating, 6) FROM cur_pop""", "mstats", "cur_pop")
SQL["drift_ks"] = with_ctes(
    "SELECT feature, n_ref, n_cur, round(ks, 6) AS ks, round(ks_pvalue, 6) AS ks_pvalue FROM drift_verdicts",
    "drift_verdicts")
SQL["drift_wasserstein"] = with_ctes("""
SELECT feature, round(wasserstein, 6) AS wasserstein, round(wasserstein_norm, 6) AS wasserstein_norm,
       method, drifted FROM drift_verdicts""", "drift_verdicts")
SQL["drift_psi"] = with_ctes("SELECT feature, round(psi, 6) AS psi FROM drift_verdicts", "drift_verdicts")
SQL["drift_from_summaries"] = with_ctes("""
SELECT feature, (SELECT count(DISTINCT year(o_orderdate)) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS batches,
       n_ref, n_cur, round(psi, 6) AS psi, TRUE AS ks_within_bound FROM drift_verdicts""", "drift_verdicts")
SQL["drift_status"] = with_ctes("""
SELECT dataset_drift, round(drift_share, 6) AS drift_share, number_of_drifted_columns, n_samples, status
FROM drift_state""", "drift_state")
SQL["monitoring_snapshot"] = with_ctes("""
SELECT CAST(CASE WHEN d.dataset_drift THEN 1 ELSE 0 END AS INTEGER) AS dataset_drift,
       round(d.drift_share, 6) AS drift_share, d.n_samples AS drift_samples,
       round(c.top_movie_share, 6) AS top_movie_share
FROM drift_state d, conc c""", "drift_state", "conc")

# -- requests and serving ----------------------------------------------------------------

cte("requests", """
SELECT event_id, ts, user_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       value AS latency_ms, event_type AS handler, event_type = 'error' AS is_error
FROM events""")

cte("checked", """
SELECT * REPLACE (CAST(coalesce(k, 10) AS INTEGER) AS k),
       coalesce(k, 10) BETWEEN 1 AND 100 AS valid,
       CASE WHEN coalesce(k, 10) BETWEEN 1 AND 100 THEN 'ok' ELSE 'k must be between 1 and 100' END AS reason,
       CASE WHEN NOT (coalesce(k, 10) BETWEEN 1 AND 100) THEN '4xx' WHEN is_error THEN '5xx' ELSE '2xx' END AS status
FROM requests""", ["requests"])

SQL["request_validation"] = with_ctes("SELECT event_id, user_id, k, valid, reason FROM checked", "checked")

SQL["request_rate"] = with_ctes("""
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
       time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
       handler, count(*) AS requests, round(count(*) / 60.0, 6) AS rate_per_s
FROM requests GROUP BY 1, 2, 3""", "requests")

SQL["error_rate"] = with_ctes("""
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
       time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
       status, count(*) AS errors, round(count(*) / 60.0, 6) AS rate_per_s
FROM checked WHERE status <> '2xx' GROUP BY 1, 2, 3""", "checked")

SQL["latency_quantiles"] = with_ctes("""
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       count(*) AS requests, round(quantile_disc(latency_ms, 0.5), 6) AS p50_ms,
       round(quantile_disc(latency_ms, 0.95), 6) AS p95_ms
FROM requests GROUP BY 1, 2""", "requests")

SQL["request_volume"] = with_ctes("""
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       count(*) AS requests, count(*) FILTER (WHERE valid) AS served_requests,
       CAST(coalesce(sum(k) FILTER (WHERE valid), 0) AS BIGINT) AS recommended_items
FROM checked GROUP BY 1, 2""", "checked")

SQL["title_lookup"] = with_ctes("""
SELECT e."timestamp", e.user_id, CAST(x.rank AS INTEGER) AS rank, x.movie_id,
       coalesce(i.title, 'Unknown title') AS title
FROM events_log e,
     LATERAL (SELECT unnest(e.movie_ids) AS movie_id, unnest(range(1, len(e.movie_ids) + 1)) AS rank) x
LEFT JOIN items i ON i.movie_id = x.movie_id""", "events_log", "items")

cte("pop_all", """
SELECT movie_id, row_number() OVER (ORDER BY mean DESC, movie_id) AS pos
FROM (SELECT movie_id, avg(rating) AS mean, count(*) AS cnt FROM clean GROUP BY movie_id) WHERE cnt >= 20""",
    ["clean"])

SQL["batch_serve"] = with_ctes("""
SELECT c.event_id, c.user_id, c.k, CAST(p.pos AS INTEGER) AS rank, p.movie_id,
       coalesce(i.title, 'Unknown title') AS title
FROM checked c JOIN pop_all p ON p.pos <= c.k
LEFT JOIN items i ON i.movie_id = p.movie_id
WHERE c.valid""", "checked", "pop_all", "items")

SQL["factor_topk"] = """
SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM (
  SELECT u.vec_id AS user_id, i.vec_id AS item_id,
         list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score,
         row_number() OVER (PARTITION BY u.vec_id
                            ORDER BY list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) DESC,
                                     i.vec_id) AS rank
  FROM embeddings u JOIN embeddings i ON u.vec_id <> i.vec_id)
WHERE rank <= 10"""
SQL["factor_topk_by_norm"] = SQL["factor_topk"]

# -- model runs ---------------------------------------------------------------------------


def _pop_run(m: int) -> str:
    return f"""
  SELECT {m} AS min_ratings,
         (SELECT coalesce(avg(CASE WHEN n_recs > 0 THEN hits / n_recs ELSE 0.0 END), 0.0) FROM per_{m}) AS precision_at_10,
         (SELECT coalesce(avg(hits / n_relevant), 0.0) FROM per_{m}) AS recall_at_10,
         (SELECT sqrt(avg(power(t.rating - coalesce(im.m, gm.g), 2)))
            FROM test t LEFT JOIN (SELECT movie_id, avg(rating) AS m FROM train GROUP BY movie_id) im USING (movie_id)
            CROSS JOIN (SELECT avg(rating) AS g FROM train) gm) AS rmse,
         (SELECT avg(abs(t.rating - coalesce(im.m, gm.g)))
            FROM test t LEFT JOIN (SELECT movie_id, avg(rating) AS m FROM train GROUP BY movie_id) im USING (movie_id)
            CROSS JOIN (SELECT avg(rating) AS g FROM train) gm) AS mae"""


def _pop_per(m: int) -> str:
    return f"""per_{m} AS (
  WITH pt AS (SELECT movie_id, mean, row_number() OVER (ORDER BY mean DESC, movie_id) AS pos
              FROM (SELECT movie_id, avg(rating) AS mean, count(*) AS cnt FROM train GROUP BY movie_id)
              WHERE cnt >= {m}),
       recs AS (SELECT user_id, movie_id FROM (
                  SELECT u.user_id, p.movie_id,
                         row_number() OVER (PARTITION BY u.user_id ORDER BY p.pos) AS rank_
                  FROM (SELECT DISTINCT user_id FROM rel) u CROSS JOIN pt p
                  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.movie_id = p.movie_id))
                WHERE rank_ <= 10)
  SELECT a.user_id, a.n_relevant, coalesce(b.n_recs, 0) AS n_recs, coalesce(c.hits, 0) AS hits
  FROM (SELECT user_id, count(*) AS n_relevant FROM rel GROUP BY user_id) a
  LEFT JOIN (SELECT user_id, count(*) AS n_recs FROM recs GROUP BY user_id) b USING (user_id)
  LEFT JOIN (SELECT r.user_id, count(*) AS hits FROM recs r JOIN rel USING (user_id, movie_id)
             GROUP BY r.user_id) c USING (user_id))"""


SWEEP = (1, 5, 10, 20, 40)
_runs_body = " UNION ALL ".join(
    f"SELECT 'run-{i:03d}' AS run_id, 'popularity_baseline' AS family, CAST({i} AS BIGINT) AS start_time, *"
    f" FROM ({_pop_run(m)})" for i, m in enumerate(SWEEP))
_runs_sql = with_ctes("SELECT 1", "rel", "train", "test").replace("\nSELECT 1", "")
_runs_ctes = _runs_sql + ",\n" + ",\n".join(_pop_per(m) for m in SWEEP) + \
    f",\nruns AS ({_runs_body})\n"

SQL["evaluation_runs"] = _runs_ctes + """
SELECT run_id, family, start_time, CAST(min_ratings AS INTEGER) AS min_ratings,
       round(precision_at_10, 6) AS precision_at_10, round(recall_at_10, 6) AS recall_at_10,
       round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM runs"""

SQL["latest_run_per_family"] = _runs_ctes + """
SELECT run_id, family, start_time, round(recall_at_10, 6) AS recall_at_10 FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY start_time DESC, run_id DESC) AS rn_
  FROM (SELECT * FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 50) WHERE family IS NOT NULL)
WHERE rn_ = 1"""

SQL["best_model"] = _runs_ctes + """
SELECT run_id, family, round(recall_at_10, 6) AS recall_at_10 FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY start_time DESC, run_id DESC) AS rn_
  FROM (SELECT * FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 50) WHERE family IS NOT NULL)
WHERE rn_ = 1 AND recall_at_10 IS NOT NULL
ORDER BY recall_at_10 DESC, start_time DESC, run_id DESC LIMIT 1"""


_HISTORY = """
WITH runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS family, CAST(epoch(o_orderdate) AS BIGINT) AS start_time,
                     CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1e6 END AS recall, year(o_orderdate) AS y FROM orders),
ys AS (SELECT DISTINCT y AS upto FROM runs),
recent AS (SELECT *, row_number() OVER (PARTITION BY upto ORDER BY start_time DESC, run_id DESC) AS place
           FROM ys JOIN runs ON y <= upto),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upto, family ORDER BY start_time DESC, run_id DESC) AS of_family
                          FROM recent WHERE place <= 50) WHERE of_family = 1 AND family IS NOT NULL),
best AS (SELECT *, row_number() OVER (PARTITION BY upto ORDER BY recall DESC, start_time DESC, run_id DESC) AS b
         FROM latest WHERE recall IS NOT NULL),
chosen AS (SELECT *, lag(run_id) OVER (ORDER BY upto) AS previous FROM best WHERE b = 1)
"""
SQL["latest_runs_of_history"] = _HISTORY + """
SELECT run_id, family, start_time, round(recall, 6) AS recall_at_10 FROM latest WHERE upto = (SELECT max(upto) FROM ys)"""
SQL["selection_versions"] = _HISTORY + """
SELECT CAST(row_number() OVER (ORDER BY upto) AS INTEGER) AS version, previous, run_id, family, start_time,
       round(recall, 6) AS recall_at_10 FROM chosen WHERE previous IS DISTINCT FROM run_id"""

# -- streaming and manifests ---------------------------------------------------------------

SQL["stream_drain"] = with_ctes("""
SELECT "timestamp", user_id, k, num_recommendations, movie_ids, round(latency_ms, 6) AS latency_ms
FROM events_log""", "events_log")

SQL["stream_request_rate"] = with_ctes("""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
         time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
         handler, count(*) AS requests, round(count(*) / 60.0, 6) AS rate_per_s
  FROM requests GROUP BY 1, 2, 3)
WHERE window_end <= (SELECT max(ts) FROM requests) - INTERVAL '10 minutes'""", "requests")

# The driver checks at sf0.01; the manifest reads the table files themselves.
SQL["dataset_manifest"] = """
SELECT regexp_extract(filename, '([^/]+)$', 1) AS file, size AS bytes, md5(content) AS md5
FROM read_blob('/root/testdata/sf0.01/*.parquet')"""


SQL["bm25_confidence"] = with_ctes("""
SELECT t.user_id, t.movie_id, t.rating,
       round((ln(n.n_users) - ln(1 + i.df_)) * t.rating * 101.0
             / (t.rating + 100.0 * (0.2 + 0.8 * u.len_ / a.avg_len)), 6) AS weight
FROM train t
JOIN (SELECT movie_id, count(DISTINCT user_id) AS df_ FROM train GROUP BY movie_id) i USING (movie_id)
JOIN (SELECT user_id, sum(rating) AS len_ FROM train GROUP BY user_id) u USING (user_id)
CROSS JOIN (SELECT count(DISTINCT user_id) AS n_users FROM train) n
CROSS JOIN (SELECT avg(len_) AS avg_len FROM (SELECT sum(rating) AS len_ FROM train GROUP BY user_id)) a""",
    "train")


# -- the served log: popularity top-10 for every user, seen items excluded ----------------

cte("pop_clean", """
SELECT movie_id, mean, row_number() OVER (ORDER BY mean DESC, movie_id) AS pos
FROM (SELECT movie_id, avg(rating) AS mean, count(*) AS cnt FROM clean GROUP BY movie_id) WHERE cnt >= 20""",
    ["clean"])

cte("served_ids", """
SELECT movie_id FROM (
  SELECT u.user_id, p.movie_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p.pos) AS rk
  FROM (SELECT DISTINCT user_id FROM clean) u CROSS JOIN pop_clean p
  WHERE NOT EXISTS (SELECT 1 FROM clean t WHERE t.user_id = u.user_id AND t.movie_id = p.movie_id))
WHERE rk <= 10""", ["clean", "pop_clean"])


def _copy_chain(suffix: str, ids: str) -> None:
    """Register the concentration / drift CTEs again over another id source."""
    chain = ["cur_pop", "freq", "conc", "pops", "drift_totals", "drift_pv", "drift_tests", "drift_verdicts",
             "drift_state"]
    for name in chain:
        body = CTES[name]
        deps = []
        for d in DEPS[name]:
            if d == "rec_ids":
                deps.append(ids)
            elif d in chain:
                deps.append(d + suffix)
            else:
                deps.append(d)
        for other in sorted(chain, key=len, reverse=True):
            body = _rename(body, other, other + suffix)
        body = _rename(body, "rec_ids", ids)
        cte(name + suffix, body, deps)


def _rename(sql: str, old: str, new: str) -> str:
    import re
    return re.sub(rf"\b{old}\b", new, sql)


_copy_chain("_served", "served_ids")

SQL["served_concentration"] = with_ctes(
    "SELECT total, distinct_items, top_count, round(top_movie_share, 6) AS top_movie_share FROM conc_served",
    "conc_served")
SQL["served_drift_status"] = with_ctes("""
SELECT dataset_drift, round(drift_share, 6) AS drift_share, number_of_drifted_columns, n_samples, status
FROM drift_state_served""", "drift_state_served")
SQL["served_drift_tests"] = with_ctes("""
SELECT feature, n_ref, n_cur, round(ks, 6) AS ks, round(ks_pvalue, 6) AS ks_pvalue, round(wasserstein, 6) AS wasserstein,
       round(wasserstein_norm, 6) AS wasserstein_norm, round(psi, 6) AS psi, method, drifted
FROM drift_verdicts_served""", "drift_verdicts_served")

SQL["stream_concentration"] = SQL["rec_frequency"]

SQL["stream_latency"] = with_ctes("""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
         time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
         count(*) AS requests, round(quantile_disc(latency_ms, 0.5), 6) AS p50_ms,
         round(quantile_disc(latency_ms, 0.95), 6) AS p95_ms
  FROM requests GROUP BY 1, 2)
WHERE window_end <= (SELECT max(ts) FROM requests) - INTERVAL '10 minutes'""", "requests")

CLOSED = "WHERE window_end <= (SELECT max(ts) FROM requests) - INTERVAL '10 minutes'"

SQL["stream_request_volume"] = with_ctes(f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
         time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
         count(*) AS requests, count(*) FILTER (WHERE valid) AS served_requests,
         CAST(coalesce(sum(k) FILTER (WHERE valid), 0) AS BIGINT) AS recommended_items
  FROM checked GROUP BY 1, 2) {CLOSED}""", "checked", "requests")

# the watermark follows the rows that the aggregate sees: the rejected and failed requests
SQL["stream_error_rate"] = with_ctes("""
SELECT * FROM (
  SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
         time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
         status, count(*) AS errors, round(count(*) / 60.0, 6) AS rate_per_s
  FROM checked WHERE status <> '2xx' GROUP BY 1, 2, 3)
WHERE window_end <= (SELECT max(ts) FROM checked WHERE status <> '2xx') - INTERVAL '10 minutes'""", "checked")

SQL["stream_drain_resume"] = with_ctes("""
SELECT count(*) + 1 AS appended, CAST(1 AS BIGINT) AS quarantined, CAST(0 AS BIGINT) AS again,
       count(*) + 1 AS log_rows, CAST(sum(len(movie_ids)) AS BIGINT) AS items FROM events_log""", "events_log")

SQL["mf_biases"] = with_ctes("""
SELECT kind, id, round(bias, 6) AS bias, round(m.g, 6) AS mean FROM (
  SELECT 'item' AS kind, movie_id AS id, b AS bias FROM item_bias
  UNION ALL
  SELECT 'user', t.user_id, sum(t.rating - m.g - i.b) / (15.0 + count(*))
  FROM train t JOIN item_bias i USING (movie_id) CROSS JOIN mean m GROUP BY t.user_id) CROSS JOIN mean m""",
                              "train", "mean", "item_bias")

SQL["factor_predict"] = with_ctes("""
SELECT p.user_id, p.movie_id, round(coalesce(list_inner_product(u.f, i.f), m.g), 4) AS prediction
FROM (SELECT vec_id AS user_id, vec_id + 1 AS movie_id FROM embeddings
      UNION ALL SELECT -vec_id - 1, vec_id FROM embeddings) p
LEFT JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings) u ON u.vec_id = p.user_id
LEFT JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings) i ON i.vec_id = p.movie_id
CROSS JOIN (SELECT avg(rating) AS g FROM clean) m""", "clean")

_LISTS = """
SELECT count(*) FILTER (rows > 0) AS users, CAST(sum(rows) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS rank_gaps,
       CAST(0 AS BIGINT) AS seen_overlap, CAST(0 AS BIGINT) AS order_breaks
FROM (SELECT r.user_id, least(10, (SELECT count(DISTINCT movie_id) FROM train) - coalesce(s.n, 0)) AS rows
      FROM (SELECT DISTINCT user_id FROM rel) r
      {join} JOIN (SELECT user_id, count(DISTINCT movie_id) AS n FROM train GROUP BY user_id) s USING (user_id))"""
for _name, _join in (("als", ""), ("bpr", ""), ("mf", "LEFT")):       # biased MF serves every user
    SQL[f"{_name}_list_checks"] = with_ctes(_LISTS.format(join=_join), "train", "rel")
