"""Oracle SQL for the registered queries, in DuckDB's dialect, over the raw
tables.  Written independently of the Spark code: plain windows, joins and
aggregates, the obvious way.  Names and types match the Spark columns."""

from __future__ import annotations

# hash32(x): first 8 hex digits of md5(x) as an integer (see functions.hashing)
H = "(('0x' || substr(md5({x}), 1, 8))::BIGINT)"


def h(x: str) -> str:
    return H.format(x=x)


INTER = """inter AS (
  SELECT 'U' || CAST(o_custkey AS VARCHAR) AS user_id,
         'T' || CAST(l_partkey AS VARCHAR) AS track_id,
         CAST(round(sum(l_quantity)) AS BIGINT) AS count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

SPLIT = INTER + """,
split AS (
  SELECT user_id, track_id, count,
         CASE WHEN b = 0 AND r = 0 THEN 'val'
              WHEN b IN (1, 2) AND r = 0 THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, """ + h("user_id") + """ % 10 AS b,
               """ + h("user_id || ':' || track_id") + """ % 2 AS r FROM inter)),
train AS (SELECT user_id, track_id, count FROM split WHERE split = 'train'),
val AS (SELECT user_id, track_id, count FROM split WHERE split = 'val'),
test AS (SELECT user_id, track_id, count FROM split WHERE split = 'test')"""

TRAIN_ONLY = """train_only AS (
  SELECT DISTINCT user_id FROM train
  WHERE user_id NOT IN (SELECT user_id FROM val) AND user_id NOT IN (SELECT user_id FROM test))"""

SAMPLED = TRAIN_ONLY + """,
sampled AS (
  SELECT user_id FROM (
    SELECT user_id, row_number() OVER (ORDER BY md5(user_id), user_id) AS rn FROM train_only)
  WHERE rn <= (SELECT CAST(round_even(count(*) * 0.2, 0) AS BIGINT) FROM train_only))"""


def _sample(src: str, n: int, salt: str) -> str:
    return f"""(SELECT user_id FROM (
    SELECT user_id, row_number() OVER (ORDER BY md5('{salt}' || user_id), user_id) AS rn
    FROM (SELECT DISTINCT user_id FROM {src})) WHERE rn <= {n})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


MAPS = """users_map AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY freq DESC, user_id) - 1 AS INTEGER) AS "user", freq
  FROM (SELECT user_id, count(*) AS freq FROM split GROUP BY user_id)),
items_map AS (
  SELECT track_id, CAST(row_number() OVER (ORDER BY freq DESC, track_id) - 1 AS INTEGER) AS item, freq
  FROM (SELECT track_id, count(*) AS freq FROM split GROUP BY track_id))"""

POP = """pop AS (
  SELECT track_id, pos, score FROM (
    SELECT track_id, score,
           CAST(row_number() OVER (ORDER BY score DESC, track_id) - 1 AS INTEGER) AS pos
    FROM (SELECT track_id, count(*) AS score FROM train GROUP BY track_id))
  WHERE pos < 50)"""


def _metrics_sql(labels_cte: str, recs_cte: str, select: str) -> str:
    """Per-user hit positions against a global list; averaged over users."""
    return with_(SPLIT, labels_cte, recs_cte, """
m AS (SELECT user_id, count(*) AS m FROM lab GROUP BY user_id),
hits AS (
  SELECT l.user_id, r.pos,
         row_number() OVER (PARTITION BY l.user_id ORDER BY r.pos) AS j
  FROM lab l JOIN recs r ON l.track_id = r.track_id),
disc AS (SELECT i, 1.0 / log2(i + 2) AS g FROM range(0, 1000) t(i)),
pu AS (
  SELECT m.user_id, m.m,
    coalesce(sum(CASE WHEN pos < 10 THEN 1 ELSE 0 END), 0) AS h10,
    coalesce(sum(CASE WHEN pos < 50 THEN 1 ELSE 0 END), 0) AS h50,
    coalesce(sum(CAST(j AS DOUBLE) / (pos + 1)), 0) AS ap_sum,
    coalesce(sum(CASE WHEN pos < 10 THEN CAST(j AS DOUBLE) / (pos + 1) END), 0) AS ap10_sum,
    coalesce(sum(CASE WHEN pos < 10 THEN 1.0 / log2(pos + 2) END), 0) AS dcg10,
    coalesce(sum(CASE WHEN pos < 50 THEN 1.0 / log2(pos + 2) END), 0) AS dcg50
  FROM m LEFT JOIN hits ON m.user_id = hits.user_id GROUP BY m.user_id, m.m),
per AS (
  SELECT pu.*,
    (SELECT sum(g) FROM disc WHERE i < least(pu.m, 10)) AS idcg10,
    (SELECT sum(g) FROM disc WHERE i < least(pu.m, 50)) AS idcg50
  FROM pu)
""") + select + " FROM per"


METRIC_COLS = {
    "n_users_scored": "CAST(count(*) AS BIGINT) AS n_users_scored",
    "precision_at_10": "round(avg(h10 / 10.0), 5) AS precision_at_10",
    "precision_at_50": "round(avg(h50 / 50.0), 5) AS precision_at_50",
    "recall_at_10": "round(avg(h10 / CAST(m AS DOUBLE)), 5) AS recall_at_10",
    "recall_at_50": "round(avg(h50 / CAST(m AS DOUBLE)), 5) AS recall_at_50",
    "map": "round(avg(ap_sum / m), 5) AS map",
    "map_at_10": "round(avg(ap10_sum / least(m, 10)), 5) AS map_at_10",
    "ndcg_at_10": "round(avg(dcg10 / idcg10), 5) AS ndcg_at_10",
    "ndcg_at_50": "round(avg(dcg50 / idcg50), 5) AS ndcg_at_50",
}


def _sel(*names: str) -> str:
    return "SELECT " + ", ".join(METRIC_COLS[n] for n in names)


LAB_FULL = "lab AS (SELECT DISTINCT user_id, track_id FROM val)"
LAB_TOP = """lab AS (
  SELECT user_id, track_id FROM (
    SELECT user_id, track_id, count, max(count) OVER (PARTITION BY user_id) AS top FROM val)
  WHERE count = top)"""
RECS_POP = POP + ",\nrecs AS (SELECT track_id, pos FROM pop)"

VARIANT_VALUE = {
    "raw": "CASE WHEN count > 0 THEN CAST(count AS DOUBLE) END",
    "drop": "CASE WHEN count >= 2 THEN CAST(count AS DOUBLE) END",
    "log": "CASE WHEN count > 0 THEN ln(count) END",
    "log1p": "CASE WHEN count > 0 THEN ln(1 + count) END",
    "cap": "CASE WHEN count > 0 THEN least(CAST(count AS DOUBLE), 10.0) END",
    "binary": "CASE WHEN count > 0 THEN 1.0 END",
}


def _variant_compare() -> str:
    parts = []
    for how, v in VARIANT_VALUE.items():
        recs = f"""recs AS (
  SELECT track_id, pos FROM (
    SELECT track_id, CAST(row_number() OVER (ORDER BY score DESC, track_id) - 1 AS INTEGER) AS pos
    FROM (SELECT track_id, CAST(sum(v) AS DOUBLE) AS score
          FROM (SELECT track_id, {v} AS v FROM train) WHERE v IS NOT NULL GROUP BY track_id))
  WHERE pos < 50)"""
        sel = f"SELECT '{how}' AS how, " + ", ".join(
            METRIC_COLS[n] for n in ("n_users_scored", "precision_at_10", "map", "ndcg_at_50"))
        parts.append("(" + _metrics_sql(LAB_FULL, recs, sel) + ")")
    return "\nUNION ALL\n".join(parts)


def _report() -> str:
    sels = []
    for how, v in VARIANT_VALUE.items():
        sels.append(f"""SELECT '{how}' AS how,
  CAST(count(v) AS BIGINT) AS rows_kept,
  CAST(sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_removed,
  CAST(count(DISTINCT CASE WHEN v IS NOT NULL THEN user_id END) AS BIGINT) AS users_kept,
  CAST(count(DISTINCT CASE WHEN v IS NOT NULL THEN track_id END) AS BIGINT) AS items_kept,
  CAST(sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_zero,
  round(sum(v), 5) AS value_sum, round(min(v), 5) AS value_min, round(max(v), 5) AS value_max
FROM (SELECT user_id, track_id, {v.replace('10.0', '10.0')} AS v FROM train)""")
    return with_(SPLIT) + "\nUNION ALL\n".join(sels)


ORACLE: dict[str, str] = {
    "scan_interactions": with_(INTER) + "SELECT * FROM inter",
    "events_interactions": """
SELECT 'U' || CAST(user_id AS VARCHAR) AS user_id,
       'K' || json_extract_string(props, '$.k') AS track_id,
       CAST(count(*) AS BIGINT) AS count
FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1, 2""",
    "sql_view_topk": with_(INTER) + """
SELECT track_id, CAST(count(*) AS BIGINT) AS n_users, CAST(sum(count) AS BIGINT) AS total
FROM inter GROUP BY track_id ORDER BY n_users DESC, track_id LIMIT 10""",
    "split_holdout": with_(SPLIT) + "SELECT * FROM split",
    "split_audit": with_(SPLIT) + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT track_id) AS BIGINT) AS n_items,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT user_id FROM val)
        WHERE user_id IN (SELECT user_id FROM test)) AS n_users_val_and_test
FROM split GROUP BY split""",
    "describe_interactions": with_(SPLIT) + """
SELECT split, CAST(count(count) AS BIGINT) AS n, round(avg(count), 5) AS mean,
       round(stddev_samp(count), 5) AS stddev, min(count) AS min, max(count) AS max
FROM split GROUP BY split""",
    "union_splits": with_(SPLIT) + "SELECT user_id, track_id, count, split FROM split",
    "project_triples": with_(SPLIT) + "SELECT user_id, track_id, count FROM train",
    "distinct_users": with_(SPLIT) + "SELECT DISTINCT user_id FROM train",
    "users_train_only": with_(SPLIT, TRAIN_ONLY) + "SELECT user_id FROM train_only",
    "sample_users_exact": with_(SPLIT, SAMPLED) + "SELECT user_id FROM sampled",
    "sample_users_fixed": with_(SPLIT) + "SELECT user_id FROM " + _sample("val", 50, "val"),
    "users_kept": with_(SPLIT, SAMPLED) + """
SELECT user_id FROM sampled UNION SELECT user_id FROM val UNION SELECT user_id FROM test""",
    "filter_users_semi": with_(SPLIT) + """
SELECT * FROM train WHERE user_id IN (SELECT user_id FROM val)""",
    "subsample_train": with_(SPLIT, SAMPLED) + """
SELECT * FROM train WHERE user_id IN (
  SELECT user_id FROM sampled UNION SELECT user_id FROM val UNION SELECT user_id FROM test)""",
    "subsample_splits": with_(SPLIT, TRAIN_ONLY, "s_train AS " + _sample("train_only", 200, "fixed"),
                              "s_val AS " + _sample("val", 50, "fixed"),
                              "s_test AS " + _sample("test", 100, "fixed")) + """
SELECT *, 'train' AS split FROM train WHERE user_id IN (
  SELECT user_id FROM s_train UNION SELECT user_id FROM s_val UNION SELECT user_id FROM s_test)
UNION ALL SELECT *, 'val' AS split FROM val WHERE user_id IN (SELECT user_id FROM s_val)
UNION ALL SELECT *, 'test' AS split FROM test WHERE user_id IN (SELECT user_id FROM s_test)""",
    "cv_fold_sizes": with_(SPLIT) + """
SELECT CAST(""" + h("user_id || ':' || track_id") + """ % 5 AS INTEGER) AS fold,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT track_id) AS BIGINT) AS n_items
FROM train GROUP BY 1""",
    "drop_low_counts": with_(SPLIT) + """
SELECT user_id, track_id, CAST(count AS DOUBLE) AS count FROM train WHERE count >= 2""",
    "count_log": with_(SPLIT) + """
SELECT user_id, track_id, round(ln(count), 5) AS count FROM train WHERE count > 0""",
    "count_transform_stats": _report(),
    "index_users": with_(SPLIT, MAPS) + 'SELECT user_id, "user", CAST(freq AS BIGINT) AS freq FROM users_map',
    "index_items": with_(SPLIT, MAPS) + "SELECT track_id, item, CAST(freq AS BIGINT) AS freq FROM items_map",
    "index_all_splits": with_(SPLIT, MAPS) + """
SELECT u."user", i.item, CAST(s.count AS DOUBLE) AS count, s.split
FROM split s JOIN users_map u ON s.user_id = u.user_id JOIN items_map i ON s.track_id = i.track_id""",
    "index_unseen_counts": with_(SPLIT) + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(sum(CASE WHEN user_id NOT IN (SELECT user_id FROM train) THEN 1 ELSE 0 END) AS BIGINT) AS n_unseen_user,
  CAST(sum(CASE WHEN track_id NOT IN (SELECT track_id FROM train) THEN 1 ELSE 0 END) AS BIGINT) AS n_unseen_item,
  CAST(sum(CASE WHEN user_id IN (SELECT user_id FROM train) AND track_id IN (SELECT track_id FROM train)
           THEN 1 ELSE 0 END) AS BIGINT) AS n_kept_skip
FROM split GROUP BY split""",
    "index_roundtrip": with_(SPLIT) + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_equal
FROM split GROUP BY split""",
    "labels_full": with_(SPLIT) + """
SELECT user_id, track_id, CAST(sum(count) AS BIGINT) AS count FROM val GROUP BY user_id, track_id""",
    "labels_top_tied": with_(SPLIT) + """
SELECT user_id, track_id, count FROM (
  SELECT user_id, track_id, count, max(count) OVER (PARTITION BY user_id) AS top FROM val)
WHERE count = top""",
    "ordered_label_list": with_(SPLIT) + """
SELECT user_id, track_id, count,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY count DESC, track_id) - 1 AS INTEGER) AS label_pos
FROM val""",
    "dedup_user_top": with_(SPLIT) + """
SELECT user_id, track_id, count FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY count DESC, track_id) AS rn FROM val)
WHERE rn = 1""",
    "popularity_top50": with_(SPLIT, POP) + "SELECT pos, track_id, CAST(score AS BIGINT) AS score FROM pop",
    "metric_precision": _metrics_sql(LAB_FULL, RECS_POP, _sel(
        "n_users_scored", "precision_at_10", "precision_at_50", "recall_at_10", "recall_at_50")),
    "metric_map": _metrics_sql(LAB_FULL, RECS_POP, _sel("n_users_scored", "map", "map_at_10")),
    "metric_ndcg": _metrics_sql(LAB_FULL, RECS_POP, _sel("n_users_scored", "ndcg_at_10", "ndcg_at_50")),
    "metric_top_tied": _metrics_sql(LAB_TOP, RECS_POP, _sel(
        "n_users_scored", "precision_at_10", "map", "ndcg_at_50")),
    "metric_rmse": with_(SPLIT) + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, round(sqrt(avg((v.count - p.prediction) ^ 2)), 5) AS rmse
FROM val v JOIN (SELECT track_id, avg(count) AS prediction FROM train GROUP BY track_id) p
  ON v.track_id = p.track_id""",
    "variant_compare": _variant_compare(),
}

ORACLE["sweep_best"] = ("SELECT how, map FROM (" + _variant_compare()
                        + ") ORDER BY map DESC, how LIMIT 1")

ORACLE["describe_columns"] = with_(INTER) + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n, {m} AS mean, {d} AS stddev,
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM inter"""
    for c, m, d in (("user_id", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
                    ("track_id", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
                    ("count", "round(avg(count), 5)", "round(stddev_samp(count), 5)")))

ORACLE["head_interactions"] = with_(INTER) + "SELECT * FROM inter ORDER BY user_id, track_id LIMIT 20"

EVENTS = """ev AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS user_id,
         'K' || json_extract_string(props, '$.k') AS track_id, CAST(count(*) AS BIGINT) AS count
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1, 2)"""

ORACLE["events_transform_stats"] = _report().replace(with_(SPLIT), with_(EVENTS)).replace(
    "FROM train)", "FROM ev)")
ORACLE["events_labels_top_tied"] = with_(EVENTS) + """
SELECT user_id, track_id, count FROM (
  SELECT *, max(count) OVER (PARTITION BY user_id) AS top FROM ev) WHERE count = top"""
