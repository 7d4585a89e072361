"""The views of ``views.py`` in SQL, written on their own for the cross-check."""

FEAT_META = """
vec AS (
  SELECT vec_id, embedding, 'c' || label AS class, CAST(label AS BIGINT) AS classID,
         vec_id % 10 + 1 AS fold
  FROM embeddings),
feat_meta AS (
  SELECT vec_id, embedding, class, classID, fold, FALSE AS is_augmented,
         CAST(-1 AS BIGINT) AS aug_index, 'audio/' || vec_id AS path FROM vec
  UNION ALL
  SELECT vec_id, embedding, class, classID, fold, TRUE, CAST(0 AS BIGINT),
         'audio/' || vec_id || '_aug0' FROM vec WHERE fold <> 10)"""

# Long form: one row per (row, feature).
FEAT_LONG = (
    FEAT_META
    + """,
feat_long AS (
  SELECT vec_id, class, classID, fold, is_augmented, aug_index, path, i,
         CAST(embedding[i + 1] AS DOUBLE) + CASE WHEN is_augmented THEN 0.1 ELSE 0.0 END AS x
  FROM feat_meta, (SELECT unnest(range(64)) AS i))"""
)

SCORES_LONG = """
vec AS (
  SELECT vec_id, embedding, CAST(label AS INTEGER) AS y_true, vec_id % 10 + 1 AS fold
  FROM embeddings),
raw_scores AS (
  SELECT vec_id, y_true, fold, m, c, exp(CAST(embedding[m * 10 + c + 1] AS DOUBLE)) AS e
  FROM vec, (SELECT unnest(range({models})) AS m), (SELECT unnest(range(10)) AS c)),
scores_long AS (
  SELECT vec_id, y_true, fold, m, CAST(c AS INTEGER) AS c,
         e / sum(e) OVER (PARTITION BY vec_id, m) AS p
  FROM raw_scores),
scores AS (
  SELECT vec_id, y_true, fold, m, c AS pred, p AS confidence FROM scores_long
  QUALIFY row_number() OVER (PARTITION BY vec_id, m ORDER BY p DESC, c) = 1)"""

SCORES = SCORES_LONG.format(models=1)
MODEL_SCORES = SCORES_LONG.format(models=6)

PRED = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
pred AS (
  SELECT event_id, ts, user_id, k, value,
         CASE WHEN event_type <> 'error' THEN event_type END AS label,
         CASE WHEN event_type <> 'error' THEN 'ok'
              WHEN k % 2 = 0 THEN 'http_400' ELSE 'error' END AS status,
         CASE WHEN event_type <> 'error' THEN 1 - exp(-value / 50) END AS confidence,
         value / 100 AS latency_s,
         'm' || (user_id % 3) AS model_name
  FROM ev),
pred_ok AS (SELECT * FROM pred WHERE status = 'ok'),
ref AS (SELECT * FROM pred_ok WHERE ts < TIMESTAMP '2024-01-11'),
live AS (SELECT * FROM pred_ok WHERE ts >= TIMESTAMP '2024-01-11')"""

SIGNAL = """
sig AS (
  SELECT vec_id, i, CAST(CAST(x AS DOUBLE) - avg(CAST(x AS DOUBLE)) OVER (PARTITION BY vec_id)
         AS FLOAT) AS x
  FROM (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding) AS x FROM embeddings))"""

LINES = """
line_long AS (
  SELECT f AS feature, position, l_shipdate,
         CASE f WHEN 'l_quantity' THEN l_quantity WHEN 'l_extendedprice' THEN l_extendedprice
                WHEN 'l_discount' THEN l_discount ELSE l_tax END AS x
  FROM lineitem,
       (VALUES ('l_quantity', 0), ('l_extendedprice', 1), ('l_discount', 2), ('l_tax', 3))
         AS names(f, position)),
line_ref AS (SELECT * FROM line_long WHERE l_shipdate < TIMESTAMP '1998-06-01' AND isfinite(x)),
line_live AS (SELECT * FROM line_long WHERE l_shipdate >= TIMESTAMP '1998-06-01' AND isfinite(x)),
line_range AS (SELECT feature, position, min(x) AS lo, max(x) AS hi FROM line_ref GROUP BY ALL),
line_edges AS (
  SELECT feature, position, i,
         CASE WHEN i = 10 THEN hi ELSE lo + i * ((hi - lo) / 10) END AS e
  FROM line_range, (SELECT unnest(range(11)) AS i))"""

UPLOADS = """
up AS (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '.WAV' ELSE url END AS filename,
         strlen(html) AS size,
         CASE page_id % 4 WHEN 0 THEN ' Audio/WAV ; rate=16000' WHEN 1 THEN 'text/html'
                          WHEN 2 THEN 'audio/x-wav' END AS content_type
  FROM pages)"""


def r6(expression: str) -> str:
    """Six decimals, without a negative zero."""
    return f"round({expression}, 6) + 0.0"


def query(*parts: str) -> str:
    """CTE texts followed by the final select."""
    *views, select = parts
    return f"WITH {', '.join(views)} {select}" if views else select
