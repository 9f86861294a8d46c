"""Common table expressions for the checking SQL: the same review views and steps in plain SQL."""

from __future__ import annotations

# White-space characters as a regex class, and the runs between words.
SPACE_CLASS = r"[ \t\n\x0b\f\r]"
WORD_BREAK = r"[^\p{L}\p{N}_]+"

DOCUMENT_REVIEWS = """
document_reviews AS (
  SELECT 'r' || doc_id AS review_id, 'p' || (doc_id % 50) AS product_id,
    'u' || (doc_id % 97) AS reviewer_id,
    CAST(CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 9
         ELSE 1 + (doc_id * 7) % 5 END AS INTEGER) AS stars,
    CASE WHEN doc_id % 17 = 0 THEN '' ELSE text END AS review_body,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE substr(text, 1, 20) END AS review_title,
    lang AS language, source AS product_category,
    CASE WHEN doc_id % 23 = 0 THEN '2024-02-31'
         ELSE strftime(DATE '2022-01-01' + CAST(doc_id % 730 AS INTEGER), '%Y-%m-%d')
         END AS review_date,
    CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END AS verified_purchase,
    CAST(NULL AS VARCHAR) AS vine, doc_id
  FROM documents)"""

MISSING = """(review_id IS NULL OR review_id = '' OR stars IS NULL
    OR review_body IS NULL OR review_body = '' OR review_date IS NULL OR review_date = ''
    OR language IS NULL OR language = '' OR product_category IS NULL OR product_category = '')"""

BAD_STARS = "(stars < 1 OR stars > 5)"
BAD_DATE = "(try_strptime(review_date, '%Y-%m-%d') IS NULL)"

CHECKED = f"""
checked AS (
  SELECT *, {MISSING} AS is_missing, coalesce({BAD_STARS}, false) AS is_out_of_range,
    {BAD_DATE} AS is_bad_date
  FROM document_reviews)"""

VALID = """
valid AS (
  SELECT * EXCLUDE (is_missing, is_out_of_range, is_bad_date) FROM checked
  WHERE NOT is_missing AND NOT is_out_of_range AND NOT is_bad_date)"""

SILVER = """
silver AS (
  SELECT *, CAST(review_date AS DATE) AS review_dt,
    CASE WHEN stars >= 4 THEN 1 ELSE 0 END AS is_positive,
    CAST(date_trunc('month', CAST(review_date AS DATE)) AS DATE) AS review_month_start
  FROM valid)"""

FEATURES = """
features AS (
  SELECT review_id, review_date, stars, product_category,
    coalesce(length(product_category), 0) AS category_name_len,
    coalesce(review_title, '') AS review_title, coalesce(review_body, '') AS review_body,
    coalesce(review_title, '') || ' ' || coalesce(review_body, '') AS review_text,
    CASE WHEN stars >= 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS lab,
    CAST(review_date AS DATE) AS review_dt,
    CAST(epoch(CAST(review_date AS DATE)) AS BIGINT) AS unix_time
  FROM valid WHERE TRY_CAST(review_date AS DATE) IS NOT NULL)"""

_DOCUMENT = """SELECT 'r' || doc_id AS review_id, 'p' || (doc_id % 50) AS product_id,
    'u' || (doc_id % 97) AS reviewer_id, CAST({stars} AS INTEGER) AS stars, {body} AS review_body,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE substr(text, 1, 20) END AS review_title,
    lang AS language, {category} AS product_category, {day} AS review_date,
    CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END AS verified_purchase,
    CAST(NULL AS VARCHAR) AS vine, doc_id FROM documents"""
_RATING = "1 + (doc_id * 7) % 5"
_DAY = "strftime(DATE '2022-01-01' + CAST(doc_id % 730 AS INTEGER), '%Y-%m-%d')"
_WHOLE = _DOCUMENT.format(stars=_RATING, body="text", category="source", day=_DAY)
_PATCHY = _DOCUMENT.format(
    stars=f"CASE WHEN doc_id % 29 = 0 THEN NULL ELSE {_RATING} END",
    body="CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END",
    category="CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source END",
    day=f"CASE WHEN doc_id % 23 = 0 THEN '2024-02-31' ELSE {_DAY} END",
)

# Ingest: what validation leaves of a feed with defects. All else: every document, without defects
# or with gaps that were never validated.
REVIEWS_TO_VALID = f"WITH {DOCUMENT_REVIEWS}, {CHECKED}, {VALID}"
REVIEWS_TO_SILVER = f"WITH valid AS ({_WHOLE}), {SILVER}"
REVIEWS_TO_FEATURES = f"WITH valid AS ({_WHOLE}), {FEATURES}"
PATCHY_TO_FEATURES = f"WITH valid AS ({_PATCHY}), {FEATURES}"

EVENT_FEED = """
event_feed AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, 'A' || (event_id % 300) AS asin,
    epoch_us(ts) // 1000 AS "timestamp", CAST(1 + event_id % 5 AS DOUBLE) AS rating,
    props AS text, event_type AS title, event_type = 'purchase' AS verified_purchase,
    'raw_review_' || event_type AS _dataset_config, event_id
  FROM events)"""

EVENT_REVIEWS = f"""WITH {EVENT_FEED},
event_reviews AS (
  SELECT user_id || '_' || asin || '_' || "timestamp" AS review_id, asin AS product_id,
    user_id AS reviewer_id, rating AS stars, text AS review_body, title AS review_title,
    'en' AS language, regexp_replace(_dataset_config, '^raw_review_', '') AS product_category,
    strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') AS review_date,
    CASE WHEN verified_purchase THEN 'True' ELSE 'False' END AS verified_purchase,
    CAST(NULL AS VARCHAR) AS vine, event_id % 43 = 0 AS is_text
  FROM event_feed)"""

SCORED = """
scored AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS review_id, CAST(l.quality AS DOUBLE) AS lab,
    CASE WHEN d.n_chars % 3 > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
    round(d.n_chars / 100.0::DOUBLE) AS score
  FROM documents d JOIN labels l USING (doc_id))"""

CELLS = """
cells AS (
  SELECT CAST(count(*) FILTER (lab = 1 AND prediction = 1) AS BIGINT) AS tp,
    CAST(count(*) FILTER (lab = 0 AND prediction = 1) AS BIGINT) AS fp,
    CAST(count(*) FILTER (lab = 1 AND prediction = 0) AS BIGINT) AS fn,
    CAST(count(*) FILTER (lab = 0 AND prediction = 0) AS BIGINT) AS tn
  FROM scored)"""

F1_WEIGHTED = """(2.0::DOUBLE * tp / (2 * tp + fp + fn) * (tp + fn)
    + 2.0::DOUBLE * tn / (2 * tn + fp + fn) * (tn + fp)) / (tp + fp + fn + tn)"""
F1_BINARY = "2.0::DOUBLE * tp / (2 * tp + fp + fn)"
ACCURACY = "CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)"

AUC = """
auc AS (
  SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END
      ::DOUBLE) / count(*) AS auc
  FROM (SELECT score FROM scored WHERE lab = 1) p, (SELECT score FROM scored WHERE lab = 0) n)"""

TOKENS = f"""
trimmed AS (
  SELECT *, rtrim(lower(review_text), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
    AS lowered FROM features),
tokenised AS (
  SELECT *, CASE WHEN lowered = '' AND review_text <> '' THEN CAST([] AS VARCHAR[])
    ELSE string_split_regex(lowered, '{SPACE_CLASS}') END AS tokens FROM trimmed)"""
