"""Pieces of oracle SQL shared by several queries."""

from __future__ import annotations

from opinara.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, WHITESPACE

GAP = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def rounded(expr: str, digits: int) -> str:
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits} + CAST(0 AS DOUBLE))"


def exact(expr: str, digits: int) -> str:
    """Decimal text of the stored value, read back."""
    return f"(CAST(printf('%.{digits}f', {expr}) AS DOUBLE) + CAST(0 AS DOUBLE))"


def mean(expr: str) -> str:
    return f"(CAST(sum(CAST(round(({expr}) * 1e6) AS BIGINT)) AS DOUBLE) / 1e6 / count({expr}))"


def trimmed(expr: str) -> str:
    return f"trim({expr}, '{WHITESPACE}')"


def tokens(expr: str) -> str:
    return f"CAST(ceil({word_count(expr)} * CAST(1.3 AS DOUBLE)) AS BIGINT)"


def word_list(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{GAP}'), lambda w: w <> '')"


def word_count(expr: str) -> str:
    return f"len({word_list(expr)})"


def strings(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


REVIEWS = f"""reviews AS (
  SELECT event_id AS ingest_seq,
    'r' || CAST(CASE WHEN event_id % 11 = 0 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS source_id,
    'product_' || CAST(user_id % 20 AS VARCHAR) AS product_name,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_type = 'error' THEN ' Negative'
      WHEN event_type = 'view' THEN 'neutral' WHEN event_type = 'click' THEN 'mixed' ELSE 'positive' END AS sentiment,
    CASE event_id % 6 WHEN 0 THEN ' Books' WHEN 1 THEN 'home_garden' ELSE 'beauty' END AS product_category,
    CASE WHEN event_id % 4 = 0 THEN ' EN' ELSE 'tr' END AS language_detected,
    {exact('(value - 50) / 50', 4)} AS sentiment_score,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE ((event_id * 37) % 101) / CAST(100 AS DOUBLE) END AS confidence_score,
    CASE WHEN event_id % 8 = 7 THEN NULL ELSE CAST(event_id % 7 AS DOUBLE) END AS reviewer_rating,
    event_id % 23 = 0 AS is_spam_or_fake,
    CASE WHEN event_type = 'error' AND value > 150 THEN 'critical' WHEN event_type = 'error' THEN 'low'
      ELSE 'medium' END AS urgency_level,
    CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS data_quality,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS review_date,
    [event_type, ' topic_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 12 AS VARCHAR), ' '] AS key_topics,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 9 = 0
      THEN ['brand_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR)]
      ELSE ['nan'] END AS mentioned_competitors
  FROM events)"""

USABLE = """usable AS (
  SELECT * FROM reviews
  WHERE NOT is_spam_or_fake AND (confidence_score IS NULL OR confidence_score >= 0.5)
    AND source_id IS NOT NULL AND sentiment IS NOT NULL AND sentiment_score IS NOT NULL)"""

CLEAN = f"""{REVIEWS}, {USABLE}, cleaned AS (
  SELECT ingest_seq, source_id, product_name, lower(trim(sentiment)) AS sentiment,
    lower(trim(product_category)) AS product_category, lower(trim(language_detected)) AS language_detected,
    CASE WHEN sentiment_score > 1 THEN 1.0 WHEN sentiment_score < -1 THEN -1.0 ELSE sentiment_score END AS sentiment_score,
    confidence_score,
    CASE WHEN reviewer_rating BETWEEN 1 AND 5 THEN reviewer_rating END AS reviewer_rating,
    is_spam_or_fake, lower(trim(urgency_level)) AS urgency_level, data_quality, review_date,
    key_topics, mentioned_competitors
  FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ingest_seq) AS place FROM usable)
  WHERE place = 1)"""


def series(period: str, source: str = "cleaned") -> str:
    return f"""series AS (
  SELECT {period} AS period, {rounded(mean('sentiment_score'), 4)} AS avg_sentiment,
    count(source_id) AS review_count, {rounded(mean('reviewer_rating'), 2)} AS avg_rating,
    {rounded("avg(CASE WHEN sentiment = 'negative' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)", 4)} AS negative_rate,
    {rounded("avg(CASE WHEN sentiment = 'positive' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)", 4)} AS positive_rate
  FROM {source} WHERE review_date IS NOT NULL GROUP BY 1)"""


DAY = "strftime(review_date, '%Y-%m-%d')"
WEEK = (
    "strftime(date_trunc('week', review_date), '%Y-%m-%d') || '/' || "
    "strftime(date_trunc('week', review_date) + INTERVAL 6 DAY, '%Y-%m-%d')"
)
DAILY = f"{CLEAN}, {series(DAY)}"

def alerts(threshold: float) -> str:
    return f"""long AS (
  SELECT 1 AS m, period, 'negative_rate' AS metric, negative_rate AS value FROM series
  UNION ALL SELECT 2, period, 'avg_sentiment', avg_sentiment FROM series),
stats AS (SELECT metric, avg(value) AS mu, stddev_samp(value) AS sd, count(value) AS n FROM long GROUP BY metric),
alerts AS (
  SELECT m, period, metric, {exact('value', 4)} AS value, {exact('(value - mu) / sd', 3)} AS z_score,
    CASE WHEN abs((value - mu) / sd) > 3 THEN 'critical' WHEN abs((value - mu) / sd) > 2.5 THEN 'high'
      ELSE 'medium' END AS severity,
    {exact('mu', 4)} AS mean, {exact('sd', 4)} AS std
  FROM long JOIN stats USING (metric)
  WHERE n >= 3 AND sd >= 1e-9 AND abs((value - mu) / sd) > {threshold})"""

TOPICS = f"""topics AS (
  SELECT topic, count(*) AS count, {exact(mean('sentiment_score'), 3)} AS avg_sentiment
  FROM (SELECT trim(unnest(key_topics)) AS topic, sentiment_score FROM cleaned) WHERE topic <> ''
  GROUP BY topic ORDER BY count DESC, topic LIMIT 10)"""

COMPETITORS = """competitors AS (
  SELECT value, count(*) AS count
  FROM (SELECT trim(unnest(mentioned_competitors)) AS value FROM cleaned) WHERE value NOT IN ('', 'nan', 'None')
  GROUP BY value ORDER BY count DESC, value LIMIT 10)"""

RAW = f"""raw AS (
  SELECT doc_id AS ingest_seq, CAST(doc_id AS VARCHAR) AS source_id, raw_text
  FROM (SELECT doc_id, {trimmed('text')} AS raw_text FROM documents) WHERE length(raw_text) >= 10)"""


def scored(negative=NEGATIVE_WORDS, positive=POSITIVE_WORDS, source: str = "raw") -> str:
    ratio = "neg / CAST(greatest(neg + pos, 1) AS DOUBLE)"
    balance = exact("0.1::DOUBLE + (pos - neg) * 0.05::DOUBLE", 3)
    return f"""counted AS (
  SELECT ingest_seq, source_id, raw_text, len(vocabulary) AS size,
    len(list_intersect(vocabulary, {strings(negative)})) AS neg,
    len(list_intersect(vocabulary, {strings(positive)})) AS pos
  FROM (SELECT *, list_distinct({word_list('lower(raw_text)')}) AS vocabulary FROM {source})),
scored AS (
  SELECT ingest_seq, source_id, raw_text,
    CASE WHEN {ratio} >= 0.7::DOUBLE THEN 'negative' WHEN {ratio} >= 0.4::DOUBLE THEN 'mixed'
      WHEN pos > 0 AND neg = 0 THEN 'positive' WHEN {balance} > 0.15::DOUBLE THEN 'positive' ELSE 'neutral' END AS sentiment,
    CASE WHEN {ratio} >= 0.7::DOUBLE THEN {exact(f'-(0.4::DOUBLE + ({ratio}) * 0.6::DOUBLE)', 3)}
      WHEN {ratio} >= 0.4::DOUBLE THEN {exact(f'-({ratio}) * 0.4::DOUBLE', 3)}
      WHEN pos > 0 AND neg = 0
        THEN {exact('least(0.3::DOUBLE + (pos / CAST(greatest(size, 1) AS DOUBLE)) * 5, 0.95::DOUBLE)', 3)}
      ELSE {balance} END AS sentiment_score,
    CASE WHEN {ratio} >= 0.85::DOUBLE THEN 'high' WHEN {ratio} >= 0.4::DOUBLE THEN 'medium' ELSE 'low' END AS urgency_level
  FROM counted)"""


# The serial walk, one row at a time.
BATCHES = f"""costs AS MATERIALIZED (
  SELECT ingest_seq, source_id, raw_text, {tokens('raw_text')} + 50 AS cost,
    row_number() OVER (ORDER BY ingest_seq) AS rn FROM raw),
walk AS (
  SELECT rn, CAST(1 AS BIGINT) AS batch_no, 800 + cost AS load FROM costs WHERE rn = 1
  UNION ALL
  SELECT c.rn, CASE WHEN w.load + c.cost > 6000 THEN w.batch_no + 1 ELSE w.batch_no END,
    CASE WHEN w.load + c.cost > 6000 THEN 800 + c.cost ELSE w.load + c.cost END
  FROM walk w JOIN costs c ON c.rn = w.rn + 1),
packed AS (SELECT c.*, w.batch_no FROM costs c JOIN walk w USING (rn))"""

DRAFTS = """drafts AS (
  SELECT event_id AS ingest_seq,
    CASE WHEN event_id % 41 = 0 THEN '' ELSE 'r' || CAST(event_id AS VARCHAR) END AS source_id,
    CASE WHEN event_id % 43 = 0 THEN '' WHEN event_id % 47 = 0 THEN repeat('x', 201)
      ELSE 'product_' || CAST(user_id % 20 AS VARCHAR) END AS product_name,
    CASE WHEN event_id % 37 = 0 THEN 'toys' WHEN event_id % 2 = 0 THEN 'books' ELSE 'home_garden' END AS product_category,
    CASE WHEN event_id % 53 = 0 THEN ' Negative' WHEN event_type = 'error' THEN 'negative'
      WHEN event_type = 'view' THEN 'neutral' WHEN event_type = 'click' THEN 'mixed' ELSE 'positive' END AS sentiment,
    CASE WHEN event_id % 59 = 0 THEN NULL ELSE (value - 50) / 50 END AS score_in,
    CASE WHEN event_id % 61 = 0 THEN CAST(150 AS DOUBLE) WHEN event_id % 3 = 0 THEN CAST((event_id * 37) % 101 AS DOUBLE)
      ELSE ((event_id * 37) % 101) / CAST(100 AS DOUBLE) END AS confidence_in,
    CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS review_date,
    CASE WHEN event_id % 67 = 0 THEN 'too short' ELSE 'Review of event ' || CAST(event_id AS VARCHAR) END AS summary,
    event_type || '|topic_' || CAST(event_id % 12 AS VARCHAR) AS key_topics,
    'fast|' || event_type AS pros,
    CASE WHEN event_id % 4 = 0 THEN event_id % 7 + 0.25::DOUBLE ELSE CAST(event_id % 7 AS DOUBLE) END AS rating_in,
    CASE event_id % 5 WHEN 0 THEN 'expert' WHEN 2 THEN 'novice' END AS reviewer_expertise,
    CASE WHEN event_type = 'error' AND value > 150 THEN 'critical' WHEN event_type = 'error' THEN 'low'
      WHEN event_id % 71 = 0 THEN 'urgent' ELSE 'medium' END AS urgency_in,
    CASE WHEN event_id % 73 = 0 THEN repeat('y', 301) WHEN event_id % 2 = 0 THEN 'call back' END AS action_notes,
    CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS quality_in,
    CASE WHEN event_id % 79 = 0 THEN 'e' WHEN event_id % 6 = 0 THEN 'en' WHEN event_id % 6 = 1 THEN 'en-us'
      ELSE 'tr' END AS language_detected,
    event_id % 23 = 0 AS is_spam_or_fake
  FROM events)"""


def _contract() -> str:
    share = "CASE WHEN confidence_in > 1 AND confidence_in <= 100 THEN confidence_in / 100 ELSE confidence_in END"
    rules = {
        "source_id": "source_id = ''",
        "product_name": "length(product_name) NOT BETWEEN 1 AND 200",
        "product_category": "product_category = 'toys'",
        "sentiment": "sentiment = ' Negative'",
        "sentiment_score": "sentiment_score IS NULL",
        "confidence_score": "confidence_score IS NULL",
        "summary": "length(summary) NOT BETWEEN 10 AND 500",
        "urgency_level": "urgency_in = 'urgent'",
        "action_notes": "coalesce(length(action_notes) > 300, false)",
        "language_detected": "length(language_detected) < 2",
    }
    errors = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in rules.items())
    escalate = "(sentiment = 'negative' AND coalesce(reviewer_rating <= 2, false) AND urgency_in = 'low')"
    return f"""{DRAFTS}, coerced AS (
  SELECT *, {exact("CASE WHEN score_in > 1 THEN 1 WHEN score_in < -1 THEN -1 ELSE score_in END", 4)} AS sentiment_score,
    CASE WHEN {share} BETWEEN 0 AND 1 THEN {exact(share, 4)} END AS confidence_score,
    CASE WHEN rating_in BETWEEN 1 AND 5 THEN {exact('rating_in', 1)} END AS reviewer_rating
  FROM drafts),
contract AS (
  SELECT *, concat_ws(',', {errors}) AS errors,
    CASE WHEN {escalate} THEN 'high' ELSE urgency_in END AS urgency_level,
    {escalate} OR urgency_in = 'critical' AS action_required,
    CASE WHEN is_spam_or_fake THEN 'low' ELSE quality_in END AS data_quality
  FROM coerced)"""


CONTRACT = _contract()
