"""The same queries in DuckDB SQL, written from the rules, not from the Spark code."""

from __future__ import annotations

from opinara.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, PRICE_PER_1K
from opinara.operators.prompts import _BATCH, _SINGLE
from opinara.registry.sqltext import (
    BATCHES,
    CLEAN,
    COMPETITORS,
    CONTRACT,
    DAILY,
    RAW,
    REVIEWS,
    TOPICS,
    WEEK,
    alerts,
    exact,
    mean,
    scored,
    series,
    strings,
    tokens,
    trimmed,
    word_count,
)
from opinara.schemas import SERIES
from opinara.sinks import KPI_LABELS
from opinara.sources.views import RECORDS_PER_REPLY, TEST_NEGATIVE, TEST_POSITIVE

ORACLES: dict[str, str] = {}

SCHEMA_TEXT = '{"type": "object"}'
_TRIMMED = f"SELECT CAST(doc_id AS VARCHAR) AS source_id, {trimmed('text')} AS raw_text"
_LONG_ENOUGH = f"length({trimmed('text')}) >= 10"

# --- A -----------------------------------------------------------------------------

ORACLES["a1_json_arrays"] = f"{_TRIMMED} FROM documents WHERE {_LONG_ENOUGH}"
ORACLES["a1_json_lines"] = f"{_TRIMMED}, source FROM documents WHERE {_LONG_ENOUGH}"
ORACLES["a2_csv_rows"] = ORACLES["a1_json_arrays"]
ORACLES["a1_files"] = f"""
SELECT format, row_number() OVER (PARTITION BY format ORDER BY doc_id) - 1 AS ingest_seq, CAST(doc_id AS VARCHAR) AS source_id,
  length({trimmed('text')}) AS length, CASE WHEN {_LONG_ENOUGH} THEN '' ELSE 'raw_text_short' END AS rule
FROM documents, (VALUES ('json'), ('jsonl'), ('csv')) AS formats(format)"""
ORACLES["a3_reject_report"] = f"""
SELECT 'raw' AS stage, rule, count(*) AS n FROM (
  SELECT CASE doc_id % 10 WHEN 0 THEN 'raw_text_missing,raw_text_short'
    WHEN 1 THEN 'source_id_empty' || CASE WHEN {_LONG_ENOUGH} THEN '' ELSE ',raw_text_short' END
    WHEN 2 THEN 'not_an_object,source_id_empty'
    ELSE CASE WHEN {_LONG_ENOUGH} THEN NULL ELSE 'raw_text_short' END END AS rule
  FROM documents) WHERE rule IS NOT NULL GROUP BY rule"""
ORACLES["a5_record_cap"] = f"WITH {RAW} SELECT ingest_seq, source_id FROM raw ORDER BY ingest_seq LIMIT 100"

ORACLES["a5_first_files"] = f"""
WITH {RAW}, placed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents)
SELECT place AS ingest_seq, source_id, length(raw_text) AS length FROM raw JOIN placed ON doc_id = ingest_seq
ORDER BY place LIMIT (SELECT count(*) // 3 FROM documents)"""

_LANDED = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place FROM lineitem),
posts AS (SELECT * FROM (SELECT * FROM orders /*cap*/) WHERE o_orderkey <> 0),
landed AS (
  SELECT o_orderkey AS post_seq, CAST(place AS INTEGER) AS place, 'Order ' || o_orderpriority AS post_title,
    o_orderstatus AS post_body, l_partkey AS comment_id, 'line ' || CAST(l_linenumber AS VARCHAR) AS comment_name,
    CASE WHEN l_partkey % 5 <> 0 THEN l_returnflag || ' ' || l_linestatus END AS comment_body,
    '/posts/' || CAST(o_orderkey AS VARCHAR) || '/comments' AS source_url
  FROM placed JOIN posts ON l_orderkey = o_orderkey WHERE place <= 2)"""
_ALL_LANDED = _LANDED.replace(" WHERE place <= 2", "")
_COLUMNS = "post_seq, post_title, comment_id, comment_body"
ORACLES["a6_post_comments"] = f"WITH {_ALL_LANDED} SELECT {_COLUMNS} FROM landed"
ORACLES["a6_first_comments"] = f"WITH {_LANDED} SELECT {_COLUMNS} FROM landed"
ORACLES["a6_capped_fetch"] = (
    f"WITH {_LANDED.replace('/*cap*/', 'ORDER BY o_orderkey LIMIT 30')} SELECT {_COLUMNS} FROM landed ORDER BY post_seq, place LIMIT 30"
)
ORACLES["a7_article_cards"] = """
SELECT page_id, CAST(1 AS INTEGER) AS card_no,
  replace(trim(regexp_extract(html, '<article><h1>([^<]*)</h1>', 1)), '&amp;', '&') AS title FROM pages"""
ORACLES["a8_star_words"] = """
SELECT event_id, CASE WHEN event_id % 7 = 6 THEN 0 ELSE event_id % 7 END AS stars FROM events"""
ORACLES["a9_resolved_links"] = """
SELECT page_id, CAST(card_no AS INTEGER) AS card_no, replace(labels[card_no], '&amp;', '&') AS label,
  regexp_extract(url, '^(https?://[^/?#]+)', 1) || replace(links[card_no], '&amp;', '&') AS link
FROM (SELECT *, unnest(range(1, len(links) + 1)) AS card_no FROM (
  SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS links,
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS labels FROM pages))"""
_LINKS = """links AS (
  SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin, generate_subscripts(hrefs, 1) AS link_no,
    replace(unnest(hrefs), '&amp;', '&') AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages))"""
ORACLES["a9_page_links"] = f"WITH {_LINKS} SELECT page_id, link_no, 'a' AS tag, href, origin || href AS link FROM links"
ORACLES["a9_reference_forms"] = rf"""
WITH {_LINKS}, named AS (
  SELECT *, regexp_replace(href, '[^A-Za-z]', '', 'g') AS word, regexp_replace(url, '[?#].*$', '') AS bare,
    regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS parent FROM links)
SELECT page_id, link_no, CASE link_no % 6
  WHEN 0 THEN CASE WHEN parent = origin || '/' THEN parent ELSE regexp_replace(parent, '[^/]*/$', '') END || word
  WHEN 1 THEN bare || CASE WHEN word = '' THEN '?q=' ELSE '?q=' || word END
  WHEN 2 THEN regexp_replace(url, '#.*$', '') || CASE WHEN word = '' THEN '' ELSE '#' || word END
  WHEN 3 THEN CASE WHEN word = '' THEN parent ELSE parent || word || '/' END
  WHEN 4 THEN regexp_extract(url, '^(https?:)', 1) || '//other.example/' || word
  ELSE parent || word || ';v=1?q#f' END AS link FROM named"""
ORACLES["a10_card_texts"] = """
WITH cards AS (
  SELECT CAST(p_partkey AS VARCHAR) || '_1' AS comment_id,
    CASE WHEN p_partkey % 3 <> 0 THEN p_name WHEN p_partkey % 9 <> 0 THEN p_brand ELSE 'Unknown' END AS title,
    CASE WHEN p_partkey % 4 <> 0 THEN '£' || CAST(p_partkey % 90 AS VARCHAR) ELSE 'N/A' END AS price,
    p_partkey % 6 AS stars, CASE WHEN p_partkey % 5 <> 0 THEN 'In stock' ELSE 'Unknown' END AS stock
  FROM part)
SELECT comment_id, title AS post_title, title || ' - Price: ' || price || ' - Rating: ' || CAST(stars AS VARCHAR) || '/5' AS post_body,
  'Product: ' || title || '. Price: ' || price || '. Customer rating: ' || CAST(stars AS VARCHAR) ||
  ' out of 5 stars. Availability: ' || stock || '. Customers who rated this ' ||
  CASE WHEN stars >= 4 THEN 'highly recommend' ELSE 'have mixed opinions about' END || ' this product.' AS comment_body,
  stars AS star_rating FROM cards"""
ORACLES["a11_review_texts"] = f"""
WITH {_ALL_LANDED} SELECT post_seq AS ingest_seq,
  concat_ws(chr(10), 'Title: ' || post_title, 'Review Title: ' || comment_name,
    coalesce('Review: ' || comment_body, 'Content: ' || post_body)) AS raw_text FROM landed"""
ORACLES["a12_id_fallback"] = """
SELECT o_orderkey AS ingest_seq, CASE WHEN o_orderkey % 2 <> 0 THEN '1'
  WHEN o_orderkey % 3 <> 0 THEN 'p' || CAST(o_custkey AS VARCHAR) ELSE 'rec_' || CAST(o_orderkey AS VARCHAR) END AS source_id
FROM orders"""
ORACLES["a13_residual_metadata"] = f"""
WITH {_ALL_LANDED} SELECT post_seq AS ingest_seq,
  '{{"comment_id":' || CAST(comment_id AS VARCHAR) || ',"post_id":' ||
  CAST(post_seq AS VARCHAR) || ',"post_title":"' || post_title ||
  '","source_url":"' || source_url || '"}}' AS metadata FROM landed"""
ORACLES["a14_raw_contract"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS source_id, length({trimmed('text')}) AS length,
  CASE WHEN {_LONG_ENOUGH} THEN '' ELSE 'raw_text_short' END AS rule FROM documents"""

# --- B -----------------------------------------------------------------------------

_TEST_SCORED = f"{RAW}, {scored(TEST_NEGATIVE, TEST_POSITIVE)}"
ORACLES["b1_lexicon_sentiment"] = (
    f"WITH {_TEST_SCORED} SELECT source_id, sentiment, sentiment_score, urgency_level FROM scored"
)
_ENDED = f"""ended AS (
  SELECT ingest_seq, source_id, concat_ws(' ', raw_text,
    CASE WHEN ingest_seq % 4 < 3 THEN {strings(NEGATIVE_WORDS)}[ingest_seq % {len(NEGATIVE_WORDS)} + 1] END,
    CASE WHEN ingest_seq % 3 < 2 THEN {strings(POSITIVE_WORDS)}[ingest_seq % {len(POSITIVE_WORDS)} + 1] END,
    CASE WHEN ingest_seq % 5 = 0 THEN upper({strings(NEGATIVE_WORDS)}[ingest_seq % 7 + 1]) END) AS raw_text
  FROM raw)"""
ORACLES["b1_lexicon_table"] = (
    f"WITH {RAW}, {_ENDED}, {scored(source='ended')} SELECT source_id, sentiment, sentiment_score, urgency_level FROM scored"
)
_PRICES = ", ".join(
    f"('{name}', CAST({rate_in!r} AS DOUBLE), CAST({rate_out!r} AS DOUBLE), {place})"
    for place, (name, (rate_in, rate_out)) in enumerate(PRICE_PER_1K.items())
)
ORACLES["b4_price_table"] = f"""
WITH prices(model, input_price, output_price, place) AS (VALUES {_PRICES}),
usage AS (
  SELECT o_orderkey, coalesce((SELECT model FROM prices WHERE place = o_orderkey % 6), 'unlisted') AS model,
    o_orderdate < TIMESTAMP '1995-06-17' AS early, o_custkey * 10 AS i, o_orderkey % 1000 AS o FROM orders)
SELECT u.o_orderkey, u.model,
  {exact("(CAST(0 AS DOUBLE) + u.i * coalesce(f * p.input_price, CAST(0 AS DOUBLE)) + u.o * coalesce(f * p.output_price, CAST(0 AS DOUBLE))) / CAST(1000 AS DOUBLE)", 6)} AS cost_usd
FROM (SELECT u.*, CASE WHEN NOT early THEN 2 WHEN model <> 'claude-3-5-sonnet-20241022' THEN 1 END AS f FROM usage u) u
LEFT JOIN prices p ON u.model = p.model"""
ORACLES["b2_token_estimate"] = f"WITH {RAW} SELECT source_id, {tokens('raw_text')} AS tokens FROM raw"
ORACLES["b3_conversation_tokens"] = f"""
SELECT conv_id, CAST(sum({tokens("coalesce(text, '')")}) + 4 * count(*) + 2 AS BIGINT) AS tokens
FROM conversations GROUP BY conv_id"""


def _price(model: str, tokens_in: str, tokens_out: str) -> str:
    cases = " ".join(
        f"WHEN {model} = '{name}' THEN ({tokens_in} * {a!r}::DOUBLE + {tokens_out} * {b!r}::DOUBLE) / 1000"
        for name, (a, b) in PRICE_PER_1K.items()
    )
    return exact(f"CASE {cases} ELSE 0 END", 6)


_MODELS = "[" + ", ".join(f"'{name}'" for name in [*PRICE_PER_1K, "unlisted"]) + "]"
ORACLES["b4_cost_estimate"] = f"""
WITH {RAW}, usage AS (
  SELECT {_MODELS}[ingest_seq % 6 + 1] AS model, CAST(sum({tokens('raw_text')}) AS BIGINT) AS input_tokens, count(*) AS records
  FROM raw GROUP BY 1)
SELECT model, input_tokens, {_price('model', 'input_tokens', '(records * 200)')} AS cost_usd FROM usage"""
_PACKED = f"WITH RECURSIVE {RAW}, {BATCHES}"
ORACLES["b5_token_batches"] = f"{_PACKED} SELECT ingest_seq, cost, batch_no, cost > 5200 AS oversize FROM packed"
ORACLES["b6_single_prompt"] = f"""
WITH {RAW} SELECT source_id, '{_SINGLE[0]}' || raw_text || '{_SINGLE[1]}{SCHEMA_TEXT}{_SINGLE[2]}' AS prompt FROM raw"""
ORACLES["b7_batch_prompt"] = f"""
{_PACKED}, numbered AS (SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY ingest_seq) AS i FROM packed)
SELECT batch_no, '{_BATCH[0]}' || CAST(count(*) AS VARCHAR) || '{_BATCH[1]}' ||
  string_agg('REVIEW #' || CAST(i AS VARCHAR) || ' [source_id: ' || source_id || ']:' || chr(10) || raw_text,
    chr(10) || chr(10) ORDER BY i) || '{_BATCH[2]}' || CAST(count(*) AS VARCHAR) || '{_BATCH[3]}{SCHEMA_TEXT}{_BATCH[4]}' AS prompt,
  count(*) AS records
FROM numbered GROUP BY batch_no"""
_CONTRACT_COLUMNS = """source_id, product_name, product_category, lower(sentiment) AS sentiment, sentiment_score,
  confidence_score, review_date, summary, key_topics AS key_topics_str, pros AS pros_str, '' AS cons_str,
  '' AS competitors_str, reviewer_rating, reviewer_expertise, urgency_level, action_required, action_notes,
  data_quality, language_detected, is_spam_or_fake, errors"""
ORACLES["b8_reply_parsing"] = f"""
WITH {CONTRACT} SELECT ingest_seq // {RECORDS_PER_REPLY} AS batch_no,
  ingest_seq % {RECORDS_PER_REPLY} + CASE WHEN (ingest_seq // {RECORDS_PER_REPLY}) % 5 = 4 THEN 1 ELSE 0 END AS place,
  {_CONTRACT_COLUMNS} FROM contract WHERE (ingest_seq // {RECORDS_PER_REPLY}) % 5 <> 3"""
_LEXICON_DRAFT = """'Unknown' AS product_name, sentiment, sentiment_score, 0.85::DOUBLE AS confidence_score,
  'Unknown: word lists say ' || sentiment || CASE WHEN urgency_level = 'high' THEN '; needs an answer.' ELSE '.' END AS summary,
  urgency_level, urgency_level = 'high' AS action_required,
  CASE WHEN urgency_level = 'high' THEN 'Answer this customer first.' END AS action_notes,
  'unknown' AS product_category, 'medium' AS data_quality, 'en' AS language_detected"""
ORACLES["b9_lexicon_analyzer"] = f"WITH {_TEST_SCORED} SELECT source_id, {_LEXICON_DRAFT} FROM scored"
_ASKED = f"""{RAW}, asked AS (
  SELECT source_id, raw_text, right(source_id, 1) IN ('3', '7') AS again, contains(raw_text, ' der ') AS broken FROM raw),
outcomes AS (
  SELECT source_id, 'analyzed' AS outcome, 'Text of 0 characters.' AS summary, true AS known FROM asked WHERE NOT again
  UNION ALL SELECT 'other-' || source_id, 'analyzed', 'Text of 0 characters.', false FROM asked WHERE right(source_id, 1) = '7'
  UNION ALL SELECT source_id, 'analyzed', 'Text of ' || CAST(length(raw_text) AS VARCHAR) || ' characters.', true
    FROM asked WHERE again AND NOT broken
  UNION ALL SELECT source_id, 'failed', NULL, true FROM asked WHERE again AND broken)"""
ORACLES["b10_reconciliation"] = f"WITH {_ASKED} SELECT source_id, outcome, summary FROM outcomes"
ORACLES["b11_run_metrics"] = f"""
WITH {_ASKED}, totals AS (
  SELECT (SELECT count(*) FROM raw) AS total_input,
    (SELECT count(*) FROM outcomes WHERE outcome = 'analyzed') AS successful,
    (SELECT count(*) FROM outcomes WHERE outcome = 'failed') AS failed,
    (SELECT CAST(sum({tokens('raw_text')}) AS BIGINT) FROM raw) AS total_tokens_used)
SELECT 'run' AS batch_id, total_input, successful, failed, successful / CAST(total_input AS DOUBLE) AS success_rate,
  12.5::DOUBLE AS processing_time_seconds, {exact('12.5::DOUBLE / total_input', 4)} AS avg_time_per_record,
  'gpt-4o-mini' AS model_used, total_tokens_used,
  {_price("'gpt-4o-mini'", 'total_tokens_used', '(successful * 200)')} AS estimated_cost_usd FROM totals"""
_BROKEN = "product_name,sentiment,sentiment_score,confidence_score,summary"
ORACLES["b10_rejects"] = f"""
WITH {_ASKED} SELECT source_id, 'analyzed' AS stage, '{_BROKEN}' AS rule FROM outcomes WHERE outcome = 'failed'"""
ORACLES["b8_reply_rejects"] = f"""
WITH batches AS (SELECT DISTINCT event_id // {RECORDS_PER_REPLY} AS batch_no FROM events)
SELECT 'reply' AS stage, 'reply_unreadable' AS rule, CAST(NULL AS VARCHAR) AS item FROM batches WHERE batch_no % 5 = 3
UNION ALL SELECT 'reply', 'item_not_an_object', unnest(['"note"', '17', 'null']) FROM batches WHERE batch_no % 5 = 4"""

# --- C -----------------------------------------------------------------------------

ORACLES["c_reject_report"] = f"""
WITH {CONTRACT} SELECT 'analyzed' AS stage, errors AS rule, count(*) AS n FROM contract WHERE errors <> '' GROUP BY errors"""
ORACLES["c_full_contract"] = f"WITH {CONTRACT} SELECT ingest_seq, {_CONTRACT_COLUMNS} FROM contract"
for _name, _columns in {
    "c1_source_id": "source_id",
    "c2_rating": "reviewer_rating",
    "c3_confidence": "confidence_score",
    "c4_sentiment_score": "sentiment_score",
    "c5_expertise": "reviewer_expertise",
    "c7_language": "language_detected",
    "c8_labels": "product_category, urgency_level, data_quality",
    "c9_lengths": "product_name, summary, action_notes",
    "c10_escalation": "urgency_level, action_required",
    "c11_critical_action": "urgency_level, action_required",
    "c12_spam_quality": "is_spam_or_fake, data_quality",
}.items():
    ORACLES[_name] = f"WITH {CONTRACT} SELECT ingest_seq, {_columns}, errors FROM contract"
ORACLES["c6_lists"] = f"""
WITH {CONTRACT} SELECT ingest_seq, key_topics, pros, '' AS cons, '' AS mentioned_competitors FROM contract"""
ORACLES["c13_defaults"] = """
SELECT event_id AS ingest_seq, 'unknown' AS product_category, 'low' AS urgency_level, false AS action_required,
  'medium' AS data_quality, 'en' AS language_detected, false AS is_spam_or_fake, CAST(0 AS BIGINT) AS topics,
  '2024-01-01' AS analyzed_on FROM events"""

# --- D -----------------------------------------------------------------------------

_REVIEWS = f"WITH {REVIEWS}"
_CLEAN = f"WITH {CLEAN}"
_JOINED = "array_to_string(key_topics, '|') AS key_topics%s, array_to_string(mentioned_competitors, '|') AS "
ORACLES["d1_flat_lists"] = f"{_REVIEWS} SELECT ingest_seq, {_JOINED % '_str'}competitors_str FROM reviews"
ORACLES["d2_lower_labels"] = f"""
{_REVIEWS} SELECT ingest_seq, lower(sentiment) AS sentiment, urgency_level, data_quality FROM reviews"""
ORACLES["d3_utc_times"] = """
SELECT event_id AS ingest_seq, strftime(CASE event_id % 4 WHEN 2 THEN ts - INTERVAL 3 HOUR WHEN 3 THEN NULL ELSE ts END,
  '%Y-%m-%d %H:%M:%S') AS review_date FROM events"""
ORACLES["d4_typed_values"] = """
SELECT event_id AS ingest_seq, CASE WHEN event_id % 5 > 1 THEN CAST(event_id % 7 AS DOUBLE) END AS reviewer_rating,
  event_id % 3 = 0 AS is_verified_purchase FROM events"""
ORACLES["d5_spam_filter"] = f"{_REVIEWS} SELECT ingest_seq, is_spam_or_fake FROM reviews WHERE NOT is_spam_or_fake"
ORACLES["d6_confidence_filter"] = f"""
{_REVIEWS} SELECT ingest_seq, confidence_score FROM reviews WHERE confidence_score IS NULL OR confidence_score >= 0.5"""
ORACLES["d7_null_filter"] = f"{_REVIEWS} SELECT ingest_seq, source_id FROM reviews WHERE sentiment IS NOT NULL"
for _name, _columns in {
    "d8_rating_range": "reviewer_rating",
    "d9_clipped_score": "sentiment_score",
    "d10_first_per_id": "source_id",
    "d11_trimmed_labels": "sentiment, urgency_level",
}.items():
    ORACLES[_name] = f"{_CLEAN} SELECT ingest_seq, {_columns} FROM cleaned"
ORACLES["d12_product_names"] = f"""
{_CLEAN} SELECT ingest_seq, CASE WHEN ingest_seq % 5 IN (2, 3) THEN product_name ELSE 'Unknown' END AS product_name
FROM cleaned"""
ORACLES["d13_removal_audit"] = f"""
WITH {REVIEWS}, steps AS (
  SELECT CASE WHEN is_spam_or_fake THEN 'spam' WHEN confidence_score < 0.5 THEN 'low_confidence'
    WHEN sentiment IS NULL THEN 'null_critical'
    WHEN row_number() OVER (PARTITION BY source_id, is_spam_or_fake OR coalesce(confidence_score < 0.5, false)
      OR sentiment IS NULL ORDER BY ingest_seq) > 1 THEN 'duplicate' END AS step FROM reviews),
names AS (SELECT unnest(['spam', 'low_confidence', 'null_critical', 'duplicate', 'total']) AS step)
SELECT (SELECT count(*) FROM steps) AS initial, names.step,
  count(steps.step) AS removed, count(steps.step) / CAST((SELECT count(*) FROM steps) AS DOUBLE) AS removed_share
FROM names LEFT JOIN steps ON steps.step = names.step OR (names.step = 'total' AND steps.step IS NOT NULL)
GROUP BY names.step"""

# --- E -----------------------------------------------------------------------------

_SERIES = ", ".join(SERIES.names)
_DAILY = f"WITH {DAILY}"
_WEEKLY = f"{CLEAN}, {series(WEEK)}"
ORACLES["e1_safe_mean"] = f"""
{_CLEAN} SELECT {exact(mean('sentiment_score'), 4)} AS mean_score, 0::DOUBLE AS mean_of_nothing FROM cleaned"""
_MICROS = "o_totalprice * 1e6::DOUBLE"
_SIGNED = f"CASE WHEN o_orderkey % 2 = 0 THEN {_MICROS} ELSE o_totalprice * -1e6::DOUBLE END"
ORACLES["e1_large_mean"] = "SELECT " + ", ".join(
    exact(f"CAST(sum(CAST({value} AS DECIMAL(38, 6))) AS DOUBLE) / count(*)", 4) + f" AS {name}"
    for name, value in (("mean_micros", _MICROS), ("mean_mixed", _SIGNED))
) + " FROM orders"
ORACLES["e2_value_counts"] = f"{_CLEAN} SELECT product_name AS value, count(*) AS count FROM cleaned GROUP BY 1"
ORACLES["e3_top_topics"] = f"{_CLEAN}, {TOPICS} SELECT * FROM topics"
ORACLES["e4_topics_from_text"] = ORACLES["e3_top_topics"]
ORACLES["e5_competitors"] = f"{_CLEAN}, {COMPETITORS} SELECT * FROM competitors"
ORACLES["e5_competitors_from_text"] = ORACLES["e5_competitors"]
ORACLES["e6_time_series_day"] = f"{_DAILY} SELECT {_SERIES} FROM series ORDER BY period"
ORACLES["e7_time_series_week"] = f"WITH {_WEEKLY} SELECT {_SERIES} FROM series ORDER BY period"
ORACLES["e8_anomalies"] = (
    f"{_DAILY}, {alerts(2.0)} SELECT period, metric, value, z_score, severity, mean, std FROM alerts ORDER BY m, period"
)
ORACLES["e9_severity"] = f"{_DAILY}, {alerts(0.5)} SELECT period, metric, severity FROM alerts"
ORACLES["e10_anomaly_flag"] = f"{_DAILY}, {alerts(2.0)} SELECT count(*) > 0 AS anomaly_detected FROM alerts"
_SCALARS = f"""count(*) AS total_reviews_analyzed,
  count(*) FILTER (data_quality = 'high') AS high_quality_reviews,
  coalesce({exact(mean('sentiment_score'), 4)}, 0) AS average_sentiment_score,
  {exact(mean('reviewer_rating'), 2)} AS average_rating,
  coalesce({exact(mean('confidence_score'), 4)}, 0) AS average_confidence"""
_ESCALATE = "(sentiment = 'negative' AND coalesce(reviewer_rating <= 2, false) AND urgency_level = 'low')"
ORACLES["e11_scalar_kpis"] = f"""
{_CLEAN} SELECT {_SCALARS},
  count(*) FILTER ({_ESCALATE} OR urgency_level = 'critical') AS action_required_count,
  count(*) FILTER (urgency_level = 'critical') AS critical_urgency_count,
  count(*) FILTER ({_ESCALATE} OR urgency_level = 'high') AS high_urgency_count FROM cleaned"""
ORACLES["e12_spam_excluded"] = f"{_REVIEWS} SELECT count(*) FILTER (is_spam_or_fake) AS spam_excluded FROM reviews"
_COUNTS = """counts AS (
  SELECT 'sentiment' AS dimension, sentiment AS value, count(*) AS count FROM cleaned GROUP BY sentiment
  UNION ALL SELECT 'product_category', product_category, count(*) FROM cleaned GROUP BY product_category
  UNION ALL SELECT 'language_detected', language_detected, count(*) FROM cleaned GROUP BY language_detected
  UNION ALL SELECT 'data_quality', data_quality, count(*) FROM cleaned GROUP BY data_quality)"""
ORACLES["e13_distributions"] = f"{_CLEAN}, {_COUNTS} SELECT * FROM counts"


def _pairs(counts: str) -> str:
    return f"(SELECT string_agg(value || '=' || CAST(count AS VARCHAR), ';' ORDER BY count DESC, value) FROM {counts})"


def _tidy(ctes: str, more: str = "") -> str:
    return f"""
WITH {ctes}, {alerts(2.0)}, {TOPICS}, {COMPETITORS}, {_COUNTS}
SELECT {_SCALARS},
  (SELECT count(*) FILTER (is_spam_or_fake) FROM reviews) AS spam_excluded,
  CAST(0 AS BIGINT) AS action_required_count,
  count(*) FILTER (urgency_level = 'critical') AS critical_urgency_count,
  count(*) FILTER (urgency_level = 'high') AS high_urgency_count,
  {_pairs("(SELECT * FROM counts WHERE dimension = 'sentiment')")} AS sentiment_distribution,
  {_pairs("(SELECT * FROM counts WHERE dimension = 'data_quality')")} AS data_quality_distribution,
  {_pairs("(SELECT * FROM counts WHERE dimension = 'product_category')")} AS category_distribution,
  {_pairs("(SELECT * FROM counts WHERE dimension = 'language_detected')")} AS language_distribution,
  {_pairs('competitors')} AS competitor_mentions,
  (SELECT string_agg(printf('%s=%d/%.3f', topic, count, avg_sentiment), ';' ORDER BY count DESC, topic) FROM topics) AS top_topics,
  (SELECT string_agg(printf('%s:%d/%.4f', period, review_count, avg_sentiment), ';' ORDER BY period) FROM series) AS time_series_data,
  (SELECT coalesce(string_agg(printf('%s %s %.3f %s', metric, period, z_score, severity), ';' ORDER BY m, period), '') FROM alerts)
    AS anomaly_details,
  (SELECT count(*) > 0 FROM alerts) AS anomaly_detected{more}
FROM cleaned"""


ORACLES["e14_summary_document"] = _tidy(DAILY, ", 'r1' AS report_id, '2024-01-01 00:00:00' AS generated_at")
_SHARE = "count / CAST(sum(count) OVER (PARTITION BY dimension) AS DOUBLE)"
ORACLES["e15_shares"] = f"""
{_CLEAN}, {_COUNTS} SELECT dimension, value, count, {exact(_SHARE, 4)} AS share,
  printf('%.1f%%', {exact(f'{_SHARE} * 100', 1)}) AS percent FROM counts"""
ORACLES["e16_report_topics"] = f"{_CLEAN}, {TOPICS} SELECT * FROM topics ORDER BY count DESC, topic LIMIT 5"
ORACLES["e16_report_periods"] = f"{_DAILY} SELECT {_SERIES} FROM series ORDER BY period DESC LIMIT 5"

# --- F -----------------------------------------------------------------------------

ORACLES["f1_export_columns"] = f"""
{_CLEAN} SELECT source_id, product_name, product_category, language_detected, sentiment, sentiment_score, confidence_score, reviewer_rating, urgency_level,
  array_to_string(key_topics, '|') AS key_topics_str, array_to_string(mentioned_competitors, '|') AS mentioned_competitors,
  data_quality, is_spam_or_fake FROM cleaned"""
ORACLES["f2_json_records"] = f"""
{_CLEAN} SELECT source_id, product_name, product_category, language_detected, sentiment, sentiment_score, confidence_score, reviewer_rating, urgency_level,
  array_to_string(key_topics, '|') AS key_topics_str, array_to_string(mentioned_competitors, '|') AS mentioned_competitors,
  data_quality, 'false' AS is_spam_or_fake, confidence_score IS NULL AS confidence_score_blank,
  reviewer_rating IS NULL AS reviewer_rating_blank FROM cleaned"""
ORACLES["f3_csv_records"] = f"""
{_CLEAN} SELECT source_id, product_name, product_category, language_detected, sentiment, printf('%.4f', sentiment_score) AS sentiment_score,
  CASE WHEN confidence_score IS NOT NULL THEN printf('%.4f', confidence_score) END AS confidence_score,
  CASE WHEN reviewer_rating IS NOT NULL THEN printf('%.4f', reviewer_rating) END AS reviewer_rating, urgency_level,
  array_to_string(key_topics, '|') AS key_topics_str, array_to_string(mentioned_competitors, '|') AS mentioned_competitors,
  data_quality, 'False' AS is_spam_or_fake FROM cleaned"""
_TOTAL = "(SELECT count(*) FROM cleaned)"
_LABEL = list(KPI_LABELS.values())
_FIXED = [
    "CAST(count(*) AS VARCHAR) AS value FROM cleaned",
    "CAST(count(*) FILTER (data_quality = 'high') AS VARCHAR) FROM cleaned",
    "CAST(count(*) FILTER (is_spam_or_fake) AS VARCHAR) FROM reviews",
    f"printf('%+.4f', {exact(mean('sentiment_score'), 4)}) FROM cleaned",
    f"printf('%.2f/5.0', {exact(mean('reviewer_rating'), 2)}) FROM cleaned",
    f"printf('%.1f%%', {exact(exact(mean('confidence_score'), 4) + ' * 100', 1)}) FROM cleaned",
    "'0'",
    "CAST(count(*) FILTER (urgency_level = 'critical') AS VARCHAR) FROM cleaned",
    "CAST(count(*) FILTER (urgency_level = 'high') AS VARCHAR) FROM cleaned",
]
_CAPITALS = "upper(word[1]) || word[2:]"
_TITLE = f"array_to_string(list_transform(string_split(value, '_'), lambda word: {_CAPITALS}), ' ')"
ORACLES["f4_kpi_table"] = f"""
{_CLEAN}, {_COUNTS}, listed AS (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY count DESC, value) AS place FROM counts)
""" + " UNION ALL ".join(
    f"SELECT {place} AS position, '{_LABEL[place]}' AS label, {value}" for place, value in enumerate(_FIXED)
) + f"""
UNION ALL SELECT 8 + place, {_TITLE}, printf('%d (%.1f%%)', count, {exact(f'count / CAST({_TOTAL} AS DOUBLE) * 100', 1)})
  FROM listed WHERE dimension = 'sentiment'
UNION ALL SELECT 8 + place + (SELECT count(*) FROM counts WHERE dimension = 'sentiment'), {_TITLE}, CAST(count AS VARCHAR)
  FROM listed WHERE dimension = 'product_category'"""
ORACLES["f5_sentiment_table"] = f"""
{_CLEAN}, {_COUNTS} SELECT upper(value[1]) || value[2:] AS sentiment, count,
  {exact(f'count / CAST({_TOTAL} AS DOUBLE)', 4)} AS share FROM counts WHERE dimension = 'sentiment'"""
ORACLES["f9_formats"] = f"""
{_CLEAN}, written AS (SELECT source_id, printf('%.4f', sentiment_score) AS score FROM cleaned)
SELECT 'csv' AS format, 'reviews_analysis_20240101_000000.csv' AS name, source_id AS key, score AS value FROM written
UNION ALL SELECT 'json', 'reviews_analysis_20240101_000000.json', source_id, score FROM written
UNION ALL SELECT 'kpi', 'reviews_analysis_20240101_000000.kpi', '1', CAST(count(*) AS VARCHAR) FROM written
UNION ALL SELECT 'broken', NULL, NULL, NULL"""
ORACLES["f6_headings"] = f"""
{_CLEAN} SELECT source_id AS "Source Id", sentiment_score AS "Sentiment Score",
  array_to_string(key_topics, '|') AS "Key Topics" FROM cleaned"""
ORACLES["f7_joined_lists"] = f"{_CLEAN} SELECT source_id, {_JOINED % ''}mentioned_competitors FROM cleaned"

# --- G -----------------------------------------------------------------------------

_ACTION = "CASE WHEN urgency_level = 'high' THEN 1 ELSE 0 END"
ORACLES["g1_full_run"] = f"""
WITH {_TEST_SCORED}, labels_found AS (SELECT sentiment AS value, count(*) AS count FROM scored GROUP BY sentiment)
SELECT count(*) AS total_reviews_analyzed, CAST(0 AS BIGINT) AS spam_excluded, {_pairs('labels_found')} AS sentiment_distribution,
  {exact(mean('sentiment_score'), 4)} AS average_sentiment_score, 0.85::DOUBLE AS average_confidence,
  'unknown=' || CAST(count(*) AS VARCHAR) AS category_distribution, 'en=' || CAST(count(*) AS VARCHAR) AS language_distribution,
  CAST(sum({_ACTION}) AS BIGINT) AS action_required_count, CAST(sum({_ACTION}) AS BIGINT) AS high_urgency_count,
  false AS anomaly_detected FROM scored"""
ORACLES["g1_run_tables"] = f"""
WITH {_TEST_SCORED}, short AS (SELECT doc_id FROM documents WHERE length({trimmed('text')}) < 10)
SELECT 'clean' AS name, source_id, sentiment AS value FROM scored
UNION ALL SELECT 'csv', source_id, printf('%.4f', sentiment_score) FROM scored
UNION ALL SELECT 'rejects', CAST(doc_id AS VARCHAR), 'raw_text_short' FROM short
UNION ALL SELECT 'summary', NULL, CAST(count(*) AS VARCHAR) FROM scored
UNION ALL SELECT 'runs', NULL, CAST(count(*) AS VARCHAR) FROM scored"""
ORACLES["g2_analytics"] = _tidy(_WEEKLY)
ORACLES["g3_run_record"] = f"""
WITH {RAW} SELECT 'success' AS status, count(*) AS records_scraped, count(*) AS records_analyzed,
  CAST(1 AS DOUBLE) AS success_rate, false AS anomaly_detected FROM raw"""
