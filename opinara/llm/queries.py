"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.chat import digests, format_chats
from opinara.llm.collocations import collocations
from opinara.llm.common import in_part, table
from opinara.llm.decontaminate import find_leaks, leaked_pairs
from opinara.llm.html_extract import extract_pages, learn, training_pages
from opinara.llm.langid import identify, training_sample
from opinara.llm.line_dedup import dedup_lines
from opinara.llm.lm import score_texts
from opinara.llm.mixing import mix
from opinara.llm.packing import pack
from opinara.llm.quality import quality_rules
from opinara.llm.simhash import near_duplicates
from opinara.llm.spelling import spelling_variants
from opinara.llm.toxicity import score, train

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return leaked_pairs(find_leaks(docs, table(spark, folder, "benchmark")))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract_pages(pages, learn(training_pages(pages)))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = in_part(F.col("doc_id"), 5, 0)
    model = train(docs, table(spark, folder, "labels"), ~held_out & F.col("doc_id").isNotNull())
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    texts = training_sample(docs, ~in_part(F.col("doc_id"), 3, 1))
    found = identify(docs, texts)
    return found.select("doc_id", in_part(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "letters_per_phrase")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(told).alias("text"),
    )
    return digests(format_chats(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    held_out = in_part(F.col("doc_id"), 7, 2)
    found = score_texts(table(spark, folder, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), with_ids=False)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"))


def op11_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents")).select("word", "n", "n_near", "form", "form_n", "root")


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_html_extraction": op3_html_extraction,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_source_mixing": op11_source_mixing,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}
# Written from the contract: lengths of the marks, the escaped texts, and the machine's steps.
CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
escaped AS (
    SELECT *, regexp_replace(
        text, '([<\[])(\\*)(/?s>|/?SYS\]|/?INST\]|OUT\]|/?TURN\]|TEXT\])', '\1\\\2\3', 'g'
    ) AS inside FROM turns
),
conversation AS (
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
        3 + sum(length(inside) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
            ELSE 23 + length(role) END) AS formatted_chars,
        string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
            ORDER BY turn NULLS FIRST, role, text) AS roles
    FROM escaped GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars,
    CASE WHEN NOT regexp_full_match(roles, 's?(ua)*u?') THEN 'error' WHEN roles = 's' THEN 'ready'
        WHEN roles LIKE '%u' THEN 'asked' ELSE 'answered' END AS state,
    regexp_full_match(roles, 's?(ua)*u?') AS valid
FROM conversation
"""
# All deletion variants of all lines, spelled out; document ids are unique here.
LINES_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n
    FROM documents
),
worded AS (
    SELECT doc_id, n, line, list_filter(string_split_regex(line, '[ \t\x0B\f\r]+'), lambda w: w <> '') AS words FROM lines
),
plain AS (SELECT *, array_to_string(words, ' ') AS plain, {'d': doc_id, 'n': n} AS place FROM worded WHERE len(words) > 0),
firsts AS (SELECT plain, any_value(words) AS words, min(place) AS early FROM plain GROUP BY plain),
cut AS (SELECT plain, words, early, unnest(range(1, len(words) + 1)) AS p FROM firsts WHERE len(words) >= 10),
changed AS (
    SELECT plain, early, array_to_string(words[1:p - 1] || [chr(1)] || words[p + 1:], ' ') AS variant FROM cut
),
shorter AS (
    SELECT DISTINCT plain, early, array_to_string(words[1:p - 1] || words[p + 1:], ' ') AS variant FROM cut WHERE len(words) > 10
),
added AS (
    SELECT s.plain AS long, f.plain AS short, s.early AS long_early, f.early AS short_early
    FROM shorter s JOIN firsts f ON s.variant = f.plain
),
gone AS (
    SELECT plain FROM (SELECT plain, early, min(early) OVER (PARTITION BY variant) AS least FROM changed) WHERE early > least
    UNION SELECT CASE WHEN long_early > short_early THEN long ELSE short END FROM added
),
judged AS (
    SELECT w.doc_id, w.n, w.line, len(w.words) > 0 AS worded,
        len(w.words) > 0 AND (g.plain IS NOT NULL OR f.early <> {'d': w.doc_id, 'n': w.n}) AS removed
    FROM worded w LEFT JOIN firsts f ON array_to_string(w.words, ' ') = f.plain
    LEFT JOIN gone g ON array_to_string(w.words, ' ') = g.plain
)
SELECT d.doc_id, coalesce(count(*) FILTER (j.worded), 0) AS n_lines, coalesce(count(*) FILTER (j.removed), 0) AS n_removed,
    CASE WHEN any_value(d.text) IS NOT NULL
        THEN coalesce(string_agg(j.line, chr(10) ORDER BY j.n) FILTER (NOT j.removed), '') END AS text
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id
"""
# The level of words per weight is found by trying every source as the first free one; ranks are summed in one sort.
MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13))::BIGINT + CAST(0.5 AS DOUBLE))
            / CAST(4503599627370496 AS DOUBLE) AS u
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS words,
        [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
    FROM sized GROUP BY source
),
tried AS (
    SELECT s.source, s.words * 3 AS bound, s.weight, s.words,
        (CAST((SELECT sum(words) FROM sources) AS DOUBLE) - coalesce(sum(3 * o.words) FILTER (o.source IS NOT NULL OR o.words IS NOT NULL), 0))
            / ((SELECT sum(weight) FROM sources) - coalesce(sum(o.weight), 0)) AS level
    FROM sources s LEFT JOIN sources o ON o.words * CAST(3 AS DOUBLE) / o.weight < s.words * CAST(3 AS DOUBLE) / s.weight
        OR (o.words * CAST(3 AS DOUBLE) / o.weight = s.words * CAST(3 AS DOUBLE) / s.weight
            AND coalesce(o.source < s.source, o.source IS NOT NULL))
    GROUP BY s.source, s.words, s.weight
),
levelled AS (SELECT arg_min(level, bound / CAST(weight AS DOUBLE)) FILTER (level * weight <= bound) AS level FROM tried),
aimed AS (
    SELECT source, words, least(CAST(bound AS DOUBLE), coalesce(l.level * weight, CAST(bound AS DOUBLE))) AS target
    FROM tried, levelled l
),
planned AS (
    SELECT *, target - whole * words AS room, ratio - whole AS p FROM (
        SELECT *, CAST(floor(ratio) AS BIGINT) AS whole FROM (
            SELECT *, CASE WHEN words > 0 THEN target / words ELSE 0 END AS ratio FROM aimed))
),
ranked AS (
    SELECT s.*, p.words, p.target, p.whole, p.room,
        CASE WHEN p.p > 0 AND s.size <= p.room THEN (u / (1 - u)) / (p.p / (1 - p.p)) END AS rank
    FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
),
walked AS (
    SELECT source, rank, room, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source, room ORDER BY rank) AS after
    FROM ranked WHERE rank IS NOT NULL GROUP BY source, rank, room
),
filled AS (
    SELECT source, coalesce(max(rank) FILTER (after <= room), -1) AS cut,
        max(room) - coalesce(max(after) FILTER (after <= room), 0) AS missing FROM walked GROUP BY source
),
further AS (
    SELECT w.source, arg_min(w.rank, {'miss': abs(w.size - f.missing), 'rank': w.rank}) AS extra
    FROM walked w JOIN filled f ON w.source IS NOT DISTINCT FROM f.source
    WHERE w.rank > f.cut AND abs(w.size - f.missing) < f.missing GROUP BY w.source
),
chosen AS (
    SELECT r.*, CAST(r.whole + CASE WHEN coalesce(r.rank <= f.cut OR r.rank = e.extra, false) THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM ranked r LEFT JOIN filled f ON r.source IS NOT DISTINCT FROM f.source
    LEFT JOIN further e ON r.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source, words AS source_size, target, copies, copies * size AS taken FROM chosen
"""
# All phrases of up to five words, spelled out and counted.
PHRASE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS p FROM worded),
sized AS (SELECT lang, words, p, k FROM placed, (SELECT unnest(range(1, 6)) AS k) WHERE p + k - 1 <= len(words)),
counted AS (
    SELECT lang, array_to_string(words[p:p + k - 1], ' ') AS phrase, k, count(*) AS f FROM sized GROUP BY ALL HAVING count(*) >= 100
),
candidates AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE k > 1),
starts AS (SELECT *, unnest(range(1, size + 1)) AS b FROM candidates),
inner_ AS (SELECT lang, size, a, words, b, unnest(range(b + 1, size + 1)) AS e FROM starts),
covered AS (SELECT DISTINCT lang, array_to_string(words[b:e], ' ') AS phrase, a FROM inner_ WHERE e - b + 1 < size),
kept AS (SELECT c.* FROM candidates c ANTI JOIN covered o ON c.lang = o.lang AND c.phrase = o.phrase AND 100 * o.a >= 100 * c.a),
cut AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.k,
        CAST((1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cut c JOIN counted x ON c.lang = x.lang AND x.phrase = array_to_string(c.words[1:c.k], ' ')
    JOIN counted y ON c.lang = y.lang AND y.phrase = array_to_string(c.words[c.k + 1:], ' ')
    JOIN totals t ON c.lang = t.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
ORACLES: dict[str, str] = {
    "op6_line_dedup": LINES_SQL,
    "op7_chat_formatting": CHAT_SQL,
    "op11_source_mixing": MIX_SQL,
    "op12_collocations": PHRASE_SQL,
}
