"""DuckDB oracle SQL, one statement per registered query.

These restate each query independently in plain SQL (brute force where the
Spark plan is clever) so the driver can compare results value by value.
"""

from __future__ import annotations

from ..schemas import BLOOM_KEYWORDS, QTYPES
from .oracle_views import ITEMS, SENT, with_ctes

SEP = "chr(31)"
ORACLE: dict[str, str] = {}

WS_SPLIT = r"'([.!?])\s+'"


def sents(x: str) -> str:
    return (f"list_filter(list_transform(string_split(regexp_replace(coalesce({x}, ''), {WS_SPLIT}, "
            rf"'\1' || chr(1), 'g'), chr(1)), lambda y: regexp_replace(y, '^\s+|\s+$', '', 'g')), "
            "lambda y: y <> '')")


def words(x: str, var: str = "t") -> str:
    return (rf"list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}]+'), "
            f"lambda {var}: {var} <> '')")


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def words_or_text(x: str) -> str:
    trimmed = strip(f"coalesce({x}, '')")
    return f"(CASE WHEN len({words(x)}) > 0 THEN {words(x)} WHEN {trimmed} <> '' THEN [{trimmed}] ELSE []::VARCHAR[] END)"


def jn(x: str, alias: str) -> str:
    return f"array_to_string({x}, {SEP}) AS {alias}"


ORACLE["sentences"] = with_ctes(SENT) + """
SELECT doc_id, CAST(p AS INTEGER) AS p, l[p + 1] AS q
FROM (SELECT doc_id, l, unnest(range(len(l))) AS p FROM sent)"""

ORACLE["items"] = with_ctes(ITEMS) + f"""
SELECT chapter_id, topic_pos, seq, qtype, bloom, bloom_ord, question, {jn('options', 'options')},
       answer, explanation, reference_answer, {jn('reference_points', 'reference_points')},
       {jn('variations', 'variations')}
FROM items"""

DUP_KEY = f"CASE WHEN len(terms) > 0 THEN array_to_string(terms, ' ') ELSE {strip('question')} END"

ORACLE["exact_duplicates"] = with_ctes(ITEMS, """it AS (
  SELECT chapter_id, topic_pos, seq, qtype, """ + DUP_KEY + """ AS norm FROM items)""", """w AS (
  SELECT *, count(*) OVER (PARTITION BY norm) AS n_corpus,
         first_value(chapter_id) OVER (PARTITION BY norm ORDER BY chapter_id, seq) AS first_chapter_id,
         first_value(seq) OVER (PARTITION BY norm ORDER BY chapter_id, seq) AS first_seq,
         count(*) OVER (PARTITION BY chapter_id, topic_pos, norm) AS n_topic,
         min(seq) OVER (PARTITION BY chapter_id, topic_pos, norm) AS first_topic_seq
  FROM it)""") + """
SELECT chapter_id, topic_pos, seq, qtype, n_corpus, first_chapter_id, first_seq, n_topic,
       (chapter_id <> first_chapter_id OR seq <> first_seq) AS dup_in_corpus,
       (seq <> first_topic_seq) AS dup_in_topic
FROM w WHERE n_corpus > 1"""

_PTS = f"list_filter(list_transform(coalesce(reference_points, []), lambda x: {strip('x')}), lambda x: x <> '')"
_LEGACY = (f"list_filter(list_transform(string_split(regexp_replace({strip("coalesce(reference_answer, '')")}, "
           rf"{WS_SPLIT}, '\1' || chr(1), 'g'), chr(1)), lambda y: {strip('y')}), lambda y: y <> '')")

FLAGS = f"""flags AS (
  SELECT *, CASE WHEN qtype = 'long_answer' THEN
              (CASE WHEN len({_PTS}) > 0 THEN {_PTS} ELSE {_LEGACY} END)
            END AS points
  FROM items)"""


def _blank(f: str) -> str:
    return f"coalesce(length({strip(f)}) = 0, true)"


KEYWORDS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{b}')" for b, ks in BLOOM_KEYWORDS.items() for k in ks) + ") t(keyword, kw_bloom)"


RULES = [
    ("mcq_answer_not_in_options", "incorrect", "critical",
     "qtype = 'MCQs' AND NOT coalesce(list_contains(coalesce(options, []), answer), false)"),
    ("mcq_options_not_four_distinct", "poor_quality", "high",
     "qtype = 'MCQs' AND len(list_distinct(coalesce(options, []))) <> 4"),
    ("mcq_all_none_of_above", "poor_quality", "medium",
     "qtype = 'MCQs' AND len(list_filter(coalesce(options, []), "
     "lambda x: regexp_matches(lower(x), '(all|none) of the above'))) > 0"),
    ("mcq_explanation_length", "poor_quality", "low",
     f"qtype = 'MCQs' AND NOT len({sents('explanation')}) BETWEEN 1 AND 2"),
    ("blank_marker_missing", "incorrect", "critical",
     "qtype = 'fill_in_the_blanks' AND NOT coalesce(contains(question, '_____'), false)"),
    ("blank_answer_length", "poor_quality", "medium",
     f"qtype = 'fill_in_the_blanks' AND NOT len({words('answer')}) BETWEEN 1 AND 3"),
    ("short_answer_length", "poor_quality", "medium",
     f"qtype = 'short_answer' AND NOT len({sents('reference_answer')}) BETWEEN 2 AND 4"),
    ("long_answer_point_count", "poor_quality", "high",
     "qtype = 'long_answer' AND NOT len(points) BETWEEN 3 AND 6"),
    ("long_answer_point_too_long", "poor_quality", "medium",
     f"qtype = 'long_answer' AND len(list_filter(points, lambda x: len({words('x')}) >= 20)) > 0"),
    ("long_answer_points_repeated", "poor_quality", "medium",
     "qtype = 'long_answer' AND len(list_distinct(points)) < len(points)"),
    ("required_field_blank", "unclear", "high",
     f"((qtype = 'MCQs' AND ({_blank('question')} OR len(coalesce(options, [])) = 0 OR {_blank('answer')} "
     f"OR {_blank('explanation')})) OR (qtype = 'fill_in_the_blanks' AND ({_blank('question')} OR {_blank('answer')}))"
     f" OR (qtype = 'short_answer' AND ({_blank('question')} OR {_blank('reference_answer')}))"
     f" OR (qtype = 'long_answer' AND {_blank('question')}))"),
    ("mcq_options_not_uniform", "poor_quality", "low",
     "qtype = 'MCQs' AND len(list_distinct(list_transform(coalesce(options, []), lambda x: regexp_matches(x, '[.!?]$')))) > 1"),
    ("level_keyword_mismatch", "poor_quality", "medium",
     "list_has_any(terms, (SELECT list(keyword) FROM kw)) AND NOT list_has_any(terms, "
     "coalesce((SELECT list(keyword) FROM kw WHERE kw_bloom = bloom), []))"),
    ("variations_not_five_unique", "poor_quality", "medium",
     "len(coalesce(variations, [])) > 0 AND (len(variations) <> 5 OR len(list_distinct(variations)) < len(variations) "
     "OR coalesce(list_contains(variations, question), false))"),
    ("variation_shape_lost", "poor_quality", "medium",
     "(qtype = 'fill_in_the_blanks' AND len(list_filter(coalesce(variations, []), lambda x: NOT contains(x, '_____'))) > 0) "
     "OR (qtype = 'MCQs' AND len(list_filter(coalesce(variations, []), lambda x: "
     "len(string_split(coalesce(regexp_extract(x, 'Options: ([^|]*)', 1), ''), '; ')) <> 4)) > 0)"),
]

RULE_CONDITION = {name: condition for name, _, _, condition in RULES}

RULE_ISSUES = f"kw AS ({KEYWORDS_SQL}),\nrule_issues AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT chapter_id, topic_pos, qtype, seq, '{n}' AS rule, '{t}' AS issue_type, '{s}' AS severity "
    f"FROM flags WHERE {c}" for n, t, s, c in RULES) + ")"

DUP_ISSUES = """dup_issues AS (
  SELECT chapter_id, topic_pos, qtype, seq, 'exact_duplicate' AS rule, 'duplicate' AS issue_type,
         'critical' AS severity
  FROM (SELECT *, min(seq) OVER (PARTITION BY chapter_id, topic_pos, norm) AS first_seq
        FROM (SELECT *, """ + DUP_KEY + """ AS norm FROM items))
  WHERE seq <> first_seq)"""

NEAR_PAIRS = """sets AS (SELECT chapter_id, topic_pos, seq, list_sort(list_distinct(CASE WHEN len(terms) > 0 THEN terms ELSE [""" + strip('question') + """] END)) AS st FROM items),
cls AS (SELECT *, len(st) AS n, min(seq) OVER (PARTITION BY chapter_id, topic_pos, st) AS rep FROM sets),
ex AS (SELECT chapter_id, topic_pos, seq, n, unnest(st) AS w FROM cls WHERE seq = rep),
pairs AS (SELECT a.chapter_id, a.topic_pos, a.seq AS seq_a, b.seq AS seq_b, count(*) AS inter,
                 any_value(a.n) AS na, any_value(b.n) AS nb
          FROM ex a JOIN ex b ON a.chapter_id = b.chapter_id AND a.topic_pos = b.topic_pos AND a.w = b.w
                              AND a.seq < b.seq
          GROUP BY 1, 2, 3, 4)"""

NEAR_ISSUES = """links AS (
  SELECT chapter_id, topic_pos, seq_a, seq_b FROM pairs WHERE inter * 5 >= (na + nb - inter) * 4
  UNION ALL SELECT chapter_id, topic_pos, rep, seq FROM cls WHERE seq <> rep),
both_ways AS (SELECT * FROM links UNION ALL SELECT chapter_id, topic_pos, seq_b, seq_a FROM links),
reached AS (
  SELECT DISTINCT chapter_id, topic_pos, seq_a AS seq, seq_a AS low FROM both_ways
  UNION
  SELECT r.chapter_id, r.topic_pos, b.seq_b, r.low
  FROM reached r JOIN both_ways b ON b.chapter_id = r.chapter_id AND b.topic_pos = r.topic_pos AND b.seq_a = r.seq),
near_issues AS (
  SELECT i.chapter_id, i.topic_pos, i.qtype, i.seq, 'near_duplicate' AS rule, 'duplicate' AS issue_type, 'high' AS severity
  FROM items i JOIN (SELECT chapter_id, topic_pos, seq, min(low) AS low FROM reached GROUP BY ALL) r USING (chapter_id, topic_pos, seq)
  WHERE r.low < i.seq AND NOT EXISTS (SELECT 1 FROM dup_issues d WHERE d.chapter_id = i.chapter_id AND d.seq = i.seq))"""

ORDER_ISSUES = """order_issues AS (
  SELECT chapter_id, topic_pos, qtype, seq, 'level_out_of_order' AS rule, 'poor_quality' AS issue_type, 'low' AS severity
  FROM items i WHERE EXISTS (SELECT 1 FROM items j WHERE j.chapter_id = i.chapter_id AND j.topic_pos = i.topic_pos AND j.qtype = i.qtype
                                                     AND j.seq < i.seq AND j.bloom_ord > i.bloom_ord))"""

ISSUES = [ITEMS, FLAGS, RULE_ISSUES, DUP_ISSUES, NEAR_PAIRS, NEAR_ISSUES, ORDER_ISSUES,
          "issues AS (SELECT * FROM rule_issues UNION ALL SELECT * FROM dup_issues UNION ALL SELECT * FROM near_issues UNION ALL SELECT * FROM order_issues)"]

ORACLE["item_issues"] = with_ctes(*ISSUES, recursive=True) + "SELECT * FROM issues"

TOPIC_Q = """topic_q AS (
  SELECT t.chapter_id, t.topic_pos, t.n_items, coalesce(i.n_issues, 0) AS n_issues,
         CASE WHEN i.worst IS NULL THEN 'excellent' WHEN i.worst <= 2 THEN 'good'
              WHEN i.worst = 3 THEN 'fair' ELSE 'poor' END AS overall_quality,
         coalesce(i.has_dup, false) AS has_duplicates
  FROM (SELECT chapter_id, topic_pos, count(*) AS n_items FROM items GROUP BY ALL) t
  LEFT JOIN (SELECT chapter_id, topic_pos, count(*) AS n_issues,
                    max(CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END) AS worst,
                    bool_or(issue_type = 'duplicate') AS has_dup
             FROM issues GROUP BY ALL) i USING (chapter_id, topic_pos))"""

ORACLE["topic_quality"] = with_ctes(*ISSUES, TOPIC_Q, recursive=True) + "SELECT * FROM topic_q"

ORACLE["chapter_quality"] = with_ctes(*ISSUES, TOPIC_Q, recursive=True) + """
SELECT chapter_id, count(*) AS n_topics, CAST(sum(n_issues) AS BIGINT) AS total_issues,
       bool_and(overall_quality NOT IN ('poor', 'fair') AND NOT has_duplicates) AS overall_pass
FROM topic_q GROUP BY chapter_id"""

ORACLE["combine_pages"] = """
SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS content
FROM conversations GROUP BY conv_id"""

ORACLE["structural_violations"] = with_ctes(ITEMS, FLAGS) + f"""
, v AS (
  SELECT qtype, 'required_field_missing' AS rule FROM flags
   WHERE (qtype = 'MCQs' AND (question IS NULL OR options IS NULL OR answer IS NULL OR explanation IS NULL))
      OR (qtype = 'fill_in_the_blanks' AND (question IS NULL OR answer IS NULL))
      OR (qtype = 'short_answer' AND (question IS NULL OR reference_answer IS NULL))
      OR (qtype = 'long_answer' AND question IS NULL)
  UNION ALL SELECT qtype, 'required_field_blank' FROM flags WHERE {RULE_CONDITION['required_field_blank']}
  UNION ALL SELECT qtype, 'mcq_not_four_options' FROM flags WHERE qtype = 'MCQs' AND coalesce(len(options), 0) <> 4
  UNION ALL SELECT qtype, 'unknown_level' FROM flags
   WHERE NOT coalesce(bloom IN ('remember', 'understand', 'apply', 'analyze', 'evaluate', 'create'), false)
  UNION ALL SELECT qtype, 'long_answer_without_points' FROM flags WHERE qtype = 'long_answer' AND len(points) = 0
  UNION ALL SELECT qtype, 'section_not_six_levels' FROM
   (SELECT chapter_id, topic_pos, qtype FROM items GROUP BY ALL HAVING count(DISTINCT bloom) <> 6))
SELECT qtype, rule, count(*) AS n_violations FROM v GROUP BY ALL"""

ORACLE["coverage_cube"] = with_ctes(ITEMS) + """
SELECT chapter_id, qtype, bloom, count(*) AS n_items FROM items
GROUP BY GROUPING SETS ((chapter_id, qtype, bloom), (chapter_id, qtype), (chapter_id, bloom), (chapter_id))"""

ORACLE["issue_rollup"] = with_ctes(*ISSUES, recursive=True) + """
SELECT severity, issue_type, count(*) AS n_issues, grouping(severity, issue_type) AS gid
FROM issues GROUP BY ROLLUP (severity, issue_type)"""

TOPIC_COUNTS = """chap AS (
  SELECT chapter_id, count(*) AS n_topics, CASE WHEN count(*) < 5 THEN 8 ELSE 5 END AS qpl
  FROM (SELECT DISTINCT chapter_id, topic_pos FROM items) GROUP BY chapter_id)"""

ORACLE["coverage_gaps"] = with_ctes(ITEMS, TOPIC_COUNTS) + """
, grid AS (
  SELECT t.chapter_id, t.topic_pos, c.qpl, q.qtype, b.bloom
  FROM (SELECT DISTINCT chapter_id, topic_pos FROM items) t JOIN chap c USING (chapter_id)
  CROSS JOIN (SELECT unnest(['MCQs', 'fill_in_the_blanks', 'short_answer', 'long_answer']) AS qtype) q
  CROSS JOIN (SELECT unnest(['remember', 'understand', 'apply', 'analyze', 'evaluate', 'create']) AS bloom) b)
SELECT g.chapter_id, g.topic_pos, g.qtype, g.bloom, CAST(g.qpl AS BIGINT) AS expected,
       coalesce(a.n, 0) AS actual
FROM grid g LEFT JOIN (SELECT chapter_id, topic_pos, qtype, bloom, count(*) AS n FROM items GROUP BY ALL) a
  USING (chapter_id, topic_pos, qtype, bloom)
WHERE coalesce(a.n, 0) <> g.qpl"""

ORACLE["expected_volume"] = with_ctes(ITEMS, TOPIC_COUNTS) + """
SELECT chapter_id, n_topics, CAST(qpl AS BIGINT) AS questions_per_level, CAST(qpl * 6 AS BIGINT) AS per_type,
       CAST(qpl * 24 AS BIGINT) AS per_topic, CAST(qpl * 24 * n_topics AS BIGINT) AS expected_items,
       CAST(qpl * 24 * n_topics * 6 AS BIGINT) AS expected_with_variations, a.actual_items
FROM chap JOIN (SELECT chapter_id, count(*) AS actual_items FROM items GROUP BY ALL) a USING (chapter_id)"""

ORACLE["mcq_rules"] = with_ctes(ITEMS) + f"""
SELECT chapter_id, seq,
       coalesce(list_contains(coalesce(options, []), answer), false) AS answer_in_options,
       len(list_distinct(coalesce(options, []))) = 4 AS four_distinct,
       len(list_filter(coalesce(options, []), lambda x: regexp_matches(lower(x), '(all|none) of the above'))) > 0
         AS all_none_of_above,
       len({sents('explanation')}) AS explanation_sentences,
       list_max(list_transform(options, lambda x: length(x))) - list_min(list_transform(options, lambda x: length(x)))
         AS option_len_spread,
       len(list_distinct(list_transform(coalesce(options, []), lambda x: regexp_matches(x, '[.!?]$')))) <= 1
         AS punctuation_uniform
FROM items WHERE qtype = 'MCQs'"""

ORACLE["fill_blank_rules"] = with_ctes(ITEMS) + f"""
SELECT chapter_id, seq, coalesce(contains(question, '_____'), false) AS has_marker,
       len({words('answer')}) AS answer_words, len({words('answer')}) BETWEEN 1 AND 3 AS answer_ok
FROM items WHERE qtype = 'fill_in_the_blanks'"""

ORACLE["short_answer_rules"] = with_ctes(ITEMS) + f"""
SELECT chapter_id, seq, len({sents('reference_answer')}) AS answer_sentences,
       len({sents('reference_answer')}) BETWEEN 2 AND 4 AS answer_ok
FROM items WHERE qtype = 'short_answer'"""

ORACLE["long_answer_points"] = with_ctes(ITEMS, FLAGS) + f"""
SELECT chapter_id, seq, array_to_string(points, chr(31)) AS points, len(points) AS n_points,
       CASE WHEN len({_PTS}) > 0 OR length({strip("coalesce(reference_answer, '')")}) > 0 THEN ''
            ELSE coalesce(reference_answer, '') END AS reference_answer,
       (len({_PTS}) = 0 AND length({strip("coalesce(reference_answer, '')")}) = 0) AS rejected
FROM flags WHERE qtype = 'long_answer'"""

ORACLE["long_answer_rules"] = with_ctes(ITEMS, FLAGS) + f"""
SELECT chapter_id, seq, len(points) AS n_points, len(points) BETWEEN 3 AND 6 AS count_ok,
       coalesce(list_max(list_transform(points, lambda x: len({words('x')}))), 0) AS max_point_words,
       len(list_distinct(points)) = len(points) AS points_distinct
FROM flags WHERE qtype = 'long_answer'"""

# --- responses -------------------------------------------------------------
PY_WS_RE2 = r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def pystrip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WS_RE2}+|{PY_WS_RE2}+$', '', 'g')"


def clean(x: str) -> str:
    t = pystrip(x)
    t = f"regexp_replace({t}, '^(?:```json)?(?:```)?', '')"
    t = rf"regexp_replace({t}, '```\z', '')"
    t = rf"regexp_replace({t}, '[\x00-\x08\x0b-\x1f\x7f-\x9f]', ' ', 'g')"
    return pystrip(t)


_A, _B, _C = "terms[1]", "array_to_string(list_slice(terms, 1, 2), ' ')", "array_to_string(list_slice(terms, 1, 3), ' ')"
RAW = f"""raw_view AS (
  SELECT chapter_id, topic_pos, seq, qtype, bloom, question, variations,
         (CASE WHEN seq % 5 = 0 THEN chr(7) ELSE '' END)
         || (CASE WHEN seq % 3 = 0 THEN '```json' || chr(10) || body1 || chr(10) || '```' ELSE body1 END)
         || (CASE WHEN seq % 5 = 1 THEN chr(13) || chr(10) || '  ' ELSE '' END) AS raw
  FROM (SELECT *, CASE WHEN seq % 11 = 10 THEN substring(body, 1, length(body) - 1) ELSE body END AS body1
        FROM (SELECT *, CASE (seq + chapter_id) % 8
          WHEN 0 THEN '["  ' || {_B} || '  ", "' || {_A} || '", " "]'
          WHEN 1 THEN '{{"variations": [{{"variation_1": "' || {_C} || '", "variation_10": "' || {_A}
                      || '", "variation_2": "  "}}, "' || {_B} || '"]}}'
          WHEN 2 THEN '[{{"question": " ", "text": "' || {_C} || '"}}, {{"prompt": "' || {_A} || '"}}]'
          WHEN 3 THEN '{{"question": "' || {_B} || '", "reference_points": ["' || {_A} || '", " ", "' || {_C} || '"]}}'
          WHEN 4 THEN '[{{"answer": "' || {_C} || '", "options": ["' || {_A} || '", " ", "' || {_B} || '"]}}, {{"options": []}}]'
          WHEN 5 THEN '{{"variations": [{{"reference_answer": "' || {_C} || '"}}, {{"question": "' || {_A}
                      || '", "reference_answer": "' || {_B} || '"}}]}}'
          WHEN 6 THEN '{{"other": 1}}'
          ELSE '7' END AS body
        FROM (SELECT * REPLACE (CASE WHEN len(terms) > 0 THEN terms
                                     ELSE [regexp_replace({strip('question')}, '["\\\\]', '', 'g')] END AS terms) FROM items))))"""

PARSED = f"""parsed_view AS (
  SELECT *, CASE WHEN json_valid(cleaned) THEN cleaned::JSON END AS parsed
  FROM (SELECT *, {clean('raw')} AS cleaned FROM raw_view))"""


def pystr(o: str) -> str:
    o = f"({o})"
    return (f"(CASE WHEN {o} IS NULL OR json_type({o}) = 'NULL' THEN 'None' "
            f"WHEN json_type({o}) = 'BOOLEAN' THEN (CASE WHEN {o}::VARCHAR = 'true' THEN 'True' ELSE 'False' END) "
            f"WHEN json_type({o}) IN ('OBJECT', 'ARRAY') THEN json_extract({o}, '$')::VARCHAR "
            f"WHEN json_type({o}) = 'VARCHAR' THEN json_extract_string({o}, '$') ELSE {o}::VARCHAR END)")


def str_field(x: str, k: str) -> str:
    return (f"(CASE WHEN json_type({x}->'{k}') = 'VARCHAR' AND {pystrip(f'({x}->>' + repr(k) + ')')} <> '' "
            f"THEN {pystrip(f'({x}->>' + repr(k) + ')')} END)")


def joined_list(x: str, k: str) -> str:
    inner = (f"array_to_string(list_filter(list_transform(from_json({x}->'{k}', '[\"json\"]'), "
             f"lambda o: {pystrip(pystr('o'))}), lambda s: s <> ''), '; ')")
    return f"(CASE WHEN json_type({x}->'{k}') = 'ARRAY' THEN nullif({inner}, '') END)"


def normalize(x: str, is_mcq: str) -> str:
    bundle_vals = (f"list_filter(list_transform(list_filter(list_sort(json_keys({x})), "
                   f"lambda k: starts_with(k, 'variation_')), lambda k: {pystrip(pystr(x + '->k'))}), "
                   "lambda s: s <> '')")
    bundle = f"(CASE WHEN len({bundle_vals}) > 0 THEN array_to_string({bundle_vals}, ' | ') END)"
    text = "coalesce(" + ", ".join(str_field(x, k) for k in
                                   ["question", "variation_text", "variation", "text", "prompt"]) + ")"
    head = (f"array_to_string(list_filter([{text}, CASE WHEN {is_mcq} THEN 'Options: ' || {joined_list(x, 'options')} END, "
            f"CASE WHEN {is_mcq} THEN 'Answer: ' || {str_field(x, 'answer')} END, "
            f"'Key points: ' || {joined_list(x, 'reference_points')}], lambda s: s IS NOT NULL), ' | ')")
    ref = str_field(x, "reference_answer")
    base = (f"list_transform([{head}], lambda h: CASE WHEN {ref} IS NULL THEN h WHEN h = '' THEN {ref} "
            f"ELSE h || ' | Reference answer: ' || {ref} END)[1]")
    return (f"(CASE WHEN json_type({x}) = 'VARCHAR' THEN {pystrip(f'json_extract_string({x}, {chr(39)}${chr(39)})')} "
            f"WHEN json_type({x}) = 'OBJECT' AND {bundle} IS NOT NULL THEN {bundle} "
            f"WHEN json_type({x}) = 'OBJECT' THEN list_transform([{base}], "
            f"lambda b: CASE WHEN b <> '' THEN b ELSE json_extract({x}, '$')::VARCHAR END)[1] "
            f"ELSE {pystrip(pystr(x))} END)")


UNWRAP = """(CASE WHEN json_type(parsed) = 'OBJECT' AND list_contains(json_keys(parsed), 'variations')
      THEN (CASE WHEN json_type(parsed->'variations') = 'ARRAY' THEN from_json(parsed->'variations', '["json"]')
                 ELSE [parsed->'variations'] END)
      WHEN json_type(parsed) = 'ARRAY' THEN from_json(parsed, '["json"]') ELSE [parsed] END)"""

VAR_RESULTS = PARSED + f""",
var_results AS (
  SELECT *, CASE WHEN norm IS NULL THEN []::VARCHAR[]
              ELSE list_concat(norm, list_transform(range(greatest(5 - len(norm), 0)), lambda i: coalesce(norm[1], question)))
            END AS new_variations
  FROM (SELECT *, CASE WHEN parsed IS NOT NULL THEN
                    list_filter(list_transform({UNWRAP}, lambda x: {normalize('x', "qtype = 'MCQs'")}),
                                lambda s: s IS NOT NULL AND s <> '') END AS norm
        FROM parsed_view))"""

ORACLE["clean_responses"] = with_ctes(ITEMS, RAW, PARSED) + """
SELECT chapter_id, seq, cleaned, parsed IS NOT NULL AS parsed_ok FROM parsed_view"""

ORACLE["normalize_variations"] = with_ctes(ITEMS, RAW, VAR_RESULTS) + """
SELECT chapter_id, seq, array_to_string(norm, chr(31)) AS normalized, len(norm) AS n_normalized FROM var_results"""

ORACLE["pad_variations"] = with_ctes(ITEMS, RAW, VAR_RESULTS) + """
SELECT chapter_id, seq, array_to_string(new_variations, chr(31)) AS variations FROM var_results"""

ORACLE["variation_rules"] = with_ctes(ITEMS, RAW, VAR_RESULTS) + """
SELECT chapter_id, seq, qtype, len(new_variations) AS n_variations,
       len(list_distinct(new_variations)) AS n_unique,
       list_contains(new_variations, question) AS repeats_original,
       len(new_variations) = 5 AND len(list_distinct(new_variations)) = 5 AND NOT list_contains(new_variations, question) AS five_unique,
       CASE WHEN qtype = 'MCQs' THEN
              coalesce(list_bool_and(list_transform(new_variations, lambda s:
                len(string_split(coalesce(regexp_extract(s, 'Options: ([^|]*)', 1), ''), '; ')) = 4)), true)
            WHEN qtype = 'fill_in_the_blanks' THEN
              coalesce(list_bool_and(list_transform(new_variations, lambda s: contains(s, '_____'))), true)
            ELSE true END AS shape_kept
FROM var_results"""

ORACLE["variation_tally"] = with_ctes(ITEMS, RAW, VAR_RESULTS) + """
SELECT i.chapter_id, count(*) AS items_requested, count(*) FILTER (WHERE r.parsed IS NULL) AS calls_failed,
       CAST(coalesce(sum(len(coalesce(r.new_variations, []))), 0) AS BIGINT) AS variations_obtained
FROM items i LEFT JOIN var_results r USING (chapter_id, seq)
WHERE len(coalesce(i.variations, [])) = 0
GROUP BY i.chapter_id"""

ORACLE["merge_variations"] = with_ctes(ITEMS, RAW, VAR_RESULTS) + """
SELECT i.chapter_id, i.seq,
       array_to_string(CASE WHEN len(coalesce(i.variations, [])) > 0 THEN i.variations
                            ELSE coalesce(r.new_variations, []) END, chr(31)) AS variations
FROM items i LEFT JOIN var_results r USING (chapter_id, seq)"""

# --- corpus preparation ------------------------------------------------------
ORACLE["path_metadata"] = """
WITH p AS (
  SELECT doc_id AS chapter_id, CASE doc_id % 6
        WHEN 0 THEN '/corpus/CBSE/' || lang || '/medium ' || lang || '/' || source || '/chapter ' || doc_id
        WHEN 1 THEN '/corpus/Sample/' || lang || '/' || source || '/chapter ' || doc_id
        WHEN 2 THEN '/corpus/Sample/CBSE/' || lang || '/x/' || source || '/chapter ' || doc_id
        WHEN 3 THEN '/corpus/other/' || lang || '/' || source || '/chapter ' || doc_id
        WHEN 4 THEN '/corpus/' || source || '/Sample/' || lang
        ELSE '/corpus/Sample/' || lang || '/' || source || '/unit-' || doc_id || '-b' || (doc_id % 7) END AS path
  FROM documents),
q AS (SELECT *, string_split(path, '/') AS parts FROM p),
r AS (SELECT *, coalesce(list_position(parts, 'CBSE'), 0) AS pc, coalesce(list_position(parts, 'Sample'), 0) AS ps FROM q),
s AS (SELECT *, CASE WHEN pc > 0 THEN pc WHEN ps > 0 THEN ps END AS a FROM r)
SELECT chapter_id, path,
       CASE WHEN a IS NOT NULL THEN coalesce(parts[a + 1], 'Unknown') END AS class_name,
       CASE WHEN a IS NOT NULL THEN coalesce(parts[a + CASE WHEN pc > 0 THEN 3 ELSE 2 END], 'Unknown') END AS subject_name,
       CASE WHEN a IS NOT NULL THEN coalesce(parts[a + CASE WHEN pc > 0 THEN 4 ELSE 3 END], 'Unknown') END AS chapter_name,
       parts[-1] AS dir_name,
       nullif(regexp_extract(parts[-1], '[0-9]+', 0), '') AS chapter_number,
       CASE WHEN a IS NULL THEN 'Could not find CBSE or Sample in path: ' || path END AS error
FROM s"""

TOPIC_TITLES = (r"list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN (i - 1) % 4 = 3 "
                r"THEN doc_id || '.' || i || ' Zzq recap' ELSE doc_id || '.' || i || ' ' || "
                r"coalesce(nullif(array_to_string(list_slice(" + words("x", "u") + r", 1, 3), ' '), ''), 'part') END)")

ENTRIES = f"""ent AS (
  SELECT source AS subject_key, -doc_id AS chapter_pos,
         CASE doc_id % 3 WHEN 0 THEN 'Chapter ' || doc_id WHEN 1 THEN CAST(doc_id AS VARCHAR)
              ELSE 'unit: chapter ' || doc_id || '!' END AS label,
         CASE WHEN doc_id % 7 = 0 AND doc_id % 4 <> 0 THEN NULL ELSE 'Unit ' || doc_id END AS title,
         CASE WHEN doc_id % 10 = 9 THEN []::VARCHAR[] ELSE {TOPIC_TITLES} END AS topics
  FROM documents WHERE doc_id % 13 <> 12),
ch AS (SELECT doc_id AS chapter_id, source AS subject_key, 'chapter ' || doc_id AS dir_name,
              CAST(doc_id AS VARCHAR) AS chapter_number FROM documents),
m AS (
  SELECT c.chapter_id, min(e.chapter_pos) AS chapter_pos
  FROM ch c JOIN ent e ON c.subject_key = e.subject_key
   AND (lower(e.label) = lower(c.dir_name) OR contains(lower(e.label), lower(c.dir_name))
        OR lower(e.label) = c.chapter_number)
  GROUP BY c.chapter_id),
matched AS (
  SELECT m.chapter_id, m.chapter_pos, e.label, e.topics
  FROM m JOIN ch USING (chapter_id) JOIN ent e ON e.subject_key = ch.subject_key AND e.chapter_pos = m.chapter_pos)"""

ORACLE["syllabus_scan"] = with_ctes(ENTRIES) + """
SELECT subject_key, chapter_pos, label, title, array_to_string(topics, chr(31)) AS topics, label AS shown_label FROM ent"""

ORACLE["syllabus_match"] = with_ctes(ENTRIES) + """
SELECT chapter_id, chapter_pos, label, len(topics) AS n_topics,
       CAST(CASE WHEN len(topics) < 5 THEN 8 ELSE 5 END AS BIGINT) AS questions_per_level
FROM matched"""

_REJECTS = with_ctes(ENTRIES) + """
, rej AS (
  SELECT chapter_id, subject_key, 'not_in_syllabus' AS reason FROM ch WHERE chapter_id NOT IN (SELECT chapter_id FROM matched)
  UNION ALL
  SELECT chapter_id, subject_key, 'no_topics' FROM matched JOIN ch USING (chapter_id) WHERE len(topics) = 0)
"""
ORACLE["chapter_rejects"] = _REJECTS + "SELECT chapter_id, reason FROM rej"
ORACLE["available_labels"] = _REJECTS + """
SELECT subject_key, chapter_pos, label FROM ent WHERE subject_key IN (SELECT subject_key FROM rej)"""

ORACLE["explode_topics"] = with_ctes(ENTRIES) + """
SELECT chapter_id, CAST(i - 1 AS INTEGER) AS topic_pos, topics[i] AS topic, '[' || i || '/' || len(topics) || ']' AS progress
FROM (SELECT *, unnest(range(1, len(topics) + 1)) AS i FROM matched)"""


def _pos(s: str, pat: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, {pat}) THEN strpos({s}, regexp_extract({s}, {pat})) ELSE 0 END)"


_P1 = _pos("content", r"'(?i)#+ \Q' || topic || '\E'")
_P3 = _pos("content", r"'(?i)\Q' || topic || '\E'")
_P4 = _pos("content", r"'(?i)\Q' || regexp_replace(topic, '^\d+\.\d+\s+', '') || '\E'")

ORACLE["topic_sections"] = with_ctes(ENTRIES) + f"""
, headed AS (
  SELECT doc_id AS chapter_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
           (CASE (i - 1) % 4 WHEN 0 THEN '# ' || tt[i] WHEN 1 THEN tt[i]
                 WHEN 2 THEN '# ' || regexp_replace(tt[i], '^\\d+\\.\\d+\\s+', '')
                 ELSE '# ' || doc_id || '.' || i || ' Section' END) || chr(10) || x), chr(10)) AS content
  FROM (SELECT *, {TOPIC_TITLES} AS tt FROM documents)),
t AS (SELECT chapter_id, CAST(i - 1 AS INTEGER) AS topic_pos, topics[i] AS topic
      FROM (SELECT *, unnest(range(1, len(topics) + 1)) AS i FROM matched)),
p AS (SELECT t.*, h.content, {_P1} AS p1, {_P3} AS p3, {_P4} AS p4 FROM t JOIN headed h USING (chapter_id)),
s AS (SELECT *, CASE WHEN p1 > 0 THEN 1 WHEN p3 > 0 THEN 3 WHEN p4 > 0 THEN 4 END AS strategy,
             CASE WHEN p1 > 0 THEN p1 WHEN p3 > 0 THEN p3 WHEN p4 > 0 THEN p4 END AS st FROM p),
n AS (SELECT *, {_pos("substring(content, st + length(topic))", r"'\n#+ \d+\.\d+'")} AS nxt FROM s WHERE strategy IS NOT NULL),
raw AS (SELECT *, substring(content, st, CASE WHEN nxt > 0 THEN length(topic) + nxt - 1 ELSE length(content) END) AS r FROM n
        UNION ALL SELECT *, 0 AS nxt, content AS r FROM s WHERE strategy IS NULL)
SELECT chapter_id, topic_pos, topic, strategy, CAST(coalesce(st - 1, -1) AS INTEGER) AS start, length(r) AS section_len,
       CAST(k AS INTEGER) AS part_pos, substring(r, k * 3000 + 1, 3000) AS section
FROM (SELECT *, unnest(range(greatest(CAST(ceil(length(r) / 3000.0) AS BIGINT), 1))) AS k FROM raw)"""

# --- run bookkeeping ---------------------------------------------------------
ORACLE["skip_processed"] = """
SELECT doc_id AS chapter_id, source AS subject_key FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

ORACLE["content_default"] = """
SELECT d.doc_id AS chapter_id, length(coalesce(f.text, '')) AS content_len, f.text IS NULL AS missing_file
FROM documents d LEFT JOIN (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) f USING (doc_id)"""

FAILED = """sec AS (
  SELECT chapter_id, topic_pos, qtype, count(DISTINCT bloom) = 6 AS ok FROM items GROUP BY ALL),
pt AS (SELECT chapter_id, topic_pos, count(*) FILTER (WHERE ok) AS sections_ok FROM sec GROUP BY ALL),
failed AS (
  SELECT pt.chapter_id, pt.topic_pos, pt.sections_ok,
         coalesce((SELECT bool_or(p2.sections_ok = 4) FROM pt p2 WHERE p2.chapter_id = pt.chapter_id), false)
           AS chapter_has_success
  FROM pt WHERE sections_ok < 4)"""

ORACLE["failed_topics"] = with_ctes(ITEMS, FAILED) + "SELECT * FROM failed"

ORACLE["run_summary"] = with_ctes(ENTRIES, ITEMS, FAILED) + """
, st AS (
  SELECT d.doc_id AS chapter_id,
         CASE WHEN l.doc_id IS NOT NULL THEN 'skipped'
              WHEN d.doc_id NOT IN (SELECT chapter_id FROM matched)
                OR d.doc_id IN (SELECT chapter_id FROM matched WHERE len(topics) = 0)
                OR d.doc_id IN (SELECT chapter_id FROM failed WHERE NOT chapter_has_success)
                OR d.doc_id NOT IN (SELECT chapter_id FROM items) THEN 'failed'
              ELSE 'processed' END AS status,
         l.quality = 0 AS output_empty
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) FILTER (WHERE status = 'processed') AS processed,
       count(*) FILTER (WHERE status = 'skipped') AS skipped,
       count(*) FILTER (WHERE status = 'failed') AS failed,
       count(*) FILTER (WHERE status = 'processed' OR (status = 'skipped' AND NOT output_empty)) AS legacy_processed,
       count(*) FILTER (WHERE status = 'skipped' AND output_empty) AS legacy_skipped
FROM st"""

# --- request tables ----------------------------------------------------------
from ..functions import prompts as _pr  # noqa: E402

_ts = ORACLE["topic_sections"]
_cut = _ts.index("\nSELECT chapter_id, topic_pos, topic, strategy,")
SECTIONS = _ts[len("WITH "):_cut] + ",\nsections AS (" + _ts[_cut:] + ")"


def _section_prompt_sql(q: str) -> str:
    label, fields = _pr.requested(q)
    user = _pr.render_sql(_pr.SECTION_TEMPLATE, n="CAST(qpl AS VARCHAR)", label=_pr._sql_lit(label), topic="topic",
                          class_name="class_name", subject_name="subject_name", chapter_name="chapter_name",
                          content="section", key=_pr._sql_lit(q), fields=_pr._sql_lit(fields))
    return _pr.render_sql(_pr.TYPED_WRAP, system=_pr._sql_lit(_pr.SYSTEM_GENERATE), user=user,
                          schema=_pr._sql_lit(_pr.schema_text(q)))


ORACLE["section_requests"] = "WITH " + SECTIONS + f"""
, meta AS (
  SELECT d.doc_id AS chapter_id, d.lang AS class_name, d.source AS subject_name, 'chapter ' || d.doc_id AS chapter_name,
         CASE WHEN len(m.topics) < 5 THEN 8 ELSE 5 END AS qpl
  FROM documents d JOIN matched m ON m.chapter_id = d.doc_id),
req AS (
  SELECT s.chapter_id, s.topic_pos, s.part_pos, q.qtype, s.topic, s.section, meta.*
  FROM sections s JOIN meta USING (chapter_id)
  CROSS JOIN (SELECT unnest(['MCQs', 'fill_in_the_blanks', 'short_answer', 'long_answer']) AS qtype) q),
rp AS (SELECT *, CASE qtype {" ".join(f"WHEN '{q}' THEN {_section_prompt_sql(q)}" for q in QTYPES)} END AS prompt
      FROM req)
SELECT 'generate:' || chapter_id || ':' || topic_pos || ':' || part_pos || ':' || qtype AS request_id, chapter_id, topic_pos, part_pos, qtype,
       length(prompt) AS prompt_len, md5(prompt) AS prompt_md5
FROM rp"""

_VERIFY_USER = _pr.render_sql(_pr.VERIFY_TEMPLATE, topic="chapter_id || '.' || (topic_pos + 1)", items_json="items_json")
ORACLE["verification_requests"] = with_ctes(ITEMS) + f"""
, g AS (
  SELECT chapter_id, topic_pos, count(*) AS n_items,
         to_json(list({{'qtype': qtype, 'bloom': bloom, 'question': question, 'options': options, 'answer': answer,
                       'explanation': explanation, 'reference_answer': reference_answer,
                       'reference_points': reference_points, 'variations': variations}}
                      ORDER BY list_position(['MCQs', 'fill_in_the_blanks', 'short_answer', 'long_answer'], qtype),
                               bloom_ord, seq))::VARCHAR AS items_json
  FROM items GROUP BY chapter_id, topic_pos),
p AS (SELECT *, {_pr.render_sql(_pr.TYPED_WRAP, system=_pr._sql_lit(_pr.SYSTEM_VERIFY), user=_VERIFY_USER,
                                schema=_pr._sql_lit(_pr.VERIFICATION_SCHEMA))} AS prompt FROM g)
SELECT 'verify:' || chapter_id || ':' || topic_pos AS request_id, chapter_id, topic_pos, n_items,
       length(prompt) AS prompt_len, md5(prompt) AS prompt_md5
FROM p"""

_BUL = "array_to_string(list_transform({x}, lambda b: '- ' || b), chr(10))"
_DETAILS = f"""(CASE WHEN qtype = 'MCQs' THEN 'Options:' || chr(10) || {_BUL.format(x="coalesce(options, [])")}
                   || chr(10) || chr(10) || 'Correct answer: ' || coalesce(answer, '')
              WHEN qtype = 'fill_in_the_blanks' THEN 'Answer: ' || coalesce(answer, '')
              WHEN qtype = 'short_answer' THEN 'Reference answer: ' || coalesce(reference_answer, '')
              WHEN len(coalesce(points, [])) > 0 THEN 'Reference points:' || chr(10) || {_BUL.format(x="points")}
              ELSE 'Legacy reference answer: ' || coalesce(reference_answer, '') END)"""
_TYPE_NAME = ("(CASE qtype WHEN 'MCQs' THEN 'MCQ' WHEN 'fill_in_the_blanks' THEN 'Fill in the Blank' "
              "WHEN 'short_answer' THEN 'Short Answer' ELSE 'Long Answer' END)")
_VARY_USER = _pr.render_sql(_pr.VARY_TEMPLATE, type_name=_TYPE_NAME, bloom="bloom",
                            topic="chapter_id || '.' || (topic_pos + 1)", question="question", details=_DETAILS)
ORACLE["variation_requests"] = with_ctes(ITEMS, FLAGS) + f"""
, p AS (SELECT *, {_pr.render_sql(_pr.FREE_WRAP, system=_pr._sql_lit(_pr.SYSTEM_VARY), user=_VARY_USER)} AS prompt
        FROM flags WHERE len(coalesce(variations, [])) = 0)
SELECT 'vary:' || chapter_id || ':' || seq AS request_id, chapter_id, seq, qtype,
       length(prompt) AS prompt_len, md5(prompt) AS prompt_md5
FROM p"""

# --- typed responses and banks ----------------------------------------------
SECTIONS_FLAT = FLAGS + """,
kinds AS (
  SELECT *, (chapter_id * 4 + topic_pos + list_position(['MCQs', 'fill_in_the_blanks', 'short_answer', 'long_answer'], qtype) - 1) % 9 AS k
  FROM flags),
sec AS (
  SELECT chapter_id, topic_pos, qtype, CASE WHEN any_value(k) IN (1, 2) THEN 0 ELSE count(DISTINCT bloom) END AS n_groups,
         CASE any_value(k) WHEN 1 THEN 'no_json' WHEN 2 THEN 'no_section' WHEN 3 THEN 'wrong_type' WHEN 4 THEN 'unknown_level' ELSE
           CASE WHEN count(DISTINCT bloom) <> 6 THEN 'group_count'
                WHEN bool_or(question IS NULL OR (qtype = 'MCQs' AND (options IS NULL OR answer IS NULL OR explanation IS NULL))
                             OR (qtype = 'fill_in_the_blanks' AND answer IS NULL) OR (qtype = 'short_answer' AND reference_answer IS NULL))
                  THEN 'required_field'
                WHEN bool_or(qtype = 'MCQs' AND len(options) <> 4) THEN 'options'
                WHEN bool_or(qtype = 'long_answer' AND len(points) = 0) THEN 'no_points' ELSE '' END END AS reason
  FROM kinds GROUP BY chapter_id, topic_pos, qtype)"""

ORACLE["strict_types"] = with_ctes(ITEMS, SECTIONS_FLAT) + """
SELECT chapter_id, topic_pos, qtype, CAST(CASE WHEN reason = 'wrong_type' THEN 1 ELSE 0 END AS BIGINT) AS type_errors FROM sec"""

ORACLE["parse_sections"] = with_ctes(ITEMS, SECTIONS_FLAT) + """
SELECT chapter_id, topic_pos, qtype, n_groups, reason FROM sec"""

ORACLE["flatten_bank"] = with_ctes(ITEMS, SECTIONS_FLAT) + """
, f AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY chapter_id, topic_pos, qtype ORDER BY bloom_ord) - 1 AS INTEGER) AS group_pos,
         CAST(row_number() OVER (PARTITION BY chapter_id, topic_pos, qtype, bloom ORDER BY seq) - 1 AS INTEGER) AS q_pos
  FROM kinds WHERE k NOT IN (1, 2, 3, 4))
SELECT chapter_id, topic_pos, qtype, bloom, bloom_ord, group_pos, q_pos, question,
       array_to_string(CASE WHEN qtype = 'MCQs' THEN options END, chr(31)) AS options,
       CASE WHEN qtype IN ('MCQs', 'fill_in_the_blanks') THEN answer END AS answer,
       CASE WHEN qtype = 'MCQs' THEN explanation END AS explanation,
       CASE WHEN qtype = 'short_answer' THEN reference_answer
            WHEN qtype = 'long_answer' THEN CASE WHEN len(points) > 0 THEN '' ELSE coalesce(reference_answer, '') END END AS reference_answer,
       array_to_string(CASE WHEN qtype = 'long_answer' THEN points END, chr(31)) AS reference_points,
       array_to_string(coalesce(variations, []), chr(31)) AS variations,
       group_pos + 1 = bloom_ord AS level_order_ok
FROM f"""

COMBINED = """comb AS (
  SELECT chapter_id, topic_pos,
         coalesce(bool_or(reason = '') FILTER (WHERE qtype = 'MCQs'), false) AS "MCQs",
         coalesce(bool_or(reason = '') FILTER (WHERE qtype = 'fill_in_the_blanks'), false) AS fill_in_the_blanks,
         coalesce(bool_or(reason = '') FILTER (WHERE qtype = 'short_answer'), false) AS short_answer,
         coalesce(bool_or(reason = '') FILTER (WHERE qtype = 'long_answer'), false) AS long_answer
  FROM sec GROUP BY chapter_id, topic_pos)"""

ORACLE["combine_sections"] = with_ctes(ITEMS, SECTIONS_FLAT, COMBINED) + """
SELECT *, "MCQs" AND fill_in_the_blanks AND short_answer AND long_answer AS topic_ok FROM comb"""

ORACLE["chapter_assembly"] = with_ctes(ITEMS, SECTIONS_FLAT, COMBINED) + """
SELECT chapter_id, count(*) FILTER (WHERE ok) AS total_topics, count(*) AS attempted_topics,
       count(*) FILTER (WHERE ok) >= 1 AS chapter_ok
FROM (SELECT *, "MCQs" AND fill_in_the_blanks AND short_answer AND long_answer AS ok FROM comb)
GROUP BY chapter_id"""


def _typed_items(q: str) -> str:
    from ..schemas import TYPE_FIELDS
    fields = ", ".join(f"'{f}': {('coalesce(reference_answer, ' + chr(39) * 2 + ')') if (f == 'reference_answer' and q == 'long_answer') else f}"
                       for f in TYPE_FIELDS[q])
    return f"list({{{fields}}} ORDER BY seq)"


ORACLE["bank_export"] = with_ctes(ITEMS) + f"""
, grp AS (
  SELECT chapter_id, topic_pos, qtype, bloom_ord, bloom,
         CASE qtype {" ".join(f"WHEN '{q}' THEN to_json({_typed_items(q)})" for q in ['MCQs', 'fill_in_the_blanks', 'short_answer', 'long_answer'])} END AS qs
  FROM items GROUP BY chapter_id, topic_pos, qtype, bloom_ord, bloom),
sec AS (
  SELECT chapter_id, topic_pos, qtype,
         '[' || string_agg('{{"bloom_taxonomy":' || to_json(bloom) || ',"questions":' || qs || '}}', ',' ORDER BY bloom_ord) || ']' AS s
  FROM grp GROUP BY chapter_id, topic_pos, qtype),
top AS (
  SELECT chapter_id, topic_pos,
         '{{"topic":' || to_json(chapter_id || '.' || (topic_pos + 1))
         || ',"MCQs":' || coalesce(max(s) FILTER (WHERE qtype = 'MCQs'), 'null')
         || ',"fill_in_the_blanks":' || coalesce(max(s) FILTER (WHERE qtype = 'fill_in_the_blanks'), 'null')
         || ',"short_answer":' || coalesce(max(s) FILTER (WHERE qtype = 'short_answer'), 'null')
         || ',"long_answer":' || coalesce(max(s) FILTER (WHERE qtype = 'long_answer'), 'null') || '}}' AS t
  FROM sec GROUP BY chapter_id, topic_pos),
doc AS (
  SELECT t.chapter_id, d.lang AS class_name, d.source AS subject_name,
         '{{"class_name":' || to_json(d.lang) || ',"subject_name":' || to_json(d.source)
         || ',"chapter_name":' || to_json('chapter ' || d.doc_id) || ',"total_topics":' || count(*)
         || ',"topics":[' || string_agg(t.t, ',' ORDER BY t.topic_pos) || ']}}' AS j
  FROM top t JOIN documents d ON d.doc_id = t.chapter_id GROUP BY t.chapter_id, d.lang, d.source, d.doc_id)
SELECT chapter_id, class_name, subject_name, length(j) AS json_len, md5(j) AS json_md5 FROM doc"""

# --- near duplicates ---------------------------------------------------------
ORACLE["near_duplicates"] = f"""
WITH tok AS (SELECT doc_id, {words_or_text('text')} AS w FROM documents),
sh AS (SELECT doc_id, CASE WHEN len(w) >= 5
                 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
                 ELSE [array_to_string(w, ' ')] END AS s
       FROM tok WHERE len(w) > 0),
sets AS (SELECT doc_id, list_sort(list_distinct(s)) AS st FROM sh),
cls AS (SELECT doc_id, st, len(st) AS n, min(doc_id) OVER (PARTITION BY st) AS rep FROM sets),
ex AS (SELECT doc_id, n, unnest(st) AS sh FROM cls WHERE doc_id = rep),
pairs AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS inter, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM ex a JOIN ex b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2)
SELECT doc_a, doc_b, 'near' AS kind, round(inter / (na + nb - inter), 6) AS jaccard
FROM pairs WHERE inter * 5 >= (na + nb - inter) * 4
UNION ALL
SELECT rep, doc_id, 'copy', 1.0 FROM cls WHERE doc_id <> rep"""

ORACLE["near_duplicate_items"] = with_ctes(ITEMS, NEAR_PAIRS) + """
SELECT chapter_id, topic_pos, seq_a, seq_b, 'near' AS kind, round(inter / (na + nb - inter), 6) AS jaccard
FROM pairs WHERE inter * 5 >= (na + nb - inter) * 4
UNION ALL
SELECT chapter_id, topic_pos, rep, seq, 'copy', 1.0 FROM cls WHERE seq <> rep"""


# --- alignment, verdicts, template variations --------------------------------
STEMS_SQL = """CASE bloom WHEN 'remember' THEN ['Define the idea in: {q}', 'List the facts stated in: {q}', 'Identify the key term in: {q}', 'Name the concept behind: {q}', 'State what is said in: {q}'] WHEN 'understand' THEN ['Explain in your words: {q}', 'Summarize the point of: {q}', 'Paraphrase: {q}', 'Classify the idea in: {q}', 'Interpret the meaning of: {q}'] WHEN 'apply' THEN ['Apply this idea to a new case: {q}', 'Demonstrate with an example: {q}', 'Solve using: {q}', 'Use this to decide: {q}', 'Illustrate with a case: {q}'] WHEN 'analyze' THEN ['Analyze the parts of: {q}', 'Contrast two readings of: {q}', 'Distinguish the causes in: {q}', 'Examine the reasons for: {q}', 'Categorize the elements of: {q}'] WHEN 'evaluate' THEN ['Evaluate the claim: {q}', 'Judge how sound this is: {q}', 'Critique: {q}', 'Defend or reject: {q}', 'Assess the strength of: {q}'] WHEN 'create' THEN ['Design a task based on: {q}', 'Construct an example of: {q}', 'Develop a plan from: {q}', 'Formulate a question about: {q}', 'Propose a change to: {q}'] END"""

ORACLE["bloom_alignment"] = with_ctes(ITEMS) + f"""
, kw AS ({KEYWORDS_SQL}),
st AS (SELECT chapter_id, seq, bloom,
              replace(list_transform([['remember', 'understand', 'apply', 'analyze', 'evaluate', 'create']
                                       [((bloom_ord - 1 + CASE WHEN seq % 5 = 0 THEN 1 ELSE 0 END) % 6) + 1]],
                                     lambda bloom: {STEMS_SQL})[1][seq % 5 + 1], '{{q}}', question) AS text
       FROM items),
hits AS (SELECT i.chapter_id, i.seq, i.bloom, k.keyword, k.kw_bloom
         FROM (SELECT chapter_id, seq, bloom, unnest(list_distinct({words('text')})) AS keyword FROM st) i
         JOIN kw k USING (keyword))
SELECT i.chapter_id, i.seq, i.bloom, coalesce(h.levels, '') AS keyword_levels, coalesce(h.words, '') AS keywords, h.aligned
FROM items i LEFT JOIN (
  SELECT chapter_id, seq, array_to_string(list_sort(list_distinct(list(kw_bloom))), ',') AS levels,
         array_to_string(list_sort(list_distinct(list(keyword))), ',') AS words, bool_or(kw_bloom = bloom) AS aligned
  FROM hits GROUP BY chapter_id, seq) h USING (chapter_id, seq)"""

QINDEX = """qi AS (
  SELECT chapter_id, topic_pos, qtype, seq,
         CAST(row_number() OVER (PARTITION BY chapter_id, topic_pos, qtype ORDER BY bloom_ord, seq) - 1 AS INTEGER)
           AS question_index
  FROM items)"""

ORACLE["question_index"] = with_ctes(ITEMS, QINDEX) + "SELECT * FROM qi"

ORACLE["item_verdicts"] = with_ctes(*ISSUES, QINDEX, recursive=True) + """
SELECT q.chapter_id, q.topic_pos, q.qtype, q.seq, q.question_index, coalesce(a.n, 0) AS n_issues,
       coalesce(a.worst, 0) < 3 AS is_valid
FROM qi q LEFT JOIN (SELECT chapter_id, seq, count(*) AS n,
                            max(CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END) AS worst
                     FROM issues GROUP BY ALL) a USING (chapter_id, seq)"""

ORACLE["template_variations"] = with_ctes(ITEMS) + f"""
SELECT chapter_id, seq, array_to_string(list_transform({STEMS_SQL}, lambda s: replace(s, '{{q}}', question)), chr(31))
       AS variations
FROM items"""

_KEY = ("list_sort(list_transform(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+'), "
        "lambda w, i: {{'size': -length(w), 'i': i, 'w': w}}))[1].w")
KEYED = f"""k AS (
  SELECT chapter_id, CAST(p AS INTEGER) AS seq, l, l[p + 1] AS sentence, {_KEY.format(x="l[p + 1]")} AS answer
  FROM (SELECT doc_id AS chapter_id, l, unnest(range(len(l))) AS p FROM sent))"""
ORACLE["extractive_items"] = with_ctes(SENT, KEYED) + """
, ring AS (SELECT chapter_id, list(answer ORDER BY first_seq) AS ring FROM (
             SELECT chapter_id, answer, min(seq) AS first_seq FROM k WHERE answer IS NOT NULL GROUP BY ALL) GROUP BY chapter_id),
q AS (SELECT k.chapter_id, seq, answer, ring, list_position(ring, answer) - 1 AS r, len(ring) AS n,
             substring(sentence, 1, strpos(sentence, answer) - 1) || '_____' || substring(sentence, strpos(sentence, answer) + length(answer)) AS question
      FROM k JOIN ring USING (chapter_id) WHERE answer IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY chapter_id, question ORDER BY seq) AS rn FROM q)
SELECT chapter_id, seq, question, answer,
       CASE WHEN n >= 4 THEN array_to_string([answer, ring[(r + 1) % n + 1], ring[(r + 2) % n + 1], ring[(r + 3) % n + 1]], chr(31)) END AS options
FROM f WHERE rn = 1"""

ORACLE["extractive_open_items"] = with_ctes(SENT, KEYED) + f"""
, made AS (
  SELECT chapter_id, seq, 'short_answer' AS qtype, 'In a few sentences, what does the text say about ' || answer || '?' AS question,
         array_to_string(list_slice(l, seq + 1, seq + 2 + seq % 3), ' ') AS reference_answer, NULL AS reference_points
  FROM k WHERE answer IS NOT NULL AND len(list_slice(l, seq + 1, seq + 2 + seq % 3)) >= 2
  UNION ALL
  SELECT chapter_id, seq, 'long_answer', 'Set out the points that the text makes from ' || answer || ' on.', '', array_to_string(points, chr(31))
  FROM (SELECT *, list_slice(l, seq + 1, seq + 3 + seq % 4) AS points FROM k WHERE answer IS NOT NULL)
  WHERE len(points) >= 3 AND len(list_distinct(points)) = len(points) AND len(list_filter(points, lambda y: len({words('y')}) >= 20)) = 0),
f AS (SELECT *, row_number() OVER (PARTITION BY chapter_id, qtype, question ORDER BY seq) AS rn FROM made)
SELECT chapter_id, seq, qtype, question, reference_answer, reference_points FROM f WHERE rn = 1"""

_bank = ORACLE["bank_export"]
ORACLE["snapshot_rows"] = _bank[:_bank.index("\nSELECT chapter_id, class_name, subject_name, length(j)")] + """
, ch AS (SELECT class_name, subject_name, 'chapter ' || chapter_id AS chapter_name, j FROM doc),
st AS (SELECT unnest(['generated', 'verified', 'varied']) AS stage)
SELECT chapter_name AS chapter_id, stage, strftime(TIMESTAMP '2024-01-02 03:04:05', '%Y%m%d_%H%M%S') AS run_ts,
       replace(class_name, ' ', '_') || '_' || replace(subject_name, ' ', '_') || '_' || replace(chapter_name, ' ', '_')
         || '_' || stage || '_' || strftime(TIMESTAMP '2024-01-02 03:04:05', '%Y%m%d_%H%M%S') || '.txt' AS file_name,
       'Backup: ' || class_name || ' - ' || subject_name || ' - ' || chapter_name || chr(10) || 'Stage: ' || stage
         || chr(10) || 'Timestamp: ' || strftime(TIMESTAMP '2024-01-02 03:04:05', '%Y%m%d_%H%M%S') || chr(10)
         || repeat('=', 80) || chr(10) || chr(10) AS header,
       length(j) AS payload_len, md5(j) AS payload_md5
FROM ch CROSS JOIN st"""

ORACLE["content_coverage"] = with_ctes(ITEMS) + f"""
, content AS (SELECT DISTINCT chapter_id, topic_pos, unnest(list_distinct(terms)) AS term FROM items),
tested AS (SELECT DISTINCT chapter_id, topic_pos, unnest(list_distinct(list_concat(coalesce(options, []),
              {words('answer')}, flatten(list_transform(coalesce(reference_points, []), lambda p: {words('p', 'v')}))))) AS term
           FROM items),
nc AS (SELECT chapter_id, topic_pos, count(*) AS n FROM content GROUP BY ALL),
nt AS (SELECT chapter_id, topic_pos, count(*) AS n FROM tested SEMI JOIN content USING (chapter_id, topic_pos, term)
       GROUP BY ALL)
SELECT nc.chapter_id, nc.topic_pos, nc.n AS n_content_terms, coalesce(nt.n, 0) AS n_covered,
       round(coalesce(nt.n, 0) / nc.n, 6) AS coverage
FROM nc LEFT JOIN nt USING (chapter_id, topic_pos)"""

_SH = ("list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), "
       "lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) ELSE [array_to_string(w, ' ')] END)")
ORACLE["grounding"] = f"""
WITH p AS (SELECT item_id, unnest({_SH}) AS sh
           FROM (SELECT item_id, {words_or_text('text')} AS w FROM benchmark) WHERE len(w) > 0),
c AS (SELECT DISTINCT unnest({_SH}) AS sh FROM (SELECT {words_or_text('text')} AS w FROM documents) WHERE len(w) > 0),
tot AS (SELECT item_id, count(*) AS n FROM p GROUP BY item_id),
fnd AS (SELECT item_id, count(*) AS n FROM p SEMI JOIN c USING (sh) GROUP BY item_id)
SELECT tot.item_id, tot.n AS n_shingles, coalesce(fnd.n, 0) AS n_found, round(coalesce(fnd.n, 0) / tot.n, 6) AS grounded_share
FROM tot LEFT JOIN fnd USING (item_id)"""

ORACLE["section_coverage"] = "WITH " + SECTIONS + ",\n" + ITEMS + f"""
, w AS (SELECT chapter_id, topic_pos, part_pos, list_distinct({words('section')}) AS terms FROM sections),
idx AS (SELECT chapter_id, topic_pos, part_pos, unnest(terms) AS term FROM w),
used AS (SELECT DISTINCT chapter_id, topic_pos, unnest(list_concat(terms, {words('answer')}, {words('reference_answer')},
            flatten(list_transform(coalesce(options, []), lambda p: {words('p', 'v')})),
            flatten(list_transform(coalesce(reference_points, []), lambda p: {words('p', 'v')})))) AS term FROM items),
hit AS (SELECT chapter_id, topic_pos, part_pos, count(*) AS n FROM idx SEMI JOIN used USING (chapter_id, topic_pos, term) GROUP BY ALL)
SELECT chapter_id, topic_pos, part_pos, CAST(len(terms) AS BIGINT) AS n_terms, coalesce(n, 0) AS n_used,
       round(coalesce(n, 0) / len(terms), 6) AS coverage, round(coalesce(n, 0) / len(terms), 6) < 0.5 AS unused
FROM w LEFT JOIN hit USING (chapter_id, topic_pos, part_pos) WHERE len(terms) > 0"""

ORACLE["section_grounding"] = "WITH " + SECTIONS + ",\n" + ITEMS + f"""
, idx AS (SELECT DISTINCT chapter_id, topic_pos, unnest({_SH}) AS sh
          FROM (SELECT chapter_id, topic_pos, {words('section')} AS w FROM sections) WHERE len(w) > 0),
judged AS (SELECT chapter_id, topic_pos, qtype, seq, {_SH} AS hs
           FROM (SELECT *, terms AS w FROM items SEMI JOIN sections USING (chapter_id, topic_pos)) WHERE len(w) > 0),
hit AS (SELECT chapter_id, topic_pos, seq, count(*) AS n FROM (SELECT chapter_id, topic_pos, seq, unnest(hs) AS sh FROM judged)
        SEMI JOIN idx USING (chapter_id, topic_pos, sh) GROUP BY ALL)
SELECT chapter_id, topic_pos, qtype, seq, CAST(len(hs) AS BIGINT) AS n_runs, coalesce(n, 0) AS n_found,
       round(coalesce(n, 0) / len(hs), 6) AS grounded_share, round(coalesce(n, 0) / len(hs), 6) < 0.5 AS ungrounded
FROM judged LEFT JOIN hit USING (chapter_id, topic_pos, seq)"""

_COMB_BODY = _pr.render_sql(_pr.COMBINED_TEMPLATE, n="'5'", total="'120'", topic="chapter_id || '.' || (topic_pos + 1)",
                            class_name="lang", subject_name="source", chapter_name="'chapter ' || chapter_id",
                            content="content")
_COMB_USER = (f"CASE WHEN coalesce(previous, '') <> '' THEN {_COMB_BODY} || "
              f"{_pr.render_sql(_pr.PREVIOUS_BLOCK, previous='previous')} ELSE {_COMB_BODY} END")
ORACLE["combined_requests"] = with_ctes(ITEMS) + f"""
, t AS (SELECT chapter_id, topic_pos, any_value(lang) AS lang, any_value(source) AS source,
               string_agg(question, ' ' ORDER BY seq) AS content,
               string_agg('- ' || question, chr(10) ORDER BY seq) AS previous
        FROM items GROUP BY chapter_id, topic_pos),
p AS (SELECT *, {_pr.render_sql(_pr.FREE_WRAP, system=_pr._sql_lit(_pr.SYSTEM_GENERATE), user=_COMB_USER)} AS prompt FROM t)
SELECT 'combined:' || chapter_id || ':' || topic_pos AS request_id, chapter_id, topic_pos,
       length(prompt) AS prompt_len, md5(prompt) AS prompt_md5
FROM p"""


# --- ledger and verification report -------------------------------------------
_verify = ORACLE["verification_requests"]
ORACLE["pending_requests"] = _verify[:_verify.index("\nSELECT 'verify:'")] + """
, asked AS (SELECT 'verify:' || chapter_id || ':' || topic_pos AS request_id, (chapter_id + topic_pos) % 5 AS k,
                   sha256('10:reviewer-1' || prompt) AS prompt_digest FROM p)
SELECT request_id, prompt_digest, CASE k WHEN 0 THEN 'new' WHEN 2 THEN 'failed' ELSE 'changed' END AS reason
FROM asked WHERE k IN (0, 2, 3)"""

_KEYS = {"MCQs": "mcq_verifications", "fill_in_the_blanks": "fill_blank_verifications", "short_answer": "short_answer_verifications",
         "long_answer": "long_answer_verifications"}
_ENTRY = """{'question_index': question_index, 'is_valid': about = 1,
   'issues': CASE WHEN about = 0 THEN [{'issue_type': ['duplicate', 'unclear', 'incorrect', 'poor_quality', 'grammatical'][seq % 5 + 1],
                                        'description': 'item ' || seq, 'severity': ['low', 'medium', 'high', 'critical'][seq % 4 + 1]}] ELSE [] END,
   'suggestion': CASE WHEN seq % 2 = 1 THEN 'reword' END}"""
_STRAY = ("{'question_index': 9999, 'is_valid': false, 'issues': [{'issue_type': 'unclear', 'description': 'x', 'severity': 'low'}], "
          "'suggestion': CAST(NULL AS VARCHAR)}")
VERDICTS = QINDEX + f""",
about AS (SELECT *, (seq + chapter_id) % 4 AS about, (chapter_id + 2 * topic_pos) % 8 AS k FROM qi),
given AS (SELECT *, k IN (0, 1, 2, 5, 7) AS failed, {_ENTRY} AS entry FROM about),
tv AS (
  SELECT chapter_id, topic_pos, any_value(k) AS k, any_value(failed) AS failed,
         CASE any_value(k) WHEN 0 THEN 'no_reply' WHEN 1 THEN 'no_json' WHEN 2 THEN 'bad_topic' WHEN 5 THEN 'bad_entry' WHEN 7 THEN 'bad_entry' END AS failure,
         {", ".join(f"coalesce(list(entry ORDER BY question_index) FILTER (WHERE NOT failed AND about < 2 AND qtype = '{q}'), []) AS {v}0" for q, v in _KEYS.items())}
  FROM given GROUP BY chapter_id, topic_pos),
verdicts AS (
  SELECT *, chapter_id || '.' || (topic_pos + 1) AS topic,
         CASE WHEN k = 3 THEN list_append(mcq_verifications0, {_STRAY}) ELSE mcq_verifications0 END AS mcq_verifications,
         {", ".join(f"{v}0 AS {v}" for v in list(_KEYS.values())[1:])},
         CASE WHEN failed THEN 'poor' ELSE ['excellent', 'good', 'fair', 'poor'][(chapter_id + topic_pos) % 4 + 1] END AS overall_quality,
         NOT failed AND (chapter_id * 3 + topic_pos) % 5 = 0 AS has_duplicates
  FROM tv),
totals AS (
  SELECT *, {" + ".join(f"len({v})" for v in _KEYS.values())} AS n_entries,
         {" + ".join(f"coalesce(list_sum(list_transform({v}, lambda e: len(e.issues))), 0)" for v in _KEYS.values())} AS n_issues
  FROM verdicts)"""

ORACLE["verdict_enums"] = with_ctes(ITEMS, VERDICTS) + """
SELECT 'verify:' || chapter_id || ':' || topic_pos AS request_id, CAST(k = 7 AS BIGINT) AS bad_issue_types,
       CAST(k = 5 AS BIGINT) AS bad_severities, k IN (0, 1, 2) AS bad_quality
FROM tv"""

ORACLE["verification_topics"] = with_ctes(ITEMS, VERDICTS) + """
SELECT chapter_id, topic_pos, failure, CAST(n_entries AS BIGINT) AS n_entries, CAST(n_issues AS BIGINT) AS n_issues, overall_quality, has_duplicates
FROM totals"""

ORACLE["verification_entries"] = with_ctes(ITEMS, VERDICTS) + """
SELECT chapter_id, topic_pos, qtype, question_index, seq, about = 1 AS is_valid, CAST(len(entry.issues) AS BIGINT) AS n_issues,
       entry.issues[1].severity AS severity, entry.suggestion AS suggestion
FROM given WHERE NOT failed AND about < 2
UNION ALL
SELECT chapter_id, topic_pos, 'MCQs', 9999, NULL, false, 1, 'low', NULL FROM tv WHERE k = 3"""

ORACLE["verification_report"] = with_ctes(ITEMS, VERDICTS) + f"""
, r AS (
  SELECT chapter_id, count(*) AS n_topics, count(failure) AS n_failed, CAST(sum(n_issues) AS BIGINT) AS total_issues,
         bool_and(overall_quality NOT IN ('poor', 'fair') AND NOT has_duplicates) AS overall_pass,
         list({{'topic': topic, {", ".join(f"'{v}': {v}" for v in _KEYS.values())}, 'overall_quality': overall_quality,
               'has_duplicates': has_duplicates}} ORDER BY topic_pos) AS ts
  FROM totals GROUP BY chapter_id),
j AS (SELECT *, to_json({{'chapter_name': 'chapter ' || chapter_id, 'topic_verifications': ts, 'overall_pass': overall_pass,
                         'total_issues': total_issues}})::VARCHAR AS report FROM r)
SELECT chapter_id, n_topics, n_failed, total_issues, overall_pass, length(report) AS json_len, md5(report) AS json_md5 FROM j"""
