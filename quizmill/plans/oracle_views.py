"""DuckDB SQL for the corpus views (used only by the correctness oracle).

Each constant is a list of CTE bodies that later oracle queries prepend with
``WITH``.  They restate ``quizmill.sources.views`` in DuckDB's dialect:
RE2 has no look-behind, so the sentence split marks breaks first.
"""

from __future__ import annotations

SENT = r"""sent AS (
  SELECT doc_id, source, lang,
         list_filter(list_transform(
             string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
             lambda y: regexp_replace(y, '^\s+|\s+$', '', 'g')), lambda y: y <> '') AS l
  FROM documents)"""

WORDS = r"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"

ITEMS = SENT + r""",
sent_rows AS (
  SELECT doc_id, source, lang, l, unnest(range(len(l))) AS p FROM sent),
sent_rows2 AS (
  SELECT doc_id, source, lang, l, p, l[p + 1] AS q,
         CASE WHEN (doc_id + p // 24) % 7 = 3 AND (p // 4) % 6 IN (2, 3) THEN 5 - (p // 4) % 6 ELSE (p // 4) % 6 END AS level,
         """ + WORDS.format(x="l[p + 1]") + r""" AS w
  FROM sent_rows),
items AS (
  SELECT doc_id AS chapter_id, source, lang,
         CAST(p // 24 AS INTEGER) AS topic_pos,
         CAST(p AS INTEGER) AS seq,
         ['MCQs', 'fill_in_the_blanks', 'short_answer', 'long_answer'][p % 4 + 1] AS qtype,
         ['remember', 'understand', 'apply', 'analyze', 'evaluate', 'create'][level + 1] AS bloom,
         CAST(level + 1 AS INTEGER) AS bloom_ord,
         CASE WHEN p % 4 = 1 AND p % 3 <> 0 THEN q || ' _____' ELSE q END AS question,
         CASE WHEN p % 4 = 0 THEN list_slice(w, 1, 4) END AS options,
         CASE WHEN p % 4 = 0 THEN (CASE WHEN p % 7 = 0 THEN 'zz' ELSE w[1] END)
              WHEN p % 4 = 1 THEN array_to_string(list_slice(w, 1, p % 5), ' ') END AS answer,
         CASE WHEN p % 4 = 0 THEN array_to_string(list_slice(l, p + 2, p + 1 + p % 3), ' ') END AS explanation,
         CASE WHEN p % 4 = 2 THEN array_to_string(list_slice(l, p + 1, p + p % 6), ' ')
              WHEN p % 4 = 3 THEN (CASE WHEN p % 9 <= 1 THEN array_to_string(list_slice(l, p + 1, p + 3), ' ')
                                        ELSE '' END) END AS reference_answer,
         CASE WHEN p % 4 = 3 THEN list_slice(l, p + 1, p + p % 9) END AS reference_points,
         list_slice(w, 1, p % 7) AS variations,
         w AS terms
  FROM sent_rows2)"""


def with_ctes(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"
