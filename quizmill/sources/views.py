"""Corpus views derived from the driver tables.

Mapping used throughout: document = chapter, ``source`` = subject,
``lang`` = class, 24-sentence block = topic, sentence = item.  The item view
plays the part of a parsed question bank; the column rules plant both good
and bad items so every validation rule has hits and misses.

Every view is a pure projection / explode of its input, so it scales with
the table and never needs a shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schemas import BLOOMS, QTYPES

TOPIC_SIZE = 24


def _sql_list(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def sentence_lists(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, l): the sentences of each document."""
    return docs.select("doc_id", "source", "lang", tx.sentences("text").alias("l"))


def sentence_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, p, q): one row per sentence, 0-based position."""
    return sentence_lists(docs).select("doc_id", F.posexplode("l").alias("p", "q"))


def items(docs: DataFrame) -> DataFrame:
    """Flat item table, one row per sentence (see module doc).

    Slices that need neighbouring sentences are taken inside ``transform``
    before the explode, so a row never carries its whole document, and only
    for the types that show them.
    """
    s = sentence_lists(docs)
    # every seventh topic has its third and fourth level exchanged
    level = f"CAST(CASE WHEN (doc_id + p div {TOPIC_SIZE}) % 7 = 3 AND (p div 4) % 6 IN (2, 3) THEN 5 - (p div 4) % 6 ELSE (p div 4) % 6 END AS INT)"
    per_sentence = F.transform("l", lambda x, i: F.struct(
        i.alias("p"),
        x.alias("q"),
        F.when(i % 4 == 0, F.array_join(F.slice("l", i + 2, i % 3), " ")).alias("expl"),
        F.when(i % 4 == 2, F.array_join(F.slice("l", i + 1, i % 6), " ")).alias("ra"),
        F.when(i % 4 == 3, F.slice("l", i + 1, i % 9)).alias("rp"),
        F.when((i % 4 == 3) & (i % 9 <= 1), F.array_join(F.slice("l", i + 1, 3), " ")).alias("legacy"),
    ))
    e = tx.exploded(s, per_sentence, "x", "doc_id", "source", "lang").select("doc_id", "source", "lang", "x.*").withColumn("w", tx.words("q"))
    return e.selectExpr(
        "doc_id AS chapter_id",
        "source",
        "lang",
        f"CAST(p div {TOPIC_SIZE} AS INT) AS topic_pos",
        f"concat(doc_id, '.', p div {TOPIC_SIZE} + 1) AS topic",
        "p AS seq",
        f"element_at({_sql_list(QTYPES)}, p % 4 + 1) AS qtype",
        f"element_at({_sql_list(BLOOMS)}, {level} + 1) AS bloom",
        f"{level} + 1 AS bloom_ord",
        "CASE WHEN p % 4 = 1 AND p % 3 <> 0 THEN concat(q, ' _____') ELSE q END AS question",
        "CASE WHEN p % 4 = 0 THEN slice(w, 1, 4) END AS options",
        "CASE WHEN p % 4 = 0 THEN (CASE WHEN p % 7 = 0 THEN 'zz' ELSE get(w, 0) END)"
        " WHEN p % 4 = 1 THEN array_join(slice(w, 1, p % 5), ' ') END AS answer",
        "CASE WHEN p % 4 = 0 THEN expl END AS explanation",
        "CASE WHEN p % 4 = 2 THEN ra WHEN p % 4 = 3 THEN (CASE WHEN p % 9 <= 1 THEN legacy ELSE '' END)"
        " END AS reference_answer",
        "CASE WHEN p % 4 = 3 THEN rp END AS reference_points",
        "slice(w, 1, p % 7) AS variations",
        "w AS terms",
    )


def raw_responses(items: DataFrame) -> DataFrame:
    """Model-response view for the variation stage, one per item (its words, or its text where it has none).

    ``(seq + chapter_id) % 8`` picks the response shape: padded strings;
    a ``variation_*`` bundle; text keys; question with points; options with
    answer; reference answers; an unusable object; a bare number.  Some
    responses are fenced, some carry a control character, some are cut
    short (invalid JSON).  Object keys are written in sorted order.
    """
    a = "get(terms, 0)"
    b = "array_join(slice(terms, 1, 2), ' ')"
    c = "array_join(slice(terms, 1, 3), ' ')"
    body = f"""CASE (seq + chapter_id) % 8
      WHEN 0 THEN concat('["  ', {b}, '  ", "', {a}, '", " "]')
      WHEN 1 THEN concat('{{"variations": [{{"variation_1": "', {c}, '", "variation_10": "', {a},
                         '", "variation_2": "  "}}, "', {b}, '"]}}')
      WHEN 2 THEN concat('[{{"question": " ", "text": "', {c}, '"}}, {{"prompt": "', {a}, '"}}]')
      WHEN 3 THEN concat('{{"question": "', {b}, '", "reference_points": ["', {a}, '", " ", "', {c}, '"]}}')
      WHEN 4 THEN concat('[{{"answer": "', {c}, '", "options": ["', {a}, '", " ", "', {b}, '"]}}, {{"options": []}}]')
      WHEN 5 THEN concat('{{"variations": [{{"reference_answer": "', {c}, '"}}, {{"question": "', {a},
                         '", "reference_answer": "', {b}, '"}}]}}')
      WHEN 6 THEN '{{"other": 1}}'
      ELSE '7' END"""
    df = (items.withColumn("terms", F.when(F.size("terms") > 0, F.col("terms")).otherwise(
        F.array(F.regexp_replace(tx.trim_ascii("question"), r'["\\]', ""))))
          .selectExpr("chapter_id", "topic_pos", "seq", "qtype", "bloom", "question", "variations",
                      f"{body} AS body"))
    return df.selectExpr(
        "chapter_id", "topic_pos", "seq", "qtype", "bloom", "question", "variations",
        "CASE WHEN seq % 11 = 10 THEN substring(body, 1, length(body) - 1) ELSE body END AS body1"
    ).selectExpr(
        "chapter_id", "topic_pos", "seq", "qtype", "bloom", "question", "variations",
        "concat(CASE WHEN seq % 5 = 0 THEN char(7) ELSE '' END,"
        " CASE WHEN seq % 3 = 0 THEN concat('```json', char(10), body1, char(10), '```') ELSE body1 END,"
        " CASE WHEN seq % 5 = 1 THEN concat(char(13), char(10), '  ') ELSE '' END) AS raw")


def typed_responses(sections: DataFrame) -> DataFrame:
    """Typed section responses as a model might send them, by
    ``(4 * chapter + topic + type) % 9``: fenced (0), cut short (1), under
    another key (2), a number for a question (3), an unknown level (4), with a
    control character (5); the others as they are."""
    kind = F.array_position(F.array(*[F.lit(q) for q in QTYPES]), F.col("qtype")) - 1
    return sections.withColumn("k", F.pmod(F.col("chapter_id") * 4 + F.col("topic_pos") + kind, F.lit(9))).selectExpr(
        "chapter_id", "topic_pos", "qtype", r"""CASE k
          WHEN 0 THEN concat('```json', char(10), raw, char(10), '```')
          WHEN 1 THEN substring(raw, 1, length(raw) - 1)
          WHEN 2 THEN regexp_replace(raw, concat('^\\{"', qtype, '"'), '{"other"')
          WHEN 3 THEN regexp_replace(raw, '^(.*?)"question":"', '$1"question":1,"x":"')
          WHEN 4 THEN regexp_replace(raw, '^(.*?)"bloom_taxonomy":"', '$1"bloom_taxonomy":"un')
          WHEN 5 THEN concat(char(7), raw)
          ELSE raw END AS raw""")


def verification_replies(items: DataFrame) -> DataFrame:
    """One verification reply per topic (request_id, raw) whose entries name real items by their index in the section.

    Of items, by ``(seq + chapter) % 4``: 0 has an entry with an issue, 1 an
    entry without, the others none.  Replies by ``(chapter + 2 * topic) % 8``:
    none at all (0), cut short (1), an undeclared quality (2), an entry that names
    no item (3), fenced (4), an undeclared severity (5) or issue type (7); the
    others as they are.
    """
    from ..operators.quality import question_index
    from ..schemas import ISSUE_TYPES, QUALITY_RATINGS, SEVERITIES, VERIFICATION_KEYS
    indexed = question_index(items).withColumn("about", F.pmod(F.col("seq") + F.col("chapter_id"), F.lit(4)))
    entry = f"""named_struct('question_index', question_index, 'is_valid', about = 1, 'issues', CASE WHEN about = 0 THEN array(named_struct(
        'issue_type', element_at({_sql_list(ISSUE_TYPES)}, seq % 5 + 1), 'description', concat('item ', seq),
        'severity', element_at({_sql_list(SEVERITIES)}, seq % 4 + 1))) ELSE array() END, 'suggestion', CASE WHEN seq % 2 = 1 THEN 'reword' END)"""
    wrong = """named_struct('question_index', CASE k WHEN 3 THEN 9999 ELSE 0 END, 'is_valid', false, 'issues', array(named_struct(
        'issue_type', CASE k WHEN 7 THEN 'typo' ELSE 'unclear' END, 'description', 'x', 'severity', CASE k WHEN 5 THEN 'dire' ELSE 'low' END)), 'suggestion', CAST(NULL AS STRING))"""
    lists = [F.array_sort(F.collect_list(F.expr(f"CASE WHEN qtype = '{q}' AND about < 2 THEN {entry} END"))).alias(k) for q, k in VERIFICATION_KEYS.items()]
    topics = (indexed.groupBy("chapter_id", "topic_pos").agg(*lists)
              .withColumn("k", F.pmod(F.col("chapter_id") + 2 * F.col("topic_pos"), F.lit(8))))
    first, *others = VERIFICATION_KEYS.values()
    body = f"""to_json(named_struct('topic', concat(chapter_id, '.', topic_pos + 1),
        '{first}', CASE WHEN k IN (3, 5, 7) THEN concat({first}, array({wrong})) ELSE {first} END, {", ".join(f"'{k}', {k}" for k in others)},
        'overall_quality', CASE k WHEN 2 THEN 'fine' ELSE element_at({_sql_list(QUALITY_RATINGS)}, CAST((chapter_id + topic_pos) % 4 AS INT) + 1) END,
        'has_duplicates', (chapter_id * 3 + topic_pos) % 5 = 0), map('ignoreNullFields', 'false'))"""
    return topics.selectExpr("chapter_id", "topic_pos", "k", f"{body} AS body").selectExpr(
        "concat('verify:', chapter_id, ':', topic_pos) AS request_id", """CASE k WHEN 0 THEN NULL WHEN 1 THEN substring(body, 1, length(body) - 1)
            WHEN 4 THEN concat('```json', char(10), body, char(10), '```') ELSE body END AS raw""")


def ledger_rows(requests: DataFrame, model: str) -> DataFrame:
    """A ledger as earlier runs of ``model`` would have left it, by ``(chapter + topic) % 5`` of the request: no row (0), a good
    reply (1), failures only (2), a good reply to another model (3), a failure and then a good reply (4)."""
    from ..operators.ledger import prompt_digest
    k = F.pmod(F.col("chapter_id") + F.col("topic_pos"), F.lit(5))
    digest = F.when(k == 3, prompt_digest(F.col("prompt"), model + "-old")).otherwise(prompt_digest(F.col("prompt"), model))
    failed = F.struct(F.lit(3).alias("attempt_count"), F.lit(None).cast("string").alias("raw"), F.lit("TimeoutError: ").alias("error"))
    good = F.struct(F.lit(1).alias("attempt_count"), F.lit("{}").alias("raw"), F.lit(None).cast("string").alias("error"))
    rows = F.when(k == 0, F.array().cast("array<struct<attempt_count:int,raw:string,error:string>>")).when(k == 2, F.array(failed, failed)) \
        .when(k == 4, F.array(failed, good)).otherwise(F.array(good))
    return requests.select("request_id", digest.alias("prompt_digest"), F.explode(rows).alias("r")).select("request_id", "prompt_digest", "r.*")


# ---------------------------------------------------------------------------
# Chapter folders, syllabus entries and headed chapter content.
# ---------------------------------------------------------------------------

def chapter_paths(docs: DataFrame) -> DataFrame:
    """(chapter_id, path): folder layouts by ``doc_id % 6`` -- CBSE with a
    medium level, Sample, both anchors, no anchor, too short, and a folder
    name whose number is embedded."""
    return docs.selectExpr("doc_id AS chapter_id", """CASE doc_id % 6
        WHEN 0 THEN concat('/corpus/CBSE/', lang, '/medium ', lang, '/', source, '/chapter ', doc_id)
        WHEN 1 THEN concat('/corpus/Sample/', lang, '/', source, '/chapter ', doc_id)
        WHEN 2 THEN concat('/corpus/Sample/CBSE/', lang, '/x/', source, '/chapter ', doc_id)
        WHEN 3 THEN concat('/corpus/other/', lang, '/', source, '/chapter ', doc_id)
        WHEN 4 THEN concat('/corpus/', source, '/Sample/', lang)
        ELSE concat('/corpus/Sample/', lang, '/', source, '/unit-', doc_id, '-b', doc_id % 7) END AS path""")


def chapters(docs: DataFrame) -> DataFrame:
    """Standard-layout chapters: subject = source, folder ``chapter <doc_id>``."""
    return docs.selectExpr("doc_id AS chapter_id", "source AS subject_key", "lang AS class_name",
                           "concat('chapter ', doc_id) AS dir_name", "concat('chapter ', doc_id) AS chapter_name",
                           "CAST(doc_id AS STRING) AS chapter_number", "text")


def topic_titles_expr() -> str:
    """SQL for the topic names of a document: one per line, numbered
    ``<doc>.<line>``; every fourth names a section absent from the text."""
    return """transform(split(text, '\\n'), (x, i) -> CASE WHEN i % 4 = 3
                THEN concat(doc_id, '.', i + 1, ' Zzq recap')
                ELSE concat(doc_id, '.', i + 1, ' ',
                            coalesce(nullif(array_join(slice(filter(split(lower(x), '[^\\\\p{L}\\\\p{N}]+'),
                                                                    t -> t <> ''), 1, 3), ' '), ''), 'part')) END)"""


def syllabus_entries(docs: DataFrame) -> DataFrame:
    """One JSON syllabus entry per document, listed in descending doc order.

    Labels by ``doc_id % 3``: ``Chapter n`` / ``n`` / ``unit: chapter n!``;
    keys are capitalised for ``doc_id % 4 = 0``; every seventh entry carries
    an empty ``Chapter`` next to ``chapter``; every tenth has no topics;
    every thirteenth is left out of the syllabus.
    """
    t = topic_titles_expr()
    return docs.where("doc_id % 13 <> 12").selectExpr(
        "source AS subject_key", "-doc_id AS chapter_pos",
        f"""CASE doc_id % 3 WHEN 0 THEN concat('Chapter ', doc_id) WHEN 1 THEN CAST(doc_id AS STRING)
             ELSE concat('unit: chapter ', doc_id, '!') END AS label""",
        f"CASE WHEN doc_id % 10 = 9 THEN array() ELSE {t} END AS topics",
        "doc_id % 4 = 0 AS upper_keys", "doc_id % 7 = 0 AS blank_upper", "doc_id",
    ).selectExpr(
        "subject_key", "chapter_pos",
        """CASE WHEN upper_keys THEN to_json(named_struct('Chapter', label, 'Title', concat('Unit ', doc_id),
                                                          'Topics', topics))
                WHEN blank_upper THEN to_json(named_struct('Chapter', '', 'chapter', label, 'title', CAST(NULL AS STRING),
                                                           'topics', topics))
                ELSE to_json(named_struct('chapter', label, 'title', concat('Unit ', doc_id), 'topics', topics))
           END AS entry_json""")


def headed_chapters(docs: DataFrame) -> DataFrame:
    """(chapter_id, content): each line preceded by a heading for its topic.

    Line ``i``: ``# n.i title`` (i%4=0), plain ``n.i title`` (1), ``# title``
    without number (2), ``# n.i Section`` that no topic names (3).
    """
    t = topic_titles_expr()
    return docs.selectExpr("doc_id AS chapter_id", "split(text, '\\n') AS lines", f"{t} AS topics").selectExpr(
        "chapter_id", """array_join(transform(lines, (x, i) -> concat(CASE i % 4
              WHEN 0 THEN concat('# ', topics[i])
              WHEN 1 THEN topics[i]
              WHEN 2 THEN concat('# ', regexp_replace(topics[i], '^\\\\d+\\\\.\\\\d+\\\\s+', ''))
              ELSE concat('# ', chapter_id, '.', i + 1, ' Section') END, '\\n', x)), '\\n') AS content""")
