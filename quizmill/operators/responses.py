"""Response processing: clean, parse, normalise, pad, merge.

Responses are data: a failed call is a row with ``parsed IS NULL`` and an
error, never an exception.  Everything here is a per-row projection except
the merge (one equi-join on the item key) and the tallies (aggregates).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import variations as vx


def clean_and_parse(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``cleaned`` (fences and control characters removed) and
    ``parsed`` (VARIANT, null when the text is not valid JSON)."""
    return (responses.withColumn("cleaned", tx.clean_response(raw))
            .withColumn("parsed", F.try_parse_json("cleaned")))


def variation_results(responses: DataFrame) -> DataFrame:
    """Per response: normalised variations (``norm``) and the final padded
    list of at least five (``new_variations``); failed calls give an empty list."""
    df = clean_and_parse(responses)
    is_mcq = F.col("qtype") == "MCQs"
    return (df.withColumn("norm", vx.normalized_variations(F.col("parsed"), is_mcq))
            .withColumn("new_variations", vx.padded(F.col("norm"), F.col("question"))))


def variation_rules(df: DataFrame, col: str = "new_variations") -> DataFrame:
    """Five unique variations, none equal to the original, type shape kept."""
    v = F.col(col)
    opts_ok = F.forall(v, lambda s: F.size(F.split(F.regexp_extract(s, r"Options: ([^|]*)", 1), "; ")) == 4)
    shape = (F.when(F.col("qtype") == "MCQs", opts_ok)
             .when(F.col("qtype") == "fill_in_the_blanks", F.forall(v, lambda s: s.contains("_____")))
             .otherwise(F.lit(True)))
    n_unique = F.size(F.array_distinct(v))
    return df.select(
        "chapter_id", "seq", "qtype",
        F.size(v).cast("bigint").alias("n_variations"),
        n_unique.cast("bigint").alias("n_unique"),
        F.array_contains(v, F.col("question")).alias("repeats_original"),
        ((F.size(v) == 5) & (n_unique == 5) & ~F.array_contains(v, F.col("question"))).alias("five_unique"),
        shape.alias("shape_kept"),
    )


def needs_variations(items: DataFrame) -> DataFrame:
    """Only items whose variations are missing get a request."""
    return items.where(F.size(F.coalesce("variations", F.array().cast("array<string>"))) == 0)


def merge_variations(items: DataFrame, results: DataFrame) -> DataFrame:
    """Keep existing variations; fill missing ones from new results (K8)."""
    new = results.select("chapter_id", "seq", "new_variations")
    j = items.join(new, ["chapter_id", "seq"], "left")
    empty = F.array().cast("array<string>")
    existing = F.col("variations")
    return j.withColumn(
        "variations",
        F.when(F.size(F.coalesce(existing, empty)) > 0, existing)
        .otherwise(F.coalesce(F.col("new_variations"), empty))).drop("new_variations")


def variation_tally(items: DataFrame, results: DataFrame) -> DataFrame:
    """Per chapter: items requested, calls failed, variations obtained."""
    req = needs_variations(items).select("chapter_id", "seq")
    r = req.join(results.select("chapter_id", "seq", "parsed", "new_variations"), ["chapter_id", "seq"], "left")
    return r.groupBy("chapter_id").agg(
        F.count("*").cast("bigint").alias("items_requested"),
        F.count_if(F.col("parsed").isNull()).cast("bigint").alias("calls_failed"),
        F.sum(F.size(F.coalesce("new_variations", F.array().cast("array<string>")))).cast("bigint")
        .alias("variations_obtained"))


# ---------------------------------------------------------------------------
# Typed section responses: nest, parse, flatten, combine, assemble
# ---------------------------------------------------------------------------

from ..schemas import BLOOMS, ITEM_FIELDS, QTYPES, REQUIRED_FIELDS, TYPE_FIELDS  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

_ALL_ITEM = T.StructType(ITEM_FIELDS)
_GROUP = T.StructType([T.StructField("bloom_taxonomy", T.StringType()),
                       T.StructField("questions", T.ArrayType(_ALL_ITEM))])
# One parse schema for every type; fields a type does not declare are
# dropped afterwards, exactly as a typed record would ignore them.
SECTION_ANY = T.StructType([T.StructField(q, T.ArrayType(_GROUP)) for q in QTYPES])


def _item_struct():
    return F.struct(*[F.col(f.name) for f in ITEM_FIELDS])


def nest_sections(items: DataFrame) -> DataFrame:
    """Items -> one typed JSON response per (chapter, topic, type):
    ``{"<type>": [{"bloom_taxonomy": level, "questions": [...]}, ...]}`` with
    levels in canonical order and items in position order (D2)."""
    sec = (items.groupBy("chapter_id", "topic_pos", "qtype")
           .agg(F.sort_array(F.collect_list(F.struct("bloom_ord", "bloom", "seq", _item_struct().alias("q")))).alias("xs")))
    sec = sec.withColumn("levels", F.array_distinct(F.transform("xs", lambda x: F.struct(x["bloom_ord"].alias("bloom_ord"), x["bloom"].alias("bloom")))))
    body = F.transform("levels", lambda g: F.struct(g["bloom"].alias("bloom_taxonomy"), F.transform(
        F.filter("xs", lambda x: x["bloom_ord"].eqNullSafe(g["bloom_ord"]) & x["bloom"].eqNullSafe(g["bloom"])), lambda x: x["q"]).alias("questions")))
    raw = F.to_json(F.create_map(F.col("qtype"), body))
    return sec.select("chapter_id", "topic_pos", "qtype", raw.alias("raw"))


def parse_sections(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Clean, parse and validate typed responses: adds ``groups`` and ``reason``.

    ``groups`` is null when the text is not valid JSON or lacks the type's key.
    ``reason`` is null for a valid section, else the first rule it breaks:
    ``no_json``, ``no_section``, ``wrong_type`` (I10), ``unknown_level`` (I3),
    ``group_count`` (I4), ``empty_group`` (I5), ``required_field`` (I1),
    ``options`` (I2) or ``no_points`` (I9).  Points of long answers are
    normalised here (H6); a section with a reason counts as a failed call.  The
    text is cleaned once and read once as VARIANT and once as typed record, each
    in a projection of its own.
    """
    from .quality import normalized
    from .validate import type_errors
    read = responses.withColumn("_text", tx.clean_response(raw))
    read = read.withColumn("_variant", F.try_parse_json("_text"))
    read = read.withColumn("_record", F.when(F.col("_variant").isNotNull(), F.from_json("_text", SECTION_ANY)))
    record = F.col("_record")
    groups = F.when(F.col("qtype") == QTYPES[0], record[QTYPES[0]])
    for q in QTYPES[1:]:
        groups = groups.when(F.col("qtype") == q, record[q])
    df = (read.withColumn("_json", F.col("_variant").isNotNull()).withColumn("type_errors", type_errors(F.col("_variant"), F.col("qtype")))
          .withColumn("groups", F.when(F.col("_json"), groups)).drop("_text", "_variant", "_record"))
    long_ = F.col("qtype") == "long_answer"

    def question(it):
        points, legacy = normalized(it["reference_points"], it["reference_answer"])
        changed = {"reference_points": points, "reference_answer": legacy}
        return F.struct(*[changed.get(f.name, it[f.name]).alias(f.name) for f in ITEM_FIELDS])

    df = df.withColumn("groups", F.when(long_, F.transform("groups", lambda g: F.struct(
        g["bloom_taxonomy"].alias("bloom_taxonomy"), F.transform(g["questions"], question).alias("questions")))).otherwise(F.col("groups")))

    def any_item(rule):
        return F.exists("groups", lambda g: F.exists(g["questions"], rule))

    def any_null(fields):
        return any_item(lambda it: reduce(or_, [it[f].isNull() for f in fields]))

    missing = F.lit(False)
    for q, fields in REQUIRED_FIELDS.items():
        missing = F.when(F.col("qtype") == q, any_null(fields)).otherwise(missing)

    reason = (F.when(~F.col("_json"), "no_json").when(F.col("groups").isNull(), "no_section").when(F.col("type_errors") > 0, "wrong_type")
              .when(F.exists("groups", lambda g: ~F.coalesce(g["bloom_taxonomy"].isin(*BLOOMS), F.lit(False))), "unknown_level")
              .when(F.size("groups") != len(BLOOMS), "group_count")
              .when(F.exists("groups", lambda g: F.coalesce(F.size(g["questions"]), F.lit(0)) < 1), "empty_group")
              .when(missing, "required_field")
              .when((F.col("qtype") == "MCQs") & any_item(lambda it: F.size(it["options"]) != 4), "options")
              .when(long_ & any_item(lambda it: F.size(it["reference_points"]) == 0), "no_points"))
    return df.withColumn("reason", reason).drop("_json", "type_errors")


def flatten_sections(parsed: DataFrame) -> DataFrame:
    """Parsed sections -> flat items (D1, G1): group position, item
    position, and only the fields the item's type declares (B10)."""
    keys = ["chapter_id", "topic_pos", *(["part_pos"] if "part_pos" in parsed.columns else []), "qtype"]
    g = parsed.select(*keys, F.posexplode("groups").alias("group_pos", "g"))
    q = g.select(*keys, "group_pos", F.col("g.bloom_taxonomy").alias("bloom"),
                 F.posexplode("g.questions").alias("q_pos", "it"))
    cols = []
    for f in ITEM_FIELDS:
        declared = [t for t in QTYPES if f.name in TYPE_FIELDS[t]]
        c = F.when(F.col("qtype").isin(*declared), F.col("it")[f.name])
        if f.name == "variations":
            c = F.coalesce(c, F.array().cast("array<string>"))
        if f.name == "reference_answer":
            c = F.when(F.col("qtype") == "long_answer", F.coalesce(c, F.lit(""))).otherwise(c)
        cols.append(c.alias(f.name))
    bloom_ord = F.array_position(F.array(*[F.lit(b) for b in BLOOMS]), F.col("bloom")).cast("int")
    return q.select(*keys, "bloom", bloom_ord.alias("bloom_ord"),
                    "group_pos", "q_pos", *cols)


def combine_sections(parsed: DataFrame) -> DataFrame:
    """Four sections -> one topic row; any failed response (a part's, where a section came in parts) fails the topic (D3)."""
    ok = parsed.withColumn("ok", F.col("reason").isNull())
    p = ok.groupBy("chapter_id", "topic_pos").pivot("qtype", QTYPES).agg(F.bool_and("ok"))
    all_ok = F.lit(True)
    for q in QTYPES:
        all_ok = all_ok & F.coalesce(F.col(q), F.lit(False))
    return p.select("chapter_id", "topic_pos", *[F.coalesce(F.col(q), F.lit(False)).alias(q) for q in QTYPES],
                    all_ok.alias("topic_ok"))


def chapter_assembly(topics: DataFrame) -> DataFrame:
    """total_topics = successful topics; a chapter with none fails."""
    return topics.groupBy("chapter_id").agg(
        F.count_if("topic_ok").cast("bigint").alias("total_topics"),
        F.count("*").cast("bigint").alias("attempted_topics"),
        (F.count_if("topic_ok") >= 1).alias("chapter_ok"))


def bank_documents(items: DataFrame, chapters: DataFrame) -> DataFrame:
    """Nested chapter banks as JSON: class, subject, chapter, total_topics,
    topics[{topic, MCQs, fill_in_the_blanks, short_answer, long_answer}],
    each section a list of {bloom_taxonomy, questions} whose items carry
    exactly their type's declared fields.

    Structs are nested directly, so no text is altered on the way.  Each type
    gets its own typed column (null on other types' rows); levels, topics and
    chapters are collected in turn.  The largest group is one chapter's bank,
    i.e. the document written.
    """
    topic_keys = ["chapter_id", "topic_pos", "topic"]
    typed = []
    for q in QTYPES:
        # a long answer always shows the legacy text, if only as an empty one
        fields = [F.coalesce(f, F.lit("")).alias(f) if (q, f) == ("long_answer", "reference_answer") else F.col(f) for f in TYPE_FIELDS[q]]
        typed.append(F.when(F.col("qtype") == q, F.struct("seq", F.struct(*fields).alias("it"))).alias(q))
    levels = (items.select(*topic_keys, "qtype", "bloom_ord", "bloom", *typed).groupBy(*topic_keys, "qtype", "bloom_ord", "bloom")
              .agg(*[F.transform(F.sort_array(F.collect_list(q)), lambda x: x["it"]).alias(q) for q in QTYPES]))
    level = [F.when(F.col("qtype") == q, F.struct("bloom_ord", F.struct(F.col("bloom").alias("bloom_taxonomy"), F.col(q).alias("questions")).alias("g"))).alias(q)
             for q in QTYPES]
    sections = [F.transform(F.sort_array(F.collect_list(q)), lambda x: x["g"]).alias(q) for q in QTYPES]
    t = levels.select(*topic_keys, *level).groupBy(*topic_keys).agg(*sections)
    t = t.select(*topic_keys, *[F.when(F.size(q) > 0, F.col(q)).alias(q) for q in QTYPES])
    ch = t.groupBy("chapter_id").agg(F.sort_array(F.collect_list(F.struct("topic_pos", F.struct("topic", *QTYPES).alias("t")))).alias("ts"))
    j = ch.join(chapters, "chapter_id")
    doc = F.struct("class_name", "subject_name", "chapter_name", F.size("ts").alias("total_topics"),
                   F.transform("ts", lambda x: x["t"]).alias("topics"))
    return j.select("chapter_id", "class_name", "subject_name", "chapter_name",
                    F.to_json(doc, {"ignoreNullFields": "false"}).alias("bank_json"))
