"""Structural validation: every declared constraint as a column check.

A violation is one element of an array of rule names; counting them is an
explode + hash aggregate (partial aggregation before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schemas import BLOOMS, REQUIRED_FIELDS
from .quality import normalized_points


def _required_missing(blank: bool) -> Column:
    cond = F.lit(False)
    for qt, fields in REQUIRED_FIELDS.items():
        one = F.lit(False)
        for f in fields:
            c = F.col(f)
            if blank:
                test = (F.size(F.coalesce(c, F.array().cast("array<string>"))) == 0) if f == "options" \
                    else F.coalesce(F.length(tx.trim_ascii(c)) == 0, F.lit(True))
            else:
                test = c.isNull()
            one = one | test
        cond = cond | ((F.col("qtype") == qt) & one)
    return cond


def item_violations(items: DataFrame) -> DataFrame:
    """Per item: array of violated structural rules."""
    rules = [
        ("required_field_missing", _required_missing(blank=False)),
        ("required_field_blank", _required_missing(blank=True)),
        ("mcq_not_four_options", (F.col("qtype") == "MCQs")
         & (F.coalesce(F.size("options"), F.lit(0)) != 4)),
        ("unknown_level", ~F.coalesce(F.col("bloom").isin(*BLOOMS), F.lit(False))),
        ("long_answer_without_points", (F.col("qtype") == "long_answer") & (F.size(normalized_points()) == 0)),
    ]
    arr = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    return items.select("chapter_id", "topic_pos", "qtype", "seq", arr.alias("violations"))


def section_violations(items: DataFrame) -> DataFrame:
    """Per section (chapter, topic, type): fewer or more than six levels (I4)."""
    return (items.groupBy("chapter_id", "topic_pos", "qtype")
            .agg(F.count_distinct("bloom").alias("n_levels"))
            .where("n_levels <> 6")
            .select("chapter_id", "topic_pos", "qtype", F.array(F.lit("section_not_six_levels")).alias("violations")))


def structural_counts(items: DataFrame) -> DataFrame:
    v = item_violations(items).unionByName(section_violations(items).withColumn("seq", F.lit(None).cast("int")))
    return (v.select("qtype", F.explode("violations").alias("rule"))
            .groupBy("qtype", "rule").agg(F.count("*").cast("bigint").alias("n_violations")))


def verdict_enum_violations(verdicts: DataFrame, raw: str = "raw") -> DataFrame:
    """Verification responses whose values leave the declared enums (I7, I8):
    issue type (5), severity (4), overall quality (4)."""
    from ..functions.text import clean_response
    from ..schemas import ISSUE_TYPES, QUALITY_RATINGS, SEVERITIES, TOPIC_VERIFICATION, VERIFICATION_KEYS
    text = clean_response(F.col(raw))
    verdicts = verdicts.select("request_id", F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, TOPIC_VERIFICATION)).alias("v"))
    v = F.col("v")
    entries = F.concat(*[F.coalesce(v[k], F.array().cast(TOPIC_VERIFICATION[k].dataType))
                         for k in VERIFICATION_KEYS.values()])
    issues = F.flatten(F.transform(entries, lambda e: F.coalesce(e["issues"], F.array().cast(
        TOPIC_VERIFICATION["mcq_verifications"].dataType.elementType["issues"].dataType))))
    return verdicts.select(
        "request_id",
        F.size(F.filter(issues, lambda i: ~F.coalesce(i["issue_type"].isin(*ISSUE_TYPES), F.lit(False))))
        .alias("bad_issue_types"),
        F.size(F.filter(issues, lambda i: ~F.coalesce(i["severity"].isin(*SEVERITIES), F.lit(False))))
        .alias("bad_severities"),
        (~F.coalesce(v["overall_quality"].isin(*QUALITY_RATINGS), F.lit(False))).alias("bad_quality"))


def type_errors(json: Column, qtype: Column) -> Column:
    """Values of a parsed section whose runtime type isn't the declared one (I10): strings must be strings, lists lists of strings.

    ``json`` is a VARIANT column.  The merged schema of the whole section is
    asked first: where every declared field has its type throughout and every
    group names its level, there is no error and no value is looked at singly.
    """
    from ..schemas import QTYPES, TYPE_FIELDS
    lists = {"options", "reference_points", "variations"}
    schema = F.schema_of_variant(json)

    def bad_fields(q, qt):
        errs = F.lit(0)
        for f in TYPE_FIELDS[qt]:
            fv = F.try_variant_get(q, f"$.{f}", "variant")
            t = F.schema_of_variant(fv)
            if f in lists:
                ok = fv.isNull() | (t == "ARRAY<STRING>") | (t == "ARRAY<VOID>") | (t == "ARRAY<UNKNOWN>")
            else:
                ok = fv.isNull() | (t == "STRING")
            errs = errs + F.when(ok, 0).otherwise(1)
        return errs

    total = None
    for qt in QTYPES:
        groups = F.coalesce(F.try_variant_get(json, f"$.{qt}", "array<variant>"), F.array().cast("array<variant>"))
        n = F.aggregate(groups, F.lit(0), lambda acc, g: acc + F.aggregate(
            F.coalesce(F.try_variant_get(g, "$.questions", "array<variant>"), F.array().cast("array<variant>")),
            F.lit(0), lambda a2, q: a2 + bad_fields(q, qt)) + F.when(
            F.schema_of_variant(F.try_variant_get(g, "$.bloom_taxonomy", "variant")) == "STRING", 0).otherwise(1))
        strings = "|".join(f for f in TYPE_FIELDS[qt] if f not in lists)
        arrays = "|".join(f for f in TYPE_FIELDS[qt] if f in lists)
        odd = rf"(?:\b(?:{strings}|bloom_taxonomy): (?!STRING\b))|(?:\b(?:{arrays}): (?!ARRAY<(?:STRING|VOID)>))"
        plain = ~schema.rlike(odd) & F.forall(groups, lambda g: F.try_variant_get(g, "$.bloom_taxonomy", "string").isNotNull())
        expr = F.when(plain, 0).otherwise(n)
        total = F.when(qtype == qt, expr) if total is None else total.when(qtype == qt, expr)
    return total


def strict_type_violations(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """Typed sections with the number of values of a wrong runtime type.

    ``from_json`` casts a number to a string silently, so the text is read as VARIANT.
    """
    from ..functions.text import clean_response
    read = responses.select("*", F.try_parse_json(clean_response(F.col(raw))).alias("as_json"))
    return read.select(*responses.columns, type_errors(F.col("as_json"), F.col("qtype")).alias("type_errors"))
