"""Variation responses: unwrap, normalise, pad and cap (pure Column code).

A response is free JSON.  It is parsed to VARIANT once; every branch of
the normaliser is then a ``when`` over the element's runtime type, inside
``transform`` so that a response never leaves the row it belongs to.

Known deviations from a Python rendering, documented in the README: a
fallback JSON dump is compact with keys in sorted order, and nested lists
inside an object value render as JSON rather than as a Python repr.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import N_VARIATIONS
from .text import let, py_strip

TEXT_KEYS = ["question", "variation_text", "variation", "text", "prompt"]


def _type(v: Column) -> Column:
    return F.schema_of_variant(v)


def py_str(v: Column) -> Column:
    """``str(value)`` of a JSON value: strings as is, None/True/False spelled
    the Python way, containers as compact JSON."""
    return let(_type(v), lambda t: F.when(v.isNull() | (t == "VOID"), F.lit("None"))
                .when(t == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string")))
                .when(t.startswith("OBJECT") | t.startswith("ARRAY"), F.to_json(v))
                .otherwise(F.try_variant_get(v, "$", "string")))


def _full(s: Column) -> Column:
    """A text, or null instead of an empty one."""
    return let(s, lambda x: F.when(x != "", x))


def _str_field(x: Column, key: str) -> Column:
    """Stripped value of ``key`` when it is a non-blank string, else null."""
    return let(F.try_variant_get(x, f"$.{key}", "variant"),
                lambda fv: F.when(_type(fv) == "STRING", _full(py_strip(F.try_variant_get(fv, "$", "string")))))


def _joined_list(x: Column, key: str) -> Column:
    """'; '-joined non-blank entries of a list field, null when absent/empty."""
    arr = F.try_variant_get(x, f"$.{key}", "array<variant>")
    return _full(F.array_join(F.filter(F.transform(arr, lambda o: py_strip(py_str(o))), lambda s: s != ""), "; "))


def _from_object(x: Column, is_mcq: Column) -> Column:
    text = F.coalesce(*[_str_field(x, k) for k in TEXT_KEYS])
    head = F.array_join(F.array(
        text,
        F.when(is_mcq, F.concat(F.lit("Options: "), _joined_list(x, "options"))),
        F.when(is_mcq, F.concat(F.lit("Answer: "), _str_field(x, "answer"))),
        F.concat(F.lit("Key points: "), _joined_list(x, "reference_points"))), " | ")
    base = let(head, lambda h: let(_str_field(x, "reference_answer"), lambda ref: F.when(ref.isNull(), h).when(h == "", ref)
                                     .otherwise(F.concat(h, F.lit(" | Reference answer: "), ref))))
    return let(base, lambda b: F.when(b != "", b).otherwise(F.to_json(x)))


def _bundle(obj: Column) -> Column:
    keys = F.array_sort(F.filter(F.map_keys(obj), lambda k: k.startswith("variation_")))
    return _full(F.array_join(F.filter(F.transform(keys, lambda k: py_strip(py_str(F.try_element_at(obj, k)))), lambda s: s != ""), " | "))


def normalize_item(x: Column, is_mcq: Column) -> Column:
    """One variation (a VARIANT) -> text, following the branch order:
    string; bundle of ``variation_*`` keys; object fields; scalar.

    For objects the text is the first non-blank text field, then (MCQ only)
    ``Options: ...`` and ``Answer: ...``, then ``Key points: ...``, joined by
    `` | ``; a reference answer is appended as ``Reference answer: ...``, or
    stands alone when nothing came before it.
    """
    of_object = lambda obj: F.when(obj.isNotNull(), F.coalesce(_bundle(obj), _from_object(x, is_mcq))).otherwise(py_strip(py_str(x)))
    return (F.when(_type(x) == "STRING", py_strip(F.try_variant_get(x, "$", "string")))
            .otherwise(let(F.try_variant_get(x, "$", "map<string,variant>"), of_object)))


def unwrap(v: Column) -> Column:
    """Response -> list of raw variations: an object's ``variations`` member
    when present, a list as is, anything else as a one-element list."""
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    has_key = F.coalesce(F.array_contains(F.map_keys(obj), "variations"), F.lit(False))
    raw = F.when(has_key, F.try_element_at(obj, F.lit("variations"))).otherwise(v)
    return F.coalesce(F.try_variant_get(raw, "$", "array<variant>"), F.array(raw))


def normalized_variations(parsed: Column, is_mcq: Column) -> Column:
    """Non-empty normalised variations, before padding (null if the call failed)."""
    return F.when(parsed.isNotNull(),
                  F.filter(F.transform(unwrap(parsed), lambda x: normalize_item(x, is_mcq)),
                           lambda s: s.isNotNull() & (s != "")))


def padded(norm: Column, question: Column, n: int = N_VARIATIONS) -> Column:
    """Pad with the first variation (or the question when none) up to ``n``; none above is cut.

    A failed call (null) yields an empty list and is not padded.
    """
    filler = F.coalesce(F.get(norm, 0), question)
    full = F.concat(norm, F.array_repeat(filler, F.greatest(F.lit(n) - F.size(norm), F.lit(0))))
    return F.when(norm.isNull(), F.array().cast("array<string>")).otherwise(full)
