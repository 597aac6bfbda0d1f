"""Column-level text functions (all JVM-side, no Python per row)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SECTION_PART

# Whitespace as Python's str.strip() sees it (str.isspace), spelled out so
# that Java regex gives the same answer as the pipeline being rebuilt.
_PY_WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
PY_WS = r"[\t\n\x0b\x0c\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SENTENCE_BREAK = r"(?<=[.!?])\s+"
NON_WORD = r"[^\p{L}\p{N}]+"
HEADING_NUMBER = r"^\d+\.\d+\s+"
NEXT_HEADING = r"\n#+ \d+\.\d+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside lambdas Spark shares nothing between places that name the same expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def exploded(rows: DataFrame, values: Column, name: str, *keep: str) -> DataFrame:
    """``keep`` and a row for each of ``values``, none for an empty or null list.

    For a plain ``explode`` Spark infers a filter on the list's size, which it
    pushes below the projections and so works out costly lists several times.
    """
    return rows.select(*keep, F.posexplode_outer(values).alias("_at", name)).where("_at IS NOT NULL").drop("_at")


def trim_ascii(col) -> Column:
    """Strip ASCII whitespace at both ends (the sentence-level trim)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def py_strip(col) -> Column:
    """Python ``str.strip()`` parity (Unicode whitespace); looks at the ends only, not at every character as a pattern would."""
    return F.btrim(_c(col), F.lit(_PY_WS))


def sentences(col) -> Column:
    """Split text into trimmed, non-empty sentences at ``(?<=[.!?])\\s+``."""
    parts = F.split(_c(col), SENTENCE_BREAK)
    return F.filter(F.transform(parts, trim_ascii), lambda y: y != "")


def words(col) -> Column:
    """Lower-cased word tokens: split on runs of non letters/digits, blanks dropped."""
    return F.filter(F.split(F.lower(_c(col)), NON_WORD), lambda x: x != "")


def strip_heading_number(col) -> Column:
    """Drop a two-level ``d.d `` prefix (``6.1 Title`` -> ``Title``)."""
    return F.regexp_replace(_c(col), HEADING_NUMBER, "")


def clean_response(col) -> Column:
    """Clean a raw model response before JSON parsing.

    Pre-strip; drop a leading ```json fence, then a leading ``` fence, then a
    trailing ``` fence; turn control characters (except tab and newline) into
    spaces; strip again.
    """
    t = py_strip(col)
    t = let(t, lambda x: F.when(x.startswith("```"), F.regexp_replace(x, r"^(?:```json)?(?:```)?", "")).otherwise(x))
    t = let(t, lambda x: F.when(x.endswith("```"), F.substring(x, F.lit(1), F.length(x) - 3)).otherwise(x))
    t = F.regexp_replace(t, r"[\x00-\x08\x0b-\x1f\x7f-\x9f]", " ")
    return py_strip(t)


def parts(col, size: int = SECTION_PART) -> Column:
    """Consecutive parts of at most ``size`` characters (one, empty part for an empty text)."""
    c = _c(col)
    last = F.greatest(F.ceil(F.length(c) / size), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(c, i * size + 1, F.lit(size)))


def first_number(col) -> Column:
    """First run of ASCII digits in a string, else null (chapter number)."""
    return F.nullif(F.regexp_extract(_c(col), r"[0-9]+", 0), F.lit(""))
