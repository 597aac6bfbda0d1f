"""Path metadata for chapter folders (pure Column code)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_number

# Anchor folders in order of preference, and the offsets of
# class / subject / chapter below each anchor.
#   CBSE:   class +1, (medium +2), subject +3, chapter +4
#   Sample: class +1, subject +2, chapter +3
ANCHORS = {"CBSE": (1, 3, 4), "Sample": (1, 2, 3)}
UNKNOWN = "Unknown"


def chapter_info(path: Column) -> Column:
    """Struct(class_name, subject_name, chapter_name, dir_name, chapter_number, error)
    for a chapter folder path.  No anchor -> names null and an error text."""
    parts = F.split(path, "/")
    pos = {a: F.array_position(parts, a) for a in ANCHORS}
    anchor_pos = F.when(pos["CBSE"] > 0, pos["CBSE"]).when(pos["Sample"] > 0, pos["Sample"])
    is_cbse = pos["CBSE"] > 0

    def at(k_cbse: int, k_sample: int) -> Column:
        k = F.when(is_cbse, F.lit(k_cbse)).otherwise(F.lit(k_sample))
        return F.when(anchor_pos.isNotNull(),
                      F.coalesce(F.try_element_at(parts, (anchor_pos + k).cast("int")), F.lit(UNKNOWN)))

    (c1, s1, h1), (c2, s2, h2) = ANCHORS["CBSE"], ANCHORS["Sample"]
    dir_name = F.element_at(parts, -1)
    return F.struct(
        at(c1, c2).alias("class_name"),
        at(s1, s2).alias("subject_name"),
        at(h1, h2).alias("chapter_name"),
        dir_name.alias("dir_name"),
        first_number(dir_name).alias("chapter_number"),
        F.when(anchor_pos.isNull(), F.concat(F.lit("Could not find CBSE or Sample in path: "), path))
        .alias("error"),
    )


def snapshot_name(class_name: Column, subject_name: Column, chapter_name: Column,
                  stage: Column, ts: Column) -> Column:
    """``{class}_{subject}_{chapter}_{stage}_{yyyyMMdd_HHmmss}.txt`` with spaces as ``_``."""
    def safe(c):
        return F.replace(c, F.lit(" "), F.lit("_"))
    return F.concat(F.concat_ws("_", safe(class_name), safe(subject_name), safe(chapter_name), stage,
                                F.date_format(ts, "yyyyMMdd_HHmmss")), F.lit(".txt"))
