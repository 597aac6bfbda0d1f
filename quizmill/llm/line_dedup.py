"""Cross-site boilerplate: lines that many sites show among unrelated contents.

A line (blanks at its ends cut off; empty lines don't count) is boilerplate if
it stands on at least ``least_sites`` distinct sites (``source``) and beside at
least as many different contents.  A document's content is the set of its lines
that stand on fewer sites, so neither blank lines nor whole blocks of boilerplate
are part of it, wherever they stand.  Both numbers are absolute: copies of a
document add nothing and take nothing away.  Copies that were each changed in
another line count as different contents: from eight of them on, on eight sites,
the lines that they share go.

Numbers are estimated by HyperLogLog sketches, one per line hash, which merge by
aggregation.  Lines whose estimate lies near the threshold get exact distinct
counts.  Boilerplate goes from every document; other lines stay, in order, and so
do documents that lose all their lines.

Nulls: a null text has no line and stays null; a null source is no site.
Repeated rows are copies.  An empty table gives no rows.  Only line feeds end a
line: a carriage return before one is part of its line, so a line with one is
another line than the same without.  Columns of the input with the names used
inside are left as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, staged, table

LEAST_SITES = 8
#: 2**12 registers: a relative standard error of 1.6 %.
SKETCH_BITS = 12
#: Relative distance from a threshold within which a line is counted exactly: six standard errors.
NEAR = 0.1


def line_hash(line):
    return F.xxhash64(F.trim(line))


def widespread(docs: DataFrame, least_sites: int = LEAST_SITES) -> DataFrame:
    """(line): the hashes of the lines to remove, decided on distinct sites.

    The line stands on ``least_sites`` distinct sites or more, in documents with
    ``least_sites`` or more different contents.  A document's content is the set
    of its lines that stand on fewer sites: blank lines and whole blocks of
    boilerplate aren't part of it, wherever they stand.  Both numbers are
    absolute, so copies of a document add nothing and take nothing away.
    """
    hashes = F.filter(F.transform(F.split("text", "\n"), lambda x: F.when(F.trim(x) != "", line_hash(x))), lambda h: h.isNotNull())
    texts = docs.where("text is not null").select(F.xxhash64("text").alias("th"), F.col("source").cast("string").alias("site"), F.array_distinct(hashes).alias("h"))
    part = lambda h: F.shiftright(h, 24)  # noqa: E731  sums of 2**23 of them fit a long
    sized = texts.select("th", "site", "h", F.size("h").alias("n_all"), F.aggregate("h", F.lit(0).cast("long"), lambda a, h: a + part(h)).alias("sum_all"))
    lines = sized.select("th", "site", "n_all", "sum_all", F.explode("h").alias("line"))
    # a line on so many sites is in so many rows: a summed count leaves out the rare ones for good
    frequent = staged(lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= least_sites).select("line"), "row-counts")
    seen = staged(lines.join(frequent, "line", "left_semi"), "lines-of-many-rows")
    sites = staged(at_least(seen, "site", least_sites), "lines-of-many-sites")
    # what a text holds beside such lines: its sums less theirs, one row a text
    shown = seen.join(sites, "line", "left_semi").select("line", "th", "n_all", "sum_all").distinct().groupBy("th", "n_all", "sum_all").agg(F.collect_list("line").alias("lines"))
    rest = shown.select("lines", (F.col("n_all") - F.size("lines")).alias("n"), F.aggregate("lines", F.col("sum_all"), lambda a, h: a - part(h)).alias("sum"))
    contents = staged(rest.where("n > 0").select(F.explode("lines").alias("line"), F.xxhash64("n", "sum").alias("content")), "contents-beside")
    return at_least(contents, "content", least_sites)


def at_least(pairs: DataFrame, column: str, least: int) -> DataFrame:
    """(line): lines with ``least`` distinct values or more, by sketches; those near the threshold are counted exactly."""
    estimate = staged(pairs.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg(column, SKETCH_BITS)).alias("n")), f"{column}-estimates")
    close = F.abs(F.col("n") - least) <= max(1.0, least * NEAR)
    # distinct (line, value) pairs are summed first, so that no line's rows meet in one task
    some = pairs.where(f"{column} is not null").join(estimate.where(close).select("line"), "line", "left_semi").select("line", column).distinct()
    exact = some.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return estimate.where(~close & (F.col("n") >= least)).select("line").unionByName(exact.select("line"))


def without_boilerplate(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """``docs`` with _kept (text without the lines ``flagged``), _lines (not blank) and _removed (lines gone)."""
    flagged = staged(flagged, "boilerplate")
    key = F.struct("doc_id", F.xxhash64("text").alias("text"))  # rows with the same id and text share their lines
    hashes = F.filter(F.transform(F.split("text", "\n"), lambda x: F.when(F.trim(x) != "", line_hash(x))), lambda h: h.isNotNull())
    gone = (docs.where(F.col("text").isNotNull()).select(key.alias("_key"), F.explode(F.array_distinct(hashes)).alias("line"))
            .join(flagged, "line", "left_semi").groupBy("_key").agg(F.collect_set("line").alias("_gone")))
    joined = docs.withColumn("_key", key).join(gone.withColumnRenamed("_key", "_gone_key"), F.col("_key").eqNullSafe(F.col("_gone_key")), "left")
    split = F.split("text", "\n")
    keep = F.filter(split, lambda x: (F.trim(x) == "") | ~F.array_contains("_gone", line_hash(x)))
    kept = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n"))
    full = lambda t: F.coalesce(F.size(F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")), F.lit(0)).cast("long")
    out = joined.withColumn("_kept", kept).withColumn("_lines", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(full("text")))
    out = out.withColumn("_removed", F.when(F.col("_gone").isNull(), F.lit(0).cast("long")).otherwise(F.col("_lines") - full("_kept")))
    return out.drop("_key", "_gone_key", "_gone")


@apart("doc_id", "text", "source", "n_chars")
def remove_boilerplate(docs: DataFrame) -> DataFrame:
    """``docs`` with ``widespread`` lines cut from ``text`` (``n_chars`` follows, where there is one); same columns, same rows."""
    out = without_boilerplate(docs, widespread(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_removed") > 0, F.length("_kept").cast("long")).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("_kept")).select(*docs.columns)


def op4_site_spread_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines that aren't blank, lines removed, and the checksum of the text kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = without_boilerplate(docs, widespread(docs))
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"),
                      F.sha2(F.coalesce("_kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = f"""
WITH raw AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, source, text, trim(unnest(parts)) AS line, unnest(parts) AS whole, unnest(generate_series(1, len(parts))) AS pos FROM raw WHERE text IS NOT NULL),
wide AS (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {LEAST_SITES}),
held AS (SELECT DISTINCT text, line FROM lines WHERE line <> ''),
beside AS (
  SELECT text, string_agg(h.line, chr(10) ORDER BY h.line) FILTER (WHERE w.line IS NULL) AS content
  FROM held h LEFT JOIN wide w ON h.line = w.line GROUP BY text),
gone AS (
  SELECT h.line FROM held h JOIN wide w ON h.line = w.line JOIN beside b ON b.text = h.text
  WHERE b.content IS NOT NULL GROUP BY h.line HAVING count(DISTINCT b.content) >= {LEAST_SITES}),
marked AS (SELECT l.*, g.line IS NOT NULL AS removed FROM lines l LEFT JOIN gone g ON l.line = g.line AND l.line <> ''),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE line <> '') AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
         coalesce(string_agg(whole, chr(10) ORDER BY pos) FILTER (WHERE NOT removed), '') AS text
  FROM marked GROUP BY doc_id)
SELECT r.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM raw r LEFT JOIN kept k USING (doc_id)
"""
