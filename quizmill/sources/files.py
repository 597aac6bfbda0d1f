"""File sources: chapter folders and their JSON documents.

All readers take a root folder and return DataFrames keyed by the chapter
folder path; nothing is read on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CHAPTER_CONTENT, PAGE, SUMMARY, TOPICS_FILE

CORRUPT = "_corrupt_record"


def local_path(uri: Column) -> Column:
    """``_metadata.file_path`` is a URI: drop the scheme and percent-decode
    (a literal ``+`` is protected first, ``url_decode`` would turn it into a space)."""
    p = F.regexp_replace(uri, r"^file:(//)?", "")
    return F.url_decode(F.replace(p, F.lit("+"), F.lit("%2B")))


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def _json_files(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name)
          .option("multiLine", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).schema(with_corrupt).json(root))
    return df.withColumn("path", local_path(F.col("_metadata.file_path"))).withColumn("chapter_dir", parent(F.col("path")))


def _exists(spark: SparkSession, path: str) -> bool:
    """Metadata check through the Hadoop file system (like a file listing)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def find_chapters(spark: SparkSession, root: str) -> DataFrame:
    """Chapter folders = folders holding ``chapter_content.json`` (A1, A2, F1).

    When the root itself holds one, only the root is a chapter (decided by
    one existence check, then only that file is read); otherwise the tree
    is scanned recursively.  Missing ``content`` -> '' (B3).
    """
    root_dir = root.rstrip("/")
    own = f"{root_dir}/chapter_content.json"
    if _exists(spark, own):
        with_corrupt = T.StructType(list(CHAPTER_CONTENT.fields) + [T.StructField(CORRUPT, T.StringType())])
        df = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).schema(with_corrupt).json(own)
              .withColumn("chapter_dir", parent(local_path(F.col("_metadata.file_path")))))
    else:
        df = _json_files(spark, root_dir, "chapter_content.json", CHAPTER_CONTENT)
    # sorted by folder (F1): a global sort is a range shuffle, no single task
    return df.select("chapter_dir", "chapter_name", F.coalesce("content", F.lit("")).alias("content"),
                     F.col(CORRUPT).isNotNull().alias("corrupt")).orderBy("chapter_dir")


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """``llm_output.json`` page lists -> (chapter_dir, page_number, page_content) (A5 input)."""
    arr = T.StructType([T.StructField("pages", T.ArrayType(PAGE))])
    df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "llm_output.json")
          .text(root, wholetext=True))
    parsed = F.from_json(F.concat(F.lit('{"pages":'), F.col("value"), F.lit("}")), arr)
    return (df.select(parent(local_path(F.col("_metadata.file_path"))).alias("chapter_dir"),
                      F.explode(parsed["pages"]).alias("p"))
            .select("chapter_dir", "p.page_number", "p.page_content"))


def read_topics_files(spark: SparkSession, root: str) -> DataFrame:
    """Legacy ``topics.json`` -> one row per topic, empty files kept (A4)."""
    df = _json_files(spark, root, "topics.json", TOPICS_FILE)
    return df.select("chapter_dir", "chapter_name", "total_topics",
                     F.posexplode_outer("topics").alias("topic_pos", "t")).select(
        "chapter_dir", "chapter_name", "total_topics", "topic_pos",
        F.col("t.topic").alias("topic"), F.col("t.content").alias("content"))


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """``summary.json`` -> (chapter_dir, short, detailed)."""
    df = _json_files(spark, root, "summary.json", SUMMARY)
    return df.select("chapter_dir", F.col("summary.short").alias("short"), F.col("summary.detailed").alias("detailed"))


def read_syllabus_files(spark: SparkSession, root: str) -> DataFrame:
    """``syllabus.json`` per subject folder -> one JSON entry per chapter (A3).

    The document is parsed to VARIANT; the chapter list is ``chapters``
    when that key exists (even empty), else ``Chapters``, else empty.
    Output: (subject_key, chapter_pos, entry_json) for
    ``corpus.parse_syllabus_entries``.
    """
    df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "syllabus.json")
          .text(root, wholetext=True))
    v = F.try_parse_json("value")
    keys = F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))
    chapters = (F.when(F.array_contains(keys, "chapters"), F.try_variant_get(v, "$.chapters", "array<variant>"))
                .when(F.array_contains(keys, "Chapters"), F.try_variant_get(v, "$.Chapters", "array<variant>")))
    return (df.select(parent(local_path(F.col("_metadata.file_path"))).alias("subject_key"),
                      F.posexplode(F.coalesce(chapters, F.array().cast("array<variant>"))).alias("chapter_pos", "e"))
            .select("subject_key", F.col("chapter_pos").cast("bigint").alias("chapter_pos"),
                    F.to_json("e").alias("entry_json")))
