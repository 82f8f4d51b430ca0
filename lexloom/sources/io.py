"""Readers and writers: page XML, JSON, JSON lines, CSV, column-wise JSON, text reports, shards by letter with a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.normalize import line_text, shard_letter

ENTRY = "term string, body string, source_pages array<string>"
CANDIDATE = "source_index int, source_headword string, norm_headword string, body string, source_pages array<string>, leaves array<int>"
PAGE = "leaf int, printed_page string, page_type string, width int, height int, lines array<string>"
CORRECTION = "type string, term string, trim_at string, old string, new string, correct string, issue string, reason string"
OBJECT = "_width int, _height int, HIDDENTEXT struct<PAGECOLUMN: struct<REGION: struct<PARAGRAPH: array<struct<LINE: array<struct<WORD: array<struct<_coords: string, _VALUE: string>>>>>>>>>"


def page_xml(spark: SparkSession, path: str, schema: str = OBJECT) -> DataFrame:
    """Lines of scanned pages with their boxes (S1): leaf, width, height, line, text, x0, y0, x1, y1.

    Files are cut at the ends of their objects, wherever a split of theirs ends, so one large file is read by many
    tasks. Pages are numbered in document order: by their place in a split and the number of pages in the splits
    before, one small row each. Words without text after normalising, or without four whole numbers, are dropped.
    """
    raw = spark.read.text(path, lineSep="</OBJECT>").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    raw = raw.where(F.contains("value", F.lit("<OBJECT")))
    splits = raw.groupBy("file", "split").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = raw.join(splits.withColumn("before", before), ["file", "split"])
    record = F.concat(F.expr("substring(value, instr(value, '<OBJECT'))"), F.lit("</OBJECT>"))
    pages = placed.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).cast("int").alias("leaf"), F.from_xml(record, schema, {"rowTag": "OBJECT"}).alias("page")).select("file", "leaf", "page.*")
    lines = pages.select("file", "leaf", F.col("_width").alias("width"), F.col("_height").alias("height"), F.posexplode(F.flatten(F.expr("transform(HIDDENTEXT.PAGECOLUMN.REGION.PARAGRAPH, p -> p.LINE)"))).alias("line", "l"))
    words = lines.select("file", "leaf", "width", "height", "line", F.posexplode("l.WORD").alias("nth", "w"))
    box = F.split("w._coords", ",")
    words = words.withColumn("t", line_text("w._VALUE")).where((F.col("t") != "") & F.col("w._coords").rlike(r"^\d+,\d+,\d+,\d+$"))
    words = words.select("file", "leaf", "width", "height", "line", "nth", "t", *(box[i].cast("int").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "t"))), lambda s: s["t"]), " ")
    return words.groupBy("file", "leaf", "width", "height", "line").agg(text.alias("text"), F.min("x0").alias("x0"), F.min(F.least("y0", "y1")).alias("y0"), F.max("x1").alias("x1"), F.max(F.greatest("y0", "y1")).alias("y1"))


def page_metadata(spark: SparkSession, path: str) -> DataFrame:
    """leaf, printed_page, page_type of scan metadata; blanks are null, leaves that are no number are dropped."""
    raw = spark.read.format("xml").option("rowTag", "page").schema("_leafNum string, pageNumber string, pageType string").load(path)
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return raw.select(F.col("_leafNum").try_cast("int").alias("leaf"), blank(F.col("pageNumber")).alias("printed_page"), blank(F.col("pageType")).alias("page_type")).where("leaf is not null")


def json_array(spark: SparkSession, path: str, schema: str = ENTRY) -> DataFrame:
    """A file that is one JSON array (S3)."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line; blank and broken lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def csv_corpus(spark: SparkSession, path: str) -> DataFrame:
    """term and definition with a header line; rows without a term are dropped."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', schema="term string, definition string").where("term is not null and trim(term) <> ''")


def column_json(spark: SparkSession, path: str) -> DataFrame:
    """{'term': {i: ..}, 'definition': {i: ..}} as rows."""
    raw = spark.read.schema("term map<string,string>, definition map<string,string>").json(path, multiLine=True)
    a, b = raw.select(F.explode("term").alias("i", "term")), raw.select(F.explode("definition").alias("i", "definition"))
    return a.join(b, "i").select("term", "definition")


def shards(spark: SparkSession, glob: str, schema: str = ENTRY) -> DataFrame:
    """All shards of a glob with the letter in their file names."""
    return spark.read.schema(schema).json(glob, multiLine=True).withColumn("letter", F.upper(F.regexp_extract(F.col("_metadata.file_name"), r"_([a-z])\.json", 1)))


def report_sections(spark: SparkSession, path: str, heading: str = r"(?m)^## ") -> DataFrame:
    """Sections of a text report: title and text."""
    parts = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", heading)).alias("nth", "part"))
    return parts.where("nth > 0").select("nth", F.regexp_extract("part", r"^([^\n]*)", 1).alias("title"), F.regexp_replace("part", r"^[^\n]*\n?", "").alias("text"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, columns in order."""
    df.write.mode("overwrite").json(path)


def write_alignment_csv(df: DataFrame, path: str) -> None:
    """Scores with two decimals, arrays joined by ', ' (S10)."""
    cells = [F.format_string("%.2f", c).alias(c) if t == "double" else F.array_join(c, ", ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*cells).write.mode("overwrite").csv(path, header=True)


def lettered(entries: DataFrame) -> DataFrame:
    """Entries with the letter of their shard; letters outside A-Z have no shard."""
    return entries.withColumn("letter", shard_letter("term"))


def manifest(entries: DataFrame) -> DataFrame:
    """letter, file and count of each shard."""
    kept = lettered(entries).where(F.col("letter").rlike("^[A-Z]$"))
    return kept.groupBy("letter").agg(F.count("*").alias("count")).select("letter", F.concat(F.lit("entries_"), F.lower("letter"), F.lit(".json")).alias("file"), "count")


def write_shards(entries: DataFrame, path: str) -> DataFrame:
    """Writes shards by letter, the manifest and the rejected rows; returns the manifest.

    Rows are written by the tasks that hold them, so a letter with a third of all rows is written by many.
    """
    marked = lettered(entries)
    good = F.col("letter").rlike("^[A-Z]$")
    marked.where(good).write.mode("overwrite").partitionBy("letter").json(f"{path}/entries")
    marked.where(~good).write.mode("overwrite").json(f"{path}/rejects")
    out = manifest(entries)
    out.write.mode("overwrite").json(f"{path}/manifest")
    return out


def read_shards(spark: SparkSession, path: str, *letters: str) -> DataFrame:
    """Entries of a sharded store; with letters only their partitions are read."""
    df = spark.read.schema(f"{ENTRY}, letter string").json(f"{path}/entries")
    return df.where(F.col("letter").isin(*letters)) if letters else df


def save_count(spark: SparkSession, n: int, path: str) -> None:
    """The count of a build as a table of one row."""
    spark.createDataFrame([(n,)], "n long").coalesce(1).write.mode("overwrite").json(path)


def wordlist(entries: DataFrame, *more: DataFrame) -> DataFrame:
    """Distinct upper-case terms longer than 2 without end marks, with further lists, in order."""
    words = entries.select(F.upper(F.regexp_replace("term", "[.,;:]+$", "")).alias("word"))
    for m in more:
        words = words.unionByName(m.select(F.upper(m.columns[0]).alias("word")))
    return words.where(F.length("word") > 2).distinct().orderBy("word")


def promote(candidate: DataFrame, path: str) -> None:
    """The candidate becomes the live corpus."""
    candidate.write.mode("overwrite").parquet(path)


def headword_index(entries: DataFrame) -> DataFrame:
    """Distinct headwords in order."""
    return entries.select("term").distinct().orderBy("term")
