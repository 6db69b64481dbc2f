"""Readers of files and folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions.text import first_doi, first_line_title


def folder_files(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """(path, name, text, length) of a folder's text files, ordered by path; length is in characters."""
    d = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path, wholetext=True)
    p = F.col("_metadata.file_path")
    return d.select(p.alias("path"), F.regexp_extract(p, r"([^/]+)$", 1).alias("name"), F.col("value").alias("text"), F.length("value").alias("length")).orderBy("path")


def json_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines (by extension) or a JSON array or object; blank lines are skipped."""
    r = spark.read.option("multiLine", not path.rstrip("/").endswith(".jsonl")).option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema else r).json(path)


def csv_texts(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def record_folders(spark: SparkSession, root: str, name: str = "record.json", skip_broken: bool = True) -> DataFrame:
    """(path, folder, doc) of one JSON file per folder below ``root``; unreadable ones are left out or, without ``skip_broken``, an error."""
    d = spark.read.option("pathGlobFilter", name).option("recursiveFileLookup", True).text(root, wholetext=True)
    p = F.col("_metadata.file_path")
    d = d.select(p.alias("path"), F.regexp_extract(p, r"([^/]+)/[^/]+$", 1).alias("folder"), F.col("value").alias("doc"))
    if skip_broken:
        return d.filter(F.try_parse_json("doc").isNotNull())
    return d.filter(F.parse_json("doc").isNotNull())


def local_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(doi, folder): folders with a paper.xml or a sections folder. The DOI is the first one in the text, else in the folder's name; of one DOI (case folded) the first folder counts."""
    named = spark.read.option("recursiveFileLookup", True)
    d = named.option("pathGlobFilter", "paper.xml").text(root, wholetext=True).withColumn("path", F.url_decode(F.col("_metadata.file_path")))
    xml = d.select(F.regexp_extract("path", r"^(.*)/paper\.xml$", 1).alias("folder"), first_doi(F.col("value")).alias("x"))
    # Only the names of the other files are read, not what is in them.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.url_decode(F.col("path")).alias("path"))
    sec = files.filter(F.col("path").contains("/sections/")).select(F.regexp_extract("path", r"^(.*)/sections/", 1).alias("folder"), F.lit(None).cast("string").alias("x"))
    by_name = first_doi(F.replace(F.regexp_extract("folder", r"([^/]+)$", 1), F.lit("_"), F.lit("/")))
    got = xml.union(sec).groupBy("folder").agg(F.max("x").alias("x")).withColumn("doi", F.coalesce("x", by_name)).filter("doi is not null")
    w = Window.partitionBy(F.lower("doi")).orderBy("folder")
    return got.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("doi", "folder")


def titled(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.withColumn("title", first_line_title(F.col(text)))


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8) -> DataFrame:
    """A database table, read in parallel ranges of a numeric column where given; the statement's time-out is five minutes unless set."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**({"queryTimeout": "300"} | properties))
    if column and bounds:
        r = r.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return r.load()


def head_keys(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The first n keys; all of them where n is 0."""
    return rows.orderBy(key).limit(n) if n > 0 else rows


def with_prediction(rows: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Rows whose key has a prediction file; each stays once, however many files there are."""
    return rows.join(predictions.select(key).distinct(), key, "left_semi")
