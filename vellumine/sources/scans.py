"""Scans: page records, images, listings, overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.functions import text as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Page JSON documents, one a file, with the page number that the file name states; broken JSON raises."""
    records = spark.read.schema(schemas.PAGE).json(path, multiLine=True, mode="FAILFAST", pathGlobFilter="*.json")
    return records.withColumn("file_page", F.regexp_extract(F.col("_metadata.file_name"), r"page-(\d+)\.json$", 1).try_cast("int"))


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one a file; anything but an object of the schema raises."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def commented_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents with comments."""
    strip = F.udf(T.uncommented, "string")
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.from_json(strip("value"), schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def regions(records: DataFrame) -> DataFrame:
    """A row for each region of each page, in order."""
    return records.select("page", F.posexplode("study.regions").alias("pos", "r")).select("page", "pos", "r.*")


def files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """Name, path, size, time and digest of files."""
    found = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=str(recursive).lower()).load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return found.select(name.alias("name"), "path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"))


def pdf_listing(spark: SparkSession, path: str) -> DataFrame:
    """PDF files of a folder, not below it, whatever the case of their suffix, by folded name, with their slug."""
    found = files(spark, path, "*.[pP][dD][fF]")
    stem = F.regexp_replace("name", r"(?i)\.pdf$", "")
    return found.withColumn("slug", T.slug(stem)).orderBy(F.lower("name"), "name")


def repeated_slugs(listing: DataFrame) -> DataFrame:
    return listing.groupBy("slug").agg(F.count("*").alias("n")).where("n > 1").orderBy("slug")


def page_pairs(images: DataFrame, records: DataFrame) -> DataFrame:
    """Images with the record of the same stem; ``record`` is null where there is none."""
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    a = images.select(stem.alias("stem"), F.col("path").alias("image"))
    b = records.select(stem.alias("stem"), F.col("path").alias("record"))
    return a.join(b, "stem", "left")


def cleaned_pages(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """``page, n, path`` for each wanted page: n of 0 is missing, over 1 ambiguous."""
    number = F.regexp_extract("name", r"page-(\d+)", 1).try_cast("int")
    numbered = found.withColumn("page", number).where("page IS NOT NULL")
    return wanted.join(numbered, "page", "left").groupBy("page").agg(F.count("path").alias("n"), F.min("path").alias("path"))


def existing_pages(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Pages that the manifest names; without a manifest, those that the files are named after."""
    if not manifest.isEmpty():
        return manifest.select("page").distinct().orderBy("page")
    number = F.regexp_extract("name", r"^page-(\d+)\.json$", 1).try_cast("int")
    return listing.select(number.alias("page")).where("page IS NOT NULL").distinct().orderBy("page")


def overrides(documents: DataFrame, schema: str = schemas.OVERRIDE) -> DataFrame:
    """Rows of override documents (schema_version, overrides), which must be of version 1."""
    version = F.when(F.col("schema_version") == 1, True).otherwise(F.raise_error(F.lit("unsupported override version")))
    return documents.where(version).select(F.explode("overrides").alias("o")).select("o.*")


def override_violations(rows: DataFrame) -> DataFrame:
    again = rows.groupBy("page", "id").agg(F.count("*").alias("n")).where("n > 1").select("page", "id", F.lit("repeated").alias("violation"))
    blank = rows.where("trim(coalesce(final_translation, '')) = ''").select("page", "id", F.lit("blank").alias("violation"))
    return again.unionByName(blank)


def page_count(info: Column) -> Column:
    """Number of pages in the output of a PDF information tool."""
    return F.regexp_extract(info, r"(?mi)^Pages:\s+(\d+)\s*$", 1).try_cast("int")


def newest(files_: DataFrame) -> DataFrame:
    return files_.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
