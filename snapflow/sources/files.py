"""File listings: size and records per file, and which dump of a dataset is the newest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapflow.functions.files import file_name, prefix_date, stem, stem_pieces, suffixes
from snapflow.session import small_frame


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below ``path``; contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listing.select("path", "length", "modificationTime")


def bare_path(path) -> "F.Column":
    """A path without its scheme, so that listings of different readers can be compared."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/*(?=/)", "")


def file_metadata(listing: DataFrame, counts: DataFrame) -> DataFrame:
    """``(path, size, records)`` from a listing and ``(_file, records)``; a file without rows has 0 records."""
    sizes = listing.select(bare_path("path").alias("path"), F.col("length").alias("size"))
    rows = counts.select(bare_path("_file").alias("path"), "records")
    return sizes.join(rows, "path", "left").select("path", "size", F.coalesce("records", F.lit(0)).alias("records"))


def latest_dumps(files: DataFrame, datasets: DataFrame, path: str = "path", suffix: str = "suffix") -> DataFrame:
    """Newest file per dataset suffix: ``(suffix, path)``, ``path`` NULL where no file matches.

    A file belongs to a suffix when its name ends with it at a real boundary, whatever the case. Newest means
    latest date prefix, undated files first, then the larger name. All datasets are settled in one pass: a
    file's possible suffixes are exploded and equi-joined; ``row_number() = 1`` keeps at most one file per
    suffix and map task before the exchange.
    """
    name = file_name(path)
    cut = files.select(F.col(path).alias("_path"), name.alias("_name")).select(
        "_path", "_name", prefix_date("_name").alias("_date"), stem_pieces(stem("_name")).alias("_pieces"))
    offers = cut.select("_path", "_name", "_date", F.explode(suffixes("_pieces")).alias("_key"))
    wanted = datasets.select(suffix, F.lower(suffix).alias("_key")).distinct()
    newest = Window.partitionBy(suffix).orderBy(F.col("_date").desc_nulls_last(), F.col("_name").desc())
    best = (offers.join(wanted, "_key").withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
            .select(suffix, F.col("_path").alias("path")))
    return datasets.select(suffix).distinct().join(best, suffix, "left")


def resolve_dump(spark: SparkSession, directory: str, suffix: str) -> str:
    """Path of the newest dump of one dataset; an error when there is none."""
    listing = spark.read.format("binaryFile").load(directory).select("path")
    found = latest_dumps(listing, small_frame(spark, [(suffix,)], "suffix string")).collect()[0]["path"]
    if found is None:
        raise FileNotFoundError(f"no file for dataset '{suffix}' in {directory}")
    return found
