"""What files a folder held, kept as Parquet, so that a run opens only those it has not seen.

A listing has path, length and time of every file and is made without opening
any. It is compared with the manifest of earlier runs first; contents are read
afterwards, for new files, and take part in no shuffle.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.merge import union_all
from siltbed.session import work_dir
from siltbed.sources.files import decoded_path, one_slash

LISTING = "path string, length bigint, modified timestamp"

#: Names of new files that are broadcast to a scan at once; more are divided into ranges of paths.
NAMES_AT_ONCE = 100_000


def _scan(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, length and time of all files, stored in the work folder; no content is read.

    File scans leave out files of zero bytes. Only if there are any, the names
    of Spark's own listing are stored too, to find them; such a file has no time.
    A path or glob without any file raises.
    """
    scan = _scan(spark, path, glob)
    folder = work_dir(spark, "listing")
    filled = scan.select("path", "length", F.col("modificationTime").alias("modified"))
    filled.write.parquet(f"{folder}/filled")
    listing = spark.read.schema(LISTING).parquet(f"{folder}/filled")
    names = scan.inputFiles()
    if not names:
        raise FileNotFoundError(f"no file at {path}" + (f" matches {glob}" if glob else ""))
    if len(names) == listing.count():
        return listing
    spark.createDataFrame([(name,) for name in names], "name string").write.parquet(f"{folder}/names")
    stored = spark.read.schema("name string").parquet(f"{folder}/names")
    every = stored.select(decoded_path(F.col("name")).alias("path"))
    key = one_slash(F.col("path"))
    empty = every.withColumn("_key", key).join(listing.select(key.alias("_key")), "_key", "left_anti")
    return listing.unionByName(
        empty.select(
            "path", F.lit(0).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified")
        )
    )


class Manifest:
    """The files of all finished runs, one folder per run.

    A run first stores what it made of the files, then its part of the manifest.
    What a run that died has stored is not in the manifest: ``finished`` hides
    it, and its files are new to the next run.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def files(self) -> DataFrame:
        try:
            return self.spark.read.schema(f"{LISTING}, run string").parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{LISTING}, run string")

    def unseen(self, listing: DataFrame) -> DataFrame:
        """Files of a listing that no finished run has seen with this length and time.

        A file that was changed counts as new. Only names, lengths and times are compared.
        """
        known = self.files().select("path", "length", "modified")
        same = [listing[c].eqNullSafe(known[c]) for c in known.columns]
        return listing.join(known, same, "left_anti")

    def record(self, files: DataFrame, run: str) -> None:
        """Mark a run as finished with these files; recording it again replaces its part."""
        files.select("path", "length", "modified").write.mode("overwrite").parquet(f"{self.folder}/run={run}")

    def finished(self, rows: DataFrame, run: str = "ingestion_id") -> DataFrame:
        """Rows of finished runs; there is one name per run to compare with."""
        runs = self.files().select(F.col("run").alias(run)).distinct()
        return rows.join(runs, run, "left_semi")


def read_listed(
    spark: SparkSession, path: str | list[str], new: DataFrame, glob: str | None = None, names_at_once: int = NAMES_AT_ONCE
) -> DataFrame:
    """Path, length and content of the files of a listing.

    Files outside the range of the new paths, or older than the oldest new file,
    are left out by Spark's listing and are not opened. The rest meets the names by
    broadcast, at most about ``names_at_once`` at a time, so contents stay where they are read.
    """
    filled = new.filter("length > 0").withColumn("_name", one_slash(F.col("path")))
    count = filled.count()
    pieces = -(-count // names_at_once)
    cuts = []
    if pieces > 1:
        # Ranges of paths with about equally many names: a cut per piece goes to the driver, no listing.
        folder = work_dir(spark, "new-files")
        filled.repartitionByRange(pieces, "_name").write.parquet(folder)
        stored = spark.read.parquet(folder)
        firsts = stored.groupBy(F.col("_metadata.file_path")).agg(F.min("_name").alias("first"))
        cuts = sorted(row["first"] for row in firsts.collect())[1:]
        filled = stored
    scan = _scan(spark, path, glob)
    parts = [
        new.filter("length = 0").select("path", "length", F.lit(b"").alias("content")),
    ]
    for low, high in zip([None, *cuts], [*cuts, None]):
        piece = filled
        if low is not None:
            piece = piece.filter(F.col("_name") >= low)
        if high is not None:
            piece = piece.filter(F.col("_name") < high)
        oldest = piece.agg(F.min("modified")).first()[0]
        if oldest is None:
            continue
        # Pushed into the scan: files before that time are not opened.
        recent = scan.filter(F.col("modificationTime") >= F.lit(oldest))
        named = recent.withColumn("_name", one_slash(F.col("path")))
        if low is not None:
            named = named.filter(F.col("_name") >= low)
        if high is not None:
            named = named.filter(F.col("_name") < high)
        parts.append(
            named.join(F.broadcast(piece.select("_name")), "_name", "left_semi").select("path", "length", "content")
        )
    return union_all(parts)
