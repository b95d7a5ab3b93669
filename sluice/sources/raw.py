"""Landing-zone reads: dated CSV snapshots and the landing inventory."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.clock import instant
from sluice.model import BUSINESS_DATE, CORRUPT, ENTITIES

# Fixed value: dataset and date in a landing path.
LANDED_FILE = r"([^/]+)/odate=(\d{4}-\d{2}-\d{2})/[^/]+$"


def partition_path(root: str, dataset: str, odate: date) -> str:
    return f"{root.rstrip('/')}/{dataset}/odate={odate.isoformat()}"


def read_raw_csv(
    spark: SparkSession,
    root: str,
    dataset: str,
    odate: date,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """One dataset of one date, all columns as text, plus lineage columns.

    Only that date's directory is listed. Lines that do not fit the schema keep
    their text in ``_corrupt_record``.
    """
    lines = (
        spark.read.schema(ENTITIES[dataset].raw_ddl)
        .options(
            header=True,
            encoding="UTF-8",
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
            pathGlobFilter="*.csv",
        )
        .csv(partition_path(root, dataset, odate))
    )
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        instant(as_of).alias("_ingested_at"),
        F.lit(odate).cast("date").alias(BUSINESS_DATE),
    )


def landed_from_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    """Distinct (dataset, odate) pairs named by a column of file paths."""
    found = paths.select(
        F.regexp_extract(path, LANDED_FILE, 1).alias("dataset"),
        F.regexp_extract(path, LANDED_FILE, 2).try_cast("date").alias("odate"),
    )
    return found.where(F.col("odate").isNotNull()).distinct()


def list_landed(spark: SparkSession, root: str, odate: date | None = None) -> DataFrame:
    """Landed (dataset, odate) pairs; file contents are never read.

    With ``odate`` only the folders of that date are listed, not the history.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    if odate is None:
        return landed_from_paths(files.option("recursiveFileLookup", True).load(root).select("path"))
    try:
        found = files.load(f"{root.rstrip('/')}/*/odate={odate.isoformat()}/").select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string")
    return landed_from_paths(found)


def expected_landings(dates: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Every dataset for every ``odate`` of ``dates`` (by generating per date)."""
    wanted = F.array(*(F.lit(name) for name in datasets))
    return dates.select("odate").distinct().select(F.explode(wanted).alias("dataset"), "odate")


def missing_landings(expected: DataFrame, landed: DataFrame, root: str) -> DataFrame:
    """Expected files that did not land, each with the path it should have."""
    missing = expected.join(landed, on=["dataset", "odate"], how="left_anti")
    path = F.concat(
        F.lit(root.rstrip("/") + "/"),
        F.col("dataset"),
        F.lit("/odate="),
        F.col("odate").cast("string"),
        F.lit("/"),
        F.col("dataset"),
        F.lit(".csv"),
    )
    return missing.select("dataset", "odate", path.alias("expected_path"))


def require_landed(spark: SparkSession, root: str, odate: date) -> None:
    """Fail with the expected path of every dataset that has no file for ``odate``."""
    day = spark.range(1).select(F.lit(odate).cast("date").alias("odate"))
    missing = missing_landings(
        expected_landings(day, list(ENTITIES)), list_landed(spark, root, odate), root
    )
    # At most one row per entity.
    paths = sorted(row["expected_path"] for row in missing.collect())
    if paths:
        raise FileNotFoundError("missing expected raw files: " + ", ".join(paths))
