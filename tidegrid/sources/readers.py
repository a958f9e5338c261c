"""Loading drifting files: harmonise names and types, union by name, reduce wide feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeedSpec:
    """Columns a feed stores with drifting width, by the type they are settled on."""

    integers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()

    def target(self, name: str) -> str | None:
        for group, kind in (
            (self.integers, "int"),
            (self.doubles, "double"),
            (self.dates, "date"),
        ):
            if name in group:
                return kind
        return None


def harmonise(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Lower-case every name and cast the declared columns that are present.

    Absent columns stay absent, so a genuine gap is visible to the union that follows.
    """
    projected = []
    for field in df.columns:
        name = field.lower()
        column = F.col(f"`{field}`")
        kind = spec.target(name)
        projected.append((column.cast(kind) if kind else column).alias(name))
    return df.select(*projected)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing from any frame is an error."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(DataFrame.unionByName, frames)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted files under a glob or folder, by Spark's own listing on any file system."""
    files = spark.read.format("binaryFile").load(pattern).select("path").orderBy("path")
    return [row["path"] for row in files.toLocalIterator()]


def load_union(spark: SparkSession, paths: str | Sequence[str], spec: FeedSpec) -> DataFrame:
    """Load every Parquet file of a feed and settle them on one schema.

    ``paths`` is a glob, or a list of files or folders that are each of one schema (a month
    folder, say). Paths whose raw schemas agree are read in one scan, so the plan holds one
    branch per distinct schema rather than one per file.
    """
    if isinstance(paths, str):
        try:
            found = list_files(spark, paths)
        except AnalysisException as missing:
            raise FileNotFoundError(f"no files matched {paths}") from missing
    else:
        found = sorted(paths)
    if not found:
        raise FileNotFoundError(f"no files matched {paths}")
    by_schema: dict[str, list[str]] = {}
    for path in found:
        by_schema.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return union_frames(
        [harmonise(spark.read.parquet(*group), spec) for group in by_schema.values()]
    )


def read_parquet(spark: SparkSession, *paths: str, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Read one or many Parquet paths, casting key columns on the way in."""
    df = spark.read.parquet(*paths)
    if not casts:
        return df
    return df.select(
        *[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    )


def read_dim_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    rename: Mapping[str, str] | None = None,
    relabel: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Read a dimension from CSV, keeping ``N/A`` as a value, then rename and relabel."""
    df = spark.read.csv(path, header=True, schema=schema)
    df = df.withColumnsRenamed(dict(rename or {}))
    for column, mapping in (relabel or {}).items():
        df = df.replace(dict(mapping), subset=[column])
    return df


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few constant rows (holidays, code lists) as a frame of known size."""
    return spark.createDataFrame(list(rows), schema)


def reduce_feed(df: DataFrame, columns: Sequence[str], keep: Column) -> DataFrame:
    """Project a wide feed to the columns in use and keep the rows in scope."""
    return df.where(keep).select(*columns)


def retention_report(df: DataFrame, keep: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows read, rows kept and the percentage kept, in one pass over the wide feed."""
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(
        F.count("*").alias("rows_read"), F.count(F.when(keep, 1)).alias("rows_kept")
    ).select(
        *by,
        "rows_read",
        "rows_kept",
        F.when(
            F.col("rows_read") > 0, 100.0 * F.col("rows_kept") / F.col("rows_read")
        ).alias("pct_kept"),
    )


def stable_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """A sample decided by each row's key, so it does not move with the file layout.

    The key is hashed with the seed and compared with the fraction of the hash range; the
    md5 form gives the same rows in any engine.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    position = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.where(position < F.lit(int(fraction * 2**32)))
