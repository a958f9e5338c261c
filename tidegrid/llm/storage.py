"""Tables written to the folder that the cluster shares, and read back, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


LOCAL_FOLDERS: dict[str, str] = {}
WRITTEN: dict[str, int] = {}
#: Tables staged between two collections of the driver's garbage.
TIDY_EVERY = 4
SLOTS = 1 << 23


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset on a local master, a folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    app = spark.sparkContext.applicationId
    if app not in LOCAL_FOLDERS:
        LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tidegrid-llm-")
    return LOCAL_FOLDERS[app]


def tidy(spark: SparkSession, every: int = TIDY_EVERY) -> None:
    """Now and then let the driver collect its garbage.

    Spark frees the broadcasts and shuffle files of a finished query when the driver's JVM collects
    the query's plan. Jobs of many small queries fill the heap with plans long before that happens.
    """
    app = spark.sparkContext.applicationId
    WRITTEN[app] = WRITTEN.get(app, 0) + 1
    if WRITTEN[app] % every == 0:
        spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame) -> DataFrame:
    """Write the frame as Parquet in the shared folder and read it again: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tidy(spark)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, column: str) -> DataFrame:
    """Like ``staged``, in buckets of one column: later joins on it move the other side only."""
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(name, format="parquet")
    return spark.table(name)


def slot_of(column: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(slots))


def slots_of(df: DataFrame, column: str) -> DataFrame:
    """``bucket, bits``: a bit for each slot of ``SLOTS`` that a value falls in, one MB in all at most.

    It only thins what a later exact join sees; when it is full, nothing is thinned and nothing lost.
    """
    slot = slot_of(F.col(column), SLOTS)
    return staged(df.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")))


def in_slots(df: DataFrame, column: str, slots: DataFrame) -> DataFrame:
    """The rows whose value falls in a taken slot, and by chance a few more."""
    slot = slot_of(F.col(column), SLOTS)
    place = F.bitmap_bit_position(slot)
    bucket, bits = spare("bucket", df.columns), spare("bits", df.columns)
    byte = F.conv(F.hex(F.substring(F.col(bits), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    taken = F.getbit(byte, (place % 8).cast("int")) == 1
    marked = df.join(F.broadcast(slots.toDF(bucket, bits)), F.bitmap_bucket_number(slot) == F.col(bucket))
    return marked.where(taken).select(df.columns)


def spare(name: str, taken: list[str]) -> str:
    """A column name that no column has yet, whatever its case."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in an Arrow batch than Spark's default, since rows here hold whole texts or sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))
