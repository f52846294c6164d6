"""Session helpers the operators share: written intermediate tables and Arrow batch sizing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text in one Arrow batch: some 100 KB documents still make a batch of tens of MB.
ARROW_ROWS = 256
#: And bytes in one: a batch ends with the row that goes beyond.
ARROW_BYTES = 32 << 20

_scratch: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; where it is unset, a temporary one in local mode and an error elsewhere."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that driver and executors share")
    # One machine, as in tests: its own folders are shared.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-"))
    return sc._jsc.sc().getCheckpointDir().get()


def _remove(path: str) -> None:
    session = SparkSession.getActiveSession()
    if session is None or session.sparkContext._jsc is None:
        return
    try:
        hadoop = session._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the JVM is ending; its own shutdown is not to be disturbed
        pass


@atexit.register
def _clean() -> None:
    for path in _scratch:
        _remove(path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage so that a lost executor costs a reread and not a recomputation, and gives
    the planner the real size of the table. The files go when the application ends.
    """
    spark = df.sparkSession
    top = f"{shared_dir(spark).rstrip('/')}/weftline-{spark.sparkContext.applicationId}"
    _scratch.add(top)
    path = f"{top}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a settled table that nothing reads any more."""
    _remove(df._settled_at)


def bounded_sample(rows: DataFrame, size: int, seed: int, name: str, by: str | None = None) -> DataFrame:
    """At most ``size`` of the rows that differ (of each value of ``by``), those of the least 64-bit hashes of all columns.

    A first cut by the share of hashes leaves about twice the size, and equal rows become one, so that
    neither null nor repeated ids bring more; it is written once. The exact cut compares hashes alone.
    """
    spin, group = F.col("spin of it"), F.col("group of it")
    dealt = rows.withColumns({"spin of it": F.xxhash64(*rows.columns, F.lit(seed)), "group of it": F.lit(0).cast("bigint") if by is None else F.xxhash64(by)})
    # One row a group; how many rows differ, within a few percent.
    counts = {r[0]: r[1] for r in dealt.groupBy(group).agg(F.approx_count_distinct(spin)).collect()}
    bounds = {g: below(2 * size, n) for g, n in counts.items() if n > 2 * size}
    for held in bounds, None:
        if bounds:
            cut = F.try_element_at(F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair)), group)
            dealt = dealt.where(cut.isNull() | (spin < cut))
        if held is not None:
            dealt = settle(dealt.dropDuplicates(["spin of it", "group of it"]), name)
            ranked = dealt.groupBy(group).agg(F.try_element_at(F.sort_array(F.collect_list(spin)), F.lit(size + 1)).alias("cut"))
            bounds = {r[0]: r[1] for r in ranked.collect() if r[1] is not None}
    return dealt.drop("spin of it", "group of it")


def below(part: int, whole: int) -> int:
    """The 64-bit number that part of whole (part < whole) of all numbers lie under, exact for any counts."""
    return -(1 << 63) + (part << 64) // whole


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: workers may start anywhere."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="weftline-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Make ready for Python workers: ship the package and bound an Arrow batch in rows and bytes, so that few long texts are held at once.

    Spark reads these settings when a plan runs, so they stay; a caller's own tighter bounds are kept.
    """
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, "-1", str(2**31 - 1), f"{2**31 - 1}b"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
