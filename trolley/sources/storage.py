"""CSV and Parquet sources and sinks, and stored fragments."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache, reduce

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_LINE_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("order_number", T.IntegerType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("days_since_prior_order", T.DoubleType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
        T.StructField("department_id", T.IntegerType()),
        T.StructField("department", T.StringType()),
        T.StructField("product_name", T.StringType()),
    ]
)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Give a schema for large files: inferring one reads them twice."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


BUCKET_BYTES = 64 << 20
PART_BYTES = 128 << 20
# Stored bytes per partition of a shuffle. Rows take several times as much in memory.
SHUFFLED_BYTES = 16 << 20


def parts_for(df: DataFrame, part_bytes: int = PART_BYTES, least: int = 1) -> int:
    """How many parts of about ``part_bytes`` the inputs of ``df`` fill, at least ``least``.

    Sizes of joins are not estimated: they multiply up to absurd numbers.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    # Leaves made from local rows or RDDs have no size but the largest number there is.
    size = sum(s for s in sizes if s < 1 << 60)
    return max(least, min(100_000, size // part_bytes + 1))


@contextmanager
def wide_shuffles(*inputs: DataFrame) -> Iterator[None]:
    """Until the end of the block, shuffles have a partition per ``SHUFFLED_BYTES`` of the stored inputs, or more.

    With a fixed number the partitions of a large table outgrow a task's memory and
    are spilled. Adaptive execution puts small partitions together again, so a
    number that is too high costs little. Holds for what runs inside the block.
    """
    conf, key = inputs[0].sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, max(int(before), sum(parts_for(df, SHUFFLED_BYTES) for df in inputs)))
    try:
        yield
    finally:
        conf.set(key, before)


@contextmanager
def wide_shuffles(*inputs: DataFrame) -> Iterator[None]:
    """Until the end of the block, shuffles have a partition per ``SHUFFLED_BYTES`` of the stored inputs, or more.

    With a fixed number the partitions of a large table outgrow a task's memory and
    are spilled. Adaptive execution puts small partitions together again, so a
    number that is too high costs little. Holds for what runs inside the block.
    """
    conf, key = inputs[0].sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, max(int(before), sum(parts_for(df, SHUFFLED_BYTES) for df in inputs)))
    try:
        yield
    finally:
        conf.set(key, before)


def save_bucketed(df: DataFrame, path: str, column: str, buckets: int | None = None) -> DataFrame:
    """Store ``df`` at ``path`` in sorted buckets of ``column``, one file each, and read it as a table.

    Joins and aggregations on the column then need neither shuffle nor sort. The
    number of buckets follows the size of ``df``, so that they stay alike however
    large it is. The column should have many even values. ``drop_bucketed``
    removes the table from the catalogue.
    """
    spark = df.sparkSession
    buckets = buckets or parts_for(df, BUCKET_BYTES, least=spark.sparkContext.defaultParallelism)
    table = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column).format("parquet")
    writer.option("path", path).saveAsTable(table)
    _bucketed[path] = table
    return spark.table(table)


_bucketed: dict[str, str] = {}


def drop_bucketed(spark: SparkSession, path: str) -> None:
    """Forget the table stored at ``path`` and delete its files."""
    table = _bucketed.pop(path, None)
    if table is not None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    delete(spark, path)


def repartitioned(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` in a fixed number of partitions; by default left to adaptive execution."""
    return df if partitions is None else df.repartition(partitions)


def _root(output_dir: str, frag_type: str) -> str:
    return f"{output_dir.rstrip('/')}/fragments_{frag_type}"


def fragment_path(output_dir: str, frag_type: str, site: str) -> str:
    """Where one site lies: horizontal sites are partitions of one table, vertical ones tables of their own."""
    return f"{_root(output_dir, frag_type)}/{'site=' if frag_type == 'horizontal' else ''}{site}"


def save_horizontal(df: DataFrame, sites: dict[str, list[str]], output_dir: str, column: str = "department") -> None:
    """Cut ``df`` by the values of ``column`` and store it, in one pass and one job, partitioned by site.

    A value that several sites list is stored at each; rows of no site are left out.
    """
    owners = F.array_compact(F.array(*[F.when(F.col(column).isin(values), F.lit(s)) for s, values in sites.items()]))
    _store_sites(df.withColumn("site", F.explode(owners)), output_dir, list(sites))


def save_fragments(fragments: dict[str, DataFrame], output_dir: str, frag_type: str = "horizontal") -> None:
    """Store fragments under ``<output_dir>/fragments_<frag_type>``, and the list of sites last.

    Horizontal fragments go to one table partitioned by site, vertical ones to a
    table per site.
    """
    if frag_type == "horizontal":
        labelled = [part.withColumn("site", F.lit(site)) for site, part in fragments.items()]
        _store_sites(reduce(DataFrame.unionByName, labelled), output_dir, list(fragments))
        return
    spark = next(iter(fragments.values())).sparkSession
    delete(spark, f"{_root(output_dir, frag_type)}_sites")
    for site, fragment in fragments.items():
        save_parquet(fragment, fragment_path(output_dir, frag_type, site))
    _save_list(spark, output_dir, frag_type, list(fragments))


def _store_sites(labelled: DataFrame, output_dir: str, sites: list[str]) -> None:
    spark = labelled.sparkSession
    delete(spark, f"{_root(output_dir, 'horizontal')}_sites")
    labelled.write.mode("overwrite").partitionBy("site").parquet(_root(output_dir, "horizontal"))
    _save_list(spark, output_dir, "horizontal", sites)


def _save_list(spark: SparkSession, output_dir: str, frag_type: str, sites: list[str]) -> None:
    listed = spark.createDataFrame([(site,) for site in sites], "site string")
    save_parquet(listed.coalesce(1), f"{_root(output_dir, frag_type)}_sites")


def stored_sites(spark: SparkSession, output_dir: str, frag_type: str = "horizontal") -> set[str]:
    """Sites whose storing came to its end; none while it is going on or after it broke off."""
    listed = f"{_root(output_dir, frag_type)}_sites"
    return {row["site"] for row in load_parquet(spark, listed).collect()} if is_complete(spark, listed) else set()


def load_fragments(
    spark: SparkSession,
    output_dir: str,
    frag_type: str = "horizontal",
    site_names: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Read stored fragments, in the order of ``site_names`` or of the sites' names.

    A site that is asked for and not completely stored is an error.
    """
    stored = stored_sites(spark, output_dir, frag_type)
    wanted = sorted(stored) if site_names is None else site_names
    missing = [site for site in wanted if site not in stored]
    if missing:
        raise ValueError(f"not stored in {_root(output_dir, frag_type)}: {missing}")
    if frag_type != "horizontal":
        return {site: load_parquet(spark, fragment_path(output_dir, frag_type, site)) for site in wanted}
    whole = load_parquet(spark, _root(output_dir, frag_type)) if wanted else None
    return {site: whole.filter(F.col("site") == site).drop("site") for site in wanted}


def new_shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that all executors can reach.

    It lies in the folder that ``spark.checkpoint.dir`` names. Where that is
    unset and all tasks run on this machine, a temporary folder stands in for it;
    on a cluster that would lose rows, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    """Stands in for the shared folder of a cluster; removed when the process ends."""
    root = tempfile.mkdtemp(prefix="trolley-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def settled(df: DataFrame, label: str, spread_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Ends its lineage: what follows reads the stored table, however often it
    is used and whichever executors are lost. ``spread_by`` names a column with
    many values; the table is then stored in three parts per core or more, as
    its size demands, for work that is heavy per row.
    """
    if spread_by is not None:
        least = 3 * df.sparkSession.sparkContext.defaultParallelism
        df = df.repartition(parts_for(df, least=least), spread_by)
    path = new_shared_folder(df.sparkSession, label)
    save_parquet(df, path)
    return load_parquet(df.sparkSession, path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``settled`` has stored and nothing will read again.

    Without this they lie in the shared folder until it is cleared.
    """
    for table in tables:
        files = table.inputFiles()
        if files:
            delete(table.sparkSession, files[0].rsplit("/", 1)[0])


def part_files(table: DataFrame) -> list[str]:
    """The files of a table that ``settled`` has stored, in the order of the partitions that wrote them.

    A partition without rows has no file.
    """
    return sorted(table.inputFiles(), key=lambda file: (len(file), file))


def read_part(file: str, *columns: str, rows: int = 16) -> Iterator[pa.RecordBatch]:
    """The rows of one of ``part_files`` in the order in which they were written, some at a time. For use in tasks.

    What many tasks need whole is written once and read by each of them, where a shuffle
    would write it once for each.
    """
    system, at = fs.FileSystem.from_uri(re.sub("^file:/(?=[^/])", "file:///", file))
    with system.open_input_file(at) as opened:
        yield from parquet.ParquetFile(opened).iter_batches(rows, columns=list(columns))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table lies at ``path`` whose writing came to its end."""
    system, at = _file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _file_system(spark, path)
    system.delete(at, True)


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of every file at or below ``path``, in order."""
    system, at = _file_system(spark, path)
    found, listed = [], system.listFiles(at, True)
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at
