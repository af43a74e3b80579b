"""Lake I/O: read and write layer tables, with row counts observed during the write.

Tables are Parquet by default; ``fmt`` is a parameter so a transactional format can
be used where its package is on the classpath. Partitioned writes use a
``rebalance`` hint so adaptive execution sizes the output files per partition and
splits a partition that is much larger than the others.

A table may be written in buckets of its keys. ``read_bucketed`` tells Spark so, and grouping or
joining by these keys then needs no shuffle; ``read_table`` reads the same files as any others.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A table is written in this many buckets if each holds BUCKET_BYTES of what it is made from, on
# average, and in more where they would hold more than BUCKET_MOST.
BUCKETS = 96
BUCKET_BYTES, BUCKET_MOST = 4 << 20, 128 << 20
# Tasks that write into every bucket, at most; beyond it rows are shuffled to their bucket first.
BUCKET_WRITERS = 128
_MARK = "_buckets"  # a file named _buckets.<number>.<key>... stands in a table written in buckets


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a location."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what stands in a folder, hidden entries left out; [] without it."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    entries = ((st.getPath().getName(), st.isDirectory()) for st in fs.listStatus(folder))
    # Spark reads a folder such as _load_id=1 although its name starts like a hidden one.
    return [(n, is_dir) for n, is_dir in entries if not n.startswith(".") and (not n.startswith("_") or "=" in n)]


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the completed write folders in a folder, in order (those with a success mark)."""
    fs, _ = _folder(spark, path)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    return sorted(n for n, is_dir in _children(spark, path) if is_dir and fs.exists(Path(f"{path}/{n}/_SUCCESS")))


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Put the folder ``path`` in place of ``to``, on the same file system; nothing without it, so it may be repeated."""
    fs, folder = _folder(spark, path)
    if fs.exists(folder):
        _, target = _folder(spark, to)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(folder, target):
            raise OSError(f"{path} could not be moved to {to}")


def _has_data(spark: SparkSession, path: str) -> bool:
    found = _children(spark, path)
    return any(not is_dir for _, is_dir in found) or any(_has_data(spark, f"{path}/{n}") for n, is_dir in found if is_dir)


def try_read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet (a folder listing)."""
    return read_table(spark, path, fmt) if _has_data(spark, path) else None


def partition_values(spark: SparkSession, path: str, column: str) -> set[str]:
    """Values of a table's first partition column that have data, from its folder names."""
    prefix = f"{column}="
    return {
        name[len(prefix) :]
        for name, is_dir in _children(spark, path)
        if is_dir and name.startswith(prefix) and _has_data(spark, f"{path}/{name}")
    }


def _bucketing(spark: SparkSession, path: str) -> tuple[int, list[str]] | None:
    """(number of buckets, keys) of a table written in buckets, from its mark."""
    fs, folder = _folder(spark, path)
    found = [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []
    marks = [n.split(".") for n in found if n.startswith(f"{_MARK}.")]
    return (int(marks[0][1]), marks[0][2:]) if len(marks) == 1 else None


def _bytes_read(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is made from; what Spark knows no size of counts nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 62)


def _in_buckets(df: DataFrame, path: str, keys: Sequence[str], fmt: str, dynamic: bool) -> tuple[DataFrame, int | None]:
    """The rows to write, and the buckets to write them in; None where they lie as they come.

    A table keeps its buckets while only some partitions are replaced. Bucketed tables pass
    through the session's catalog, so a catalog that outlives the session is left alone.
    """
    spark = df.sparkSession
    if not keys or fmt != "parquet" or any("." in k for k in keys) or spark.conf.get("spark.sql.catalogImplementation", "in-memory") != "in-memory":
        return df, None
    size = _bytes_read(df)
    number, few = max(BUCKETS, -(-size // BUCKET_MOST)), size < BUCKETS * BUCKET_BYTES
    if dynamic and _has_data(spark, path):
        found = _bucketing(spark, path)
        if found is None or found[1] != list(keys):
            return df, None
        number = found[0]
    elif few:
        return df, None
    return (df.repartition(number, *keys) if few or number > BUCKET_WRITERS else df), number


def _bucket_sizes(spark: SparkSession, path: str) -> tuple[int, list[str], int] | None:
    """(buckets, keys, bytes of one on average) of a table in buckets of about one size, else None."""
    found = _bucketing(spark, path)
    if found is None:
        return None
    number, keys = found
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    each = files.groupBy(F.regexp_extract("path", r"_(\d{5})\.c\d+[^/]*$", 1).alias("bucket")).agg(F.sum("length").alias("size"))
    sizes = {r["bucket"]: r["size"] for r in each.collect()}  # a row per bucket
    mean = sum(sizes.values()) // number
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    )
    return None if "" in sizes or max(sizes.values(), default=0) > max(limit, 4 * mean) else (number, keys, mean)


def bucket_size(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Bytes of a bucket that a few tasks write on from; 0 without even buckets of these keys."""
    found = _bucket_sizes(spark, path)
    return found[2] if found and found[1] == list(keys) and found[0] <= BUCKET_WRITERS else 0


def read_bucketed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, known to Spark as bucketed if it was written so.

    A bucket is read by one task. Where one is much larger than the others, or a file belongs to
    no bucket, the table is read like any other, and skew is left to the shuffle.
    """
    rows, found = read_table(spark, path, fmt), _bucket_sizes(spark, path)
    if found is None:
        return rows
    number, keys, _ = found
    table, parts = f"terrace_{uuid.uuid4().hex}", partition_columns(spark, path)
    by = ", ".join(f"`{k}`" for k in keys)
    partitioned = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)}) " if parts else ""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({rows.schema.toDDL()}) USING parquet {partitioned}CLUSTERED BY ({by}) INTO {number} BUCKETS LOCATION '{place}'"
    )
    if parts:
        spark.catalog.recoverPartitions(table)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")  # its size, from the folders
    return spark.table(table)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    name: str | None = None,
    observe: dict[str, Column] | None = None,
    dynamic: bool = False,
    spread: bool = True,
    bucket_by: Sequence[str] = (),
) -> dict[str, object]:
    """Write ``df`` and return ``{table, rows, destination, **observe}``.

    The row count (and any ``observe`` aggregates) come from an ``Observation``
    filled by the write itself, so the plan is not run a second time. ``dynamic``
    replaces only the partitions present in ``df`` (a per-write option, so
    concurrent writes never depend on a shared session setting). Without ``spread`` the rows
    are written as they lie, for rows of one partition or rebalanced by the caller. With
    ``bucket_by`` the files are split by a hash of these columns, for ``read_bucketed``.
    """
    spark = df.sparkSession
    df, buckets = _in_buckets(df, path, bucket_by, fmt, dynamic)
    obs = Observation(name or "write")
    extra = [c.alias(k) for k, c in (observe or {}).items()]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)
    if partition_by and spread and not buckets:
        observed = observed.hint("rebalance", *partition_by)
    writer = observed.write.format(fmt).mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        table = f"terrace_{uuid.uuid4().hex}"
        writer.bucketBy(buckets, *bucket_by).option("path", path).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay
        fs, _ = _folder(spark, path)
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{'.'.join([_MARK, str(buckets), *bucket_by])}"), True).close()
    else:
        writer.save(path)
    try:
        metrics = obs.get
        rows = int(metrics.get("rows", 0))
        values = {k: metrics.get(k) for k in (observe or {})}
    except Py4JJavaError:
        # Spark reports no metrics row when the write saw no input partitions; count
        # explicitly on that (cheap, empty) path only.
        rows = df.count()
        values = {k: None for k in (observe or {})}
    if buckets and not rows and not partition_by:
        df.limit(0).write.format(fmt).mode(mode).save(path)  # a bucket without rows has no file to tell the columns
    return {"table": name or path, "rows": rows, "destination": path, **values}


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    name: str | None = None,
    observe: dict[str, Column] | None = None,
    spread: bool = True,
    bucket_by: Sequence[str] = (),
) -> dict[str, object]:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    return write_table(df, path, fmt, "overwrite", partition_by, name, observe, dynamic=True, spread=spread, bucket_by=bucket_by)


def partition_columns(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Hive-style partition columns of a written table, read from its folder names
    (``col=value`` levels). Metadata only: one directory listing per level."""
    cols: list[str] = []
    while True:
        dirs = [name for name, is_dir in _children(spark, path) if is_dir and "=" in name]
        if not dirs:
            return tuple(cols)
        cols.append(dirs[0].split("=", 1)[0])
        path = f"{path}/{dirs[0]}"
