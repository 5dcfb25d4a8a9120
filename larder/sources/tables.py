"""Raw tables by name, result tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from larder.operators.checks import Check, CheckFailed, Result, refuse, with_checks

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Short name of each raw input and the table it is read from.
RAW_TABLES = {
    "buyers": "BUYERSERVICE_BUYERS",
    "suppliers": "SUPPLIERSERVICE_SUPPLIERS",
    "supplier_groups": "SUPPLIERSERVICE_SUPPLIERGROUPS",
    "orders": "ORDERSERVICE_ORDERS",
    "documents": "DOCUMENTSERVICE_DOCUMENTS",
    "inventory_counts": "inventoryservice_inventorycounts",
    "contacts": "CATALOGPROD_BUYERSUPPLIERCONTACTS",
    "links": "CATALOGPROD_BUYERSUPPLIERS",
    "events": "MP_MASTER_EVENT_RAW",
    "roles": "BUYER_ROLE_MAPPING",
    "chains": "BUYERSERVICE_CHAINS",
    "categories": "HIGH_LEVEL_CATEGORIES_MAPPING",
}


def read_source(spark: SparkSession, name: str, folder: str | None = None,
                columns: dict[str, str] | None = None) -> DataFrame:
    """A raw input by its short name: Parquet below `folder`, or else a catalog table.

    `columns` maps column names of the source to those the operators read."""
    table = RAW_TABLES[name]
    source = spark.table(table) if folder is None else spark.read.parquet(f"{folder}/{table}")
    return source.withColumnsRenamed(columns or {})


# Names inside a stored table's folder: the file that names the version in force, and the versions.
CURRENT = "_current"
VERSION = "version-"


def _path(spark: SparkSession, path: str):
    """A path as the Hadoop client's object, and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the versions below a stored table, oldest first."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    found = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(target) if s.isDirectory()]
    return [name for _, name in sorted(found) if name.startswith(VERSION)]


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version in force of a stored table; None before the first one."""
    target, fs = _path(spark, f"{path}/{CURRENT}")
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def write_version(df: DataFrame, path: str, checks: Iterable[Check] = ()) -> tuple[DataFrame, str]:
    """Write a new version of the table at `path`, which readers do not see before `publish`: the version read back,
    which ends the lineage, and its name. A failed check of severity error raises CheckFailed and deletes it."""
    version = f"{VERSION}{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    found = with_checks(df, checks, lambda rows: rows.write.parquet(folder))
    try:
        refuse(found)
    except CheckFailed:
        target, fs = _path(df.sparkSession, folder)
        fs.delete(target, True)
        raise
    return df.sparkSession.read.schema(df.schema).parquet(folder), version


def publish(spark: SparkSession, path: str, version: str, kept: int = 1) -> None:
    """Put a written version in force by one rename, and delete versions older than the last `kept` ones in force.

    Readers that have planned on the version before can go on reading it."""
    before = current_version(spark, path)
    fresh, fs = _path(spark, f"{path}/{CURRENT}.{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(version, "utf-8"))
    finally:
        stream.close()
    target, _ = _path(spark, f"{path}/{CURRENT}")
    rename = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)
    names = [name for name in _versions(spark, path) if name not in (version, before)]
    for name in names[:len(names) - kept + 1] if before else names:
        old, _ = _path(spark, f"{path}/{name}")
        fs.delete(old, True)


def write_table(df: DataFrame, path: str, checks: Iterable[Check] = ()) -> DataFrame:
    """Replace the table at `path` and read it back, which ends the lineage.

    The new rows are written beside the old ones and put in force at the end: a write that fails leaves the old table."""
    table, version = write_version(df, path, checks)
    publish(df.sparkSession, path, version)
    return table


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The version in force of a stored table."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table is stored at {path}")
    return spark.read.parquet(f"{path}/{version}")


# Paths written by `staged` in this process, until `drop_staged` deletes them.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else one below the warehouse; never a machine's own
    temporary folder. On a cluster a warehouse of the driver's own file system is refused: each executor would write
    to its own disk."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    _, fs = _path(spark, warehouse)
    if fs.getUri().getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"name a folder that all machines share in {CHECKPOINT_DIR}: {warehouse} is a machine's own")
    return f"{warehouse}/larder-staged"


def staged(df: DataFrame, name: str, checks: Iterable[Check] = (), found: list[Result] | None = None) -> DataFrame:
    """Write an intermediate result once to the shared folder, under a name of its own.

    Unlike cached blocks the files outlive a lost executor, and readers prune their columns. What the checks find is added
    to `found`."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    results = with_checks(df, checks, lambda rows: rows.write.parquet(path))
    if found is not None:
        found += results
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_so_far() -> int:
    """Number of intermediate results written and not deleted yet."""
    return len(_written)


def drop_staged(spark: SparkSession, since: int = 0, keep: Iterable[str] = ()) -> None:
    """Delete what `staged` wrote after the first `since` results, but for the paths in `keep`. Results computed from
    it must be stored before."""
    kept = set(keep)
    for path in _written[since:]:
        if path not in kept:
            target, fs = _path(spark, path)
            fs.delete(target, True)
    _written[since:] = [path for path in _written[since:] if path in kept]


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Intermediate results written inside the block are deleted at its end."""
    before = len(_written)
    try:
        yield
    finally:
        drop_staged(spark, before)


def staged_alone(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of `build`, staged; everything else that it staged is deleted."""
    before = len(_written)
    done = build()
    result = staged(done, name)
    drop_staged(done.sparkSession, before, keep=[_written[-1]])
    return result
