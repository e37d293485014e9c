"""File-level statistics and table maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per data file: record count, NULL count, lower and upper bound per column, size.

    Uses the hidden ``_metadata`` column of file sources, so only the named
    columns are read.
    """
    aggs = [F.count(F.lit(1)).alias("record_count"), F.first("_metadata.file_size").alias("file_size_in_bytes")]
    for c in cols:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_null_count"),
                 F.min(c).alias(f"{c}_lower"), F.max(c).alias(f"{c}_upper")]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*aggs)


def expire_snapshots(table, older_than=None, retain_last: int = 1, execute: bool = False) -> DataFrame:
    """Plan (and on request carry out) the expiry of old snapshots.

    Kept: the newest ``retain_last`` ancestors of the current snapshot, and
    every snapshot committed at or after ``older_than``. Everything else goes —
    staged snapshots that were never published included, since they are no
    ancestors. With ``execute`` the expiry is committed and the data
    directories that no kept snapshot lists are deleted.
    Returns ``snapshot_id, committed_at, operation`` of the expired snapshots.
    """
    import datetime as dt

    base = table.state()
    snaps = table.snapshots_meta()
    keep = set(table.current_ancestors(base)[:max(1, retain_last)])
    if older_than is not None:
        keep |= {s["snapshot_id"] for s in snaps if dt.datetime.fromisoformat(s["committed_at"]) >= older_than}
    gone = [s for s in snaps if s["snapshot_id"] not in keep]
    if execute and gone:
        kept_dirs = {d["dir"] for s in snaps if s["snapshot_id"] in keep for d in s["dirs"]}
        dead_dirs = {d["dir"] for s in gone for d in s["dirs"]} - kept_dirs
        expired = sorted(set(base.get("expired", [])) | {s["snapshot_id"] for s in gone})
        table._commit_state("expire-snapshots", base, expired=expired)
        delete_paths(table, [f"{table.data}/_dir={d}" for d in sorted(dead_dirs)])
        # partitions every remaining snapshot excludes are unreachable as well
        delete_paths(table, [f"{table.data}/_dir={d}/{part}" for d, part in table.dead_partitions()])
    rows = [(s["snapshot_id"], dt.datetime.fromisoformat(s["committed_at"]), s["operation"]) for s in gone]
    return table.spark.createDataFrame(rows, "snapshot_id bigint, committed_at timestamp_ntz, operation string")


#: Files younger than this may belong to a writer that has not committed yet.
WRITER_MS = 3 * 24 * 3_600_000


def orphan_files(table, older_than_ms: int | None = None, min_age_ms: int = WRITER_MS) -> DataFrame:
    """Data files under the table that no live snapshot references (dry run).

    The listing is a distributed ``binaryFile`` scan that reads paths, sizes and
    times only; referenced directories (metadata, one row per directory) are
    removed with a ``left_anti`` join. Files younger than ``min_age_ms``, which a running writer may
    still be committing, are left out, unless ``older_than_ms`` names another moment.
    """
    import time

    spark = table.spark
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table.data)
             .select("path", "length", "modificationTime"))
    files = (files.withColumn("dir", F.regexp_extract("path", r"/_dir=([^/]+)/", 1))
             .withColumn("part", F.regexp_extract("path", r"/_dir=[^/]+/(.+)/[^/]+$", 1)))
    live = sorted({d["dir"] for s in table.snapshots_meta() for d in s["dirs"]})
    live_df = spark.createDataFrame([(d,) for d in live], "dir string")  # one row per directory
    dead = spark.createDataFrame(table.dead_partitions(), "dir string, part string")  # per excluded partition
    unreferenced = files.join(live_df, "dir", "left_anti")
    excluded = files.join(dead, ["dir", "part"], "left_semi")
    orphans = unreferenced.unionByName(excluded)
    if older_than_ms is None:
        older_than_ms = int(time.time() * 1000) - min_age_ms + (0 if min_age_ms else 60_000)
    orphans = orphans.where(F.col("modificationTime") < F.timestamp_millis(F.lit(older_than_ms)))
    return orphans.select("path", "length", "modificationTime")


# Concurrent file-system deletions issued by the driver (I/O bound metadata calls).
DELETE_THREADS = 16


def delete_paths(table, paths, recursive: bool = True, batch: int = 1000) -> int:
    """Delete ``paths`` with a bounded thread pool, ``batch`` at a time."""
    from concurrent.futures import ThreadPoolExecutor
    from itertools import islice

    n = 0
    it = iter(paths)
    with ThreadPoolExecutor(max_workers=DELETE_THREADS) as pool:
        while chunk := list(islice(it, batch)):
            list(pool.map(lambda p: table.fs.delete(p, recursive), chunk))
            n += len(chunk)
    return n


def remove_orphans(table, orphans: DataFrame) -> int:
    """Delete the listed orphan files (streamed to the driver, never collected whole)."""
    return delete_paths(table, (r["path"] for r in orphans.select("path").toLocalIterator()), recursive=False)
