"""Write-audit-publish over versioned tables.

With the table property ``write.wap.enabled=true`` and ``spark.wap.id`` set in
the session, writes create snapshots that are *not* current: readers keep
seeing the published rows. The audit reads the staged snapshot by time travel
and compares value sets both ways; publishing makes it current.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from shoal.operators.relational import AuditError, raise_if_different, set_audit  # noqa: F401
from shoal.tables.versioned import VersionedTable


@contextlib.contextmanager
def wap_session(table: VersionedTable, wap_id: str) -> Iterator[str]:
    """Stage every write to ``table`` inside the block under ``wap_id``."""
    spark = table.spark
    if table.state().get("properties", {}).get("write.wap.enabled") != "true":
        table.set_properties(**{"write.wap.enabled": "true"})
    old = spark.conf.get("spark.wap.id", None)
    spark.conf.set("spark.wap.id", wap_id)
    try:
        yield wap_id
    finally:
        if old is None:
            spark.conf.unset("spark.wap.id")
        else:
            spark.conf.set("spark.wap.id", old)


def staged_rows(table: VersionedTable, wap_id: str) -> DataFrame:
    return table.scan(snapshot_id=table.staged_snapshot(wap_id))


def audit_value_set(table: VersionedTable, wap_id: str, col: str, expected: Iterable[str]) -> DataFrame:
    """Differences between the staged snapshot's distinct ``col`` values and ``expected``."""
    return set_audit(staged_rows(table, wap_id), col, expected)


def audit_and_publish(table: VersionedTable, wap_id: str, col: str, expected: Iterable[str]) -> int:
    """Raise :class:`AuditError` with the differing values, else publish."""
    raise_if_different(audit_value_set(table, wap_id, col, list(expected)), "audit failed")
    return table.cherry_pick(table.staged_snapshot(wap_id))
