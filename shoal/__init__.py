"""shoal — data-engineering operators as Spark DataFrame jobs.

Every operator is a function from DataFrame(s) to DataFrame built from
``pyspark.sql.functions`` so that Catalyst prunes, pushes down and plans the
shuffles. Sub-packages:

* ``sources``   — landing readers (CSV, JSON, Parquet, text, tables, JDBC)
* ``sinks``     — writers (files, tables, by-name inserts, JDBC)
* ``functions`` — column-level helpers (safe ratio, clock parsing, JSON paths)
* ``operators`` — statistics, joins, dedup, audits, keys, normalisation
* ``tables``    — versioned copy-on-write Parquet tables and their maintenance
* ``plans``     — the registered queries over the driver tables
* ``streaming`` — incremental (trigger-once) landing loads
"""

from shoal.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
