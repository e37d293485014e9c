"""Versioned copy-on-write Parquet tables, write-audit-publish and maintenance."""
