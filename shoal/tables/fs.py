"""Small file-system helper over the Hadoop FileSystem of the session.

Works for every URI scheme Spark is configured for (local, ``hdfs://``,
``s3a://``, ``abfss://``). Only metadata goes through here — table data is
always read and written by Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """A metadata file that must be new already exists (a concurrent commit)."""


class HadoopFS:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self.fs = self._Path(root).getFileSystem(self._conf)

    def path(self, p: str):
        return self._Path(p)

    def qualify(self, p: str) -> str:
        return self.fs.makeQualified(self._Path(p)).toString()

    def exists(self, p: str) -> bool:
        return bool(self.fs.exists(self._Path(p)))

    def mkdirs(self, p: str) -> None:
        self.fs.mkdirs(self._Path(p))

    def write_new(self, p: str, text: str) -> None:
        """Create ``p`` with ``text``; fail if it exists (atomic on HDFS and local FS)."""
        try:
            out = self.fs.create(self._Path(p), False)
        except Exception as e:  # py4j wraps FileAlreadyExistsException
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                raise CommitConflict(p) from None
            raise
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read(self, p: str) -> str:
        stream = self.fs.open(self._Path(p))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def list(self, p: str) -> list[tuple[str, bool, int, int]]:
        """Direct children: ``(name, is_dir, size, modification_ms)``; empty if absent."""
        if not self.exists(p):
            return []
        return [(s.getPath().getName(), bool(s.isDirectory()), int(s.getLen()), int(s.getModificationTime()))
                for s in self.fs.listStatus(self._Path(p))]

    def size(self, p: str) -> int:
        """Bytes below ``p`` (a summary from the file system, no data read)."""
        return int(self.fs.getContentSummary(self._Path(p)).getLength())

    def delete(self, p: str, recursive: bool = True) -> bool:
        return bool(self.fs.delete(self._Path(p), recursive))
