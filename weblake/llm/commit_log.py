"""A small commit log in the shared folder: each id is published once, all or nothing.

An entry is a file written under a temporary name and renamed into place without
overwriting. Where the file system renames atomically (HDFS and its like, a POSIX file
system), a reader sees a whole entry or none, and of two writers of the same id one learns
that it came second. An object store that copies on rename keeps the first property only if
nobody reads during the copy, and needs a single writer.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._sc = spark._jvm, spark.sparkContext
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _entry(self, entry_id: str):
        return self._path(f"{self.root}/{quote(entry_id, safe='')}.json")

    def ids(self) -> list[str]:
        """Published ids in name order."""
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return sorted(unquote(n[:-5]) for n in names if n.endswith(".json"))

    def __contains__(self, entry_id: str) -> bool:
        return self._fs.exists(self._entry(entry_id))

    def read(self, entry_id: str) -> dict:
        stream = self._fs.open(self._entry(entry_id))
        try:
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return json.loads(reader.readLine())
        finally:
            stream.close()

    def publish(self, entry_id: str, entry: dict) -> bool:
        """Add an entry; False if the id is there already (nothing is changed then)."""
        temporary = self._path(f"{self.root}/_tmp-{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        try:
            out.write(bytearray((json.dumps(entry) + "\n").encode()))
        finally:
            out.close()
        if entry_id in self:
            self._fs.delete(temporary, False)
            return False
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_overwrite = self._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(temporary, self._entry(entry_id), no_overwrite)
        except Exception:
            if entry_id not in self:
                raise
            self._fs.delete(temporary, False)
            return False
        return True
