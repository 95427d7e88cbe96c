"""Markers: small numbered or named files that are created once and never replaced.

They are all that writers of a table share.  Creating one is a rename that refuses to replace: atomic on HDFS and local disks;
an object store needs a committer with the same promise.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Markers:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _mark(self, name: str, content: dict) -> bool:
        """Create a marker, whole or not at all; False if it exists."""
        path, files = self._files()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        place, draft = path(f"{self.root}/{name}"), path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        files.mkdirs(place.getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf())
        plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, place, plain)  # refuses to replace
        except Exception:
            if not files.exists(place):
                raise
            files.delete(draft, False)
            return False
        return True

    def _numbers(self, folder: str) -> list[int]:
        path, files = self._files()
        place = path(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _marker(self, name: str) -> dict:
        path, files = self._files()
        stream = files.open(path(f"{self.root}/{name}"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _markers(self, folder: str, above: int = -1) -> dict[int, dict]:
        """Contents of a folder's markers by number: one file per commit since the last snapshot."""
        return {n: self._marker(f"{folder}/{n}") for n in self._numbers(folder) if n > above}
