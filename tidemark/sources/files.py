"""Small files and folders through the file system that Spark uses, so that all machines see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's name below spark.checkpoint.dir. Where that is unset, below a folder of
    this machine on a local master, and an error elsewhere."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/').removeprefix('file://')}/{label}-{uuid.uuid4().hex}"


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._gateway, self._conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()

    def _at(self, path: str) -> tuple:
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def read(self, path: str) -> str | None:
        place, fs = self._at(path)
        if not fs.exists(place):
            return None
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The file appears whole: it is written beside and moved into place."""
        beside, fs = self._at(f"{path}.tmp")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        place = fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(path))
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf).rename(fs.makeQualified(beside), place, options)

    def names(self, path: str) -> list[str]:
        place, fs = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(place)) if fs.exists(place) else []

    def delete(self, path: str) -> None:
        place, fs = self._at(path)
        fs.delete(place, True)
