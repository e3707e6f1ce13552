"""Folders on any file system Spark reaches: listing, renaming, small texts."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder and the names in it; paths are resolved by the Hadoop file system that owns them."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, of: str = "") -> list[str]:
        """Names in the folder, or in one below it; none if there is no such folder."""
        if not self._fs.exists(self._at(of)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(of)))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        """Renames; fails if the new name is taken. One step on file systems that can."""
        none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self._jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
        options[0] = none
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._at(name), self._at(to), options)

    def write_text(self, name: str, text: str) -> bool:
        """A new text file, seen whole or not at all; False if there is one of that name."""
        draft = f"_staging/{name.replace('/', '-')}-{self._jvm.java.util.UUID.randomUUID().toString()}"
        out = self._fs.create(self._at(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.mkdirs(self._at(name).getParent())
        try:
            self.move(draft, name)
        except Py4JJavaError as error:
            self.delete(draft)
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        return True

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
