"""File operations on whatever file system Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The few file operations that Spark's own readers and writers do not offer."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        conf = spark._jsc.hadoopConfiguration()
        path = self._fs.Path(root)
        self.system = path.getFileSystem(conf)
        self.context = self._fs.FileContext.getFileContext(self.system.getUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(self._fs.Options.Rename, 0)

    def path(self, name: str):
        return self._fs.Path(name)

    def children(self, folder: str) -> dict[str, int]:
        """Name and time of the last change, in milliseconds."""
        at = self.path(folder)
        if not self.system.exists(at):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.system.listStatus(at)}

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """False if ``name`` exists; else it has the whole text as soon as it is seen."""
        folder, _, last = name.rpartition("/")
        draft = self.path(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self.context.rename(draft, self.path(name), self._no_options)
            return True
        except Exception as e:  # py4j wraps what Java raises
            self.system.delete(draft, False)
            if "FileAlreadyExistsException" in str(e):
                return False
            raise

    def delete(self, folder: str) -> None:
        self.system.delete(self.path(folder), True)
