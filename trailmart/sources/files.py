"""Files of any file system Spark can reach: the small steps around what Spark itself reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    """Paths below ``root``, through Hadoop's file system of that root."""

    def __init__(self, spark: SparkSession, root: object) -> None:
        self.spark, self.root = spark, str(root).rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def _path(self, name: str):
        return self.hadoop.Path(self.at(name))

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def make(self, name: str) -> None:
        self.fs.mkdirs(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def rename(self, old: str, new: str, overwrite: bool = False) -> None:
        """Move a file or folder in one step; an existing target is refused, or replaced if ``overwrite``."""
        options = self.spark._sc._gateway.new_array(self.hadoop.Options.Rename, 1)
        options[0] = self.hadoop.Options.Rename.OVERWRITE if overwrite else getattr(self.hadoop.Options.Rename, "NONE")
        root = self.fs.makeQualified(self._path(""))
        self.hadoop.FileContext.getFileContext(root.toUri(), self.conf).rename(self.fs.makeQualified(self._path(old)), self.fs.makeQualified(self._path(new)), options)

    def write_text(self, name: str, text: str) -> None:
        """Write beside and rename, so that readers see the old or the new text."""
        out = self.fs.create(self._path(name + ".tmp"), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        self.rename(name + ".tmp", name, overwrite=True)

    def read_bytes(self, name: str) -> bytes:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_text(self, name: str) -> str:
        return self.read_bytes(name).decode("utf-8-sig")

    def names(self, folder: str = "") -> list[str]:
        """All files below a folder, relative to the root, hidden ones left out."""
        found, walk = [], self.fs.listFiles(self._path(folder), True)
        root = self.fs.makeQualified(self._path("")).toUri().getPath()
        while walk.hasNext():
            name = walk.next().getPath().toUri().getPath()[len(root) :].lstrip("/")
            if not any(part.startswith((".", "_")) for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def digests(self, folder: str = "", pattern: str = "*.parquet") -> dict[str, str]:
        """SHA-256 of each file below a folder, computed where the executors read them; one row per file comes back."""
        if not any(n.endswith(pattern.lstrip("*")) for n in self.names(folder)):
            return {}
        rows: DataFrame = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(self.at(folder))
        mark = self.fs.makeQualified(self._path("")).toUri().getPath().rstrip("/") + "/"
        return dict(sorted((p.split(mark, 1)[1], d) for p, d in rows.select("path", F.sha2("content", 256)).collect()))
