"""Files and folders through the driver's Hadoop file system: any store that Spark itself can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Existence, listing, renaming, deleting and small texts; on Spark Connect there is no such access, which is an error."""

    def __init__(self, spark: SparkSession):
        try:
            self._jvm = spark.sparkContext._jvm
            self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        except Exception as exc:  # noqa: BLE001 - Spark Connect has no SparkContext
            raise RuntimeError("this needs the file system of the driver's JVM, which Spark Connect does not give") from exc

    def _at(self, path: str):
        jpath = self._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self._conf), jpath

    def store(self, path: str) -> str:
        """The file system a path is on; folders move only within one."""
        return self._at(path)[0].getUri().toString()

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def names(self, path: str) -> list[str]:
        """What a folder holds (nothing where it is missing)."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        if fs.exists(p) and not fs.delete(p, True):
            raise OSError(f"cannot delete {path}")

    def move(self, source: str, target: str) -> None:
        """Put ``source`` in the place of ``target``."""
        self.delete(target)
        fs, p = self._at(source)
        to = self._at(target)[1]
        fs.mkdirs(to.getParent())
        if not fs.rename(p, to):
            raise OSError(f"cannot move {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """All of ``text`` or nothing: written beside, then renamed."""
        fs, p = self._at(path + ".part")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(path + ".part", path)

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
