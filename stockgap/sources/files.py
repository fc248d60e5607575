"""Small file-system steps through Hadoop's client, so that they work on
whatever Spark reads and writes: listings, exclusive creation, joining parts."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``root``; paths are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(self._conf)

    def uri(self, path: str = "") -> str:
        return f"{self.root}/{path}" if path else self.root

    def local(self, path: str = "") -> str | None:
        """The path as this and other machines of the session open it without
        Hadoop's client; None on another file system than files'."""
        full = self._fs.makeQualified(self._path(path)).toUri()
        return full.getPath() if full.getScheme() == "file" else None

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.uri(path))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str = "", folders: bool = False) -> list[str]:
        """Names in a folder in order (none where there is no folder), without
        hidden ones; only those of folders if asked."""
        if not self.exists(path):
            return []
        found = ((s.getPath().getName(), s.isDirectory()) for s in self._fs.listStatus(self._path(path)))
        return sorted(n for n, is_dir in found if n[0] not in "._" and (is_dir or not folders))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> None:
        """Create a file with ``text``; FileExistsError if there is one."""
        try:
            out = self._fs.create(self._path(path), False)
        except Exception as e:
            if self.exists(path):
                raise FileExistsError(self.uri(path)) from e
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def replace(self, source: str, target: str) -> None:
        """Move ``source`` to ``target`` in place of what is there."""
        self.delete(target)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {self.uri(source)} to {self.uri(target)}")

    def join(self, parts: list[str], target: str, head: str = "") -> None:
        """``head`` and the bytes of ``parts``, one after the other, as the new
        file ``target``.  Bytes are copied stream to stream."""
        out = self._fs.create(self._path(target), True)
        try:
            out.write(bytearray(head.encode()))
            for p in parts:
                part = self._fs.open(self._path(p))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                finally:
                    part.close()
        finally:
            out.close()
