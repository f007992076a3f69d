"""The store of a path, through the session's Hadoop file systems (driver side).

Any URI that Spark reads works here too (``hdfs``, ``s3a``, ``abfs``, ``file``
and so on).  Paths are literal names: nothing is decoded.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, uri: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(uri).getFileSystem(spark._jsc.hadoopConfiguration())

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_dirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names directly below ``path``; none if it does not exist."""
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def rename(self, old: str, new: str) -> None:
        parent = new.rstrip("/").rsplit("/", 1)[0]
        if not self.exists(parent):
            self.make_dirs(parent)
        if self.exists(new) or not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        """Remove a file or a whole folder; nothing happens if it does not exist."""
        if self.exists(path) and not self._fs.delete(self._path(path), True):
            raise OSError(f"cannot delete {path}")

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()


class Swap:
    """Puts staged folders in the place of live ones, and back again on any error.

    The old folders are kept below ``backup`` until ``finish``, which first
    returns files that were not there when the work began (``known``: folder
    to file names): whoever appended them meanwhile loses nothing.
    """

    def __init__(self, store: Store, backup: str):
        self._store, self._backup = store, backup.rstrip("/")
        self._done: list[tuple[str | None, str, str | None]] = []

    def put(self, live: str, staged: str | None) -> None:
        """``staged`` takes the place of ``live``; either may be missing."""
        kept = f"{self._backup}/{len(self._done)}" if self._store.exists(live) else None
        if kept:
            self._store.rename(live, kept)
        self._done.append((kept, live, None))
        if staged:
            self._store.rename(staged, live)
            self._done[-1] = (kept, live, staged)

    def undo(self) -> None:
        for kept, live, staged in reversed(self._done):
            if staged:
                self._store.rename(live, staged)
            if kept:
                self._store.rename(kept, live)
        self._done = []

    def finish(self, known: dict[str, set[str]] | None) -> None:
        """Drop the old folders; with ``known`` None there are only single files among them."""
        for kept, live, _ in self._done:
            late = [] if kept is None or known is None else [n for n in self._store.names(kept) if n not in known.get(live, set()) and n[0] not in "._"]
            for name in late:
                self._store.rename(f"{kept}/{name}", f"{live}/{name}")
        self._store.delete(self._backup)
