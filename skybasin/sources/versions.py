"""Folders that are replaced as a whole: a new folder, then a pointer that moves last.

Version ``n`` is what the file ``_version-n`` names, one line; the highest number counts.  A pointer is
written beside and renamed where no file may be yet, so of two writers that saw the same version
one publishes the next and the other is told to start over.  Until then readers see the version before,
and what a broken writer leaves behind is never read.  There is no list of files and no history:
folders and pointers more than ``KEPT`` versions old go.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import SparkSession

KEPT = 3
_POINTER = "_version-"


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @cached_property
    def _hadoop(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs

    def _path(self, name: str = ""):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        files = self._files()
        if not files.exists(self._path()):
            return []
        found = files.globStatus(self._path(f"{_POINTER}[0-9]*"))
        return sorted(int(x.getPath().getName()[len(_POINTER) :]) for x in found)

    def current(self) -> tuple[int, str | None]:
        """The number of the version that counts and its folder; 0 and none before the first."""
        numbers = self.numbers()
        if not numbers:
            return 0, None
        stream = self._files().open(self._path(f"{_POINTER}{numbers[-1]}"))
        try:
            name = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()
        return numbers[-1], f"{self.root}/{name}"

    def folder(self, number: int) -> str:
        """A new folder for what may become version ``number``."""
        return f"{self.root}/v{number}-{uuid.uuid4().hex}"

    def publish(self, number: int, folder: str) -> bool:
        """Make ``folder`` version ``number``; false if there is such a version by now."""
        files, name = self._files(), f"{_POINTER}{number}"
        draft = self._path(f"_draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(folder.rsplit("/", 1)[-1] + "\n", "utf-8"))
        out.close()
        jvm = self.spark.sparkContext._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path().toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        try:
            context.rename(draft, self._path(name), options)
        except Exception:
            # Whatever the file system calls it: the version is there, or the error is another one.
            files.delete(draft, False)
            if not files.exists(self._path(name)):
                raise
            return False
        self._tidy(number - KEPT)
        return True

    def discard(self, folder: str) -> None:
        """Remove a folder that did not become a version."""
        self._files().delete(self._hadoop.Path(folder), True)

    def _tidy(self, last: int) -> None:
        files = self._files()
        for number in (n for n in self.numbers() if n <= last):
            for old in files.globStatus(self._path(f"v{number}-*")):
                files.delete(old.getPath(), True)
            files.delete(self._path(f"{_POINTER}{number}"), False)
