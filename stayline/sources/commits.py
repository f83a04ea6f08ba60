"""Numbered commit files: what several writers agree on and readers take a snapshot of."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class CommitLog:
    """Entries 1, 2, 3, … below one folder, a small JSON file each, never changed or removed.

    A file is written under another name and put in place whole, only if its
    number is still free: of two writers of one number exactly one succeeds.
    Locally a hard link sees to that, elsewhere a rename, which distributed file
    systems refuse when the target exists. An object store without such a rename
    needs one writer at a time.

    Since numbers have no gaps, the newest is found by about two logarithms of
    existence checks, without a listing.
    """

    spark: SparkSession
    root: str

    def _place(self, name: str):
        """(file system, path) of a file of the log."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root, name)
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return system, system.makeQualified(path)

    @staticmethod
    def _local(path) -> str | None:
        """The path on this machine, None if it is of a distributed file system."""
        uri = path.toUri()
        return uri.getPath() if uri.getScheme() == "file" else None

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:012d}.json"

    def _has(self, number: int) -> bool:
        system, path = self._place(self._name(number))
        return system.exists(path)

    def newest(self) -> int:
        """The highest number, 0 for an empty log."""
        above = 1
        while self._has(above):
            above *= 2
        below = above // 2
        while above - below > 1:
            middle = (below + above) // 2
            below, above = (middle, above) if self._has(middle) else (below, middle)
        return below

    def read(self, number: int) -> dict | None:
        """The entry of that number, None if there is none."""
        if number < 1 or not self._has(number):
            return None
        system, path = self._place(self._name(number))
        stream = system.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, number: int, entry: Mapping) -> bool:
        """Commit ``entry`` as ``number``; False if another writer had it first."""
        content = json.dumps(dict(entry)).encode()
        system, path = self._place(self._name(number))
        _, draft = self._place(f".{uuid.uuid4().hex}")
        own = self._local(path)
        if own is not None:
            os.makedirs(os.path.dirname(own), exist_ok=True)
            written = self._local(draft)
            with open(written, "xb") as file:
                file.write(content)
            try:
                os.link(written, own)
            except FileExistsError:
                return False
            finally:
                os.remove(written)
            return True
        stream = system.create(draft, False)
        stream.write(content)
        stream.close()
        placed = not system.exists(path) and system.rename(draft, path)
        if not placed:
            system.delete(draft, False)
        return placed

    def append(self, next_entry: Callable[[int, dict | None], Mapping | None]) -> tuple[int, dict | None]:
        """Commit what follows from the newest entry; (number, entry) in force afterwards.

        ``next_entry`` gets the newest number and entry, and returns the next entry
        or None for no change. Whoever loses the number decides again from the
        winner's entry, so every commit was decided on its predecessor.
        """
        while True:
            number = self.newest()
            last = self.read(number)
            entry = next_entry(number, last)
            if entry is None:
                return number, last
            if self.put(number + 1, entry):
                return number + 1, dict(entry)
