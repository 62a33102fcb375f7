"""Tables as numbered versions: lists of folders that are switched at once and never change.

A version is one small file that names the folders of the table, each with the number of the batch it came with. It is
written beside its name and then renamed, so a reader sees it whole or not at all. Folders are never written to again; a folder goes once
none of the newest `keep` versions names it. So whoever has opened one of these reads on undisturbed while the
table is shortened.

There is one writer, the stream that owns the checkpoint. A batch that is replayed writes new folders and replaces its version.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_NAME = "version="


class Versions:
    """The versions of the table under `path`, in whatever store it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.jvm = spark, path, spark._jvm
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def numbers(self) -> list[int]:
        """Versions there are, oldest first."""
        found = self.fs.globStatus(self._at(f"versions/{_NAME}*")) or []
        return sorted(int(s.getPath().getName().removeprefix(_NAME)) for s in found)

    def folders(self, number: int | None = None) -> list[tuple[str, int]]:
        """(folder, batch) of a version, of the newest one by default; none for a table without versions."""
        numbers = self.numbers()
        if number is None and not numbers:
            return []
        stream = self.fs.open(self._at(f"versions/{_NAME}{numbers[-1] if number is None else number}"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [(f"{self.path}/data/{name}", batch) for name, batch in json.loads(text)]

    def before(self, number: int) -> list[tuple[str, int]]:
        """What the newest version below `number` names."""
        older = [n for n in self.numbers() if n < number]
        return self.folders(older[-1]) if older else []

    def write(self, rows: DataFrame, kind: str, batch: int) -> tuple[str, int]:
        """Write rows to a folder of their own, which no version names yet."""
        folder = f"{self.path}/data/{kind}-{batch}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(folder)
        return folder, batch

    def publish(self, number: int, folders: list[tuple[str, int]]) -> None:
        """Switch the table to these folders."""
        final, beside = self._at(f"versions/{_NAME}{number}"), self._at(f"versions/_{uuid.uuid4().hex[:8]}")
        text = json.dumps([(folder.rsplit("/", 1)[1], batch) for folder, batch in folders])
        out = self.fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(final, False)  # there only if the batch is replayed
        if not self.fs.rename(beside, final):
            raise OSError(f"version {number} of {self.path} could not be written")

    def clean(self, keep: int) -> None:
        """Delete all but the newest `keep` versions and the folders that only the deleted ones name."""
        numbers = self.numbers()
        named = {folder.rsplit("/", 1)[1] for n in numbers[-keep:] for folder, _ in self.folders(n)}
        for n in numbers[:-keep]:
            self.fs.delete(self._at(f"versions/{_NAME}{n}"), False)
        for status in self.fs.globStatus(self._at("data/*")) or []:
            if status.getPath().getName() not in named:
                self.fs.delete(status.getPath(), True)
