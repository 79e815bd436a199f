"""Who may write to a store: batch numbers that are never given twice, and writers that a newer one shuts out.

Offsets live in a stream's checkpoint and its batch ids start at 0 again in a fresh one. A store therefore numbers batches itself: each (stream,
batch) claims the next free number by creating a file that must not exist, and finds that number again when it is repeated. Every
start of a stream also claims the next epoch of its role; a process that was replaced and comes back finds a newer epoch and stops before
it writes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


class StaleWriter(RuntimeError):
    """A newer start of the same role has taken over the store."""


class Files:
    """Small files on the cluster's file system."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def make_folder(self, path: str) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def create(self, path: str, text: str) -> bool:
        """Write a file that must not exist; False if it does."""
        fs, at = self._at(path)
        try:
            out = fs.create(at, False)
        except Exception as e:
            if fs.exists(at):
                return False
            raise e
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, path: str) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


@dataclass
class Writer:
    """One start of a stream on a store. ``number`` gives the store's number of a batch of the stream."""

    files: Files
    folder: str
    stream: str
    epoch: int
    numbers: dict[tuple[str, str], int] = field(default_factory=dict)
    floor: int = -1  # the last batch that a store got in another way, as by compaction

    def check(self) -> None:
        if self.files.exists(f"{self.folder}/epochs/{self.epoch + 1:012d}"):
            raise StaleWriter(f"writer {self.epoch} of {self.folder} was replaced by a newer start")

    def _look(self) -> None:
        for name in self.files.names(f"{self.folder}/batches"):
            if int(name) not in self.numbers.values():
                stream, _, batch = self.files.read(f"{self.folder}/batches/{name}").partition(" ")
                self.numbers[(stream, batch)] = int(name)

    def number(self, batch_id: int) -> int:
        """The store's number of a batch: the one it has, or else the next free one."""
        self.check()
        own = (self.stream, str(batch_id))
        while own not in self.numbers:
            taken = max([self.floor, *self.numbers.values()])
            if self.files.create(f"{self.folder}/batches/{taken + 1:012d}", " ".join(own)):
                self.numbers[own] = taken + 1
            else:
                self._look()
        return self.numbers[own]


def open_writer(spark: SparkSession, root: str, checkpoint: str, role: str) -> Writer:
    """Start writing to the store at ``root`` for a stream with its offsets in ``checkpoint``; earlier writers of the role are shut out."""
    files, folder = Files(spark), f"{root.rstrip('/')}/_writers/{role}"
    identity = f"{checkpoint.rstrip('/')}/gridlap_stream"
    if not files.exists(identity):
        files.create(identity, uuid.uuid4().hex)
    epoch = int((files.names(f"{folder}/epochs") or ["-1"])[-1]) + 1
    stream = files.read(identity)
    while not files.create(f"{folder}/epochs/{epoch:012d}", stream):
        epoch += 1
    stored = [int(n.split("=")[1]) for n in files.names(f"{root.rstrip('/')}/partials") if n.startswith("batch_id=")] if role == "ingest" else []
    writer = Writer(files, folder, stream, epoch, floor=max(stored, default=-1))
    writer._look()
    return writer
