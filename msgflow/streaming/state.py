"""What a run remembers between micro-batches: numbered generations behind a pointer.

A generation is a table written by one micro-batch and never changed. The pointer of a micro-batch
is one small file that names the generations which hold after it, with whatever numbers belong to them; it is
written last, so a micro-batch either has its whole state or none. A replay of micro-batch N reads
the pointer of N - 1 and writes its own again. Generations that no kept pointer names are deleted.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Optional

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from msgflow.sources.sinks import BATCH_FOLDER, write_rows

#: Pointers that are kept: of the last micro-batch, and of the one that it may be replayed from.
KEPT = 2


def together(spark: SparkSession, *calls: Callable[[], Any]) -> list[Any]:
    """Results of Spark actions that do not depend on each other, run at the same time."""
    threaded = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(calls)) as pool:
        return [f.result() for f in [pool.submit(threaded(c)) for c in calls]]


class SharedFiles:
    """Small files and folders, through the file system that Spark uses for the path."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, path: str) -> list[str]:
        system, place = self._at(path)
        return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def read(self, path: str) -> Optional[str]:
        system, place = self._at(path)
        if not system.exists(place):
            return None
        stream = system.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The whole text or nothing: written aside, then renamed."""
        system, place = self._at(path)
        aside = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{time.time_ns()}.tmp")
        stream = system.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        system.delete(place, False)
        if not system.rename(aside, place):
            raise OSError(f"cannot write {path}")


class RunState:
    """State of one run: ``table`` and ``put`` for generations, ``load`` and ``save`` for pointers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root, SharedFiles(spark)

    def _pointer(self, batch_id: int) -> str:
        return f"{self.root}/pointers/{batch_id}.json"

    def last(self) -> int:
        """The last micro-batch that has a pointer; -1 before the first one."""
        return max((int(n.removesuffix(".json")) for n in self.files.names(f"{self.root}/pointers") if n.endswith(".json")), default=-1)

    def load(self, batch_id: int) -> dict:
        """What holds after a micro-batch: empty before the first one.

        State that should be there but is not is an error: going on from nothing would reset
        breakers and batch numbers without a word.
        """
        if batch_id < 0:
            return {}
        text = self.files.read(self._pointer(batch_id))
        if text is None:
            raise RuntimeError(f"the state of micro-batch {batch_id} is missing in {self.root}")
        return json.loads(text)

    def save(self, batch_id: int, pointer: dict) -> None:
        """Make a micro-batch's state count, and delete what no kept pointer names any more."""
        self.files.write(self._pointer(batch_id), json.dumps(pointer))
        kept = [self.load(n) for n in range(max(0, batch_id - KEPT + 1), batch_id + 1) if self.files.exists(self._pointer(n))]
        for name in self.files.names(f"{self.root}/pointers"):
            if name.endswith(".json") and int(name.removesuffix(".json")) <= batch_id - KEPT:
                self.files.delete(f"{self.root}/pointers/{name}")
        for table in self.files.names(self.root):
            named = {p["tables"][table] for p in kept if table in p.get("tables", {})}
            for folder in self.files.names(f"{self.root}/{table}"):
                number = folder.rpartition("=")[2]
                if folder.startswith(f"{BATCH_FOLDER}=") and int(number) not in named and int(number) < batch_id:
                    self.files.delete(f"{self.root}/{table}/{folder}")

    def put(self, table: str, df: DataFrame, batch_id: int) -> int:
        """Write a generation; returns its number for the pointer."""
        write_rows(df, f"{self.root}/{table}", batch_id)
        return batch_id

    def table(self, table: str, pointer: dict) -> Optional[DataFrame]:
        """The generation of a table that a pointer names."""
        number = pointer.get("tables", {}).get(table)
        return None if number is None else self.spark.read.parquet(f"{self.root}/{table}/{BATCH_FOLDER}={number}")


class OutcomeLog:
    """What handlers answered, written ahead of everything that is made of it.

    A handler may answer differently when it is asked again. Its outcomes for a micro-batch are
    written once, and all sinks read that table: an executor that is lost between two sinks
    changes nothing, and a micro-batch that is replayed after a crash uses the outcomes it had. Only
    a micro-batch that was stopped on purpose forgets them, so that a restart asks again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root, SharedFiles(spark)

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/{BATCH_FOLDER}={batch_id}"

    def once(self, name: str, batch_id: int, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a micro-batch, made if no complete one is there."""
        folder = self._folder(name, batch_id)
        if not self.files.exists(f"{folder}/_SUCCESS"):
            rows = make()
            rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
        return self.spark.read.parquet(folder)

    def number(self, name: str, batch_id: int, make: Callable[[], int]) -> int:
        """A number that a replay of the micro-batch finds again."""
        path = f"{self.root}/{name}/{batch_id}.json"
        text = self.files.read(path)
        if text is None:
            text = json.dumps(make())
            self.files.write(path, text)
        return json.loads(text)

    def forget(self, batch_id: int) -> None:
        for name in self.files.names(self.root):
            self.files.delete(self._folder(name, batch_id))

    def trim(self, batch_id: int) -> None:
        """Delete what belongs to micro-batches before the last one."""
        for name in self.files.names(self.root):
            for entry in self.files.names(f"{self.root}/{name}"):
                number = entry.removesuffix(".json").rpartition("=")[2]
                if number.lstrip("-").isdigit() and abs(int(number)) <= batch_id - KEPT:
                    self.files.delete(f"{self.root}/{name}/{entry}")
