"""Several tables as one state. A change writes what is new beside what is there; one rename of a small file then makes all
of it the state that readers see, and a change that stops before that has changed nothing.

The small file lists, for each table, its parts (folders of Parquet files) and its schema. It is never rewritten: each
state has a number, older ones can still be read, and of two writers that began from one state the second gets an error.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another change was committed first."""


def shared_place(spark: SparkSession, label: str) -> str:
    """A new folder that the driver and all executors see, under ``spark.checkpoint.dir``; a temporary one where that is unset
    and the session is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-store-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Change:
    """What one commit adds to the state: tables replaced or appended to."""

    def __init__(self, store: Store, before: dict):
        self.store, self.before = store, before
        self.tables = {name: dict(t) for name, t in before["tables"].items()}
        self.notes = dict(before["notes"])

    def replace(self, name: str, rows: DataFrame, by: list[str] | None = None) -> None:
        self.tables[name] = {"schema": rows.schema.jsonValue(), "parts": [self._written(name, rows, by)]}

    def append(self, name: str, rows: DataFrame, by: list[str] | None = None) -> None:
        old = self.tables.get(name)
        if old is None:
            return self.replace(name, rows, by)
        if [(f.name, f.dataType) for f in StructType.fromJson(old["schema"])] != [(f.name, f.dataType) for f in rows.schema]:
            raise ValueError(f"{name} has other columns: {old['schema']}")
        old["parts"] = [*old["parts"], self._written(name, rows, by)]

    def _written(self, name: str, rows: DataFrame, by: list[str] | None) -> str:
        part = f"{name}/{uuid.uuid4().hex}"
        rows.write.partitionBy(*(by or [])).option("compression", "zstd").parquet(f"{self.store.root}/{part}")
        return part

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.store._publish(self.before["number"] + 1, {"tables": self.tables, "notes": self.notes})


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        fs, place = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def numbers(self) -> list[int]:
        """The numbers of all states, in order."""
        return sorted(int(n.removesuffix(".json")) for n in self._names("_states") if re.fullmatch(r"\d+\.json", n))

    def state(self, number: int | None = None) -> dict:
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return {"number": 0, "tables": {}, "notes": {}}
        stream = self._fs().open(self._path("_states", f"{number}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")) | {"number": number}
        finally:
            stream.close()

    def change(self) -> Change:
        """Used with ``with``: what is written inside becomes the state at its end, all of it or nothing."""
        return Change(self, self.state())

    def _publish(self, number: int, state: dict) -> None:
        draft, final = self._path("_states", f"draft-{uuid.uuid4().hex}"), self._path("_states", f"{number}.json")
        out = self._fs().create(draft, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self._conf)
        flags = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(draft, final, flags)  # fails where the number is taken
        except Exception as error:
            self._fs().delete(draft, False)
            if number in self.numbers():
                raise Conflict(f"state {number} was committed by another change") from error
            raise

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """A table as of a state, the last one by default."""
        table = self.state(number)["tables"][name]
        schema = StructType.fromJson(table["schema"])
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/{p}").select(*schema.names) for p in table["parts"]]
        return reduce(DataFrame.unionByName, parts)

    def has(self, name: str) -> bool:
        return name in self.state()["tables"]

    def recover(self, keep: int = 2) -> list[str]:
        """Delete states but the last ``keep``, and the parts that no state left names, such as those of a change that
        stopped. No change may be under way."""
        fs, numbers, gone = self._fs(), self.numbers(), []
        for n in numbers[: max(0, len(numbers) - keep)]:
            fs.delete(self._path("_states", f"{n}.json"), False)
        for draft in (n for n in self._names("_states") if n.startswith("draft-")):
            fs.delete(self._path("_states", draft), False)
        live = {p for n in self.numbers() for t in self.state(n)["tables"].values() for p in t["parts"]}
        for name in (n for n in self._names("") if n != "_states"):
            for part in (f"{name}/{p}" for p in self._names(name)):
                if part not in live:
                    fs.delete(self._path(part), True)
                    gone.append(part)
        return sorted(gone)
