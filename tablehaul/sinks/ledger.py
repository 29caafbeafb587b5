"""Exactly-once loads into a table of Parquet folders.

A load writes its rows to a folder of its own (staged), then adds one entry to the table's ledger: what it is called, where
its rows lie and how many there are. Entries are numbered files, made whole and without overwriting, so of two writers one gets
a number and the other looks again. The table is what the entries name, in order; nothing else is read. So

* a load that fails half-way leaves a folder that no entry names;
* a load that is tried again under its name finds its entry and does nothing;
* of two loads with one name at the same time, one is entered, and the other's folder is removed;
* two loads with different names are both entered;
* a load that replaces the table hides all entries before it, and readers change over at once.

Rows are counted by the write itself. The table's folder holds ``ledger/<number>.json`` and ``loads/<name>-<random>/``.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.fs import committed, delete_path, list_names, read_text, write_new

NAME = re.compile(r"^[A-Za-z0-9_.-]+$")


@dataclass(frozen=True)
class Entry:
    number: int
    load: str
    folder: str
    rows: int
    schema: str
    replaces: bool


class LedgerTable:
    """A table under ``path`` whose loads are each in it once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> list[Entry]:
        """All entries, oldest first: one small file per load."""
        out = []
        for name in list_names(self.spark, f"{self.path}/ledger"):
            if re.fullmatch(r"\d+\.json", name):
                note = json.loads(read_text(self.spark, f"{self.path}/ledger/{name}"))
                out.append(Entry(number=int(name[:-5]), **note))
        return out

    def loads(self) -> list[Entry]:
        """The entries that make up the table: the last one that replaces it, and those after that."""
        found = self.entries()
        start = max((i for i, e in enumerate(found) if e.replaces), default=0)
        return found[start:]

    def count(self) -> int:
        """Rows in the table, from the ledger alone."""
        return sum(e.rows for e in self.loads())

    def read(self) -> DataFrame:
        """The rows of the table, with the schema of its first load."""
        found = self.loads()
        if not found:
            raise ValueError(f"{self.path} has no load")
        schema = T.StructType.fromJson(json.loads(found[0].schema))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/loads/{e.folder}" for e in found])

    def stage(self, df: DataFrame, load: str) -> dict:
        """Write the rows to a folder of their own; the table is as before."""
        if not NAME.match(load):
            raise ValueError(f"not a name for a load: {load!r}")
        folder = f"{load}-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/loads/{folder}")
        return {"load": load, "folder": folder, "rows": int(seen.get["n"]), "schema": df.schema.json()}

    def commit(self, staged: dict, replaces: bool = False) -> bool:
        """Enter a staged load, unless one of its name is in the table already; then its folder goes."""
        if not committed(self.spark, f"{self.path}/loads/{staged['folder']}"):
            raise ValueError(f"{staged['folder']} was not written to its end")
        while True:
            found = self.entries()
            if any(e.load == staged["load"] for e in self._live(found)):
                delete_path(self.spark, f"{self.path}/loads/{staged['folder']}")
                return False
            self._same_columns(staged, [] if replaces else self._live(found))
            number = found[-1].number + 1 if found else 1
            if write_new(self.spark, f"{self.path}/ledger/{number:012d}.json", json.dumps({**staged, "replaces": replaces})):
                return True

    @staticmethod
    def _live(found: list[Entry]) -> list[Entry]:
        start = max((i for i, e in enumerate(found) if e.replaces), default=0)
        return found[start:]

    @staticmethod
    def _same_columns(staged: dict, found: list[Entry]) -> None:
        if found and found[0].schema != staged["schema"]:
            raise ValueError(f"columns differ from the table's: {staged['schema']} and {found[0].schema}")

    def load(self, df: DataFrame, load: str, replace: bool = False) -> bool:
        """Put ``df`` into the table under the name ``load``, once; True where this call did it."""
        if any(e.load == load for e in self.loads()):
            return False
        return self.commit(self.stage(df, load), replace)

    def load_if_incomplete(self, df: DataFrame, load: str, expected_rows: int) -> bool:
        """Replace the table by ``df`` unless it holds ``expected_rows`` rows. The count is the ledger's: no scan."""
        if self.loads() and self.count() == expected_rows:
            return False
        return self.commit(self.stage(df, f"{load}-{uuid.uuid4().hex[:12]}"), replaces=True)

    def sweep(self) -> list[str]:
        """Remove the folders that no entry of the table names, when no load is under way; returns their names."""
        named = {e.folder for e in self.loads()}
        gone = [f for f in list_names(self.spark, f"{self.path}/loads") if f not in named]
        for folder in gone:
            delete_path(self.spark, f"{self.path}/loads/{folder}")
        return gone
