"""Incremental reading of a keyed table, with a checkpoint that the caller moves."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame

from predia.sources import files
from predia.sources.keyed_table import KeyedTable


class IncrementalReader:
    """Rows committed since the last acknowledged read.

    ``read`` gives rows after the checkpoint up to the newest commit at that moment, and leaves the checkpoint where
    it is; ``acknowledge`` moves it. A job that fails between the two reads the same rows again, none is lost.
    """

    def __init__(self, table: KeyedTable, state_path: str, name: str = ""):
        self.table = table
        self.state_path = f"{state_path.rstrip('/')}/{name or table.path.rsplit('/', 1)[-1]}.json"
        self.name = name
        self._seen: str | None = None

    def last_processed(self) -> str | None:
        spark = self.table.spark
        if not files.exists(spark, self.state_path):
            return None
        return json.loads(files.read_text(spark, self.state_path))["last_processed_commit"]

    def read(self, deletes: bool = False) -> DataFrame:
        """New rows, those of the whole table at the first read; an empty frame when there is nothing new.

        With ``deletes`` they come from the table's change feed, and ``_deleted`` marks the rows that went.
        """
        self._seen = self.table.last_commit()
        ask = self.table.changed_rows if deletes else self.table.changes_since
        return ask(self.last_processed(), self._seen)

    def acknowledge(self) -> None:
        if self._seen is None:
            return
        state = {
            "last_processed_commit": self._seen,
            "table_name": self.name,
            "path": self.table.path,
            "inserted_time": str(dt.datetime.now()),
        }
        files.write_text(self.table.spark, self.state_path, json.dumps(state))

    def reset(self) -> None:
        """Forget the checkpoint: the next read starts at the first commit."""
        files.delete(self.table.spark, self.state_path)
