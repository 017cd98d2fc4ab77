"""Markers of what a full run has committed, so that a run started again goes on from there."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from pulse.sinks.paths import path_exists, read_text, remove_path, write_text

MARKERS = "_committed"


@dataclass(frozen=True)
class Commits:
    """Markers below `out`, one per dataset and format. `key` says what the outputs depend on;
    without one nothing is marked, and nothing found."""

    spark: SparkSession
    out: str
    key: str | None

    def place(self, name: str, fmt: str) -> str:
        return f"{self.out}/{MARKERS}/{name}.{fmt}.json"

    def path_of(self, name: str, fmt: str) -> str | None:
        """The committed output of this run, if it is still there."""
        text = read_text(self.spark, self.place(name, fmt)) if self.key else None
        said = json.loads(text) if text else {}
        path = said.get("path") if said.get("key") == self.key else None
        return path if path and path_exists(self.spark, path) else None

    def open(self, name: str, fmt: str) -> None:
        """Before an output is replaced, whatever run it was of: it is no longer committed."""
        remove_path(self.spark, self.place(name, fmt))

    def close(self, name: str, fmt: str, path: str) -> None:
        if self.key:
            said = {"key": self.key, "path": path}
            write_text(self.spark, self.place(name, fmt), json.dumps(said))
