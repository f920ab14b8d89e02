from __future__ import annotations

import os
import time
from collections import Counter
from pathlib import Path

from sluice import Contract, Dataset, Field, Layout, raise_failures, run_bronze, run_silver

MEMBERS = Contract(
    (
        Field("member_id", "string", nullable=False, is_primary_key=True),
        Field("given_name", "string", nullable=False),
        Field("born_on", "date", nullable=False, date_formats=("dd/MM/yyyy",)),
        Field("points", "decimal(5,2)"),
        Field("joined_on", "date", nullable=False, date_formats=("dd/MM/yyyy",)),
    )
)

RESULTS = Contract(
    (
        Field("member_id", "string", nullable=False, is_primary_key=True),
        Field("event_code", "string", nullable=False, is_primary_key=True),
        Field("score", "decimal(5,2)", nullable=False),
        Field("held_on", "date", nullable=False, date_formats=("dd/MM/yyyy",)),
    )
)


class Desk:
    """One dataset in a fresh folder, fed with files by hand."""

    def __init__(self, spark, tmp_path: Path, contract: Contract, name: str = "members", **options) -> None:
        self.spark = spark
        self.path = tmp_path
        self.dataset = Dataset(name, f"raw_{name}", contract, **options)
        self.layout = Layout.under(f"file:{tmp_path}")
        self.landing = tmp_path / "landing" / name
        self.landing.mkdir(parents=True, exist_ok=True)
        self.clock = time.time() - 100_000

    def put(self, name: str, text: str) -> None:
        path = self.landing / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
        # A second apart: the stream takes files by time, and a test writes them all at once.
        self.clock += 1
        os.utime(path, (self.clock, self.clock))

    def take_up(self):
        statuses = run_bronze(self.spark, [self.dataset], self.layout)
        raise_failures(statuses)
        return statuses[0]

    def load(self):
        statuses = run_silver(self.spark, [self.dataset], self.layout)
        raise_failures(statuses)
        return statuses[0]

    def run(self):
        self.take_up()
        return self.load()


def rows(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
