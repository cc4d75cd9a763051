"""Test inputs: the landed and core tables, derived by SQL from the given parquet tables.

The text of each mapping is the common subset of Spark SQL and DuckDB, so both engines start
from identical rows.  ``{TS}`` stands for the zone-free timestamp type of the engine, any other
``{name}`` for a given table or another mapping.  Every mapping reads its given tables whole.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from fixtures.mappings import MAPPINGS
from fleetgauge import schemas

EVENTS_AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = datetime(2001, 8, 2)

_NAME = re.compile(r"\{(\w+)\}")


def references(text: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(text)) if n != "TS"]


class Inputs:
    """Lazily built frames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in MAPPINGS:
            text = MAPPINGS[name].replace("{TS}", "TIMESTAMP_NTZ")
            return self.spark.sql(text, **{n: getattr(self, n) for n in references(text)})
        if name in schemas.GIVEN_TABLES:
            reader = self.spark.read.schema(schemas.GIVEN_TABLES[name])
            return reader.parquet(f"{self.sf_dir}/{name}.parquet")
        raise AttributeError(name)


def duckdb_sql(body: str) -> str:
    """Turn a query over ``{mapping}`` names into one DuckDB statement with the mappings as CTEs."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in references(text):
            if name in MAPPINGS and name not in order:
                visit(MAPPINGS[name])
                order.append(name)

    visit(body)
    body = body.strip()
    ctes = [f"{n} AS (\n{_plain(MAPPINGS[n])}\n)" for n in order]
    if not ctes:
        return _plain(body)
    head = "WITH " + ",\n".join(ctes)
    if body[:5].upper() == "WITH ":
        return head + ",\n" + _plain(body[5:])
    return head + "\n" + _plain(body)


def _plain(text: str) -> str:
    return _NAME.sub(lambda m: "TIMESTAMP" if m[1] == "TS" else m[1], text).strip()
