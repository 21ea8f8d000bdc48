"""Registry of named queries: key -> Spark callable + DuckDB oracle SQL.

Each ``plans/q_*.py`` module registers its queries with ``@query``.  The Spark
callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame; ``normalize``
gives every result the same comparable shape (integers as BIGINT, floats as
DOUBLE rounded to 6 dp), and the oracle SQL is wrapped so that the listed
float columns are rounded the same way.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.plans.views import with_views

ROUND_DP = 6


@dataclass
class Entry:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    floats: tuple[str, ...] = field(default_factory=tuple)
    code: str = ""   # SURVEY inventory id, e.g. "R10"

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalize(self.fn(spark, sf_dir))

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        inner = with_views(self.sql)
        if not self.floats:
            return inner
        rep = ", ".join(f"round({c}, {ROUND_DP}) AS {c}" for c in self.floats)
        return f"SELECT * REPLACE ({rep}) FROM (\n{inner}\n) AS q"


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, floats: tuple[str, ...] | list[str] = (), code: str = ""):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql, tuple(floats), code)
        return fn
    return deco


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), ROUND_DP)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


MODULES = ("q_prep", "q_eda", "q_popularity", "q_windows", "q_text", "q_neighbors", "q_latent",
           "q_hybrid", "q_supervised", "q_evaluate", "q_monitor", "q_store", "q_csv")


def load_all() -> dict[str, Entry]:
    """Import every query module (which fills REGISTRY)."""
    import importlib
    import importlib.util
    for m in MODULES:
        name = f"cinelake.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)
    return REGISTRY
