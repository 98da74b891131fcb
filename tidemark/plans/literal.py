"""Small tables written out, for Spark and for SQL alike."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DUCK = {"string": "VARCHAR", "int": "INT", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]", "date": "DATE", "binary": "BLOB"}


def quoted(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    if isinstance(x, list):
        return "[" + ", ".join(map(quoted, x)) + "]"
    if isinstance(x, int | float):
        return str(x)
    if isinstance(x, dt.datetime):
        return f"TIMESTAMP '{x}'"
    s = str(x)
    text = "'" + s.replace("'", "''") + "'"
    for c in "\n\r\t\f":
        text = text.replace(c, f"' || chr({ord(c)}) || '")
    return text


class Literal:
    def __init__(self, kind: str, rows: list[tuple]) -> None:
        self.kind, self.rows = kind, rows
        self.fields = [f.strip().split(" ", 1) for f in kind.split(", ")]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.kind)

    def sql(self, name: str) -> str:
        """A common table expression."""
        cols = ", ".join(f"CAST(c{i} AS {DUCK[k]}) AS {n}" for i, (n, k) in enumerate(self.fields))
        values = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in self.rows)
        heads = ", ".join(f"c{i}" for i in range(len(self.fields)))
        return f"{name} AS (SELECT {cols} FROM (VALUES {values}) v({heads}))"


class Cases:
    """Inputs of a function with the results that are to come out, worked out by hand. The query gives case and got; its SQL
    is the table of expected values, so that the two have nothing in common."""

    def __init__(self, kind: str, f: Callable[..., Column], rows: list[tuple]) -> None:
        self.kind, self.f, self.rows = kind, f, rows

    def query(self, spark: SparkSession, d: str) -> DataFrame:
        n = len(self.kind.split(", "))
        table = Literal("case_no int, " + self.kind, [(i, *r[:n]) for i, r in enumerate(self.rows)]).frame(spark)
        got = self.f(*[F.col(c) for c in table.columns[1:]])
        return table.select("case_no", F.when(got.isNull(), "null").otherwise(got.cast("string")).alias("got"))

    @property
    def sql(self) -> str:
        text = lambda x: "null" if x is None else str(x).lower() if isinstance(x, bool) else str(x)
        return "WITH " + Literal("case_no int, got string", [(i, text(r[-1])) for i, r in enumerate(self.rows)]).sql("x") + " SELECT * FROM x"
