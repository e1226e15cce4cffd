"""Query registry: one Spark query per operator plus, where
SQL can express it, the DuckDB oracle for the same result.

Every query reads the driver tables (or data Spark derives from them) whole.
Output columns are aliased identically on both sides; double results are
rounded to 4 digits on both sides so float summation order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = stable_round_sql(sql.strip())
        return fn
    return deco


def stable_round_sql(sql: str, digits: int = 4) -> str:
    """Rewrite every ``round(x, digits)`` as ``round(round(x, 9), digits)``.

    The inner rounding removes float summation noise, so a value that is exactly
    on a rounding boundary (``0.71875``) rounds the same way in both engines.
    """
    out, i, tail = [], 0, f", {digits})"
    low = sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        call = sql[j:k + 1]
        if call.endswith(tail):
            inner = stable_round_sql(call[6:-len(tail)], digits)
            call = f"round(round({inner}, 9){tail}"
        out.append(sql[i:j])
        out.append(call)
        i = k + 1


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column (top level) to ``digits`` (through 9 digits
    first, matching :func:`stable_round_sql`)."""
    return df.select(*[F.round(F.round(F.col(f"`{f.name}`"), 9), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def load_all() -> None:
    """Import the modules that register queries."""
    from tidewater.plans import queries_batch, queries_flows, queries_io, queries_ops, queries_stream  # noqa: F401
