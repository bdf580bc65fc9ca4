"""Helpers that write the DuckDB oracle SQL for the query catalog.

The oracle is independent SQL over the same driver tables; these helpers only
spell repeated column lists (window x behaviour type) so the statements stay
readable.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from actionlens.sources.fixtures import DUCKDB_VIEWS
from actionlens.operators.windows import shift_date


def with_views(views: Sequence[str], ctes: Sequence[tuple[str, str]], body: str) -> str:
    parts = [f"{n} AS ({DUCKDB_VIEWS[n]})" for n in views]
    parts += [f"{n} AS ({q})" for n, q in ctes]
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + body


def ts(d: str) -> str:
    return f"TIMESTAMP '{d} 00:00:00'"


def dt(d: str) -> str:
    return f"DATE '{d}'"


def lookback_where(end: str, days: int, col: str = "time") -> str:
    return f"{col} >= {ts(shift_date(end, -days))} AND {col} < {ts(end)}"


def off_expr(end: str, col: str = "time") -> str:
    return f"CAST(date_diff('day', CAST({col} AS DATE), {dt(end)}) AS INTEGER)"


def safe_ratio(n: str, d: str) -> str:
    return (f"(CASE WHEN ({n}) IS NULL OR ({d}) IS NULL THEN 0.0 "
            f"WHEN ({d}) = 0 THEN (CASE WHEN ({n}) = 0 THEN 0.0 ELSE 1.0 END) "
            f"ELSE CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)")


def window_count_cols(windows: Iterable[int], types: Iterable[int], name) -> list[str]:
    return [f"count(*) FILTER (WHERE type = {k} AND off <= {n}) AS {name(n, k)}"
            for n in windows for k in types]


def type_count_cols(types: Iterable[int], name) -> list[str]:
    return [f"count(*) FILTER (WHERE type = {k}) AS {name(k)}" for k in types]
