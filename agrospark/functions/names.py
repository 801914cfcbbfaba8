"""Driver-side name resolution over a schema; no data is touched."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def find_column(columns: Iterable[str], candidates: Iterable[str], ignore_case: bool = True) -> str | None:
    """The first candidate that names a column, in candidate order."""
    columns = list(columns)
    if not ignore_case:
        return next((c for c in candidates if c in columns), None)
    by_lower: dict[str, str] = {}
    for c in columns:
        by_lower.setdefault(c.lower(), c)
    return next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)


def rename_first(df: DataFrame, target: str, candidates: Iterable[str]) -> DataFrame:
    """Give the first candidate present the target name; a column of that name always wins."""
    if target in df.columns:
        return df
    found = find_column(df.columns, [target, *candidates])
    return df if found is None else df.withColumnRenamed(found, target)


def require(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required column(s) {missing}; available {df.columns}")
