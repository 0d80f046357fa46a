"""Reusable DuckDB SQL fragments mirroring the column helpers of the engine."""

from __future__ import annotations

NUMERIC_TEXT_RE2 = r"^\s*[+-]?(((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def num(x: str) -> str:
    v = f"(CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '{NUMERIC_TEXT_RE2}') THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END)"
    return f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN 0.0 ELSE {v} END)"


def date(x: str) -> str:
    return (
        f"COALESCE(TRY_CAST(TRY_STRPTIME(trim({x}), '%Y-%m-%d') AS DATE), "
        f"TRY_CAST(TRY_STRPTIME(trim({x}), '%Y-%m-%d %H:%M:%S') AS DATE), "
        f"TRY_CAST(TRY_STRPTIME(trim({x}), '%m/%d/%Y') AS DATE), "
        f"TRY_CAST(TRY_STRPTIME(trim({x}), '%Y/%m/%d') AS DATE), "
        f"TRY_CAST(TRY_STRPTIME(trim({x}), '%Y%m%d') AS DATE))"
    )


def sdiv(n: str, d: str) -> str:
    """Scalar safe divide: 0 when the denominator is 0 / NULL / NaN."""
    return f"(CASE WHEN ({d}) IS NULL OR isnan(({d})::DOUBLE) OR ({d}) = 0 THEN 0.0 ELSE ({n})::DOUBLE / ({d})::DOUBLE END)"


def sdiv_clean(n: str, d: str) -> str:
    """Column safe divide: any NULL / NaN / inf quotient becomes 0."""
    q = f"(CASE WHEN ({d}) <> 0 THEN ({n})::DOUBLE / ({d})::DOUBLE END)"
    return f"(CASE WHEN {q} IS NULL OR isnan({q}) OR isinf({q}) THEN 0.0 ELSE {q} END)"


def micro(x: str) -> str:
    return f"CAST(round_even(({x})::DOUBLE * 1000000.0::DOUBLE, 0) AS BIGINT)"


def xsum(x: str) -> str:
    """Plain decimal sum."""
    return f"(SUM(CAST(({x}) AS DECIMAL(28, 8)))::DOUBLE)"


def xavg(x: str) -> str:
    return f"({xsum(x)} / COUNT({x})::DOUBLE)"


def fmt2(x: str, digits: int = 2) -> str:
    return f"printf('%.{digits}f', ({x})::DOUBLE)"


def money(x: str) -> str:
    return f"format('{{:,.2f}}', ({x})::DOUBLE)"


def bround(x: str, digits: int) -> str:
    return f"round_even(({x})::DOUBLE, {digits})"
