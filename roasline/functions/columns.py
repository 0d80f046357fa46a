"""Column-expression helpers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Fixed value: the text a decimal literal must match before it is cast.  Without
# this guard Spark would accept Java suffixes such as "1d" or "2f" as numbers.
NUMERIC_TEXT = r"^\s*[+-]?(((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"

# ISO dates, with or without a time behind; then the other layouts, tried in this order.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "yyyy/MM/dd", "yyyyMMdd")


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_bad(x: Column) -> Column:
    return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName, clean_inf: bool = False) -> Column:
    """Division that yields 0.0 instead of failing.

    ``clean_inf=False`` is the scalar rule: 0.0 when the denominator is 0, NULL or
    NaN, else the plain quotient.  ``clean_inf=True`` is the column rule used for
    the unified table: any NULL, NaN or infinite quotient becomes 0.0 as well.
    """
    n = col(numerator).cast("double")
    d = col(denominator).cast("double")
    if clean_inf:
        q = F.try_divide(n, F.when(d != 0, d))
        return F.when(_is_bad(q), F.lit(0.0)).otherwise(q)
    return F.when(d.isNull() | F.isnan(d) | (d == 0), F.lit(0.0)).otherwise(F.try_divide(n, d))


def divide_sql(numerator: str, denominator: str, clean_inf: bool = False) -> str:
    """``safe_divide`` as SQL text.

    One ``F.expr`` is one call into the JVM, where the same expression made of Columns is a dozen:
    wide feature lists are built from text, which Catalyst turns into the same expressions.
    """
    n, d = f"CAST({numerator} AS DOUBLE)", f"CAST({denominator} AS DOUBLE)"
    if clean_inf:
        q = f"try_divide({n}, nullif({d}, 0D))"
        return f"CASE WHEN {q} IS NULL OR isnan({q}) OR abs({q}) = double('inf') THEN 0D ELSE {q} END"
    return f"CASE WHEN {d} IS NULL OR isnan({d}) OR {d} = 0D THEN 0D ELSE try_divide({n}, {d}) END"


def clean_numeric(c: ColumnOrName, default: float = 0.0, dtype: T.DataType | None = None) -> Column:
    """Lenient number parse: unparsable, NULL or NaN become ``default``.

    Text columns are matched against ``NUMERIC_TEXT`` before the cast; infinite
    values survive as they would in a float parse.
    """
    c = col(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        value = c.cast("double")
    else:
        text = c.cast("string")
        value = F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))
    return F.when(value.isNull() | F.isnan(value), F.lit(float(default))).otherwise(value)


def parse_date(c: ColumnOrName, formats: Sequence[str] = DATE_FORMATS, dtype: T.DataType | None = None) -> Column:
    """Lenient date parse: the first layout that fits wins; none fits gives NULL."""
    c = col(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    text = F.trim(c.cast("string"))
    iso = F.when(text.rlike(ISO_DATE), text.try_cast("date"))
    # the other layouts as one array, looked at for texts that are not ISO: five inlined parsers
    # would make the generated method of the whole stage too long to be compiled
    fits = F.filter(F.array(*[F.try_to_date(text, f) for f in formats]), lambda d: d.isNotNull())
    return F.coalesce(iso, F.try_element_at(fits, F.lit(1)))


def first_existing(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """Plan-time choice of the first candidate that is present in a schema."""
    present = set(columns)
    for name in candidates:
        if name in present:
            return name
    return None


def fmt_fixed(x: ColumnOrName, digits: int = 2) -> Column:
    """``f"{x:.{digits}f}"``: fixed decimals, no thousands separator."""
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", col(x).cast("double"), F.lit(pattern))


def money(x: ColumnOrName) -> Column:
    """``f"{x:,.2f}"``: two decimals with thousands separators."""
    return F.format_number(col(x).cast("double"), 2)


def text_or(x: ColumnOrName, label: str) -> Column:
    """Render a text column for messages, with ``label`` standing in for NULL."""
    return F.coalesce(col(x).cast("string"), F.lit(label))


def round_half_even(x: ColumnOrName, digits: int) -> Column:
    """Float rounding as NumPy does it: ``rint(x * 10**d) / 10**d``.

    ``bround`` would round the shortest decimal text of the double instead,
    which differs on values such as 55232.53635.
    """
    scale = float(10 ** digits)
    return F.rint(col(x).cast("double") * F.lit(scale)) / F.lit(scale)


def round_decimal(x: ColumnOrName, digits: int) -> Column:
    """Rounding of the exact value of the double, as Python's ``round`` does it: 1.055 -> 1.05."""
    return F.coalesce(fmt_fixed(x, digits).try_cast("double"), col(x).cast("double"))


def zero_if_bad(x: ColumnOrName) -> Column:
    """NULL, NaN and +/-inf become 0.0."""
    x = col(x).cast("double")
    return F.when(_is_bad(x), F.lit(0.0)).otherwise(x)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# Sums are exact integers of this many units per currency unit; a row of LARGE_ROW or
# more, and a day of LARGE_DAY or more, is added as a plain double instead (as is +/-inf).
UNITS = 100_000_000
LARGE_ROW = 1e9
LARGE_DAY = 1e7


def sum_parts(column: str, name: str) -> list[Column]:
    """Aggregates ``<name>_w``, ``<name>_f`` (whole part and hundred-millionths, both long) and
    ``<name>_x`` (doubles too large to split, +/-inf) of a numeric column.

    The long sums stay in codegen, combine map-side and do not depend on row order.  They hold
    9e9 rows of any size below LARGE_ROW in one group; larger values cannot overflow either.
    """
    x = f"CAST(`{column}` AS DOUBLE)"
    small = f"abs({x}) < {LARGE_ROW}D"
    return [
        F.expr(f"sum(CAST(CASE WHEN {small} THEN floor({x}) ELSE 0 END AS BIGINT)) AS {name}_w"),
        F.expr(f"sum(CAST(CASE WHEN {small} THEN rint(({x} - floor({x})) * {UNITS}D) ELSE 0D END AS BIGINT)) AS {name}_f"),
        F.expr(f"sum(CASE WHEN {x} IS NULL OR {small} THEN 0D ELSE {x} END) AS {name}_x"),
    ]


def join_parts(name: str) -> list[Column]:
    """The parts of one group as ``<name>_u`` (long units, 0 for a large group) and ``<name>_x``.

    ``_u`` values of up to 9,000 groups can be added without overflow: a window over the calendar
    never reaches that.
    """
    value = f"(CAST({name}_w AS DOUBLE) + CAST({name}_f AS DOUBLE) / {UNITS}D)"
    fits = f"abs({value}) < {LARGE_DAY}D"
    return [
        F.expr(f"CASE WHEN {fits} THEN {name}_w * {UNITS}L + {name}_f ELSE 0L END AS {name}_u"),
        F.expr(f"{name}_x + CASE WHEN {fits} THEN 0D ELSE {value} END AS {name}_x"),
    ]


def units_sql(units: str, large: str) -> str:
    """A sum as a double, as SQL text, from the two columns of ``join_parts``."""
    return f"(CAST({units} AS DOUBLE) / {UNITS}D + {large})"


def parts_value(name: str) -> Column:
    """The sum held by the three parts of ``sum_parts``, rounded once where it fits a long."""
    w, f = F.col(f"{name}_w"), F.col(f"{name}_f")
    apart = w.cast("double") + f.cast("double") / F.lit(float(UNITS))
    whole = (w * F.lit(UNITS).cast("long") + f).cast("double") / F.lit(float(UNITS))
    return F.when(F.abs(apart) < F.lit(9e10), whole).otherwise(apart) + F.col(f"{name}_x")


def exact_sum_parts(columns: dict[str, str]) -> list[Column]:
    """``sum_parts`` of every ``{name: column}``."""
    return [part for name, c in columns.items() for part in sum_parts(c, name)]


def add_parts(names: Iterable[str]) -> list[Column]:
    """Sums of the parts of smaller groups: the second step of a two-step aggregate."""
    return [F.sum(f"{n}_{k}").alias(f"{n}_{k}") for n in names for k in "wfx"]
