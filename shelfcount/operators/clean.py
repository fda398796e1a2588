"""Projections, cleaning and row filters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import measures, text
from .ranking import Down, rank_rows


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; names that do not occur are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def clean_name(name: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"['\"]", "", name)).strip().lower()


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case names without quote marks, line breaks or runs of blanks."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def keep(df: DataFrame, cols: Sequence[str], missing: str = "ignore") -> DataFrame:
    """Column subset; ``missing='error'`` insists that every name exists."""
    absent = [c for c in cols if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"missing columns: {absent}")
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def default_column(df: DataFrame, name: str, value: object, dtype: str = "string") -> DataFrame:
    """Add ``name`` only when it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(value).cast(dtype))


def to_number(
    df: DataFrame,
    cols: Sequence[str],
    fill: float | None = None,
    scale: int | None = None,
    dtype: str = "double",
) -> DataFrame:
    """Text to numbers: bad text is null, then ``fill``; ``scale`` rounds half to even."""

    def convert(name: str) -> Column:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        # Rounded as a double before any decimal type could round it half up.
        first = dtype if scale is None else "double"
        value = measures.number(name, first) if is_text else F.col(name).cast(first)
        if scale is not None:
            value = F.bround(value, scale).cast(dtype)
        return value if fill is None else F.coalesce(value, F.lit(fill).cast(dtype))

    return df.withColumns({c: convert(c) for c in cols})


def to_decimal(df: DataFrame, cols: Sequence[str], dtype: str = "decimal(18,2)") -> DataFrame:
    return df.withColumns({c: measures.decimal(c, dtype) for c in cols})


def cast_map(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Tolerant cast by map; columns outside the map stay, map names that are absent are ignored."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items() if c in df.columns})


def numbered(prefix: str, first: int, last: int, width: int = 2) -> list[str]:
    """Generated column names such as CODE01 .. CODE43."""
    return [f"{prefix}{i:0{width}d}" for i in range(first, last + 1)]


def clean_cells(df: DataFrame, quotes: str = "all") -> DataFrame:
    """``text.clean_cell`` on every text column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: text.clean_cell(F.col(f"`{c}`"), quotes) for c in names})


def fill_defaults(df: DataFrame, cols: Sequence[str], value: int | float | str) -> DataFrame:
    return df.fillna(value, subset=[c for c in cols if c in df.columns])


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null or blank key."""
    tests = [F.trim(F.col(f"`{c}`").cast("string")) != "" for c in cols]
    return df.filter(reduce(lambda a, b: a & b, tests))


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def exclude_null_safe(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Drop the given values; rows with a null stay."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(*values))


def between_dates(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Inclusive range on ``yyyyMMdd`` text; bounds need not be calendar days."""
    return df.filter(F.col(col).between(lo, hi))


def not_prefixed(df: DataFrame, col: str, prefixes: Iterable[str]) -> DataFrame:
    """SQL ``not like 'x%'``: a null drops out."""
    return df.filter(reduce(lambda a, b: a & b, [~F.col(col).startswith(p) for p in prefixes]))


def prefixed(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.filter(F.col(col).startswith(prefix))


def in_list(df: DataFrame, col: str, values: Iterable[object]) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def not_in_list(df: DataFrame, col: str, values: Iterable[object]) -> DataFrame:
    """Rows outside the list, nulls included."""
    return df.filter(~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def contains_flag(df: DataFrame, col: str, part: str) -> DataFrame:
    """Rows whose text holds ``part``; null counts as no."""
    return df.filter(F.coalesce(F.col(col).contains(part), F.lit(False)))


def recent(df: DataFrame, ts: str, hours: int, now: Column, shift: int = 7) -> DataFrame:
    """Rows not older than ``hours`` before ``now``; both sides in the same shifted time."""
    move = F.make_interval(hours=F.lit(shift))
    return df.filter(F.col(ts) + move >= now + move - F.make_interval(hours=F.lit(hours)))


def drop_uncounted(df: DataFrame, book: str = "stock", counted: str = "qnt") -> DataFrame:
    """Remove lines with book 0 and no count, then read a missing count as 0."""
    uncounted = (F.col(book) == 0) & F.col(counted).isNull()
    return df.filter(~F.coalesce(uncounted, F.lit(False))).withColumn(
        counted, F.coalesce(F.col(counted), F.lit(0).cast(df.schema[counted].dataType))
    )


def active_as_of(df: DataFrame, end: str, today: Column | str) -> DataFrame:
    return df.filter(F.col(end).isNull() | (F.col(end) > today))


def row_index(df: DataFrame, order: Sequence[str | Down], name: str = "index") -> DataFrame:
    """0-based position in the given total order."""
    return rank_rows(df, [], order, name).withColumn(name, F.col(name) - 1)
