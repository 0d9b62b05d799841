"""Column functions over values: lenient numbers, columns that may be missing, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lenient_int(col: Column | str, dtype: str = "long") -> Column:
    """Text as a whole number: blanks around it are trimmed; '-', '', fractions and other text give null."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast(dtype))


def truncating_int(col: Column | str, dtype: str = "long") -> Column:
    """Text or numbers as whole numbers, fractions cut; other text gives null."""
    c = F.trim((F.col(col) if isinstance(col, str) else col).cast("string"))
    return F.when(c.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), c.try_cast("double").cast(dtype))


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or a null of its type where the table has none."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype).alias(name)


def first_column(df: DataFrame, names: list[str], dtype: str = "string") -> Column:
    """The first of the columns that exists, under the first name; null if none does."""
    for n in names:
        if n in df.columns:
            return F.col(n).alias(names[0])
    return F.lit(None).cast(dtype).alias(names[0])


def required_columns(df: DataFrame, names: list[str]) -> list[str]:
    """The names that the table lacks, in order."""
    return [n for n in names if n not in df.columns]


def cache_key(*cols: Column | str) -> Column:
    """SHA-256 of the columns as one JSON object."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).cast("binary"), 256)


def gzip_magic(col: Column | str) -> Column:
    """Whether bytes begin like a gzip member with deflate."""
    return F.hex(F.substring(F.col(col) if isinstance(col, str) else col, 1, 3)) == "1F8B08"


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that df has not, for columns of passing use."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
