"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Bytes of a row's text form: UTF-8 bytes of each value (null: none) and one separator for each column."""
    names = columns or df.columns
    sizes = [F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))).cast("long") for c in names]
    return sum(sizes, F.lit(0).cast("long")) + len(names)


def ceil_div(a: Column, b: Column) -> Column:
    """Whole numbers, rounded up."""
    top = (a + b - 1).cast("decimal(20,0)")
    return ((top - top % b) / b).cast("long")


def half_up(product: Column, divisor: Column) -> Column:
    """Whole non-negative product / divisor, rounded half up, in exact decimals."""
    p, d = product.cast("decimal(38,0)"), divisor.cast("decimal(19,0)")
    twice = p * 2 + d
    return ((twice - twice % (d * 2)) / (d * 2)).cast("long")


def human_size(size: Column) -> Column:
    """1023 B, 1.5 KB, 2.5 MB, 3.50 GB."""
    kb = 1024
    return (
        F.when(size < kb, F.format_string("%d B", size.cast("long")))
        .when(size < kb**2, F.format_string("%.1f KB", size / kb))
        .when(size < kb**3, F.format_string("%.1f MB", size / kb**2))
        .otherwise(F.format_string("%.2f GB", size / kb**3))
    )


def elapsed(seconds: Column) -> Column:
    """59s, 5m 30s, 2h 30m 45s."""
    s = F.floor(seconds).cast("long")
    h, m, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(s >= 3600, F.format_string("%dh %dm %ds", h, m, rest)).when(s >= 60, F.format_string("%dm %ds", m, rest)).otherwise(F.format_string("%ds", rest))


def percent(done: Column, total: Column) -> Column:
    """Whole percent, rounded down, at most 100; 0 if there is nothing to do."""
    return F.when(total > 0, F.least(F.floor(done * 100 / total), F.lit(100))).otherwise(F.lit(0)).cast("long")


# The characters that become _ in names of files, and control characters.
UNSAFE = r'[/\\<>:"|?*\x00-\x1f]'


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, UNSAFE, "_")


def chunk_file(schema: Column, table: Column, idx: Column, codec: str = "zstd") -> Column:
    return F.concat(F.lit("data/"), safe_name(schema), F.lit("."), safe_name(table), F.format_string("/chunk_%04d.parquet." + codec, idx))


def masked_url(url: Column) -> Column:
    """Password masked, then the query dropped. The password is all between the first colon behind :// and the last @, so none of its characters can end it; the user may be empty."""
    return F.split_part(F.regexp_replace(url, r"(?s)://([^:]*):.*@", "://$1:***@"), F.lit("?"), F.lit(1))


def url_tail(url: Column) -> Column:
    """Last part of the path, or ''; taken where the password is masked already."""
    bare = masked_url(url)
    return F.when(bare.contains("/"), F.substring_index(bare, "/", -1)).otherwise(F.lit(""))


def url_with_only(url: Column, parameter: str) -> Column:
    """Only one query parameter stays, where there is one."""
    query = F.split(F.get(F.split(url, r"\?"), F.lit(1)), "&")
    kept = F.get(F.filter(query, lambda p: F.lower(p).startswith(parameter.lower() + "=")), F.lit(0))
    base = F.get(F.split(url, r"\?"), F.lit(0))
    return F.when(kept.isNotNull(), F.concat(base, F.lit("?"), kept)).otherwise(base)
