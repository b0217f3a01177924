"""Text parsing as Column expressions."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finish_seconds(col) -> Column:
    """F8: trimmed text; exactly four digits ``MSSd`` (1272 -> 87.2 s) or
    ``M:SS.d``; anything else is null."""
    t = F.trim(_c(col))
    compact = F.when(t.rlike(r"^\d{4}$"), t.cast("int"))
    compact_s = F.floor(compact / 1000) * 60 + (compact % 1000) / 10.0
    pat = r"^(\d+):(\d{2})\.(\d)$"
    legacy_s = F.when(t.rlike(pat),
                      F.regexp_extract(t, pat, 1).cast("double") * 60
                      + F.regexp_extract(t, pat, 2).cast("double")
                      + F.regexp_extract(t, pat, 3).cast("double") / 10.0)
    return F.coalesce(compact_s.cast("double"), legacy_s)


def first_int(col, sep: str = "-") -> Column:
    """leading integer of a ``sep`` list, null when absent."""
    s = F.regexp_extract(_c(col), r"^(\d+)", 1)
    return F.when(s != "", s.cast("int"))


def last_int(col) -> Column:
    """trailing integer of a list, null when absent."""
    s = F.regexp_extract(_c(col), r"(\d+)$", 1)
    return F.when(s != "", s.cast("int"))


def start_minutes(col) -> Column:
    """minutes after midnight from ``HHMM`` or ``H:MM``; null otherwise."""
    t = F.coalesce(_c(col), F.lit(""))
    hhmm = F.when(t.rlike(r"^\d{4}$"),
                  F.substring(t, 1, 2).cast("int") * 60 + F.substring(t, 3, 2).cast("int"))
    pat = r"^(\d{1,2}):(\d{2})"
    hm = F.when(t.rlike(pat), F.regexp_extract(t, pat, 1).cast("int") * 60 + F.regexp_extract(t, pat, 2).cast("int"))
    return F.coalesce(hhmm, hm)


def cutoff_time(date_col, start_col, minutes_before: int = 1) -> Column:
    """date + start time - ``minutes_before`` minutes, as timestamp_ntz."""
    m = start_minutes(start_col)
    base = _c(date_col).cast("timestamp_ntz")
    return F.when(m.isNotNull(), base + F.make_dt_interval(F.lit(0), F.lit(0), m - F.lit(minutes_before)))


def join_parts(cols, sep: str = "-", skip=("", "00")) -> Column:
    """trimmed parts, blanks and ``00`` dropped, joined by ``sep``; null when empty."""
    arr = F.array(*[F.trim(_c(c)) for c in cols])
    kept = F.filter(arr, lambda x: x.isNotNull() & ~x.isin(*skip))
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def strip_chars(col, chars: str = "\u0000 \u3000") -> Column:
    """F16: trim NUL, space and full-width space on both sides (a set trim)."""
    return F.btrim(_c(col), F.lit(chars))


def strip_bom(col) -> Column:
    """Drop a leading byte-order mark."""
    return F.regexp_replace(_c(col), "^\\x{feff}", "")


def odds_value(col) -> Column:
    """Raw odds in tenths; 0 and 9999 mean missing."""
    x = F.expr(f"try_cast({col} as int)") if isinstance(col, str) else col
    return F.when(x.isNull() | x.isin(0, 9999), F.lit(None).cast("double")).otherwise(x / 10.0)


def tenths_or_null(col, sentinel: str) -> Column:
    """Numeric text in tenths, the all-zero sentinel is null."""
    x = F.nullif(_c(col), F.lit(sentinel))
    return x.try_cast("decimal(9,1)") / 10


def yyyymmdd(col) -> Column:
    """``yyyyMMdd`` text to date, null when invalid."""
    return F.try_to_date(_c(col), "yyyyMMdd")


# The characters of code page 1252 above 255, and the bytes they stand for.
CP1252 = {"€": 0x80, "‚": 0x82, "ƒ": 0x83, "„": 0x84, "…": 0x85, "†": 0x86, "‡": 0x87, "ˆ": 0x88, "‰": 0x89, "Š": 0x8A, "‹": 0x8B,
          "Œ": 0x8C, "Ž": 0x8E, "‘": 0x91, "’": 0x92, "“": 0x93, "”": 0x94, "•": 0x95, "–": 0x96, "—": 0x97, "˜": 0x98, "™": 0x99,
          "š": 0x9A, "›": 0x9B, "œ": 0x9C, "ž": 0x9E, "Ÿ": 0x9F}


@contextmanager
def java_charsets(spark: SparkSession):
    """Lets ``encode`` and ``decode`` take Java's charsets, with a replacement for
    what can't be mapped. Both settings are read when a frame is made, so they are
    put back at once and no other query sees them."""
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "true")
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def shift_jis(col) -> Column:
    """bytes as Shift_JIS text. Make the frame within ``java_charsets``."""
    return F.decode(_c(col), "Shift_JIS")


def bytes_of(col) -> Column:
    """the bytes of a payload that was read as Latin-1 or code page 1252; a
    character that neither holds becomes ``?``. Make the frame within ``java_charsets``."""
    back = F.translate(_c(col), "".join(CP1252), "".join(map(chr, CP1252.values())))
    return F.encode(back, "ISO-8859-1")
