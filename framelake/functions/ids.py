"""Column expressions for names and identities (SCL-1..SCL-7).

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake.schemas import VIDEO_SUFFIXES


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def base_name(path: Column | str) -> Column:
    """Last path component (text after the last '/')."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def stem(name: Column | str) -> Column:
    """File name without its last extension, with the usual rule for leading dots.

    'a.b.mp4' -> 'a.b', '.mp4' -> '.mp4', '..mp4' -> '..mp4', 'a.' -> 'a'.
    An extension exists only when some character before the last dot is not a dot.
    """
    n = _c(name)
    pattern = r"^(\.*[^.].*)\.[^.]*$"
    return F.when(n.rlike(pattern), F.regexp_extract(n, pattern, 1)).otherwise(n)


def video_id_from_path(path: Column | str) -> Column:
    """SCL-2: video id = file name without the last extension."""
    return stem(base_name(path))


def frame_id_from_path(frame_id: Column | str, path: Column | str) -> Column:
    """SCL-3: the given frame id, else the base name of the path without extension."""
    return F.coalesce(_c(frame_id), stem(base_name(path)))


def frame_id(video_id: Column | str, frame_number: Column | str) -> Column:
    """SCL-1: '{video_id}__{frame_number:06d}' (at least six digits, never cut).

    ``lpad`` cuts longer numbers, so it is used only below 10**6; negative numbers
    (not produced by a decoder) keep printf's sign handling.
    """
    n = _c(frame_number).cast("long")
    digits = (
        F.when((n >= 0) & (n < 1000000), F.lpad(n.cast("string"), 6, "0"))
        .when(n >= 1000000, n.cast("string"))
        .otherwise(F.format_string("%06d", n))
    )
    return F.concat(_c(video_id), F.lit("__"), digits)


def frame_path(out_dir: str, video_id: Column | str, fid: Column | str) -> Column:
    """SCL-4: '{out_dir}/{video_id}/{frame_id}.jpg'."""
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), _c(video_id), F.lit("/"), _c(fid), F.lit(".jpg"))


def truncate_ms(pos_ms: Column | str) -> Column:
    """SCL-5: integer milliseconds, truncated toward zero."""
    return _c(pos_ms).cast("long")


def has_video_suffix(name: Column | str, suffixes=VIDEO_SUFFIXES) -> Column:
    """SCL-6: case-insensitive suffix test."""
    alternatives = "|".join(s.lstrip(".") for s in suffixes)
    return _c(name).rlike(rf"(?i)\.({alternatives})$")


def now() -> Column:
    """SCL-7: one timestamp per query (Spark folds current_timestamp per query)."""
    return F.current_timestamp()


def fmt_decimal(x: Column | str, digits: int = 5) -> Column:
    """Decimal text of ``x`` rounded half away from zero to ``digits`` places.

    Goes through DECIMAL so the text is the same in every SQL engine (binary-float
    '%.5f' formatting differs between engines on exact decimal ties).
    """
    return (
        F.round(_c(x).cast("decimal(38,12)"), digits).cast(f"decimal(38,{digits})").cast("string")
    )
