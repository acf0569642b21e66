"""Paths, names and other conventions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tail_name(path: Column) -> Column:
    """``parent/name`` of a path, or the name alone."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "/")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*\z", "")


def image_part(url: Column) -> Column:
    """Last two segments of a url or path, without its query."""
    return tail_name(F.regexp_replace(url, r"[?#].*\z", ""))


def flat_name(relative: Column) -> Column:
    return F.replace(relative, F.lit("/"), F.lit("__"))


def frame_time(name: Column) -> Column:
    """Milliseconds in a name such as ``t0005000.jpg``; 0 if there are none."""
    return F.coalesce(F.regexp_extract(stem(name), r"^t([0-9]+)\z", 1).try_cast("long"), F.lit(0).cast("long"))


def frame_stem(video: Column, ms: Column) -> Column:
    return F.format_string("%s_t%07d", video, ms)


def track_stem(track: Column) -> Column:
    return F.format_string("trk_%04d", track)


def relative_to(path: Column, root: str) -> Column:
    """The path below a root, or as it is if it isn't below."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


def resolved(path: Column, root: str) -> Column:
    """An absolute path as it is, any other below a root."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def truthy(value: str | None) -> bool:
    return (value or "").strip().lower() in ("1", "true", "yes", "on")


def last_lines(log: Column, n: int = 60) -> Column:
    lines = F.split(log, "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), n), "\n")


def progress(done: Column, total: Column, phase: Column) -> Column:
    """First phase counts for half, second for 45 of a hundred; never over 0.95."""
    share = F.coalesce(F.try_divide(done.cast("double"), total.cast("double")), F.lit(0.0))
    return F.least(F.lit(0.95), F.when(phase == 1, 0.5 * share).otherwise(0.5 + 0.45 * share))


def log_progress(log: Column, first: str = "detect", second: str = "infer") -> Column:
    """``progress`` of the last line such as ``[detect v] 5/10 (50%)`` in a log; 0 without one."""
    pattern = rf"\[({first}|{second})[^\]]*\][^(]*\(\s*([0-9]+)%\)"
    names, shares = F.regexp_extract_all(log, F.lit(pattern), F.lit(1)), F.regexp_extract_all(log, F.lit(pattern), F.lit(2))
    phase = F.when(F.try_element_at(names, F.lit(-1)) == second, 2).otherwise(1)
    done = F.coalesce(F.try_element_at(shares, F.lit(-1)).try_cast("int"), F.lit(0))
    return F.when(F.size(names) == 0, 0.0).otherwise(progress(done, F.lit(100), phase))
