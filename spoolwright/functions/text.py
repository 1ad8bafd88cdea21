"""Scalar functions of paths, names, job ids and selections, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """The last component without its last suffix; a leading dot is no suffix."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def suffix(path: Column) -> Column:
    """The last suffix with its dot, or nothing."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def absolute(path: Column, folder: str) -> Column:
    """The path below a folder if it is relative, without . and .. components; absolute paths and URIs only lose those."""
    whole = F.when(path.startswith("/") | path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:/"), path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path))
    parts = F.filter(F.split(whole, "/"), lambda c: c != ".")
    # every .. takes the component before it away
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, c: F.when((c == "..") & (F.size(done) > 1), F.slice(done, 1, F.size(done) - 1)).when(c == "..", done).otherwise(F.array_append(done, c)))
    return F.array_join(kept, "/")


def path_order(path: Column) -> Column:
    """What to sort paths by: their components, so that a folder's files stand together."""
    return F.split(path, "/")


def relative_to(path: Column, folder: str) -> Column:
    """The path below a folder; other paths as they are."""
    root = folder.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def derived(path: Column, kind: str) -> Column:
    """The name of what belongs to a path: final, partial, temp, tar or wav."""
    ends = {"final": ".jsonl", "partial": ".jsonl.partial", "temp": ".jsonl.temp", "tar": ".tar", "wav": "_reconstructed.wav"}
    return F.concat(stem(path), F.lit(ends[kind]))


def little_endian(n: Column, width: int = 4) -> Column:
    """The last width bytes of a whole number, lowest first. (F.reverse() takes bytes for UTF-8, and breaks where one could begin a character.)"""
    h = F.lpad(F.hex(n.cast("long")), 16, "0")
    return F.unhex(F.concat(*[F.substring(h, 15 - 2 * i, 2) for i in range(width)]))


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def has_suffix(path: Column, suffixes: list[str]) -> Column:
    """The lower-cased path ends with one of the suffixes, which stay as they are."""
    low = F.lower(path)
    out = F.lit(False)
    for s in suffixes:
        out = out | low.endswith(s)
    return out


def glob_to_regex(pattern: str) -> str:
    """A pattern matched from the right: * and ? stay inside a component."""
    body = "".join("[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c) for c in pattern)
    return f"(^|/){body}$"


def matches_any(path: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | path.rlike(glob_to_regex(p))
    return out


def ceil_div(n: Column, by: int) -> Column:
    """The least whole number not below n / by, in whole numbers throughout; n is not negative."""
    n = n.cast("bigint")
    return F.call_function("div", n, F.lit(by).cast("bigint")) + F.when(n % by > 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def job_number(jobid: Column) -> Column:
    return F.regexp_extract(jobid, r"^(\d+)", 1).try_cast("bigint")


def fixed(x: Column, digits: int) -> Column:
    """A number with so many decimals, as text: the double's exact value is rounded, and a tie goes to the even digit, as in most languages."""
    return F.call_function("format_number", x.cast("double"), F.lit("0." + "0" * digits if digits else "0"))


def stamped(prefix: str, suffix: str, at: Column | None = None) -> Column:
    """A hidden name with a time to the microsecond, now if none is given: such names sort as they were made."""
    return F.concat(F.lit(f".{prefix}_"), F.date_format(F.current_timestamp() if at is None else at, "yyyyMMdd_HHmmss_SSSSSS"), F.lit(suffix))


def age_hours(at: Column, now: Column | None = None) -> Column:
    return ((F.current_timestamp() if now is None else now).cast("timestamp").cast("double") - at.cast("timestamp").cast("double")) / 3600


def task_count(jobid: Column) -> Column:
    """Tasks that an array job's id stands for: id_[a-b] has b - a + 1; every other form, readable or not, has one."""
    low = F.regexp_extract(jobid, r"_\[(\d+)-(\d+)\]$", 1).try_cast("bigint")
    high = F.regexp_extract(jobid, r"_\[(\d+)-(\d+)\]$", 2).try_cast("bigint")
    return F.coalesce(high - low + 1, F.lit(1).cast("bigint"))


def array_range(tasks: Column) -> Column:
    return F.when(tasks <= 1, F.lit("0")).otherwise(F.concat(F.lit("0-"), (tasks - 1).cast("string")))


def parse_selection(text: str) -> list[tuple[int, int]]:
    """"1,3-5,7:9" as inclusive ranges. A part with a dash is split there, else at a colon; other than two whole numbers raise ValueError."""
    out = []
    for part in text.split(","):
        ends = part.strip().split("-" if "-" in part else ":") if "-" in part or ":" in part else [part, part]
        if len(ends) != 2:
            raise ValueError(f"not a range: {part!r}")
        out.append((int(ends[0]), int(ends[1])))
    return out


def selected_numbers(text: str, below: int) -> list[int]:
    """The numbers of a selection in order, each once, without those that are not below a bound; for reports, as selected() needs no list."""
    return sorted({i for low, high in parse_selection(text) for i in range(max(low, 0), min(high, below - 1) + 1)})


def selected(index: Column, text: str) -> Column:
    out = F.lit(False)
    for low, high in parse_selection(text):
        out = out | index.between(low, high)
    return out
