"""Names: thresholds, years in file names, worlds of files, units of time axes."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month abbreviations in terse epoch units.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

#: How time axes write their first day, and which parts are the year, the month and the day.
EPOCHS = ((r"(?i)^\s*days? since (\d{4})-(\d{1,2})-(\d{1,2})", (1, 2, 3)), (r"(?i)^\s*days?_since_([a-z]{3})(\d{1,2}?)(\d{4})\s*$", (3, 1, 2)))

#: Names of yearly files, by world.
WORLD_FILES = {"counterfactual": r"^fwi_era5_counter_\d{4}\.nc$", "observed": r"^fwi_era5_\d{4}\.nc$"}


def file_name(world: str, year: int) -> str:
    """The name of a world's yearly file."""
    middle = {"observed": "", "counterfactual": "counter_"}
    if world not in middle:
        raise ValueError(f"unknown world {world!r}; one of {sorted(middle)}")
    return f"fwi_era5_{middle[world]}{year}.nc"


def text_of(value: Column) -> Column:
    """Attribute bytes as text, without the zeros that pad them."""
    return F.rtrim(F.regexp_replace(F.decode(value, "UTF-8"), r"\x00+$", ""))


def quantile_name(q: float) -> str:
    """p90 for 0.9; halves go to the even number."""
    return f"p{round(100 * q)}"


def quantile_label(q: Column) -> Column:
    return F.concat(F.lit("p"), F.rint(q * 100).cast("int"))


def year_of(path: Column) -> Column:
    """The first year 19xx or 20xx in the last part of a path; NULL without one."""
    year = F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"((?:19|20)\d{2})", 1)
    return F.when(year != "", year.cast("int"))


def world_of(path: Column) -> Column:
    """The world whose yearly files have such a name, else NULL."""
    return F.coalesce(*[F.when(path.rlike(pattern), world) for world, pattern in WORLD_FILES.items()])


def epoch_of(units: Column) -> Column:
    """The day of 'days since 1979-1-2' and of the terse 'days_since_Jan11900'; NULL for other units."""

    def day(pattern: str, places: tuple[int, int, int]) -> Column:
        y, m, d = (F.regexp_extract(units, pattern, k) for k in places)
        named = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(m)), F.lit(0))
        month = F.coalesce(F.lpad(named.cast("string"), 2, "0"), F.lpad(m, 2, "0"))
        # make_date would raise for what is no day
        return F.when(units.rlike(pattern), F.try_to_date(F.concat_ws("-", y, month, F.lpad(d, 2, "0")), "yyyy-MM-dd"))

    return F.coalesce(*[day(*e) for e in EPOCHS])


def epoch_day(units: str) -> dt.date | None:
    """The same for one text; None for other units."""
    for pattern, places in EPOCHS:
        if m := re.match(pattern, units):
            y, month, d = (m[k].lower() for k in places)
            return dt.date(int(y), MONTHS.index(month) + 1 if month in MONTHS else int(month), int(d))
    return None


def parse_years(spec: str) -> tuple[int, ...]:
    """'1991-1993,2018' -> (1991, 1992, 1993, 2018), sorted, each once."""
    years: set[int] = set()
    for part in spec.split(","):
        m = re.fullmatch(r"\s*(\d{4})(?:\s*-\s*(\d{4}))?\s*", part)
        if not m:
            raise ValueError(f"not a year or a range of years: {part!r}")
        first, last = int(m[1]), int(m[2] or m[1])
        if first > last:
            raise ValueError(f"{part.strip()}: the first year is after the last")
        years.update(range(first, last + 1))
    return tuple(sorted(years))


def years_in(spec: Column) -> Column:
    """The same in columns: an array of years."""
    ends = F.transform(F.split(spec, ","), lambda p: F.split(F.trim(p), r"\s*-\s*"))
    ranges = F.transform(ends, lambda e: F.sequence(F.element_at(e, 1).cast("int"), F.element_at(e, -1).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(ranges)))
