"""The month a file is filed under, taken from its name."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first match in the file name gives year and month.
MONTH_IN_NAME = r"(20\d{2})-(\d{2})"


class Month(NamedTuple):
    year: int
    month: int

    @classmethod
    def parse(cls, text: str) -> Month:
        """Month from ``YYYY-MM``."""
        match = re.fullmatch(r"(\d{4})-(\d{2})", text)
        if not match or not 1 <= int(match.group(2)) <= 12:
            raise ValueError(f"Not a month in the form YYYY-MM: {text!r}")
        return cls(int(match.group(1)), int(match.group(2)))

    @property
    def text(self) -> str:
        return f"{self.year:04d}-{self.month:02d}"

    @property
    def first_day(self) -> str:
        return f"{self.text}-01"

    @property
    def day_after(self) -> str:
        """First day of the following month."""
        years, index = divmod(self.month, 12)
        return f"{self.year + years:04d}-{index + 1:02d}-01"


class MonthColumn(NamedTuple):
    """Expected month per row, held as ``YYYY-MM`` text in the column ``name``.

    The column only guides the month rule: it is left out of the cleaned rows and of duplicate
    detection. Rows where it is null are not checked.
    """

    name: str


def month_of_path(path: str) -> Month | None:
    """Month in the last part of a path, or None if there is none.

    A number pair such as ``2025-13`` is refused: it would silently mark every row.
    """
    name = str(path).rstrip("/").rsplit("/", 1)[-1]
    match = re.search(MONTH_IN_NAME, name)
    if not match:
        return None
    try:
        return Month.parse("-".join(match.groups()))
    except ValueError:
        raise ValueError(
            f"{name!r} names no valid month ({match.group(0)}); give the month explicitly"
        ) from None


def month_of_file(file_path: str) -> Month | None:
    """As :func:`month_of_path`, for a data file: files written by Spark take their folder's name."""
    folder, _, name = str(file_path).rpartition("/")
    return month_of_path(folder if name.startswith("part-") else name)


def text_in_file_path(file_path: Column) -> Column:
    """What stands for a month in a data file's path, possible or not; empty if nothing does.

    Files written by Spark (``part-...``) have random names in which the pattern can occur by
    chance; for those the folder they lie in is the name that counts.
    """
    parts = F.split(file_path, "/")
    file_name = F.element_at(parts, -1)
    folder = F.try_element_at(parts, F.lit(-2))
    name = F.when(file_name.startswith("part-"), folder).otherwise(file_name)
    # The whole match: group 0. A name without a month gives the empty string.
    return F.regexp_extract(name, MONTH_IN_NAME, 0)


def month_in_file_path(file_path: Column) -> Column:
    """Month named by a data file's path as ``YYYY-MM``, null if none or no valid month."""
    text = text_in_file_path(file_path)
    return F.when(F.concat(text, F.lit("-01")).try_cast("date").isNotNull(), text)


def resolve_month(period: str | Month | MonthColumn | None) -> Month | MonthColumn | None:
    if isinstance(period, str):
        return Month.parse(period)
    return period
