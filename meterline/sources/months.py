"""Month names, month windows and landing paths."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

# Fixed file name of one month's delivery, and the month in a path that holds it.
FILE_TEMPLATE = "yellow_tripdata_{month}.parquet"
MONTH_IN_PATH = r".*yellow_tripdata_(\d{4}-\d{2})\.parquet"


def validate_month(month: str) -> str:
    """``month``, if it names a month as four digits, a dash and two digits."""
    try:
        start = date.fromisoformat(f"{month}-01")
    except (TypeError, ValueError):
        start = None
    if start is None or month_name(start) != month:
        raise ValueError(f"{month!r} names no month; YYYY-MM is expected")
    return month


def month_bounds(month: str) -> tuple[date, date]:
    """Half-open window from the month's first day to the next month's first day."""
    year, number = map(int, validate_month(month).split("-"))
    years, index = divmod(number, 12)
    return date(year, number, 1), date(year + years, index + 1, 1)


def month_start(month: str) -> date:
    return month_bounds(month)[0]


def month_name(day: date) -> str:
    return f"{day:%Y-%m}"


def month_path(month: str, data_dir: str) -> str:
    return f"{str(data_dir).rstrip('/')}/raw/{FILE_TEMPLATE.format(month=validate_month(month))}"


def named_month(path: str) -> str | None:
    """The month a delivery's path names, if it does."""
    found = re.match(MONTH_IN_PATH, path)
    return found and found.group(1)


def month_starts(months: Iterable[str]) -> list[date]:
    return [month_start(m) for m in months]
