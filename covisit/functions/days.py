"""Day labels (yyyyMMdd) on the driver: a handful of literals, so that scans can prune."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

LABEL_FORMAT = "%Y%m%d"  # fixed value: the partition label


def parse_day(label: str) -> date:
    """The date behind a label; anything but eight digits naming a real day is refused."""
    if not re.fullmatch(r"[0-9]{8}", label):
        raise ValueError(f"not a yyyyMMdd day: {label!r}")
    try:
        return datetime.strptime(label, LABEL_FORMAT).date()
    except ValueError:
        raise ValueError(f"not a yyyyMMdd day: {label!r}") from None


def trailing_days(end: str | None = None, days: int = 7) -> list[str]:
    """The ``days`` labels that end at ``end`` (today by default), oldest first."""
    if days < 1:
        raise ValueError(f"days must be at least 1, not {days}")
    last = parse_day(end) if end else date.today()
    return [(last - timedelta(days=back)).strftime(LABEL_FORMAT) for back in reversed(range(days))]
