"""The click window from daily maxima: a run reads one new day of actions, and small days that are already known.

The latest time of a user and item over several days is the largest of their daily ones. So each ingest day is
reduced once, to a row for each user and item, and kept; a window is the maximum over its days, and a day
that has left the window goes. Days are bucketed by user and item: however many a window has, they meet
bucket by bucket, without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from covisit.functions.days import parse_day, trailing_days
from covisit.operators.ranking import latest_time
from covisit.plans.click_window import latest_clicks
from covisit.schemas import CLICK, CLICK_CODE, conform
from covisit.sources.versions import Versions, bucketed_view

BUCKETS = 200
_KEYS = ["user_id", "creation_id"]
_DAY = T.StructType([T.StructField("p_date", T.StringType())])


class RollingClicks:
    """Daily clicks below ``path``, of one action type.

    An update is a new version (see ``sources.versions``): it fails or is put in place as a whole, and running it
    again reads nothing anew.
    """

    def __init__(self, spark: SparkSession, path: str, action_type: int = CLICK_CODE, buckets: int = BUCKETS):
        self._spark, self._versions = spark, Versions(spark, path)
        wanted = {"action_type": action_type, "buckets": buckets}
        about = self._versions.about()
        if about is None:
            self._versions.describe(wanted)
        elif about != wanted:
            raise ValueError(f"the days at {path} have {json.dumps(about)}, not {json.dumps(wanted)}")
        self._action_type, self._buckets = action_type, buckets

    def days(self) -> list[str]:
        """The days that are stored, oldest first."""
        served = self._versions.current()[1]
        return sorted(served["tables"]) if served else []

    def advance(self, action: DataFrame, end_date: str | None = None, days: int = 7, again: Sequence[str] = ()) -> list[str]:
        """Store the days of the window that ends at ``end_date``, drop all others, and give the days that were read.

        Days that are stored are not read, but for those in ``again`` (a day that was ingested anew). Each is read
        as a partition of ``action``, with a literal label.
        """
        window = trailing_days(end_date, days)
        anew = {parse_day(day).strftime("%Y%m%d") for day in again}
        with self._versions.draft() as draft:
            read = [day for day in window if day not in draft.entries or day in anew]
            for day in window:
                if day not in read:
                    draft.keep(day)
            for day in read:
                clicks = latest_clicks(action, day, 1, self._action_type)
                draft.write(clicks.repartition(self._buckets, *_KEYS), day, _KEYS, self._buckets)
            if read or set(draft.entries) != set(window):
                draft.publish()
        return read

    def window(self, end_date: str | None = None, days: int = 7) -> DataFrame:
        """``latest_clicks`` of the window, from stored days. A day that isn't stored raises ``LookupError``."""
        served = self._versions.current()[1]
        stored = served["tables"] if served else {}
        wanted = trailing_days(end_date, days)
        missing = [day for day in wanted if day not in stored]
        if missing:
            raise LookupError(f"not stored at {self._versions.path}: {', '.join(missing)}")
        rows = bucketed_view(
            self._spark, CLICK, _KEYS, self._buckets, _DAY, [((day,), f"{self._versions.path}/{stored[day]}") for day in wanted])
        return conform(latest_time(rows, _KEYS, "action_ts"), CLICK)
