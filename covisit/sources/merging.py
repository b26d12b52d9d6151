"""A table that keeps the newest version of each key, merged a little at a time.

Rows land as runs: each ``append`` writes its rows in hash buckets of the key, sorted, and touches nothing
that is there. A key may then have a row in several runs. Two reads:

- ``eventual``: all rows of all runs, older versions included, as long as no compaction has merged them;
- ``exact``: the newest version of each key. A bucket's files of all runs come to one task, so this takes no
  shuffle, however many runs there are.

``compact`` merges the buckets that have rows in more than one run, and leaves the others alone. Runs and
compactions are versions of the table (see ``sources.versions``): readers see whole ones only, and of two
writers at a time one is told to run again.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covisit.schemas import conform
from covisit.sources.tables import file_system
from covisit.sources.versions import Draft, Versions, bucketed_view

BUCKETS = 200
_SLICE = "_bucket"
_SPEC = T.StructType([T.StructField(_SLICE, T.IntegerType()), T.StructField("_run", T.StringType())])


@dataclass(frozen=True)
class Layout:
    """``buckets`` with rows, ``touched`` ones with rows in more than one run, and ``files`` (a folder each)."""

    buckets: int
    touched: int
    files: int


class MergingTable:
    """Rows of ``schema`` below ``path``. The newest row of ``keys`` has the highest ``version``; ties go to the highest
    ``tie_break`` columns, then to the highest of the rest, so that there is one. Nulls are lowest; null keys are keys."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], version: str, tie_break: Sequence[str] = (),
        buckets: int = BUCKETS,
    ):
        self._spark, self._versions = spark, Versions(spark, path)
        self._schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self._keys, self._buckets = list(keys), buckets
        first = [version, *tie_break]
        self._order = first + [f.name for f in schema if f.name not in (*first, *keys)]
        wanted = {"schema": self._schema.jsonValue(), "keys": self._keys, "order": first, "buckets": buckets}
        about = self._versions.about()
        if about is None:
            self._versions.describe(wanted)
        elif about != wanted:
            raise ValueError(f"the table at {path} is another: {json.dumps(about)}")

    # --- reads --------------------------------------------------------------------------------------

    def _entries(self) -> dict[str, str]:
        served = self._versions.current()[1]
        return served["tables"] if served else {}

    def _rows(self, entries: dict[str, str]) -> DataFrame:
        if not entries:
            return self._spark.createDataFrame([], self._schema)
        parts = [((int(name.partition(".")[0]), name.partition(".")[2]), f"{self._versions.path}/{folder}") for name, folder in sorted(entries.items())]
        return bucketed_view(self._spark, self._schema, self._keys, self._buckets, _SPEC, parts)

    def _newest(self, rows: DataFrame) -> DataFrame:
        best = rows.groupBy(*self._keys).agg(F.max(F.struct(*self._order)).alias("_best"))
        return best.select(*(F.col(c) if c in self._keys else F.col("_best")[c].alias(c) for c in self._schema.names))

    def eventual(self) -> DataFrame:
        return self._rows(self._entries()).select(*self._schema.names)

    def exact(self) -> DataFrame:
        return self._newest(self._rows(self._entries()))

    def number(self) -> int:
        """How many versions there have been."""
        return self._versions.current()[0]

    def layout(self) -> Layout:
        runs = _runs(self._entries())
        return Layout(len(runs), sum(len(r) > 1 for r in runs.values()), sum(map(len, runs.values())))

    # --- writes --------------------------------------------------------------------------------------

    def append(self, rows: DataFrame) -> None:
        """Add a run. Its own rows of a key are merged on the way. Running it again adds nothing that a read would show."""
        with self._versions.draft() as draft:
            for name in draft.entries:
                draft.keep(name)
            spread = conform(rows, self._schema).repartition(self._buckets, *self._keys)
            self._write(self._newest(spread), draft)
            draft.publish()

    def compact(self) -> int:
        """Merge the buckets with rows in more than one run, and give their number. Others are neither read nor written."""
        with self._versions.draft() as draft:
            runs = _runs(draft.entries)
            touched = {bucket for bucket, names in runs.items() if len(names) > 1}
            if not touched:
                return 0
            for bucket in runs.keys() - touched:
                draft.keep(runs[bucket][0])
            many = {name: draft.entries[name] for bucket in touched for name in runs[bucket]}
            self._write(self._newest(self._rows(many)), draft)
            draft.publish()
        return len(touched)

    def _write(self, rows: DataFrame, draft: Draft) -> None:
        """A run in its buckets, a folder for each, so that a compaction can replace some."""
        run, scratch = draft.new_folder("run"), f"covisit_draft_{uuid.uuid4().hex}"
        at = f"{self._versions.path}/{run}"
        bucket = F.pmod(F.hash(*self._keys), F.lit(self._buckets)).alias(_SLICE)  # as Spark buckets
        (
            rows.select("*", bucket).write.format("parquet").option("path", at)
            .partitionBy(_SLICE).bucketBy(self._buckets, *self._keys).sortBy(*self._keys).saveAsTable(scratch)
        )
        self._spark.sql(f"DROP TABLE {scratch}")  # an external table: its files stay
        files, folder = file_system(self._spark, at)
        for entry in files.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith(f"{_SLICE}="):
                draft.add(f"{int(name.partition('=')[2]):06d}.{run}", f"{run}/{name}")


def _runs(entries: dict[str, str]) -> dict[int, list[str]]:
    """The entries of each bucket."""
    out = defaultdict(list)
    for name in sorted(entries):
        out[int(name.partition(".")[0])].append(name)
    return out
