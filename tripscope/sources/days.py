"""A day-partitioned table of which single days can be replaced.

Every write goes to a build folder of its own, ``build=b<id>/<day>=<value>/``; a
version is a small published file that names, for each day, the build that
holds it.  Replacing a day (late or corrected trips) writes that day's folder and
a new version; no file of an earlier version is touched, so readers of it go on,
and a write that fails before it has published leaves the table as it was.
This is Spark's dynamic partition overwrite (the partitions that the new rows
belong to are the ones replaced) without deleting under a reader.

Writers that publish at the same time both get their days in: the version
number's first name counts, the others publish again on top of it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripscope.operators.prepare import write_partitioned

_VERSION = re.compile(r"/version-(\d+)-([0-9a-f]+)/")
_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


class DayTable:
    """``DayTable(spark, folder)``: nothing is read or written until asked for."""

    def __init__(self, spark: SparkSession, folder: str, day: str = "pickup_day"):
        self.spark, self.folder, self.day = spark, folder.rstrip("/"), day

    def _published(self) -> dict[int, str]:
        """Version number -> folder of its file (of several, the first by name)."""
        try:
            files = self.spark.read.text(f"{self.folder}/version-*").inputFiles()  # a listing, no job
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        names = sorted((int(m[1]), m[2]) for m in map(_VERSION.search, files) if m)
        return {n: f"{self.folder}/version-{n:08d}-{name}" for n, name in reversed(names)}

    def versions(self) -> list[int]:
        return sorted(self._published())

    def builds(self, version: int | None = None) -> dict[str, str]:
        """Day (as its folder is named) -> build, of a version (the latest)."""
        return self._builds(self._published(), version)

    def _builds(self, published: dict[int, str], version: int | None = None) -> dict[str, str]:
        if not published:
            return {}
        place = published[max(published) if version is None else version]
        return {r["day"]: r["build"] for r in self.spark.read.schema("day string, build string").json(place).collect()}

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the latest): a scan of its days' folders,
        pruned by filters on the day column."""
        builds = self.builds(version)
        if not builds:
            raise ValueError(f"no days in {self.folder}")
        paths = [f"{self.folder}/build={b}/{self.day}={d}" for d, b in sorted(builds.items())]
        return self.spark.read.option("basePath", self.folder).parquet(*paths).drop("build")

    def replace(self, rows: DataFrame, days: Iterable | None = None, dealt: bool = False) -> int:
        """Write ``rows`` as the whole new content of the days they belong to, or
        of ``days`` (other rows are left out; a day without rows ends).  Returns
        the number of the published version.  ``dealt``: the rows lie by day
        already, as those of a table stored by day do; they are not shuffled."""
        build = f"b{uuid.uuid4().hex}"
        listed = None if days is None else list(days)
        if listed is not None:
            rows = rows.where(F.col(self.day).isin(listed))
        path = f"{self.folder}/build={build}"
        write_partitioned(rows, path, [self.day], dealt=dealt)
        found = re.compile(rf"/{re.escape(self.day)}=([^/]+)/")
        written = {m[1] for f in self.spark.read.format("binaryFile").load(path).inputFiles() if (m := found.search(f))}
        gone = set() if listed is None else {_NULL_DAY if d is None else str(d) for d in listed} - written
        while True:
            seen = self._published()  # one look: the next version is made of the one it follows
            entries = {d: b for d, b in self._builds(seen).items() if d not in gone} | dict.fromkeys(written, build)
            number, name = max(seen, default=0) + 1, uuid.uuid4().hex
            place = f"{self.folder}/version-{number:08d}-{name}"
            rows_of = self.spark.createDataFrame(sorted(entries.items()), "day string, build string")
            rows_of.coalesce(1).write.json(place)
            if self._published()[number] == place:
                return number
