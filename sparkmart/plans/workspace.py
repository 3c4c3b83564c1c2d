"""Zones of one snapshot, written once under the shared folder and read back.

Every step reads the written tables of the step before, so plans stay short,
lost executors re-read files instead of replaying the run, and small tables
have exact sizes for the planner's broadcast decision.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from sparkmart import schemas as S
from sparkmart.operators import mart as M
from sparkmart.operators import serving
from sparkmart.operators import validate as V
from sparkmart.operators.rules import referenced_tables
from sparkmart.session import configure, in_parallel, scratch_folder, store
from sparkmart.sources.fixtures import BUILDERS, inject_faults
from sparkmart.sources.numbering import number_rows


class Workspace:
    """Lazily built raw, clean, quarantine and mart zones over a driver folder."""

    def __init__(self, spark: SparkSession, source: str) -> None:
        self.spark = configure(spark)
        self.source = source
        self.folder = scratch_folder(spark, "snapshot")
        self._built: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = defaultdict(Lock)

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = build()
            return self._built[name]

    def _written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        def write() -> DataFrame:
            path = f"{self.folder}/{name}"
            store(build(), path)
            return self.spark.read.parquet(path)

        return self._once(name, write)

    def raw(self, table: str) -> DataFrame:
        """Text columns and dense row numbers; the header counts as row 1."""

        def build() -> DataFrame:
            df, order = BUILDERS[table](self.spark, self.source)
            numbered = number_rows(df, order, first=2)
            return numbered.select(S.ROW_NUMBER, *S.SOURCE_COLUMNS[table])

        return self._once(f"raw/{table}", build)

    def faulted(self, table: str) -> DataFrame:
        return inject_faults(self.raw(table), table)

    def references(self, table: str) -> dict[str, DataFrame]:
        needed = referenced_tables(table)
        return dict(zip(needed, in_parallel([partial(self.clean, t) for t in needed])))

    def _validated(self, name: str, rows: Callable[[str], DataFrame], table: str) -> DataFrame:
        def build() -> DataFrame:
            raw, clean = in_parallel([partial(rows, table), partial(self.references, table)])
            return V.validate(raw, table, clean)

        return self._written(f"{name}/{table}", build)

    def validated(self, table: str) -> DataFrame:
        return self._validated("validated", self.raw, table)

    def validated_with_faults(self, table: str) -> DataFrame:
        """Faulted rows against the clean base references."""
        return self._validated("validated_faulted", self.faulted, table)

    def clean(self, table: str) -> DataFrame:
        return self._written(
            f"clean/{table}", lambda: V.route_clean(self.validated(table), table)
        )

    def quarantine(self, table: str) -> DataFrame:
        return V.route_quarantine(self.validated(table), table)

    def mart(self, table: str) -> DataFrame:
        """A mart table with its declared columns."""
        stored = self.stored_mart(table)
        return stored.drop(M.PARTITIONED[table]) if table in M.PARTITIONED else stored

    def stored_mart(self, table: str) -> DataFrame:
        """A mart table as stored; a partitioned one has its partition column as well."""
        if table not in M.PARTITIONED:
            return self._written(f"mart/{table}", lambda: self.build_mart(table))

        def write() -> DataFrame:
            path = f"{self.folder}/mart/{table}"
            store(self.build_mart(table, stored=True), path, M.PARTITIONED[table])
            return self.spark.read.schema(M.stored_columns(table)).parquet(path)

        return self._once(f"mart/{table}", write)

    def build_mart(self, table: str, **options: bool) -> DataFrame:
        """A mart table from its inputs, not stored."""
        build, inputs = M.BUILDERS[table]
        zones = {"clean": self.clean, "mart": self.mart}
        return build(*in_parallel([partial(zones[zone], name) for zone, name in inputs]), **options)

    def marts(self) -> dict[str, DataFrame]:
        """All mart tables as stored."""
        return dict(zip(S.MART_TYPES, in_parallel([partial(self.stored_mart, t) for t in S.MART_TYPES])))

    def train_frame(self) -> DataFrame:
        return serving.train_frame(self.marts())

    def predict_frame(self) -> DataFrame:
        return serving.predict_frame(self.marts())


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, source: str) -> Workspace:
    """The snapshot of a driver folder in this application."""
    key = (spark.sparkContext.applicationId, source)
    if key not in _open:
        _open[key] = Workspace(spark, source)
    return _open[key]
