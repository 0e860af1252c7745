"""The given tables of one folder, and the frames that Spark derives from them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.session import for_fleet
from checks.sqltext import SIDES, fixtures, reached, with_clause
from fleetschema.operators import graph
from fleetschema.operators.snapshots import fan_out_model
from fleetschema.plans import migration
from fleetschema.sources.catalog import RELATIONS, shaped
from fleetschema.staging import new_folder, stage

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SNAPSHOTS = [f"{side}_{kind}" for side in ("target", "current") for kind in (*migration.KINDS, "depends")]
#: fixtures that several others read: written once and read from there
SHARED = {"fx_tables", "fx_columns", *(f"{x}_{kind}" for x in SIDES for kind in ("tables", "columns", "constraints", "indexes", "views", "depends"))}
_ENVS: dict[tuple[str, str], "Env"] = {}


def env(spark: SparkSession, sf_dir: str) -> "Env":
    """One per application and folder, so that derived tables are written once."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _ENVS:
        _ENVS[key] = Env(for_fleet(spark), str(sf_dir))
    return _ENVS[key]


class Env:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._staged: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}
        self._locks: dict[str, Lock] = defaultdict(Lock)
        self.snapshots = _Lazy(self.fixture, SNAPSHOTS)
        self.diffs = _Lazy(self._difference, (*migration.DIFFS, "altered"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, body: str, but: str = "") -> DataFrame:
        """Fixture SQL over the given tables; shared fixtures other than ``but`` are read as written."""
        files = {t: f"SELECT * FROM parquet.`{Path(self.sf_dir).resolve()}/{t}.parquet`" for t in TABLES}
        shared = SHARED - {but}
        written = {n: self._folder(n) for n in sorted(reached(body, fixtures(), shared) & shared)}
        return self.spark.sql(with_clause(body, {**files, **fixtures(), **{n: f"SELECT * FROM parquet.`{f}`" for n, f in written.items()}}))

    def _folder(self, name: str) -> str:
        self.fixture(name)
        return self._folders[name]

    def staged(self, name: str, make) -> DataFrame:
        """One thread writes a table, others that ask for it wait."""
        with self._locks[name]:
            if name not in self._staged:
                df, self._folders[name] = make(), new_folder(self.spark, name)
                self._staged[name] = stage(df, name, self._folders[name])
        return self._staged[name]

    def fixture(self, name: str) -> DataFrame:
        """A fixture view as a written table, as a catalog export would be."""
        return self.staged(name, lambda: self.sql(f"SELECT * FROM {name}", name))

    def together(self, tables: _Lazy, *names: str) -> None:
        """Tables that do not depend on each other, written at the same time."""
        with ThreadPoolExecutor(4) as jobs:
            list(jobs.map(tables.__getitem__, names))

    def _difference(self, name: str) -> DataFrame:
        if name == "altered":
            return self.staged(
                "altered", lambda: graph.altered_tables(self.diffs["columns_diff"], self.snapshots["current_tables"])
            )
        return self.staged(name, lambda: migration.difference(self.snapshots, name, self.diffs))

    def raw(self, side: str) -> dict[str, DataFrame]:
        """The raw catalog relations of one side."""
        with ThreadPoolExecutor(4) as jobs:
            made = jobs.map(lambda relation: shaped(self._relation(side, relation), relation), RELATIONS)
            return dict(zip(RELATIONS, made, strict=True))

    def _relation(self, side: str, relation: str) -> DataFrame:
        if relation == "type":  # built-in types: the same rows in every database
            followers = self.fixture(f"raw_{side}_namespace").select("db_id", F.lit(0).alias("model_id"))
            return fan_out_model(self.fixture("raw_type").withColumn("model_id", F.lit(0)), followers)
        return self.fixture(f"raw_{side}_{'texts' if relation == 'definitions' else relation}")

    def queue(self) -> DataFrame:
        return self.staged("queue", lambda: migration.phase_one(self.snapshots, self.diffs))

    def order(self) -> DataFrame:
        return migration.creation(self.snapshots, self.diffs)

    def worklist(self) -> DataFrame:
        return self.staged("worklist", self.build_worklist)

    def build_worklist(self) -> DataFrame:
        self.together(self.snapshots, *SNAPSHOTS)
        self.together(self.diffs, *migration.DIFFS[:2])
        self.together(self.diffs, *migration.DIFFS[2:])
        return migration.build_worklist(self.snapshots, self.diffs)


class _Lazy(Mapping):
    """Frames by name, made when read; ``names`` are those it goes through."""

    def __init__(self, make: Callable[[str], DataFrame], names: Iterable[str] = ()):
        self._make, self._names = make, tuple(names)

    def __getitem__(self, name: str) -> DataFrame:
        return self._make(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def __contains__(self, name) -> bool:
        return True
