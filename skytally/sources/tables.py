"""The stored tables: landing and ledger on one path, published tables on another.

Keeping the two apart lets storage permissions separate them, and the read
queries take only the published side. All are versioned: a load or a build is
seen whole or not at all, and two writers cannot overwrite each other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from skytally.functions.columns import count_where, instant
from skytally.operators.quality import landing_rules, ledger_rules, with_broken_rules
from skytally.schemas import (
    DAILY_ACTIVITY,
    HOURLY_ACTIVITY,
    INGESTION_HEALTH,
    INGESTION_RUNS,
    LANDING_TABLE,
    LEDGER_TABLE,
    OBSERVATION_KEY,
    QUARANTINE_TABLE,
    STATE_VECTORS,
    conform,
)
from skytally.session import configure
from skytally.sources.versions import Conflict, Part, Version, VersionedTable

HOURLY_TABLE = StructType(
    HOURLY_ACTIVITY.fields
    + [StructField("activity_date", DateType()), StructField("hour_of_day", IntegerType())]
)

_OUTCOME = StructField("outcome", StringType())
_ASIDE = [StructField("reason", StringType()), StructField("raw", StringType())]
LANDING_SINK = StructType(LANDING_TABLE.fields + _ASIDE + [_OUTCOME])
LEDGER_SINK = StructType(LEDGER_TABLE.fields + _ASIDE + [StructField("started_date", DateType()), _OUTCOME])

LANDED, REJECTED = "landed", "rejected"


class MartsNotBuilt(RuntimeError):
    """The published tables do not exist yet."""


class SchemaDrift(ValueError):
    """A table about to be written differs from its declared or stored schema."""


def _shape(schema: StructType) -> list[list[str]]:
    return [[f.name, f.dataType.simpleString()] for f in schema]


def require_schema(df: DataFrame, declared: StructType) -> None:
    if _shape(df.schema) != _shape(declared):
        raise SchemaDrift(f"expected {_shape(declared)}, got {_shape(df.schema)}")


def _judged(rows: DataFrame, rules: dict[str, Column], columns: StructType) -> DataFrame:
    """Adds ``outcome``, and for a row that breaks a rule the first such rule and the row as JSON."""
    judged = with_broken_rules(rows, rules)
    reason = F.get("broken_rules", F.lit(0))
    raw = F.to_json(F.struct(*[f.name for f in columns]))
    return judged.withColumns(
        {
            "reason": reason,
            "raw": F.when(reason.isNotNull(), raw),
            "outcome": F.when(reason.isNull(), LANDED).otherwise(REJECTED),
        }
    )


def _outcome(outcome: str) -> Callable[[str], bool]:
    return lambda leaf: leaf.startswith(f"outcome={outcome}/")


class Lake:
    """Landed observations, the run ledger, and what either had to set aside.

    A load is one part of a table: rows that keep the rules, and those that do
    not, in one pass and one commit. Repeating a load after a crash replaces
    its part. Writers that land the same key at the same time are settled by
    the order of their commits: the later one drops what has been landed since
    it looked.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, root = configure(spark), root.rstrip("/")
        self.observations = VersionedTable(self.spark, f"{root}/state_vectors", LANDING_SINK, "outcome", "observed_date")
        self.events = VersionedTable(self.spark, f"{root}/ingestion_runs", LEDGER_SINK, "outcome", "started_date")

    # --- landing ------------------------------------------------------------------

    def landing(
        self,
        dates: Iterable[dt.date] | None = None,
        *,
        since: dt.date | None = None,
        version: Version | None = None,
        load_id: str | None = None,
        without: str | None = None,
    ) -> DataFrame:
        """Landed rows; with ``dates`` or ``since`` only those folders are even listed.

        ``load_id`` keeps a load's rows. ``without`` leaves out the part a load
        wrote, so that it can be repeated; rows of it that were gathered with
        others since stay, and count as landed.
        """
        wanted = None if dates is None else {d.isoformat() for d in dates}

        def leaves(leaf: str) -> bool:
            day = self.observations.day_of(leaf)
            return (
                _outcome(LANDED)(leaf)
                and (wanted is None or day in wanted)
                and (since is None or day >= since.isoformat())
            )

        def parts(part: Part) -> bool:
            owner = part.facts.get("load_id")
            return (load_id is None or owner in (None, load_id)) and (without is None or owner != without)

        rows = self.observations.read(version, leaves, parts, LANDING_TABLE)
        return rows if load_id is None else rows.where(F.col("load_id") == load_id)

    def quarantine(self) -> DataFrame:
        """Rows set aside: ``(run_id, reason, raw, load_id, set_aside_date)``."""
        rows = self.observations.read(leaves=_outcome(REJECTED))
        return rows.select(
            F.col("ingestion_run_id").alias("run_id"), "reason", "raw", "load_id", F.col("observed_date").alias("set_aside_date")
        )

    def append(
        self, rows: DataFrame, load_id: str, rejected: DataFrame | None = None, seen: Version | None = None
    ) -> Version:
        """Write a load: ``rows`` that keep the rules are landed, all others are set aside.

        ``rejected`` brings ``(run_id, reason, raw, ingested_at)`` that could not become rows.
        ``seen`` is the version against which the caller has looked for landed keys.
        """
        seen = seen or self.observations.current()
        judged = _judged(rows.withColumn("load_id", F.lit(load_id)), landing_rules(), STATE_VECTORS)
        kept = F.col("outcome") == LANDED
        day = F.to_date(F.when(kept, F.col("observed_at")).otherwise(F.col("ingested_at")))
        # What is set aside is kept as its JSON alone.
        emptied = {
            f.name: F.when(kept, F.col(f.name)) for f in STATE_VECTORS if f.name not in ("ingestion_run_id", "ingested_at")
        }
        sink = conform(judged.withColumn("observed_date", day).withColumns(emptied), LANDING_SINK)
        if rejected is not None:
            aside = rejected.select(
                F.col("run_id").alias("ingestion_run_id"),
                "reason",
                "raw",
                "ingested_at",
                F.to_date("ingested_at").alias("observed_date"),
                F.lit(load_id).alias("load_id"),
                F.lit(REJECTED).alias("outcome"),
            )
            sink = sink.unionByName(aside, allowMissingColumns=True)
        return self._publish(self._written(sink, load_id), seen)

    def _written(self, sink: DataFrame, load_id: str) -> Part:
        # Rebalancing gathers each day into few files and splits a busy day over several tasks.
        spread = conform(sink, LANDING_SINK).hint("rebalance", F.col("outcome"), F.col("observed_date"))
        return self.observations.write(spread, {"load_id": load_id}, **_landing_metrics())

    def _publish(self, part: Part, seen: Version) -> Version:
        load_id = part.facts["load_id"]
        while True:
            current = self.observations.current()
            others = [p for p in current.parts if p.facts.get("load_id") != load_id]
            late = tuple(p for p in others if p.added > seen.number)
            if late:
                part, seen = self._settled(part, late), current
            try:
                return self.observations.commit(current, [*others, part])
            except Conflict:
                continue

    def _settled(self, part: Part, late: tuple[Part, ...]) -> Part:
        """The part again, without keys that ``late`` parts have landed."""
        own = {leaf for leaf in part.leaves if _outcome(LANDED)(leaf)}
        keys = self.observations.read(Version(parts=late), lambda leaf: leaf in own, schema=LANDING_TABLE)
        rows = self.observations.read(Version(parts=(part,)))
        landed, aside = rows.where(F.col("outcome") == LANDED), rows.where(F.col("outcome") == REJECTED)
        fresh = landed.join(keys.select(*OBSERVATION_KEY), list(OBSERVATION_KEY), "left_anti")
        return self._written(fresh.select(rows.columns).unionByName(aside), part.facts["load_id"])

    def changed_days(self, since: int, version: Version | None = None) -> list[dt.date]:
        """Days that versions after ``since``, up to ``version``, brought rows for."""
        days = {
            self.observations.day_of(leaf)
            for part in (version or self.observations.current()).parts
            if part.added > since
            for leaf in part.leaves
            if _outcome(LANDED)(leaf)
        }
        return sorted(dt.date.fromisoformat(day) for day in days)

    def newest_ingest(self) -> DataFrame:
        """One row, ``last_ingested_at``, from what the writers noted; no file of rows is opened."""
        noted = [p.facts.get("newest_micros") for p in self.observations.current().parts]
        newest = max((n for n in noted if n is not None), default=None)
        return self.spark.range(1).select(F.timestamp_micros(F.lit(newest).cast("bigint")).alias("last_ingested_at"))

    # --- ledger -------------------------------------------------------------------

    def ledger(self, days: Iterable[dt.date] | None = None, *, load_id: str | None = None) -> DataFrame:
        """Events of runs; with ``days``, of runs that started then."""
        wanted = None if days is None else {d.isoformat() for d in days}
        rows = self.events.read(
            leaves=lambda leaf: _outcome(LANDED)(leaf) and (wanted is None or self.events.day_of(leaf) in wanted),
            parts=lambda part: load_id is None or part.facts.get("load_id") in (None, load_id),
            schema=LEDGER_TABLE,
        )
        return rows if load_id is None else rows.where(F.col("load_id") == load_id)

    def broken_events(self) -> DataFrame:
        """Events that break a rule of the ledger, as quarantined rows."""
        rows = self.events.read(leaves=_outcome(REJECTED))
        return rows.select("run_id", "reason", "raw", "load_id", F.col("started_date").alias("set_aside_date"))

    def record(self, events: DataFrame) -> None:
        """Add events of one load and one kind; recorded again, they replace themselves."""
        judged = _judged(conform(events, LEDGER_TABLE), ledger_rules(), INGESTION_RUNS)
        dated = judged.withColumn("started_date", F.to_date("started_at"))
        part = self.events.write(
            conform(dated, LEDGER_SINK).hint("rebalance", F.col("started_date")),
            None,
            load_id=F.max("load_id"),
            first_load=F.min("load_id"),
            event=F.max("event"),
            first_event=F.min("event"),
        )
        facts = part.facts
        if (facts["load_id"], facts["event"]) != (facts.pop("first_load"), facts.pop("first_event")):
            raise ValueError("events of one load and one kind at a time")
        while True:
            current = self.events.current()
            same = ("load_id", "event")
            others = [p for p in current.parts if any(p.facts.get(k) != facts[k] for k in same)]
            try:
                self.events.commit(current, [*others, part])
                return
            except Conflict:
                continue

    def changed_starts(self, since: int) -> list[dt.date]:
        """Days whose runs have events that a version after ``since`` brought."""
        days = {
            self.events.day_of(leaf)
            for part in self.events.current().parts
            if part.added > since
            for leaf in part.leaves
            if _outcome(LANDED)(leaf)
        }
        return sorted(dt.date.fromisoformat(day) for day in days)

    # --- upkeep -------------------------------------------------------------------

    def compact(self, before: dt.date) -> None:
        """Gather the loads of every day before ``before`` into one file set a day, sorted by key."""
        closed = before.isoformat()
        self.observations.compact(
            lambda leaf: self.observations.day_of(leaf) < closed, *OBSERVATION_KEY, **_landing_metrics()
        )
        self.events.compact(lambda leaf: self.events.day_of(leaf) < closed, "run_id", "event_seq")


def _landing_metrics() -> dict[str, Column]:
    kept = F.col("outcome") == LANDED
    return {
        "rows_landed": count_where(kept),
        "rows_rejected": count_where(~kept),
        "newest_micros": F.max(F.when(kept, F.unix_micros("ingested_at"))),
    }


class Marts:
    """The published tables, the only ones the read queries open."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, root = configure(spark), root.rstrip("/")
        self.tables = {
            "airspace_activity_hourly": VersionedTable(
                self.spark, f"{root}/airspace_activity_hourly", HOURLY_TABLE, "activity_date"
            ),
            "airspace_activity_daily": VersionedTable(self.spark, f"{root}/airspace_activity_daily", DAILY_ACTIVITY),
            "ingestion_health": VersionedTable(self.spark, f"{root}/ingestion_health", INGESTION_HEALTH),
        }
        self.hourly_table, self.daily_table, self.health_table = self.tables.values()

    def _open(self, table: VersionedTable) -> DataFrame:
        version = table.current()
        if not version.number:
            raise MartsNotBuilt(f"{table.root.rsplit('/', 1)[-1]} has not been built yet")
        return table.read(version)

    def hourly(self) -> DataFrame:
        """With the day that folders are named after, so that a filter on it prunes them."""
        return self._open(self.hourly_table)

    def daily(self) -> DataFrame:
        return self._open(self.daily_table)

    def health(self) -> DataFrame:
        return self._open(self.health_table)

    def latest_hour(self) -> dt.datetime | None:
        """Newest built hour, as its writer noted it; None when nothing is built."""
        noted = [p.facts["newest_micros"] for p in self.hourly_table.current().parts]
        return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=max(noted)) if noted else None

    def publishing(self) -> tuple[float, int | None]:
        """Grid and least number of aircraft a cell, as the hourly table was built; one degree and none by default."""
        facts = self.hourly_table.current().facts
        return facts.get("grid_degrees", 1.0), facts.get("min_aircraft")

    def stored_columns(self) -> dict[str, StructType]:
        """The columns of every file there is, whoever wrote it, for the identity guard.

        The footers are read and merged by Spark; files that no version lists count too.
        """
        stored = {}
        for name, table in self.tables.items():
            if table.current().number:
                files = self.spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
                stored[name] = files.parquet(f"{table.root}/data").schema
        return stored

    def write_hourly(
        self,
        hourly: DataFrame,
        *,
        replace_all: bool,
        since: dt.datetime | None = None,
        files_per_hour: int = 1,
        grid_degrees: float = 1.0,
        min_aircraft: int | None = None,
        protected: bool = False,
        landing_version: int | None = None,
    ) -> None:
        """Replace every hour, or those from ``since`` on.

        A day is a folder; earlier hours of the first day come along from the stored
        version. A day has at most one row per hour, cell and band, so the grid bounds
        its size; ``files_per_hour`` splits it where the grid is fine.
        """
        require_schema(hourly, HOURLY_ACTIVITY)
        if not replace_all and since is None:
            raise ValueError("name the first hour to replace")
        current = self.hourly_table.current()
        facts = {
            "schema": _shape(HOURLY_TABLE),
            "grid_degrees": grid_degrees,
            "min_aircraft": min_aircraft,
            "protected": protected,
            "landing_version": landing_version,
        }
        table = hourly.withColumn("activity_date", F.to_date("activity_hour")).withColumn(
            "hour_of_day", F.hour("activity_hour")
        )
        kept: list[Part] = []
        if not replace_all:
            if current.facts.get("schema", facts["schema"]) != facts["schema"]:
                raise SchemaDrift(f"{self.hourly_table.root} holds {current.facts['schema']}, not {facts['schema']}")
            first = since.date().isoformat()
            before = self.hourly_table.read(current, lambda leaf: self.hourly_table.day_of(leaf) == first)
            table = table.unionByName(before.where(F.col("activity_hour") < instant(since)))
            kept = [
                Part(p.folder, tuple(leaf for leaf in p.leaves if self.hourly_table.day_of(leaf) < first), p.added, p.facts)
                for p in current.parts
            ]
        part = F.pmod(F.hash("grid_lat", "grid_lon"), F.lit(files_per_hour))
        # A fixed number of tasks: left to itself Spark would merge the small partitions into one.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        spread = table.repartition(tasks, "activity_date", part).sortWithinPartitions("activity_date", "activity_hour")
        made = self.hourly_table.write(spread, newest_micros=F.max(F.unix_micros("activity_hour")))
        self.hourly_table.commit(current, [*kept, made], facts)

    def write_daily(self, daily: DataFrame, facts: dict | None = None) -> None:
        require_schema(daily, DAILY_ACTIVITY)
        self._replace(self.daily_table, daily, facts)

    def write_health(self, health: DataFrame, facts: dict | None = None) -> None:
        require_schema(health, INGESTION_HEALTH)
        self._replace(self.health_table, health, facts)

    def _replace(self, table: VersionedTable, rows: DataFrame, facts: dict | None) -> None:
        current = table.current()
        table.commit(current, [table.write(rows)], facts or {})


def write_rows_json(
    rows: DataFrame, path: str, generated_at: dt.datetime, **window: int
) -> None:
    """A read query's rows as JSON lines, each with its time of creation and window."""
    stamped = rows.withColumn("generated_at", F.lit(generated_at.isoformat()))
    for name, value in window.items():
        stamped = stamped.withColumn(name, F.lit(value))
    stamped.write.mode("overwrite").json(path)
