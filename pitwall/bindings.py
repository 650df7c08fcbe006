"""The generic star-schema test tables read as racing tables.

Weeks of orders stand for sessions, line items for timed laps and the event log for
telemetry, weather and race-control messages.  Each table is a lazy DataFrame built
only when asked for, so a query scans just the inputs and columns it uses.

Two tables feed nearly everything: the session calendar and the de-duplicated laps, which
cost a join and a de-duplication of the largest inputs.  They are written once per Spark
application to the shared folder, as the processed tables of a lake would be, and read
back with column pruning and filter pushdown.  The rest stays lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from pitwall.operators.joins import first_match
from pitwall.session import configure, work_dir
from pitwall.sources.readers import file_versions, path_exists

WEEK = 604_800
NO_TIME = 999.0  # stands for a missing lap time when ordering
TASK_BYTES = 8 << 20  # of Parquet, about 600,000 line items
FEW_TASKS = 16


def _at(seconds: str) -> Column:
    return F.expr(f"timestampadd(SECOND, CAST({seconds} AS INT), TIMESTAMP_NTZ'2018-01-07 14:00:00')")


def _week(date: str) -> Column:
    return F.expr(f"CAST(datediff(CAST({date} AS DATE), DATE'1995-01-01') AS BIGINT) div 7")


# Where each staged table of an application lies; the inputs' versions are part of the key.
_STAGED: dict[tuple, str] = {}
_SCHEMAS: dict[str, StructType] = {}


class Tables(Mapping):
    """Racing tables by name over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}

    NAMES = (
        "meetings", "sessions", "drivers", "laps", "laps_dup", "position", "session_result",
        "starting_grid", "pit", "stints", "car_data", "weather", "race_control",
    )

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, "_" + name)()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def source(self, name: str) -> DataFrame:
        """A generic test table; its schema is read once."""
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    def _staged(self, name: str, inputs: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
        """The table as written earlier in this application, else write it now."""
        versions = file_versions(self.spark, [f"{self.folder}/{i}.parquet" for i in inputs])
        key = (self.spark.sparkContext.applicationId, name, self.folder, versions)
        path = _STAGED.get(key)
        if path is None or not path_exists(self.spark, f"{path}/_SUCCESS"):
            path = work_dir(self.spark, f"staged-{name}")
            df = build()
            df.write.parquet(path)
            _STAGED[key] = path
            _SCHEMAS[path] = df.schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # calendar -----------------------------------------------------------------

    def _session_keys(self) -> DataFrame:
        return self._staged("sessions", ("orders",), lambda: (
            self.source("orders").select(_week("o_orderdate").alias("session_key")).distinct().repartition(1)  # one row a week
        ))

    def _sessions(self) -> DataFrame:
        slot = "session_key % 7"
        return self._session_keys().select(
            "session_key",
            F.expr("session_key div 7").alias("meeting_key"),
            F.expr("2018 + session_key div 56").alias("year"),
            F.expr(
                "element_at(array('Practice 1','Practice 2','Practice 3','Sprint Qualifying',"
                f"'Sprint','Qualifying','Race'), CAST({slot} AS INT) + 1)"
            ).alias("session_name"),
            F.expr(
                f"CASE WHEN {slot} <= 2 THEN 'Practice' WHEN {slot} IN (3, 5) THEN 'Qualifying' "
                f"WHEN {slot} = 4 THEN 'Sprint' ELSE 'Race' END"
            ).alias("session_type"),
            _at(f"session_key * {WEEK}").alias("date_start"),
            _at(f"session_key * {WEEK} + 7200").alias("date_end"),
        )

    def _meetings(self) -> DataFrame:
        keys = self._session_keys().select(F.expr("session_key div 7").alias("meeting_key")).distinct()
        nation = self.source("nation").select("n_nationkey", "n_name")
        return keys.join(nation, F.expr("n_nationkey = meeting_key % 25")).select(
            "meeting_key",
            F.expr("2018 + meeting_key div 8").alias("year"),
            F.expr("concat('GP ', meeting_key % 8 + 1)").alias("meeting_name"),
            F.expr(
                "CASE meeting_key % 8 WHEN 0 THEN 'Monaco' WHEN 1 THEN 'Monza' WHEN 2 THEN 'Silverstone' "
                "ELSE concat('Circuit ', meeting_key % 8 + 1) END"
            ).alias("circuit_short_name"),
            F.col("n_name").alias("country_name"),
            _at(f"meeting_key * {7 * WEEK}").alias("date_start"),
        )

    # timing -------------------------------------------------------------------

    def _dealt(self, name: str, key: str, inputs: tuple[str, ...]) -> DataFrame:
        """A table's rows dealt by the key of a join into tasks of TASK_BYTES of both sides' files, so that a task's sorts do not grow with the
        tables. Of small tables the join is left to Spark."""
        size = sum(length for _, length, _ in file_versions(self.spark, [f"{self.folder}/{i}.parquet" for i in inputs]))
        tasks = -(-size // TASK_BYTES)
        return self.source(name).repartition(tasks, key) if tasks > FEW_TASKS else self.source(name)

    def _timed(self) -> DataFrame:
        """Line items with their session, driver and lap; the other columns of laps are derived from these (``_as_laps``)."""
        both = ("orders", "lineitem")
        orders = self._dealt("orders", "o_orderkey", both).select("o_orderkey", _week("o_orderdate").alias("session_key"))
        return self._dealt("lineitem", "l_orderkey", both).join(orders, F.expr("l_orderkey = o_orderkey")).select(
            "session_key",
            F.expr("CAST(l_suppkey % 20 + 1 AS INT)").alias("driver_number"),
            F.expr("CAST((l_linenumber - 1) * 10 + l_orderkey % 10 + 1 AS INT)").alias("lap_number"),
            "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount",
            "l_returnflag", "l_linestatus", "l_linenumber",
        )

    @staticmethod
    def _as_laps(timed: DataFrame) -> DataFrame:
        return timed.withColumn("seconds", F.expr("(80000 + floor(l_extendedprice / 10)) / 1000.0D")).select(
            "session_key",
            "driver_number",
            "lap_number",
            F.expr("CASE WHEN l_quantity <> 1 THEN seconds END").alias("lap_duration"),
            F.expr("CASE WHEN l_quantity <> 1 AND l_discount <> 0 THEN seconds END").alias("lap_time"),
            F.expr("CASE WHEN l_tax <> 0 THEN 250 + l_quantity END").alias("i1_speed"),
            F.expr("260 + l_quantity").alias("i2_speed"),
            F.expr("350 - l_quantity").alias("st_speed"),
            F.expr("l_orderkey % 10 = 0").alias("is_pit_out_lap"),
            F.expr(
                "CASE l_returnflag WHEN 'A' THEN 'SOFT' WHEN 'N' THEN 'MEDIUM' WHEN 'R' THEN 'HARD' END"
            ).alias("compound"),
            F.expr("CAST(l_linenumber - 1 AS INT)").alias("tyre_life"),
            F.expr("l_linestatus = 'O'").alias("fresh_tyre"),
            _at(f"session_key * {WEEK} + lap_number * 90 + driver_number").alias("date_start"),
            "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_tax",
        )

    def _laps_dup(self) -> DataFrame:
        return self._as_laps(self._timed())

    LAP_KEYS = ("session_key", "driver_number", "lap_number")
    LAP_ORDER = ("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_tax")

    def _laps(self) -> DataFrame:
        """Rows are sorted and shuffled before the lap's columns are derived: they are half as wide then."""
        return self._staged("laps", ("orders", "lineitem"), lambda: (
            self._as_laps(first_match(self._timed(), self.LAP_KEYS, [F.desc(c) for c in self.LAP_ORDER]))
        ))

    def _drivers(self) -> DataFrame:
        pairs = self["laps"].select("session_key", "driver_number").distinct()
        return pairs.select(
            "session_key",
            "driver_number",
            F.expr("concat('Driver ', driver_number)").alias("full_name"),
            F.expr("concat('D', driver_number)").alias("name_acronym"),
            F.expr("concat('Team ', (driver_number - 1) div 2 + 1)").alias("team_name"),
        )

    def _position(self) -> DataFrame:
        samples = self["laps"].select(
            "session_key", "driver_number", "lap_number", "lap_duration",
            F.explode(F.array(F.lit(0), F.lit(1))).alias("s"),
        )
        key = F.when(F.col("s") == 0, F.coalesce("lap_duration", F.lit(NO_TIME))).otherwise(
            F.col("driver_number").cast("double")
        )
        order = W.partitionBy("session_key", "lap_number", "s").orderBy(key, "driver_number")
        return samples.select(
            "session_key",
            "driver_number",
            _at(
                f"session_key * {WEEK} + lap_number * 90 + driver_number"
                " + (driver_number * 7 + lap_number * 11) % 80 - 40 + 25 * s"
            ).alias("date"),
            F.row_number().over(order).alias("position"),
        )

    def _session_result(self) -> DataFrame:
        per_driver = (
            self["laps"].where("session_key % 7 = 6").groupBy("session_key", "driver_number")
            .agg(
                F.max("lap_number").alias("laps_done"),
                F.avg(F.coalesce("lap_duration", F.lit(NO_TIME))).alias("pace"),
            )
        )
        order = W.partitionBy("session_key").orderBy(F.desc("laps_done"), "pace", "driver_number")
        return per_driver.select(
            "session_key",
            "driver_number",
            F.row_number().over(order).alias("position"),
            (F.col("laps_done") < 35).alias("dnf"),
            F.lit(False).alias("dns"),
            F.lit(False).alias("dsq"),
        )

    def _starting_grid(self) -> DataFrame:
        best = (
            self["laps"].where("session_key % 7 = 5").groupBy("session_key", "driver_number")
            .agg(F.min(F.coalesce("lap_duration", F.lit(NO_TIME))).alias("best"))
        )
        order = W.partitionBy("session_key").orderBy("best", "driver_number")
        return best.select(
            (F.col("session_key") + 1).alias("session_key"),
            "driver_number",
            F.row_number().over(order).alias("position"),
        )

    def _pit(self) -> DataFrame:
        return self["laps"].where("is_pit_out_lap").select(
            "session_key", "driver_number", "lap_number",
            F.col("date_start").alias("date"),
            (20 + F.col("l_tax")).alias("pit_duration"),
        )

    def _stints(self) -> DataFrame:
        return self["drivers"].select(
            "session_key", "driver_number", F.explode(F.array(F.lit(1), F.lit(2))).alias("stint_number")
        ).select(
            "session_key", "driver_number", "stint_number",
            F.expr("(stint_number - 1) * 35 + 1").alias("lap_start"),
            F.expr("stint_number * 35").alias("lap_end"),
            F.expr("element_at(array('SOFT','MEDIUM','HARD'), (driver_number + stint_number) % 3 + 1)").alias("compound"),
            F.expr("(driver_number * stint_number) % 4").alias("tyre_age_at_start"),
        )

    # event log ----------------------------------------------------------------

    def _ev(self, kinds: tuple[str, ...]) -> DataFrame:
        return self.source("events").where(F.col("event_type").isin(*kinds)).select(
            F.expr("event_id % 344").alias("session_key"),
            F.expr("CAST(user_id % 20 + 1 AS INT)").alias("driver_number"),
            _at(f"(event_id % 344) * {WEEK} + (event_id div 344) % 7200").alias("date"),
            "value",
            F.expr("CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)").alias("k"),
        )

    def _car_data(self) -> DataFrame:
        return self._ev(("click", "purchase", "signup")).select(
            "session_key", "driver_number", "date",
            F.expr("CASE WHEN value < 300 THEN CAST(floor(value) AS INT) END").alias("speed"),
            F.col("k").alias("throttle"),
            F.expr("CASE WHEN k >= 70 THEN 100 ELSE 0 END").alias("brake"),
        )

    def _weather(self) -> DataFrame:
        return self._ev(("view",)).select(
            "session_key", "date",
            F.expr("(1500 + floor(value * 5)) / 100.0D").alias("air_temperature"),
            F.expr("(2500 + floor(value * 7)) / 100.0D").alias("track_temperature"),
            F.expr("CASE WHEN k >= 80 THEN 1 ELSE 0 END").alias("rainfall"),
        )

    def _race_control(self) -> DataFrame:
        return self._ev(("error",)).select(
            "session_key", "date", "driver_number",
            F.expr("CASE k % 4 WHEN 0 THEN 'SafetyCar' WHEN 2 THEN 'Other' ELSE 'Flag' END").alias("category"),
            F.expr("CASE k % 3 WHEN 0 THEN 'RED' WHEN 1 THEN 'YELLOW' END").alias("flag"),
            F.expr(
                "CASE WHEN k % 10 = 0 THEN concat(5 + k % 7, ' SECOND TIME PENALTY') ELSE 'NOTED' END"
            ).alias("message"),
        )
