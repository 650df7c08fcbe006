"""A small hand-made season, with the awkward cases."""

from collections.abc import Mapping

SCHEMAS = {
    "meetings": "meeting_key long, meeting_name string, circuit_short_name string, country_name string, date_start timestamp, year int",
    "sessions": "session_key long, meeting_key long, session_name string, session_type string, date_start timestamp, date_end timestamp, year int",
    "drivers": "session_key long, driver_number int, full_name string, name_acronym string, team_name string",
    "laps": "session_key long, driver_number int, lap_number int, date_start timestamp, lap_duration double, lap_time double, "
            "is_pit_out_lap boolean, i1_speed int, i2_speed int, st_speed int",
    "session_result": "session_key long, driver_number int, position int, dnf boolean, dns boolean, dsq boolean",
    "starting_grid": "session_key long, driver_number int, position int",
    "race_control": "session_key long, date timestamp, driver_number int, category string, flag string, message string",
    "pit": "session_key long, driver_number int, lap_number int, date timestamp, pit_duration double",
    "stints": "session_key long, driver_number int, stint_number int, lap_start int, lap_end int, compound string, tyre_age_at_start int",
    "car_data": "session_key long, driver_number int, date timestamp, speed int, throttle int, brake int",
    "weather": "session_key long, date timestamp, air_temperature double, track_temperature double, rainfall int",
    "position": "session_key long, driver_number int, date timestamp, position int",
}


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


class Small(Mapping):
    """Tables from Python rows; ``date`` and ``date_start`` are given as text."""

    def __init__(self, spark, **tables):
        self.spark, self.tables = spark, tables

    def __getitem__(self, name):
        schema = SCHEMAS[name]
        text = schema.replace("timestamp", "string")
        df = self.spark.createDataFrame(self.tables.get(name, []), text)
        for item in schema.split(", "):
            column, kind = item.split()
            if kind == "timestamp":
                df = df.withColumn(column, df[column].cast("timestamp"))
        return df

    def __iter__(self):
        return iter(SCHEMAS)

    def __len__(self):
        return len(SCHEMAS)


def lap(session, driver, number, start, seconds, out=False, i1=280, i2=290, st=310):
    return (session, driver, number, start, seconds, seconds, out, i1, i2, st)


def season(spark, **more):
    """Three races; the first two on one date.

    Driver 3 misses race 2 and changes team for race 3.  Driver 9 has a result but no entry.
    """
    t = {
        "meetings": [(1, "Alpha GP", "Monza", "Italy", "2023-03-05", 2023), (2, "Beta GP", "Nowhere", "Spain", "2023-03-05", 2023),
                     (3, "Gamma GP", "Monaco", "Monaco", "2023-03-19", 2023)],
        "sessions": [(11, 1, "Race", "Race", "2023-03-05 13:00:00", None, 2023), (12, 1, "Practice 1", "Practice", "2023-03-03 13:00:00", None, 2023),
                     (21, 2, "Race", "Race", "2023-03-05 18:00:00", None, 2023), (31, 3, "Race", "Race", "2023-03-19 13:00:00", None, 2023)],
        "drivers": [(s, d, f"Driver {d}", f"D{d}", team) for s in (11, 12, 21, 31) for d, team in ((1, "Red"), (2, "Red"), (3, "Blue"))
                    if (s, d) != (21, 3)],
        "session_result": [(11, 1, 1, False, False, False), (11, 2, 2, False, False, False), (11, 3, 3, False, None, False),
                           (11, 9, 4, False, False, False),
                           (21, 2, 1, False, False, False), (21, 1, 2, False, False, False),
                           (31, 3, 1, False, False, False), (31, 1, 11, True, False, False), (31, 2, None, True, False, True)],
        "starting_grid": [(11, 1, 2), (11, 2, 1), (11, 2, 5)],
        "laps": [lap(11, 1, 1, "2023-03-05 13:00:30", 91.5), lap(11, 2, 1, "2023-03-05 13:00:32", 92.4),
                 lap(11, 1, 2, "2023-03-05 13:02:02", 90.0, out=True), lap(11, 2, 2, "2023-03-05 13:02:04", None),
                 lap(31, 1, 1, "2023-03-19 13:00:30", 70.0), lap(31, 3, 1, "2023-03-19 13:00:31", 71.0)],
        "race_control": [(11, "2023-03-05 13:05:00", 1, "Other", None, "CAR 1 (D1) 5 SECOND TIME PENALTY - TRACK LIMITS"),
                         (11, "2023-03-05 13:06:00", 1, "Other", None, "10 SECOND TIME PENALTY FOR CAR 1"),
                         (11, "2023-03-05 13:07:00", 2, "SafetyCar", None, "SAFETY CAR DEPLOYED"),
                         (11, "2023-03-05 13:08:00", None, "SafetyCar", None, "SAFETY CAR DEPLOYED"),
                         (11, "2023-03-05 13:09:00", None, "safetycar", "RED", "RED FLAG")],
    }
    t["drivers"] = [(s, d, f, a, "Green" if (s, d) == (31, 3) else team) for s, d, f, a, team in t["drivers"]]
    return Small(spark, **{**t, **more})
