"""Table definitions by layer: columns, keys, foreign keys, defaults and endpoints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Type words of the definitions, and of the SQL-style names users pass to create_table.
TYPES: dict[str, T.DataType] = {
    "key": T.LongType(), "int": T.IntegerType(), "bigint": T.LongType(), "real": T.DoubleType(),
    "double": T.DoubleType(), "text": T.StringType(), "string": T.StringType(), "ts": T.TimestampType(),
    "timestamp": T.TimestampType(), "date": T.DateType(), "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "integer": T.IntegerType(), "varchar": T.StringType(), "float": T.DoubleType(), "datetime": T.TimestampType(),
    "texts": T.ArrayType(T.StringType()), "counts": T.MapType(T.StringType(), T.LongType()),
    "names": T.MapType(T.StringType(), T.StringType()),
}

# Table, column and type names, and which columns must be filled (!).
_WHERE = "location text!; country_name text!; country_code text!; country_key key!; circuit_key key!; circuit_short_name text!"
_LANDED = "_extracted_at ts!; _endpoint text!"
_SAMPLE = "session_key key!; meeting_key key!; driver_number int!; date ts!"

_RAW = {
    "raw_meetings": ("meeting_key", f"meeting_key key!; meeting_name text!; meeting_official_name text; {_WHERE}; "
                     f"date_start ts!; gmt_offset text!; year int!; {_LANDED}"),
    "raw_sessions": ("session_key", f"session_key key!; session_name text!; session_type text!; meeting_key key!; {_WHERE}; "
                     f"date_start ts!; date_end ts; gmt_offset text!; year int!; {_LANDED}"),
    "raw_drivers": ("session_key driver_number", "session_key key!; meeting_key key!; driver_number int!; broadcast_name text!; "
                    "country_code text!; first_name text!; full_name text!; headshot_url text; last_name text!; "
                    f"name_acronym text!; team_colour text!; team_name text!; year int!; {_LANDED}"),
    "raw_laps": ("session_key driver_number lap_number", "session_key key!; meeting_key key!; driver_number int!; "
                 "lap_number int!; date_start ts!; duration_sector_1 real; duration_sector_2 real; duration_sector_3 real; "
                 "i1_speed int; i2_speed int; is_pit_out_lap bool; lap_duration real; st_speed int; year int!; "
                 f"{_LANDED}"),
    "raw_car_data": ("session_key driver_number date", f"{_SAMPLE}; brake int; drs int; n_gear int; rpm int; speed int; "
                     f"throttle int; year int!; {_LANDED}"),
    "raw_position": ("session_key driver_number date", f"{_SAMPLE}; position int!; year int!; {_LANDED}"),
    "raw_pit": ("session_key driver_number lap_number", f"{_SAMPLE}; lap_number int!; pit_duration real!; year int!; {_LANDED}"),
    "raw_weather": ("session_key date", "session_key key!; meeting_key key!; date ts!; air_temperature real; humidity int; "
                    "pressure real; rainfall int; track_temperature real; wind_direction int; wind_speed real; "
                    f"year int!; {_LANDED}"),
    "raw_intervals": ("session_key driver_number date", f"{_SAMPLE}; gap_to_leader real; interval real; year int!; {_LANDED}"),
    "raw_location": ("session_key driver_number date", f"{_SAMPLE}; x int; y int; z int; year int!; {_LANDED}"),
    "raw_stints": ("session_key driver_number stint_number", "session_key key!; meeting_key key!; driver_number int!; "
                   f"stint_number int!; lap_start int; lap_end int; compound text; tyre_age_at_start int; year int!; {_LANDED}"),
    "raw_race_control": ("session_key date message", "session_key key!; meeting_key key!; date ts!; driver_number int; "
                         f"lap_number int; category text; flag text; scope text; sector int; message text!; year int!; {_LANDED}"),
    "raw_team_radio": ("session_key driver_number date", f"{_SAMPLE}; recording_url text!; year int!; {_LANDED}"),
    "raw_overtakes": ("session_key date overtaking_driver_number overtaken_driver_number", "session_key key!; meeting_key key!; "
                      f"date ts!; overtaking_driver_number int!; overtaken_driver_number int!; position int; year int!; {_LANDED}"),
    "raw_session_result": ("session_key driver_number", "session_key key!; meeting_key key!; driver_number int!; position int; "
                           f"number_of_laps int; dnf bool; dns bool; dsq bool; year int!; {_LANDED}"),
    "raw_starting_grid": ("session_key driver_number", "session_key key!; meeting_key key!; driver_number int!; position int; "
                          f"lap_duration real; year int!; {_LANDED}"),
}

_ANALYTICS = {
    "grand_prix_results": ("result_id", "result_id text!; session_key key!; date ts!; year int!; race_round int!; grand_prix text!; circuit_name text!; "
                           "driver_number int!; driver_name text!; driver_acronym text!; team_name text!; "
                           "starting_grid_position int; final_position int; points real!=0; fastest_lap real; "
                           "total_time_penalty real!=0; total_season_points real!=0; drivers_championship_ranking int; "
                           "points_from_first real!=0; dnf bool!=false; dns bool!=false; dsq bool!=false; created_at ts!"),
    "grand_prix_performance": ("performance_id", "performance_id text!; session_key key!; date ts!; year int!; "
                               "grand_prix text!; session_name text!; driver_number int!; driver_name text!; "
                               "team_name text!; best_lap_time real; "
                               "average_lap_time real; total_pit_time real!=0; pit_stops int!=0; avg_speed real; "
                               "max_speed real; avg_throttle real; time_spent_braking_pct real; tire_compounds_used texts; "
                               "tire_stint_count int!=0; created_at ts!"),
    "driver_championship_standings": ("standing_id", "standing_id text!; year int!; race_round int!; after_race text!; "
                                      "driver_number int!; driver_name text!; team_name text!; position int!; points real!; "
                                      "points_behind_leader real!=0; points_ahead_next real!=0; wins int!=0; podiums int!=0; "
                                      "points_finishes int!=0; created_at ts!"),
}

_ML = {
    "driver_performance_features": ("feature_id", "feature_id text!; year int!; race_round int!; session_type text!; "
                                    "driver_number int!; pace_vs_teammate real; pace_vs_field real; consistency_score real; "
                                    "track_position_start int; track_position_avg real; straight_line_speed_rank int; "
                                    "cornering_speed_rank int; air_temperature real; track_temperature real; created_at ts!"),
    "race_context_features": ("context_id", "context_id text!; year int!; race_round int!; grand_prix text!; "
                              "circuit_length real; number_of_turns int; overtaking_difficulty real; "
                              "safety_car_deployments int!=0; red_flag_periods int!=0; total_race_time real; "
                              "weather_changes bool!=false; rain_probability real; created_at ts!"),
}

_METADATA = {
    "schema_metadata": ("table_name", "table_name text!; schema_version text!; description text!; data_source text!; "
                        "field_descriptions names!; field_types names!; upstream_dependencies texts; "
                        "downstream_dependencies texts; last_updated ts!; update_frequency text; created_at ts!"),
    "data_quality_metrics": ("table_name measurement_date", "table_name text!; measurement_date ts!; total_records bigint!; "
                             "null_counts counts!; completeness_score real!; duplicate_records bigint!=0; "
                             "constraint_violations bigint!=0; latest_data_timestamp ts; data_freshness_hours real; "
                             "outlier_count bigint!=0; anomaly_score real; created_at ts!"),
}

_LAKE = {
    "lake_meetings": ("meeting_key year", "meeting_key bigint; meeting_name text; meeting_official_name text; location text; "
                      "country_key bigint; country_code text; country_name text; circuit_key bigint; circuit_short_name text; "
                      "date_start ts; year int; gmt_offset text; processing_timestamp ts; data_quality_score real"),
    "lake_sessions": ("session_key", "session_key bigint; session_name text; session_type text; date_start ts; date_end ts; "
                      "gmt_offset text; meeting_key bigint; processing_timestamp ts; year int"),
    "lake_drivers": ("session_key driver_number", "driver_number int; broadcast_name text; full_name text; name_acronym text; "
                     "team_name text; team_colour text; first_name text; last_name text; headshot_url text; "
                     "country_code text; session_key bigint; processing_timestamp ts; year int"),
    "lake_laps": ("session_key driver_number lap_number date_start", "session_key bigint; driver_number int; lap_number int; "
                  "lap_duration double; lap_time double; i1_speed double; i2_speed double; st_speed double; "
                  "is_personal_best boolean; compound text; tyre_life int; fresh_tyre boolean; processing_timestamp ts; "
                  "data_completeness_score double; date_start date"),
}

LAYERS = {"raw": _RAW, "analytics": _ANALYTICS, "ml": _ML, "metadata": _METADATA, "lake": _LAKE}
PARTITION_BY = {"lake_meetings": ["year"], "lake_sessions": ["year"], "lake_drivers": ["year"], "lake_laps": ["date_start"]}

# Foreign keys of the raw layer.
_SESSION_FK = {"session_key": "raw_sessions", "meeting_key": "raw_meetings"}
FOREIGN_KEYS = {"raw_sessions": {"meeting_key": "raw_meetings"}} | {
    t: _SESSION_FK for t in _RAW if t not in ("raw_meetings", "raw_sessions")
}

# Landing endpoints and the equality filters each accepts.
ENDPOINTS = {
    "meetings": ("year", "country_name", "meeting_key"),
    "sessions": ("year", "country_name", "session_name", "session_type", "meeting_key"),
    "drivers": ("driver_number", "session_key", "meeting_key"),
    "laps": ("session_key", "driver_number", "lap_number"),
    "car_data": ("session_key", "driver_number", "date", "speed", "rpm"),
    "position": ("session_key", "driver_number", "meeting_key", "position"),
    "intervals": ("session_key", "driver_number", "interval"),
    "pit": ("session_key", "driver_number", "pit_duration"),
    "location": ("session_key", "driver_number", "date"),
    "stints": ("session_key", "driver_number", "compound"),
    "weather": ("session_key", "meeting_key"),
    "race_control": ("session_key", "driver_number", "flag", "category"),
    "team_radio": ("session_key", "driver_number"),
    "overtakes": ("session_key", "overtaking_driver_number", "overtaken_driver_number"),
    "session_result": ("session_key", "position", "driver_number"),
    "starting_grid": ("session_key", "position", "driver_number"),
}


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    keys: tuple[str, ...]
    schema: T.StructType
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        """Columns that must be filled and have no default."""
        return [f.name for f in self.schema if not f.nullable and f.name not in self.defaults]

    @property
    def foreign_keys(self) -> dict[str, str]:
        return FOREIGN_KEYS.get(self.name, {})

    @property
    def partition_by(self) -> list[str]:
        return PARTITION_BY.get(self.name, ["year"] if "year" in self.schema.names else [])


def _table(name: str, layer: str, keys: str, text: str) -> Table:
    fields, defaults = [], {}
    for item in text.split(";"):
        column, kind = item.split()
        kind, _, default = kind.partition("=")
        if default:
            defaults[column] = default
        fields.append(T.StructField(column, TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return Table(name, layer, tuple(keys.split()), T.StructType(fields), defaults)


TABLES = {n: _table(n, layer, *d) for layer, defs in LAYERS.items() for n, d in defs.items()}


def get_table(name: str) -> Table:
    if name not in TABLES:
        raise KeyError(f"table {name} is not defined")
    return TABLES[name]


def endpoint_schema(name: str) -> T.StructType:
    """What rows of a landing endpoint look like, without its two directory columns."""
    if name not in ENDPOINTS:
        raise ValueError(f"unknown endpoint {name!r}; one of {sorted(ENDPOINTS)}")
    return T.StructType([f for f in TABLES[f"raw_{name}"].schema if f.name not in ("year", "endpoint")])


def get_schema_by_layer(layer: str) -> dict[str, T.StructType]:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; one of {sorted(LAYERS)}")
    return {n: TABLES[n].schema for n in LAYERS[layer]}


def column_type(text: str) -> T.DataType:
    """The Spark type of an SQL-style column definition such as ``REAL NOT NULL``."""
    word = text.split()[0].split("(")[0].lower()
    if word not in TYPES:
        raise ValueError(f"unknown column type {text!r}")
    return TYPES[word]


def struct_of(columns: dict[str, str]) -> T.StructType:
    """A schema from column names and SQL-style definitions."""
    return T.StructType([
        T.StructField(n, column_type(d), not ("NOT NULL" in d.upper() or "PRIMARY KEY" in d.upper()))
        for n, d in columns.items()
    ])
