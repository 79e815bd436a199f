"""Schemas, table keys and fixed names."""

from __future__ import annotations

# Observable types.
AMBIENT = "ambient_condition"
ANOMALY = "anomaly"

# Event kinds as they travel in messages, and their routing keys.
LATEST = "LATEST"
NEW_ROUND = "NEW_ROUND"
NEW_DAY = "NEW_NEW_DAY"
NEW_TIME_OF_DAY = "NEW_TIME_OF_DAY"
NEW_HOURLY_OVERVIEW = "NEW_HOURLY_OVERVIEW"
NEW_HOURLY = "NEW_HOURLY"
DERIVED_OBSERVABLE = "DERIVED_OBSERVABLE"
FRONTEND = "FRONTEND"

EVENT_ROUTING = {
    LATEST: "latest.event",
    NEW_ROUND: "round.event",
    NEW_DAY: "new_day.event",
    NEW_TIME_OF_DAY: "time_of_day.event",
    NEW_HOURLY_OVERVIEW: "hourly.event",
    NEW_HOURLY: "hour.event",
    DERIVED_OBSERVABLE: "derived_observable.event",
}
FRONTEND_ROUTING = {
    LATEST: "frontend.latest",
    NEW_ROUND: "frontend.round",
    NEW_DAY: "frontend.new_day",
    NEW_TIME_OF_DAY: "frontend.time_of_day",
    NEW_HOURLY_OVERVIEW: "frontend.hourly",
}

# Fixed value: the time that stands for "never".
NEVER = "1970-01-01 00:00:01"

DDL = {
    "reading": "file_id string, round_id string, robot_id string, observable_name string, observable_id string, obs_type string, "
    "x_dim int, y_dim int, time timestamp_ntz, x int, y int, z int, value double",
    "round_counter": "round_id string, time timestamp_ntz, round_number int, is_valid_round int",
    "cycle": "id string, `from` date",
    "robot_observable": "robot_id string, observable_id string",
    "observable": "code_name string, observable_precision int",
    "cell": "x int, y int, z int, round_number int, value double, time timestamp_ntz, round_id string, day_of_production int, "
    "observable_name string, obs_type string",
    "json_reading": "coordinates array<double>, timestamp string, data double, unit string",
    "envelope": "file_content string, roundId string, robotId string, observableName string, observableId string, "
    "dimension struct<dimX:int,dimY:int>, type string, dataFile string",
    "event_message": "event_type string, roundId string, robotId string, observableName string, x_dim int, y_dim int, type string",
}

# A cell is one grid square of one lap of one observable.
CELL_KEY = ["round_id", "observable_name", "obs_type", "round_number", "x", "y", "z"]
CELL_COLUMNS = ["x", "y", "z", "round_number", "value", "time", "round_id", "day_of_production", "observable_name", "obs_type"]
SERIES_KEY = ["round_id", "observable_name", "obs_type"]

TABLE_KEYS = {
    "cells": ["round_id", "observable_name", "round_number", "x", "y", "z"],
    "latest_over_time": ["round_id", "observable_name", "x", "y", "z"],
    "latest_over_space": ["round_id", "observable_name"],
    "round_over_time": ["round_id", "observable_name", "round_number", "x", "y", "z"],
    "round_over_space": ["round_id", "observable_name", "round_number"],
    "day_over_time": ["round_id", "observable_name", "day", "x", "y"],
    "day_over_space": ["round_id", "observable_name", "day"],
    "tod_over_time": ["round_id", "observable_name", "window_start", "x", "y"],
    "tod_over_space": ["round_id", "observable_name", "window_start"],
    "hourly_overview": ["round_id", "observable_name", "time"],
    "frontend_data": ["round_id", "observable_name", "event_type", "type_of_plot"],
}

_ID = "round_id string, observable_name string, obs_type string"
_STATS = "mean double, sd double, total double"
_ALERT = (
    "kind string, round_id string, robot_id string, observable_name string, file_id string, subject string, body string, notify boolean"
)
_FAILED = "event_type string, round_id string, observable_name string, error string"
_PLACE = "value double, time timestamp_ntz, x int, y int, z int"

STORED_DDL = {
    "partials": f"{_ID}, round_number int, x int, y int, z int, value_sum double, value_count bigint, rows bigint, time_days bigint, "
    "time_seconds bigint, time_micros bigint, first_key decimal(38,0)",
    "cells": DDL["cell"],
    "latest_over_time": f"{_PLACE}, {_ID}",
    "latest_over_space": f"{_STATS}, latest_time timestamp_ntz, old_time timestamp_ntz, {_ID}",
    "round_over_time": f"{_PLACE}, {_ID}, round_number int",
    "round_over_space": f"{_STATS}, time timestamp_ntz, round_number int, {_ID}",
    "day_over_time": f"{_PLACE}, {_ID}, day int",
    "day_over_space": f"{_STATS}, time timestamp_ntz, day int, {_ID}",
    "tod_over_time": f"{_PLACE}, {_ID}, day int, time_of_day int, window_start timestamp_ntz",
    "tod_over_space": f"{_STATS}, time timestamp_ntz, day int, time_of_day int, {_ID}, window_start timestamp_ntz",
    "hourly_overview": f"{_STATS}, time timestamp_ntz, round_number int, day int, {_ID}",
    "frontend_data": "data string, event_type string, type_of_plot string, round_id string, observable_name string",
    "alerts": _ALERT,
    "coordinate_alerts": _ALERT,
    "alert_notification": "id string, robot_id string, alert_id string, notification_method_id string, user_id string, "
    "time timestamp_ntz, subject string, message string, level string, created_by string, event_type string",
    "ingest_audit": "id string, robot_id string, round_id string, url string, `from` timestamp_ntz, `to` timestamp_ntz, "
    "observable_id string, created_by string",
    "derived_triggers": "event_type string, round_id string, robot_id string, observable_name string, x_dim int, y_dim int, "
    "obs_type string, routing_key string",
    "frontend_triggers": "event_type string, round_id string, robot_id string, observable_name string, x_dim int, y_dim int, "
    "obs_type string, routing_key string",
    "failed_events": _FAILED,
    "failed_displays": _FAILED,
    "output_alerts": _ALERT,
    "quarantine": "file_id string, round_id string, robot_id string, observable_name string, line_number int, line string, reason string",
    "accepted_files": "file_id string, digest string, file_bucket int",
    "counter_changes": "round_id string, round_number int, time timestamp_ntz, is_valid_round int",
    "dim_changes": "round_id string, x_dim int, y_dim int",
    "touched_units": "round_id string, round_number int, day_of_production int, time timestamp_ntz, to_round int, to_day int, "
    "to_time timestamp_ntz",
    "unit_marks": "round_id string, observable_name string, marked_by bigint, last_round_number int, last_day int, "
    "last_time timestamp_ntz, newest_window timestamp_ntz, closed_window timestamp_ntz, was_last_round_number int, was_last_day int, "
    "was_last_time timestamp_ntz, was_newest_window timestamp_ntz, was_closed_window timestamp_ntz",
    "cell_spans": "round_id string, lap_block int, first_day int, last_day int, first_time timestamp_ntz, last_time timestamp_ntz",
    "latest_cells": f"{_PLACE}, {_ID}, round_number int",
    "new_units": "round_id string, observable_name string, lap int, day int, time timestamp_ntz, is_new_round boolean, "
    "is_new_day boolean, is_new_time_of_day boolean, is_new_hourly_overview boolean, stored_lap int, is_known_cycle boolean",
    "triggers": "event_type string, round_id string, robot_id string, observable_name string, x_dim int, y_dim int, obs_type string, "
    "routing_key string",
}
