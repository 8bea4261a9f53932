"""Explicit schemas: no source is read with inference."""

TAP = "time timestamp_ntz, stationID int, deviceID int, status int"

# The day column of the folders that ``write_taps`` makes.
TAP_DAY = "record_day"

SLOT = (
    "stationID int, hour int, minute int, inNums bigint, outNums bigint, day int, week int, weekend int, "
    "nuni_deviceID_of_stationID bigint, nuni_deviceID_of_stationID_hour bigint, "
    "nuni_deviceID_of_stationID_hour_minute bigint, day_since_first int, date date"
)

FLOW_IN = "stationID int, time timestamp_ntz, inNums bigint"
FLOW_OUT = "stationID int, time timestamp_ntz, outNums bigint"

FORECAST = (
    "stationID int, startTime timestamp_ntz, endTime timestamp_ntz, "
    "inNums double, outNums double"
)
HOUR_FORECAST = "stationID int, hour int, inNums double, outNums double"

STATION = (
    "stationID int, lineID int, linePos int, start_time string, start_time2 string, "
    "end_time string, end_time2 string"
)

FORECAST_COLUMNS = ("stationID", "startTime", "endTime", "inNums", "outNums")
HOUR_FORECAST_COLUMNS = ("stationID", "hour", "inNums", "outNums")
FLOWS = ("inNums", "outNums")
SLOT_KEYS = ("stationID", "date", "hour", "minute")
HOUR_KEYS = ("stationID", "date", "hour")
