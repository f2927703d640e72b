"""Names and rules the telemetry data model is defined by.

Fixed values: these must stay equal to the behaviour being reproduced
(record key, partition field, readings, type tags, topic, row cap).
"""

# --- fixed values -----------------------------------------------------------
RECORD_KEY = ("device_id", "timestamp")
READINGS = ("temperature", "pressure", "humidity")
ITEM_SCAN_CAP = 10000
TOPIC = "telemetry_data"
# sparse-row threshold = number of counted columns // 2
THRESHOLD_DIVISOR = 2
# -----------------------------------------------------------------------------

# Key of the driver-table fixture (`telemetry` view over `events`): the
# event time is a typed timestamp there instead of ISO text.
FIXTURE_KEY = ("device_id", "event_ts")
