"""Fixed values that must equal the behaviour being reproduced.

Everything here is a plain value (labels, patterns, formats); no logic.
"""

# --- fixed values -----------------------------------------------------------
# Parts of a key name that mark it as sensitive (matched case-insensitively,
# as substrings).  "ip" also matches e.g. "description"; that over-match is
# part of the behaviour and kept.
SENSITIVE_KEY_PARTS = (
    "token",
    "authorization",
    "api_key",
    "password",
    "secret",
    "email",
    "ip",
    "visitor_key",
    "visitor_id",
)

# Names under which visitor / event keys are harvested from raw JSON.
VISITOR_KEY_NAMES = ("visitor_key", "visitorKey")
EVENT_KEY_NAMES = ("event_key", "eventKey")

# Object members that may hold the record list of a response, in priority order.
RECORD_CONTAINER_KEYS = ("events", "data", "items", "results")

# The two channels of the media configuration, and our source label.
CHANNELS = ("Facebook", "YouTube")
SOURCE_NAME = "video_api"

# Event time text format (three-digit fraction, zone letter) and the cleaning
# pattern for file-name parts.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
FILE_PART_UNSAFE = "[^A-Za-z0-9_.=-]+"

# Rounding scales of the gold layer.
RATE_SCALE = 6
SECONDS_SCALE = 2
HOURS_SCALE = 6
PERCENT_SCALE = 4

# Incremental ingestion defaults.
DEFAULT_LOOKBACK_DAYS = 1
DEFAULT_PAGE_SIZE = 100
WATERMARK_FIELD = "updated_at"
# ---------------------------------------------------------------------------

DATASETS = (
    "media_metadata",
    "media_stats",
    "media_stats_by_date",
    "media_engagement",
    "events",
    "visitor_stats",
)
