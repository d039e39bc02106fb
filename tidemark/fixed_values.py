"""Fixed values of the wire and table formats.

Everything here must keep exactly this spelling for messages and tables to be
readable by existing producers and consumers.
"""

# Event types.
TYPE_STATUS = "dimo.status"
TYPE_FINGERPRINT = "dimo.fingerprint"
TYPE_EVENTS = "dimo.events"
TYPE_SIGNALS = "dimo.signals"
TYPE_RAW_STATUS = "dimo.raw.status"
TYPE_ATTESTATION = "dimo.attestation"
TYPE_TOMBSTONE = "dimo.tombstone"
CONNECTION_TYPES = (TYPE_STATUS, TYPE_FINGERPRINT, TYPE_EVENTS, TYPE_SIGNALS, TYPE_RAW_STATUS)
ATTESTATION_PREFIXES = ("dimo.raw.", "dimo.document.")

# Message header names.
HEADER_VOIDS_ID = "din-voids-id"
HEADER_DATA_INDEX_KEY = "din-data-index-key"

# Routing.
ROUTE_ROOT = "in.raw"

# Header rules.
CONTENT_TYPES = ("application/json", "image/png", "image/jpeg", "application/pdf")
DEFAULT_CONTENT_TYPE = "application/json"
DEFAULT_SPEC_VERSION = "1.0"
MAX_HEADER_BYTES = 8192
MAX_REASON_BYTES = 512
ALLOWED_SKEW_SECONDS = 300
SPLIT_THRESHOLD_BYTES = 1 << 20
BLOB_PREFIX = "cloudevent/blobs/"

# Signal names and the coordinate window.
SIGNAL_LATITUDE = "currentLocationLatitude"
SIGNAL_LONGITUDE = "currentLocationLongitude"
SIGNAL_HDOP = "dimoAftermarketHDOP"
SIGNAL_LOCATION = "currentLocationCoordinates"
COORDINATE_WINDOW_MICROS = 500_000

# Sealed payload prefix.
SEAL_MAGIC = "DBE1"

# Table defaults.
CODECS = ("zstd", "lz4", "snappy", "uncompressed")
DEFAULT_CODEC = "snappy"
RETENTION_SECONDS = 72 * 3600
STALENESS_SECONDS = 3600
ORPHAN_SECONDS = 7 * 24 * 3600
DELETE_THRESHOLD = 0.5
FILES_PER_SNAPSHOT = 2000
MERGE_HARD_CEILING = 1000
MERGE_FALLBACK = 256
MERGE_BUDGET_FRACTION = 0.5

# Report thresholds.
CYCLE_STALLED_SECONDS = 2700
SNAPSHOT_AGE_ALERT_SECONDS = 233280
BACKLOG_FILES_THRESHOLD = 20000
PENDING_ROWS_THRESHOLD = 100000
