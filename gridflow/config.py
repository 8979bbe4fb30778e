"""Fixed values that results depend on.

These must equal the behaviour being reproduced; they are stated once here.
"""

# --- fixed values: billing -------------------------------------------------
BILLING_WINDOW_SIZE = 5            # readings per bill, per node
CONSUMER_RATE = 0.25               # per kWh consumed
PRODUCER_CREDIT_RATE = 0.10        # credit per kWh produced
# rates in hundredths, so cost = energy * rate / 100 stays in integer arithmetic
RATE_HUNDREDTHS = {"CONSUMER": 25, "PRODUCER": -10}

# --- fixed values: node registry ------------------------------------------
NODE_TYPES = ("PRODUCER", "CONSUMER", "ACCUMULATOR")
USER_EVENT_TYPES = ("UserRegistered", "UserUpdated", "UserDeleted")
NODE_EVENT_TYPES = ("NodeCreated", "NodeUpdated", "NodeDeleted")
MEASUREMENT_EVENT_TYPE = "MeasurementReported"
BILLING_EVENT_TYPE = "UsageRecordCreated"

# --- fixed values: streaming analytics ------------------------------------
WINDOW_DURATION = "2 minutes"
SLIDE_DURATION = "30 seconds"
WATERMARK_DELAY = "30 seconds"

# --- fixed values: device twin ---------------------------------------------
PARENT_HISTORY_DEPTH = 3           # previous parents kept, newest first
DEFAULT_PERIOD_MS = 4000           # device report period
HEARTBEAT_MULTIPLIER = 3           # silence > 3 x period means crashed
HEARTBEAT_TICK_MS = 2000           # liveness check interval
ROOT_NODE_ID = "1"                 # app messages go here; its start parent is "root"
ROOT_START_PARENT = "root"
PERIOD_COMMAND_PREFIX = "PERIOD:"
PARENT_LINE_PATTERN = r"PARENT_CHANGE:\s*([0-9a-fA-F:]+)"
MSG_LINE_PATTERN = r"MSG_SENT:\s*(\d+)"

# --- fixed values: district simulation -------------------------------------
PRODUCER_SHARE_TENTHS = 6          # first floor(0.6 * size) ranks produce
STEP_HOURS_DIVISOR = 60            # fixed-step charge adds balance / 60

# --- units -----------------------------------------------------------------
# power in centi-kW (BIGINT), time in ms (BIGINT): energy in centi-kW x ms.
MS_PER_HOUR = 3_600_000
CENTI_KW_MS_PER_KWH = 360_000_000  # 100 * 3_600_000

# --- scale parameters (not results) ----------------------------------------
# Keys with more rows than this are split into ordered sub-ranges so that no
# single task holds a hot key's whole history.
ROWS_PER_SPLIT = 2_000_000
