"""Fixed values of the scoring model, plus the size limits of our own plans."""

# --- Fixed values: they must equal the model's for results to agree. -------------------------

EARTH_RADIUS_KM = 6371.0

MIN_MAGNITUDE = 3.0
DEFAULT_DEPTH_KM = 10.0
DEFAULT_EVENT_NAME = "Bilinmeyen Konum"
FEED_SOURCE = "AFAD"
WATERMARK = "10 minutes"

MAGNITUDE_FLOOR = 5.0
MAGNITUDE_CEILING = 7.5
DEPTH_LIMIT_KM = 40.0
DISTANCE_DECAY_KM = 75.0
MAGNITUDE_WEIGHT = 0.70
DEPTH_WEIGHT = 0.30

# magnitude at least -> severity; below the last one "Minor"
SEVERITY_STEPS = ((7.0, "Extreme"), (6.5, "Major"), (6.0, "Moderate"))
SEVERITY_OTHERWISE = "Minor"

IMPACT_WEIGHT = 0.60
BASE_RISK_WEIGHT = 0.40
LIVE_IMPACT_WEIGHT = 0.30
CHANGE_THRESHOLD = 1.0

# live risk at most -> level; above the last one "Very High"
RISK_LEVEL_STEPS = ((30.0, "Low"), (55.0, "Medium"), (75.0, "High"))
RISK_LEVEL_OTHERWISE = "Very High"

FACILITY_TYPE_SCORES = {
    "havalimani": 100,
    "liman": 90,
    "feribot_iskele": 70,
    "otogar": 65,
}
SUPPORT_WEIGHTS = {
    "hastane": 3,
    "itfaiye": 2,
    "akaryakit": 2,
    "polis": 1,
}
BUS_STATION = "otogar"
EXCLUDED_BUS_STATION_WORDS = (
    "peron",
    "durak",
    "basduragi",
    "mahalle",
    "mah",
    "hastane",
    "metro",
    "minibus",
    "dolmus",
    "toplu tasima",
    "iett",
    "otobus duragi",
    "servis duragi",
    "terminal peron",
    "servis",
)
MILITARY_WORDS = ("ana us", "hava ussu", "jet us", "komutanligi", "askeri")
PRIVATE_OR_SPECIAL_WORDS = ("deniz ucagi", "seabird", "hara havaalani")
UNNAMED_PREFIX = "İsimsiz"

# letters folded to ASCII before a name is compared
FOLD_FROM = "çğıöşüâîû"
FOLD_TO = "cgiosuaiu"

TOP_DISTRICTS = 10
TOP_FACILITIES = 3
MAX_PRIORITY_DISTANCE_KM = 100.0
LOCAL_SUPPORT_RADIUS_KM = 15.0
MULTIMODAL_RADIUS_KM = 20.0

EVENT_SAFETY_WEIGHT = 0.50
HAZARD_SAFETY_WEIGHT = 0.30
FAULT_SAFETY_WEIGHT = 0.20

ACTIVATION_WEIGHTS = {
    "affected_area_access_score": 0.50,
    "facility_safety_score": 0.25,
    "facility_type_score": 0.15,
    "multimodal_score": 0.05,
    "local_support_score": 0.05,
}

# --- Our own choices. ------------------------------------------------------------------------

# A side is broadcast only after a count shows it is no larger than this many rows.
BROADCAST_ROWS = 100_000
# The same for the pool as it meets events: a dozen numbers a row, some 50 MB in all.
POOL_ROWS = 400_000
# The same for bounds by key: two numbers a row, some 50 MB in all.
BOUND_ROWS = 1_000_000
# Most (event, facility) rows a task sorts on average: some 200 MB, so that none are spilled.
SORTED_ROWS = 1_000_000
# Pieces a hot key is split into where a shuffle on it cannot be avoided.
SALTS = 16
# Time constant of the decay of a live impact.
DECAY_HOURS = 24.0
