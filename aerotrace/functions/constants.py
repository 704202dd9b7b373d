"""Fixed values.

These lookup tables, vocabularies, unit factors and thresholds must equal
the values of the original telemetry system for results to match.  They
are stated here plainly, in their natural order, and nowhere else.
"""

# --- fixed values: ADS-B emitter category code -> label (live state path) ---
LIVE_CATEGORY = {
    0: "NO_INFO",
    1: "NO_ADS_B",
    2: "LIGHT",
    3: "SMALL",
    4: "LARGE",
    5: "HIGH_VORTEX",
    6: "HEAVY",
    7: "PERF_MANEUVER",
    8: "ROTORCRAFT",
    9: "GLIDER",
    10: "LIGHTER_AIR",
    11: "PARACHUTIST",
    12: "ULTRALIGHT",
    13: "RESERVED",
    14: "UAV",
    15: "SPACE",
    16: "SURFACE_EMERG",
    17: "SURFACE_SVC",
    18: "POINT_OBSTACLE",
    19: "CLUSTER_OBSTACLE",
    20: "LINE_OBSTACLE",
}
LIVE_CATEGORY_DEFAULT = "UNKNOWN"

# --- fixed values: emitter category code -> category letter code (ML feed) ---
FEED_CATEGORY = {
    2: "A1",
    3: "A2",
    4: "A3",
    5: "A4",
    6: "A5",
    7: "A6",
    8: "B1",
    9: "B2",
    10: "B3",
    11: "C1",
    12: "C2",
    14: "C3",
    15: "C4",
}
FEED_CATEGORY_DEFAULT = "A3"

# --- fixed values: category letter code -> display label (gold analytics) ---
GOLD_CATEGORY = {
    "A0": "No ADS-B emitter category",
    "A1": "Light Aircraft",
    "A2": "Small Aircraft",
    "A3": "Large Aircraft",
    "A4": "High Vortex Large",
    "A5": "Heavy Aircraft",
    "A6": "High Performance",
    "A7": "Rotorcraft",
    "B0": "No ADS-B emitter category (B)",
    "B1": "Glider / Sailplane",
    "B2": "Lighter than Air",
    "B3": "Parachutist / Sky Diver",
    "B4": "Ultralight / Hang Glider",
    "B5": "Reserved",
    "B6": "UAV / Drone",
    "B7": "Space Vehicle",
    "C0": "No ADS-B emitter category (C)",
    "C1": "Surface Vehicle - Emergency",
    "C2": "Surface Vehicle - Service",
    "C3": "Fixed Ground Obstacle",
}
GOLD_CATEGORY_DEFAULT = "Unknown category"

# --- fixed values: position source code -> label (live path) ---
POSITION_SOURCE = {0: "ADS-B", 1: "ASTERIX", 2: "MLAT", 3: "FLARM"}
POSITION_SOURCE_DEFAULT = "UNKNOWN"

# --- fixed values: vocabularies accepted by silver cleaning ---
EMERGENCY_VALUES = ["NONE", "NO", "GENERAL", "LIFEGUARD", "MINFUEL", "NORDO",
                    "UNLAWFUL", "DOWNED", "RESERVED"]
POSITION_TYPES = ["ADSB_ICAO", "MLAT", "ADSR_ICAO", "TISB_ICAO", "MODE_S", "ADSC", "OTHER"]
NON_EMERGENCY_VALUES = ["NONE", "NO", "OTHER"]
SPECIAL_SQUAWKS = {"7700": "GENERAL_EMERGENCY", "7600": "RADIO_FAILURE", "7500": "HIJACK"}

# --- fixed values: accepted inclusive ranges (silver validation) ---
MOTION_RANGES = {
    "ground_speed": (0, 1200),
    "track": (0, 360),
    "nav_heading": (0, 360),
    "nav_qnh": (800, 1100),
    "lat": (-90, 90),
    "lon": (-180, 180),
}
INTEGRITY_RANGES = {
    "nic": (0, 11),
    "nac_p": (0, 11),
    "nac_v": (0, 4),
    "sil": (0, 3),
    "gva": (0, 2),
    "sda": (0, 3),
    "version": (0, 2),
}

# --- fixed values: null-backfill defaults (silver step 1) ---
CATEGORICAL_DEFAULTS = {
    "position_type": "other",
    "flight": "UNKNOWN",
    "squawk": "0000",
    "emergency": "none",
    "category": "A0",
    "sil_type": "unknown",
}
BOOLEAN_FLAGS = ["is_stale", "is_new_leg", "is_geom_rate", "is_geom_alt"]

# --- fixed values: backfill field groups ---
STABLE_IDENTITY_FIELDS = ["registration", "aircraft_type", "description", "db_flags"]
SEMI_STABLE_FIELDS = ["squawk", "emergency", "category", "position_type",
                      "nav_altitude_mcp", "nav_altitude_fms", "nav_heading", "nav_qnh"]
CONTINUOUS_FIELDS = ["lat", "lon", "alt_geom", "ground_speed", "track", "vert_rate",
                     "geom_vert_rate", "ias", "nav_heading"]

# --- fixed values: trace flag bits ---
FLAG_BITS = {"is_stale": 1, "is_new_leg": 2, "is_geom_rate": 4, "is_geom_alt": 8}

# --- fixed values: unit factors ---
M_TO_FT = 3.28084
MS_TO_KMH = 3.6
MS_TO_KNOTS = 1.94384
MS_TO_FPM = 196.85
EARTH_RADIUS_KM = 6371.0

# --- fixed values: thresholds ---
ALTITUDE_BANDS_FT = [(10000, "LOW"), (25000, "MEDIUM"), (40000, "HIGH")]
PHASE_RATE_MS = 2.5
CLIMB_RATE_FPM = 300
ANOMALY_THRESHOLD = 5.0
SEQUENCE_LENGTH = 32
WHOLE_SERIES_ROWS = 100_000  # an aircraft with more reports is scanned in chunks
RETENTION_DAYS = 30
FEED_NIC = 8
FEED_SIL = 3

# --- fixed values: anomaly score scaling, in tie-break order ---
REASON_SCALES = [
    ("POSITION", "position_error_km", 1.0),
    ("ALTITUDE", "altitude_error_ft", 1000.0),
    ("SPEED", "ground_speed_error", 100.0),
    ("VERTICAL_RATE", "vert_rate_error", 1000.0),
    ("TRACK", "track_error", 1.0),
]

# --- fixed values: next-state model inputs and targets ---
FEATURE_COLUMNS = ["lat", "lon", "resolved_altitude", "ground_speed", "resolved_vert_rate",
                   "track_sin", "track_cos", "nic", "nac_p", "nac_v", "sil"]
TARGET_COLUMNS = ["next_lat", "next_lon", "next_altitude", "next_ground_speed",
                  "next_vert_rate", "next_track_sin", "next_track_cos"]
SEQUENCE_FIELDS = ["lat", "lon", "resolved_altitude", "ground_speed", "resolved_vert_rate",
                   "track_sin", "track_cos"]
GBT_PARAMS = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "seed": 42}

# --- fixed values: callsign classes, first match counts ---
CALLSIGN_CLASSES = {
    "AIRLINE": "^[A-Z]{2,3}[0-9].*",
    "GENERAL_AVIATION": "^[A-Z0-9]{2,7}$",
}
CALLSIGN_MISSING = "UNKNOWN"
CALLSIGN_DEFAULT = "OTHER"

# --- fixed values: signal integrity classes, least values of each, first match counts ---
INTEGRITY_CLASSES = {
    "HIGH": {"nic": 8, "nac_p": 8, "sil": 2},
    "MEDIUM": {"nic": 5, "nac_p": 5},
}
INTEGRITY_DEFAULT = "LOW"

# --- fixed values: barometric altitude text of an aircraft on the ground ---
ON_GROUND_ALTITUDE = "ground"
