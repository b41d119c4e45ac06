"""Fixed vocabularies, bounds and thresholds that results depend on.

Everything here is a plain value; operators take them as default arguments so a
caller can pass their own lists.
"""

# --- fixed values: coordinate bounds of the metropolitan area -----------------
LAT_BOUNDS = (14.0, 15.0)
LON_BOUNDS = (120.5, 121.5)

# --- fixed values: text markers read as "missing" -----------------------------
NA_MARKERS = ("na",)
GENDER_NA_MARKERS = ("Nan", "", "Na")
CSV_MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: age groups -------------------------------------------------
AGE_CUT_EDGES = (0, 12, 17, 30, 50, 100)
AGE_CUT_LABELS = (
    "Child (0-12)", "Teen (13-17)", "Young Adult (18-30)",
    "Adult (31-50)", "Senior (51+)",
)
SMART_AGE_ORDER = (
    "Child", "Young Teen", "Teen", "Young Adult", "Adult", "Old", "Unknown",
)
SMART_AGE_WORDS = {
    "adult": "Adult",
    "senior": "Old",
    "adult older": "Old",
    "teen": "Teen",
    "young teen": "Young Teen",
    "young adult": "Young Adult",
    "child": "Child",
}
REPORT_AGE_ORDER = ("Child", "Teen", "Adult", "Senior")

# --- fixed values: calendar names and seasons by month 1..12 ------------------
MONTH_SHORT = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)
SEASONS = (
    "Summer", "Summer", "Fall", "Fall", "Fall", "Winter",
    "Winter", "Winter", "Spring", "Spring", "Spring", "Summer",
)
SEASONS_NORTHERN = (
    "Winter", "Winter", "Spring", "Spring", "Spring", "Summer",
    "Summer", "Summer", "Fall", "Fall", "Fall", "Winter",
)

# --- fixed values: gender display order ---------------------------------------
GENDER_ORDER = ("Female", "Male", "Unknown")

# --- fixed values: ordered city words looked for in a free-text place ---------
CITY_WORDS = (
    "manila", "quezon", "caloocan", "las piñas", "las pinas", "makati",
    "malabon", "mandaluyong", "marikina", "muntinlupa", "navotas",
    "parañaque", "paranaque", "pasay", "pasig", "pateros", "san juan",
    "taguig", "valenzuela", "antipolo",
)
CITY_SPELLINGS = {"las pinas": "Las Piñas", "paranaque": "Parañaque"}

# --- fixed values: words that rule a place out of / into the city -------------
EXCLUDED_PLACE_WORDS = (
    "caloocan", "las piñas", "las pinas", "makati", "malabon",
    "mandaluyong", "marikina", "muntinlupa", "navotas",
    "parañaque", "paranaque", "pasay", "pasig", "pateros",
    "quezon city", "qc", "san juan", "taguig", "valenzuela",
    "rizal", "bulacan", "cavite", "laguna",
)
INCLUDED_PLACE_WORDS = (
    "manila", "binondo", "ermita", "intramuros", "malate", "paco",
    "pandacan", "port area", "quiapo", "sampaloc", "san miguel",
    "san nicolas", "santa ana", "sta. ana", "santa cruz", "sta. cruz",
    "tondo", "san andres",
)

# --- fixed values: ordered keyword -> district rules of the home city ---------
HOME_CITY = "Manila"
DISTRICT_KEYWORDS = (
    ("tondo", "Tondo"),
    ("sampaloc", "Sampaloc"),
    ("san miguel", "San Miguel"),
    ("san nicolas", "San Nicolas"),
    ("sta nicolas", "San Nicolas"),
    ("malate", "Malate"),
    ("ermita", "Ermita"),
    ("quiapo", "Quiapo"),
    ("intramuros", "Intramuros"),
    ("pandacan", "Pandacan"),
    ("paco", "Paco"),
    ("port area", "Port Area"),
    ("san andres", "San Andres"),
    ("santa cruz", "Santa Cruz"),
    ("sta cruz", "Santa Cruz"),
    ("santa mesa", "Santa Mesa"),
    ("sta mesa", "Santa Mesa"),
    ("santa ana", "Santa Ana"),
    ("sta ana", "Santa Ana"),
    ("binondo", "Binondo"),
)

# --- fixed values: named venues that override every other place rule ----------
VENUE_RULES = (
    {
        "aliases": (
            "manila arena",
            "rizal memorial coliseum",
            "rizal memorial sports complex",
        ),
        "city": "Manila",
        "district": "Malate",
        "latitude": 14.562222,
        "longitude": 120.993889,
        "level": "barangay",
        "score": 1.0,
    },
)

# --- fixed values: scores and thresholds of the place matcher -----------------
KEYWORD_SCORE = 0.95
DISTRICT_ALIAS_SCORE = 0.9
TAIL_ALIAS_SCORE = 0.85
LEVEL_THRESHOLDS = {"barangay": 0.7, "district": 0.55, "city": 0.55}
HOME_FLOOR_SCORE = 0.55
FALLBACK_THRESHOLD = 0.4

# --- fixed values: cluster marker colours by cluster id -----------------------
CLUSTER_COLORS = (
    "red", "blue", "green", "purple", "orange", "darkred",
    "lightred", "beige", "darkblue", "darkgreen", "cadetblue",
)

# --- fixed values: parameter grids and defaults of the models -----------------
KMEANS_DEFAULTS = {"k": 5, "n_init": 10, "max_iter": 300, "seed": 42}
DBSCAN_DEFAULTS = {"eps": 0.01, "min_samples": 5}
DBSCAN_EPS_GRID = (0.005, 0.01, 0.015, 0.02, 0.025, 0.03)
DBSCAN_EPS_GRID_WIDE = (
    0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08, 0.10, 0.12, 0.15,
)
DBSCAN_MIN_SAMPLES_GRID = (3, 5, 7, 10)
DBSCAN_FALLBACK = {"eps": 0.05, "min_samples": 3}
POISSON_GRID = {"alpha": (0.1, 0.5, 1.0, 2.0), "max_iter": (100, 200)}
POISSON_GRID_WIDE = {"alpha": (0.0, 0.1, 0.5, 1.0, 2.0), "max_iter": (100, 200, 500)}
GBT_GRID = {
    "n_estimators": (50, 100), "learning_rate": (0.05, 0.1), "max_depth": (5, 7),
}
GBT_GRID_WIDE = {
    "n_estimators": (50, 100, 200), "learning_rate": (0.01, 0.05, 0.1),
    "max_depth": (3, 5, 7), "min_samples_split": (2, 5, 10),
}
#: Most values of a column that a count map holds.
MAP_CATEGORIES = 1000
PANEL_FEATURES = ("latitude", "longitude", "year", "prev_count", "age")
R2_VERDICTS = ((0.3, "strong"), (0.15, "moderate"))
