"""Fixed values the operators share.

These are business constants of the data set: they have to be exactly these
for results to be right, so they are stated here once, as plain text.
"""

# Event actions that make a session a converted one.
TARGET_ACTIONS = [
    "sub_car_claim_click",
    "sub_car_claim_submit_click",
    "sub_open_dialog_click",
    "sub_custom_question_submit_click",
    "sub_call_number_click",
    "sub_callback_submit_click",
    "sub_submit_success",
    "sub_car_request_submit_click",
]

# Traffic that was not paid for, and social-network ad sources.
ORGANIC_MEDIUMS = ["organic", "referral", "(none)"]
SOCIAL_SOURCES = [
    "QxAxdyPLuQMEcrdZWdWb",
    "MvfHsxITijuriZxsqZqt",
    "ISrKoXQCxqqYvAZICvjs",
    "IZEXUFLARCUMynmHNBGo",
    "PlbkrSYoHuZBWfYjYnfw",
    "gVRrcxiDQubJiljoTbGm",
]

# Country groups and device groups.
HOME_COUNTRY = "Russia"
CIS_COUNTRIES = [
    "Belarus",
    "Kazakhstan",
    "Armenia",
    "Uzbekistan",
    "Kyrgyzstan",
    "Tajikistan",
    "Moldova",
    "Azerbaijan",
]
MOBILE_CATEGORIES = ["mobile", "tablet"]

# Strings that stand for "no value".
PLACEHOLDERS = ["(Other)", "(not set)", "other"]

# Hours counted as night, and days counted as weekend (Monday is 0).
NIGHT_HOURS = [23, 0, 1, 2, 3, 4, 5]
WEEKEND_DAYS = [5, 6]
DEFAULT_HOUR = 12

# Fixed value: the car id is the last path segment under /cars/.
# (?s) lets "." cross newlines; \z is the very end of the text.
CAR_ID_PATTERN = r"(?s)/cars/(?:.*/)?([a-zA-Z0-9]+)(?:\?|\z)"
UTM_INITIAL_PATTERN = r"utm_{tag}_initial=([^&]+)"

# City market facts as (city, has_metro, population, average
# salary, cars per family), and the row used for any other city.
CITY_MARKETS = [
    ("moscow", 1, 13010000, 120000, 1.10),
    ("saint petersburg", 1, 5600000, 75000, 0.95),
    ("yekaterinburg", 1, 1544000, 54000, 0.90),
    ("krasnodar", 0, 1099000, 48000, 1.25),
    ("kazan", 1, 1308000, 45000, 0.88),
    ("samara", 1, 1173000, 42000, 0.86),
    ("nizhny novgorod", 1, 1228000, 43000, 0.82),
    ("novosibirsk", 1, 1633000, 46000, 0.85),
    ("ufa", 0, 1144000, 43500, 0.89),
    ("voronezh", 0, 1057001, 41500, 0.96),
    ("chelyabinsk", 0, 1189000, 44000, 0.92),
    ("krasnoyarsk", 0, 1187000, 51000, 1.15),
    ("rostov-on-don", 0, 1142000, 41000, 0.98),
    ("perm", 0, 1034000, 43000, 0.87),
    ("balashikha", 0, 520000, 72000, 1.12),
    ("khimki", 0, 257000, 85000, 1.15),
    ("vidnoye", 0, 82000, 70000, 1.10),
    ("zheleznodorozhny", 0, 150000, 68000, 1.08),
    ("odintsovo", 0, 135000, 88000, 1.20),
    ("mytishchi", 0, 255000, 80000, 1.14),
    ("tula", 0, 473000, 45000, 0.94),
    ("irkutsk", 0, 617000, 45000, 1.02),
    ("grozny", 0, 326000, 33000, 0.85),
    ("vladivostok", 0, 600000, 55000, 1.40),
    ("yaroslavl", 0, 577000, 40000, 0.88),
    ("sochi", 0, 432000, 47000, 1.05),
    ("tyumen", 0, 847000, 58000, 1.18),
    ("saratov", 0, 901000, 37000, 0.80),
    ("izhevsk", 0, 623000, 38500, 0.83),
    ("lipetsk", 0, 496000, 41000, 0.91),
    ("dublin", 0, 544000, 320000, 0.80),
]
CITY_DEFAULT = (0, 100000, 33000, 0.65)

# Default settings of splitting and cleaning.
SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.1
SAMPLE_SHARE = 0.2
MAX_NULL_SHARE = 0.90
MAX_CONSTANT_SHARE = 0.99
MAX_ROW_NULL_SHARE = 0.5
TOP_CATEGORIES = 20
TARGET_COLUMN = "event_value"
CLIENT_COLUMN = "client_id"
SERVICE_COLUMNS = ["session_id", "client_id", "rn"]
TECHNICAL_COLUMNS = ["session_id", "client_id", "visit_date", "visit_time"]

# Histogram buckets of the confidence monitor (upper bounds).
CONFIDENCE_BUCKETS = [0.1, 0.3, 0.5, 0.7, 0.9, 1.0]
