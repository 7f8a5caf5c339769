"""Business vocabulary.

FIXED VALUES — these strings and numbers must equal the ones of the system we
re-implement, because results (eligibility, messages, quality rules) are
compared against it. They are listed plainly and in their natural order.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values: employee reference data ---------------------------------
CONTRACT_TYPES = ["CDI", "CDD"]
TRANSPORT_MODES = [
    "Marche/running",
    "Vélo/Trottinette/Autres",
    "véhicule thermique/électrique",
    "Transports en commun",
]
WALK_MODE = "Marche/running"
BIKE_MODE = "Vélo/Trottinette/Autres"
BUSINESS_UNITS = ["Finance", "Support", "Ventes", "Marketing", "R&D"]

# --- fixed values: activities ----------------------------------------------
ACTIVITY_SOURCES = ["historical", "live"]

# --- fixed values: notification wording ------------------------------------
SPORT_EMOJI = {
    "Course à pied": "🏃",
    "Vélo": "🚴",
    "Marche": "🚶",
    "Randonnée": "🥾",
    "Natation": "🏊",
    "Escalade": "🧗",
    "Yoga": "🧘",
    "Fitness": "💪",
    "Tennis": "🎾",
}
DEFAULT_EMOJI = "🏅"
SPORT_VERB = {
    "Course à pied": "courir",
    "Vélo": "rouler",
    "Marche": "marcher",
    "Randonnée": "randonner",
    "Natation": "nager",
}
DEFAULT_VERB = "faire"
ELISION_LETTERS = "aeiouéèàâ"
UNKNOWN_EMPLOYEE_PREFIX = "Employé #"

# --- fixed values: default benefit parameters ------------------------------
DEFAULT_PARAMETERS = {
    "premium_rate": 0.05,
    "wellbeing_threshold": 15,
    "wellbeing_days": 5,
    "max_distance_walk_km": 15,
    "max_distance_bike_km": 25,
}
LOOKBACK_DAYS = 365

# --- fixed values: gold table quality suite --------------------------------
QUALITY_TOTAL_COST_RANGE = (0, 10000)
QUALITY_SALARY_RANGE = (20000, 100000)

# --- fixed values: distance reply statuses ---------------------------------
DISTANCE_OK = "ok"
DISTANCE_NOT_FOUND = "not_found"
DISTANCE_ERROR = "error"
DISTANCE_NO_KEY = "no_api_key"

# Default as-of date used by the registered queries over the driver tables
# (the events cover 1-30 January 2024).
TEST_AS_OF = dt.date(2024, 1, 31)
