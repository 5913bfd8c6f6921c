"""Names, codes, limits and lookup rows the data itself dictates.

They are part of the input contract (file column names, code lists, cleaning
limits), so they are kept together here and nowhere else.
"""

from __future__ import annotations

# --- columns of the monthly files, per service -------------------------------
YELLOW_FILE_COLUMNS = [
    ("VendorID", "int"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "int"),
    ("trip_distance", "float"),
    ("RatecodeID", "int"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "int"),
    ("fare_amount", "float"),
    ("extra", "float"),
    ("mta_tax", "float"),
    ("tip_amount", "float"),
    ("tolls_amount", "float"),
    ("improvement_surcharge", "float"),
    ("total_amount", "float"),
    ("congestion_surcharge", "float"),
    ("airport_fee", "float"),
]

GREEN_FILE_COLUMNS = [
    ("VendorID", "int"),
    ("lpep_pickup_datetime", "timestamp"),
    ("lpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "int"),
    ("trip_distance", "float"),
    ("RatecodeID", "int"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("payment_type", "int"),
    ("fare_amount", "float"),
    ("extra", "float"),
    ("mta_tax", "float"),
    ("tip_amount", "float"),
    ("tolls_amount", "float"),
    ("improvement_surcharge", "float"),
    ("total_amount", "float"),
    ("trip_type", "int"),
    ("congestion_surcharge", "float"),
]

FHV_FILE_COLUMNS = [
    ("dispatching_base_num", "string"),
    ("pickup_datetime", "timestamp"),
    ("dropOff_datetime", "timestamp"),
    ("PUlocationID", "int"),
    ("DOlocationID", "int"),
    ("SR_Flag", "int"),
    ("Affiliated_base_number", "string"),
]

# --- file column name -> table column name ------------------------------------
YELLOW_RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}

GREEN_RENAMES = {
    "VendorID": "vendor_id",
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}

FHV_RENAMES = {
    "dropOff_datetime": "dropoff_datetime",
    "PUlocationID": "pu_location_id",
    "DOlocationID": "do_location_id",
    "SR_Flag": "sr_flag",
    "Affiliated_base_number": "affiliated_base_number",
}

# --- columns of the fact table ----------------------------------------------
FACT_COLUMNS = [
    ("dwid", "string"),
    ("cab_type", "string"),
    ("fare_amount", "float"),
    ("total_amount", "float"),
    ("trip_distance", "float"),
    ("ratecode_id", "int"),
    ("vendor_id", "int"),
    ("pu_location_id", "int"),
    ("do_location_id", "int"),
    ("pickup_datetime", "timestamp"),
    ("dropoff_datetime", "timestamp"),
    ("payment_type", "int"),
    ("dispatching_base_num", "string"),
    ("affiliated_base_number", "string"),
]

# --- key columns -----------------------------------------------------------------
TRIP_KEY = ["pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id"]
PRIMARY_KEY = ["dwid", "pickup_datetime", "dropoff_datetime"]
ROW_KEY_LENGTH = 16

# --- cleaning limits and code lists -------------------------------------------
MAX_TRIP_DISTANCE = 10000
MAX_FARE_AMOUNT = 100000
RATE_CODES = [1, 2, 3, 4, 5, 6]
VENDOR_CODES = [1, 2]
SR_FLAGS = [0, 1]
UNKNOWN_PAYMENT_TYPE = 5
UNKNOWN_LOCATION = 0
UNKNOWN_BASE = "UNKNOWN"
SERVICES = ["yellow", "green", "fhv"]
METERED_SERVICES = ["yellow", "green"]

# --- holiday rules that float: which weekday of the month ------------------------
FLOATING_HOLIDAY_RULE = (
    "^(first|second|third|fourth|last)_"
    "(sunday|monday|tuesday|wednesday|thursday|friday|saturday)$"
)

# --- share of lost rows, in percent, at which a month is refused -----------------
LOSS_LIMITS = {"very_strict": 1.0, "strict": 5.0, "moderate": 10.0}

# --- lookup rows ----------------------------------------------------------------------
VENDORS = [
    (1, "Creative Mobile Technologies (CMT)"),
    (2, "Verifone Inc."),
]

PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

RATE_CODE_NAMES = [
    (1, "Standard Rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated Fare"),
    (6, "Group Ride"),
]

HOLIDAYS = [
    (1, "New Year's Day", 1, "1", "Federal", True),
    (2, "Lincoln's Birthday", 2, "12", "State (NYC)", True),
    (3, "Independence Day", 7, "4", "Federal", True),
    (4, "Veterans Day", 11, "11", "Federal", True),
    (5, "Christmas Day", 12, "25", "Federal", True),
    (6, "Martin Luther King Jr. Day", 1, "third_monday", "Federal", True),
    (7, "Presidents' Day", 2, "third_monday", "Federal", True),
    (8, "Memorial Day", 5, "last_monday", "Federal", True),
    (9, "Juneteenth National Independence Day", 6, "19", "Federal", True),
    (10, "Labor Day", 9, "first_monday", "Federal", True),
    (11, "Columbus Day", 10, "second_monday", "Federal", True),
    (12, "Thanksgiving Day", 11, "fourth_thursday", "Federal", True),
]

# --- centre point used to choose among places of the same name (lat, lon) --------
CITY_CENTRE = (40.7128, -74.0060)

# Names of the days of a week, from day 1.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
