"""Raw schemas and analysis presets for the two original data sets.

The operators never hard-code these: they are the parameters a user passes to
reproduce the original road-safety study on its own CSV extracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names and types of the city collision log (29 columns).
# ---------------------------------------------------------------------------
COLLISION_COLUMNS = [
    ("CRASH DATE", "string"), ("CRASH TIME", "string"), ("BOROUGH", "string"),
    ("ZIP CODE", "string"), ("LATITUDE", "double"), ("LONGITUDE", "double"),
    ("LOCATION", "string"), ("ON STREET NAME", "string"), ("CROSS STREET NAME", "string"),
    ("OFF STREET NAME", "string"),
    ("NUMBER OF PERSONS INJURED", "int"), ("NUMBER OF PERSONS KILLED", "int"),
    ("NUMBER OF PEDESTRIANS INJURED", "int"), ("NUMBER OF PEDESTRIANS KILLED", "int"),
    ("NUMBER OF CYCLIST INJURED", "int"), ("NUMBER OF CYCLIST KILLED", "int"),
    ("NUMBER OF MOTORIST INJURED", "int"), ("NUMBER OF MOTORIST KILLED", "int"),
    ("CONTRIBUTING FACTOR VEHICLE 1", "string"), ("CONTRIBUTING FACTOR VEHICLE 2", "string"),
    ("CONTRIBUTING FACTOR VEHICLE 3", "string"), ("CONTRIBUTING FACTOR VEHICLE 4", "string"),
    ("CONTRIBUTING FACTOR VEHICLE 5", "string"), ("COLLISION_ID", "bigint"),
    ("VEHICLE TYPE CODE 1", "string"), ("VEHICLE TYPE CODE 2", "string"),
    ("VEHICLE TYPE CODE 3", "string"), ("VEHICLE TYPE CODE 4", "string"),
    ("VEHICLE TYPE CODE 5", "string"),
]

# The eight injury / death count columns of the collision log.
COLLISION_COUNTS = [
    "NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED",
    "NUMBER OF PEDESTRIANS INJURED", "NUMBER OF PEDESTRIANS KILLED",
    "NUMBER OF CYCLIST INJURED", "NUMBER OF CYCLIST KILLED",
    "NUMBER OF MOTORIST INJURED", "NUMBER OF MOTORIST KILLED",
]

# The 23 columns kept from the national crash register, in table order.
REGISTER_COLUMNS = [
    ("ST_CASE", "int"), ("STATE", "int"), ("CITY", "int"), ("COUNTY", "int"),
    ("YEAR", "int"), ("MONTH", "int"), ("DAY", "int"), ("DAY_WEEK", "int"),
    ("HOUR", "int"), ("MINUTE", "int"), ("FATALS", "int"), ("PERSONS", "int"),
    ("PEDS", "int"), ("VE_TOTAL", "int"), ("VE_FORMS", "int"), ("ROUTE", "int"),
    ("HARM_EV", "int"), ("MAN_COLL", "int"), ("REL_ROAD", "int"), ("LGT_COND", "int"),
    ("WEATHER", "int"), ("LATITUDE", "double"), ("LONGITUD", "double"),
]

# Register cleaning rules.
REGISTER_WINDOW = (2005, 2024)
REGISTER_CRITICAL = ["STATE", "YEAR", "MONTH", "FATALS", "ST_CASE"]
REGISTER_SENTINELS = {"HOUR": [99], "MINUTE": [99]}
REGISTER_RANGES = {
    "LATITUDE": {"lo": 17.0, "hi": 77.0, "zero_is_missing": True},
    "LONGITUD": {"hi": 180.0, "zero_is_missing": True, "absolute": True},
}

# Cross-city study units, (STATE, CITY) code -> name; treated first.
CITY_CODES = {
    (36, 4170): "NYC",
    (17, 1670): "Chicago",
    (6, 1980): "LA",
    (48, 3280): "Houston",
    (42, 6540): "Philadelphia",
}
TREATED_CITY = "NYC"
CONTROL_CITIES = ["Chicago", "LA", "Houston", "Philadelphia"]
POLICY_YEAR = 2014
DID_DIVISORS = {0: 9, 1: 11}          # 2005-2013 / 2014-2024
PLACEBO_YEAR = 2010
PLACEBO_DIVISORS = {0: 5, 1: 4}       # 2005-2009 / 2010-2013
# The DiD summary's row labels.
DID_LABELS = (
    "Real DiD ({cut}) - total fatalities",
    "Real DiD ({cut}) - pedestrian fatalities",
    "Placebo DiD ({placebo_cut}) - total fatalities",
)

# Borough population table (about 2020) and the collision-log rules.
BOROUGH_POPULATION = [
    ("BRONX", 1472654),
    ("BROOKLYN", 2736074),
    ("MANHATTAN", 1694251),
    ("QUEENS", 2405464),
    ("STATEN ISLAND", 495747),
]
COLLISION_DATE_PATTERN = "MM/dd/yyyy"
COLLISION_YEAR_MIN = 2013
BOROUGH_MISSING_TOKENS = ("NULL", "0")      # cleaner rule
FACTOR_MISSING_TOKENS = ("UNSPECIFIED",)     # analysis rule
TOP_FACTORS = 15
ANOMALY_WINDOW = (2018, 2022)


def _struct(columns) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t), True) for n, t in columns])


def collision_schema() -> T.StructType:
    return _struct(COLLISION_COLUMNS)


def register_schema() -> T.StructType:
    return _struct(REGISTER_COLUMNS)
