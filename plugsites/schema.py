"""Canonical station schema and the fixed values every feed shares."""

from __future__ import annotations

from pyspark.sql import types as T

# The canonical columns, in output order.
CANONICAL = T.StructType(
    [
        T.StructField("address_additional", T.StringType()),
        T.StructField("charging_facility_type", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("commissioning_date", T.DateType()),
        T.StructField("district_city", T.StringType()),
        T.StructField("house_number", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("number_of_charging_points", T.IntegerType()),
        T.StructField("operator", T.StringType()),
        T.StructField("plug_types", T.ArrayType(T.StringType())),
        T.StructField("postal_code", T.StringType()),
        T.StructField("power_connection_capacity", T.DoubleType()),
        T.StructField("power_capacities_kw", T.ArrayType(T.DoubleType())),
        T.StructField("state", T.StringType()),
        T.StructField("street", T.StringType()),
    ]
)

# The consolidated table: as above, with lists as text and a total of points.
SITES = T.StructType(
    [
        T.StructField(
            field.name,
            {
                "number_of_charging_points": T.LongType(),
                "plug_types": T.StringType(),
                "power_capacities_kw": T.StringType(),
            }.get(field.name, field.dataType),
        )
        for field in CANONICAL.fields
    ]
)

SITE_KEY = ("latitude", "longitude")

# Plug labels of the feeds and the label each one becomes.
PLUG_LABELS = {
    "AC Typ 2 Steckdose": "Type 2 (AC)",
    "Type 2 (Socket Only)": "Type 2 (AC)",
    "Type 2 (Tethered Connector)": "Type 2 (AC)",
    "AC Typ 2 Fahrzeugkupplung": "Type 2 (AC)",
    "DC Fahrzeugkupplung Typ Combo 2 (CCS)": "CCS Combo 2 (DC)",
    "CCS (Type 2)": "CCS Combo 2 (DC)",
    "DC CHAdeMO": "CHAdeMO (DC)",
    "CHAdeMO": "CHAdeMO (DC)",
    "Tesla (Model S/X)": "Tesla Proprietary",
    "NACS / Tesla Supercharger": "Tesla Proprietary",
    "Tesla (Roadster)": "Tesla Proprietary",
    "Type 1 (J1772)": "Type 1 (AC)",
    "Type I (AS 3112)": "Type 1 (AC)",
}

# Texts that stand for "no value". UNKOWN is a spelling found in
# existing data; it is read as missing and never written.
PLACEHOLDER = "N.A"
UNKNOWN = "UNKNOWN"
MISSING_TEXT = ("N.A", "UNKNOWN", "UNKOWN", "")
MISSING_COUNT = ("N.A", "")

# Plausible ranges, bounds included.
LATITUDE_RANGE = (47.2, 55.1)
LONGITUDE_RANGE = (5.5, 15.1)
FIRST_YEAR = 2000
POINTS_RANGE = (1, 20)

# Plausible power of one plug in kW, bounds excluded.
POWER_KW_RANGE = (1.0, 1000.0)

# Reasons for which a row is set aside.
REASON_BBOX = "bbox"
REASON_YEAR = "year"
REASON_COUNT = "count_range"
REASON_NO_COORDINATES = "missing_coordinates"
REASONS = (REASON_BBOX, REASON_YEAR, REASON_COUNT, REASON_NO_COORDINATES)

# Fixed value: unreadable records tolerated by one warehouse load.
BAD_RECORD_BUDGET = 100

# Administrative levels of the boundary set and the column each one fills.
LEVEL_COLUMNS = {1: "state", 2: "district_city", 3: "city"}
