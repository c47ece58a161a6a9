"""The three feeds, described; one generic job carries each description out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugsites.functions.plugs import pack, plausible_power, plug_label, plug_tokens
from plugsites.functions.text import (
    TextRule,
    clean_text,
    coordinate_part,
    decimal_comma,
    parse_date,
    postal_code,
)
from plugsites.operators.areas import BROADCAST_LIMIT_BYTES, AreaIndex, fill_areas
from plugsites.operators.checks import check
from plugsites.operators.missing import fill_count
from plugsites.operators.shape import rename_and_drop
from plugsites.schema import CANONICAL
from plugsites.sources.delimited import Layout

ROW_KEY = "row_key"
SOURCE = "src"


@dataclass(frozen=True)
class FeedSpec:
    name: str
    priority: int
    """Feeds with a smaller number win where several know a site."""
    layout: Layout
    renames: dict[str, str]
    drops: tuple[str, ...] = ()
    placeholders: tuple[str, ...] = ()
    text_rule: TextRule = field(default_factory=TextRule)
    plug_columns: int = 0
    """Numbered plug and power columns; 0 if plugs come as one text."""
    coordinates: str | None = None
    """Column with "lat, lon" text; None if there is a column for each."""
    numeric_postal_codes: bool = True
    unreadable_count_is_missing: bool = False
    extra: tuple[str, ...] = ()
    """Text columns kept beside the canonical ones."""


# Column names of the federal register and what they mean.
FEED_A = FeedSpec(
    name="a",
    priority=1,
    layout=Layout(sep=";", charset="ISO-8859-1", preamble=10),
    renames={
        "Betreiber": "operator",
        "Art der Ladeeinrichung": "charging_facility_type",
        "Anzahl Ladepunkte": "number_of_charging_points",
        "Nennleistung Ladeeinrichtung [kW]": "power_connection_capacity",
        "Steckertypen1": "plug_type_1",
        "Steckertypen2": "plug_type_2",
        "Steckertypen3": "plug_type_3",
        "Steckertypen4": "plug_type_4",
        "Steckertypen5": "plug_type_5",
        "Steckertypen6": "plug_type_6",
        "P1 [kW]": "power_capacity_kw_1",
        "P2 [kW]": "power_capacity_kw_2",
        "P3 [kW]": "power_capacity_kw_3",
        "P4 [kW]": "power_capacity_kw_4",
        "P5 [kW]": "power_capacity_kw_5",
        "P6 [kW]": "power_capacity_kw_6",
        "Kreis/kreisfreie Stadt": "district_city",
        "Ort": "city",
        "Postleitzahl": "postal_code",
        "Straße": "street",
        "Hausnummer": "house_number",
        "Adresszusatz": "address_additional",
        "Bundesland": "state",
        "Inbetriebnahmedatum": "commissioning_date",
        "Breitengrad": "latitude",
        "Längengrad": "longitude",
    },
    drops=(
        "Anzeigename (Karte)",
        "Public Key1",
        "Public Key2",
        "Public Key3",
        "Public Key4",
        "Public Key5",
        "Public Key6",
    ),
    text_rule=TextRule(newline=" "),
    plug_columns=6,
)

# Column names of the community map and what they mean.
FEED_B = FeedSpec(
    name="b",
    priority=2,
    layout=Layout(sep=","),
    renames={
        "AddressLine1": "street",
        "AddressLine2": "address_additional",
        "Town": "city",
        "Postcode": "postal_code",
        "Latitude": "latitude",
        "Longitude": "longitude",
        "ConnectionType": "plug_types",
        "UsageType": "usage_type",
        "NumberOfPoints": "number_of_charging_points",
        "StatusType": "status_type",
        "DateCreated": "commissioning_date",
        "Operator": "operator",
    },
    drops=(
        "ID",
        "UUID",
        "LocationTitle",
        "Distance",
        "DistanceUnit",
        "Addr_ContactTelephone1",
        "Addr_ContactTelephone2",
        "Addr_ContactEmail",
        "Addr_AccessComments",
        "Addr_GeneralComments",
        "Addr_RelatedURL",
        "ChargerType",
        "GeneralComments",
        "DateLastConfirmed",
        "DateLastStatusUpdate",
        "Country",
        "StateOrProvince",
    ),
    placeholders=("state", "district_city"),
    unreadable_count_is_missing=True,
    extra=("usage_type", "status_type"),
)

# Column names of the regional open data and what they mean.
FEED_C = FeedSpec(
    name="c",
    priority=3,
    layout=Layout(sep=";"),
    renames={
        "betreiber": "operator",
        "art_der_ladeeinrichung": "charging_facility_type",
        "anzahl_ladepunkte": "number_of_charging_points",
        "nennleistung_ladeeinrichtung_kw": "power_connection_capacity",
        "steckertypen1": "plug_type_1",
        "steckertypen2": "plug_type_2",
        "steckertypen3": "plug_type_3",
        "steckertypen4": "plug_type_4",
        "p1_kw": "power_capacity_kw_1",
        "p2_kw": "power_capacity_kw_2",
        "p3_kw": "power_capacity_kw_3",
        "p4_kw": "power_capacity_kw_4",
        "kreis_kreisfreie_stadt": "district_city",
        "ort": "city",
        "postleitzahl": "postal_code",
        "strasse": "street",
        "hausnummer": "house_number",
        "adresszusatz": "address_additional",
        "inbetriebnahmedatum": "commissioning_date",
    },
    placeholders=("state",),
    text_rule=TextRule(collapse=False),
    plug_columns=4,
    coordinates="koordinaten",
    numeric_postal_codes=False,
)

FEEDS = {spec.name: spec for spec in (FEED_A, FEED_B, FEED_C)}


def transform_feed(
    raw: DataFrame,
    spec: FeedSpec,
    last_year: int | Column,
    index: AreaIndex | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Raw text table to checked canonical rows.

    Adds ``src``, ``row_key`` and ``violations``. Narrow but for the area lookup,
    which is narrow too while the boundary set may be broadcast. A raw column
    ``row_key`` identifies the rows; without one a hash of the result does.
    """
    names = [name for name in raw.columns if name != ROW_KEY]
    content = raw.na.drop(how="all", subset=names)
    named = rename_and_drop(content, spec.renames, spec.drops, spec.placeholders)
    filled = fill_areas(named.select(*_canonical(named, spec)), index, broadcast_limit=broadcast_limit)
    if ROW_KEY not in raw.columns:
        filled = filled.withColumn(ROW_KEY, F.xxhash64(*filled.columns))
    return check(filled.withColumn(SOURCE, F.lit(spec.priority)), last_year)


def _canonical(df: DataFrame, spec: FeedSpec) -> list[Column]:
    """Every column in its final type, one projection; typed NULLs for absent ones.

    Plugs are looked up before they are cleaned, as labels match exactly. Numbers
    and dates are read from the raw text: what cleaning would change in them does
    not make a number of them.
    """
    present = set(df.columns)
    plugs, powers = [], []
    for i in range(1, spec.plug_columns + 1):
        plugs += [name for name in (f"plug_type_{i}",) if name in present]
        powers += [name for name in (f"power_capacity_kw_{i}",) if name in present]
    values: dict[str, Column] = {}

    def clean(text: Column) -> Column:
        return clean_text(text, spec.text_rule)

    if plugs:
        values["plug_types"] = pack(plugs, lambda label: clean(plug_label(label)))
    elif "plug_types" in present:
        values["plug_types"] = F.transform(plug_tokens(F.col("plug_types")), clean)
    if powers:
        values["power_capacities_kw"] = pack(powers, plausible_power)
    if spec.coordinates in present:
        values["latitude"] = coordinate_part(F.col(spec.coordinates), 0)
        values["longitude"] = coordinate_part(F.col(spec.coordinates), 1)
    numeric = spec.numeric_postal_codes
    readers = {
        "latitude": decimal_comma,
        "longitude": decimal_comma,
        "power_connection_capacity": decimal_comma,
        "commissioning_date": parse_date,
        "number_of_charging_points": lambda text: fill_count(text, spec.unreadable_count_is_missing),
        "postal_code": lambda text: postal_code(text if numeric else clean(text), numeric),
    }
    columns = []
    for field in CANONICAL.fields:
        name = field.name
        if name in values:
            value = values[name]
        elif name not in present:
            value = F.lit(None)
        elif name in readers:
            value = readers[name](F.col(name))
        else:
            value = clean(F.col(name))
        columns.append(value.cast(field.dataType).alias(name))
    kept = [clean(F.col(name)).alias(name) for name in spec.extra if name in present]
    return columns + kept + [F.col(name) for name in (ROW_KEY,) if name in present]
