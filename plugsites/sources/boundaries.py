"""Administrative boundary layers from GeoJSON or shape files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugsites.operators.shape import union_sources
from plugsites.sources.shapefiles import layer_files, read_shapes

# The property that names an area, by level.
NAME_PROPERTIES = {1: "NAME_1", 2: "NAME_2", 3: "NAME_3"}

# Coordinates stay text here: their nesting depends on the geometry type.
FEATURE = T.StructType(
    [
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "geometry",
            T.StructType(
                [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
            ),
        ),
    ]
)
COLLECTION = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])
POLYGON = "array<array<array<double>>>"
MULTI_POLYGON = "array<array<array<array<double>>>>"


def read_layer(
    spark: SparkSession,
    path: str,
    level: int,
    name_property: str | None = None,
    order_property: str | None = None,
    collection: bool = False,
) -> DataFrame:
    """One layer as ``level, ord, name, rings``; a ``.shp`` file is read with its siblings.

    One feature per line by default, so a large layer is read in parallel;
    ``collection`` reads a single FeatureCollection document. Areas are ordered
    by ``order_property``, else by their place in the file.
    """
    name_property = name_property or NAME_PROPERTIES[level]
    if path.endswith(".shp"):
        return read_shapes(spark, path, level, name_property, order_property)
    if collection:
        features = spark.read.schema(COLLECTION).json(path, multiLine=True).select(F.inline("features"))
    else:
        features = spark.read.schema(FEATURE).json(path)
    place = (
        F.col("properties")[order_property].cast("bigint")
        if order_property
        else F.monotonically_increasing_id()
    )
    kind, coordinates = F.col("geometry.type"), F.col("geometry.coordinates")
    parts = F.when(kind == "Polygon", F.from_json(coordinates, POLYGON)).when(
        kind == "MultiPolygon", F.flatten(F.from_json(coordinates, MULTI_POLYGON))
    )
    rings = F.transform(
        parts,
        lambda ring: F.transform(
            ring, lambda point: F.struct(F.get(point, 0).alias("x"), F.get(point, 1).alias("y"))
        ),
    )
    return features.select(
        F.lit(level).alias("level"),
        place.alias("ord"),
        F.col("properties")[name_property].alias("name"),
        rings.alias("rings"),
    )


def boundary_files(path: str) -> list[str]:
    """The files that a layer is read from."""
    return layer_files(path) if path.endswith(".shp") else [path]


def read_boundaries(spark: SparkSession, paths: dict[int, str], **options) -> DataFrame:
    """The layers of several levels as one boundary set."""
    return union_sources([read_layer(spark, path, level, **options) for level, path in paths.items()])
