"""Small place tables of fixed size: sights, city centres, nations, map outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# City, latitude and longitude of the centre, name in addresses.
CITY_CENTRES = [
    ("Milano", 45.4642, 9.1900, "Milan"),
    ("Vienna", 48.2082, 16.3738, "Vienna"),
    ("Barcellona", 41.3851, 2.1734, "Barcelona"),
    ("Londra", 51.5074, -0.1278, "London"),
    ("Parigi", 48.8566, 2.3522, "Paris"),
    ("Amsterdam", 52.3709, 4.8902, "Amsterdam"),
]

# Sights of each city.
POINTS_OF_INTEREST = [
    ("Milano", "Duomo di Milano", 45.4642, 9.1916),
    ("Milano", "Castello Sforzesco", 45.4700, 9.1793),
    ("Milano", "Galleria Vittorio Emanuele II", 45.4668, 9.1899),
    ("Milano", "Teatro alla Scala", 45.4670, 9.1899),
    ("Milano", "Santa Maria delle Grazie", 45.4658, 9.1704),
    ("Milano", "Navigli", 45.4495, 9.1700),
    ("Milano", "Piazza Gae Aulenti", 45.4841, 9.1920),
    ("Vienna", "Schönbrunn Palace", 48.1845, 16.3122),
    ("Vienna", "Stephansdom", 48.2082, 16.3738),
    ("Vienna", "Belvedere Palace", 48.1914, 16.3804),
    ("Vienna", "Hofburg Palace", 48.2065, 16.3656),
    ("Vienna", "Prater", 48.2167, 16.4000),
    ("Vienna", "Kunsthistorisches Museum", 48.2035, 16.3615),
    ("Vienna", "Vienna State Opera", 48.2026, 16.3686),
    ("Barcellona", "Sagrada Familia", 41.4036, 2.1744),
    ("Barcellona", "Parc Güell", 41.4145, 2.1527),
    ("Barcellona", "Casa Batlló", 41.3916, 2.1649),
    ("Barcellona", "Casa Milà (La Pedrera)", 41.3954, 2.1615),
    ("Barcellona", "La Rambla", 41.3809, 2.1730),
    ("Barcellona", "Barri Gòtic", 41.3839, 2.1760),
    ("Barcellona", "Montjuïc", 41.3634, 2.1585),
    ("Amsterdam", "Rijksmuseum", 52.3599, 4.8852),
    ("Amsterdam", "Van Gogh Museum", 52.3584, 4.8811),
    ("Amsterdam", "Anne Frank House", 52.3752, 4.8838),
    ("Amsterdam", "Dam Square", 52.3731, 4.8922),
    ("Amsterdam", "Vondelpark", 52.3580, 4.8687),
    ("Amsterdam", "Heineken Experience", 52.3570, 4.8910),
    ("Amsterdam", "Amsterdam Central Station", 52.3791, 4.9003),
    ("Parigi", "Torre Eiffel", 48.8584, 2.2945),
    ("Parigi", "Louvre", 48.8606, 2.3376),
    ("Parigi", "Cattedrale di Notre-Dame", 48.8530, 2.3499),
    ("Parigi", "Montmartre - Sacré-Cœur", 48.8867, 2.3431),
    ("Parigi", "Arco di Trionfo", 48.8738, 2.2950),
    ("Parigi", "Champs-Élysées", 48.8698, 2.3075),
    ("Parigi", "Museo d'Orsay", 48.8599, 2.3266),
    ("Londra", "Buckingham Palace", 51.5014, -0.1419),
    ("Londra", "Tower of London", 51.5081, -0.0759),
    ("Londra", "British Museum", 51.5194, -0.1270),
    ("Londra", "London Eye", 51.5033, -0.1195),
    ("Londra", "Big Ben", 51.5007, -0.1246),
    ("Londra", "Trafalgar Square", 51.5080, -0.1281),
    ("Londra", "Hyde Park", 51.5073, -0.1657),
]

# Fixed values.
NATIONS = ["Italy", "France", "United Kingdom", "Netherlands", "Austria", "Spain"]


def points_of_interest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        POINTS_OF_INTEREST, "city string, nome string, lat double, lng double"
    )


def city_centres(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CITY_CENTRES, "city string, lat double, lng double, alias string"
    )


def nations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name,) for name in NATIONS], "name string")


def outline_names(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """Names of the outlines in a GeoJSON file, by default those of :data:`NATIONS`."""
    schema = "features array<struct<properties: struct<name: string>>>"
    features = spark.read.schema(schema).option("multiLine", True).json(path)
    names = features.select(F.explode("features.properties.name").alias("name"))
    return names.filter(F.col("name").isin(NATIONS if wanted is None else wanted))
