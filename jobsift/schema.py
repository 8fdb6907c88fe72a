"""Canonical listing schema, key and column orders."""

from pyspark.sql import types as T

# Column order of a listing file and of the insert into the stored table.
LISTING_COLUMNS = [
    "listing_id",
    "source",
    "title",
    "company",
    "link",
    "time_when_scraped",
    "location",
    "compensation",
]

# Column order of the screening report.
SCREEN_COLUMNS = [
    "time_when_scraped",
    "link",
    "title",
    "company",
    "compensation",
    "location",
    "source",
    "listing_id",
]

KEY = ["listing_id", "source"]

# Columns the stored table declares NOT NULL.
REQUIRED_COLUMNS = ["listing_id", "link", "title", "company", "time_when_scraped", "source"]

# A listing file is all text: no inference, every column a string.
LISTING_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in LISTING_COLUMNS])

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("listing_id", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("company", T.StringType(), False),
        T.StructField("link", T.StringType(), False),
        T.StructField("time_when_scraped", T.TimestampNTZType(), False),
        T.StructField("location", T.StringType(), True),
        T.StructField("compensation", T.StringType(), True),
    ]
)

# Text form of time_when_scraped in listing files.
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

SOURCES = ["LinkedIn", "Indeed", "BuiltIn", "Dice"]
