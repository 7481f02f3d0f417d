"""Social-media and web-crawl documents: ``{"norm": {"body": ...}, "norm_attribs": {...}, ...}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of a converted document.
CAPTURE_PREFIX = "pulse_"
PRODUCER = "Pulse"
CLASSIFICATION = "UNCLASSIFIED"
LANGUAGE = "en"

PULSE_JSON = (
    "STRUCT<norm: STRUCT<body: STRING, author: STRING, url: STRING, timestamp: STRING>, "
    "norm_attribs: STRUCT<type: STRING>, meta: STRUCT<title: ARRAY<STRUCT<results: ARRAY<STRING>>>>>"
)
ISO_OFFSET_TIME = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"
)


def is_pulse(document: str) -> Column:
    """``norm`` is an object with a string ``body`` and, if at all, a string ``author``."""
    def kind(path: str) -> Column:
        return F.expr(f"schema_of_variant(try_variant_get({document}, '{path}', 'variant'))")

    return F.coalesce(kind("$.norm.body") == "STRING", F.lit(False)) & (
        F.coalesce(kind("$.norm.author"), F.lit("STRING")) == "STRING"
    )


def pulse_fields(document: str) -> Column:
    return F.expr(f"try_variant_get({document}, '$', '{PULSE_JSON}')")


def title(pulse: Column) -> Column:
    """First result of the first title attribute, else ""."""
    first = F.get(pulse.getField("meta").getField("title"), F.lit(0)).getField("results")
    return F.when(F.size(first) > 0, F.get(first, F.lit(0))).otherwise("")


def local_date(timestamp: Column) -> Column:
    """Date as written in an ISO offset timestamp, not moved to another time zone."""
    readable = timestamp.rlike(ISO_OFFSET_TIME) & timestamp.try_cast("timestamp").isNotNull()
    return F.when(readable, F.substring(timestamp, 1, 10).try_cast("date"))


def unconvertible(pulse: Column) -> Column:
    """True when attributes are missing, a title lacks its results, or the time is unreadable."""
    stamp = pulse.getField("norm").getField("timestamp")
    titles = pulse.getField("meta").getField("title")
    no_results = (F.coalesce(F.size(titles), F.lit(0)) > 0) & F.get(titles, F.lit(0)).getField("results").isNull()
    return (
        pulse.getField("norm_attribs").isNull()
        | F.coalesce(no_results, F.lit(False))
        | (stamp.isNotNull() & local_date(stamp).isNull())
    )
