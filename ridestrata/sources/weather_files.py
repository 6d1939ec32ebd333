"""Landed weather responses."""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ridestrata.schemas import WEATHER_RESPONSE, WEATHER_VARIABLES

# Fixed values of the request whose responses are landed.
BOUNDING_BOX = (38.7916, -77.1197, 38.9959, -76.9094)
MODEL = "icon_global"


def weather_request(first: date, last: date) -> dict[str, str]:
    """Parameters of the request for a span of days: every location in the box
    answers with one array per variable."""
    return {
        "bounding_box": ",".join(str(edge) for edge in BOUNDING_BOX),
        "models": MODEL,
        "start_date": first.isoformat(),
        "end_date": last.isoformat(),
        "daily": ",".join(WEATHER_VARIABLES),
    }


def read_weather(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """One row per location of JSON-lines files."""
    return spark.read.schema(WEATHER_RESPONSE).option("mode", "FAILFAST").json(list(paths))
