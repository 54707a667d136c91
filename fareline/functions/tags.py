"""Transport class of a tag map."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify(tags: Column) -> Column:
    def has(key, value):
        return F.coalesce(tags[key] == value, F.lit(False))

    return (
        F.when(has("railway", "tram"), "tram")
        .when(has("railway", "tram_stop") | (has("public_transport", "stop_position") & has("tram", "yes")), "tram_stop")
        .when(has("highway", "busway") | has("busway", "lane"), "brt")
        .when(has("amenity", "bus_station"), "brt_stop")
    )
