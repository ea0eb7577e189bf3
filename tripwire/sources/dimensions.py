"""Static dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tripwire.config import CITY_COUNTRY

CITY_SCHEMA = StructType([StructField("location", StringType(), False),
                          StructField("country", StringType(), False)])


def city_dimension(spark: SparkSession) -> DataFrame:
    """The fixed city -> country table (41 rows; a local relation, so its size
    is known when it is broadcast)."""
    return spark.createDataFrame(list(CITY_COUNTRY.items()), CITY_SCHEMA)
