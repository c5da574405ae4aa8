"""Message records of positions (S2, C19) and the topic stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.schemas import POSITION_COLUMNS


def to_records(positions: DataFrame) -> DataFrame:
    """(key, value) records: key = vehicle id bytes ("" when NULL), value =
    JSON object of all 16 position fields with NULLs written out."""
    value = F.to_json(F.struct(*[F.col(c) for c in POSITION_COLUMNS]), {"ignoreNullFields": "false"})
    return positions.select(
        F.coalesce(F.col("vehicle_id"), F.lit("")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def write_records(records: DataFrame, servers: str, topic: str) -> None:
    """Publish to a topic (needs the Kafka connector on the classpath)."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
