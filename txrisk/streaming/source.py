"""Streaming sources of raw transaction messages.

The production source is a message-broker topic read from the latest
offset; the format is injected so tests can drive the same job from a
folder of JSON-lines files (the broker connector is not installed here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_TOPIC = "transactions"


def read_transactions(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Raw message stream with a ``value`` column (binary or string).

    * ``fmt="kafka"``: ``options`` must hold ``kafka.bootstrap.servers``;
      ``subscribe`` defaults to the transactions topic and
      ``startingOffsets`` to ``latest``.
    * ``fmt="text"``: one JSON message per line of the files under ``path``.
    """
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("subscribe", DEFAULT_TOPIC)
        opts.setdefault("startingOffsets", "latest")
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
    elif max_per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    for k, v in opts.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    return df.select("value")
