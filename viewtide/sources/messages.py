"""Message sources of one shape: a DataFrame with a ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# One task reads a whole gzipped file, so a file holds few messages: some 10 MB of text.
FILE_MESSAGES = 20_000


@dataclass(frozen=True)
class KafkaTopic:
    """A topic and how to reach it; credentials come from the caller."""

    bootstrap_servers: str
    topic: str
    security_protocol: str | None = None
    sasl_mechanism: str | None = None
    sasl_jaas_config: str | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def _connection(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "kafka.security.protocol": self.security_protocol,
            "kafka.sasl.mechanism": self.sasl_mechanism,
            "kafka.sasl.jaas.config": self.sasl_jaas_config,
        }
        return {k: v for k, v in options.items() if v is not None} | dict(self.extra)

    def read_options(
        self,
        starting_offsets: str = "latest",
        fail_on_data_loss: bool = True,
        max_per_trigger: int | None = None,
    ) -> dict[str, str]:
        options = self._connection() | {
            "subscribe": self.topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
        }
        if max_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return options

    def write_options(self) -> dict[str, str]:
        return self._connection() | {"topic": self.topic}


def read_messages(spark: SparkSession, *paths: str) -> DataFrame:
    """Folders of text files, one message per line."""
    return spark.read.text(list(paths))


def write_messages(messages: DataFrame, path: str) -> None:
    """Add messages to a folder of gzipped text files, one message per line.

    ``read_messages`` and streams read these like plain files; JSON shrinks to about a tenth.
    """
    writer = messages.write.mode("append").option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_MESSAGES).text(path)


def read_message_stream(
    spark: SparkSession, source: str | KafkaTopic, **options
) -> DataFrame:
    """A stream of messages from a folder of text files or from a topic.

    For a folder ``options`` go to the text reader; for a topic they are those of
    ``KafkaTopic.read_options``.
    """
    if isinstance(source, KafkaTopic):
        stream = spark.readStream.format("kafka").options(**source.read_options(**options))
        return stream.load().select("value")
    return spark.readStream.options(**options).text(source)

