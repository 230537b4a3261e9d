"""Publish keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordertide.sources.topic import TopicConfig


def write_topic(messages: DataFrame, cfg: TopicConfig) -> None:
    """K3: send ``key``, ``value`` rows. The key picks the partition, so one order stays in order.

    A replayed batch sends its messages again (at-least-once); readers tell copies by
    ``event_id``. Needs the Kafka connector on the session's class path.
    """
    messages.select("key", "value").write.format("kafka").options(**cfg.write_options()).save()
