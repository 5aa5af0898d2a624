"""Run the streaming job on Kafka: ``spark-submit --packages <kafka> salestide/job.py``.

Parameters come from the environment; the names are those of the deployment the events come from. ``DATA_DIR`` and
``SCHEMA_REGISTRY_TABLE`` must be given with their file system (``s3a://``, ``hdfs://``, ``file://`` of a shared mount): a
bare path would be a local disk of every machine.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Mapping
from dataclasses import dataclass

if not __package__:  # run as a script: its folder is on the path, the package's parent has to be
    sys.path[0] = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from salestide import contract as c  # noqa: E402
from salestide.functions.rules import Rules  # noqa: E402
from salestide.operators.silver import STREAM_SALTS  # noqa: E402
from salestide.sources.kafka import kafka_stream  # noqa: E402
from salestide.streaming.layers import Layout, Options, run_layers  # noqa: E402

_EVENTS = {1: c.EVENT_V1, 2: c.EVENT_V2}


@dataclass(frozen=True)
class Settings:
    servers: str = "kafka:29092"
    topic: str = "sales.events.v1"
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    registry_table: str = ""
    root: str = ""
    run_id: str = "main"
    gold_dir: str | None = None
    dq_dir: str | None = None
    checkpoint_dir: str | None = None
    watermark: str = c.WATERMARK_DELAY
    trigger: str = c.TRIGGER_INTERVAL
    latency_sla_seconds: int = c.LATENCY_SLA_SECONDS
    event_version: int = 1
    gated: bool = False
    salts: int = STREAM_SALTS
    dead_letter_topic: str | None = None

    def __post_init__(self) -> None:
        for variable, path in (("DATA_DIR", self.root), ("SCHEMA_REGISTRY_TABLE", self.registry_table)):
            if ":/" not in path:
                raise ValueError(f"set {variable} to a folder with its file system, not {path!r}")
        if self.event_version not in _EVENTS:
            raise ValueError(f"the contract has the versions {sorted(_EVENTS)}")

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> Settings:
        names = {
            "servers": "KAFKA_BOOTSTRAP_SERVERS",
            "topic": "KAFKA_TOPIC",
            "starting_offsets": "STARTING_OFFSETS",
            "max_offsets_per_trigger": "MAX_OFFSETS_PER_TRIGGER",
            "min_partitions": "MIN_PARTITIONS",
            "registry_table": "SCHEMA_REGISTRY_TABLE",
            "root": "DATA_DIR",
            "run_id": "RUN_ID",
            "gold_dir": "GOLD_DIR",
            "dq_dir": "DQ_DIR",
            "checkpoint_dir": "CHECKPOINT_DIR",
            "watermark": "WATERMARK_DELAY",
            "trigger": "TRIGGER_INTERVAL",
            "latency_sla_seconds": "LATENCY_SLA_SECONDS",
            "event_version": "EVENT_VERSION",
            "gated": "GATE_REVENUE",
            "salts": "DEDUP_SALTS",
            "dead_letter_topic": "DEAD_LETTER_TOPIC",
        }
        given = {name: env[variable] for name, variable in names.items() if variable in env}
        for name in ("max_offsets_per_trigger", "min_partitions", "latency_sla_seconds", "event_version", "salts"):
            if name in given:
                given[name] = int(given[name])
        if "gated" in given:
            given["gated"] = given["gated"].lower() in ("1", "true", "yes")
        return cls(**given)

    def layout(self) -> Layout:
        chosen = {"gold": self.gold_dir, "dq": self.dq_dir, "checkpoints": self.checkpoint_dir}
        return Layout(self.root, self.run_id, {name: path for name, path in chosen.items() if path})


    def options(self) -> Options:
        letters = (self.servers, self.dead_letter_topic) if self.dead_letter_topic else None
        return Options(
            self.watermark, Rules(latency_sla_seconds=self.latency_sla_seconds), self.salts, self.gated,
            _EVENTS[self.event_version], c.ADDED_FIELDS if self.event_version > 1 else None, letters,
        )


def main(settings: Settings) -> None:
    spark = SparkSession.builder.appName("sales-revenue").getOrCreate()
    records = kafka_stream(
        spark,
        settings.servers,
        settings.topic,
        settings.starting_offsets,
        settings.max_offsets_per_trigger,
        settings.min_partitions,
    )

    def registry() -> DataFrame:
        schemas = spark.read.schema(c.REGISTRY_SCHEMA).parquet(settings.registry_table)
        return schemas.filter(F.col("subject") == f"{settings.topic}-value")

    run_layers(spark, records, registry, settings.layout(), settings.trigger, settings.options())


if __name__ == "__main__":
    main(Settings.from_env(os.environ))
