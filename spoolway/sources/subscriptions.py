"""What to read from a topic table: names, a pattern, partitions or partitions with offsets."""

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


@dataclass(frozen=True)
class Topics:
    names: Sequence[str]

    def predicate(self) -> Column:
        return F.col("topic").isin(list(self.names))

    def kafka_options(self) -> dict[str, str]:
        return {"subscribe": ",".join(self.names)}


@dataclass(frozen=True)
class TopicPattern:
    """Topics whose whole name matches a regular expression."""

    pattern: str

    def predicate(self) -> Column:
        return F.col("topic").rlike(f"^(?:{self.pattern})$")

    def kafka_options(self) -> dict[str, str]:
        return {"subscribePattern": self.pattern}


@dataclass(frozen=True)
class Assignment:
    """Fixed (topic, partition) pairs."""

    pairs: Sequence[tuple[str, int]]

    def predicate(self) -> Column:
        return _any(
            [
                (F.col("topic") == topic)
                & F.col("partition").isin([p for t, p in self.pairs if t == topic])
                for topic in sorted({t for t, _ in self.pairs})
            ]
        )

    def kafka_options(self) -> dict[str, str]:
        return {"assign": json.dumps(_by_topic([(t, p, p) for t, p in self.pairs], list))}


@dataclass(frozen=True)
class AssignmentWithOffset:
    """(topic, partition, first offset) triples; the offset is inclusive."""

    triples: Sequence[tuple[str, int, int]]

    def predicate(self) -> Column:
        return _any(
            [
                (F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") >= o)
                for t, p, o in self.triples
            ]
        )

    def kafka_options(self) -> dict[str, str]:
        return {
            "assign": json.dumps(_by_topic([(t, p, p) for t, p, _ in self.triples], list)),
            "startingOffsets": json.dumps(_by_topic(self.triples, dict)),
        }


Subscription = Topics | TopicPattern | Assignment | AssignmentWithOffset


def _by_topic(triples, shape):
    grouped = {t: {} for t, _, _ in triples}
    for topic, partition, value in triples:
        grouped[topic][partition] = value
    return {t: list(found) if shape is list else {str(p): o for p, o in found.items()} for t, found in grouped.items()}
