"""Fold the events of every id to a state."""

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spoolway.operators.skew import ROWS_PER_TASK, entity_keys

State = dict[str, Any]
Step = Callable[[State, pd.DataFrame], State]
Merge = Callable[[State, State], State]

STATES_PER_FRAME = 10_000


def fold_state(journal: DataFrame, **state: Column) -> DataFrame:
    """Fold by aggregates, such as ``max_by(value, offset)``; partial sums spread a hot id."""
    return journal.groupBy(*entity_keys(journal)).agg(*[column.alias(name) for name, column in state.items()])


def fold_events(
    journal: DataFrame,
    zero: State,
    step: Step,
    merge: Merge,
    schema: T.StructType,
    rows_per_task: int = ROWS_PER_TASK,
    initial: State | None = None,
) -> DataFrame:
    """Fold by user code, in offset order.

    ``step`` takes a state and the next events of one id as a frame. Every id is folded
    in stretches of ``rows_per_task`` offsets, each from ``zero``, and ``merge`` joins
    neighbouring states; ``zero`` must be neutral for it. ``initial`` is the state an id
    starts with, merged in once at the front. So the result does not depend on how many
    events an id has. Tasks hold one Arrow batch and one state at a time. Where the
    journal has a topic, an id is folded for each topic.
    """
    ids = entity_keys(journal)
    keys = [*ids, "_stretch"]
    states = (
        journal.withColumn("_stretch", F.call_function("div", F.col("offset"), F.lit(rows_per_task)))
        .repartition(*keys)
        .sortWithinPartitions(*keys, "offset")
        .mapInPandas(_folder(keys, zero, step, schema.names), _states_of(schema, ids, ["_stretch"]))
    )
    return merge_states(states, "_stretch", zero if initial is None else initial, merge, schema)


def merge_states(states: DataFrame, position: str, initial: State, merge: Merge, schema: T.StructType) -> DataFrame:
    """One state per id out of partial ones, joined to ``initial`` in the order of ``position``.

    States stay Arrow values and Python objects, so nulls leave whole numbers exact.
    """
    names, ids = schema.names, entity_keys(states)
    result = _states_of(schema, ids)

    def join_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_schema(result)
        current, state, done, begun = None, None, [], False
        for batch in batches:
            for row in batch.to_pylist():
                own = {name: row[name] for name in ids}
                if not begun or own != current:
                    if begun:
                        done.append(current | {name: state[name] for name in names})
                    current, state, begun = own, dict(initial), True
                state = merge(state, {name: row[name] for name in names})
            if len(done) >= STATES_PER_FRAME:
                yield pa.RecordBatch.from_pylist(done, kind)
                done = []
        if begun:
            done.append(current | {name: state[name] for name in names})
        yield pa.RecordBatch.from_pylist(done, kind)

    return (
        states.repartition(*ids)
        .sortWithinPartitions(*ids, position)
        .mapInArrow(join_all, result)
    )


def _states_of(schema: T.StructType, ids: list[str], more_keys: Sequence[str] = ()) -> T.StructType:
    keys = [T.StructField(name, T.StringType()) for name in ids]
    return T.StructType([*keys, *[T.StructField(name, T.LongType()) for name in more_keys], *schema.fields])


def _folder(keys: list[str], zero: State, step: Step, names: list[str]) -> Callable:
    """A fold over sorted batches: a group may go on from one batch into the next."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, done = None, None, []
        for batch in batches:
            columns = [batch[name].to_numpy() for name in keys]
            for begin, end in _stretches(columns):
                key, rows = tuple(column[begin] for column in columns), batch.iloc[begin:end]
                if key != current:
                    if current is not None:
                        done.append((*current, *[state[name] for name in names]))
                    current, state = key, dict(zero)
                state = step(state, rows)
            if len(done) >= STATES_PER_FRAME:
                yield pd.DataFrame(done, columns=[*keys, *names], dtype=object)
                done = []
        if current is not None:
            done.append((*current, *[state[name] for name in names]))
        # as objects, so that a null does not turn whole numbers into floats
        yield pd.DataFrame(done, columns=[*keys, *names], dtype=object)

    return fold


def _stretches(columns: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches of equal keys; a null equals a null."""
    n = len(columns[0])
    if not n:
        return
    differs = np.zeros(n - 1, bool)
    for column in columns:
        differs |= (column[1:] != column[:-1]) & ~(pd.isna(column[1:]) & pd.isna(column[:-1]))
    ends = [*(np.flatnonzero(differs) + 1).tolist(), n]
    yield from zip([0, *ends], ends)
