"""Events of ids in the order of their numbers, live, whatever the order in which they arrive."""

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from spoolway.schema import ENTITY, MAX_LONG

#: State of this kind of operator is kept by RocksDB.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Holds events back until the numbers before them have come, or the wait for these is over."""

    def __init__(self, names: list[str], ids: list[str], from_seq: int, to_seq: int, wait_ms: int):
        self.names, self.ids, self.from_seq, self.to_seq, self.wait_ms = names, ids, from_seq, to_seq, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the number to come, and the end of the wait for it, 0 while nothing waits behind it
        numbers = [T.StructField("seq_nr", T.LongType()), T.StructField("until_ms", T.LongType())]
        self.next = handle.getValueState("next", T.StructType(numbers))
        self.held = handle.getMapState(
            "held",
            T.StructType([T.StructField("seq_nr", T.LongType())]),
            T.StructType([T.StructField("event", T.BinaryType())]),
        )

    def _given(self, key: tuple, seq: int, until: int, timers, skip: bool) -> Iterator[pd.DataFrame]:
        """Give out what follows without a gap; past one as well if the wait is over."""
        out, awaited = [], seq
        if skip and not self.held.containsKey((seq,)):
            later = [key[0] for key in self.held.keys()]
            seq = min([*(s for s in later if s > seq), self.to_seq + 1]) if later else seq
        while seq <= self.to_seq and self.held.containsKey((seq,)):
            out.append((*pickle.loads(self.held.getValue((seq,))[0]), False))
            self.held.removeKey((seq,))
            seq += 1
        if seq > self.to_seq:
            # nothing more is wanted: a last row tells so
            last = dict(zip(self.ids, key)) | {"seq_nr": self.to_seq}
            out.append((*[last.get(name) for name in self.names], True))
            self.held.clear()
        if seq > self.to_seq or next(iter(self.held.keys()), None) is None:
            until = 0
        elif seq != awaited or not until:
            until = timers.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(until)
        self.next.update((seq, until))
        if out:
            yield pd.DataFrame(out, columns=[*self.names, "end"], dtype=object)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seq, until = self.next.get() if self.next.exists() else (self.from_seq, 0)
        if seq > self.to_seq:
            return
        for frame in rows:
            for row in frame[self.names].astype(object).itertuples(index=False, name=None):
                number = row[self.names.index("seq_nr")]
                # numbers given out before come no second time
                if number >= seq:
                    self.held.updateValue((int(number),), (pickle.dumps(row),))
        yield from self._given(key, seq, until, timerValues, skip=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seq, until = self.next.get()
        # the timer of a gap that was closed meanwhile says nothing about the present one
        if seq <= self.to_seq and 0 < until <= timerValues.getCurrentProcessingTimeInMs():
            yield from self._given(key, seq, until, timerValues, skip=True)

    def close(self) -> None:
        pass


def in_order(events: DataFrame, from_seq: int = 1, to_seq: int = MAX_LONG - 1, wait: float = 5.0) -> DataFrame:
    """A stream of events, each topic and id in the order of its numbers; ``end`` marks the row behind the last one.

    An event waits for the numbers before it. After ``wait`` seconds without them they are
    taken as missing. Of events with the same number one is given. Once all numbers up to
    ``to_seq`` have come or are missing while later ones are there, a row with ``end`` and
    that number follows, null but for the id, so that ``control.tail_until`` stops the query.
    Columns of events must not be null; state is held for each id apart, so hot ids do not meet.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    names, ids = events.columns, [name for name in ENTITY if name in events.columns]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in events.schema.fields], T.StructField("end", T.BooleanType())])
    return events.groupBy(*ids).transformWithStateInPandas(
        statefulProcessor=InOrder(names, ids, from_seq, to_seq, int(wait * 1000)),
        outputStructType=schema,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
