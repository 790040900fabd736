"""A user-defined fold: the longest run of consecutive events tagged ``high``."""

import numpy as np
import pandas as pd
from pyspark.sql import types as T

NO_RUN = {"events": 0, "leading": 0, "trailing": 0, "longest": 0}
RUN = T.StructType([T.StructField(name, T.LongType()) for name in NO_RUN])


def _summary(high: np.ndarray) -> dict:
    """Runs within one stretch of flags."""
    misses = np.flatnonzero(high == 0)
    # the sum up to each miss and to the end, and from it the sum of each run between two
    sums = np.concatenate(([0], np.cumsum(np.nan_to_num(high))))
    runs = np.diff(np.concatenate(([0], sums[misses], sums[-1:])))
    return {"events": len(high), "leading": int(runs[0]), "trailing": int(runs[-1]), "longest": int(runs.max())}


def join_runs(left: dict, right: dict) -> dict:
    return {
        "events": left["events"] + right["events"],
        "leading": left["leading"] + (right["leading"] if left["leading"] == left["events"] else 0),
        "trailing": right["trailing"] + (left["trailing"] if right["trailing"] == right["events"] else 0),
        "longest": max(left["longest"], right["longest"], left["trailing"] + right["leading"]),
    }


def add_events(state: dict, rows: pd.DataFrame) -> dict:
    return join_runs(state, _summary(rows["high"].to_numpy()))
