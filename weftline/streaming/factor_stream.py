"""Factor states kept up to date by a stream of actual and predicted units (an extension of the batch jobs)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftline.operators.factors import FilterConfig

OUTPUT = "key string, x double, p double, updates bigint"


def stream_states(observations: DataFrame, cfg: FilterConfig = FilterConfig(), key: str = "key", actual: str = "units", pred: str = "pred_base") -> DataFrame:
    """The state of each key after each micro-batch: one update a batch, from the batch's totals.

    A batch whose predictions don't add up to something positive leaves its key as it was.
    """

    def move(keys: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        x, p, n = state.get if state.exists else (cfg.initial_x, cfg.initial_p, 0)
        total_a = total_p = 0.0
        for frame in frames:
            total_a += float(frame[actual].sum())
            total_p += float(frame[pred].sum())
        if total_p > 0:
            z = total_a / total_p
            if z > 0:
                gain = p / (p + cfg.measurement_noise)
                x, p = min(max(x + gain * (z - x), cfg.low), cfg.high), (1 - gain) * p + cfg.process_noise
            else:
                p += cfg.process_noise
            n += 1
        state.update((x, p, n))
        yield pd.DataFrame({"key": [keys[0]], "x": [x], "p": [p], "updates": [n]})

    return observations.where(f"{key} IS NOT NULL").groupBy(key).applyInPandasWithState(move, OUTPUT, "x double, p double, updates bigint", "update", GroupStateTimeout.NoTimeout)
