"""Dimensions that change slowly, re-read between micro-batches."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame


class RefreshedDim:
    """A dimension that is read again when it is older than ``seconds``. Only the plan is
    renewed; rows stay distributed and nothing is collected."""

    def __init__(self, read: Callable[[], DataFrame], seconds: float = 3600, clock=time.monotonic):
        self._read, self._seconds, self._clock = read, seconds, clock
        self._df: DataFrame | None = None
        self._at = 0.0
        self.reads = 0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._df is None or now - self._at >= self._seconds:
            self._df, self._at, self.reads = self._read(), now, self.reads + 1
        return self._df


def per_batch(
    operator: Callable[..., DataFrame], write: Callable[[DataFrame, int], None], **dims: RefreshedDim
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: joins every micro-batch with the current dimensions."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(operator(batch, **{name: dim.get() for name, dim in dims.items()}), batch_id)

    return run
