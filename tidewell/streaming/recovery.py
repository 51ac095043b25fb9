"""Failure and recovery of streaming queries.

A micro-batch that wrote its output but did not reach the commit log is replayed from the
offset log when the query starts again on its checkpoint: same epoch, same rows.
Writers overwrite by (run, epoch), so a replay leaves one copy. ``CrashAfterWrite`` makes
such failures on purpose; ``supervise`` is the loop that starts a failed query again.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

_LOG = logging.getLogger(__name__)


class InjectedCrash(RuntimeError):
    """The failure that ``CrashAfterWrite`` raises."""


@dataclass
class CrashAfterWrite:
    """A batch function that does ``step``'s work and then fails, the first ``times`` times
    an epoch comes by: its output is written, its commit is not."""

    step: Callable[[DataFrame, int], None]
    times: int = 1
    attempts: dict[int, int] = field(default_factory=dict)

    def __call__(self, df: DataFrame, epoch: int) -> None:
        self.step(df, epoch)
        self.attempts[epoch] = self.attempts.get(epoch, 0) + 1
        if self.attempts[epoch] <= self.times:
            raise InjectedCrash(f"after the write of epoch {epoch}")


def supervise(start: Callable[[], StreamingQuery], most_failures: int = 10) -> int:
    """Runs ``start``'s finite query to its end, starting it again on its checkpoint after a
    failure; gives up with the last failure after ``most_failures`` in a row without a
    finished batch. Returns how often it failed."""
    failures = in_a_row = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return failures
        except StreamingQueryException as e:
            failures += 1
            done = (query.lastProgress or {}).get("batchId")
            in_a_row = 1 if done is not None else in_a_row + 1
            if in_a_row > most_failures:
                raise
            _LOG.warning("stream %s failed (%s); starting again from its checkpoint", query.id, e.__class__.__name__)
