"""When rows come in, as opposed to when they say they were made.

Waiting and forgetting go by arrival: a record dated in the future, or a backlog of old ones, then neither closes anything early
nor is late itself. The arrival of a row is the time of the batch that brings it, which the checkpoint records, so a repeated
batch sees the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def arrived(clock: str | None = None) -> Column:
    """The time of the batch; or the column ``clock``, where the source stamps rows as they come in, but never a later time than
    the batch's."""
    now = F.current_timestamp()
    return now if clock is None else F.least(F.coalesce(F.col(clock).cast("timestamp"), now), now)
