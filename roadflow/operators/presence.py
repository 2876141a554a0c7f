"""Which segments the feed still reports: a clock that odd stamps cannot move, and absence in feed time.

A snapshot's stamp comes from outside, so the newest one is not the time. The clock follows the
median of the stamps that arrived last; a stamp far beyond it, or beyond its own arrival, is
"ahead" and has to wait until the clock gets there. A segment is gone when the feed has run on
without it for long enough, where a pause of the feed counts for little: an outage takes nobody
off the map, a change of the network takes off whoever left.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow import schemas

SEEN = f"segment_id string, coords {schemas.COORDS}, time timestamp"
ARRIVALS = "stamp timestamp, batch_id bigint, arrived_at timestamp, base timestamp"
#: From this many arrivals on the clock does not go back.
SETTLED = 3


class Clock(NamedTuple):
    """``now``: the newest stamp believed; ``until``: rows beyond it wait; ``gone``: who was not seen after it is gone.
    ``base``: the median the clock stands on."""

    now: datetime
    until: datetime
    base: datetime
    gone: datetime | None


def arrivals_of(obs: DataFrame, batch_id: int) -> DataFrame:
    """One row per snapshot file and stamp of a batch; ``arrived_at`` where the rows have it."""
    arrived = F.max("arrived_at") if "arrived_at" in obs.columns else F.lit(None).cast("timestamp")
    rows = obs.filter(F.col("time").isNotNull()).groupBy("source_file", F.col("time").alias("stamp"))
    return rows.agg(arrived.alias("arrived_at")).select("stamp", F.lit(batch_id).cast("bigint").alias("batch_id"), "arrived_at")


def feed_clock(
    before: Sequence[tuple[datetime, int, datetime | None, datetime | None]],
    new: Sequence[tuple[datetime, int, datetime | None]],
    window: timedelta,
    gap: timedelta,
    recent: int = 5,
) -> Clock | None:
    """The clock after a batch, from stored arrivals (stamp, batch_id, arrived_at, base) and the batch's own.

    The lower median of the last ``recent`` stamps, in order of arrival, moves the clock; a stamp
    may lie up to ``window`` beyond it. Going back over the stamps up to ``now``, each step counts
    for its length but at most for ``gap``; ``gone`` is the first one that is ``window`` back.
    None while no stamp can be believed. Both lists hold files, not segments.
    """
    early = lambda r: r[2] is None or r[0] <= r[2] + window
    order = sorted([tuple(r[:3]) for r in before if early(r)] + [tuple(r) for r in new if early(r)], key=lambda r: (r[1], r[0]))
    if not order:
        return None
    last = sorted(r[0] for r in order[-recent:])
    base = last[(len(last) - 1) // 2]
    earlier_base = max(((r[1], r[3]) for r in before if r[3] is not None), default=(0, None))[1]
    if earlier_base is not None and len(before) >= SETTLED:
        base = max(base, earlier_base)
    line = sorted({r[0] for r in order if r[0] <= base + window}, reverse=True)
    if not line:
        return None
    age, gone = timedelta(), None
    for later, earlier in zip(line, line[1:]):
        age += min(later - earlier, gap)
        if age >= window:
            gone = earlier
            break
    return Clock(line[0], base + window, base, gone)


def arrivals_to_keep(rows: Sequence[tuple], clock: Clock | None, batch_id: int, recent: int = 5) -> list[tuple]:
    """The arrivals that later clocks, and this batch's if it is repeated, can depend on."""
    before = sorted((r for r in rows if r[1] < batch_id), key=lambda r: (r[1], r[0]))
    needed = set(before[-recent:])
    return [r for r in rows if r in needed or r[1] >= batch_id or clock is None or clock.gone is None or r[0] >= clock.gone]


def last_seen(rows: DataFrame) -> DataFrame:
    """Each segment's newest time, and its newest line that has points; a row without a line counts as seen."""
    drawn = F.size("coords") > 0
    line = F.max_by(F.when(drawn, F.col("coords")), F.when(drawn, F.col("time"))).alias("coords")
    return rows.groupBy("segment_id").agg(line, F.max("time").alias("time"))


def split_by_clock(rows: DataFrame, clock: Clock | None) -> tuple[DataFrame, DataFrame]:
    """(what the clock has reached, what has to wait)."""
    reached = F.lit(False) if clock is None else F.col("time") <= F.lit(clock.until)
    return rows.filter(reached), rows.filter(~reached)


def present(seen: DataFrame, clock: Clock) -> DataFrame:
    """Segments not gone."""
    return seen if clock.gone is None else seen.filter(F.col("time") > F.lit(clock.gone))
