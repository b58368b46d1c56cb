"""Time windows relative to an anchor, and the canonical column names.

Tables used by the operators follow three shapes:

* anchors    ``(entity, anchor_ts)``, one row per entity
* points     ``(entity, ts, label, value)``
* intervals  ``(entity, start_ts, end_ts, label, amount)``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def shift(ts: Column | str, by_us: int) -> Column:
    return F.timestamp_micros(micros(ts) + F.lit(by_us))


def offset_us(ts: Column | str, anchor: Column | str = "anchor_ts") -> Column:
    """Microseconds from the anchor to ``ts`` (negative before the anchor)."""
    return micros(ts) - micros(anchor)


@dataclass(frozen=True)
class TimeWindow:
    """``[anchor + lo, anchor + hi]`` in microseconds; either bound may be open or absent."""

    lo: int | None
    hi: int | None
    lo_closed: bool = True
    hi_closed: bool = True

    @classmethod
    def before(cls, hours: float) -> TimeWindow:
        return cls(-int(hours * HOUR), 0)

    @classmethod
    def around(cls, hours: float) -> TimeWindow:
        return cls(-int(hours * HOUR), int(hours * HOUR))

    @classmethod
    def after(cls, days: float) -> TimeWindow:
        return cls(0, int(days * DAY))

    def holds(self, offset: Column) -> Column:
        """Whether an offset from the anchor lies inside the window."""
        terms = []
        if self.lo is not None:
            terms.append(offset >= self.lo if self.lo_closed else offset > self.lo)
        if self.hi is not None:
            terms.append(offset <= self.hi if self.hi_closed else offset < self.hi)
        if not terms:
            return offset.isNotNull()
        cond = terms[0]
        for t in terms[1:]:
            cond = cond & t
        return cond

    def contains(self, ts: Column | str, anchor: Column | str = "anchor_ts") -> Column:
        return self.holds(offset_us(ts, anchor))

    def overlaps(
        self,
        start: Column | str = "start_ts",
        end: Column | str = "end_ts",
        anchor: Column | str = "anchor_ts",
        strict: bool = False,
    ) -> Column:
        """Whether ``[start, end]`` meets the window; ``strict`` asks for more than a shared endpoint."""
        s, e = offset_us(start, anchor), offset_us(end, anchor)
        if strict:
            return (s < self.hi) & (e > self.lo)
        return (e >= self.lo) & (s <= self.hi)

    @property
    def length_us(self) -> int:
        return self.hi - self.lo


LOOK_BACK_12H = TimeWindow.before(12)
