"""Run parameters shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(moment: datetime) -> Column:
    """A timestamp literal that does not depend on any time-zone setting."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((moment - _EPOCH) // timedelta(microseconds=1)).cast("bigint"))


@dataclass(frozen=True)
class Params:
    """What a run looks at, and which of the rule variants it follows.

    ``as_of`` stands for "now" everywhere, so a run can be repeated. The three ``require_*``
    switches choose between the rule the reference computes (the defaults) and the rule it documents.
    """

    as_of: datetime
    # Default window, gap, batch length, tracked organisations, wanted labels, chart size.
    window_days: int = 180
    gap_days: int = 30
    batch_days: int = 7
    orgs: tuple[str, ...] = ("apache", "github", "huggingface")
    wanted_labels: tuple[str, ...] = ("bug", "enhancement")
    top_n: int | None = 5
    require_label_on_closed: bool = False
    require_agent_pr_on_open: bool = True
    require_closed_after_merge: bool = False

    def __post_init__(self):
        if self.as_of.tzinfo is None:
            object.__setattr__(self, "as_of", self.as_of.replace(tzinfo=timezone.utc))

    @property
    def start(self) -> datetime:
        return self.as_of - timedelta(days=self.window_days)

    @property
    def end(self) -> datetime:
        return self.as_of

    @property
    def start_column(self) -> Column:
        return instant(self.start)

    @property
    def end_column(self) -> Column:
        return instant(self.end)

    @property
    def last_updated(self) -> str:
        return self.as_of.isoformat()
