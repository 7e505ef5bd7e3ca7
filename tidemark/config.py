"""Settings shared by the composed jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class JobConfig:
    """One immutable set of job options.

    churn_threshold  a user churned when two consecutive activity dates are
                     more than this many days apart
    align            'left' fills the oldest of the five change slots first,
                     'right' the newest; it only matters below five sessions
    null_policy      'poison' zeroes a user's variety statistics when any week
                     is missing, 'skip' ignores the missing weeks
    prior_as_written True gives the constant 0 as prior churn count
    keep_state_flag  adds is_subs_acct to the subscription features
    as_of            with a date, variety weeks after that date's ISO week go
    row_limit        reads only the first rows of each dataset
    intermediates    folder for the per-user tables; None writes none
    intermediates_format  'tsv' or 'parquet'
    """

    churn_threshold: int = 15
    align: str = "left"
    null_policy: str = "poison"
    prior_as_written: bool = False
    keep_state_flag: bool = False
    as_of: dt.date | None = None
    row_limit: int | None = None
    intermediates: str | None = None
    intermediates_format: str = "tsv"

    def __post_init__(self) -> None:
        if self.churn_threshold < 0:
            raise ValueError("churn_threshold must be 0 or more days")
        if self.align not in ("left", "right"):
            raise ValueError(f"align must be 'left' or 'right', not {self.align!r}")
        if self.null_policy not in ("poison", "skip"):
            raise ValueError(f"null_policy must be 'poison' or 'skip', not {self.null_policy!r}")
