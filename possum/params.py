"""Run parameters: everything the reference hard-codes becomes an argument."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from . import constants as K


@dataclass(frozen=True)
class RunParams:
    """Arguments of one daily run.

    ``execute_date`` is the run day as int ``yyyymmdd``; ``as_of`` anchors the
    revenue months (the reference used the wall clock, which makes reruns drift).
    Account lists are caller data, never literals in the library.
    """

    execute_date: int
    as_of: dt.date
    cancel_floor: int = K.CANCEL_FLOOR
    client_floor: int = K.CLIENT_FLOOR
    # Whether the client table is read from client_floor on, or whole.
    use_client_floor: bool = False
    excluded_accounts: tuple[str, ...] = ()
    journey_to_outros: tuple[str, ...] = ()
    journey_to_onboarding: tuple[str, ...] = ()
    months: int = K.REVENUE_MONTHS
    open_end: dt.date = K.OPEN_END
    pdv_tie_break: tuple[str, ...] = field(default_factory=tuple)
    estab_tie_break: tuple[str, ...] = field(default_factory=tuple)
    # Groups above this many rows are ranked by the skew-safe path.
    max_group_rows: int = 1_000_000
