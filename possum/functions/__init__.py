"""Column expressions (``Column -> Column``), all built-in and codegen-friendly."""

from .columns import (  # noqa: F401
    account_key,
    branch_of,
    account_of,
    date_text_to_int,
    snapshot_int,
    tax_id14,
    tax_id_base,
    year_month_text,
)
from .rules import (  # noqa: F401
    entry_or_exit,
    event_date,
    is_active,
    journey_label,
    journey_override,
    opening_date,
)
