"""Fixed values that must equal the reference job's for right results.

They are business codes and defaults, stated once here, in natural order.
"""

import datetime as _dt

# --- fixed values (channel codes, journey labels, sentinels, defaults) ---
CHANNEL_RESSEG_IN = "resseg in"
CHANNEL_RESSEG_OUT = "resseg out"
CHANNEL_ONBOARDING = "onboarding"
CHANNEL_OUTROS = "outros"
CHANNEL_OUTRO = "outro"
SIDE_ENTRY = "entrada"

LABEL_RESSEG = "ressegmentacao"
LABEL_ONE = "one_itau"

OPEN_END = _dt.date(9999, 12, 31)      # closing date of an account still open
NO_DATE = 0                             # int yyyymmdd meaning "no date"
CANCEL_FLOOR = 20231001                 # cancelled on/after this day stays eligible
CLIENT_FLOOR = 20240314                 # default floor of the client-table scan
REVENUE_MONTHS = 10                     # current month + 9 back
ACCOUNT_KEY_SEP = "_"                   # branch "_" account
TAX_ID_WIDTH = 14                       # digits of a company tax id
TAX_ID_BASE_WIDTH = 8                   # leading digits forming its base
# --- end of fixed values ---
