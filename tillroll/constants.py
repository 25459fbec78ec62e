"""Fixed values.

These values define the business rules; results depend on them, so they
are stated here once, plainly, and imported everywhere else.
"""

# --- fixed values (must not change) -------------------------------------------
# A stock code is kept when it starts with five letters or digits.
STOCK_CODE_PATTERN = "^[a-zA-Z0-9]{5,}"
# An invoice is a cancellation when its (trimmed) number starts with this.
CANCELLED_PREFIX = "C"
# A customer id read from a float column ends in ".0"; that suffix is removed.
CUSTOMER_ID_SUFFIX = r"\.0$"
# TransactionType values.
CANCELLED = "Cancelled"
NORMAL = "Normal"
# MonthName: the full English month name.
MONTH_NAME_FORMAT = "MMMM"
# Published money columns and ReturnRate are rounded to this many places.
MONEY_PLACES = 2
# Report size: top products / customers / countries.
TOP_K = 10
# ------------------------------------------------------------------------------
