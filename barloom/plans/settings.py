"""Parameters of the registered queries for the date range of the test tables."""

import datetime

from barloom.operators.mart import MartSettings

# Cut-offs that suit bars of 1995-2001.
CUT = datetime.date(2001, 1, 1)
AS_OF = datetime.date(2001, 11, 4)
REPORT_DAYS = 365
MART = MartSettings(
    validation_from=datetime.date(2000, 1, 1),
    test_from=datetime.date(2001, 1, 1),
    fold_years=(1997, 1998, 1999, 2000, 2001),
    sector_codes={"africa": 1, "america": 2, "asia": 3},
)
SECTORS = {
    "africa": ["S0", "S1", "S2"],
    "asia": ["S3", "S4"],
    "europe": ["S5", "S6", "S7", "S8"],
}
