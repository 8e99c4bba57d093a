"""A small snapshot with ties, flags and missing values; results worked out by hand."""

import datetime as dt
from decimal import Decimal

AS_OF = "2025-01-10"

PEOPLE = [
    # 366 days, over a leap day
    ["1", " ann ", "o'neil", "Ops", "annexample.com", "(1) 2", "Active", "$100", "2024-01-10", "", "x\ny"],
    # 1 day
    ["2", "bob", "ray", "Ops", "b@x.org", "3", "Active", "201", "2025-01-09", "", "z"],
    # 2 days, over a leap day
    ["3", "cat", "lee", "Ops", "c@x.org", "3", "Terminated", "300", "2024-02-28", "2024-03-01", "z"],
    # End before start: flagged, dates wiped
    ["4", "dan", "poe", "HR", "d@x.org", "4", "Active", "400", "2024-06-01", "2024-05-01", "q"],
    # 0 days
    ["5", "eve", "fox", "HR", "e@x.org", "5", "Leave", "500", "2025-01-10", "", "q"],
    # No department and no salary; 375 days
    ["6", "fay", "gil", "", "f@x.org", "6", "Active", "", "2024-01-01", "", "unknown"],
    # Terminated without dates: flagged
    ["7", "gus", "hay", "Tax", "g@x.org", "7", "Terminated", "700", "", "", "q"],
    # No start: counts, but has no tenure; the sign is dropped
    ["8", "hal", "ivy", "Ops", "h@x.org", "8", "Active", "-100", "", "", "q"],
]

_DAY = dt.date.fromisoformat(AS_OF)

# department, total, active, mean salary, active cost, mean tenure, day
KPI = [
    (None, 1, 1, None, None, 375, _DAY),
    ("Ops", 4, 3, Decimal("175.25"), 401, 123, _DAY),
    ("HR", 1, 0, Decimal("500.00"), 0, 0, _DAY),
]

# year, hires, mean salary, most frequent department (ties: the first), day
TRENDS = [
    (2025, 2, Decimal("350.50"), "HR", _DAY),
    (2024, 3, Decimal("200.00"), "Ops", _DAY),
    (-1, 3, Decimal("400.00"), "HR", _DAY),
]
