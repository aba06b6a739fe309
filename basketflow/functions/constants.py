"""Fixed values of the modelled feature definitions.

These must equal the definitions of the modelled workload for the features
to mean the same thing; they are stated here together, in natural order.
"""

# Parts of the day by order hour (inclusive ranges).
MORNING_HOURS = (6, 11)
AFTERNOON_HOURS = (12, 17)
EVENING_HOURS = (18, 20)
NIGHT_HOURS = ((21, 23), (0, 5))

# Weekend days (order_dow, Sunday = 0).
WEEKEND_DAYS = (0, 6)

# Days per week (per-week rates) and the percent scale.
DAYS_PER_WEEK = 7
PERCENT = 100.0

# Fixed value: tolerance of the data-quality sum and product checks.
CHECK_TOLERANCE = 1e-9
