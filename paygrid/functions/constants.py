"""Fixed values of the feature mart.

FIXED VALUES — these must equal the behaviour being reproduced, so they are
stated here plainly, in natural order, in one place.
"""

# Horizon: the first day of the month 18 months before the as-of date.
HORIZON_MONTHS = 18

# Market rows used for enrichment carry this aggregation type ("whole market").
WHOLE_MARKET = "Весь рынок"

# Competitor placeholder that means "not determined" (exact, case-sensitive).
COMPETITOR_UNKNOWN = "не определено"

# Allowed values of competitor_food_cat (NULL is allowed as well).
FOOD_CATEGORIES = ("Food", "Non-food", "Не определено")

# Row offsets and frames of the per-series windows (rows, not calendar months).
LAG_PREV = 1
LAG_YEAR = 12
TRAILING_FRAME = (-3, -1)
ROLLING_FRAME = (-11, 0)
LONG_FRAME = (-51, 0)

# Placeholder value of normalized_positions when staff is present.
STAFFED_VALUE = 100

# data_insufficient is set when the completeness score exceeds this.
INSUFFICIENT_ABOVE = 0.3

# Run log identity and step texts.
JOB_NAME = "PRC_UPDATE_CITY_POSITION_FEATURES_GE"
STEP_STARTED = "Процедура запущена"
STEP_DONE = "Данные обновлены успешно"
