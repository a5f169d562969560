"""Fixed values of the log format.

These literals define what the parser recognises and how the marts are
labelled; they must stay exactly as written for results to agree with the
original pipeline.
"""

# ---- fixed values: must equal the original log format and marts ----------
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
COLUMN_HEADERS = ("Exercise", "Weight", "Grip", "Amount", "Rest (s)")
SECTION_NAMES = (
    "Warm-Up", "Pull", "Push", "Legs", "Weights", "Floor Routine", "Bar Routine",
    "Pull/Push Pyramid", "Pull/Push",
)
DELOAD_MARK = "Deload"
COUNTER_MARK = "/365"
TOTAL_MARK = "Total"
BODYWEIGHT_MARK = "Bodyweight"
KG_MARK = "kg"
EXCLUDED_SHEETS = ("2023",)
DATE_CELL_LENGTH = 7
RECORD_WIDTH = 5
ALLOWED_UNITS = ("kg", "lbs")
SECONDS_PATTERN = "%(s)%"
COMBO_PATTERN = "%+%"
MONTH_AXIS_FLOOR = "2021-01-01"
LBS_PER_KG = 2.2
WEEKDAY_YEAR_BOUND = 2025
MAIN_EXERCISES = (
    "pull-ups", "chin-ups", "push-ups", "dips", "squats", "australian pull-ups",
    "straight bar dips", "pike push-ups", "knee raises", "leg raises",
)
DASHBOARD_EXERCISES = (
    "pull-ups", "chin-ups", "australian pull-ups", "push-ups", "dips",
    "straight bar dips", "knee raises", "leg raises", "pike push-ups",
)
HEATMAP_WEEKDAY_ORDER = ("sunday", "saturday", "friday", "thursday", "wednesday", "tuesday", "monday")
# spreadsheet serial-date epochs (workbook date mode 0 and 1)
EXCEL_EPOCH_1900 = "1899-12-30"
EXCEL_EPOCH_1904 = "1904-01-01"
# ---------------------------------------------------------------------------
