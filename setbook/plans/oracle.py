"""DuckDB SQL for every registered query (the correctness oracle).

Each query is a final SELECT over named steps.  A step is a SELECT that may
read other steps; ``compose`` puts the steps a query needs, and no others,
into its WITH clause in order.  The steps are written from the meaning of
the marts (SURVEY §2, §7.5): an exercise's class is a predicate, gaps are
filled by uniting generated rows with observed ones, and a previous period
is looked up once and then used.

Edge types match the Spark edge (``catalog.edge``): integers BIGINT,
decimals and percentages DOUBLE.  Percentages are rounded half away from
zero with exact integer arithmetic (DuckDB's DECIMAL / INT gives DOUBLE).
"""

from __future__ import annotations

import re

from ..functions.vocab import HEATMAP_WEEKDAY_ORDER, LBS_PER_KG, MONTH_NAMES, WEEKDAY_NAMES, WEEKDAY_YEAR_BOUND
from ..sources.journal import ODD_SQL, REST_DAY_RESIDUES


def _percent(part: str, whole: str) -> str:
    """round(100 * part / whole, 2), half away from zero, NULL when whole = 0 or NULL."""
    n, d = f"CAST(({part}) AS BIGINT)", f"CAST(NULLIF(({whole}), 0) AS BIGINT)"
    return f"(sign({n}) * sign({d}) * ((abs({n}) * 20000 + abs({d})) // (2 * abs({d}))) / 100.0)"


def _array(names) -> str:
    return "[" + ", ".join(f"'{n.lower()}'" for n in names) + "]"


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


# the fixture's years before the bound of the weekday chart
WIDE_YEARS = tuple(range(2022, WEEKDAY_YEAR_BOUND))

# ---- steps ------------------------------------------------------------------------

STEPS: dict[str, str] = {}

STEPS["dated_lines"] = f"""
    SELECT *, moved + CASE WHEN dayofyear(moved) % 7 IN ({", ".join(map(str, REST_DAY_RESIDUES))})
                           THEN 1 ELSE 0 END AS day
    FROM (SELECT *, CAST(CAST(l_shipdate AS DATE) + INTERVAL 27 YEAR AS DATE) AS moved FROM lineitem)"""

STEPS["journal"] = """
    SELECT lower(monthname(day)) AS month, lower(dayname(day)) AS weekday, day AS date,
           CAST(l_returnflag = 'R' AS SMALLINT) AS deload,
           CAST(dayofyear(day) AS SMALLINT) AS workout_counter, CAST(l_linenumber AS SMALLINT) AS set_counter,
           lower(o_orderpriority) AS type, lower(l_linestatus) AS section,
           lower(p_brand) || CASE p_size % 10 WHEN 0 THEN ' hold (s)' WHEN 1 THEN ' + dips' ELSE '' END AS exercise,
           CAST(CAST(round(l_discount * 100) AS INTEGER) * 2.5 AS DECIMAL(5,2)) AS weight, 'kg' AS weight_unit,
           lower(l_returnflag) AS grip, CAST(l_quantity AS SMALLINT) AS amount,
           CAST(CAST(round(l_tax * 100) AS INTEGER) * 15 AS SMALLINT) AS rest
    FROM dated_lines JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

# the typed journal, with the class of each exercise
STEPS["sets"] = f"""
    SELECT month, CAST(list_position({_array(MONTH_NAMES)}, month) AS SMALLINT) AS month_int,
           weekday, CAST(list_position({_array(WEEKDAY_NAMES)}, weekday) AS SMALLINT) AS weekday_int,
           CAST(year(date) AS SMALLINT) AS year, date,
           CASE deload WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS deload_bool,
           workout_counter, set_counter, type AS workout_type, section AS workout_section, exercise,
           CAST(weight AS DECIMAL(5,2)) AS added_weight, weight_unit,
           coalesce(weight = 0, FALSE) AS bodyweight, grip, amount, rest,
           contains(exercise, '(s)') AS timed,
           NOT contains(exercise, '(s)') AND NOT contains(exercise, '+') AS counted
    FROM journal"""

# first days of the months from January 2021, or the first month trained in if earlier, to the last one
STEPS["axis"] = """
    SELECT CAST(unnest(generate_series(CAST(least(DATE '2021-01-01', date_trunc('month', min(date))) AS TIMESTAMP),
                                       CAST(date_trunc('month', max(date)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS day
    FROM sets"""

_CELL = "year, month_int, month, exercise, added_weight"

# one row per trained month, exercise, weight and unit; a total only for months with a number
_OBSERVED = """
    SELECT {cell}, coalesce(unit, 'kg') AS weight_unit, coalesce(CAST(total AS BIGINT), 0) AS total_reps
    FROM (SELECT {cell}, CASE WHEN {known} THEN weight_unit END AS unit, sum(amount) FILTER (WHERE {known}) AS total
          FROM (SELECT *, month_int IS NOT NULL AND {valued} AS has_total,
                       month_int IS NOT NULL AND (counted OR timed) AS has_unit FROM sets)
          GROUP BY {cell}, CASE WHEN has_unit THEN weight_unit END, CASE WHEN {known} THEN weight_unit END)"""
STEPS["observed"] = _OBSERVED.format(cell=_CELL, known="has_total", valued="counted")
STEPS["observed_all"] = _OBSERVED.format(cell=_CELL, known="has_total", valued="(counted OR timed)")

# months of the axis in which an exercise and weight, seen at any time, was not trained
STEPS["untrained"] = """
    SELECT CAST(year(day) AS SMALLINT) AS year, CAST(month(day) AS SMALLINT) AS month_int,
           lower(monthname(day)) AS month, exercise, added_weight
    FROM axis, (SELECT DISTINCT exercise, added_weight FROM sets)
    EXCEPT
    SELECT year, month_int, list_extract({names}, month_int), exercise, added_weight FROM sets WHERE month_int IS NOT NULL
""".format(names=_array(MONTH_NAMES))

for _name, _seen in (("monthly", "observed"), ("monthly_all", "observed_all")):
    STEPS[_name] = f"""
    SELECT {_CELL}, weight_unit, total_reps FROM {_seen}
    UNION ALL SELECT {_CELL}, 'kg', 0 FROM untrained"""

_BEFORE = "OVER (PARTITION BY exercise, added_weight ORDER BY year, month_int)"


def _change(source: str, back: int, name: str, prefix: str, same_month: bool) -> str:
    """Previous value ``back`` rows earlier, percentage and absolute change."""
    usable = "earlier" if not same_month else "CASE WHEN earlier_month = month_int THEN earlier END"
    counts = "previous <> 0" if not same_month else "previous > 0"
    return f"""
    SELECT {_CELL}, weight_unit, total_reps, previous AS {name},
           CASE WHEN previous = 0 AND total_reps > 0 THEN 100
                WHEN {counts} THEN {_percent("total_reps - earlier", "earlier")} END AS {prefix}_percentage_change,
           total_reps - coalesce(earlier, 0) AS {prefix}_absolute_change
    FROM (SELECT *, {usable} AS previous
          FROM (SELECT *, lag(total_reps, {back}) {_BEFORE} AS earlier,
                       lag(month_int, {back}) {_BEFORE} AS earlier_month FROM {source}))"""


for _suffix in ("", "_all"):
    STEPS[f"by_month{_suffix}"] = _change(f"monthly{_suffix}", 1, "last_month_reps", "mom", False)
    STEPS[f"by_year{_suffix}"] = _change(f"monthly{_suffix}", 12, "last_year_reps", "yoy", True)

# classes of exercises that were ever trained; a NULL name has none
STEPS["counted_names"] = "SELECT DISTINCT exercise FROM sets WHERE counted"
STEPS["timed_names"] = "SELECT DISTINCT exercise FROM sets WHERE timed"

# every day from 1 January of the first year to the last trained day
STEPS["calendar"] = """
    SELECT day AS date, NOT bool_or(trained) AS rest
    FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(date)) AS TIMESTAMP),
                                             CAST(max(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day,
                 FALSE AS trained FROM sets
          UNION ALL SELECT date, TRUE FROM sets)
    GROUP BY day"""

# sessions per year and weekday, with a zero for every weekday ever trained in every year of the span
STEPS["weekdays"] = """
    SELECT year, weekday_int, weekday, max(n) AS total_workouts
    FROM (SELECT CAST(year AS INTEGER) AS year, weekday_int, weekday, count(DISTINCT workout_counter) AS n
          FROM sets WHERE weekday_int IS NOT NULL GROUP BY ALL
          UNION ALL
          SELECT y, weekday_int, weekday, 0
          FROM (SELECT unnest(range(CAST(min(year) AS INTEGER), CAST(max(year) AS INTEGER) + 1)) AS y FROM sets),
               (SELECT DISTINCT weekday_int, weekday FROM sets))
    GROUP BY ALL"""

# ---- marts: name -> final SELECT ---------------------------------------------------

MARTS: dict[str, str] = {
    "stg_workout_journal": "SELECT * FROM sets",
    "exercises_calculated_in_reps": "SELECT exercise FROM counted_names",
    "exercises_calculated_in_seconds": "SELECT exercise FROM timed_names",
    "monthly_aggregates_every_possible_combination": "SELECT * FROM monthly",
    "mom_changes": "SELECT * FROM by_month",
    "mom_changes_reps": """SELECT * REPLACE (coalesce(mom_percentage_change, -100) AS mom_percentage_change)
        FROM by_month WHERE exercise IN (FROM counted_names)""",
    "yoy_changes": "SELECT * FROM by_year",
    "yoy_changes_reps": "SELECT * FROM by_year WHERE exercise IN (FROM counted_names)",
    "monthly_added_volume_lifted": """SELECT year, month_int, month, exercise, weight_unit,
        sum(added_weight * amount) AS total_added_volume FROM sets WHERE counted AND NOT bodyweight GROUP BY ALL""",
    "month_with_most_workouts_per_year": """SELECT year, month_int, month, count(DISTINCT workout_counter) AS total_workouts
        FROM sets GROUP BY year, month_int, month QUALIFY rank() OVER (PARTITION BY year ORDER BY count(DISTINCT workout_counter) DESC) = 1""",
    "workout_vs_rest_days": """SELECT CAST(year(date) AS SMALLINT) AS year, CAST(month(date) AS SMALLINT) AS month_int,
        rpad(lower(monthname(date)), 9, ' ') AS month, date, rest FROM calendar""",
    "workout_days_per_year_percentage": f"""SELECT year, total_days, workout_days,
        {_percent("workout_days", "total_days")} AS workout_percentage,
        {_percent("total_days - workout_days", "total_days")} AS rest_percentage
        FROM (SELECT year, dayofyear(make_date(year, 12, 31)) AS total_days, count(DISTINCT date) AS workout_days
              FROM sets GROUP BY year)""",
    "workout_frequency_weekday": "SELECT * FROM weekdays",
}
for _suffix, _end in (("", ""), ("_all", "_corrected")):
    for _table, _mart, _old in (("by_month", "mom_changes_seconds", "last_month"), ("by_year", "yoy_changes_seconds", "last_year")):
        MARTS[_mart + _end] = (f"SELECT * RENAME ({_old}_reps AS {_old}_seconds, total_reps AS total_seconds) "
                               f"FROM {_table}{_suffix} WHERE exercise IN (FROM timed_names)")
for _grain, _keys in (("daily", "date, "), ("monthly", "year, month_int, month, "), ("yearly", "year, "), ("total", "")):
    for _kind, _flag in (("reps", "counted"), ("seconds", "timed")):
        MARTS[f"{_grain}_{_kind}_per_exercise_weight"] = (
            f"SELECT {_keys}exercise, added_weight, weight_unit, sum(amount) AS total_{_kind} "
            f"FROM sets WHERE {_flag} GROUP BY ALL")
for _grain, _keys in (("monthly", "year, month_int, month"), ("yearly", "year")):
    _zero, _more = "count(*) FILTER (WHERE added_weight = 0)", "count(*) FILTER (WHERE added_weight > 0)"
    MARTS[f"{_grain}_bodyweight_vs_weighted_workouts"] = f"""SELECT {_keys}, {_zero} AS bodyweight_sets,
        {_more} AS weighted_sets, {_percent(_zero, f"{_zero} + {_more}")} AS bodyweight_percentage,
        {_percent(_more, f"{_zero} + {_more}")} AS weighted_percentage FROM sets GROUP BY {_keys}"""
for _mart, _keys in (("workouts_per_month_per_year", "year, month_int, month"), ("workout_sessions_per_year", "year"),
                     ("yearly_workouts_per_type", "year, workout_type")):
    MARTS[_mart] = f"SELECT {_keys}, count(DISTINCT workout_counter) AS total_workouts FROM sets GROUP BY {_keys}"

# ---- output columns (in order) ------------------------------------------------

_MOM = ("year, month_int, month, exercise, last_month_reps, total_reps, added_weight, "
        "weight_unit, mom_percentage_change, mom_absolute_change")
_YOY = ("year, month_int, month, exercise, last_year_reps, total_reps, added_weight, "
        "weight_unit, yoy_percentage_change, yoy_absolute_change")
_ROLL = "exercise, {m}, added_weight, weight_unit"
COLUMNS: dict[str, str] = {
    "stg_workout_journal": ("month, month_int, weekday, weekday_int, year, date, deload_bool, "
                            "workout_counter, set_counter, workout_type, workout_section, exercise, "
                            "added_weight, weight_unit, bodyweight, grip, amount, rest"),
    "main_exercises": "exercise",
    "exercises_calculated_in_reps": "exercise",
    "exercises_calculated_in_seconds": "exercise",
    "monthly_aggregates_every_possible_combination":
        "year, month_int, month, exercise, total_reps, added_weight, weight_unit",
    "mom_changes": _MOM,
    "mom_changes_reps": _MOM,
    "mom_changes_seconds": _MOM.replace("last_month_reps", "last_month_seconds")
                                   .replace(" total_reps", " total_seconds"),
    "yoy_changes": _YOY,
    "yoy_changes_reps": _YOY,
    "yoy_changes_seconds": _YOY.replace("last_year_reps", "last_year_seconds")
                                   .replace(" total_reps", " total_seconds"),
    "monthly_added_volume_lifted": "year, month_int, month, exercise, total_added_volume, weight_unit",
    "monthly_bodyweight_vs_weighted_workouts": ("year, month_int, month, bodyweight_sets, weighted_sets, "
                                                "bodyweight_percentage, weighted_percentage"),
    "yearly_bodyweight_vs_weighted_workouts": ("year, bodyweight_sets, weighted_sets, "
                                               "bodyweight_percentage, weighted_percentage"),
    "workouts_per_month_per_year": "year, month_int, month, total_workouts",
    "month_with_most_workouts_per_year": "year, month_int, month, total_workouts",
    "workout_sessions_per_year": "year, total_workouts",
    "yearly_workouts_per_type": "year, workout_type, total_workouts",
    "workout_vs_rest_days": "year, month_int, month, date, rest:keep",
    "workout_days_per_year_percentage": "year, total_days, workout_days, workout_percentage, rest_percentage",
    "workout_frequency_weekday": "year, weekday_int, weekday, total_workouts",
}
COLUMNS["mom_changes_seconds_corrected"] = COLUMNS["mom_changes_seconds"]
COLUMNS["yoy_changes_seconds_corrected"] = COLUMNS["yoy_changes_seconds"]
for _kind in ("reps", "seconds"):
    _m = f"total_{_kind}"
    COLUMNS[f"daily_{_kind}_per_exercise_weight"] = "date, " + _ROLL.format(m=_m)
    COLUMNS[f"monthly_{_kind}_per_exercise_weight"] = "year, month_int, month, " + _ROLL.format(m=_m)
    COLUMNS[f"yearly_{_kind}_per_exercise_weight"] = "year, " + _ROLL.format(m=_m)
    COLUMNS[f"total_{_kind}_per_exercise_weight"] = _ROLL.format(m=_m)

INT_COLUMNS = {
    "year", "month_int", "weekday_int", "workout_counter", "set_counter", "amount", "rest",
    "total_reps", "total_seconds", "last_month_reps", "last_month_seconds", "last_year_reps",
    "last_year_seconds", "mom_absolute_change", "yoy_absolute_change", "bodyweight_sets",
    "weighted_sets", "total_workouts", "total_days", "workout_days", "deload", "weekday_position", "position", "violations",
    "total_amount", "broken",
}
NUM_COLUMNS = {
    "added_weight", "weight", "total_added_volume", "mom_percentage_change", "yoy_percentage_change",
    "bodyweight_percentage", "weighted_percentage", "workout_percentage", "rest_percentage",
    "display_weight",
}


def _edge_select(cols: str) -> str:
    out = []
    for c in (x.strip() for x in cols.split(",")):
        if c.endswith(":keep"):          # same name, different meaning (e.g. boolean rest)
            out.append(c[:-5])
        elif c in INT_COLUMNS:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c in NUM_COLUMNS:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def compose(select: str, columns: str, given=(), **steps: str) -> str:
    """``select`` with the steps it needs (``steps`` are its own) and edge-typed ``columns``.

    Steps named in ``given`` are views that exist already.
    """
    known = {k: v for k, v in {**STEPS, **steps}.items() if k not in given}
    order: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"[a-z_]+", sql):
            if name in known and name not in order and re.search(rf"(FROM|JOIN|,)\s+{name}\b", sql):
                need(known[name])
                order.append(name)

    need(select)
    clauses = [f"{name} AS ({known[name]})" for name in dict.fromkeys(order)]
    return "WITH " + ",\n".join([*clauses, f"result AS ({select})"]) + f"\nSELECT {_edge_select(columns)} FROM result"


def mart_sql(name: str) -> str:
    return compose(MARTS[name], COLUMNS[name])


def mart_sql_on_journal(name: str) -> str:
    """The oracle for ``name`` starting from a registered ``journal`` view
    (used to compare both engines on hand-made journals)."""
    return compose(MARTS[name], COLUMNS[name], given=("journal",))


def main_exercises_sql(names) -> str:
    return compose(f"SELECT exercise FROM sets WHERE exercise IN ({_quoted(names)})", COLUMNS["main_exercises"])


def ordered_sql(name: str, keys) -> str:
    """A mart with each row's place among the rows that share the first sort key."""
    first, *rest = keys
    by = ", ".join(f"{k[1:]} DESC" if k.startswith("-") else k for k in rest)
    return compose(f"SELECT *, rank() OVER (PARTITION BY {first} ORDER BY {by}) AS position FROM ({MARTS[name]})",
                   COLUMNS[name] + ", position")


def placed_sql(name: str, keys) -> str:
    """A mart with each row's place in the whole table."""
    by = ", ".join(f"{k[1:]} DESC NULLS FIRST" if k.startswith("-") else f"{k} NULLS LAST" for k in keys)
    return compose(f"SELECT *, rank() OVER (ORDER BY {by}) AS position FROM ({MARTS[name]})",
                   COLUMNS[name] + ", position")


def by_log_sql(name: str) -> str:
    """A mart of each log (the fixture's two sections), one below the other."""
    logs = []
    for log in ("f", "o"):
        own = compose(MARTS[name], COLUMNS[name], journal=STEPS["journal"] + f" WHERE lower(l_linestatus) = '{log}'")
        logs.append(f"SELECT '{log}' AS log, * FROM ({own})")
    return " UNION ALL ".join(logs)


# ---- presentation queries ------------------------------------------------------------

def dashboard_sql(exercises, as_of, weight_kg, year) -> dict[str, str]:
    """The presentation queries with the fixture's parameters."""
    names, (y, m) = _quoted(exercises), as_of
    view = ("year, month_int, month, exercise, added_weight, last_month_reps, total_reps, "
            "mom_percentage_change, mom_absolute_change")
    months = f"""SELECT * FROM ({MARTS["mom_changes_reps"]})
        WHERE (year, month_int) <= ({y}, {m}) AND exercise IN ({names})"""
    years = f"""SELECT * FROM ({MARTS["yearly_reps_per_exercise_weight"]})
        WHERE year <= {y} AND exercise IN ({names})"""
    shown = lambda unit, w: f"ROUND({w} * {LBS_PER_KG if unit == 'lbs' else 1}, 2)"
    steps = {"month_view": months, "year_view": years,
             "weekday_view": f"SELECT * FROM weekdays WHERE year < {WEEKDAY_YEAR_BOUND}"}
    for unit in ("lbs", "kg"):
        steps[f"month_{unit}"] = (f"SELECT *, {shown(unit, 'added_weight')} AS display_weight, "
                                  f"'{unit}' AS display_unit FROM month_view")
    chosen = f"display_weight = {shown('lbs', f'CAST({weight_kg} AS DECIMAL(5,2))')}"
    more = view + ", display_weight, display_unit"
    specs = {
        "dash_mom": ("SELECT * FROM month_view", view),
        "dash_yoy": ("SELECT * FROM year_view", "year, exercise, added_weight, total_reps"),
        "dash_weekday": ("SELECT * FROM weekday_view", "year, weekday_int, weekday, total_workouts"),
        "dash_units": ("SELECT * FROM month_lbs", more),
        "dash_units_kg": ("SELECT * FROM month_kg", more),
        "dash_weight_options": ("SELECT display_weight, row_number() OVER (ORDER BY display_weight) AS position "
                                "FROM (SELECT DISTINCT display_weight FROM month_lbs)", "display_weight, position"),
        "dash_year_options": ("SELECT year, row_number() OVER (ORDER BY year) AS position "
                              "FROM (SELECT DISTINCT year FROM month_view)", "year, position"),
        "dash_filter": (f"SELECT * FROM month_lbs WHERE {chosen}", more),
        "dash_month_date": (f"SELECT *, make_date(year, month_int, 1) AS date FROM month_lbs WHERE {chosen}", more + ", date"),
        "dash_yearly_sorted": (
            f"SELECT *, 'lbs' AS display_unit, rank() OVER (ORDER BY exercise, total_reps, display_weight) AS position "
            f"FROM (SELECT *, {shown('lbs', 'added_weight')} AS display_weight FROM year_view WHERE year = {year})",
            "year, exercise, added_weight, total_reps, display_weight, display_unit, position"),
        "dash_bubble": (f"SELECT * FROM month_lbs WHERE year = {year}", more),
        "dash_heatmap": (f"""SELECT year, weekday, SUM(total_workouts) AS total_workouts,
            CAST(list_position({_array(HEATMAP_WEEKDAY_ORDER)}, weekday) AS INTEGER) AS weekday_position
            FROM weekday_view GROUP BY year, weekday""", "year, weekday, total_workouts, weekday_position"),
        "dash_heatmap_wide": ("SELECT CAST(list_position({order}, weekday) AS INTEGER) AS weekday_position, weekday, "
                              "{years} FROM weekday_view GROUP BY weekday".format(
                                  order=_array(HEATMAP_WEEKDAY_ORDER),
                                  years=", ".join(f"CAST(sum(total_workouts) FILTER (WHERE year = {y}) AS BIGINT) AS y{y}"
                                                  for y in WIDE_YEARS)),
                              "weekday_position, weekday, " + ", ".join(f"y{y}" for y in WIDE_YEARS)),
    }
    return {k: compose(sql, cols, **steps) for k, (sql, cols) in specs.items()}


# ---- grid parser round trip, weight texts, quality report ----------------------

_FIXTURE_LINES = """
sess AS (
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 27 YEAR AS DATE) AS dt
    FROM orders),
lines AS (
    SELECT l.*, p.p_brand, p.p_size, s.*,
           row_number() OVER (PARTITION BY l.l_orderkey, l.l_linestatus
                              ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
                                       l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag) AS set_idx,
           CAST(CAST(round(l.l_discount * 100) AS INTEGER) * 2.5 AS DECIMAL(5,2)) AS w_kg
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN sess s ON l.l_orderkey = s.o_orderkey)"""

ROUNDTRIP = "WITH " + _FIXTURE_LINES.strip() + """
SELECT lower(monthname(dt)) AS month, lower(dayname(dt)) AS weekday, dt AS date,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS BIGINT) AS deload,
       CAST(dayofyear(dt) AS BIGINT) AS workout_counter,
       CAST(set_idx AS BIGINT) AS set_counter,
       lower(o_orderpriority) AS type,
       CASE WHEN l_linestatus = 'F' THEN 'pull' ELSE 'push' END AS section,
       lower(p_brand) || CASE WHEN p_size % 10 = 0 THEN ' hold (s)'
                              WHEN p_size % 10 = 1 THEN ' + dips' ELSE '' END AS exercise,
       CAST(w_kg AS DOUBLE) AS weight,
       'kg' AS weight_unit,
       lower(l_returnflag) AS grip,
       CAST(CAST(l_quantity AS SMALLINT) AS BIGINT) AS amount,
       CAST(CAST(round(l_tax * 100) AS INTEGER) * 15 AS BIGINT) AS rest
FROM lines
WHERE year(dt) <> 2023"""

# weight texts of the odd cells fixture, parsed: what Python's float() reads before the first 'kg'
CLEAN_WEIGHT = f"""
WITH texts AS (SELECT DISTINCT {ODD_SQL["weight_text"]} AS weight_text FROM lineitem),
parts AS (SELECT weight_text, contains(weight_text, 'Bodyweight') AS body, contains(weight_text, 'kg') AS kg,
                 trim(split_part(weight_text, 'kg', 1)) AS number FROM texts),
numbers AS (SELECT *, CASE WHEN body THEN 0.0
                           WHEN kg AND regexp_full_match(number, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
                           THEN TRY_CAST(number AS DOUBLE) END AS value FROM parts)
SELECT weight_text, CASE WHEN abs(value) < 999.995 THEN round_even(value * 100, 0) / 100 END AS weight,
       CASE WHEN body OR kg THEN 'kg' END AS weight_unit
FROM numbers"""

_NOT_NULL = ("month weekday date deload workout_counter set_counter type section exercise weight "
             "weight_unit grip amount rest").split()
_RULES = [(f"not_null_{c}", f"{c} IS NULL") for c in _NOT_NULL] + [
    ("unit_allowed", "weight_unit NOT IN ('kg', 'lbs')"),
    ("deload_is_flag", "deload NOT IN (0, 1)"),
    ("weight_fits_5_2", "abs(weight) >= 1000"),
    ("month_name_known", f"list_position({_array(MONTH_NAMES)}, month) IS NULL AND month IS NOT NULL"),
    ("weekday_name_known", f"list_position({_array(WEEKDAY_NAMES)}, weekday) IS NULL AND weekday IS NOT NULL"),
    ("month_matches_date", "month <> lower(monthname(date))"),
    ("weekday_matches_date", "weekday <> lower(dayname(date))"),
    ("negative_amount", "amount < 0"),
]
STEPS["odd_lines"] = f"""
    SELECT * REPLACE ({", ".join(f"{sql} AS {c}" for c, sql in ODD_SQL.items() if c != "weight_text")})
    FROM (SELECT *, {STEPS["journal"].strip()[len("SELECT "):]})"""
STEPS["cell_variants"] = f"""
    SELECT count(DISTINCT (month, weight_unit)) FILTER (WHERE month IS NOT NULL AND weight_unit IS NOT NULL) AS variants
    FROM odd_lines
    GROUP BY year(date), list_position({_array(MONTH_NAMES)}, month), exercise, weight"""
CHECK_JOURNAL = compose(
    " UNION ALL ".join([f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {p}) AS violations FROM odd_lines" for n, p in _RULES]
                       + ["SELECT 'one_unit_per_cell', count(*) FILTER (WHERE variants > 1) FROM cell_variants"]),
    "rule, violations")

# ---- tables: single years, the text dump, refused rows, a given dimension

_JOURNAL = "month, weekday, date, deload, workout_counter, set_counter, type, section, exercise, weight, weight_unit, grip, amount, rest"
_REFUSED = [(1 << i, n, p) for i, (n, p) in enumerate(_RULES)
            if n.startswith("not_null_") or n in ("unit_allowed", "weight_fits_5_2")]
TABLES: dict[str, str] = {
    "refresh_year_journal": compose("SELECT * FROM journal", _JOURNAL),
    "dump_roundtrip": compose("SELECT * FROM journal", _JOURNAL),
    "refresh_year_totals": compose(
        "SELECT exercise, added_weight, weight_unit, sum(amount) AS total_amount FROM sets GROUP BY ALL",
        "exercise, added_weight, weight_unit, total_amount"),
    "rejected_rows": compose(
        "SELECT *, {bits} AS broken, concat_ws(',', {names}) AS reasons FROM odd_lines WHERE {any}".format(
            bits=" + ".join(f"CASE WHEN {p} THEN {b} ELSE 0 END" for b, _, p in _REFUSED),
            names=", ".join(f"CASE WHEN {p} THEN '{n}' END" for _, n, p in _REFUSED),
            any=" OR ".join(f"coalesce({p}, FALSE)" for _, _, p in _REFUSED)), _JOURNAL + ", broken, reasons"),
    "semi_join_dimension": compose("""SELECT date, exercise, added_weight, amount FROM sets WHERE exercise IN (
        SELECT lower(p_brand) || CASE p_size % 10 WHEN 0 THEN ' hold (s)' WHEN 1 THEN ' + dips' ELSE '' END
        FROM part WHERE p_brand LIKE 'Brand#1_' AND p_type = 'ECONOMY')""", "date, exercise, added_weight, amount"),
}
