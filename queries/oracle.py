"""DuckDB twins of the registered queries, written as plain SQL.

Nothing here is generated from the Spark plans; only the snippets that shape
inputs (queries.inputs) are shared text.
"""

from __future__ import annotations

from queries import inputs as i
from tidepanel import config
from tidepanel.functions.calendar import FIXED_HOLIDAYS

ORACLE: dict[str, str] = {}
H = range(1, 8)


def r(expr: str, name: str, places: int = 6) -> str:
    """Rounded double; adding 0 turns a negative zero into zero."""
    return f"ROUND(CAST({expr} AS DOUBLE), {places}) + 0.0 AS {name}"


def rs(names, places: int = 6) -> str:
    return ", ".join(r(n, n, places) for n in names)


def even(expr: str, places: int) -> str:
    return f"round_even(CAST({expr} AS DOUBLE), {places})"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join(c.strip() for c in ctes) + " "


PANEL = """panel AS (
  SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2)"""
TOTALS = """totals AS (
  SELECT CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS total FROM lineitem GROUP BY 1)"""
WEATHER = f"weather AS (SELECT {i.WEATHER_SELECT} FROM orders GROUP BY CAST(o_orderdate AS DATE))"
NATIONS = "nations AS (SELECT s_suppkey AS entity, s_nationkey AS cluster FROM supplier)"

Y0, Y1 = i.YEARS
_fixed = ", ".join(f"make_date(y, {m}, {d})" for m, d in FIXED_HOLIDAYS)
# Easter by the Gauss rule with its two corrections, an independent formula.
HOLIDAYS = f"""
years AS (SELECT CAST(y AS BIGINT) AS y FROM generate_series({Y0}, {Y1}) t(y)),
gauss AS (SELECT y, y % 19 AS a, y % 4 AS b, y % 7 AS c, y // 100 AS k FROM years),
gauss2 AS (SELECT *, (15 - (13 + 8 * k) // 25 + k - k // 4) % 30 AS m, (4 + k - k // 4) % 7 AS n FROM gauss),
gauss3 AS (SELECT *, (19 * a + m) % 30 AS d FROM gauss2),
gauss4 AS (SELECT *, (2 * b + 4 * c + 6 * d + n) % 7 AS e FROM gauss3),
easter AS (SELECT y, make_date(y, 3, 22) + CAST(
    CASE WHEN d = 29 AND e = 6 THEN 28
         WHEN d = 28 AND e = 6 AND (11 * m + 11) % 30 < 19 THEN 27
         ELSE d + e END AS INTEGER) AS sunday FROM gauss4),
holidays AS (SELECT DISTINCT unnest([{_fixed}, sunday + 1, sunday + 39, sunday + 50]) AS day FROM easter)
"""
_breaks = " UNION ALL ".join(
    f"SELECT '{zone}' AS zone, make_date(y, {m}, {d}) AS first, make_date(y, {m}, {d}) + {n} AS last FROM byears"
    for zone, parts in i.SCHOOL_BREAKS.items()
    for m, d, n in parts
)
SCHOOL = f"""
byears AS (SELECT CAST(y AS BIGINT) AS y FROM generate_series({Y0 - 1}, {Y1}) t(y)),
school AS ({_breaks})
"""


def flags(day: str) -> str:
    return f"""
    isodow({day}) >= 6 AS IS_WEEKEND,
    EXISTS (SELECT 1 FROM holidays h WHERE h.day = {day}) AS IS_FERIE,
    EXISTS (SELECT 1 FROM school s WHERE s.zone = 'C' AND {day} BETWEEN s.first AND s.last) AS IS_VACANCES,
    (isodow({day}) = 5 AND EXISTS (SELECT 1 FROM holidays h WHERE h.day = {day} - 1))
      OR (isodow({day}) = 1 AND EXISTS (SELECT 1 FROM holidays h WHERE h.day = {day} + 1)) AS IS_PONT
    """


CALENDAR = f"""{HOLIDAYS}, {SCHOOL},
spine AS (SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '{Y0}-01-01', DATE '{Y1}-12-31', INTERVAL 1 DAY) t(d)),
calendar AS (SELECT day, {flags('spine.day')} FROM spine)
"""
FLAGS = "IS_WEEKEND, IS_FERIE, IS_VACANCES, IS_PONT"
SKY = ["RR", "TN", "TX", "TM", "FFM"]
JOINED = f"joined AS (SELECT p.*, {', '.join('w.' + c for c in SKY)}, {FLAGS} FROM panel p LEFT JOIN weather w USING (day) LEFT JOIN calendar USING (day))"
MEDIANS = "med AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in SKY) + " FROM joined)"
FILLED = "filled AS (SELECT entity, day, value, " + ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in SKY) + f", {FLAGS} FROM joined, med)"
TIME = """
  CAST(isodow(day) - 1 AS INTEGER) AS jour_semaine,
  CAST(day(day) AS INTEGER) AS jour_mois,
  CAST(dayofyear(day) AS INTEGER) AS jour_annee,
  CAST(weekofyear(day) AS INTEGER) AS semaine_annee,
  CAST(month(day) AS INTEGER) AS mois,
  CAST(quarter(day) AS INTEGER) AS trimestre,
  CAST(year(day) AS INTEGER) AS annee,
  CAST(day(day) <= 5 AS INTEGER) AS is_debut_mois,
  CAST(day(day) >= 25 AS INTEGER) AS is_fin_mois,
  sin(2 * pi() * month(day) / 12) AS mois_sin,
  cos(2 * pi() * month(day) / 12) AS mois_cos
"""
TIME_INT = config.TIME_COLUMNS[:-2]
TIME_OUT = ", ".join(TIME_INT) + ", " + rs(["mois_sin", "mois_cos"])
SKY_PARTS = """
  TX - TN AS amplitude, ln(1 + RR) AS log_RR,
  CAST(RR >= 1 AS INTEGER) AS is_rain, CAST(FFM >= 12 AS INTEGER) AS is_wind,
  CAST(TM <= 5 AS INTEGER) AS is_cold, CAST(TM >= 28 AS INTEGER) AS is_hot
"""
SKY_FLAGS = ["is_rain", "is_wind", "is_cold", "is_hot"]


def in_train(c: str) -> str:
    return f"{c} >= DATE '{i.EXCLUDED[1]}' OR {c} < DATE '{i.EXCLUDED[0]}'"


KEPT = f"kept AS (SELECT * FROM panel WHERE {in_train('day')})"
W = "PARTITION BY entity ORDER BY day"

# ---------------------------------------------------------------- sources

ORACLE["file_audit_missing"] = """
WITH e AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem),
     o AS (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
     d AS (SELECT * FROM e EXCEPT SELECT * FROM o)
SELECT CAST(y AS INTEGER) AS year, 'M' || lpad(CAST(m AS VARCHAR), 2, '0') AS period,
       'raw/validations/data-' || y || '-validations/' || y || '-M' || lpad(CAST(m AS VARCHAR), 2, '0')
       || '-validations.csv' AS path FROM d
"""
ORACLE["weather_daily"] = f"""
SELECT CAST(o_orderdate AS DATE) AS day, {r('MAX(o_totalprice)', 'RR')}, {r('MIN(o_totalprice)', 'TN')},
  {r('MAX(o_totalprice)', 'TX')}, {r('MIN(o_totalprice)', 'TM')}, {r('COUNT(*)', 'FFM')}
FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND year(o_orderdate) >= 1996 GROUP BY 1
"""
ORACLE["calendar_flags"] = with_(TOTALS, HOLIDAYS, SCHOOL) + f"SELECT day, total, {flags('totals.day')} FROM totals"
ORACLE["public_holidays"] = with_(TOTALS, HOLIDAYS) + "SELECT day, total FROM totals JOIN holidays USING (day)"
ORACLE["school_holidays_range"] = with_(TOTALS, SCHOOL) + """
SELECT day, total, EXISTS (SELECT 1 FROM school s WHERE s.zone = 'C' AND totals.day BETWEEN s.first AND s.last) AS IS_VACANCES
FROM totals"""
ORACLE["bridge_days"] = with_(TOTALS, HOLIDAYS, SCHOOL, f"f AS (SELECT day, total, {flags('totals.day')} FROM totals)") + \
    "SELECT day, total, IS_PONT FROM f"

RAW = f"raw AS (SELECT {i.raw_cells(chr(39).join(['strftime(l_shipdate, ', '%Y-%m-%d', ')']), chr(39).join(['strftime(l_shipdate, ', '%d/%m/%Y', ')']))}, l_shipdate FROM lineitem)"
TYPED = """typed AS (
  SELECT CAST(COALESCE(try_strptime(JOUR, '%Y-%m-%d'), try_strptime(JOUR, '%d/%m/%Y')) AS DATE) AS JOUR,
         CAST(trunc(TRY_CAST(lda AS DOUBLE)) AS BIGINT) AS ID_LIEU, CATEGORIE_TITRE,
         CASE WHEN regexp_replace(NB_VALD, '[\\s\\p{Z}]', '', 'g') = 'Moinsde5' THEN 3.0
              ELSE TRY_CAST(regexp_replace(NB_VALD, '[\\s\\p{Z}]', '', 'g') AS DOUBLE) END AS NB_VALD,
         l_shipdate
  FROM raw)"""
ORACLE["clean_types"] = with_(RAW, TYPED) + """
SELECT JOUR, COALESCE(ID_LIEU, -1) AS ID_LIEU, SUM(NB_VALD) AS total, COUNT(*) AS n, COUNT(*) FILTER (WHERE NB_VALD IS NULL) AS n_null
FROM typed GROUP BY 1, 2"""
ORACLE["harmonise_union"] = with_(RAW, TYPED) + """
SELECT CAST(year(l_shipdate) AS VARCHAR) AS ANNEE, CASE WHEN month(l_shipdate) <= 6 THEN 'S1' ELSE 'S2' END AS PERIODE,
  CATEGORIE_TITRE, COUNT(*) AS n, SUM(NB_VALD) AS total, CAST(SUM(ID_LIEU) AS BIGINT) AS id_sum
FROM typed WHERE ID_LIEU IS NOT NULL AND NB_VALD IS NOT NULL GROUP BY ALL"""
ORACLE["raw_files_daily"] = with_(RAW, TYPED) + """
SELECT JOUR, ID_LIEU, SUM(NB_VALD) AS NB_VALD_TOTAL, CAST(year(JOUR) AS VARCHAR) AS ANNEE
FROM typed WHERE ID_LIEU IS NOT NULL AND NB_VALD IS NOT NULL GROUP BY JOUR, ID_LIEU"""
ORACLE["drop_ids"] = with_(PANEL, NATIONS) + """
SELECT entity, COUNT(*) AS n_days, SUM(value) AS total FROM panel
WHERE entity NOT IN (0, 3, 999999) AND entity NOT IN (SELECT entity FROM nations WHERE cluster = 7) GROUP BY 1"""


def title(s: str) -> str:
    tidy = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    return (
        f"array_to_string(list_transform(regexp_extract_all({tidy}, '\\p{{L}}+|[^\\p{{L}}]+'), "
        "lambda x: upper(x[1]) || lower(x[2:])), '')"
    )


def key(s: str) -> str:
    out = f"lower(strip_accents({s}))"
    for pattern in (r"\b(t\d{1,2}|rer\s*[a-e])\b", r"[^\w\s]", r"\s+"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"trim({out})"


ORACLE["normalize_labels"] = f"SELECT p_partkey, {title(i.PART_LABEL)} AS label FROM part"
ORACLE["label_keys"] = f"SELECT p_partkey, {key(i.PART_LABEL)} AS key FROM part"
ORACLE["exclude_window"] = with_(PANEL, KEPT) + f"SELECT * FROM kept WHERE day >= DATE '{i.TRAIN_FROM}'"
ORACLE["min_history"] = with_(PANEL) + """
SELECT entity, COUNT(*) AS n_days, SUM(value) AS total FROM panel GROUP BY entity HAVING COUNT(*) > 530"""

MULTI = f"""
multi0 AS (SELECT * FROM panel WHERE {i.ENTITY_ALIVE}),
multi AS (SELECT entity, day, {i.ENTITY_VALUE} AS value, {i.ENTITY_LABEL} AS label FROM multi0)"""
ORACLE["entity_labels"] = with_(PANEL, MULTI) + """
SELECT entity, MIN(label) AS label, arg_min(label, day) AS first_label FROM multi GROUP BY entity"""
ORACLE["distinct_entities"] = "SELECT DISTINCT l_suppkey AS entity FROM lineitem"

# ---------------------------------------------------------------- panel

ORACLE["panel_daily"] = with_(PANEL) + """
SELECT day, entity, value, s_name AS label FROM panel JOIN supplier ON s_suppkey = entity"""
ORACLE["panel_joined"] = with_(PANEL, WEATHER, CALENDAR, JOINED) + f"""
SELECT day, entity, {rs(['value', *SKY])}, {FLAGS} FROM joined WHERE day >= DATE '{i.TRAIN_FROM}'"""
_q = lambda name, expr: f"SELECT '{name}' AS \"check\", CAST({expr} AS VARCHAR) AS value"
ORACLE["quality_report"] = with_(
    PANEL,
    "f AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS day, l_quantity AS q FROM lineitem)",
) + " UNION ALL ".join(
    [_q(n, e) + " FROM f" for n, e in [
        ("fact_rows", "COUNT(*)"), ("fact_null_days", "COUNT(*) FILTER (day IS NULL)"),
        ("fact_null_ids", "COUNT(*) FILTER (entity IS NULL)"), ("fact_null_counts", "COUNT(*) FILTER (q IS NULL)"),
        ("fact_min_count", "CAST(MIN(q) AS BIGINT)"), ("fact_max_count", "CAST(MAX(q) AS BIGINT)"),
        ("fact_first_day", "MIN(day)"), ("fact_last_day", "MAX(day)")]]
    + [_q(n, e) + " FROM panel" for n, e in [
        ("panel_rows", "COUNT(*)"), ("panel_entities", "COUNT(DISTINCT entity)"),
        ("panel_min_value", "CAST(MIN(value) AS BIGINT)"),
        ("panel_sentinels", "COUNT(*) FILTER (entity IN (-1, 0, 999999))"),
        ("panel_duplicate_keys", "COUNT(*) - COUNT(DISTINCT (entity, day))")]]
)
ORACLE["duplicate_keys"] = """
SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey AS entity, COUNT(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING COUNT(*) > 1"""
ORACLE["entities_per_year"] = with_(PANEL) + """
SELECT CAST(year(day) AS INTEGER) AS year, COUNT(DISTINCT entity) AS entities FROM panel GROUP BY 1"""
ORACLE["busiest_entity"] = with_(PANEL) + """
SELECT entity, COUNT(*) AS n_rows FROM panel GROUP BY 1 ORDER BY n_rows DESC, entity LIMIT 1"""
ORACLE["panel_summary"] = with_(PANEL) + """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT entity) AS n_entities, CAST(3 AS BIGINT) AS n_columns FROM panel"""
ORACLE["volume_ranking"] = with_(PANEL) + f"SELECT entity, {r('AVG(value)', 'mean_value')} FROM panel GROUP BY 1"

# ---------------------------------------------------------------- entities

ORACLE["entity_lifetimes"] = with_(PANEL, MULTI) + """
SELECT entity, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n_days FROM multi GROUP BY 1"""
PAIRS = f"pairs AS (SELECT DISTINCT {key('label')} AS key, entity FROM multi WHERE label IS NOT NULL)"
ORACLE["ids_per_key"] = with_(PANEL, MULTI, PAIRS) + """
SELECT key, COUNT(*) AS n_ids, MIN(entity) AS min_id, MAX(entity) AS max_id FROM pairs GROUP BY 1"""
# Closure of "shares an id" over keys; the component is its smallest key.
GROUPS = """
reach(key, other) AS (
  SELECT key, key FROM pairs
  UNION
  SELECT reach.key, b.key FROM reach JOIN pairs a ON a.key = reach.other JOIN pairs b ON a.entity = b.entity),
groups AS (SELECT key, MIN(other) AS grp FROM reach GROUP BY key),
grouped AS (SELECT pairs.key, entity, grp FROM pairs JOIN groups USING (key))"""
ORACLE["key_components"] = with_(PANEL, MULTI, PAIRS, GROUPS) + 'SELECT key, entity, grp AS "group" FROM grouped'
LIVES = """lives AS (SELECT entity, MIN(day) AS a, MAX(day) AS b FROM multi GROUP BY 1)"""
NLIVES = "nlives AS (SELECT cluster AS grp, lives.* FROM lives JOIN nations USING (entity))"


def overlap(source: str, name: str) -> str:
    """Largest pairwise overlap by the plain theta self join."""
    return f"""{name} AS (
  SELECT g.grp, CAST(greatest(0, COALESCE(MAX(CASE WHEN y.entity IS NOT NULL
      THEN least(x.b, y.b) - greatest(x.a, y.a) END), 0)) AS INTEGER) AS overlap
  FROM (SELECT DISTINCT grp FROM {source}) g JOIN {source} x USING (grp)
  LEFT JOIN {source} y ON x.grp = y.grp AND x.entity < y.entity GROUP BY g.grp)"""


def means(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT m.grp, multi.entity, AVG(value) AS mean FROM {source} m JOIN multi USING (entity)
  JOIN (SELECT grp, MAX(a) AS a, MIN(b) AS b FROM {source} GROUP BY 1) w ON w.grp = m.grp
  WHERE multi.day BETWEEN w.a AND w.b GROUP BY 1, 2)"""


ORACLE["lifetime_overlap"] = with_(PANEL, MULTI, NATIONS, LIVES, NLIVES, overlap("nlives", "o")) + \
    'SELECT grp AS "group", overlap FROM o'
ORACLE["common_window_means"] = with_(PANEL, MULTI, NATIONS, LIVES, NLIVES, means("nlives", "m")) + \
    f'SELECT grp AS "group", entity, {r("mean", "mean")} FROM m'

_over = ", ".join(f"('{k}', '{v}')" for k, v in i.OVERRIDES.items())
ACTIONS = f"""
members AS (SELECT DISTINCT grp, entity FROM grouped
            WHERE grp IN (SELECT grp FROM grouped GROUP BY grp HAVING COUNT(DISTINCT entity) > 1)),
mlives AS (SELECT grp, lives.* FROM members JOIN lives USING (entity)),
{overlap('mlives', 'mover')}, {means('mlives', 'mmeans')},
ratio AS (SELECT grp, MIN(mean) AS low, MAX(mean) AS high FROM mmeans GROUP BY 1),
target AS (SELECT grp, entity AS target FROM mlives
           QUALIFY row_number() OVER (PARTITION BY grp ORDER BY b DESC, entity DESC) = 1),
canon AS (SELECT grp, key AS canonical FROM (SELECT DISTINCT grp, key FROM grouped)
          QUALIFY row_number() OVER (PARTITION BY grp ORDER BY length(key) DESC, key) = 1),
overrides(key, forced) AS (VALUES {_over}),
forced AS (SELECT grp, arg_min(forced, key) AS forced FROM grouped JOIN overrides USING (key) GROUP BY 1),
decided AS (SELECT target.grp, target, canonical, overlap, COALESCE(forced,
    CASE WHEN overlap < 7 THEN 'merge_sum' WHEN high IS NULL OR high = 0 THEN 'merge_max'
         WHEN low / high >= 0.65 THEN 'merge_max' ELSE 'merge_sum' END) AS action
  FROM target JOIN canon USING (grp) JOIN mover USING (grp) LEFT JOIN ratio USING (grp) LEFT JOIN forced USING (grp)),
actions AS (SELECT entity, decided.* FROM members JOIN decided USING (grp) WHERE action <> 'skip')"""
DETECT = [PANEL, MULTI, PAIRS, GROUPS, LIVES, ACTIONS]
ORACLE["entity_actions"] = with_(*DETECT) + \
    'SELECT entity, target, action, grp AS "group", canonical, overlap FROM actions'
MOVED = """
moved AS (SELECT day, COALESCE(target, multi.entity) AS entity, value, label, multi.entity AS source_id,
          COALESCE(action, 'keep') AS action FROM multi LEFT JOIN actions USING (entity)),
applied AS (SELECT day, entity, MAX(value) AS value, arg_max(label, source_id) AS label, MAX(source_id) AS source_id
            FROM moved WHERE action = 'merge_max' GROUP BY 1, 2
            UNION ALL SELECT day, entity, value, label, source_id FROM moved WHERE action <> 'merge_max')"""
ORACLE["merge_actions"] = with_(*DETECT, MOVED) + f"SELECT day, entity, {r('value', 'value')}, label, source_id FROM applied"
_hubs = ", ".join(
    f"('{k}', CAST({i.HUB_BASE - n} AS BIGINT), '{name}')" for n, (name, keys) in enumerate(i.HUBS.items()) for k in keys
)


def hubbed(source: str) -> str:
    return f"""
hubs(key, hub_id, hub_name) AS (VALUES {_hubs}),
hubkeys AS (SELECT DISTINCT entity, {key('label')} AS key FROM {source}),
hubof AS (SELECT entity, MIN(hub_id) AS hub_id, arg_min(hub_name, hub_id) AS hub_name
          FROM hubkeys JOIN hubs USING (key) GROUP BY 1),
hubbed AS (SELECT s.* REPLACE (COALESCE(hub_id, s.entity) AS entity, COALESCE(hub_name, label) AS label)
           FROM {source} s LEFT JOIN hubof ON hubof.entity = s.entity)"""


ORACLE["hub_merge"] = with_(PANEL, MULTI, hubbed("multi")) + f"""
SELECT entity, COUNT(*) AS n, {r('SUM(value)', 'total')}, MAX(label) AS last_label FROM hubbed GROUP BY 1"""
ORACLE["merge_entities"] = with_(*DETECT, MOVED, hubbed("applied")) + f"""
SELECT day, entity, {r('SUM(value)', 'value')}, arg_max(label, source_id) AS label FROM hubbed GROUP BY 1, 2"""

# ---------------------------------------------------------------- profiles


def profiles(source: str, where: str = "TRUE") -> str:
    def m(cond):
        return f"AVG(value) FILTER ({cond})"

    return f"""SELECT entity, AVG(value) AS nb_vald_moyen, stddev_samp(value) AS nb_vald_std,
  ln(1 + AVG(value)) AS log_vald, stddev_samp(value) / AVG(value) AS cv,
  {m('IS_WEEKEND')} / {m('NOT IS_WEEKEND')} AS ratio_we_sem,
  {m('IS_VACANCES')} / {m('NOT IS_VACANCES')} AS ratio_vac_horsvac,
  {m('month(day) = 8')} / {m('month(day) <> 8')} AS creux_estival
  FROM {source} WHERE {where} GROUP BY entity"""


PROFILE_ALL = ["nb_vald_moyen", "nb_vald_std", *config.PROFILE_COLUMNS]
FULL = " AND ".join(f"{c} IS NOT NULL" for c in PROFILE_ALL)
FLAGGED = f"flagged AS (SELECT panel.*, {FLAGS} FROM panel LEFT JOIN calendar USING (day))"
ORACLE["entity_profiles"] = with_(PANEL, CALENDAR, FLAGGED, f"prof AS ({profiles('flagged')})") + \
    f"SELECT entity, {rs(PROFILE_ALL)} FROM prof WHERE {FULL}"
ORACLE["level_guard"] = with_(
    PANEL, CALENDAR, FLAGGED, f"prof AS ({profiles('flagged', chr(39).join(['day < DATE ', '1996-07-01', '']))})"
) + f"""
SELECT entity, {r('nb_vald_moyen', 'lvl')} FROM prof WHERE {FULL} AND nb_vald_moyen > 0"""
LEVELS = f"levels AS (SELECT entity, AVG(value) AS lvl FROM panel WHERE day < DATE '{i.CUTOFF}' GROUP BY 1)"
ORACLE["levels_before_cutoff"] = with_(PANEL, LEVELS) + f"SELECT entity, {r('lvl', 'lvl')} FROM levels"
FEATURED = [PANEL, WEATHER, CALENDAR, JOINED, MEDIANS, FILLED]
ORACLE["median_fill"] = with_(*FEATURED) + \
    f"SELECT day, {', '.join(r(f'MAX({c})', c) for c in SKY)} FROM filled GROUP BY day"

# ---------------------------------------------------------------- windows


def lag(ks) -> str:
    return ", ".join(f"LAG(value, {k}) OVER ({W}) AS lag_{k}" for k in ks)


def lead(h) -> str:
    return ", ".join(f"LEAD(value, {k}) OVER ({W}) AS target_j{k}" for k in range(1, h + 1))


def roll(ws, full=True) -> str:
    out = []
    for w in ws:
        frame = f"({W} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        out.append(f"CASE WHEN COUNT(value) OVER {frame} = {w} THEN AVG(value) OVER {frame} END AS roll_{w}")
    return ", ".join(out)


def complete(names) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


LAG_EVAL = [f"lag_{k}" for k in i.EVAL_LAGS]
TARGETS = [f"target_j{h}" for h in H]
ORACLE["lags"] = with_(PANEL, f"x AS (SELECT *, {lag(i.EVAL_LAGS)} FROM panel)") + f"SELECT * FROM x WHERE {complete(LAG_EVAL)}"
ORACLE["rolling_means"] = with_(PANEL, f"x AS (SELECT *, {roll((7, 30))} FROM panel)") + \
    f"SELECT entity, day, {rs(['value', 'roll_7', 'roll_30'])} FROM x WHERE roll_7 IS NOT NULL AND roll_30 IS NOT NULL"
ORACLE["targets"] = with_(PANEL, f"x AS (SELECT *, {lead(7)} FROM panel)") + f"SELECT * FROM x WHERE {complete(TARGETS)}"
# Chained like the definition: lags drop rows, rolls see the rest, targets last.
ORACLE["warmup_rule"] = with_(
    PANEL,
    f"x AS (SELECT *, {lag((1, 7))} FROM panel)",
    "y AS (SELECT * FROM x WHERE lag_1 IS NOT NULL AND lag_7 IS NOT NULL)",
    f"z AS (SELECT *, {roll(i.ROLLS)} FROM y)",
    f"z2 AS (SELECT * FROM z WHERE {complete([f'roll_{w}' for w in i.ROLLS])})",
    f"t AS (SELECT *, {lead(7)} FROM z2)",
) + f"SELECT entity, day, value, lag_1, lag_7, {rs([f'roll_{w}' for w in i.ROLLS])}, {', '.join(TARGETS)} FROM t WHERE {complete(TARGETS)}"
ORACLE["calendar_spaced"] = with_(PANEL) + """
SELECT entity, CAST(MAX(day) - MIN(day) + 1 AS BIGINT) AS n_days, COUNT(*) AS n_known, SUM(value) AS total
FROM panel GROUP BY 1"""


def naive(source: str, cols: str = "*", h: int = 7) -> str:
    preds = ", ".join(f"LAG(value, {7 - k}) OVER ({W}) AS pred_j{k}" for k in range(1, h + 1))
    return f"(SELECT {cols}, {lead(h)}, {preds} FROM {source})"


PREDS = [f"pred_j{h}" for h in H]
NAIVE = f"naive AS (SELECT * FROM {naive('panel')} n WHERE {complete(TARGETS + PREDS)})"
ORACLE["weekly_naive_rows"] = with_(PANEL, NAIVE) + "SELECT * FROM naive"
CUT = "CAST(trunc(COUNT(DISTINCT day) * (1.0::DOUBLE - 0.2::DOUBLE)) AS BIGINT)"
ORACLE["day_cutoff"] = with_(
    PANEL, NATIONS,
    "rows AS (SELECT cluster, day FROM panel JOIN nations USING (entity) UNION ALL SELECT -1, day FROM panel)",
    f"cut AS (SELECT cluster, {CUT} AS k FROM rows GROUP BY 1)",
    "ranked AS (SELECT cluster, day, row_number() OVER (PARTITION BY cluster ORDER BY day) - 1 AS idx FROM (SELECT DISTINCT cluster, day FROM rows))",
) + "SELECT CAST(ranked.cluster AS INTEGER) AS cluster, day AS cutoff FROM ranked JOIN cut ON cut.cluster = ranked.cluster AND idx = k"
FL, FS = config.FOLD_LENGTH, config.FOLD_STRIDE
FOLDS = f"""
days AS (SELECT day, total, row_number() OVER (ORDER BY day) - 1 AS idx, COUNT(*) OVER () AS n FROM totals),
starts AS (SELECT CAST(s // {FS} AS INTEGER) AS fold, s FROM generate_series(0, 100000, {FS}) t(s)
           WHERE s + {FL} <= (SELECT COUNT(*) FROM totals)),
folds AS (SELECT fold, day, total, idx - s AS pos FROM starts JOIN days ON idx >= s AND idx < s + {FL})"""
ORACLE["sliding_folds"] = with_(TOTALS, FOLDS) + """
SELECT fold, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n, SUM(total) AS total FROM folds GROUP BY 1"""
_last = f"CAST(round_even({config.TRAIN_RATIO}::DOUBLE * {FL}, 0) AS INTEGER)"
ORACLE["train_test_context"] = with_(TOTALS, FOLDS) + f"""
SELECT fold AS _fold, role AS _role, MIN(day) AS _first_day, MAX(day) AS _last_day, SUM(total) AS _total FROM (
  SELECT fold, day, total, 'train' AS role FROM folds WHERE pos < {_last}
  UNION ALL SELECT fold, day, total, 'test' FROM folds WHERE pos >= {_last} - {config.PAST_LENGTH}) GROUP BY 1, 2"""
ORACLE["walk_forward"] = with_(
    PANEL,
    f"pre AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS idx, COUNT(*) OVER () AS n FROM (SELECT DISTINCT day FROM panel WHERE day < DATE '{i.CUTOFF}'))",
    "sizes AS (SELECT DISTINCT n, CAST(trunc(n * 0.5::DOUBLE) AS BIGINT) AS s FROM pre)",
    """edges AS (SELECT k, CASE WHEN k = 3 THEN n ELSE CAST(trunc(k * ((n - s)::DOUBLE / 3) + s) AS BIGINT) END AS e
       FROM sizes, generate_series(0, 3) t(k))""",
    """blocks AS (SELECT CAST(a.k + 1 AS INTEGER) AS fold, p.day AS v0, q.day AS v1 FROM edges a JOIN edges b ON b.k = a.k + 1
       JOIN pre p ON p.idx = a.e JOIN pre q ON q.idx = b.e - 1)""",
) + """
SELECT fold, CASE WHEN day < v0 THEN 'train' ELSE 'validation' END AS role, MIN(day) AS first_day, MAX(day) AS last_day,
  COUNT(*) AS n_rows, SUM(value) AS total FROM panel JOIN blocks ON day <= v1 GROUP BY 1, 2"""
ORACLE["ts_cv"] = with_(
    PANEL, NATIONS,
    "x AS (SELECT cluster, day, value, row_number() OVER (PARTITION BY cluster ORDER BY day, substr(md5(CAST(entity AS VARCHAR)), 1, 2), entity) - 1 AS idx, COUNT(*) OVER (PARTITION BY cluster) AS n FROM panel JOIN nations USING (entity))",
    "b AS (SELECT *, CASE WHEN idx < n - 3 * (n // 4) THEN 0 ELSE (idx - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block FROM x)",
) + """
SELECT cluster, CAST(block AS INTEGER) AS block, COUNT(*) AS n, MIN(day) AS first_day, MAX(day) AS last_day,
  SUM(value) AS total FROM b GROUP BY 1, 2"""
ORACLE["stratified_sample"] = with_(NATIONS) + """
SELECT entity, cluster FROM nations
QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY md5(CAST(entity AS VARCHAR) || '-42'), entity) <= 2"""
ORACLE["cluster_sizes"] = with_(NATIONS) + """
SELECT cluster, COUNT(*) AS size, MIN(entity) AS min_id, MAX(entity) AS max_id FROM nations GROUP BY 1"""

# ---------------------------------------------------------------- features

ORACLE["time_features"] = with_(TOTALS, f"x AS (SELECT day, total, {TIME} FROM totals)") + f"SELECT day, total, {TIME_OUT} FROM x"
ORACLE["weather_features"] = with_(*FEATURED, f"x AS (SELECT DISTINCT day, {', '.join(SKY)}, {SKY_PARTS} FROM filled)") + \
    f"SELECT day, {rs([*SKY, 'amplitude', 'log_RR'])}, {', '.join(SKY_FLAGS)} FROM x"
ORACLE["cluster_onehot"] = with_(PANEL, NATIONS) + "SELECT entity, SUM(value) AS total, " + ", ".join(
    f"CAST(COALESCE(MAX(cluster) = {k}, FALSE) AS INTEGER) AS cluster_{k}" for k in range(25) if k != 3
) + " FROM panel LEFT JOIN nations USING (entity) GROUP BY 1"
ORACLE["level_normalise"] = with_(PANEL, LEVELS) + f"""
SELECT entity, day, {r('value', 'value')}, {r('lvl', 'lvl')}, {r('value / lvl', 'ratio')}, {r('value', 'back')}
FROM panel JOIN levels USING (entity)"""
ORACLE["log_target"] = with_(PANEL) + f"SELECT entity, day, {r('value', 'value')}, {r('ln(1 + value)', 'logged')}, {r('value', 'back')} FROM panel"


def iqr(c: str) -> str:
    return f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"


ORACLE["robust_scale"] = with_(
    PANEL, f"x AS (SELECT *, {lag(i.EVAL_LAGS)} FROM panel)", f"y AS (SELECT * FROM x WHERE {complete(LAG_EVAL)})",
    "s AS (SELECT " + ", ".join(f"median({c}) AS m_{c}, {iqr(c)} AS q_{c}" for c in LAG_EVAL) + " FROM y)",
) + "SELECT entity, day, " + r("value", "value") + ", " + ", ".join(
    r(f"({c} - m_{c}) / CASE WHEN q_{c} = 0 THEN 1 ELSE q_{c} END", c) for c in LAG_EVAL
) + " FROM y, s"
ORACLE["robust_stats"] = with_(PANEL, WEATHER, CALENDAR, JOINED) + "SELECT " + ", ".join(
    r(f"median({c})", f"{c}_centre") + ", " + r(iqr(c), f"{c}_scale") for c in [*SKY, "value"]
) + " FROM joined"
ORACLE["standard_scale"] = with_(
    PANEL, "t AS (SELECT entity, AVG(value) AS mean, COUNT(*)::DOUBLE AS n FROM panel GROUP BY 1)",
) + f"""SELECT entity, {r('(mean - (SELECT AVG(mean) FROM t)) / (SELECT stddev_pop(mean) FROM t)', 'mean')},
  {r('(n - (SELECT AVG(n) FROM t)) / (SELECT stddev_pop(n) FROM t)', 'n')} FROM t"""

EVENTS = """ev AS (SELECT event_type AS entity, CAST(ts AS DATE) AS day, COUNT(*)::DOUBLE AS value FROM events GROUP BY 1, 2)"""
TYPES = ["click", "error", "purchase", "signup", "view"]
# Days of January 2024: New Year's Day is the only holiday, no bridges, no school breaks.
JAN = "CAST(isodow(day) >= 6 AS INTEGER) AS IS_WEEKEND, CAST(day = DATE '2024-01-01' AS INTEGER) AS IS_FERIE, 0 AS IS_VACANCES, 0 AS IS_PONT"
_wide = ", ".join(f"ln(1 + COALESCE(SUM(value) FILTER (entity = '{t}'), 0)) AS {t}" for t in TYPES)
WIDE = f"""wide AS (SELECT day, {_wide}, CASE WHEN day(day) % 5 <> 0 THEN MAX(value) ELSE 0 END AS sky, {JAN},
  sin(2 * pi() * month(day) / 12) AS month_sin, cos(2 * pi() * month(day) / 12) AS month_cos FROM ev GROUP BY day)"""
ORACLE["pivot_log"] = with_(EVENTS, WIDE) + f"""
SELECT day, {rs(TYPES)}, {', '.join(r('sky', c) for c in SKY)}, {FLAGS}, {rs(['month_sin', 'month_cos'])} FROM wide"""
ORACLE["build_features"] = with_(*FEATURED, NATIONS, f"x AS (SELECT *, {TIME}, {SKY_PARTS} FROM filled LEFT JOIN nations USING (entity))") + f"""
SELECT entity, day, {rs(['value', *SKY, 'amplitude', 'log_RR'])}, {FLAGS}, {TIME_OUT}, {', '.join(SKY_FLAGS)}, cluster FROM x"""
ORACLE["prepared_matrix"] = with_(
    PANEL, KEPT, CALENDAR, NATIONS,
    f"x AS (SELECT kept.*, {FLAGS}, cluster, {lag((1, 7))} FROM kept LEFT JOIN calendar USING (day) LEFT JOIN nations USING (entity))",
    "y AS (SELECT * FROM x WHERE lag_7 IS NOT NULL)",
    f"z AS (SELECT *, {roll((7,))} FROM y)",
    "z2 AS (SELECT * FROM z WHERE roll_7 IS NOT NULL)",
    f"t AS (SELECT *, {lead(3)} FROM z2)",
) + f"""SELECT entity, day, {FLAGS}, {rs(['lag_1', 'lag_7', 'roll_7', 'target_j1', 'target_j2', 'target_j3'])},
  {', '.join(f'CAST(cluster = {k} AS INTEGER) AS cluster_{k}' for k in range(25))} FROM t WHERE target_j3 IS NOT NULL"""

LAGC, ROLLC = [f"lag_{k}" for k in i.LAGS], [f"roll_{w}" for w in i.ROLLS]
MATRIX = [
    *FEATURED, KEPT,
    f"kflag AS (SELECT kept.*, {FLAGS} FROM kept LEFT JOIN calendar USING (day))",
    "prof AS (" + profiles("kflag", f"day < DATE '{i.CUTOFF}'") + ")",
    f"x AS (SELECT *, COUNT(*) OVER (PARTITION BY entity) AS n, {lag(i.LAGS)} FROM kept)",
    "y AS (SELECT * FROM x WHERE lag_7 IS NOT NULL AND n > 38)",
    f"z AS (SELECT *, {roll(i.ROLLS)} FROM y)",
    "z2 AS (SELECT * FROM z WHERE roll_30 IS NOT NULL)",
    f"t AS (SELECT *, {lead(7)} FROM z2)",
    f"m AS (SELECT t.* EXCLUDE (n), prof.* EXCLUDE (entity), {', '.join('f.' + c for c in SKY)}, {FLAGS} FROM t JOIN prof USING (entity) "
    f"JOIN filled f USING (entity, day) WHERE {FULL} AND nb_vald_moyen > 0)",
    f"full_m AS (SELECT *, {TIME}, {SKY_PARTS} FROM m)",
]
MATRIX_COLUMNS = (
    f"entity, day, {rs(SKY)}, " + ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in FLAGS.split(", ")) + f", {TIME_OUT}, "
    + rs(["amplitude", "log_RR"]) + ", " + ", ".join(SKY_FLAGS) + ", "
    + ", ".join(f"{c} / nb_vald_moyen AS {c}" for c in LAGC + ROLLC) + ", " + rs(["log_vald", "cv"])
    + ", ratio_we_sem, ratio_vac_horsvac, creux_estival, nb_vald_moyen AS lvl"
)
ORACLE["pooled_matrix"] = with_(*MATRIX) + f"SELECT {MATRIX_COLUMNS}, {', '.join(TARGETS)} FROM full_m WHERE {complete(TARGETS)}"
ORACLE["serving_features"] = with_(*MATRIX) + f"SELECT {MATRIX_COLUMNS} FROM full_m WHERE day >= DATE '{i.CUTOFF}'"
ORACLE["served_points"] = with_(
    PANEL, f"x AS (SELECT *, {lag((1, 7))} FROM panel)",
    f"s AS (SELECT * FROM x WHERE lag_7 IS NOT NULL AND day >= DATE '{i.CUTOFF}')",
) + "SELECT p.entity, p.day, s.lag_1, s.lag_7 FROM panel p LEFT JOIN s ON s.entity = p.entity AND s.day = p.day"
ORACLE["feature_store"] = with_(PANEL, f"x AS (SELECT *, {lag((1, 7))} FROM panel)") + "SELECT * FROM x WHERE lag_7 IS NOT NULL"
ORACLE["feature_lookup"] = with_(PANEL) + f"SELECT * FROM panel WHERE entity IN {i.LOOKED_UP}"

# ---------------------------------------------------------------- evaluation


def test_rows(source: str, group: str) -> str:
    """Rows from the group's own cutoff day on."""
    return f"""
cutk AS (SELECT {group} AS g, {CUT} AS k FROM {source} GROUP BY 1),
cutd AS (SELECT g, day AS cutoff FROM (SELECT g, day, row_number() OVER (PARTITION BY g ORDER BY day) - 1 AS idx
         FROM (SELECT DISTINCT {group} AS g, day FROM {source})) JOIN cutk USING (g) WHERE idx = k),
test AS (SELECT s.* FROM {source} s JOIN cutd ON cutd.g = s.{group} WHERE s.day >= cutoff)"""


def long_metrics(source: str, group: str, hs=H) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {group}, {h} AS h, target_j{h}::DOUBLE AS t, pred_j{h}::DOUBLE AS p FROM {source}" for h in hs
    )
    return f"""
unp AS ({parts}),
long AS (SELECT {group}, CAST(h AS INTEGER) AS h, COUNT(*) AS n, AVG(abs(t - p)) AS mae, AVG(t) AS true_mean,
  AVG(abs(t - p)) / NULLIF(AVG(t), 0) * 100 AS mae_pct,
  CASE WHEN COUNT(*) < 2 THEN NULL WHEN var_pop(t) = 0 THEN CASE WHEN SUM((t - p) * (t - p)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - SUM((t - p) * (t - p)) / (var_pop(t) * COUNT(*)) END AS r2
  FROM unp GROUP BY 1, 2)"""


def per_entity(group: str, name: str = "per") -> str:
    hs = ", ".join(f"MAX(mae_pct) FILTER (h = {h}) AS mae_pct_j{h}" for h in H)
    return f"""{name} AS (SELECT {group}, MAX(n) AS n_test, AVG(mae) AS mae, AVG(mae) / NULLIF(AVG(true_mean), 0) * 100 AS mae_pct,
      AVG(r2) AS r2, {hs} FROM long GROUP BY 1)"""


GUARDED = "guarded AS (SELECT * FROM panel QUALIFY COUNT(*) OVER (PARTITION BY entity) > 38)"
NAIVE_G = f"naive AS (SELECT * FROM {naive('guarded')} n WHERE {complete(TARGETS + PREDS)})"
NAIVE_EVAL = [PANEL, GUARDED, NAIVE_G, test_rows("naive", "entity"), long_metrics("test", "entity")]
ORACLE["naive_weekly"] = with_(*NAIVE_EVAL) + f"SELECT entity, h, n, {rs(['mae', 'true_mean', 'mae_pct', 'r2'])} FROM long"
ORACLE["naive_weekly_by_group"] = with_(
    PANEL, NATIONS, "np AS (SELECT panel.*, cluster FROM panel JOIN nations USING (entity))",
    "gp AS (SELECT * FROM np QUALIFY COUNT(*) OVER (PARTITION BY cluster) > 38)",
    f"naive AS (SELECT * FROM {naive('gp')} n WHERE {complete(TARGETS + PREDS)})",
    test_rows("naive", "cluster"), long_metrics("test", "cluster"),
) + f"SELECT cluster, n, h, {rs(['mae', 'true_mean', 'mae_pct', 'r2'])} FROM long"
FLAT = "flat AS (SELECT entity, MAX(n) AS n_test, " + ", ".join(
    f"{even(f'MAX(mae) FILTER (h = {h})', 0)} AS mae_j{h}, {even(f'MAX(mae_pct) FILTER (h = {h})', 1)} AS pct_j{h}" for h in H
) + " FROM long GROUP BY 1)"
ORACLE["baseline_frame"] = with_(*NAIVE_EVAL, FLAT) + f"SELECT 'station' AS grain, 'j7' AS horizon, '{i.TRAIN_FROM}' AS train_from, * FROM flat"
ORACLE["baseline_mean_mae"] = with_(*NAIVE_EVAL, FLAT) + f"SELECT {r('AVG(mae_j1)', 'mean_mae_j1')} FROM flat"
BASE = "base AS (SELECT entity, AVG(mae) / NULLIF(AVG(true_mean), 0) * 100 AS mae_pct, CAST(NULL AS DOUBLE) AS r2, " + ", ".join(
    f"{even(f'MAX(mae_pct) FILTER (h = {h})', 1)} AS mae_pct_j{h}" for h in H
) + " FROM long GROUP BY 1)"
PCTS = [f"mae_pct_j{h}" for h in H]
ORACLE["baseline_as_model"] = with_(*NAIVE_EVAL, BASE) + f"SELECT entity, {rs(['mae_pct', 'r2', *PCTS])} FROM base"
ORACLE["horizon_metrics"] = with_(
    PANEL, NAIVE, f"test AS (SELECT * FROM naive WHERE day >= DATE '{i.CUTOFF}')", long_metrics("test", "entity"), per_entity("entity")
) + f"SELECT entity, n_test, {rs(['mae', 'mae_pct', 'r2', *PCTS])} FROM per"
ORACLE["metric_medians"] = with_(*NAIVE_EVAL, per_entity("entity")) + f"""
SELECT COUNT(*) AS n_stations, COUNT(*) FILTER (r2 < 0) AS n_r2_neg, {even('median(mae_pct)', 2)} AS mae_pct_median,
  {even('median(r2)', 4)} AS r2_median, {', '.join(f'{even(f"median({c})", 2)} AS {c}' for c in PCTS)} FROM per"""
ORACLE["consensus_params"] = with_(
    PANEL, "c AS (SELECT entity, COUNT(*) AS n, SUM(value) AS s FROM panel GROUP BY 1)",
    """l AS (SELECT 'max_depth' AS name, (n % 4 + 3)::DOUBLE AS v FROM c UNION ALL
             SELECT 'subsample', (n % 5)::DOUBLE / 10.0::DOUBLE + 0.6::DOUBLE FROM c UNION ALL
             SELECT 'gamma', (s % 7) / 100.0::DOUBLE FROM c)""",
) + "SELECT name, CASE WHEN name = 'max_depth' THEN round_even(median(v), 0) ELSE round_even(median(v), 4) END AS value FROM l GROUP BY 1"
ORACLE["mean_and_persistence"] = with_(
    PANEL, LEVELS,
    f"x AS (SELECT panel.*, LEAD(value) OVER ({W}) AS t, LAG(value, 7) OVER ({W}) AS persistence FROM panel)",
    f"y AS (SELECT x.entity, t AS target_j1, t AS target_j2, lvl AS pred_j1, persistence AS pred_j2 FROM x JOIN levels USING (entity) "
    f"WHERE day >= DATE '{i.CUTOFF}' AND t IS NOT NULL AND persistence IS NOT NULL)",
    long_metrics("y", "entity", (1, 2)),
) + f"SELECT entity, CASE WHEN h = 1 THEN 'mean' ELSE 'persistence' END AS method, n, {rs(['mae', 'mae_pct', 'r2'])} FROM long"
ORACLE["results_summary"] = with_(*NAIVE_EVAL, per_entity("entity")) + f"""
SELECT COUNT(*) AS n_groups, {r('AVG(mae)', 'mean_mae')}, {r('AVG(r2)', 'mean_r2')}, {r('median(mae)', 'median_mae')},
  {r('median(r2)', 'median_r2')} FROM per"""
ORACLE["leaderboard"] = with_(*NAIVE_EVAL, per_entity("entity")) + f"""
SELECT entity, {rs(['mae', 'mae_pct', 'r2'])}, side FROM (
  (SELECT *, 'best' AS side FROM per WHERE mae_pct IS NOT NULL ORDER BY mae_pct, entity LIMIT 5) UNION ALL
  (SELECT *, 'worst' AS side FROM per WHERE mae_pct IS NOT NULL ORDER BY mae_pct DESC, entity LIMIT 5))"""
ORACLE["ranked_report"] = with_(*NAIVE_EVAL, per_entity("entity")) + f"""
SELECT entity, s_name AS label, n_test, {rs(['mae', 'mae_pct', 'r2'])} FROM per LEFT JOIN supplier ON s_suppkey = entity"""
_meas = " UNION ALL ".join(
    f"SELECT '{m}' AS measure, (SELECT {even(f'median({c})', 2)} FROM mper) AS model, (SELECT {even(f'median({c})', 2)} FROM base) AS baseline"
    for m, c in [("mae_pct_median", "mae_pct"), *[(c, c) for c in PCTS]]
)
ORACLE["compare_baseline"] = with_(
    *NAIVE_EVAL, BASE, LEVELS, f"nn AS (SELECT * FROM {naive('panel')} n WHERE {complete(TARGETS + PREDS)})",
    f"mtest AS (SELECT nn.* REPLACE ({', '.join(f'lvl AS pred_j{h}' for h in H)}) FROM nn JOIN levels USING (entity) WHERE day >= DATE '{i.CUTOFF}')",
    long_metrics("mtest", "entity").replace("unp", "munp").replace("long AS", "mlong AS"),
    per_entity("entity", "mper").replace("FROM long", "FROM mlong"),
    f"c AS ({_meas})",
) + f"SELECT *, {even('baseline - model', 2)} AS gain FROM c"

# ---------------------------------------------------------------- sequences

NS, PAST, FUT, SEED, SHORT = 500, config.PAST_LENGTH, 7, 11, 14
START = "CAST(('0x' || substr(md5(CAST(sample AS VARCHAR) || '-{seed}'), 1, 8))::BIGINT % {choices} AS INTEGER)"


def series(log: bool) -> str:
    value = "ln(1 + COALESCE(value, 0))" if log else "COALESCE(value, 0)"
    return f"""
didx AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS idx, COUNT(*) OVER () AS n FROM (SELECT DISTINCT day FROM panel)),
ents AS (SELECT DISTINCT entity FROM panel),
dense AS (SELECT e.entity, d.idx, {value} AS v FROM ents e CROSS JOIN didx d
          LEFT JOIN panel p ON p.entity = e.entity AND p.day = d.day),
samp AS (SELECT CAST(sample AS INTEGER) AS sample, {START.format(seed=SEED, choices=f'(SELECT MAX(n) - {PAST + FUT} + 1 FROM didx)')} AS start
         FROM generate_series(0, {NS - 1}) t(sample)),
win AS (SELECT entity, sample, start, idx - start AS pos, v FROM samp JOIN dense ON idx >= start AND idx < start + {PAST + FUT}),
pairs_h AS (SELECT y.entity, sample, CAST(h AS INTEGER) AS h, y.v AS y, p.v AS p
            FROM (SELECT sample, h, start + {PAST} + h - 1 AS idx FROM samp, generate_series(1, {FUT}) t(h)) w
            JOIN dense y ON y.idx = w.idx JOIN dense p ON p.entity = y.entity AND p.idx = y.idx - 7)"""


ORACLE["sequence_windows"] = with_(PANEL, series(True)) + f"""
SELECT entity, sample, start, {r(f'SUM(v) FILTER (pos < {PAST})', 'past_sum')}, {r(f'SUM(v) FILTER (pos >= {PAST})', 'y_sum')},
  {r(f'SUM(v) FILTER (pos >= {PAST - 7} AND pos < {PAST})', 'pred_sum')} FROM win GROUP BY 1, 2, 3"""
ORACLE["sequence_baseline"] = with_(
    PANEL, series(False),
    "e AS (SELECT entity, h, AVG(abs(y - p)) / NULLIF(AVG(abs(y)), 0) AS ratio FROM pairs_h GROUP BY 1, 2)",
) + f"SELECT h, {even('AVG(ratio)', 2)} AS score FROM e GROUP BY 1"
LOGERR = "e AS (SELECT entity, h, AVG(exp(abs(y - p)) - 1) AS mae, AVG(exp(abs(y)) - 1) AS volume FROM pairs_h GROUP BY 1, 2)"
ORACLE["sequence_score"] = with_(PANEL, series(True), LOGERR) + \
    f"SELECT h, {even('AVG(mae / NULLIF(volume, 0)) * 100', 3)} AS score FROM e GROUP BY 1"
ORACLE["entity_error_table"] = with_(PANEL, series(True), LOGERR, "v AS (SELECT entity, AVG(value) AS mean_value FROM panel GROUP BY 1)") + f"""
SELECT entity, {r('mean_value', 'mean_value')}, {r('mae', 'mae_j1')}, {r('mae / mean_value * 100', 'error_pct')}
FROM v JOIN e USING (entity) WHERE h = 1"""
_numbers = " UNION ALL ".join(
    f"SELECT sample, start, '{part}' AS part, CAST(idx - start - {first} AS INTEGER) AS pos, CAST({k} AS INTEGER) AS k, CAST({c} AS DOUBLE) AS x "
    f"FROM tensors WHERE idx >= start + {first} AND idx < start + {last}"
    for part, first, last, names in (
        ("x_past", 0, SHORT, [*TYPES, "month_sin", "month_cos"]),
        ("x_fut", 0, SHORT + FUT, ["IS_WEEKEND", "IS_FERIE", "IS_VACANCES", "IS_PONT"]),
        ("y", SHORT, SHORT + FUT, TYPES),
    )
    for k, c in enumerate(names)
)
ORACLE["sequence_samples"] = with_(
    EVENTS, WIDE, "w AS (SELECT *, row_number() OVER (ORDER BY day) - 1 AS idx, COUNT(*) OVER () AS n FROM wide)",
    f"samp AS (SELECT CAST(sample AS INTEGER) AS sample, {START.format(seed=SEED, choices=f'(SELECT MAX(n) - {SHORT + FUT} + 1 FROM w)')} AS start FROM generate_series(0, {NS - 1}) t(sample))",
    f"tensors AS (SELECT * FROM samp JOIN w ON idx >= start AND idx < start + {SHORT + FUT})",
    f"numbers AS ({_numbers})",
) + f"SELECT sample, start, part, pos, k, {r('x', 'x')} FROM numbers"

# ---------------------------------------------------------------- models

LAGGED = [
    PANEL, f"x AS (SELECT *, {lag((1, 7))} FROM panel)", "y AS (SELECT * FROM x WHERE lag_7 IS NOT NULL)",
    f"z AS (SELECT *, {roll((7,))} FROM y)", "z2 AS (SELECT * FROM z WHERE roll_7 IS NOT NULL)",
    f"t AS (SELECT *, {lead(2)} FROM z2)", "lagged AS (SELECT * FROM t WHERE target_j2 IS NOT NULL)",
]
ORACLE["per_entity_linear"] = with_(*LAGGED) + f"""
SELECT entity, COUNT(*) AS n, {r('regr_intercept(target_j1, lag_7)', 'intercept', 4)}, {r('regr_slope(target_j1, lag_7)', 'slope', 4)}
FROM lagged GROUP BY 1"""
ORACLE["linear_regression"] = with_(
    *LAGGED,
    "k AS (SELECT lag_7 AS x, target_j1 AS y, md5(CAST(entity AS VARCHAR) || '|' || CAST(day AS VARCHAR)) AS d FROM lagged)",
    """f AS (SELECT x, y, CASE WHEN ('0x' || substr(d, 1, 8))::BIGINT % 10000 < 2000 THEN -1
           ELSE ('0x' || substr(d, 9, 8))::BIGINT % 5 END AS fold FROM k)""",
    "models AS (SELECT m AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM f, generate_series(-1, 4) t(m) WHERE fold >= 0 AND fold <> m GROUP BY m)",
    "s AS (SELECT fold, COUNT(*) AS n, AVG(abs(y - a - b * x)) AS mae, AVG(y) AS mean, SUM((y - a - b * x) ** 2) AS sse, var_pop(y) AS v FROM f JOIN models USING (fold) GROUP BY 1)",
) + f"""SELECT {r('AVG(mae) FILTER (fold >= 0)', 'mae_cv', 4)}, {r('stddev_pop(mae) FILTER (fold >= 0)', 'mae_cv_std', 4)},
  MAX(n) FILTER (fold = -1) AS n_test, {r('MAX(mae) FILTER (fold = -1)', 'mae', 4)},
  {r('MAX(1 - sse / (v * n)) FILTER (fold = -1)', 'r2', 4)}, {r('MAX(mae / mean * 100) FILTER (fold = -1)', 'mae_pct', 4)} FROM s"""



def ridge_models(source: str, group: str, alpha: float) -> str:
    """One standardised feature: the penalty shrinks the slope by n / (n + alpha)."""
    cols = []
    for h in (1, 2):
        slope = f"regr_slope(target_j{h}, lag_7) * COUNT(*) / (COUNT(*) + {alpha}::DOUBLE)"
        cols.append(f"{slope} AS b{h}, AVG(target_j{h}) - {slope} * AVG(lag_7) AS a{h}")
    return f"models AS (SELECT {group}, {', '.join(cols)} FROM {source} GROUP BY 1)"


def two_metrics(source: str, group: str) -> str:
    return long_metrics(source, group, (1, 2)) + f""",
per AS (SELECT {group}, MAX(n) AS n_test, AVG(mae) AS mae, AVG(mae) / NULLIF(AVG(true_mean), 0) * 100 AS mae_pct, AVG(r2) AS r2,
  MAX(mae_pct) FILTER (h = 1) AS mae_pct_j1, MAX(mae_pct) FILTER (h = 2) AS mae_pct_j2 FROM long GROUP BY 1)"""


def cutoffs(source: str, group: str) -> str:
    return f"""
cutk AS (SELECT {group} AS g, {CUT} AS k FROM {source} GROUP BY 1),
cutd AS (SELECT g, day AS cutoff FROM (SELECT g, day, row_number() OVER (PARTITION BY g ORDER BY day) - 1 AS idx
         FROM (SELECT DISTINCT {group} AS g, day FROM {source})) JOIN cutk USING (g) WHERE idx = k),
split AS (SELECT s.*, cutoff FROM {source} s JOIN cutd ON cutd.g = s.{group})"""


PREDICT = "a1 + b1 * lag_7 AS pred_j1, a2 + b2 * lag_7 AS pred_j2"
TWO = ["mae", "mae_pct", "r2", "mae_pct_j1", "mae_pct_j2"]
ORACLE["ridge_holdout"] = with_(
    *LAGGED, "enough AS (SELECT * FROM lagged QUALIFY COUNT(*) OVER (PARTITION BY entity) >= 50)",
    cutoffs("enough", "entity"), "train AS (SELECT * FROM split WHERE day < cutoff)", ridge_models("train", "entity", 10),
    f"scored AS (SELECT split.*, {PREDICT} FROM split JOIN models USING (entity) WHERE day >= cutoff)",
    two_metrics("scored", "entity"),
) + f"SELECT entity, n_test, {rs(TWO, 4)} FROM per"
ORACLE["ridge_by_group"] = with_(
    *LAGGED, NATIONS, "lc AS (SELECT lagged.*, cluster FROM lagged JOIN nations USING (entity))",
    "enough AS (SELECT * FROM lc QUALIFY COUNT(*) OVER (PARTITION BY cluster) >= 50)",
    cutoffs("enough", "cluster"), "train AS (SELECT * FROM split WHERE day < cutoff)", ridge_models("train", "cluster", 10),
    f"scored AS (SELECT lc.*, {PREDICT} FROM lc JOIN models USING (cluster))", two_metrics("scored", "cluster"),
    "last AS (SELECT cluster, day AS last_day, pred_j2 AS last_prediction FROM scored "
    "QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY day DESC, entity DESC) = 1)",
) + f"SELECT cluster, n_test, {rs(TWO, 4)}, last_day, {r('last_prediction', 'last_prediction', 4)} FROM per JOIN last USING (cluster)"
SEARCH = [
    *LAGGED, cutoffs("lagged", "entity"),
    "tr AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY day) - 1 AS idx, COUNT(*) OVER (PARTITION BY entity) AS n FROM split WHERE day < cutoff)",
    "bl AS (SELECT *, CASE WHEN idx < n - 3 * (n // 4) THEN 0 ELSE (idx - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block FROM tr)",
    "alphas(alpha) AS (VALUES (1.0::DOUBLE), (100.0::DOUBLE), (10000.0::DOUBLE))",
    """fits AS (SELECT entity, k, alpha, COUNT(*) / (COUNT(*) + alpha) AS shrink, AVG(lag_7) AS mx,
         regr_slope(target_j1, lag_7) AS s1, regr_slope(target_j2, lag_7) AS s2, AVG(target_j1) AS m1, AVG(target_j2) AS m2
       FROM bl, generate_series(1, 3) t(k), alphas WHERE block < k GROUP BY 1, 2, 3)""",
    """folds AS (SELECT bl.entity, k, alpha, AVG((abs(target_j1 - m1 - s1 * shrink * (lag_7 - mx)) + abs(target_j2 - m2 - s2 * shrink * (lag_7 - mx))) / 2) AS s
        FROM bl JOIN fits ON fits.entity = bl.entity AND fits.k = bl.block GROUP BY 1, 2, 3)""",
    "mean AS (SELECT entity, alpha, AVG(s) AS score FROM folds GROUP BY 1, 2)",
    "chosen AS (SELECT * FROM mean QUALIFY row_number() OVER (PARTITION BY entity ORDER BY score, alpha) = 1)",
]
ORACLE["ridge_search_one_feature"] = with_(*SEARCH) + \
    f"SELECT entity, 'alpha' AS name, alpha AS value, {r('score', 'score', 4)} FROM chosen"
ORACLE["consensus_search"] = with_(*SEARCH) + f"SELECT 'alpha' AS name, {even('median(alpha)', 4)} AS value FROM chosen"

# Ridge corner of the net with two standardised features, by normal equations.
NET_ROWS = [
    *LAGGED, cutoffs("lagged", "entity"),
    "tr AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY day) - 1 AS idx, COUNT(*) OVER (PARTITION BY entity) AS n FROM split WHERE day < cutoff)",
    "bl AS (SELECT *, CASE WHEN idx < n - 3 * (n // 4) THEN 0 ELSE (idx - (n - 3 * (n // 4))) // (n // 4) + 1 END AS block FROM tr)",
    "pens(penalty) AS (VALUES (0.01::DOUBLE), (0.3::DOUBLE), (3.0::DOUBLE))",
]


def net_fit(name: str, source: str, keys: str) -> str:
    """Slopes and intercepts per key and penalty, for two horizons."""
    c, d = "corr(lag_1, lag_7)", "((1 + penalty) ** 2 - corr(lag_1, lag_7) ** 2)"
    cols = []
    for h in (1, 2):
        b1, b7 = f"corr(lag_1, target_j{h})", f"corr(lag_7, target_j{h})"
        cols.append(f"((1 + penalty) * {b1} - {c} * {b7}) / {d} * stddev_pop(target_j{h}) / stddev_pop(lag_1) AS u{h}")
        cols.append(f"((1 + penalty) * {b7} - {c} * {b1}) / {d} * stddev_pop(target_j{h}) / stddev_pop(lag_7) AS v{h}")
        cols.append(f"AVG(target_j{h}) AS m{h}")
    return f"{name} AS (SELECT {keys}, penalty, AVG(lag_1) AS x1, AVG(lag_7) AS x7, {', '.join(cols)} FROM {source} GROUP BY {keys}, penalty)"


def net_of(h: int) -> str:
    return f"m{h} + u{h} * (lag_1 - x1) + v{h} * (lag_7 - x7)"


ORACLE["net_search"] = with_(
    *NET_ROWS, net_fit("fits", "bl JOIN generate_series(1, 3) t(k) ON block < k, pens", "entity, k"),
    f"""folds AS (SELECT bl.entity, k, penalty, AVG((abs(target_j1 - ({net_of(1)})) + abs(target_j2 - ({net_of(2)}))) / 2) AS s
        FROM bl JOIN fits ON fits.entity = bl.entity AND fits.k = bl.block GROUP BY 1, 2, 3)""",
    "mean AS (SELECT entity, penalty, AVG(s) AS score FROM folds GROUP BY 1, 2)",
    "chosen AS (SELECT * FROM mean QUALIFY row_number() OVER (PARTITION BY entity ORDER BY round(score, 9), penalty DESC) = 1)",
    net_fit("refit", "bl, pens", "entity"),
    "best AS (SELECT refit.*, score FROM refit JOIN chosen USING (entity, penalty))",
    f"scored AS (SELECT split.*, {net_of(1)} AS pred_j1, {net_of(2)} AS pred_j2 FROM split JOIN best USING (entity) WHERE day >= cutoff)",
    long_metrics("scored", "entity", (1, 2)),
    """every AS (SELECT entity, h, n, mae, mae_pct, r2 FROM long UNION ALL
        SELECT entity, 0, MAX(n), AVG(mae), AVG(mae) / NULLIF(AVG(true_mean), 0) * 100, AVG(r2) FROM long GROUP BY 1)""",
) + f"""SELECT entity, CAST(h AS INTEGER) AS h, n, {rs(['mae', 'mae_pct', 'r2', 'penalty', 'score'], 4)}, {r('u1', 'slope_1', 4)}, {r('v1', 'slope_7', 4)}
FROM every JOIN best USING (entity)"""

# With one standardised feature the net's slope is the correlation, cut by penalty * ratio and shrunk.
_w = "sign(c{h}) * greatest(abs(c{h}) - penalty * ratio, 0) / (1 + penalty * (1 - ratio)) * sy{h} / sx"
ORACLE["net_consensus"] = with_(
    *NET_ROWS, "ratios(ratio) AS (VALUES (0.0::DOUBLE), (0.5::DOUBLE))",
    """stats AS (SELECT entity, k, AVG(lag_7) AS mx, stddev_pop(lag_7) AS sx, """ + ", ".join(
        f"corr(lag_7, target_j{h}) AS c{h}, stddev_pop(target_j{h}) AS sy{h}, AVG(target_j{h}) AS m{h}" for h in (1, 2)
    ) + " FROM bl, generate_series(1, 3) t(k) WHERE block < k GROUP BY 1, 2)",
    "fits AS (SELECT *, " + ", ".join(f"{_w.format(h=h)} AS w{h}" for h in (1, 2)) + " FROM stats, pens, ratios)",
    """folds AS (SELECT bl.entity, k, penalty, ratio, AVG((abs(target_j1 - m1 - w1 * (lag_7 - mx)) + abs(target_j2 - m2 - w2 * (lag_7 - mx))) / 2) AS s
        FROM bl JOIN fits ON fits.entity = bl.entity AND fits.k = bl.block GROUP BY 1, 2, 3, 4)""",
    "mean AS (SELECT entity, penalty, ratio, AVG(s) AS score FROM folds GROUP BY 1, 2, 3)",
    # Scores that are equal to nine places count as equal; the first in the grid wins.
    "chosen AS (SELECT * FROM mean QUALIFY row_number() OVER (PARTITION BY entity ORDER BY round(score, 9), ratio, penalty DESC) = 1)",
) + f"""SELECT 'penalty' AS name, {even('median(penalty)', 4)} AS value FROM chosen
UNION ALL SELECT 'l1_ratio', {even('median(ratio)', 4)} FROM chosen"""

FOLDS = [
    *LAGGED,
    f"""base AS (SELECT * FROM lagged WHERE day < DATE '{i.CUTOFF}' AND entity IN (SELECT entity FROM panel GROUP BY 1
        HAVING COUNT(*) > 10 AND AVG(value) FILTER (day < DATE '{i.CUTOFF}') > 0))""",
    "pre AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS idx, COUNT(*) OVER () AS n FROM (SELECT DISTINCT day FROM base))",
    "sizes AS (SELECT DISTINCT n, CAST(trunc(n * 0.5::DOUBLE) AS BIGINT) AS s FROM pre)",
    """edges AS (SELECT k, CASE WHEN k = 3 THEN n ELSE CAST(trunc(k * ((n - s)::DOUBLE / 3) + s) AS BIGINT) END AS e
       FROM sizes, generate_series(0, 3) t(k))""",
    """blocks AS (SELECT CAST(a.k + 1 AS INTEGER) AS fold, p.day AS v0, q.day AS v1 FROM edges a JOIN edges b ON b.k = a.k + 1
       JOIN pre p ON p.idx = a.e JOIN pre q ON q.idx = b.e - 1)""",
    "lv AS (SELECT fold, entity, AVG(value) AS lvl FROM panel JOIN blocks ON day < v0 GROUP BY 1, 2 HAVING AVG(value) > 0)",
    """fr0 AS (SELECT base.*, fold, lvl, CASE WHEN day < v0 THEN 'train' ELSE 'validation' END AS role
       FROM base JOIN blocks ON day <= v1 JOIN lv USING (fold, entity))""",
    """fr AS (SELECT * REPLACE (lag_1 / lvl AS lag_1, lag_7 / lvl AS lag_7, target_j1 / lvl AS target_j1, target_j2 / lvl AS target_j2)
       FROM fr0)""",
]
ORACLE["fold_levels"] = with_(*FOLDS) + f"""SELECT fold, role, entity, COUNT(*) AS n, {r('MAX(lvl)', 'lvl')}, MIN(day) AS first_day,
  MAX(day) AS last_day, {r('AVG(lag_7)', 'mean_lag')} FROM fr GROUP BY 1, 2, 3"""
ORACLE["tuning_scores"] = with_(
    *FOLDS, "pens(config, penalty) AS (VALUES (0, 0.01::DOUBLE), (1, 0.3::DOUBLE), (2, 3.0::DOUBLE))",
    net_fit("fits", "fr, pens WHERE role = 'train'", "fold, config"),
    f"""err AS (SELECT config, fold, entity, (AVG(abs(target_j1 - ({net_of(1)})) * lvl) + AVG(abs(target_j2 - ({net_of(2)})) * lvl))
          / (AVG(target_j1 * lvl) + AVG(target_j2 * lvl)) * 100 AS pct
        FROM fr JOIN fits USING (fold) WHERE role = 'validation' GROUP BY 1, 2, 3)""",
) + f"SELECT CAST(config AS INTEGER) AS config, fold, {r('median(pct)', 'score', 4)} FROM err GROUP BY 1, 2"

# ---------------------------------------------------------------- stores

ORACLE["results_store"] = with_(*NAIVE_EVAL, FLAT) + f"""
SELECT 'station_j7_{i.TRAIN_FROM.replace('-', '')}_naive' AS run, flat.* FROM flat"""
_log = f"""SELECT {{label}} AS label, {{notes}} AS notes, CAST({{delta}} AS DOUBLE) AS delta_vs_baseline_pct, COUNT(*) AS n_stations,
  COUNT(*) FILTER (r2 < 0) AS n_r2_neg, {even('median(mae_pct)', 2)} AS mae_pct_median, {even('median(r2)', 4)} AS r2_median,
  {', '.join(f'{even(f"median({c})", 2)} AS {c}' for c in PCTS)} FROM per WHERE {{rows}}"""
ORACLE["experiment_log"] = with_(*NAIVE_EVAL, per_entity("entity")) + " UNION ALL ".join([
    _log.format(label="'naive'", notes="'all entities'", delta="0", rows="true"),
    _log.format(label="'naive even'", notes="''", delta="NULL", rows="entity % 2 = 0"),
])
ORACLE["sample_store"] = "SELECT entity FROM (" + ORACLE["stratified_sample"] + ")"
ORACLE["params_store"] = ORACLE["net_consensus"].split("SELECT 'penalty' AS name")[0] + f"""
SELECT entity, {rs(['penalty'], 4)}, {r('ratio', 'l1_ratio', 4)}, {rs(['score'], 4)},
  {r(even('(SELECT median(penalty) FROM chosen)', 4), 'consensus_penalty', 4)},
  {r(even('(SELECT median(ratio) FROM chosen)', 4), 'consensus_ratio', 4)},
  1.5::DOUBLE AS mean_score, 2.0::DOUBLE AS last_fold FROM chosen"""
ORACLE["group_model_store"] = with_(
    *LAGGED, NATIONS, "lc AS (SELECT lagged.*, cluster FROM lagged JOIN nations USING (entity))", ridge_models("lc", "cluster", 10),
    f"scored AS (SELECT lc.*, {PREDICT} FROM lc JOIN models USING (cluster) WHERE cluster = 5)",
) + f"SELECT cluster, entity, COUNT(*) AS n, {r('AVG(pred_j1)', 'mean_1', 4)}, {r('AVG(pred_j2)', 'mean_2', 4)} FROM scored GROUP BY 1, 2"

# ---------------------------------------------------------------- streams

ORACLE["stream_ingest"] = f"""
SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, {r('SUM(value)', 'total', 4)} FROM events GROUP BY 1, 2"""
# A day closes once the watermark, seven days behind the latest event, passes its end.
ORACLE["stream_daily_totals"] = f"""
SELECT CAST(ts AS DATE) AS day, event_type, {r('SUM(value)', 'value', 4)}, COUNT(*) AS n FROM events
GROUP BY 1, 2 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 7 DAY FROM events)"""
ORACLE["stream_upserts"] = f"""
SELECT CAST(ts AS DATE) AS day, event_type AS entity, {r('SUM(value)', 'value', 4)}, COUNT(*) AS n FROM events GROUP BY 1, 2"""
ORACLE["stream_components"] = with_(PANEL, MULTI, PAIRS, GROUPS) + """
SELECT key, entity, grp AS "group", MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n_days
FROM grouped JOIN multi USING (entity) GROUP BY 1, 2, 3"""
ORACLE["stream_actions"] = ORACLE["entity_actions"]
ORACLE["stream_serving"] = ORACLE["serving_features"]
