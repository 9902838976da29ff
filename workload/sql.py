"""Building blocks of the SQL counterparts, written independently of the library.

Where the library uses running totals and windows, these use range joins over
a dense grid, so that agreement of the two means something.
"""

from __future__ import annotations

THRESHOLD = 3.5
MIN_EVENTS = 10
WARMUP = 5
HORIZON = 7


def q(expr: str) -> str:
    """Round a double so that noise in its last digits cannot show."""
    return f"(round(({expr}) + 1e-9, 6) + 0e0)"


EVENTS_RAW = """
select event_id - (case when event_id % 50 = 49 then 1 else 0 end) as id,
       ts as time,
       ts + to_seconds(cast(event_id % 1000 as bigint)) as updated,
       case when event_id % 211 = 0 then cast(95 as double)
            else cast(user_id % 10 - 5 as double) + cast(0.25 as double) end as latitude,
       cast((user_id // 10) % 10 - 5 as double) + cast(0.75 as double) as longitude,
       cast(event_id % 300 as double) as depth,
       case when event_id % 97 = 0 then null
            else (20 + floor(value / cast(11.5 as double))) / cast(10 as double) end as mag,
       case when event_id % 89 = 0 then null else 'ml' end as "magType",
       case when event_type = 'error' and event_id % 10 = 0
            then 'quarry blast' else 'earthquake' end as type
from events
"""

DEDUPED = f"""
select * exclude (rn) from (
  select *, row_number() over (partition by id order by updated desc nulls first) as rn
  from ({EVENTS_RAW}) r) where rn = 1
"""

EVENTS_CLEAN = f"""
select * from ({DEDUPED}) d
where mag is not null and "magType" is not null and time is not null and type = 'earthquake'
  and latitude between -90 and 90 and longitude between -180 and 180 and depth between -5 and 700
"""

ORDERS = """
select o_orderkey as id,
       o_orderdate + to_seconds(cast(o_orderkey % 86400 as bigint)) as time,
       o_orderdate + to_seconds(cast(o_orderkey % 86400 as bigint)) as updated,
       cast(n_nationkey // 5 - 2 as double) + cast(0.5 as double) as latitude,
       cast(n_nationkey % 5 - 2 as double) + cast(0.5 as double) as longitude,
       cast(10 as double) as depth,
       (20 + o_orderkey % 7
           + (case when o_orderkey % 13 = 0 then 2 * (o_orderkey % 11) else 0 end))
         / cast(10 as double) as mag,
       'ml' as "magType", 'earthquake' as type
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def base(catalog: str, min_events: int = MIN_EVENTS, threshold: float = THRESHOLD) -> str:
    """CTEs: ev, cells, act, mc, daily, cal, grid."""
    return f"""
cat as ({catalog}),
ev as (select *, cast(floor(latitude) as integer) as i, cast(floor(longitude) as integer) as j,
              cast(time as date) as day,
              cast(round_even(mag / cast(0.1 as double), 0) as integer) as bin from cat),
cells as (select i, j, count(*) as n from ev group by i, j),
act as (select * from cells where n >= {min_events}),
bins as (select i, j, bin, count(*) as c, min(time) as ft from ev group by i, j, bin),
mode as (select i, j, bin from (
   select *, row_number() over (partition by i, j order by c desc, ft, bin) as rn from bins)
   where rn = 1),
mc as (select i, j, bin, bin * cast(0.1 as double) + cast(0.2 as double) as mc from mode),
daily as (
  select e.i, e.j, e.day, count(*) as n, sum(e.mag) as sm, max(e.mag) as mm,
         sum(pow(cast(10 as double), cast(1.5 as double) * e.mag + cast(4.8 as double))) as en,
         sum(case when e.mag >= mc.mc then 1 else 0 end) as qn,
         sum(case when e.mag >= mc.mc then e.mag else 0 end) as qm,
         sum(case when e.mag >= {threshold} then 1 else 0 end) as sg
  from ev e join mc on e.i = mc.i and e.j = mc.j group by e.i, e.j, e.day),
cal as (select cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day
        from ev),
grid as (select act.i, act.j, cal.day from act cross join cal)
"""


def window(w: int) -> str:
    """Sums over the last ``w`` days of each grid row."""
    return f"""
w{w} as (
  select g.i, g.j, g.day, coalesce(sum(d.n), 0) as n, sum(d.sm) as sm, max(d.mm) as mm,
         coalesce(sum(d.en), 0) as en, coalesce(sum(d.qn), 0) as qn, sum(d.qm) as qm
  from grid g left join daily d
    on d.i = g.i and d.j = g.j and d.day between g.day - {w - 1} and g.day
  group by g.i, g.j, g.day)
"""


PAST = """
past as (
  select g.i, g.j, g.day, coalesce(sum(d.n), 0) as hist, g.day - max(d.day) as since,
         coalesce(sum(d.n * pow(cast(0.5 as double), (g.day - d.day) / cast(3 as double))), 0) as n3,
         coalesce(sum(d.en * pow(cast(0.5 as double), (g.day - d.day) / cast(3 as double))), 0) as e3,
         coalesce(sum(d.n * pow(cast(0.5 as double), (g.day - d.day) / cast(10 as double))), 0) as n10,
         coalesce(sum(d.en * pow(cast(0.5 as double), (g.day - d.day) / cast(10 as double))), 0) as e10
  from grid g left join daily d on d.i = g.i and d.j = g.j and d.day <= g.day
  group by g.i, g.j, g.day)
"""

NEIGHBOURS = """
near as (
  select a.i, a.j, d.day, sum(d.n) as n from act a join daily d
    on abs(d.i - a.i) <= 1 and abs(d.j - a.j) <= 1 and not (d.i = a.i and d.j = a.j)
  group by a.i, a.j, d.day),
nbr as (
  select g.i, g.j, g.day,
         coalesce(sum(d.n * pow(cast(0.5 as double), (g.day - d.day) / cast(3 as double))), 0) as nn
  from grid g left join near d on d.i = g.i and d.j = g.j and d.day <= g.day
  group by g.i, g.j, g.day)
"""

NEXT_SIG = f"""
ahead as (
  select g.i, g.j, g.day, min(d.day) - g.day as wait
  from grid g left join daily d
    on d.i = g.i and d.j = g.j and d.sg > 0 and d.day > g.day and d.day <= g.day + {HORIZON}
  group by g.i, g.j, g.day)
"""

KEPT = f"""
kept as (
  select p.i, p.j, p.day from past p
  where p.hist >= {WARMUP} and p.day + {HORIZON} <= (select max(day) from ev))
"""


def b_expr(alias: str) -> str:
    return (f"case when {alias}.qn >= 10 then log10(exp(cast(1 as double))) / "
            f"({alias}.qm / {alias}.qn - (mc.mc - cast(0.05 as double))) end")


WINDOWS = (7, 30, 90, 365)


def features(catalog: str, min_events: int = MIN_EVENTS, threshold: float = THRESHOLD) -> str:
    """CTE ``feat``: unrounded features of every grid row."""
    joins = " ".join(
        f"join {t} on {t}.i = p.i and {t}.j = p.j and {t}.day = p.day"
        for t in ["w7", "w30", "w90", "w365", "nbr"])
    cols = []
    for w in WINDOWS:
        t = f"w{w}"
        cols += [f"cast({t}.n as double) as rolling_count_{w}d",
                 f"{t}.sm / nullif({t}.n, 0) as rolling_mean_mag_{w}d",
                 f"{t}.mm as rolling_max_mag_{w}d", f"log10({t}.en + 1) as log_energy_{w}d"]
    for w in (90, 365):
        cols += [f"{b_expr(f'w{w}')} as b_value_{w}d",
                 f"cast(w{w}.qn as double) as b_value_{w}d_n_events"]
    angle = "2 * pi() * dayofyear(p.day) / cast(365.25 as double)"
    return f"""
{base(catalog, min_events, threshold)}, {window(7)}, {window(30)}, {window(90)}, {window(365)},
{PAST}, {NEIGHBOURS},
feat as (
  select p.i, p.j, p.day, p.i + cast(0.5 as double) as cell_lat, p.j + cast(0.5 as double) as cell_lon,
         mc.mc as mc_cell, cast(p.hist as double) as historical_event_count,
         cast(p.since as double) as days_since_last_event, {", ".join(cols)},
         p.n3 as decay_count_hl3d, log10(p.e3 + 1) as decay_log_energy_hl3d,
         p.n10 as decay_count_hl10d, log10(p.e10 + 1) as decay_log_energy_hl10d,
         nbr.nn as neighbor_decay_count_hl3d, sin({angle}) as doy_sin, cos({angle}) as doy_cos
  from past p {joins} join mc on mc.i = p.i and mc.j = p.j)
"""


FEATURE_NAMES = (
    ["mc_cell", "historical_event_count", "days_since_last_event"]
    + [f"{n}_{w}d" for w in WINDOWS
       for n in ("rolling_count", "rolling_mean_mag", "rolling_max_mag", "log_energy")]
    + ["decay_count_hl3d", "decay_log_energy_hl3d", "decay_count_hl10d",
       "decay_log_energy_hl10d", "neighbor_decay_count_hl3d"]
    + [x for w in (90, 365) for x in (f"b_value_{w}d", f"b_value_{w}d_n_events")]
    + ["doy_sin", "doy_cos"]
)


def matrix(catalog: str) -> str:
    """CTE ``mx``: the labelled feature matrix, unrounded."""
    names = ", ".join(f"f.{n}" for n in FEATURE_NAMES)
    return f"""
{features(catalog)}, {NEXT_SIG}, {KEPT},
mx as (
  select f.day, h.h as horizon_day, f.cell_lat, f.cell_lon, {names},
         case when a.wait <= h.h then 1 else 0 end as target
  from kept k join feat f on f.i = k.i and f.j = k.j and f.day = k.day
  join ahead a on a.i = k.i and a.j = k.j and a.day = k.day
  cross join (select cast(unnest(generate_series(1, {HORIZON})) as integer) as h) h)
"""


def scored(catalog: str) -> str:
    """CTE ``sc``: matrix keys with three rounded pseudo-scores as models A, B, C."""
    parts = []
    for model, column in (("A", "rolling_count_30d"), ("B", "rolling_count_7d"),
                          ("C", "decay_count_hl3d")):
        parts.append(
            f"select '{model}' as model, day, horizon_day, cell_lat, cell_lon, target, "
            f"round({column} / (1 + {column}) + 1e-9, 6) as proba from mx")
    return f"{matrix(catalog)}, sc as ({' union all '.join(parts)})"


def score_curve(source: str, groups: str) -> str:
    """CTEs ``ds`` (distinct scores) and ``cv`` (with cumulative counts), by plain windows."""
    return f"""
ds as (select {groups}, proba, sum(target) as pos, sum(1 - target) as neg
       from {source} group by {groups}, proba),
cv as (select *,
         sum(pos) over (partition by {groups} order by proba desc) as tp,
         sum(neg) over (partition by {groups} order by proba desc) as fp,
         sum(pos) over (partition by {groups}) as p, sum(neg) over (partition by {groups}) as n
       from ds),
rk as (select {groups},
         case when max(p) > 0 and max(n) > 0
              then sum(pos * (n - fp + neg / cast(2 as double))) / (max(p) * max(n)) end as roc_auc,
         case when max(p) > 0 and max(n) > 0
              then sum(pos * tp / cast(tp + fp as double)) / max(p) end as pr_auc
       from cv group by {groups})
"""
