"""Every registered query, next to its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tremorgrid.config import HazardConfig
from tremorgrid.functions import scalar as fn
from tremorgrid.operators import boosting, cleaning, grid, metrics, ordered, profile, rolling, splits
from tremorgrid.operators.imputation import base_columns, fit_imputation
from tremorgrid.plans import backtest, features, forecast, reports, training
from tremorgrid.session import materialize, scratch_path
from tremorgrid.sources import catalog as feed
from tremorgrid.sources import views
from tremorgrid.sources.tables import TableStore
from tremorgrid.streaming import events as streams
from workload import sql as S
from workload.sql import q

CFG = HazardConfig(mag_threshold=S.THRESHOLD, min_events_per_cell=S.MIN_EVENTS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}  # without rounding
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        PLAIN[name] = run
        QUERIES[name] = lambda spark, sf_dir: rounded(run(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return register


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles to six decimals; the nudge keeps exact ties on one side."""
    return df.select([
        F.round(F.col(c) + F.lit(1e-9), 6).alias(c) if t == "double" else F.col(c)
        for c, t in df.dtypes])


def raw_events(spark, d):
    return views.catalog_events(spark, d)


def clean_events(spark, d):
    return cleaning.clean_catalog(views.catalog_events(spark, d), CFG)


def orders(spark, d):
    return views.catalog_orders(spark, d)


def cell_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"cell_lat_floor": "i", "cell_lon_floor": "j"})


CATALOG_COLUMNS = 'id, time, updated, latitude, longitude, depth, mag, "magType", type'

# --- ingest and cleaning ------------------------------------------------------


@query("upsert_latest", f"select {CATALOG_COLUMNS} from ({S.DEDUPED}) d")
def upsert_latest(spark, d):
    raw = raw_events(spark, d)
    return cleaning.upsert(raw.where("id % 2 = 0"), [raw.where("id % 2 = 1")])


@query("typed_feed", f"""
select id, time, updated, latitude, longitude, depth, mag, "magType", type
from (select cast(id as varchar) as id, * exclude (id) from ({S.EVENTS_RAW}) r) t""")
def typed_feed(spark, d):
    typed = cleaning.coerce_types(views.as_raw_text(raw_events(spark, d)))
    return typed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("time", "updated")})


@query("clean_catalog", f"select {CATALOG_COLUMNS} from ({S.EVENTS_CLEAN}) c")
def clean_catalog(spark, d):
    return clean_events(spark, d)


@query("clean_step_counts", f"""
with raw as ({S.EVENTS_RAW}), dd as ({S.DEDUPED}),
a as (select * from dd where mag is not null and "magType" is not null),
b as (select * from a where time is not null),
c as (select * from b where type = 'earthquake'),
e as ({S.EVENTS_CLEAN}),
n as (select 0 as step_no, 'raw' as step, (select count(*) from raw) as r
      union all select 1, 'duplicate_ids', (select count(*) from dd)
      union all select 2, 'missing_mag_or_magtype', (select count(*) from a)
      union all select 3, 'missing_time', (select count(*) from b)
      union all select 4, 'non_matching_eventtype', (select count(*) from c)
      union all select 5, 'out_of_physical_bounds', (select count(*) from e))
select step_no, step, r as rows, coalesce(lag(r) over (order by step_no) - r, 0) as removed from n""")
def clean_step_counts(spark, d):
    return cleaning.clean_step_counts(raw_events(spark, d), CFG)


@query("catalog_summary", f"""
select count(*) as rows, min(time) as first_time, max(time) as last_time,
       {q('min(mag)')} as min_mag, {q('max(mag)')} as max_mag,
       count(*) filter (where mag is null) as missing_mag from ({S.EVENTS_RAW}) r""")
def catalog_summary(spark, d):
    return cleaning.catalog_summary(raw_events(spark, d))


@query("incremental_window", f"""
select max(time) - interval 60 minute as start, timestamp '2030-01-01 00:00:00' as "end"
from ({S.EVENTS_RAW}) r""")
def incremental_window(spark, d):
    until = F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00"))
    return feed.incremental_window(raw_events(spark, d), CFG, end=until)


@query("range_read", f"""
select {CATALOG_COLUMNS} from ({S.EVENTS_RAW}) r
where time >= timestamp '2024-01-05 00:00:00' and time <= timestamp '2024-01-20 12:00:00'
  and mag >= 2.5 and mag <= 4.0 and type = 'earthquake'""")
def range_read(spark, d):
    moment = lambda text: F.to_timestamp_ntz(F.lit(text))
    return feed.read_range(raw_events(spark, d), moment("2024-01-05 00:00:00"),
                           moment("2024-01-20 12:00:00"), 2.5, 4.0, "earthquake")


@query("time_chunks", """
with recursive span as (
  select epoch_us(timestamp '2024-01-01') as a, epoch_us(timestamp '2024-02-01') as b),
width as (select a, b, cast(ceil((b - a) / cast(1048576 as double)) as bigint) as w from span),
t as (select (epoch_us(ts) - a) // w as piece from events, width
      where epoch_us(ts) >= a and epoch_us(ts) < b),
fine as (select piece, count(*) as n from t group by piece),
total as (select sum(n) as n from fine),
tree as (
  select 0 as level, cast(0 as bigint) as node, cast((select n from total) as bigint) as n
  union all
  select level + 1, 2 * node + half, cast(c as bigint) from (
    select tree.level, tree.node, h.half,
           (select coalesce(sum(f.n), 0) from fine f
            where f.piece >= (2 * tree.node + h.half) * (1048576 >> (tree.level + 1))
              and f.piece < (2 * tree.node + h.half + 1) * (1048576 >> (tree.level + 1))) as c
    from tree, (values (0), (1)) h(half) where tree.n > 500 and tree.level < 20) x
  where c > 0)
select level, node, n as rows,
       make_timestamp(a + node * w * (1048576 >> level)) as start,
       make_timestamp(least(a + (node + 1) * w * (1048576 >> level), b)) as "end"
from tree, width where n <= 500 or level = 20""")
def time_chunks(spark, d):
    plan = feed.plan_time_chunks(
        views.read_table(spark, d, "events").withColumnRenamed("ts", "time"),
        "2024-01-01 00:00:00", "2024-02-01 00:00:00", cap=500)
    return plan.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("random_sample", f"""
select {CATALOG_COLUMNS} from (
  select *, row_number() over (order by md5(concat('42:', id))) as rn from ({S.EVENTS_CLEAN}) c)
where rn <= 500""")
def random_sample(spark, d):
    return ordered.sample_exactly(clean_events(spark, d), 500, "id", CFG.seed)


# --- profile ------------------------------------------------------------------

_PROFILED = ["id", "latitude", "longitude", "depth", "mag"]


def _long(columns, source=S.EVENTS_RAW):
    return " union all ".join(
        f"""select '{c}' as "column", cast("{c}" as double) as value from ({source}) r"""
        for c in columns)


@query("null_rates", " union all ".join(
    f"""select '{c}' as "column", {q(f'avg(case when "{c}" is null then 1.0 else 0.0 end) * 100')}
        as pct_missing from ({S.EVENTS_RAW}) r"""
    for c in ["id", "time", "updated", "latitude", "longitude", "depth", "mag", "magType", "type"]))
def null_rates(spark, d):
    return profile.null_rates(raw_events(spark, d))


@query("profile_distinct", " union all ".join(
    f"""select '{c}' as "column", sum(n) :: bigint as n_rows,
        coalesce(sum(n) filter (where v is null), 0) :: bigint as n_missing,
        count(*) filter (where v is not null) as n_distinct,
        count(*) filter (where v is not null and n = 1) as n_unique,
        max(n) filter (where v is not null) as top_count
        from (select "{c}" as v, count(*) as n from ({S.EVENTS_RAW}) r group by 1) g"""
    for c in ["id", "time", "updated", "latitude", "longitude", "depth", "mag", "magType", "type"]))
def profile_distinct(spark, d):
    return profile.distinct_stats(raw_events(spark, d)).drop("top_value")


@query("profile_columns", f"""
with l as ({_long(_PROFILED)}), m as (select "column", avg(value) as mu from l group by 1)
select l."column", {q('avg(value)')} as mean, {q('stddev_samp(value)')} as std,
       {q('min(value)')} as min, {q('max(value)')} as max,
       {q('sum(pow(value - mu, 3)) / count(value) / pow(var_pop(value), 1.5)')} as skewness,
       {q('sum(pow(value - mu, 4)) / count(value) / pow(var_pop(value), 2) - 3')} as kurtosis,
       count(*) filter (where value = 0) as n_zeros, count(*) filter (where value < 0) as n_negative
from l join m on l."column" = m."column" group by 1""")
def profile_columns(spark, d):
    return profile.numeric_stats(raw_events(spark, d))


@query("profile_quantiles", f"""
select "column", p as prob, {q('case ' + ' '.join(
    f"when p = {p} then quantile_cont(value, {p})" for p in profile.QUANTILES) + ' end')} as q
from ({_long(_PROFILED)}) l, (values {', '.join(f'(cast({p} as double))' for p in profile.QUANTILES)}) t(p)
group by 1, 2""")
def profile_quantiles(spark, d):
    return profile.numeric_quantiles(raw_events(spark, d))


@query("profile_histogram", f"""
with l as ({_long(_PROFILED)}),
s as (select "column", min(value) as lo, max(value) as hi from l group by 1)
select "column", bin, {q('lo + bin * ((hi - lo) / 10)')} as low,
       {q('lo + (bin + 1) * ((hi - lo) / 10)')} as high, count(*) as n
from (select l."column", lo, hi,
             cast(least(floor((value - lo) / ((hi - lo) / 10)), 9) as integer) as bin
      from l join s on l."column" = s."column" where value is not null) b
group by "column", bin, lo, hi""")
def profile_histogram(spark, d):
    return profile.histogram(raw_events(spark, d))


@query("profile_correlations", " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, "
    f"{q(f'corr({a}, {b})')} as pearson from ({S.EVENTS_RAW}) r"
    for i, a in enumerate(_PROFILED) for b in _PROFILED[i + 1:]))
def profile_correlations(spark, d):
    return profile.correlations(raw_events(spark, d))


_CATALOG = ["id", "time", "updated", "latitude", "longitude", "depth", "mag", "magType", "type"]


@query("profile_report", f"""
with r as ({S.EVENTS_RAW}),
t as ({" union all ".join(f"""select '{c}' as "column", cast("{c}" as varchar) as v from r""" for c in _CATALOG)}),
vc as (select "column", v, count(*) as n from t group by 1, 2),
ds as (select "column", cast(sum(n) as bigint) as n_rows, cast(coalesce(sum(n) filter (where v is null), 0) as bigint) as n_missing,
              count(*) filter (where v is not null) as n_distinct, count(*) filter (where v is not null and n = 1) as n_unique,
              max(n) filter (where v is not null) as top_count
       from vc group by 1),
tv as (select vc."column", max(v) as top_value from vc join ds on ds."column" = vc."column" and n = top_count where v is not null group by 1),
l as ({_long(_PROFILED)}), m as (select "column", avg(value) as mu from l group by 1),
ns as (select l."column", avg(value) as mean, stddev_samp(value) as std, min(value) as min, max(value) as max,
              sum(pow(value - mu, 3)) / count(value) / pow(var_pop(value), 1.5) as skewness,
              sum(pow(value - mu, 4)) / count(value) / pow(var_pop(value), 2) - 3 as kurtosis,
              count(*) filter (where value = 0) as n_zeros, count(*) filter (where value < 0) as n_negative,
              {", ".join(f"quantile_cont(value, {p}) as p{round(p * 100)}" for p in profile.QUANTILES)}
       from l join m on m."column" = l."column" group by 1),
pr as ({" union all ".join(f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as r from r" for a in _PROFILED for b in _PROFILED if a != b)}),
st as (select a, max(abs(r)) as s from pr where r is not null group by 1),
sp as (select pr.a as "column", max(b) as correlated_with, arg_max(r, b) as pearson from pr join st on st.a = pr.a and abs(r) = s group by 1)
select ds."column", n_rows, n_missing, n_distinct, n_unique, top_value, top_count, {q('mean')} as mean, {q('std')} as std,
       {q('min')} as min, {q('max')} as max, {q('skewness')} as skewness, {q('kurtosis')} as kurtosis, n_zeros, n_negative,
       {", ".join(f"{q(f'p{round(p * 100)}')} as p{round(p * 100)}" for p in profile.QUANTILES)}, correlated_with, {q('pearson')} as pearson,
       concat_ws(',', case when n_distinct = 1 then 'constant' end, case when n_distinct = n_rows and n_rows > 1 then 'unique' end,
                 case when n_missing / n_rows >= 0.05 then 'missing' end, case when top_count / n_rows >= 0.95 then 'imbalance' end,
                 case when n_zeros / n_rows >= 0.10 then 'zeros' end, case when abs(skewness) > 20 then 'skewed' end,
                 case when abs(pearson) > 0.9 then 'high_correlation' end) as alerts
from ds left join tv on tv."column" = ds."column" left join ns on ns."column" = ds."column" left join sp on sp."column" = ds."column"
""")
def profile_report(spark, d):
    return profile.profile(raw_events(spark, d), "full").withColumn("alerts", F.array_join("alerts", ","))


@query("duplicate_ids",
       f"select id, count(*) as copies from ({S.EVENTS_RAW}) r group by id having count(*) > 1")
def duplicate_ids(spark, d):
    return profile.duplicate_rows(raw_events(spark, d), ["id"])


@query("duplicate_share", f"""
select cast(sum(c) as bigint) as n_rows, cast(sum(c - 1) as bigint) as n_duplicates from (
  select count(*) as c from ({S.EVENTS_RAW}) r
  group by id, time, updated, latitude, longitude, depth, mag, "magType", type) g""")
def duplicate_share(spark, d):
    """Repeated whole rows of the catalog."""
    return profile.duplicate_share(raw_events(spark, d))


@query("duplicate_share_keys", f"""
select cast(sum(c) as bigint) as n_rows, cast(sum(c - 1) as bigint) as n_duplicates from (
  select count(*) as c from events group by event_type, user_id, value) g""")
def duplicate_share_keys(spark, d):
    """Rows of the events table that repeat in three of its columns."""
    return profile.duplicate_share(
        views.read_table(spark, d, "events").select("event_type", "user_id", "value"))


# --- grid -----------------------------------------------------------------------

_E = S.base(S.EVENTS_CLEAN)
_O = S.base(S.ORDERS)


@query("active_cells", f"with {_E} select i, j, n as n_events from act")
def active_cells(spark, d):
    return cell_names(grid.active_cells(clean_events(spark, d), CFG))


@query("cell_coverage", f"""
with {S.base(S.EVENTS_CLEAN, 50)}
select (select count(*) from act) as n_active_cells, count(*) as n_total_cells,
       {q('100.0 * (select sum(n) from act) / sum(n)')} as coverage_pct from cells""")
def cell_coverage(spark, d):
    return grid.cell_coverage(clean_events(spark, d), CFG.with_(min_events_per_cell=50))


@query("active_events", f"""
with {S.base(S.EVENTS_CLEAN, 50)}
select i, j, id, time, mag from ev where exists (
  select 1 from act where act.i = ev.i and act.j = ev.j)""")
def active_events(spark, d):
    cfg = CFG.with_(min_events_per_cell=50)
    catalog = clean_events(spark, d)
    kept = grid.restrict_to_active(catalog, grid.active_cells(catalog, cfg), cfg)
    return cell_names(kept).select("i", "j", "id", "time", "mag")


@query("completeness_mc", f"""
with {_E} select mc.i, mc.j, cells.n as n_events, mc.bin as modal_bin, {q('mc.mc')} as mc_cell
from mc join cells on mc.i = cells.i and mc.j = cells.j""")
def completeness_mc(spark, d):
    return cell_names(grid.completeness_magnitude(clean_events(spark, d), CFG))


def _cell_day(catalog_sql):
    return f"""
with {S.base(catalog_sql)}
select i, j, day, n, {q('sm')} as sum_mag, {q('mm')} as max_mag, {q('log10(en)')} as log_energy,
       cast(qn as bigint) as qual_count, {q('qm')} as qual_summag, cast(sg as bigint) as sig_count
from daily"""


def _cell_day_rows(catalog):
    days = cell_names(grid.cell_days(catalog, CFG))
    return days.select("i", "j", F.date_from_unix_date("day_ord").alias("day"), "n", "sum_mag",
                       "max_mag", F.log10("sum_energy").alias("log_energy"), "qual_count",
                       "qual_summag", "sig_count")


@query("cell_day_agg", _cell_day(S.EVENTS_CLEAN))
def cell_day_agg(spark, d):
    return _cell_day_rows(clean_events(spark, d))


@query("cell_day_agg_long", _cell_day(S.ORDERS))
def cell_day_agg_long(spark, d):
    return _cell_day_rows(orders(spark, d))


@query("dense_cell_day", f"""
with {_O}
select g.i, g.j, g.day, coalesce(d.n, 0) as n, {q('coalesce(d.sm, 0)')} as sum_mag,
       {q('d.mm')} as max_mag, cast(coalesce(d.qn, 0) as bigint) as qual_count,
       cast(coalesce(d.sg, 0) as bigint) as sig_count
from grid g left join daily d on d.i = g.i and d.j = g.j and d.day = g.day""")
def dense_cell_day(spark, d):
    dense = cell_names(grid.dense_cell_days(orders(spark, d), CFG))
    return dense.select("i", "j", "day", "n", "sum_mag", "max_mag", "qual_count", "sig_count")


# --- trailing features ------------------------------------------------------------

def long_features(spark, d, *columns):
    """All days of the calendar for every active cell."""
    rows = features.cell_day_features(orders(spark, d), CFG, whole_calendar=True)
    return rows.select("day", "cell_lat", "cell_lon", *columns)


def _windowed(expr: Callable[[int], str], windows, prefix: str, suffix: str = "d") -> str:
    ctes = ", ".join(S.window(w) for w in windows)
    joins = " ".join(f"join w{w} on w{w}.i = p.i and w{w}.j = p.j and w{w}.day = p.day"
                     for w in windows)
    columns = ", ".join(f"{q(expr(w))} as {prefix}_{w}{suffix}" for w in windows)
    return f"""
with {_O}, {S.PAST}, {ctes}
select p.day, p.i + cast(0.5 as double) as cell_lat, p.j + cast(0.5 as double) as cell_lon, {columns}
from past p {joins} join mc on mc.i = p.i and mc.j = p.j"""


@query("rolling_counts", _windowed(lambda w: f"w{w}.n", S.WINDOWS, "rolling_count"))
def rolling_counts(spark, d):
    return long_features(spark, d, *[f"rolling_count_{w}d" for w in S.WINDOWS])


@query("rolling_mean_mag", _windowed(lambda w: f"w{w}.sm / nullif(w{w}.n, 0)", S.WINDOWS,
                                     "rolling_mean_mag"))
def rolling_mean_mag(spark, d):
    return long_features(spark, d, *[f"rolling_mean_mag_{w}d" for w in S.WINDOWS])


@query("rolling_max_mag", _windowed(lambda w: f"w{w}.mm", S.WINDOWS, "rolling_max_mag"))
def rolling_max_mag(spark, d):
    return long_features(spark, d, *[f"rolling_max_mag_{w}d" for w in S.WINDOWS])


@query("rolling_log_energy", _windowed(lambda w: f"log10(w{w}.en + 1)", S.WINDOWS, "log_energy"))
def rolling_log_energy(spark, d):
    return long_features(spark, d, *[f"log_energy_{w}d" for w in S.WINDOWS])


@query("b_values", _windowed(lambda w: S.b_expr(f"w{w}"), (90, 365), "b_value"))
def b_values(spark, d):
    return long_features(spark, d, "b_value_90d", "b_value_365d")


@query("b_sample_sizes", _windowed(lambda w: f"w{w}.qn", (90, 365), "b_value", "d_n_events"))
def b_sample_sizes(spark, d):
    return long_features(spark, d, "b_value_90d_n_events", "b_value_365d_n_events")


@query("decay_features", f"""
with {_O}, {S.PAST}
select day, i + cast(0.5 as double) as cell_lat, j + cast(0.5 as double) as cell_lon,
       {q('n3')} as decay_count_hl3d, {q('log10(e3 + 1)')} as decay_log_energy_hl3d,
       {q('n10')} as decay_count_hl10d, {q('log10(e10 + 1)')} as decay_log_energy_hl10d
from past""")
def decay_features(spark, d):
    return long_features(spark, d, "decay_count_hl3d", "decay_log_energy_hl3d",
                         "decay_count_hl10d", "decay_log_energy_hl10d")


@query("neighbor_decay", f"""
with {_E}, {S.PAST}, {S.NEIGHBOURS}
select n.day, n.i + cast(0.5 as double) as cell_lat, n.j + cast(0.5 as double) as cell_lon,
       {q('n.nn')} as neighbor_decay_count_hl3d
from nbr n join past p on p.i = n.i and p.j = n.j and p.day = n.day""")
def neighbor_decay(spark, d):
    rows = features.cell_day_features(clean_events(spark, d), CFG, whole_calendar=True)
    return rows.select(
        "day", "cell_lat", "cell_lon", "neighbor_decay_count_hl3d")


@query("days_since_last", f"""
with {_O}, {S.PAST}
select day, i + cast(0.5 as double) as cell_lat, j + cast(0.5 as double) as cell_lon,
       {q('since')} as days_since_last_event from past""")
def days_since_last(spark, d):
    return long_features(spark, d, "days_since_last_event")


@query("event_maturity", f"""
with {_O}, {S.PAST}
select day, i + cast(0.5 as double) as cell_lat, j + cast(0.5 as double) as cell_lon,
       {q('hist')} as historical_event_count from past""")
def event_maturity(spark, d):
    return long_features(spark, d, "historical_event_count")


# --- labels and matrix --------------------------------------------------------------

_MX_E = S.matrix(S.EVENTS_CLEAN)
_MX_O = S.matrix(S.ORDERS)
_MX_COLUMNS = ", ".join(f"{q(c)} as {c}" for c in ["cell_lat", "cell_lon"] + S.FEATURE_NAMES)


def events_matrix(spark, d):
    return features.feature_matrix(clean_events(spark, d), CFG)


def orders_matrix(spark, d):
    return features.feature_matrix(orders(spark, d), CFG)


def stored_matrix(spark, d):
    """The long matrix as a table, as splits and backtests read it many times."""
    return materialize(orders_matrix(spark, d), "matrix")


@query("multi_horizon_labels", f"""
with {_E}, {S.PAST}, {S.NEXT_SIG}, {S.KEPT}
select k.day, h.h as horizon_day, k.i + cast(0.5 as double) as cell_lat,
       k.j + cast(0.5 as double) as cell_lon, cast(exists (
         select 1 from daily d where d.i = k.i and d.j = k.j and d.sg > 0
         and d.day > k.day and d.day <= k.day + h.h) as integer) as target
from kept k, (select cast(unnest(generate_series(1, {S.HORIZON})) as integer) as h) h""")
def multi_horizon_labels(spark, d):
    return events_matrix(spark, d).select("day", "horizon_day", "cell_lat", "cell_lon", "target")


@query("label_rates", f"""
with {_MX_E}
select horizon_day, count(*) as rows, cast(sum(target) as bigint) as positives,
       {q('avg(target)')} as positive_rate from mx group by grouping sets ((), (horizon_day))""")
def label_rates(spark, d):
    return reports.label_rates(events_matrix(spark, d))


_SENSITIVITY = [3.0, 3.5, 4.0]


@query("threshold_sensitivity", f"""
with {_E}, {S.PAST}, {S.KEPT},
t as (select * from (values {', '.join(f'(cast({m} as double))' for m in _SENSITIVITY)}) t(m)),
h as (select cast(unnest(generate_series(1, {S.HORIZON})) as integer) as h),
l as (select t.m, h.h, cast(exists (
        select 1 from ev where ev.i = k.i and ev.j = k.j and ev.mag >= t.m
        and ev.day > k.day and ev.day <= k.day + h.h) as integer) as y
      from kept k, t, h)
select m as mag_threshold, h as horizon_day, count(*) as rows,
       cast(sum(y) as bigint) as positives, {q('avg(y)')} as positive_rate from l group by m, h""")
def threshold_sensitivity(spark, d):
    return reports.threshold_rates(clean_events(spark, d), _SENSITIVITY, CFG)


@query("feature_matrix", f"with {_MX_E} select day, horizon_day, {_MX_COLUMNS}, target from mx")
def feature_matrix(spark, d):
    return events_matrix(spark, d)


@query("feature_matrix_long", f"with {_MX_O} select day, horizon_day, {_MX_COLUMNS}, target from mx")
def feature_matrix_long(spark, d):
    return orders_matrix(spark, d)


@query("data_dictionary", f"with {_MX_E} " + " union all ".join(
    f"""select {k} as column_no, '{c}' as "column",
        '{dict(day="date", horizon_day="int", target="int").get(c, "double")}' as dtype,
        '{reports.describe_columns(CFG).get(c, "").replace("'", "''")}' as description,
        round(avg(case when {c} is null then 1.0 else 0.0 end) * 100, 3) + 1e-9 as pct_missing
        from mx""" for k, c in enumerate(
        ["day", "horizon_day", "cell_lat", "cell_lon", *S.FEATURE_NAMES, "target"])).replace(
        "+ 1e-9 as pct_missing", "as pct_missing"))
def data_dictionary(spark, d):
    return reports.data_dictionary(events_matrix(spark, d), CFG)


@query("feature_report", f"""
with {_MX_E}
select (select count(*) from act) as n_active_cells, (select count(*) from cells) as n_total_cells,
       {q('100.0 * (select sum(n) from act) / (select sum(n) from cells)')} as coverage_pct,
       cast((select count(*) from past where hist < {S.WARMUP}) as bigint) as rows_dropped_warmup,
       cast((select count(*) from past where hist >= {S.WARMUP}) - (select count(*) from kept)
            as bigint) as rows_dropped_no_label,
       count(*) as final_row_count, 35 as final_column_count,
       cast(sum(target) as bigint) as target_positive_count,
       {q('avg(target)')} as target_positive_rate, min(day) as first_day, max(day) as last_day
from mx""")
def feature_report(spark, d):
    return reports.feature_report(clean_events(spark, d), CFG)


# --- splits and preparation -----------------------------------------------------------

_SPLIT = """
days as (select distinct day from mx),
ranked as (select day, row_number() over (order by day) - 1 as k, count(*) over () as n from days),
cuts as (select n, cast(floor(n * cast(0.7 as double)) as integer) as te,
                cast(floor(n * (cast(0.7 as double) + cast(0.15 as double))) as integer) as ve
         from ranked limit 1),
tags as (select day, case when k < te then 'train'
                          when k >= least(te + 7, ve) and k < ve then 'val'
                          when k >= least(ve + 7, cuts.n) then 'test' else 'purged' end as split
         from ranked, cuts),
tagged as (select mx.*, tags.split from mx join tags on mx.day = tags.day)
"""


@query("purged_split", f"""
with {_MX_O}, {_SPLIT}
select split, horizon_day, count(*) as rows, min(day) as first_day, max(day) as last_day
from tagged group by split, horizon_day""")
def purged_split(spark, d):
    return splits.with_split(stored_matrix(spark, d), CFG).groupBy("split", "horizon_day").agg(
        F.count(F.lit(1)).alias("rows"), F.min("day").alias("first_day"),
        F.max("day").alias("last_day"))


@query("split_summary", f"""
with {_MX_O}, {_SPLIT}
select split, count(*) as rows, count(distinct day) as days, min(day) as first_day,
       max(day) as last_day, cast(sum(target) as bigint) as positives,
       {q('avg(target)')} as positive_rate,
       {q('(count(*) - sum(target)) / cast(greatest(sum(target), 1) as double)')} as class_ratio,
       cast(round_even(7 * (count(*) / cast(count(distinct day) as double)), 0) as bigint) as gap_rows
from tagged group by split""")
def split_summary(spark, d):
    return splits.split_summary(splits.with_split(stored_matrix(spark, d), CFG), CFG)


@query("cv_folds", f"""
with {_MX_O}, {_SPLIT},
tr as (select *, row_number() over (order by day, horizon_day, cell_lat, cell_lon) - 1 as ri
       from tagged where split = 'train'),
sz as (select count(*) as n, cast(round_even(7 * (count(*) / cast(count(distinct day) as double)), 0)
              as bigint) as gap from tr),
folds as (select k as fold, n - (5 - k + 1) * (n // 6) as ts, n - (5 - k + 1) * (n // 6) - gap as te,
                 n // 6 as size from sz, (select unnest(generate_series(1, 5)) as k) f),
parts as (select fold, case when ri < te then 'train'
                            when ri >= ts and ri < ts + size then 'test' end as role, tr.*
          from tr, folds)
select cast(fold as integer) as fold, role, count(*) as rows, min(ri) as first_row,
       max(ri) as last_row, min(day) as first_day, max(day) as last_day,
       cast(sum(target) as bigint) as positives
from parts where role is not null group by fold, role""")
def cv_folds(spark, d):
    tagged = splits.with_split(stored_matrix(spark, d), CFG)
    return splits.cv_folds(tagged.where("split = 'train'"), CFG)


_FILLED = [c for c in S.FEATURE_NAMES if c not in ("mc_cell", "doy_sin", "doy_cos")]


@query("median_impute", f"""
with {_MX_O}, {_SPLIT},
med as (select {', '.join(f'quantile_cont({c}, 0.5) as {c}' for c in _FILLED)}
        from tagged where split = 'train'),
gaps as (select {', '.join(f'bool_or({c} is null) as {c}' for c in _FILLED)}
         from tagged where split <> 'purged')
select t.split, count(*) as rows,
       {', '.join(q(f'avg(coalesce(t.{c}, med.{c}, 0))') + f' as {c}' for c in _FILLED)},
       {', '.join(f'cast(sum(case when t.{c} is null then 1 else 0 end) as bigint) as {c}_missing'
                  for c in ('rolling_mean_mag_7d', 'rolling_max_mag_7d', 'b_value_90d'))}
from tagged t, med, gaps where t.split <> 'purged' group by t.split""")
def median_impute(spark, d):
    tagged = splits.with_split(stored_matrix(spark, d), CFG)
    kept = tagged.where("split <> 'purged'")
    imputation = fit_imputation(kept.where("split = 'train'").drop("split"), kept.drop("split"))
    flags = ("rolling_mean_mag_7d", "rolling_max_mag_7d", "b_value_90d")
    flagged = kept.withColumns({f"{c}_missing": imputation.missing(c) for c in flags})
    return imputation.transform(flagged).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in _FILLED],
        *[F.sum(f"{c}_missing").alias(f"{c}_missing") for c in flags])


# --- metrics on pseudo-scores --------------------------------------------------------

_SC = S.scored(S.EVENTS_CLEAN)
_CURVE = S.score_curve("sc", "model")


def pseudo_scored(spark, d) -> DataFrame:
    """The matrix with three simple scores in place of trained models, stored."""
    return materialize(with_pseudo_scores(events_matrix(spark, d)), "scored")


def with_pseudo_scores(matrix: DataFrame) -> DataFrame:
    x = lambda c: F.round(F.col(c) / (1 + F.col(c)) + 1e-9, 6)
    scores = F.array(
        F.struct(F.lit("A").alias("model"), x("rolling_count_30d").alias("proba")),
        F.struct(F.lit("B").alias("model"), x("rolling_count_7d").alias("proba")),
        F.struct(F.lit("C").alias("model"), x("decay_count_hl3d").alias("proba")))
    keys = ["day", "horizon_day", "cell_lat", "cell_lon", "target"]
    return matrix.select(*keys, F.inline(scores))


@query("roc_auc", f"with {_SC}, {_CURVE} select model, {q('roc_auc')} as roc_auc from rk")
def roc_auc(spark, d):
    table = metrics.score_table(pseudo_scored(spark, d), ["model"])
    return metrics.rank_metrics(table, ["model"]).select("model", "roc_auc")


@query("average_precision", f"with {_SC}, {_CURVE} select model, {q('pr_auc')} as pr_auc from rk")
def average_precision(spark, d):
    table = metrics.score_table(pseudo_scored(spark, d), ["model"])
    return metrics.rank_metrics(table, ["model"]).select("model", "pr_auc")


_CONFUSION = f"""
conf as (
  select model, count(*) filter (where target = 0 and proba < 0.5) as tn,
         count(*) filter (where target = 0 and proba >= 0.5) as fp,
         count(*) filter (where target = 1 and proba < 0.5) as fn,
         count(*) filter (where target = 1 and proba >= 0.5) as tp,
         avg(pow(proba - target, 2)) as brier_score, avg(proba) as mean_predicted
  from sc group by model)
"""


@query("brier_confusion", f"""
with {_SC}, {_CONFUSION}
select model, tn, fp, fn, tp, {q('brier_score')} as brier_score,
       {q('mean_predicted')} as mean_predicted,
       {q('coalesce(tp / nullif(cast(tp + fp as double), 0), 0)')} as precision,
       {q('coalesce(tp / nullif(cast(tp + fn as double), 0), 0)')} as recall,
       {q('coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0)')} as f1,
       tn + fp + fn + tp as n, tp + fn as n_positive
from conf""")
def brier_confusion(spark, d):
    return metrics.threshold_metrics(pseudo_scored(spark, d), ["model"])


_BEST = """
f1s as (select *, tp / cast(tp + fp as double) as pr, tp / cast(p as double) as re from cv),
best as (select *, row_number() over (partition by model
             order by 2 * pr * re / (pr + re + 1e-12) desc, proba) as rn from f1s)
"""


@query("best_f1_threshold", f"""
with {_SC}, {_CURVE}, {_BEST}
select model, {q('proba')} as best_f1_threshold, {q('pr')} as precision_at_best_f1,
       {q('re')} as recall_at_best_f1,
       {q('2 * tp / cast(2 * tp + fp + p - tp as double)')} as f1_at_best_f1_threshold
from best where rn = 1""")
def best_f1_threshold(spark, d):
    return metrics.best_f1(metrics.score_table(pseudo_scored(spark, d), ["model"]), ["model"])


@query("calibration_bins", f"""
with {_SC},
edges as (select model, unnest(quantile_cont(proba, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) as e
          from sc group by model),
bn as (select sc.model, sc.proba, sc.target, (select count(*) from edges
         where edges.model = sc.model and edges.e < sc.proba) as bin from sc)
select model, cast(bin as integer) as bin, count(*) as n, {q('avg(proba)')} as mean_predicted,
       {q('avg(target)')} as observed_rate from bn group by model, bin""")
def calibration_bins(spark, d):
    return metrics.calibration(pseudo_scored(spark, d), ["model"])


@query("roc_points", f"""
with {_SC}, {_CURVE}
select model, {q('proba')} as threshold, {q('fp / cast(n as double)')} as fpr,
       {q('tp / cast(p as double)')} as tpr from cv""")
def roc_points(spark, d):
    return metrics.roc_points(metrics.score_table(pseudo_scored(spark, d), ["model"]), ["model"])


@query("pr_points", f"""
with {_SC}, {_CURVE}
select model, {q('proba')} as threshold, {q('tp / cast(p as double)')} as recall,
       {q('tp / cast(tp + fp as double)')} as precision from cv""")
def pr_points(spark, d):
    return metrics.pr_points(metrics.score_table(pseudo_scored(spark, d), ["model"]), ["model"])


def _by_group_sql(source: str, keys: str) -> str:
    on = " and ".join(f"a.{k.strip()} = rk.{k.strip()}" for k in keys.split(","))
    return f"""
{S.score_curve(source, keys)},
agg as (select {keys}, count(*) as cnt, cast(sum(target) as bigint) as positives,
          avg(target) as positive_rate, avg(proba) as mean_predicted,
          avg(pow(proba - target, 2)) as brier from {source} group by {keys}),
bg as (select a.*, rk.roc_auc, rk.pr_auc from agg a join rk on {on})
"""


@query("metrics_by_horizon", f"""
with {_SC}, {_by_group_sql('sc', 'model, horizon_day')}
select model, horizon_day, cnt as n, positives, {q('positive_rate')} as positive_rate,
       {q('mean_predicted')} as mean_predicted, {q('brier')} as brier,
       {q('roc_auc')} as roc_auc, {q('pr_auc')} as pr_auc from bg""")
def metrics_by_horizon(spark, d):
    return metrics.by_group(pseudo_scored(spark, d), ["model", "horizon_day"])


_RANKED = f"""
{_SC}, {_CURVE}, {_CONFUSION}, {_BEST},
ranked as (
  select conf.model, rk.roc_auc, rk.pr_auc,
         coalesce(conf.tp / nullif(cast(conf.tp + conf.fp as double), 0), 0) as precision,
         coalesce(conf.tp / nullif(cast(conf.tp + conf.fn as double), 0), 0) as recall,
         conf.brier_score, best.proba as best_f1_threshold,
         cast(row_number() over (order by rk.roc_auc desc, conf.model) as integer) as rank
  from conf join rk on rk.model = conf.model join best on best.model = conf.model and best.rn = 1)
"""


@query("model_ranking", f"""
with {_RANKED}
select model, rank, {q('roc_auc')} as roc_auc, {q('pr_auc')} as pr_auc,
       {q('precision')} as precision, {q('recall')} as recall,
       {q('brier_score')} as brier_score, {q('best_f1_threshold')} as best_f1_threshold
from ranked""")
def model_ranking(spark, d):
    return metrics.compare_models(pseudo_scored(spark, d)).select(
        "model", "rank", "roc_auc", "pr_auc", "precision", "recall", "brier_score",
        "best_f1_threshold")


@query("best_model", f"""
with {_RANKED}
select a.model as best_model, {q('a.roc_auc')} as roc_auc,
       printf('%s ranks first by test ROC-AUC (%.4f); next is %s (%.4f)',
              a.model, a.roc_auc, b.model, b.roc_auc) as justification
from ranked a, ranked b where a.rank = 1 and b.rank = 2""")
def best_model(spark, d):
    return metrics.justify_best(metrics.compare_models(pseudo_scored(spark, d)))


# --- backtest -------------------------------------------------------------------------

_SCO = S.scored(S.ORDERS)
_CUTS = """
el as (select day from (select distinct day from mx) x
       where day >= (select min(day) from mx) + 180),
cuts as (select day as cutoff from el
         order by md5(concat('42:', cast(day as varchar))) limit 10)
"""
_BT = f"{_SCO}, {_CUTS}, bt as (select sc.day as cutoff, sc.* exclude (day, model) from sc " \
      "join cuts on cuts.cutoff = sc.day where sc.model = 'C')"


def backtest_scored(spark, d):
    """Forecast rows at the chosen cutoffs with pseudo-score C."""
    matrix = stored_matrix(spark, d)
    cutoffs = backtest.choose_cutoffs(matrix, CFG)
    rows = with_pseudo_scores(matrix).where("model = 'C'")
    chosen = rows.withColumnRenamed("day", "cutoff").join(F.broadcast(cutoffs), "cutoff")
    return materialize(chosen, "scored")


@query("cutoff_selection", f"with {_MX_O}, {_CUTS} select cutoff from cuts")
def cutoff_selection(spark, d):
    return backtest.choose_cutoffs(stored_matrix(spark, d), CFG)


@query("leak_free_training", f"""
with {_MX_O}
select horizon_day, count(*) as rows, max(day) as last_day, cast(sum(target) as bigint) as positives,
       max(day + horizon_day) as last_known
from mx where day + horizon_day <= date '1998-06-15' group by horizon_day""")
def leak_free_training(spark, d):
    cutoff = F.lit("1998-06-15").cast("date")
    train = splits.training_rows(stored_matrix(spark, d), cutoff)
    return splits.assert_leak_free(train, cutoff).groupBy("horizon_day").agg(
        F.count(F.lit(1)).alias("rows"), F.max("day").alias("last_day"),
        F.sum("target").cast("long").alias("positives"),
        F.max(F.date_add("day", F.col("horizon_day"))).alias("last_known"))


@query("backtest_training_stats", f"""
with {_MX_O}, {_CUTS}
select cutoff, count(*) as train_rows, {q('avg(target)')} as train_positive_rate
from cuts join mx on mx.day + mx.horizon_day <= cutoff group by cutoff""")
def backtest_training_stats(spark, d):
    matrix = stored_matrix(spark, d)
    return backtest.training_stats(matrix, backtest.choose_cutoffs(matrix, CFG), CFG)


_TOP = """
tops as (select *, cast(row_number() over (partition by cutoff, horizon_day
             order by proba desc, cell_lat, cell_lon) as integer) as rank from bt)
"""


@query("topn_cells", f"""
with {_BT}, {_TOP}
select cutoff, horizon_day, cell_lat, cell_lon, target, {q('proba')} as proba, rank
from tops where rank <= 10""")
def topn_cells(spark, d):
    return backtest.top_cells(backtest_scored(spark, d).drop("model"), CFG)


@query("precision_at_n", f"""
with {_BT}, {_TOP}
select cutoff, horizon_day, cast(sum(target) as bigint) as hits_in_top,
       {q('sum(target) / cast(10 as double)')} as precision_at_top
from tops where rank <= 10 group by cutoff, horizon_day""")
def precision_at_n(spark, d):
    return backtest.per_horizon(backtest_scored(spark, d), CFG).select(
        "cutoff", "horizon_day", "hits_in_top", "precision_at_top")


_PER_HORIZON = f"""
{_BT}, {_TOP}, {_by_group_sql('bt', 'cutoff, horizon_day')},
ph as (
  select bg.*, t.hits, t.hits / cast(10 as double) as prec from bg join (
    select cutoff, horizon_day, cast(sum(target) as bigint) as hits from tops
    where rank <= 10 group by cutoff, horizon_day) t
  on t.cutoff = bg.cutoff and t.horizon_day = bg.horizon_day)
"""


@query("backtest_per_horizon", f"""
with {_PER_HORIZON}
select cutoff, horizon_day, cnt as n, positives, {q('positive_rate')} as positive_rate,
       {q('mean_predicted')} as mean_predicted,
       {q('case when roc_auc is not null then brier end')} as brier,
       {q('roc_auc')} as roc_auc, {q('pr_auc')} as pr_auc, hits as hits_in_top,
       {q('prec')} as precision_at_top from ph""")
def backtest_per_horizon(spark, d):
    return backtest.per_horizon(backtest_scored(spark, d), CFG)


@query("skill_by_horizon", f"""
with {_PER_HORIZON}
select horizon_day, {q('avg(positive_rate)')} as positive_rate,
       {q('avg(mean_predicted)')} as mean_predicted, {q('avg(roc_auc)')} as roc_auc,
       {q('avg(pr_auc)')} as pr_auc, {q('avg(prec)')} as precision_at_top
from ph group by horizon_day""")
def skill_by_horizon(spark, d):
    return backtest.skill_by_horizon(backtest.per_horizon(backtest_scored(spark, d), CFG))


@query("backtest_per_date", f"""
with {_BT}, {_by_group_sql('bt', 'cutoff')}
select cutoff, cnt as n, positives, {q('positive_rate')} as positive_rate,
       {q('mean_predicted')} as mean_predicted,
       {q('case when roc_auc is not null then brier end')} as brier,
       {q('roc_auc')} as roc_auc, {q('pr_auc')} as pr_auc from bg""")
def backtest_per_date(spark, d):
    return backtest.per_date(backtest_scored(spark, d))


@query("backtest_summary", f"""
with {_PER_HORIZON},
pd as (
  select d.*, k.roc_auc, k.pr_auc from (
    select cutoff, avg(target) as positive_rate, avg(pow(proba - target, 2)) as brier
    from bt group by cutoff) d
  join (select cutoff,
          case when max(p) > 0 and max(n) > 0
               then sum(pos * (n - fp + neg / cast(2 as double))) / (max(p) * max(n)) end as roc_auc,
          case when max(p) > 0 and max(n) > 0
               then sum(pos * tp / cast(tp + fp as double)) / max(p) end as pr_auc
        from (select *, sum(pos) over (partition by cutoff order by proba desc) as tp,
                sum(neg) over (partition by cutoff order by proba desc) as fp,
                sum(pos) over (partition by cutoff) as p, sum(neg) over (partition by cutoff) as n
              from (select cutoff, proba, sum(target) as pos, sum(1 - target) as neg
                    from bt group by cutoff, proba) x) y group by cutoff) k on k.cutoff = d.cutoff)
select count(*) as n_cutoffs, {q('avg(roc_auc)')} as mean_roc_auc,
       {q('stddev_samp(roc_auc)')} as std_roc_auc, {q('min(roc_auc)')} as min_roc_auc,
       {q('max(roc_auc)')} as max_roc_auc, {q('avg(pr_auc)')} as mean_pr_auc,
       {q('avg(positive_rate)')} as mean_actual_rate,
       {q('avg(case when roc_auc is not null then brier end)')} as mean_brier,
       {q('(select avg(prec) from ph)')} as mean_precision_at_top from pd""")
def backtest_summary(spark, d):
    scored = backtest_scored(spark, d)
    return backtest.summary(backtest.per_horizon(scored, CFG), backtest.per_date(scored))


# --- serving ------------------------------------------------------------------------

_SNAP = f"""
{S.features(S.EVENTS_CLEAN)}, snap as (select * from feat where day = (select max(day) from ev))
"""


@query("live_snapshot", f"""
with {_SNAP} select day, {', '.join(f'{q(c)} as {c}' for c in ['cell_lat', 'cell_lon'] + S.FEATURE_NAMES)}
from snap""")
def live_snapshot(spark, d):
    return features.snapshot(clean_events(spark, d), CFG)


_B = "greatest(coalesce(b_value_90d, b_value_365d, cast(1 as double)), cast(0.3 as double))"


@query("magnitude_readout", f"""
with {_SNAP} select cell_lat, cell_lon,
  {q(f'{S.THRESHOLD} - log10(cast(0.5 as double)) / {_B}')} as mag_likely,
  {q(f'{S.THRESHOLD} - log10(cast(0.1 as double)) / {_B}')} as mag_severe from snap""")
def magnitude_readout(spark, d):
    rows = forecast.with_magnitudes(features.snapshot(clean_events(spark, d), CFG), CFG)
    return rows.select("cell_lat", "cell_lon", "mag_likely", "mag_severe")


def pseudo_forecast(spark, d):
    """A forecast whose single model grows with horizon and recent activity."""
    def score(rows):
        x = F.col("decay_count_hl3d") * F.col("horizon_day")
        return rows.withColumn("proba_gbt", F.round(x / (20 + x) + 1e-9, 6))
    return forecast.forecast(clean_events(spark, d), score, ["adaboost_dt", "gbt"], CFG)


_FC = f"""
{_SNAP},
fc as (select day as asof_date, h.h as horizon_day, snap.*,
         round(decay_count_hl3d * h.h / (20 + decay_count_hl3d * h.h) + 1e-9, 6) as proba_gbt
       from snap, (select cast(unnest(generate_series(1, {S.HORIZON})) as integer) as h) h)
"""


@query("forecast_table", f"""
with {_FC}
select asof_date, horizon_day, cell_lat, cell_lon,
  {', '.join(f'{q(c)} as {c}' for c in forecast.DISPLAY_COLUMNS)},
  cast(null as double) as proba_adaboost_dt, {q('proba_gbt')} as proba_gbt,
  {q(f'{S.THRESHOLD} - log10(cast(0.5 as double)) / {_B}')} as mag_likely,
  {q(f'{S.THRESHOLD} - log10(cast(0.1 as double)) / {_B}')} as mag_severe
from fc""")
def forecast_table(spark, d):
    return pseudo_forecast(spark, d)


_STOPS = ((145, 207, 96), (254, 224, 139), (252, 141, 89), (215, 48, 39))


def _channel(k):
    start = "case seg " + " ".join(f"when {i} then {s[k]}" for i, s in enumerate(_STOPS)) + " end"
    end = "case seg + 1 " + " ".join(f"when {i} then {s[k]}" for i, s in enumerate(_STOPS)) + " end"
    return f"cast(floor({start} + (({end}) - ({start})) * (t * 3 - seg) + 0.5) as integer)"


@query("alerts", f"""
with {_FC},
al as (select *, greatest(cast(0 as double), least(cast(1 as double),
         (proba_gbt - cast(0.3 as double)) / (cast(1 as double) - cast(0.3 as double)))) as t
       from fc where horizon_day = 7 and proba_gbt > cast(0.3 as double)),
sg as (select *, cast(least(2, floor(t * 3)) as integer) as seg from al)
select cell_lat, cell_lon, asof_date + 7 as horizon_end, {q('proba_gbt')} as proba_gbt,
       'rgb(' || {_channel(0)} || ',' || {_channel(1)} || ',' || {_channel(2)} || ')' as risk_color,
       {q('5 + 9 * t')} as risk_radius from sg""")
def alerts(spark, d):
    week = forecast.horizon_slice(pseudo_forecast(spark, d), 9, CFG)
    return forecast.alerts(week, "proba_gbt", CFG).select(
        "cell_lat", "cell_lon", "horizon_end", "proba_gbt", "risk_color", "risk_radius")


@query("recent_significant", f"""
select strftime(time, '%Y-%m-%d %H:%M:%S.%f') as time, latitude, longitude, depth, {q('mag')} as mag
from ({S.EVENTS_CLEAN}) c
where time >= (select max(time) from ({S.EVENTS_CLEAN}) x) - interval 10 day and mag >= 3.5""")
def recent_significant(spark, d):
    return feed.recent_significant(clean_events(spark, d), days=10, min_mag=3.5)


@query("gr_exceedance", f"""
select id, {q('log10(pow(cast(10 as double), 1.5 * mag + 4.8))')} as log_energy,
       {q('pow(cast(10 as double), -(cast(0.9 as double)) * (mag - 2.0))')} as exceedance,
       {q('2.0 - log10(cast(0.25 as double)) / (0.5 + depth / 300)')} as quantile_mag,
       {q('sin(2 * pi() * dayofyear(time) / cast(365.25 as double))')} as doy_sin
from ({S.EVENTS_CLEAN}) c""")
def gr_exceedance(spark, d):
    mag = F.col("mag")
    return clean_events(spark, d).select(
        "id", F.log10(fn.energy_joules(mag)).alias("log_energy"),
        fn.exceedance_prob(F.lit(0.9), F.lit(2.0), mag).alias("exceedance"),
        fn.magnitude_quantile(0.5 + F.col("depth") / 300, 2.0, 0.25).alias("quantile_mag"),
        F.sin(fn.season_angle(F.to_date("time"))).alias("doy_sin"))
