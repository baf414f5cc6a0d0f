"""The same queries as SQL text over the benchmark tables, for the cross-engine check."""

from __future__ import annotations

from itertools import permutations

from tidewright.plans.adapters import BRAND_PARAMS
from tidewright.schemas import SWELL_MEASURES

M = ["wave_height", "dominant_period", "average_period", "mean_wave_direction"]
S = ["wvht", "dpd", "apd", "mwd"]
STD = [f"{s}_monthly_std" for s in S]

OBS = """obs as (
  select cast(l_suppkey as varchar) as station_id, l_shipdate as datetime,
    case when l_returnflag = 'R' then null else l_quantity end as wave_height,
    l_discount * 100 as dominant_period, l_tax * 100 as average_period,
    l_extendedprice % 360 as mean_wave_direction,
    l_linenumber % 3 as src, l_orderkey, l_linenumber, l_partkey
  from lineitem)"""

OBS_SRC = (
    OBS
    + """, obs_src as (
  select * replace (
    case when src <> 0 then dominant_period end as dominant_period,
    case when src <> 2 then average_period end as average_period,
    case when src <> 2 then mean_wave_direction end as mean_wave_direction)
  from obs)"""
)

EV = """ev as (
  select cast(user_id as varchar) as station_id, ts as datetime, value as wave_height,
    case when event_id % 7 <> 0 then cast(event_id % 20 as double) end as dominant_period,
    cast(event_id % 13 as double) as average_period,
    cast(event_id % 360 as double) as mean_wave_direction, event_id
  from events)"""

LANDED = EV.replace("cast(user_id as varchar)", "cast(user_id % 97 as varchar)")

ST = """st as (
  select cast(s_suppkey as varchar) as station_id,
    cast(s_suppkey * 37 % 180 - 90 as double) as latitude,
    cast(s_suppkey * 73 % 360 - 180 as double) as longitude,
    s_acctbal > 0 as met
  from supplier)"""

GRID = """grid as (
  select p_brand as param, case when p_brand <> 'Brand#11' then 'm' end as units,
    p_partkey as grid_idx, cast(p_partkey % 45 * 4 - 90 as double) as lat,
    cast(p_partkey * 7 % 90 * 4 - 180 as double) as lon,
    case when p_size = 1 then null else nullif(p_retailprice, 9999) end as value
  from part)"""

SPOT = """spot as (
  select n_name as name, cast(n_regionkey as varchar) as country,
    cast(n_nationkey * 7 % 180 - 90 as double) as lat,
    cast(n_nationkey * 14 % 360 - 180 as double) as lng
  from nation)"""

UNTIDY = """untidy as (
  select case when o_custkey % 20 > 0 then cast(o_custkey % 20 as varchar) end as station_id,
    case when o_orderkey % 50 > 0 then cast(date_trunc('month', o_orderdate) as timestamp) end as datetime,
    cast(o_orderkey as double) as wave_height, case when o_orderkey % 11 > 0 then o_totalprice end as dominant_period,
    cast(o_custkey as double) as average_period, cast(o_orderkey % 360 as double) as mean_wave_direction
  from orders)"""
UNTIDY_ORDER = ", ".join(f"{m} nulls first" for m in M)

REGIMES = """regimes as (
  select cast(o_custkey % 50 as varchar) as station_id, o_orderkey, p,
    p * 10 + o_totalprice % 1 as wave_height, p * 7 % 5 * 10 + (o_custkey % 10) / 10.0 as dominant_period,
    p * 3 % 5 * 10 + (o_orderkey % 10) / 10.0 as average_period, p * 4 % 5 * 10 + (o_orderkey % 7) / 7.0 as mean_wave_direction
  from (select *, cast(substr(o_orderpriority, 1, 1) as int) as p from orders) x)"""

LOCATED = f"{OBS}, {ST}, located as (select obs.*, latitude, longitude from obs join st using (station_id))"


def _first(order: str, c: str) -> str:
    return f"arg_min({c}, row({order})) filter (where {c} is not null) as {c}"


ROW_ORDER = "src, l_orderkey, l_linenumber, l_partkey"
MERGED = (
    f"{OBS}, merged as (select station_id, datetime, "
    + ", ".join(_first(ROW_ORDER, c) for c in M)
    + " from obs group by station_id, datetime)"
)
TABLE = f"{MERGED}, {ST}, obs_table as (select merged.*, latitude, longitude from merged join st using (station_id))"

NEAREST = f"""{GRID}, {SPOT}, pairs as (
  select param, units, grid_idx, value, name, country, spot.lat as spot_lat, spot.lng as spot_lng,
    (grid.lat - spot.lat) * (grid.lat - spot.lat)
    + (grid.lon - spot.lng) * (grid.lon - spot.lng) as d2
  from grid, spot), nearest as (
  select param, units, name, country, spot_lat, spot_lng,
    arg_min(grid_idx, row(d2, grid_idx)) as grid_idx, min(d2) as dist2,
    arg_min_null(value, row(d2, grid_idx)) as value
  from pairs group by 1, 2, 3, 4, 5, 6)"""

def _unit(lat: str, lon: str) -> str:
    parts = (f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))")
    return ", ".join(f"round({p} * 1e9) / 1e9 as {n}" for p, n in zip(parts, "xyz"))


MONTH = "cast(date_trunc('month', datetime) as timestamp)"


def _trends() -> str:
    x = STD
    cov = ", ".join(
        f"covar_samp({x[i]}, {x[j]}) as c{i}{j}" for i in range(4) for j in range(4)
    )
    step = ", ".join(
        " + ".join(f"c{i}{j} * v{j}" for j in range(4)) + f" as w{i}" for i in range(4)
    )
    norm = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in range(4)) + ")"
    biggest = "greatest(" + ", ".join(f"abs(v{i})" for i in range(4)) + ")"
    sign = "case " + " ".join(f"when abs(v{i}) = {biggest} then sign(v{i})" for i in range(4)) + " end"
    score = " + ".join(f"v{i} * sgn * ({x[i]} - m{i})" for i in range(4))
    complete = " and ".join(f"{c} is not null" for c in x)
    return f"""{LOCATED},
monthly as (
  select station_id, {MONTH} as month, {", ".join(f"stddev_samp({m}) as {s}" for m, s in zip(M, x))}
  from located group by 1, 2),
places as (
  select station_id, arg_min(latitude, datetime) as latitude, arg_min(longitude, datetime) as longitude
  from located group by 1),
moments as (
  select {", ".join(f"avg({x[i]}) as m{i}" for i in range(4))}, {cov} from monthly where {complete}),
power as (
  select 0 as i, 0.5::double as v0, 0.5::double as v1, 0.5::double as v2, 0.5::double as v3
  union all
  select i + 1, {", ".join(f"w{i} / {norm}" for i in range(4))}
  from (select i, {step} from power, moments where i < 80) s),
direction as (select *, {sign} as sgn from power where i = 80),
scored as (
  select monthly.*, case when {complete} then {score} end as consistency_score
  from monthly, direction, moments),
edges as (
  select quantile_cont(consistency_score, [1.0/3, 2.0/3]) as e,
    min(consistency_score) < max(consistency_score) as spread from scored),
trends as (
  select scored.*, latitude, longitude,
    case when consistency_score is null then 'Unknown, not enough data'
      when not spread then null
      when consistency_score <= e[1] then 'High Consistency'
      when consistency_score <= e[2] then 'Medium Consistency'
      else 'Low Consistency' end as consistency_label
  from scored left join places using (station_id), edges)"""


TRENDS = _trends()
TRENDS_OUT = (
    "station_id, month, "
    + ", ".join(f"round({c}, 6) as {c}" for c in STD)
    + ", latitude, longitude, round(consistency_score, 4) as consistency_score, consistency_label"
)


def _scaled_scores() -> str:
    """Scores by the first direction of the correlations, from squaring their matrix again and again."""
    x, n = STD, range(4)
    cells = [(i, j) for i in n for j in n]
    complete = " and ".join(f"{c} is not null" for c in x)
    corr = ", ".join(f"corr({x[i]}, {x[j]}) as c{i}{j}" for i, j in cells)
    square = ", ".join("(" + " + ".join(f"c{i}{k} * c{k}{j}" for k in n) + f") / t as c{i}{j}" for i, j in cells)
    trace = " + ".join(f"c{i}{k} * c{k}{i}" for i in n for k in n)
    norm = "sqrt(" + " + ".join(f"c{i}0 * c{i}0" for i in n) + ")"
    biggest = "greatest(" + ", ".join(f"abs(v{i})" for i in n) + ")"
    sign = "case " + " ".join(f"when abs(v{i}) = {biggest} then sign(v{i})" for i in n) + " end"
    score = " + ".join(f"v{i} * sgn * ({x[i]} - m{i}) / d{i}" for i in n)
    return f"""{LOCATED},
monthly as (
  select station_id, {MONTH} as month, {", ".join(f"stddev_samp({m}) as {s}" for m, s in zip(M, x))}
  from located group by 1, 2),
moments as (
  select {", ".join(f"avg({x[i]}) as m{i}, stddev_samp({x[i]}) as d{i}" for i in n)} from monthly where {complete}),
power as (
  select 0 as step, {corr} from monthly where {complete}
  union all
  select step + 1, {square} from (select *, {trace} as t from power where step < 20) s),
direction as (
  select *, {sign} as sgn from (select {", ".join(f"c{i}0 / {norm} as v{i}" for i in n)} from power where step = 20) s),
scored as (
  select monthly.*, case when {complete} then {score} end as consistency_score from monthly, direction, moments)"""


def _euclidean() -> str:
    """Silhouettes from the distance sums of each point to the ten groups that all clusterings are made of."""
    z = ", ".join(f"({m} - avg({m}) over ()) / stddev_pop({m}) over () as x{i}" for i, m in enumerate(M))
    gap = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(4))
    label = {"cluster": "{}p - 1", **{f"by_{k}": f"({{0}}p * 3 + {{0}}odd) % {k}" for k in range(3, 8)}}
    parts = " union all ".join(
        f"""select '{name}' as clustering, id, {own.format("")} as own, {own.format("other_")} as other, total, n from sums"""
        for name, own in label.items()
    )
    return f"""{REGIMES}, z as (select o_orderkey as id, p, o_orderkey % 2 as odd, {z} from regimes),
      s as (select * from z order by md5(cast(id as varchar)), id limit 60000),
      sums as (select a.id, a.p, a.odd, b.p as other_p, b.odd as other_odd, sum(sqrt({gap})) as total, count(*) as n
        from s a, s b group by all),
      parts as ({parts}),
      d as (select clustering, id, own, other, sum(total) as total, sum(n) as n from parts group by all),
      ab as (select clustering, id, max(case when own = other then n end) as mine,
        max(case when own = other then total / (n - 1) end) as a, min(case when own <> other then total / n end) as b from d group by 1, 2)
      select clustering, round(avg(case when mine > 1 then (b - a) / greatest(a, b) else 0 end), 6) as silhouette from ab group by 1"""


def _det(rows: list[list[str]]) -> str:
    """Determinant as a sum over permutations."""
    n, terms = len(rows), []
    for p in permutations(range(n)):
        odd = sum(p[i] > p[j] for i in range(n) for j in range(i + 1, n)) % 2
        terms.append(("-" if odd else "+") + " * ".join(rows[i][p[i]] for i in range(n)))
    return "(" + " ".join(terms) + ")"


def _forecast(partition: str, order: str) -> str:
    lags = [f"{m}_lag1" for m in M]
    window = f"over ({partition} order by {order})"
    matrix = [[f"s{min(i, j)}{max(i, j)}" for j in range(4)] for i in range(4)]
    right = [f"t{i}" for i in range(4)]
    betas = []
    for k in range(4):
        replaced = [[right[i] if j == k else matrix[i][j] for j in range(4)] for i in range(4)]
        betas.append(f"{_det(replaced)} / {_det(matrix)} as b{k}")
    sums = ", ".join(
        f"covar_pop({lags[i]}, {lags[j]}) as s{i}{j}" for i in range(4) for j in range(i, 4)
    )
    return f"""{MERGED},
lagged as (select *, {", ".join(f"lag({m}) {window} as {n}" for m, n in zip(M, lags))} from merged),
feats as (
  select *, cast('0x' || substr(md5(station_id || '|' || strftime(datetime, '%Y%m%d%H%M%S')), 1, 8) as bigint)
    % 1000 < 200 as is_test
  from lagged where {" and ".join(f"{c} is not null" for c in M + lags)}),
sums as (
  select {sums}, {", ".join(f"covar_pop({lags[i]}, wave_height) as t{i}" for i in range(4))},
    avg(wave_height) as my, {", ".join(f"avg({lags[i]}) as m{i}" for i in range(4))}
  from feats where not is_test),
slopes as (select *, {", ".join(betas)} from sums),
model as (select *, my - {" - ".join(f"b{i} * m{i}" for i in range(4))} as b from slopes)"""


def _line(columns: str) -> str:
    return f"with {EV} select event_id, station_id, date_trunc('minute', datetime) as datetime, {columns} from ev"


def _landing() -> str:
    return f"""{LANDED}, files as (
  select station_id, date_trunc('minute', datetime) as datetime, event_id % 3 as src, event_id,
    wave_height, case when event_id % 3 <> 0 then dominant_period end as dominant_period,
    case when event_id % 3 <> 2 then average_period end as average_period,
    case when event_id % 3 <> 2 then mean_wave_direction end as mean_wave_direction
  from ev), landed as (
  select station_id, datetime, cast(null as double) as latitude, cast(null as double) as longitude,
    {", ".join(_first("src, event_id", c) for c in M)}
  from files group by 1, 2)"""


def _delivery(name: str, where: str, height: str, period: str) -> str:
    """The merged rows of landed files that hold the events in `where`."""
    return f"""{LANDED}, {name} as (
  select station_id, datetime, {", ".join(_first("src, event_id", c) for c in M)}
  from (select station_id, date_trunc('minute', datetime) as datetime, event_id % 3 as src, event_id, {height} as wave_height,
      case when event_id % 3 <> 0 then dominant_period end as dominant_period,
      case when event_id % 3 <> 2 then {period} end as average_period,
      case when event_id % 3 <> 2 then mean_wave_direction end as mean_wave_direction
    from ev where {where}) x group by 1, 2)"""


def _swell_columns(value: str, units: str) -> str:
    brand = {m: b for b, m in BRAND_PARAMS.items()}
    return ", ".join(
        f"{value.format(b=brand[m])} as {m}, coalesce({units.format(b=brand[m])}, 'unknown') as {m}_units"
        for m in SWELL_MEASURES
    )


_SWELL_TAIL = "date '2024-10-22' as date, '0000' as time, 0 as forecast_hours"
_SWELL_ROWS = f"""with {NEAREST}
  select name as surf_spot_name, country, spot_lat as lat, spot_lng as lng,
    {_swell_columns("case when param = '{b}' then value end", "case when param = '{b}' then units end")},
    {_SWELL_TAIL} from nearest"""

_ASSET_META = "timestamp '2024-12-15 02:00:00' as _updated_at"


def all_oracles() -> dict[str, str]:
    by_station = _forecast("partition by station_id", "datetime")
    all_in_one = _forecast("", "datetime, station_id")

    def predict(terms) -> str:
        return "b + " + " + ".join(terms)

    return {
        "merge_first_nonnull": f"with {OBS_SRC} select station_id, datetime, "
        + ", ".join(_first(ROW_ORDER, c) for c in M)
        + " from obs_src group by station_id, datetime",
        "union_sources": f"with {OBS_SRC} select l_orderkey, src, station_id, datetime, {', '.join(M)} from obs_src",
        "single_frame_first": f"with {EV} select station_id, cast(date_trunc('day', datetime) as timestamp) as datetime, "
        + ", ".join(_first("event_id", c) for c in M)
        + " from ev group by 1, 2",
        "parse_txt_lines": _line(
            "wave_height as WVHT, dominant_period as DPD, average_period as APD, "
            "mean_wave_direction as MWD, cast(null as double) as TIDE"
        ),
        "parse_spec_lines": _line(
            "wave_height as WVHT, average_period as APD, mean_wave_direction as MWD, "
            "cast(null as varchar) as STEEPNESS"
        ),
        "parse_drift_lines": _line(
            "cast(null as double) as LAT, cast(null as double) as LON, wave_height as WVHT, dominant_period as DPD"
        ),
        "landing_scan": f"with {_landing()} select * from landed",
        "stream_ingest": f"""with {_delivery("first", "event_id % 2 = 0", "case when event_id % 4 > 0 then wave_height end", "average_period")},
            {_delivery("second", "true", "wave_height", "average_period + 100").removeprefix(f"{LANDED}, ")}
            select station_id, datetime, cast(null as double) as latitude, cast(null as double) as longitude,
            {", ".join(f"coalesce(first.{c}, second.{c}) as {c}" for c in M)}
            from second left join first using (station_id, datetime)""",
        "stream_keyed": f"""with {LANDED}, in_time as (
            select * from ev where not (event_id % 10 = 0 and datetime < timestamp '2024-01-10')), late as (
            select distinct station_id, date_trunc('minute', datetime) from ev where event_id % 10 = 0 and datetime < timestamp '2024-01-10'),
            {_landing().removeprefix(f"{LANDED}, ").replace("from ev", "from in_time")}
            select landed.*, (select count(*) from late) as late_keys from landed
            where datetime <= (select date_trunc('minute', max(datetime)) from ev) - interval 2 days""",
        "ingest_report": f"""with {EV} select station_id, count(*) filter (where event_id % 11 <> 0) as rows_ok,
            count(*) filter (where event_id % 11 = 0) as rows_failed,
            case when count(*) filter (where event_id % 11 <> 0) > 0 then 'processed' else 'empty' end as status
            from ev group by 1""",
        "ingest_report_files": f"""with {LANDED}, r as (
            select station_id, cast(station_id as bigint) % 7 = 0 as silent, cast(station_id as bigint) % 5 = 0 as odd, count(*) as n from ev group by 1)
            select station_id, case when silent then 0 else n end as rows_ok, odd::bigint as rows_failed,
            (silent::int + odd::int)::bigint as files_failed, case when silent then 'failed' else 'processed' end as status from r""",
        "station_catalogue": f"with {ST} select station_id, latitude, longitude from st where met",
        "spot_scan": f"with {SPOT} select * from spot",
        "observation_scan": f"with {LOCATED} select station_id, latitude, longitude, datetime, "
        + ", ".join(f"{m} as {s}" for m, s in zip(M, S))
        + " from located",
        "ordered_series": f"with {EV} select datetime, "
        + ", ".join(f"{m} as {s}" for m, s in zip(M, S))
        + " from ev order by datetime",
        "enrich_coordinates": f"with {LOCATED} select l_orderkey, l_linenumber, station_id, datetime, "
        f"latitude, longitude, {', '.join(M)} from located",
        "station_coverage": f"""with {ST} select station_id,
            case when met then latitude else latitude + 0.5 end as latitude, longitude,
            case when met then 'with_met' else 'without_met' end as coverage from st""",
        "distinct_stations": f"with {OBS} select distinct station_id from obs",
        "first_stations": f"with {OBS} select distinct station_id from obs order by station_id limit 10",
        "stations_all": f"with {ST} select station_id, latitude, longitude from st",
        "station_upsert": f"""with {ST} select station_id, latitude + cast(station_id as int) % 2 as latitude, longitude,
            case when met then timestamp '2024-01-01' else timestamp '2024-02-01' end as created_at,
            case when met and cast(station_id as int) % 2 = 0 then timestamp '2024-01-01'
              else timestamp '2024-02-01' end as updated_at from st""",
        "station_insert_if_absent": f"""with {ST} select station_id, latitude, longitude,
            case when met then timestamp '2024-01-01' else timestamp '2024-02-01' end as created_at,
            case when met then timestamp '2024-01-01' else timestamp '2024-02-01' end as updated_at from st""",
        "quality_metrics": f"""with {OBS} select count(*) as record_count, count(distinct station_id) as stations_count,
            min(datetime) as min_datetime, max(datetime) as max_datetime,
            round((avg(case when wave_height is null then 1 else 0 end)
              + avg(case when dominant_period is null then 1 else 0 end)
              + avg(case when mean_wave_direction is null then 1 else 0 end)) / 3 * 100, 6) as missing_data_pct
            from obs""",
        "row_validation": f"""with {LOCATED} select station_id, datetime,
            case when l_linenumber <> 2 then latitude end as latitude, longitude,
            wave_height, dominant_period, average_period,
            case when l_linenumber <> 3 then mean_wave_direction end as mean_wave_direction,
            l_linenumber <> 2 as accepted from located""",
        "row_validation_reasons": f"""with {LOCATED}, f as (
            select *, l_linenumber = 2 as no_lat, l_orderkey % 5 = 0 as odd_lon, l_linenumber = 3 as odd_dir from located),
            r as (select *, case when no_lat or odd_lon then 'rejected' else 'accepted' end as verdict, unnest(
              case when not no_lat and not odd_lon and not odd_dir then [null]
              else [x for x in [case when no_lat then ['latitude', 'missing'] end, case when odd_lon then ['longitude', 'not a double'] end,
                case when odd_dir then ['mean_wave_direction', 'not a double'] end] if x is not null] end) as r,
              no_lat::int as a, odd_lon::int as b from f)
            select verdict, cast(case r[1] when 'latitude' then 0 when 'longitude' then a when 'mean_wave_direction' then a + b end as int) as place,
              r[1] as field, r[2] as reason, count(*) as n, count(*) filter (where not no_lat) as with_latitude,
              count(*) filter (where not odd_lon) as with_longitude, count(*) filter (where not odd_dir) as with_mean_wave_direction
            from r group by all""",
        "monthly_std": f"with {OBS} select station_id, {MONTH} as month, "
        + ", ".join(f"round(stddev_samp({m}), 6) as {s}" for m, s in zip(M, STD))
        + " from obs group by 1, 2",
        "station_location": f"with {LOCATED} select distinct station_id, {MONTH} as month, latitude, longitude from located",
        "consistency_labels": f"with recursive {TRENDS} select {TRENDS_OUT} from trends",
        "result_replace": f"with recursive {TRENDS} select {TRENDS_OUT} from trends",
        "consistency_feed": f"""with recursive {TRENDS} select station_id, month, latitude, longitude, consistency_label,
            round(consistency_score, 4) as consistency_score from trends
            where month between timestamp '1996-03-01' and timestamp '1997-10-01' and consistency_score is not null""",
        "consistency_map": f"""with recursive {TRENDS} select station_id, latitude, longitude, consistency_label,
            case consistency_label when 'High Consistency' then 'blue' when 'Medium Consistency' then 'orange'
              when 'Low Consistency' then 'red' when 'Unknown, not enough data' then 'gray' else 'black' end as colour
            from trends""",
        "consistency_popups": """select cast(o_custkey as varchar) as station_id,
            strftime(o_orderdate, '%Y-%m') as month,
            case when s >= 0.8 then '#ff0000' when s >= 0.6 then '#ffff00' when s >= 0.4 then '#00ff00'
              when s >= 0.2 then '#00ffff' else '#4169e1' end as colour,
            printf('%.2f', s) as score_text,
            (o_custkey % 90) || '.00' as latitude_text, (o_orderkey % 180) || '.00' as longitude_text
            from (select *, least(1.0, o_totalprice / 400000) as s from orders) x""",
        "consistency_finite": """select cast(o_orderkey as varchar) as station_id, cast(date_trunc('month', o_orderdate) as timestamp) as month,
            o_totalprice as consistency_score from orders where o_orderkey % 7 > 3
            and o_orderdate >= date '1996-03-01' and o_orderdate < date '1997-11-01'""",
        "consistency_scaled": f"with recursive {_scaled_scores()} select station_id, month, round(consistency_score, 4) as consistency_score from scored",
        "score_join": f"""with {OBS}, monthly as (
            select station_id, {MONTH} as month, {", ".join(f"stddev_samp({m}) as {s}" for m, s in zip(M, STD))}
            from obs group by 1, 2)
            select station_id, month, case when {" and ".join(f"{s} is not null" for s in STD)}
              then round(mwd_monthly_std, 6) end as consistency_score from monthly""",
        "tertile_scores": """with edges as (
            select quantile_cont(o_totalprice, [1.0/3, 2.0/3]) as e from orders)
            select o_orderkey, o_totalprice, case when o_totalprice <= e[1] then 'High Consistency'
              when o_totalprice <= e[2] then 'Medium Consistency' else 'Low Consistency' end as consistency_label
            from orders, edges""",
        "tertile_ties": """with s as (select o_orderkey,
              case when o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0 then (o_custkey % 19) / 7.0 end as score from orders),
            edges as (select quantile_cont(score, [1.0/3, 2.0/3]) as e from s)
            select o_orderkey, case when score <= e[1] then 'High Consistency' when score <= e[2] then 'Medium Consistency'
              when score is not null then 'Low Consistency' end as consistency_label from s, edges""",
        "wave_data_range": f"""with {EV} select station_id, datetime, {", ".join(M)} from ev
            where datetime between timestamp '2024-01-05' and timestamp '2024-01-20'""",
        "wave_data_station": f"""with {EV} select station_id, datetime, {", ".join(M)} from ev
            where datetime >= timestamp '2024-01-01' and datetime < timestamp '2024-02-01' and station_id = '42'""",
        "range_checks": """select '2024-01-05' as start_date, '2024-01-20' as end_date, count(*) as n, cast(null as varchar) as refused
            from events where ts between timestamp '2024-01-05' and timestamp '2024-01-20'
            union all values ('2024-01-20', '2024-01-05', null, 'the range 2024-01-20 to 2024-01-05 runs backwards'),
              ('2024-1-x', '2024-01-05', null, '''2024-1-x'' does not read as YYYY-MM-DD'),
              ('2023-01-01', '2024-01-02', null, '366 days asked for, 31 are allowed'),
              ('2024-12-20', '2025-01-02', null, '2025-01-02 has not begun yet')""",
        "last_day": f"""with {EV} select event_id, station_id, datetime, {", ".join(M)} from ev
            where datetime >= timestamp '2024-01-29 12:00:00'""",
        "nearest_grid_value": f"with {NEAREST} select * from nearest",
        "nearest_shared_grid": f"""with {GRID}, {SPOT} select param, name, country,
            spot_lat, spot_lng, arg_min(grid_idx, row(d2, grid_idx)) as grid_idx, min(d2) as dist2,
            arg_min_null(value, row(d2, grid_idx)) as value
            from (select f.param, grid_idx, value / parts as value, name, country,
              spot.lat as spot_lat, spot.lng as spot_lng,
              (grid.lat - spot.lat) * (grid.lat - spot.lat) + (grid.lon - spot.lng) * (grid.lon - spot.lng) as d2
              from grid, spot, (values ('full', 1), ('half', 2)) f(param, parts)) pairs group by 1, 2, 3, 4, 5""",
        "nearest_on_sphere": f"""with {GRID}, {SPOT}, sites as (
              select name, country, lat, lng from spot union all
              select name || ' edge', country, lat, case when cast(country as int) % 2 = 0 then 178.5 else -178.5 end from spot),
            g as (select grid_idx, value, {_unit("lat", "lon")} from grid), s as (select *, {_unit("lat", "lng")} from sites),
            pairs as (select grid_idx, value, name, country, s.lat as spot_lat, s.lng as spot_lng,
              (g.x - s.x) * (g.x - s.x) + (g.y - s.y) * (g.y - s.y) + (g.z - s.z) * (g.z - s.z) as d2 from g, s)
            select name, country, spot_lat, spot_lng, arg_min(grid_idx, row(d2, grid_idx)) as grid_idx,
              arg_min_null(value, row(d2, grid_idx)) as value, round(2 * 6371.0088 * asin(least(1, sqrt(min(d2)) / 2)), 6) as km
            from pairs group by 1, 2, 3, 4""",
        "swell_rows": _SWELL_ROWS,
        "model_samples": _SWELL_ROWS,
        "swell_wide": f"""with {NEAREST}
            select name as surf_spot_name, country, spot_lat as lat, spot_lng as lng,
            {_swell_columns("max(case when param = '{b}' then value end)", "max(case when param = '{b}' then units end)")},
            {_SWELL_TAIL} from nearest group by name, country, spot_lat, spot_lng""",
        "decode_values": """select p_partkey, case when p_size % 3 = 0 then null
            else p_retailprice * case when p_size % 5 <> 0 then cast(p_size as double) else 1 end end as value from part""",
        "grid_ravel": f"""with {GRID} select param, units, row_number() over (partition by param order by grid_idx) - 1 as grid_idx,
            lat, lon, value from grid""",
        "grid_scan": f"""with {GRID} select param, units, grid_idx, lat, lon, value, '20241022' as data_date, '0000' as data_time,
            '0 hours' as forecast_time from grid""",
        "station_refresh": f"""with {ST} select station_id, latitude, longitude, timestamp '2024-01-01' as created_at,
            timestamp '2024-01-01' as updated_at from st where met""",
        "coverage_job": f"""with {ST} select station_id, latitude, longitude,
            case when met then 'with_met' else 'without_met' end as coverage from st""",
        "catalog_table": f"""with {ST} select station_id, latitude + more as latitude, longitude, false as before, true as after
            from st, (values (0), (1)) m(more)""",
        "asset_metadata": f"""with {TABLE}, n as (select count(*) as everything,
            count(*) filter (where datetime < timestamp '1998-07-01') as early from obs_table)
            select 'wave_data_raw_buoy_data' as "table", '199806' as "partition", early as row_count, 11 as n_columns from n
            union all select 'wave_data_raw_buoy_data', '200112', everything, 11 from n
            union all select 'wave_data_raw_buoy_data', '200201', 0, 11 from n""",
        "param_listing": f"with {GRID} select param, count(*) as n_values from grid group by 1",
        "run_manifest": f"""with {EV}, bounds as (
            select station_id, time_bucket(interval 6 hours, min(datetime), timestamp '2000-01-01') as a,
              max(datetime) as b from ev group by 1),
            runs as (select station_id, unnest(generate_series(a, b, interval 6 hours)) as run_ts from bounds)
            select station_id, run_ts,
              'gfs_0p253hr/gfs' || strftime(run_ts, '%Y%m%d') || '/gfs_0p253hr_' || strftime(run_ts, '%H')
                || 'z.ascii?gustsfc[0][540][1260]' as archive_file,
              'grib_' || strftime(run_ts, '%Y%m%d_%H%M') || '.grib2' as local_file from runs""",
        "cycle_files": f"""with {EV}, c as (
            select event_id, time_bucket(interval 6 hours, datetime, timestamp '2000-01-01') as cycle from ev)
            select event_id, cycle, 'gfs.' || strftime(cycle, '%Y%m%d') || '/' || strftime(cycle, '%H')
              || '/wave/gridded/gfswave.t' || strftime(cycle, '%H') || 'z.atlocn.f'
              || case when event_id % 1200 < 1000 then lpad(cast(event_id % 1200 as varchar), 3, '0')
                 else cast(event_id % 1200 as varchar) end || '.grib2' as archive_file from c""",
        "lag_features": f"""with {EV}, lagged as (select station_id, datetime, {", ".join(M)},
            {", ".join(f"lag({m}) over (partition by station_id order by datetime) as {m}_lag1" for m in M)} from ev)
            select * from lagged where {" and ".join(f"{m} is not null and {m}_lag1 is not null" for m in M)}""",
        "lag_features_all_stations": f"""with {EV} select station_id, datetime, {", ".join(M)},
            {", ".join(f"lag({m}) over (order by datetime, station_id) as {m}_lag1" for m in M)} from ev""",
        "lag_features_untidy": f"""with {UNTIDY} select station_id, datetime, {", ".join(M)},
            {", ".join(f"lag({m}) over (partition by station_id order by datetime nulls first, {UNTIDY_ORDER}) as {m}_lag1" for m in M)} from untidy""",
        "lag_features_untidy_all": f"""with {UNTIDY} select station_id, datetime, {", ".join(M)},
            {", ".join(f"lag({m}) over (order by datetime nulls first, station_id nulls first, {UNTIDY_ORDER}) as {m}_lag1" for m in M)} from untidy""",
        "latest_untidy": f"""with {UNTIDY} select * from untidy qualify row_number() over (
            partition by station_id order by datetime desc nulls last, {", ".join(f"{m} desc nulls last" for m in M)}) = 1""",
        "sample_rows": f"with {MERGED} select * from merged order by md5(station_id || '|' || cast(datetime as varchar)) limit 60000",
        "kmeans_clusters": f"with {REGIMES} select o_orderkey, p - 1 as cluster from regimes",
        "kmeans_centres": f"""with {REGIMES} select p - 1 as cluster, count(*) as n,
            {", ".join(f"round(avg({m}), 6) as {m}" for m in M)} from regimes group by 1""",
        "cluster_histogram": f"with {REGIMES} select station_id, p - 1 as cluster, count(*) as n from regimes group by 1, 2",
        "silhouette_by_k": f"""with {REGIMES}, z as (
              select p, {", ".join(f"({m} - avg({m}) over ()) / stddev_pop({m}) over () as x{i}" for i, m in enumerate(M))} from regimes),
            c as (select p as q, count(*) as n, {", ".join(f"avg(x{i}) as m{i}" for i in range(4))},
              avg({" + ".join(f"x{i} * x{i}" for i in range(4))}) as s from z group by 1),
            zz as (select row_number() over () as id, * from z),
            d as (select id, p, q, n, {" + ".join(f"x{i} * x{i}" for i in range(4))} + s
              - 2 * ({" + ".join(f"x{i} * m{i}" for i in range(4))}) as far from zz, c),
            ab as (select id, max(case when p = q then far * n / (n - 1) end) as a, min(case when p <> q then far end) as b from d group by 1)
            select 5 as k, round(avg(1 - a / b), 6) as silhouette from ab""",
        "silhouette_euclidean": f"with {_euclidean()}",
        "latest_per_station": f"""with {EV} select * from ev
            qualify row_number() over (partition by station_id order by datetime desc) = 1""",
        "forecast_mse": f"""with {by_station}
            select count(*) as n_test, round(avg(pow(wave_height - ({predict(f"b{i} * {m}_lag1" for i, m in enumerate(M))}), 2)), 5) as mse
            from feats, model where is_test""",
        "forecast_next": f"""with {by_station}, last_rows as (
            select * from merged qualify row_number() over (partition by station_id order by datetime desc) = 1)
            select station_id, datetime, {", ".join(M)},
              round({predict(f"b{i} * {m}" for i, m in enumerate(M))}, 5) as forecast from last_rows, model""",
        "forecast_refit_last": f"""with {all_in_one}
            select station_id, datetime, round({predict(f"b{i} * {m}_lag1" for i, m in enumerate(M))}, 5) as forecast
            from (select * from lagged order by datetime desc, station_id desc limit 1) x, model""",
        "impute_scale": f"""with {OBS}, s as (select {", ".join(
            f"avg({m}) as a{i}, sqrt(var_pop({m}) * count({m}) / count(*)) as d{i}" for i, m in enumerate(M))} from obs)
            select l_orderkey, l_linenumber, {", ".join(
            f"round((coalesce({m}, a{i}) - a{i}) / d{i}, 6) as {m}_scaled" for i, m in enumerate(M))} from obs, s""",
        "insert_if_absent": f"""with {TABLE} select station_id, datetime, latitude, longitude, wave_height,
            dominant_period, case when datetime < timestamp '1998-07-01' then average_period else average_period + 1000 end
            as average_period, mean_wave_direction from obs_table""",
        "partition_rewrite": f"""with {TABLE} select station_id, datetime, latitude, longitude, {", ".join(M)}, {_ASSET_META},
            case when datetime < timestamp '1998-07-01' then '199806' else '200112' end as _asset_partition,
            case when datetime < timestamp '1998-07-01' then '199806' else '200112' end as _partition_key from obs_table""",
        "asset_reload": f"""with {TABLE} select station_id, datetime, latitude, longitude, {", ".join(M)} from obs_table
            where datetime < timestamp '1998-07-01'""",
        "daily_asset": f"""with {_landing()} select * replace (
              cast(cast(station_id as bigint) % 90 as double) as latitude,
              cast(cast(station_id as bigint) % 180 as double) as longitude) from landed
            where datetime >= timestamp '2024-01-29 12:00:00'""",
    }
