"""SQL for the other engine: the sample inputs written a second time, on their own."""

PINGS = """
  select event_id, user_id, ts, cast(round(value * 100) as bigint) as cents,
    cast(floor((day(ts) - 1) / 7.0e0) as bigint) as week,
    (event_id // 1048576) * 5 + cast(floor((day(ts) - 1) / 7.0e0) as bigint) as period,
    8.0e0  + (user_id % 40) / 10.0e0 + ((event_id * 7919) % 1000) / 10000.0e0   as lon,
    54.0e0 + (user_id % 30) / 10.0e0 + ((event_id * 104729) % 1000) / 10000.0e0 as lat
  from events
"""

GROUPED = f"""
  select user_id, week, period, count(*) as n, min(ts) as t0, max(ts) as t1,
    min(cents) // 10 as low, max(cents) // 10 as high,
    (cast(sum(cents) as bigint) // count(*)) // 10 as mean,
    arg_min(cents, event_id) // 10 as first, arg_max(cents, event_id) // 10 as last,
    list({{'x': lon, 'y': lat}} order by event_id) as geom
  from ({PINGS}) p group by user_id, week, period having count(*) >= 2
"""

_PARTS = {
    "start": "first", "end": "last", "min": "low", "max": "high", "avg": "mean",
    "median": "(low + high) // 2",
}


def _measures() -> str:
    out = []
    for part, tenths in _PARTS.items():
        if part != "median":
            out.append(f"({tenths} + 1) / 10.0e0 as calc_speed_{part}")
        out.append(f"({tenths}) / 10.0e0 as sog_{part}")
        out.append(f"(({tenths}) % 150) / 10.0e0 as draught_{part}")
        out.append(f"case when user_id % 2 <> 0 then (({tenths}) % 300) / 10.0e0 end as ukc_{part}")
    return ",\n    ".join(out)


OBJECTS = f"""
  select g.*, period * 10000000 + user_id as traj_id,
    case (user_id + period) % 4 when 3 then 'outlier' when 2 then 'stationary'
      else 'in motion' end as type,
    219000000 + user_id as mmsi,
    case when user_id % 5 <> 0 then 9000000 + user_id * 7 end as imo,
    cast(substr(cast(219000000 + user_id as varchar), 1, 3) as bigint) as mid,
    'ship' as radio_service_type, true as is_valid_mmsi,
    coalesce(user_id % 5 <> 0 and 9000000 + user_id * 7 <= 9999999 and
      (7 * ((9000000 + user_id * 7) // 1000000) + 6 * ((9000000 + user_id * 7) // 100000 % 10)
       + 5 * ((9000000 + user_id * 7) // 10000 % 10) + 4 * ((9000000 + user_id * 7) // 1000 % 10)
       + 3 * ((9000000 + user_id * 7) // 100 % 10) + 2 * ((9000000 + user_id * 7) // 10 % 10)) % 10
       = (9000000 + user_id * 7) % 10, false) as is_valid_imo,
    user_id % 2 = 0 as in_eu_mrv_db,
    cast(strftime(t0, '%Y%m%d') as bigint) as start_date_id,
    cast(strftime(t1, '%Y%m%d') as bigint) as end_date_id,
    cast(strftime(t0, '%-H%M%S') as bigint) as start_time_id,
    cast(strftime(t1, '%-H%M%S') as bigint) as end_time_id,
    date_sub('second', t0, t1) as seconds, n as no_points, n * 12.5e0 as meters,
    1.0e0 + (n % 7) / 8.0e0 as tortuosity,
    case when period <> 0 then period * 1000 + user_id % 7 end as meters_to_prev_obj,
    case when period <> 0 then period * 60 end as seconds_to_prev_obj,
    case when period = 0 then null when (user_id + period) % 2 = 0 then 'in motion'
      else 'stationary' end as prev_obj_type,
    ['unknown', 'initial', 'temporal gap', 'spatial gap', 'speeding', 'corrupt', 'stopping',
     'starting'][(user_id + period) % 8 + 1] as state_change,
    'VESSEL ' || (user_id % 150) as vessel_name, 'CALL ' || (user_id % 97) as call_sign,
    'type ' || (user_id % 5) as vessel_type, 'cargo ' || (user_id % 4) as cargo_type,
    'class ' || (user_id % 2) as transponder_type, 'pos ' || (user_id % 3) as pos_type,
    'DEST ' || (user_id % 23) as start_destination_msg,
    'DEST ' || ((user_id + period) % 23) as end_destination_msg,
    chr(cast(65 + user_id % 25 as integer)) || 'A' as alpha2,
    chr(cast(65 + user_id % 25 as integer)) || 'AX' as alpha3,
    'COUNTRY ' || (user_id % 25) as country_name, 100 + user_id % 25 as country_code,
    'R' || (user_id % 25 % 5) as region, user_id % 25 % 5 as region_code,
    'S' || (user_id % 25 % 10) as sub_region, user_id % 25 % 10 as sub_region_code,
    case when user_id % 3 <> 0 then user_id % 50 * 2 + 10 end as length,
    case when user_id % 3 <> 0 then user_id % 50 + 5 end as width,
    case when user_id % 6 <> 0 then user_id % 7 + 3 end as height, user_id % 9 as max_draught,
    user_id % 11 * 1000 as dwt, user_id % 11 * 500 as grt, user_id % 4 as to_bow,
    user_id % 4 + 1 as to_stern, user_id % 2 as to_port, user_id % 13 * 100 as main_engine_kwh,
    user_id % 2 = 0 as is_simple_geom,
    {_measures()}
  from ({GROUPED}) g
"""
MEASURE_COLUMNS = [
    f"{family}_{part}" for part in _PARTS for family in ("calc_speed", "sog", "draught", "ukc")
    if not (family == "calc_speed" and part == "median")
]
