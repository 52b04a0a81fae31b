"""SQL of the cleaned tables, written against the supplied tables directly."""

from __future__ import annotations

from siltstone.schemas import LINE_COLOURS
from workload.registry import AT

K = "cast(json_extract_string(props, '$.k') as integer)"
LINE_ID = (
    "coalesce(list_extract([" + ", ".join(f"'{x}'" for x in LINE_COLOURS) + "], cast(user_id as integer) + 1), "
    "'route-' || user_id)"
)
STAMP = f"timestamp '{AT}'"


def filed(time: str) -> str:
    """Audit and partition columns of a cleaned row."""
    return (
        f'{STAMP} as _silver_processed_at, cast(year({time}) as integer) as _year, '
        f'cast(month({time}) as integer) as _month, cast(day({time}) as integer) as _day'
    )


def hours(time: str) -> str:
    h = f"hour({time})"
    return (
        f"case when {h} between 5 and 8 then 'Early Morning' when {h} between 9 and 11 then 'Morning' "
        f"when {h} between 12 and 13 then 'Lunch' when {h} between 14 and 16 then 'Afternoon' "
        f"when {h} between 17 and 19 then 'Evening Rush' when {h} between 20 and 22 then 'Evening' "
        f"when {h} = 23 then 'Late Night' else 'Night' end"
    )


def peak(time: str) -> str:
    return f"(hour({time}) between 7 and 9 or hour({time}) between 17 and 19)"


def severity(code: str) -> str:
    return (
        f"case when {code} = 10 then 'Normal' when {code} between 6 and 9 then 'Minor' "
        f"when {code} between 3 and 5 then 'Major' when {code} is null then 'Unknown' else 'Severe' end"
    )


def date_key(time: str) -> str:
    return f"cast(year({time}) * 10000 + month({time}) * 100 + day({time}) as integer)"


def time_key(time: str) -> str:
    return f"cast(hour({time}) * 60 + minute({time}) as integer)"


def hour_of_2024(day: str) -> str:
    return f"(timestamp '2024-01-01' + to_hours(date_diff('day', date '1995-01-01', {day})))"


COLOUR = "case line_id " + " ".join(f"when '{k}' then '{v}'" for k, v in LINE_COLOURS.items()) + " end"

LANDED = f"""
select cast(event_id as varchar) as id, case when event_type = 'signup' then '' when event_type <> 'error' then 'V' || user_id end as "vehicleId",
  'S' || user_id as "naptanId", '  Station ' || user_id || ' ' as "stationName", case when {K} <> 0 then {LINE_ID} end as "lineId",
  'Line ' || user_id as "lineName", case when event_type <> 'view' then 'Platform ' || event_type end as "platformName",
  case when event_type in ('click', 'view') then ' Inbound ' else 'OUTBOUND' end as direction, '' as "destinationNaptanId",
  ' ' || event_type || ' ' as "destinationName", strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as "timestamp", {K} * 17 as "timeToStation",
  ' poll ' || p as "currentLocation", event_type || ' ' as towards,
  case when event_type = 'error' then 'not a time' else strftime(ts + to_seconds({K} * 17), '%Y-%m-%dT%H:%M:%S.%fZ') end as "timeToLive",
  case when event_type = 'purchase' then 'bus' else 'tube' end as "modeName",
  strftime(ts + to_seconds(p), '%Y-%m-%dT%H:%M:%S.%f+00:00') as _ingested_at,
  cast(year(ts + to_seconds(p)) as integer) as year, cast(month(ts + to_seconds(p)) as integer) as month,
  cast(day(ts + to_seconds(p)) as integer) as day
from events, (select 0 as p union all select 30)
"""

ARRIVALS = f"""
select cast(event_id as varchar) as id, 1 as "operationType",
  case when event_type = 'signup' then '' when event_type <> 'error' then 'V' || user_id end as "vehicleId",
  'S' || user_id as "naptanId", 'Station ' || user_id as "stationName", {LINE_ID} as "lineId",
  'Line ' || user_id as "lineName", case when event_type <> 'view' then 'Platform ' || event_type end as "platformName",
  case when event_type in ('click', 'view') then 'inbound' else 'outbound' end as direction,
  '' as "destinationNaptanId", event_type as "destinationName", ts as "timestamp", {K} * 17 as "timeToStation",
  'poll 30' as "currentLocation", event_type as towards, ts + to_seconds({K} * 17) as "expectedArrival",
  case when event_type <> 'error' then ts + to_seconds({K} * 17) end as "timeToLive",
  case when event_type = 'purchase' then 'bus' else 'tube' end as "modeName",
  ts + to_seconds(30) as _ingested_at, {filed("ts")}
from events where {K} <> 0
"""

LINE_STATUS = f"""
select id, name, "modeName", "statusSeverity", "statusSeverityDescription", reason, created, modified,
  _ingested_at, {filed("_ingested_at")}
from (
  select *, row_number() over (partition by id, _ingested_at, "statusSeverity" order by name nulls last,
    "modeName" nulls last, "statusSeverityDescription" nulls last, reason nulls last, created nulls last,
    modified nulls last) as rn
  from (
    select {LINE_ID} as id, 'Line ' || user_id as name,
      case when user_id < 11 then 'tube' when user_id = 11 then 'dlr' else 'bus' end as "modeName",
      case when event_type in ('signup', 'view') then null when s.n = 1 then {K} % 12 else 10 end as "statusSeverity",
      case when event_type in ('signup', 'view') then null
        else 'Severity ' || (case when s.n = 1 then {K} % 12 else 10 end) end as "statusSeverityDescription",
      case when event_type = 'error' and s.n = 1 then 'Reason ' || event_id end as reason,
      ts as created, case when event_type <> 'signup' then ts end as modified, ts as _ingested_at
    from events join (select 1 as n union all select 2) s on s.n = 1 or event_type = 'error'
  )
) where rn = 1
"""

BIKEPOINTS = f"""
select * exclude (rn), {filed("_ingested_at")} from (
  select *, row_number() over (partition by id, _ingested_at order by "commonName" nulls last, "placeType" nulls last,
    lat nulls last, lon nulls last, terminalname nulls last, installed nulls last, locked nulls last,
    temporary nulls last, nbbikes nulls last, nbemptydocks nulls last, nbdocks nulls last,
    nbstandardbikes nulls last, nbebikes nulls last) as rn
  from (
    select 'Dock_' || l_partkey as id, 'Dock ' || l_partkey as "commonName", 'BikePoint' as "placeType",
      l_discount as lat, l_tax as lon, cast(l_suppkey as varchar) as terminalname,
      case l_returnflag when 'N' then true when 'A' then false end as installed,
      l_linestatus = 'O' as locked, case when l_returnflag = 'A' then false end as temporary,
      cast(l_quantity as integer) as nbbikes,
      case when l_returnflag <> 'R' then 50 - cast(l_quantity as integer) end as nbemptydocks, 50 as nbdocks,
      l_linenumber as nbstandardbikes, cast(null as integer) as nbebikes, {hour_of_2024("l_shipdate")} as _ingested_at
    from lineitem
  )
) where rn = 1
"""

ZONE = (
    "case when c_nationkey < 10 then cast(c_nationkey as varchar) "
    "when c_nationkey <= 20 then (c_nationkey - 9) || '/' || (c_nationkey - 8) end"
)
WIFI = "case c_mktsegment when 'HOUSEHOLD' then 'yes' when 'MACHINERY' then 'Yes' when 'FURNITURE' then 'no' end"

STOPPOINTS = f"""
select case when c_mktsegment <> 'BUILDING' then 'C' || c_custkey else 'S' || c_custkey end as id,
  'S' || c_custkey as "naptanId", c_name as "commonName", 'StopPoint' as "placeType", c_mktsegment as "stopType",
  'N' || c_nationkey as "stationNaptan", cast(null as varchar) as "indicator", cast(null as varchar) as "stopLetter",
  c_acctbal > 0 as status, c_acctbal as lat, cast(c_nationkey as double) as lon, {ZONE} as zone, {WIFI} as wifi,
  case when c_mktsegment = 'AUTOMOBILE' then null when c_nationkey < 12 then 'tube,bus' else 'tube' end as modes,
  timestamp '2024-01-20 03:00:00' as _ingested_at, {filed("timestamp '2024-01-20 03:00:00'")}
from customer
"""


def decoded(text: str) -> str:
    out = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&quot;", '"'), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return f"regexp_replace({out}, '<br\\s*/?>', ' ', 'g')"


def stripped(text: str) -> str:
    out = f"replace({text}, '<br/>', ' ')"
    for entity in ("&lt;", "&gt;", "&#39;", "&amp;"):
        out = f"replace({out}, '{entity}', '')"
    return out


AIR_QUALITY = f"""
select 'hourly' as "updatePeriod", '1' as "updateFrequency", kind as "forecastType", 'F' || page_id as "forecastId",
  timestamp '2024-01-02 06:00:00' as "fromDate", cast(null as timestamp) as "toDate", 'Low' as "forecastBand",
  cast(null as varchar) as "forecastSummary", 'Low' as "no2Band", cast(null as varchar) as "o3Band",
  'Moderate' as "pm10Band", cast(null as varchar) as "pm25Band", cast(null as varchar) as "so2Band",
  {decoded("case when kind = 'Current' then html else url end")} as "forecastText",
  timestamp '2024-01-02 06:00:00' as _ingested_at, {filed("timestamp '2024-01-02 06:00:00'")}
from pages cross join (select 'Current' as kind union all select 'Future')
"""

ACCIDENTS = f"""
select o_orderkey as id, o_totalprice as lat, cast(null as double) as lon, 'Near 2024-01-06' as location,
  'Borough ' || o_custkey as borough, {hour_of_2024("o_orderdate")} as date, lower(o_orderpriority) as severity,
  case when o_orderpriority = '1-URGENT' then 'Car, Bus' when o_orderpriority = '2-HIGH' then ''
    when o_orderpriority <> '5-LOW' then 'Pedal Cycle' end as vehicle_types,
  case when o_orderstatus = 'F' then 4 else 0 end as casualties_total,
  case when o_orderstatus = 'F' then 1 else 0 end as casualties_fatal,
  0 as casualties_serious,
  case when o_orderstatus = 'F' then 2 else 0 end as casualties_slight,
  timestamp '2024-01-06 00:00:00' as _ingested_at, {filed(hour_of_2024("o_orderdate"))}
from orders
"""

DIM_LINE = f"""
select line_id, line_name, mode_name, {COLOUR} as line_color, mode_name = 'tube' as is_tube, mode_name = 'bus' as is_bus,
  mode_name = 'dlr' as is_dlr, contains(line_id, 'overground') as is_overground,
  row_number() over (order by line_id) - 1 as line_key, {STAMP} as _created_at
from (select distinct id as line_id, name as line_name, "modeName" as mode_name from ({LINE_STATUS}))
"""

DIM_STATION = f"""
select "naptanId" as naptan_id, "commonName" as common_name, "stopType" as stop_type, "stationNaptan" as station_naptan,
  zone, wifi, modes, lat, lon, status, station_name, coalesce(station_name, "commonName") as display_name,
  split_part(zone, '/', 1) as zone_primary,
  case when contains(zone, '/') then split_part(zone, '/', 2) end as zone_secondary,
  lower(wifi) = 'yes' as has_wifi, row_number() over (order by "naptanId") - 1 as station_key, {STAMP} as _created_at
from ({STOPPOINTS}) s
left join (select distinct "naptanId" as seen, "stationName" as station_name from ({ARRIVALS})) a on s."naptanId" = a.seen
"""

DIM_ZONE = f"""
select zone, split_part(zone, '/', 1) as zone_primary,
  case when contains(zone, '/') then split_part(zone, '/', 2) end as zone_secondary,
  contains(zone, '/') as is_boundary_zone, row_number() over (order by zone) - 1 as zone_key,
  'Zone ' || zone as zone_description, {STAMP} as _created_at
from (select distinct {ZONE} as zone from customer) where zone is not null
"""

DIM_DISRUPTION = f"""
select severity_code, case when severity_code is not null then 'Severity ' || severity_code end as severity_description,
  severity_code = 10 as is_good_service, severity_code < 10 as is_disrupted,
  {severity("severity_code")} as severity_category,
  row_number() over (order by severity_code nulls first) - 1 as disruption_key, {STAMP} as _created_at
from (select distinct "statusSeverity" as severity_code from ({LINE_STATUS}))
"""

FACT_ARRIVALS = f"""
select {date_key('"timestamp"')} as date_key, {time_key('"timestamp"')} as time_key, line_key, station_key,
  id as arrival_id, "vehicleId" as vehicle_id, "naptanId" as naptan_id, "lineId" as line_id,
  "platformName" as platform_name, direction, "destinationNaptanId" as destination_naptan_id,
  "destinationName" as destination_name, "timeToStation" as time_to_station_seconds,
  "timeToStation" / 60 as time_to_station_minutes, "currentLocation" as current_location, towards,
  "modeName" as mode_name, "timestamp" as prediction_timestamp, "expectedArrival" as expected_arrival,
  "timeToLive" as time_to_live, {hours('"timestamp"')} as period_of_day, {peak('"timestamp"')} as is_peak_hour,
  _ingested_at, _silver_processed_at, {STAMP} as _gold_processed_at, _year, _month, _day
from ({ARRIVALS}) a
left join (select line_id as l_id, line_key from ({DIM_LINE})) l on a."lineId" = l.l_id
left join (select naptan_id as n_id, station_key from ({DIM_STATION})) s on a."naptanId" = s.n_id
"""

FACT_LINE_STATUS = f"""
select {date_key("_ingested_at")} as date_key, {time_key("_ingested_at")} as time_key, line_key, disruption_key,
  id as line_id, name as line_name, "modeName" as mode_name, "statusSeverity" as status_severity,
  "statusSeverityDescription" as status_description, reason as disruption_reason,
  {hours("_ingested_at")} as period_of_day, {peak("_ingested_at")} as is_peak_hour,
  coalesce("statusSeverity" = 10, false) as is_good_service, coalesce("statusSeverity" < 10, false) as is_disrupted,
  _ingested_at, modified as last_modified, {STAMP} as _gold_processed_at, _year, _month, _day
from ({LINE_STATUS}) f
left join (select line_id as l_id, line_key from ({DIM_LINE})) l on f.id = l.l_id
left join (select severity_code, disruption_key from ({DIM_DISRUPTION})) d on f."statusSeverity" = d.severity_code
"""

SILVER = {
    "arrivals": ARRIVALS,
    "line_status": LINE_STATUS,
    "bikepoints": BIKEPOINTS,
    "stoppoints": STOPPOINTS,
    "air_quality": AIR_QUALITY,
    "accidents": ACCIDENTS,
}
