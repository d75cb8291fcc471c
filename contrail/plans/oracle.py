"""SQL twins of the registered queries, for an independent engine.

``MODELS`` holds one SELECT per model; a query is a final SELECT plus the models
it names, directly or not, as common table expressions.
"""

from __future__ import annotations

import re

from contrail.plans.registry import LOAD_DATE, MAP_COUNTRIES, SERIES_COUNTRY

ALPHA = 0.85
MAX_ITERATIONS = 100
# Steps that suffice for shortest paths and labels: the graph has 25 nodes at most.
GRAPH_STEPS = 25


def rnd(expression: str, digits: int = 6) -> str:
    return f"(round(({expression}) * 1e{digits}) / 1e{digits})"


def even(expression: str, digits: int) -> str:
    return f"(round_even(({expression}) * 1e{digits}, 0) / 1e{digits})"


MODELS: dict[str, str] = {}

MODELS["raw_flights"] = """
select
  concat(' ', upper(lpad(lower(hex(cast(base + l_partkey % 2048 as bigint))), 6, '0')), ' ') as icao24,
  fs as firstSeen,
  concat('n', lpad(cast(case when s_nationkey = 24 then 99 else s_nationkey end as varchar), 3, '0')) as estDepartureAirport,
  case when l_partkey % 97 = 0 then fs - 60
       when l_partkey % 101 = 0 then fs + 90000
       else fs + 1800 + cast(l_quantity * 600 as bigint) end as lastSeen,
  case when l_linenumber = 7 then null
       else concat('n', lpad(cast(case when dest = 24 then 99 else dest end as varchar), 3, '0')) end as estArrivalAirport,
  case when l_partkey % 50 = 0 then null
       else concat(case l_partkey % 14
                     when 0 then 'rch' when 1 then 'RRR' when 2 then 'gaf' when 3 then 'PLF'
                     when 4 then 'CNV' when 5 then 'LAGR' when 6 then 'TITAN'
                     when 7 then 'VIPER' when 8 then 'HAWK' when 9 then 'VENOM'
                     when 10 then 'RAGE' when 11 then 'HOMER' when 12 then 'FORTE'
                     else 'DLH' end, cast(l_partkey % 1000 as varchar)) end as callsign,
  cast(200 + l_partkey % 4800 as int) as estDepartureAirportHorizDistance,
  cast(10 + l_partkey % 190 as int) as estDepartureAirportVertDistance,
  cast(200 + l_suppkey % 4800 as int) as estArrivalAirportHorizDistance,
  cast(10 + l_suppkey % 190 as int) as estArrivalAirportVertDistance,
  cast(1 + l_partkey % 4 as int) as departureAirportCandidatesCount,
  cast(1 + l_suppkey % 4 as int) as arrivalAirportCandidatesCount,
  concat('n', lpad(cast(case when s_nationkey = 24 then 99 else s_nationkey end as varchar), 3, '0')) as _source_airport,
  'departure' as _source_direction,
  cast(l_shipdate as date) as source_date
from (
  select l.*, s_nationkey,
    cast(epoch(l_shipdate) as bigint) + (l_orderkey * 37 + l_linenumber * 11) % 86400 as fs,
    case when l_suppkey % 10 = 0 then 3866624
         when l_suppkey % 10 = 1 then 11403264
         when l_suppkey % 10 = 2 then 7866368
         when l_suppkey % 10 in (3, 4, 5, 6, 7)
              and extract(day from l_shipdate) = 13
              and extract(month from l_shipdate) in (3, 9) then 3866624
         else 2097152 end as base,
    case when o_custkey % 10 < 6 then g + (s_nationkey - g + 1) % m
         when o_custkey % 10 < 8 then g + (s_nationkey - g + 4) % m
         when o_custkey % 10 = 8 then g
         when o_custkey % 20 = 9 then s_nationkey
         else g + (s_nationkey - g + 2) % m end as dest
  from lineitem l
  join orders o on l_orderkey = o_orderkey
  join (select *, case when s_nationkey < 15 then 0 else 15 end as g,
                  case when s_nationkey < 15 then 15 else 10 end as m from supplier) s
    on l_suppkey = s_suppkey) t"""

MODELS["airport_metadata"] = """
select concat(' n', lpad(cast(n_nationkey as varchar), 3, '0')) as airport_id,
       n_name as airport_name, concat('City ', n_name) as city,
       substr(r_name, 1, 2) as country_code, r_name as country_name,
       cast(-60 + (n_nationkey * 37) % 120 as double) + 0.25 as latitude,
       cast(-170 + (n_nationkey * 71) % 340 as double) + 0.5 as longitude,
       'UTC' as timezone,
       case when n_nationkey % 8 = 0 then 'military' else 'international' end as airport_type
from nation join region on n_regionkey = r_regionkey"""

MODELS["range_seed"] = """
select * from (values
  (' 3B0000', '3bffff ', 'de', 'Germany', 'Branch A', 'x'),
  ('ae0000', 'aeffff', 'US', 'United States', 'Branch B', 'x'),
  ('780000', '783fff', 'NO', 'Norway', 'Branch C', 'x'),
  ('780800', '780fff', 'JP', 'Japan', 'Branch D', 'overlaps NO')
) as t(range_start, range_end, country_code, country_name, military_branch, notes)"""

MODELS["supplier_seed"] = """
select concat(' ', lpad(upper(hex(start)), 6, '0')) as range_start,
       concat(lpad(lower(hex(start + 95)), 6, '0'), ' ') as range_end,
       concat('c', cast(s_nationkey as varchar)) as country_code,
       concat(' ', s_name) as country_name,
       concat('Branch ', cast(s_suppkey % 5 as varchar)) as military_branch,
       case when s_suppkey % 3 <> 0 then concat('block ', cast(s_suppkey as varchar)) end as notes
from (select *, cast(case s_suppkey % 4 when 0 then 3866624 when 1 then 11403264
                                        when 2 then 7866368 else 2097152 end
                     + ((s_suppkey // 4) * 64) % 65536 as bigint) as start
      from supplier) s"""


def _ranges(seed: str) -> str:
    return f"""
select lower(trim(range_start)) as range_start, lower(trim(range_end)) as range_end,
       upper(trim(country_code)) as country_code, trim(country_name) as country_name,
       trim(military_branch) as military_branch, trim(notes) as notes
from {seed} where range_start is not null"""


MODELS["military_ranges"] = _ranges("range_seed")
MODELS["supplier_ranges"] = _ranges("supplier_seed")

MODELS["staged_flights"] = """
select md5(concat(coalesce(icao24, '_dbt_utils_surrogate_key_null_'), '-',
                  coalesce(cast(firstSeen as varchar), '_dbt_utils_surrogate_key_null_'), '-',
                  coalesce(estDepartureAirport, '_dbt_utils_surrogate_key_null_'))) as flight_id,
       lower(trim(icao24)) as icao24,
       make_timestamp(firstSeen * 1000000) as first_seen_at,
       make_timestamp(lastSeen * 1000000) as last_seen_at,
       upper(trim(estDepartureAirport)) as origin_airport_id,
       upper(trim(estArrivalAirport)) as destination_airport_id,
       upper(trim(callsign)) as callsign,
       estDepartureAirportHorizDistance as departure_horiz_distance_m,
       estDepartureAirportVertDistance as departure_vert_distance_m,
       estArrivalAirportHorizDistance as arrival_horiz_distance_m,
       estArrivalAirportVertDistance as arrival_vert_distance_m,
       departureAirportCandidatesCount as departure_candidates_count,
       arrivalAirportCandidatesCount as arrival_candidates_count,
       source_date
from raw_flights
where icao24 is not null and firstSeen is not null and lastSeen is not null
  and lastSeen > firstSeen"""

MODELS["staged_airports"] = """
select upper(trim(airport_id)) as airport_id, trim(airport_name) as airport_name,
       trim(city) as city, upper(trim(country_code)) as country_code,
       trim(country_name) as country_name, cast(latitude as double) as latitude,
       cast(longitude as double) as longitude, trim(timezone) as timezone,
       trim(airport_type) as airport_type
from airport_metadata where airport_id is not null"""

MODELS["placed_flights"] = """
select f.*, o.airport_name as origin_airport_name, o.city as origin_city,
       o.country_code as origin_country, o.latitude as origin_lat, o.longitude as origin_lon,
       d.airport_name as destination_airport_name, d.city as destination_city,
       d.country_code as destination_country, d.latitude as destination_lat,
       d.longitude as destination_lon,
       case when o.latitude is not null and o.longitude is not null
             and d.latitude is not null and d.longitude is not null
            then 2 * 6371.0 * asin(least(1.0, sqrt(
              pow(sin(radians(d.latitude - o.latitude) / 2), 2)
              + cos(radians(o.latitude)) * cos(radians(d.latitude))
                * pow(sin(radians(d.longitude - o.longitude) / 2), 2)))) end as distance_km
from staged_flights f
left join staged_airports o on f.origin_airport_id = o.airport_id
left join staged_airports d on f.destination_airport_id = d.airport_id"""

MODELS["enriched"] = """
select flight_id, icao24, callsign, first_seen_at, last_seen_at,
       cast(first_seen_at as date) as flight_date,
       (epoch(last_seen_at) - epoch(first_seen_at)) / 60.0 as flight_duration_min,
       origin_airport_id, origin_airport_name, origin_city, origin_country, origin_lat, origin_lon,
       destination_airport_id, destination_airport_name, destination_city, destination_country,
       destination_lat, destination_lon,
       distance_km,
       r.country_code is not null as is_military,
       r.country_code as military_country, r.military_branch,
       extract(year from first_seen_at) as flight_year,
       extract(month from first_seen_at) as flight_month,
       extract(dow from first_seen_at) as day_of_week,
       extract(dow from first_seen_at) in (0, 6) as is_weekend,
       source_date
from placed_flights f
left join military_ranges r on f.icao24 >= r.range_start and f.icao24 <= r.range_end"""

MODELS["military"] = """
select *,
  case when callsign like 'RCH%' or callsign like 'RRR%' or callsign like 'GAF%'
         or callsign like 'PLF%' or callsign like 'CNV%' then 'TRANSPORT'
       when callsign like 'LAGR%' or callsign like 'TITAN%' then 'TANKER'
       when callsign like 'VIPER%' or callsign like 'HAWK%' then 'TRAINING'
       when callsign like 'VENOM%' or callsign like 'RAGE%' then 'FIGHTER'
       when callsign like 'HOMER%' or callsign like 'FORTE%' then 'SURVEILLANCE'
       else 'UNKNOWN' end as military_category,
  case when distance_km is null then 'UNKNOWN' when distance_km < 500 then 'SHORT_RANGE'
       when distance_km < 2000 then 'MEDIUM_RANGE' else 'LONG_RANGE' end as range_category
from enriched where is_military"""

ROUTE_KEYS = """origin_airport_id, destination_airport_id, origin_airport_name,
       destination_airport_name, origin_country, destination_country"""

MODELS["connections"] = f"""
select *,
  case when origin_country = destination_country then 'DOMESTIC' else 'INTERNATIONAL' end
    as route_type,
  case when flight_count >= 100 then 'HIGH_FREQUENCY'
       when flight_count >= 20 then 'MEDIUM_FREQUENCY' else 'LOW_FREQUENCY' end
    as frequency_category
from (
  select {ROUTE_KEYS},
         count(*) as flight_count, count(distinct flight_date) as active_days,
         avg(flight_duration_min) as avg_duration_min, avg(distance_km) as avg_distance_km,
         sum(case when is_military then 1 else 0 end)::bigint as military_flights,
         sum(case when not is_military then 1 else 0 end)::bigint as civilian_flights,
         min(flight_date) as first_flight_date, max(flight_date) as last_flight_date
  from enriched
  where origin_airport_id is not null and destination_airport_id is not null
    and origin_airport_id != destination_airport_id
  group by {ROUTE_KEYS}) c"""

MODELS["performance"] = f"""
select *, {rnd('total_flights::double / nullif(active_days, 0)', 2)} as flights_per_day,
  {rnd('avg_duration_min / nullif(avg_distance_km, 0)', 4)} as min_per_km,
  case when origin_country = destination_country then 'DOMESTIC' else 'INTERNATIONAL' end
    as route_type,
  case when total_flights >= 500 then 'TIER_1_MAJOR' when total_flights >= 100 then 'TIER_2_REGULAR'
       when total_flights >= 20 then 'TIER_3_MINOR' else 'TIER_4_RARE' end as route_tier
from (
  select {ROUTE_KEYS},
         count(*) as total_flights, count(distinct flight_date) as active_days,
         count(distinct icao24) as unique_aircraft,
         {rnd('avg(flight_duration_min)', 1)} as avg_duration_min,
         {rnd('min(flight_duration_min)', 1)} as min_duration_min,
         {rnd('max(flight_duration_min)', 1)} as max_duration_min,
         {rnd('stddev_samp(flight_duration_min)', 1)} as stddev_duration_min,
         {rnd('avg(distance_km)', 1)} as avg_distance_km,
         {rnd('avg(case when is_weekend then 1::double else 0::double end) * 100', 1)} as weekend_pct,
         {rnd('sum(case when is_military then 1 else 0 end)::double * 100 / count(*)', 1)}
           as military_pct,
         min(flight_date) as first_flight, max(flight_date) as last_flight
  from enriched
  where origin_airport_id is not null and destination_airport_id is not null
  group by {ROUTE_KEYS}
  having count(*) >= 5) r"""

MODELS["degrees"] = """
select coalesce(o.airport_id, i.airport_id) as airport_id,
       coalesce(out_degree, 0) as out_degree, coalesce(in_degree, 0) as in_degree,
       coalesce(out_degree, 0) + coalesce(in_degree, 0) as total_degree,
       coalesce(outbound_flights, 0) as outbound_flights,
       coalesce(inbound_flights, 0) as inbound_flights,
       coalesce(outbound_flights, 0) + coalesce(inbound_flights, 0) as total_flights,
       coalesce(outbound_countries, 0) as outbound_countries,
       coalesce(inbound_countries, 0) as inbound_countries
from (select origin_airport_id as airport_id,
             count(distinct destination_airport_id) as out_degree,
             sum(flight_count)::bigint as outbound_flights,
             count(distinct destination_country) as outbound_countries
      from connections group by 1) o
full outer join
     (select destination_airport_id as airport_id,
             count(distinct origin_airport_id) as in_degree,
             sum(flight_count)::bigint as inbound_flights,
             count(distinct origin_country) as inbound_countries
      from connections group by 1) i
on o.airport_id = i.airport_id"""

MODELS["network"] = f"""
select n.airport_id, airport_name, city, country_code, latitude, longitude, out_degree,
       in_degree, total_degree, outbound_flights, inbound_flights, total_flights,
       outbound_countries, inbound_countries,
       case when total_degree >= 100 then 'MAJOR_HUB' when total_degree >= 50 then 'REGIONAL_HUB'
            when total_degree >= 20 then 'MEDIUM_AIRPORT'
            when total_degree >= 5 then 'SMALL_AIRPORT' else 'MINOR_AIRPORT' end as hub_category,
       case when total_flights > 0
            then {rnd('(outbound_flights - inbound_flights)::double / total_flights', 3)}
            else 0::double end as flow_asymmetry
from degrees n left join staged_airports a on n.airport_id = a.airport_id"""


def _category(name: str) -> str:
    return (f"sum(case when military_category = '{name}' then 1 else 0 end)::bigint "
            f"as {name.lower()}_flights")


MODELS["daily"] = f"""
select * from (
  select flight_date as date_id, extract(dow from flight_date) as day_of_week,
         military_country as country_code, count(*) as military_flight_count,
         count(distinct icao24) as unique_aircraft_count,
         {_category('TRANSPORT')}, {_category('FIGHTER')}, {_category('TRAINING')},
         {_category('TANKER')}, {_category('SURVEILLANCE')}, {_category('UNKNOWN')},
         avg(distance_km) as avg_distance_km, max(distance_km) as max_distance_km,
         count(distinct origin_airport_id) as unique_origins,
         count(distinct destination_airport_id) as unique_destinations
  from military where military_country is not null group by 1, 2, 3) d
where military_flight_count >= 3"""

MODELS["rolling"] = """
select *,
  avg(military_flight_count) over (partition by country_code order by date_id
    rows between 6 preceding and current row) as rolling_7d_avg,
  avg(military_flight_count) over (partition by country_code order by date_id
    rows between 29 preceding and current row) as rolling_30d_avg,
  stddev_samp(military_flight_count) over (partition by country_code order by date_id
    rows between 29 preceding and current row) as rolling_30d_std,
  military_flight_count - lag(military_flight_count) over (partition by country_code
    order by date_id) as day_over_day_change,
  military_flight_count - lag(military_flight_count, 7) over (partition by country_code
    order by date_id) as week_over_week_change,
  row_number() over (partition by country_code
    order by military_flight_count desc, date_id) as activity_rank_desc
from daily"""

MODELS["activity"] = f"""
select date_id, country_code, day_of_week, military_flight_count, unique_aircraft_count,
       transport_flights, fighter_flights, training_flights, tanker_flights,
       surveillance_flights,
       {rnd('rolling_7d_avg', 1)} as rolling_7d_avg,
       {rnd('rolling_30d_avg', 1)} as rolling_30d_avg,
       {rnd('rolling_30d_std', 2)} as rolling_30d_std,
       case when rolling_30d_std > 0
            then {rnd('(military_flight_count - rolling_30d_avg) / rolling_30d_std', 2)}
            else 0::double end as simple_z_score,
       day_over_day_change, week_over_week_change,
       {rnd('(military_flight_count - rolling_30d_avg) / nullif(rolling_30d_avg, 0) * 100', 1)}
         as pct_above_baseline,
       avg_distance_km, max_distance_km, unique_origins, unique_destinations,
       activity_rank_desc
from rolling"""

MODELS["flags"] = """
select *,
  case when simple_z_score >= 3.5 then 'CRITICAL' when simple_z_score >= 2.5 then 'HIGH'
       when simple_z_score >= 1.5 then 'ELEVATED' else 'NORMAL' end as anomaly_level,
  simple_z_score >= 2.5 as is_anomaly,
  case when fighter_flights > rolling_7d_avg * 0.3 then 'FIGHTER_SPIKE'
       when transport_flights > rolling_7d_avg * 0.5 then 'TRANSPORT_SURGE'
       when surveillance_flights > 0 then 'SURVEILLANCE_ACTIVE'
       else 'GENERAL_INCREASE' end as anomaly_context
from activity where simple_z_score >= 1.5"""

MODELS["baselines"] = """
select country_code, day_of_week, avg(military_flight_count) as baseline_mean,
       stddev_samp(military_flight_count) as baseline_std,
       median(military_flight_count) as baseline_median,
       count(military_flight_count) as sample_count
from daily group by 1, 2"""

MODELS["percentiles"] = """
select d.*,
       (rank() over (partition by country_code order by military_flight_count)
        + (count(*) over (partition by country_code, military_flight_count) - 1) / 2.0)::double
       / count(*) over (partition by country_code) as percentile_rank
from daily d"""

MODELS["scored"] = f"""
select date_id, country_code, day_of_week, military_flight_count, unique_aircraft_count,
       {even('baseline_mean', 2)} as baseline_mean, {even('baseline_std', 2)} as baseline_std,
       baseline_median::double as baseline_median, sample_count, {even('z', 4)} as z_score,
       case when z > 3.5 then 'CRITICAL' when z > 2.5 then 'HIGH' when z > 1.5 then 'ELEVATED'
            else 'NORMAL' end as anomaly_level,
       {even('percentile_rank', 4)} as percentile_rank
from (select p.*, baseline_mean, baseline_std, baseline_median, sample_count,
             case when baseline_std > 0
                  then (military_flight_count - baseline_mean) / baseline_std
                  else 0::double end as z
      from percentiles p join baselines b
        on p.country_code = b.country_code and p.day_of_week = b.day_of_week) s"""

# --- graph ---------------------------------------------------------------

MODELS["edges"] = """
select origin_airport_id as src, destination_airport_id as dst,
       max(flight_count) as weight
from connections group by 1, 2"""

MODELS["graph_nodes"] = "select src as id from edges union select dst from edges"

MODELS["wdegree"] = """
select id,
       coalesce((select sum(weight) from edges where dst = id), 0)::bigint as in_degree_weighted,
       coalesce((select sum(weight) from edges where src = id), 0)::bigint as out_degree_weighted,
       coalesce((select sum(weight) from edges where dst = id), 0)::bigint
       + coalesce((select sum(weight) from edges where src = id), 0)::bigint
         as total_degree_weighted
from graph_nodes"""

MODELS["shares"] = """
select src, dst, weight / sum(weight) over (partition by src) as share from edges"""

MODELS["rank_0"] = "select id, 1.0::double / (select count(*) from graph_nodes) as r from graph_nodes"
for _k in range(1, MAX_ITERATIONS + 1):
    MODELS[f"rank_{_k}"] = f"""
select n.id, {ALPHA}::double * (coalesce(i.inflow, 0) + l.lost) + {1 - ALPHA}::double * l.even as r
from graph_nodes n
left join (select dst, sum(share * r) as inflow from shares join rank_{_k - 1} on src = id
           group by dst) i on n.id = i.dst
cross join (select coalesce(sum(case when id not in (select src from edges) then r end), 0)
                   / count(*) as lost, 1::double / count(*) as even from rank_{_k - 1}) l"""

# the first iteration whose total change is below the tolerance
MODELS["settled_step"] = ("select min(step) as step from (" + " union all ".join(
    f"select {k} as step, sum(abs(a.r - b.r)) as change, count(*) as n "
    f"from rank_{k} a join rank_{k - 1} b on a.id = b.id"
    for k in range(1, MAX_ITERATIONS + 1)) + ") c where change < n * 1e-6")
MODELS["settled"] = ("select id, r from (" + " union all ".join(
    f"select {k} as step, id, r from rank_{k}"
    for k in range(1, MAX_ITERATIONS + 1)) + ") s where step = (select step from settled_step)")

MODELS["links"] = "select src, dst from edges union select dst, src from edges"
MODELS["label_0"] = "select id, id as label from graph_nodes"
for _k in range(1, GRAPH_STEPS + 1):
    MODELS[f"label_{_k}"] = f"""
select id, min(label) as label from (
  select id, label from label_{_k - 1}
  union all select dst, label from links join label_{_k - 1} on src = id) u group by id"""

MODELS["communities"] = f"""
select id, dense_rank() over (order by label) - 1 as community_id from label_{GRAPH_STEPS}"""

MODELS["pairs"] = """
select low, high, weight::double / max(weight) over () as w from (
  select least(src, dst) as low, greatest(src, dst) as high,
         coalesce(max(case when src > dst then weight end), max(weight)) as weight
  from edges where src <> dst group by 1, 2) p"""

MODELS["triangles"] = """
select x.low as a, x.high as b, y.high as c, cbrt(x.w * y.w * z.w) as t
from pairs x join pairs y on x.high = y.low join pairs z on z.low = x.low and z.high = y.high"""

MODELS["clustered"] = """
select id, case when t is null then 0::double else 2 * t / (d * (d - 1)) end as clustering
from (select id, count(*) as d from (select low as id from pairs union all select high from pairs) e
      group by id) deg
left join (select node, sum(t) as t
           from (select a as node, t from triangles union all select b, t from triangles
                 union all select c, t from triangles) s group by node) tri on id = node"""

MODELS["dist_0"] = "select id as source, id as node, 0::bigint as d from graph_nodes"
for _k in range(1, GRAPH_STEPS + 1):
    MODELS[f"dist_{_k}"] = f"""
select source, node, min(d) as d from (
  select * from dist_{_k - 1}
  union all select source, dst, d + weight from dist_{_k - 1} join edges on node = src) u
group by source, node"""

_DIST = f"dist_{GRAPH_STEPS}"
MODELS["tight"] = f"""
select a.source, e.src, e.dst from {_DIST} a join edges e on a.node = e.src
join {_DIST} b on b.source = a.source and b.node = e.dst and b.d = a.d + e.weight"""

MODELS["fwd_0"] = f"select source, node, 1::double as p from {_DIST} where source = node"
for _k in range(1, GRAPH_STEPS + 1):
    MODELS[f"fwd_{_k}"] = f"""
select t.source, t.dst as node, sum(p) as p from fwd_{_k - 1} f
join tight t on t.source = f.source and t.src = f.node group by 1, 2"""
MODELS["path_counts"] = (
    "select source, node, sum(p) as paths from ("
    + " union all ".join(f"select * from fwd_{k}" for k in range(GRAPH_STEPS + 1))
    + ") u group by 1, 2")

MODELS["bwd_0"] = "select source, node, 1 / paths as p from path_counts"
for _k in range(1, GRAPH_STEPS + 1):
    MODELS[f"bwd_{_k}"] = f"""
select t.source, t.src as node, sum(p) as p from bwd_{_k - 1} f
join tight t on t.source = f.source and t.dst = f.node group by 1, 2"""
MODELS["path_shares"] = (
    "select source, node, sum(p) as share from ("
    + " union all ".join(f"select * from bwd_{k}" for k in range(1, GRAPH_STEPS + 1))
    + ") u group by 1, 2")

MODELS["centrality"] = """
select id, coalesce(b, 0) as betweenness
from graph_nodes left join (
  select c.node, sum(paths * share)
         / (case when (select count(*) from graph_nodes) > 2
                 then ((select count(*) from graph_nodes) - 1)
                      * ((select count(*) from graph_nodes) - 2) else 1 end) as b
  from path_counts c join path_shares s on c.source = s.source and c.node = s.node
  where c.node <> c.source group by c.node) x on id = node"""

MODELS["graph_mart"] = f"""
select r.id as airport_id, {even('r', 6)} as pagerank_score,
       in_degree_weighted, out_degree_weighted, total_degree_weighted,
       {even('betweenness', 6)} as betweenness_centrality,
       {even('coalesce(clustering, 0)', 6)} as clustering_coefficient,
       community_id,
       row_number() over (order by {rnd('r * (select count(*) from graph_nodes)', 9)} desc, r.id) as hub_rank,
       (select count(*) from graph_nodes) as graph_total_nodes,
       (select count(*) from edges) as graph_total_edges
from settled r join wdegree w on r.id = w.id join centrality b on r.id = b.id
left join clustered c on r.id = c.id join communities m on r.id = m.id"""

# --- the growing graph: recursion until nothing changes --------------------

MODELS["supply_edges"] = """
select a.src, a.dst, sum(w)::bigint as weight from (
  select 's' || lpad(x.l_suppkey::varchar, 7, '0') as src,
         's' || lpad((case when x.l_partkey % 10 = 0 then 1 else y.l_suppkey end)::varchar, 7, '0') as dst,
         1 + x.l_partkey % 5 as w
  from lineitem x join lineitem y on x.l_orderkey = y.l_orderkey and y.l_linenumber = x.l_linenumber + 1
  where x.l_quantity = 50 and x.l_suppkey % 10 <> 7) a
where a.src <> a.dst group by a.src, a.dst"""


def _of_supply(model: str) -> str:
    """A model over the growing graph instead of the airports."""
    names = ("edges", "graph_nodes", "wdegree", "shares", "settled", "communities", "pairs", "triangles",
             "clustered", "path_counts", "path_shares", "centrality", "tight")
    return re.sub(rf"\b({'|'.join(names)})\b", r"supply_\1", MODELS[model])


for _model in ("graph_nodes", "wdegree", "shares", "pairs", "triangles", "clustered", "centrality", "graph_mart"):
    MODELS[f"supply_{_model}"] = _of_supply(_model)
MODELS["supply_settled"] = f"""
with recursive s as (
  select 0 as step, id, 1::double / (select count(*) from supply_graph_nodes) as r, 1e9::double as change
  from supply_graph_nodes
  union all
  select step, id, r, sum(abs(r - before)) over () as change from (
    select p.step + 1 as step, p.id, p.r as before,
           {ALPHA}::double * (coalesce(i.inflow, 0) + l.lost) + {1 - ALPHA}::double / l.n as r
    from s p
    left join (select h.dst, sum(h.share * q.r) as inflow from supply_shares h join s q on h.src = q.id
               group by h.dst) i on p.id = i.dst
    cross join (select coalesce(sum(case when id not in (select src from supply_edges) then r end), 0)
                       / count(*) as lost, count(*) as n from s) l
    where p.change >= l.n * 1e-6) n)
select id, r from s where step = (select max(step) from s)"""
MODELS["supply_communities"] = """
with recursive u as (select src as a, dst as b from supply_edges union select dst, src from supply_edges),
c as (select id, id as label from supply_graph_nodes union select u.b, c.label from c join u on u.a = c.id)
select id, dense_rank() over (order by min(label)) - 1 as community_id from c group by id"""
MODELS["supply_dist"] = """
with recursive d(source, node, d) using key (source, node) as (
  select id, id, 0::bigint from supply_graph_nodes
  union
  select n.source, n.node, n.d from (
    select w.source, e.dst as node, min(w.d + e.weight) as d from d w join supply_edges e on w.node = e.src
    group by w.source, e.dst) n
  left join recurring.d r on r.source = n.source and r.node = n.node where r.d is null or n.d < r.d)
select source, node, d from d"""
MODELS["supply_tight"] = """
select a.source, e.src, e.dst from supply_dist a join supply_edges e on a.node = e.src
join supply_dist b on b.source = a.source and b.node = e.dst and b.d = a.d + e.weight"""
for _name, _start, _from, _to in (
        ("path_counts", "select id as source, id as node, 1::double as p from supply_graph_nodes", "src", "dst"),
        ("path_shares", "select source, node, 1 / paths as p from supply_path_counts", "dst", "src")):
    MODELS[f"supply_{_name}"] = f"""
with recursive w as (
  select 0 as step, source, node, p from ({_start}) s
  union all
  select any_value(w.step) + 1, t.source, t.{_to}, sum(w.p) from w
  join supply_tight t on t.source = w.source and t.{_from} = w.node group by t.source, t.{_to})
select source, node, sum(p) as {"paths" if _name == "path_counts" else "share"} from w
where {"true" if _name == "path_counts" else "step > 0"} group by source, node"""

MODELS["map_points"] = """
select g.*, airport_name, country_code, latitude, longitude
from graph_mart g left join staged_airports a on g.airport_id = a.airport_id
where latitude is not null and longitude is not null"""

# --- ingest --------------------------------------------------------------

MODELS["state_vectors_raw"] = """
select lower(hex(user_id)) as icao24, event_type as callsign,
       concat('C', cast(user_id % 5 as varchar)) as origin_country,
       cast(floor(epoch(ts)) as bigint) as seconds, value, user_id
from events"""

MODELS["pulls_done"] = """
select distinct source_date as day, _source_airport as airport,
       _source_direction as direction from raw_flights"""

MODELS["pull_grid"] = """
select cast(d.day as date) as day, airport, direction
from (select distinct airport from pulls_done) a,
     (select unnest(generate_series((select min(day) from pulls_done)::timestamp,
                                    (select max(day) from pulls_done)::timestamp,
                                    interval 1 day)) as day) d,
     (values ('departure'), ('arrival')) v(direction)"""

RAW_COLUMNS = [
    "icao24", "firstSeen", "estDepartureAirport", "lastSeen", "estArrivalAirport", "callsign",
    "estDepartureAirportHorizDistance", "estDepartureAirportVertDistance",
    "estArrivalAirportHorizDistance", "estArrivalAirportVertDistance",
    "departureAirportCandidatesCount", "arrivalAirportCandidatesCount"]


def _dedup() -> str:
    rest = [c for c in RAW_COLUMNS if c not in ("icao24", "firstSeen")]
    order = ", ".join(f"{c} asc nulls first" for c in ["icao24", "firstSeen", *rest,
                                                       "_source_airport", "_source_direction",
                                                       "source_date"])
    columns = ", ".join([*RAW_COLUMNS, "_source_airport", "_source_direction", "source_date"])
    return f"""
select {columns} from (
  select *, row_number() over (partition by coalesce(icao24, ''), coalesce(firstSeen, 0)
                               order by pull, {order}) as copy
  from (select *, 0 as pull from raw_flights
        union all
        select * replace ('arrival' as _source_direction), 1 as pull
        from raw_flights where departureAirportCandidatesCount = 2) b) c
where copy = 1"""


# --- checks --------------------------------------------------------------

CHECKED_MODELS = {
    "stg_flights": "staged_flights", "stg_airports": "staged_airports",
    "stg_ranges": "military_ranges", "flight_performance": "performance",
    "airport_network": "network", "military_activity": "activity", "anomaly_flags": "flags",
    "anomaly_scores": "scored", "airport_graph": "graph_mart", "flights_enriched": "enriched"}


# The specified checks, one column per line.
SPECIFIED_CHECKS = """
stg_flights flight_id unique not_null
stg_flights icao24 not_null
stg_flights first_seen_at not_null
stg_flights last_seen_at not_null
stg_airports airport_id unique not_null
stg_airports latitude not_null
stg_airports longitude not_null
stg_ranges range_start not_null
stg_ranges range_end not_null
stg_ranges country_code not_null
flight_performance origin_airport_id not_null
flight_performance destination_airport_id not_null
flight_performance total_flights not_null accepted_range:5:
flight_performance avg_duration_min accepted_range:0:1440
airport_network airport_id unique not_null
airport_network total_degree accepted_range:0:
military_activity date_id not_null
military_activity country_code not_null
military_activity military_flight_count not_null accepted_range:0:
anomaly_flags anomaly_level accepted_values:ELEVATED,HIGH,CRITICAL
anomaly_scores date_id not_null
anomaly_scores country_code not_null
anomaly_scores anomaly_level accepted_values:NORMAL,ELEVATED,HIGH,CRITICAL
airport_graph airport_id unique not_null
airport_graph hub_rank unique not_null
airport_graph pagerank_score accepted_range:0:1
flights_enriched flight_duration_min no_negative max_value:1440
flights_enriched is_military max_ratio:20
"""


def _failing(source: str, column: str, kind: str, *args: str) -> str:
    if kind == "unique":
        return (f"select count(*) from (select {column} from {source} where {column} is not null "
                f"group by 1 having count(*) > 1) x")
    if kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in args[0].split(","))
        return (f"select count(*) from (select {column} from {source} group by 1) x "
                f"where {column} not in ({values})")
    if kind == "max_ratio":
        return (f"select count(*) from (select sum(case when {column} then 1 else 0 end) * 100.0 "
                f"/ count(*) as pct from {source}) x where pct > {args[0]}")
    if kind == "not_null":
        condition = f"{column} is null"
    elif kind == "no_negative":
        condition = f"{column} < 0"
    elif kind == "max_value":
        condition = f"{column} > {args[0]}"
    else:
        condition = " or ".join(f"{column} {sign} {bound}" for sign, bound in zip("<>", args) if bound)
    return f"select count(*) from {source} where {condition}"


def _suite() -> str:
    rows = []
    for line in SPECIFIED_CHECKS.split("\n"):
        if line:
            model, column, *checks = line.split()
            for kind, *args in (c.split(":") for c in checks):
                failing = _failing(CHECKED_MODELS[model], column, kind, *args)
                rows.append(f"select '{kind}:{model}.{column}' as \"check\", '{model}' as model, "
                            f"'{column}' as \"column\", ({failing}) as failures")
    return ("select *, failures = 0 as passed from (\n  "
            + "\n  union all ".join(rows) + ") r")


# --- final selects -------------------------------------------------------

def _all_but(model: str, *doubles: str) -> str:
    """All columns of a model with some doubles rounded for the comparison."""
    replaced = ", ".join(f"{rnd(c)} as {c}" for c in doubles)
    return f"select * replace ({replaced}) from {model}"


FINAL: dict[str, str] = {
    "stg_flights": "select * from staged_flights",
    "stg_airports": "select * from staged_airports",
    "stg_ranges": "select * from supplier_ranges",
    "flights_enriched": _all_but("enriched", "flight_duration_min", "distance_km"),
    "haversine_distance": f"select flight_id, origin_airport_id, destination_airport_id, "
                          f"{rnd('distance_km')} as distance_km from placed_flights",
    "date_parts": "select flight_id, cast(first_seen_at as date) as flight_date, "
                  "extract(year from first_seen_at) as flight_year, "
                  "extract(month from first_seen_at) as flight_month, "
                  "extract(dow from first_seen_at) as day_of_week, "
                  "extract(dow from first_seen_at) in (0, 6) as is_weekend from staged_flights",
    "military_flights": _all_but("military", "flight_duration_min", "distance_km"),
    "airport_connections": _all_but("connections", "avg_duration_min", "avg_distance_km"),
    "route_performance": "select * from performance",
    "airport_network": "select * from network",
    "degree_full_outer": "select * from degrees",
    "daily_counts": _all_but("daily", "avg_distance_km", "max_distance_km"),
    "rolling_stats": f"select date_id, country_code, military_flight_count, "
                     f"{rnd('rolling_7d_avg')} as rolling_7d_avg, "
                     f"{rnd('rolling_30d_avg')} as rolling_30d_avg, "
                     f"{rnd('rolling_30d_std')} as rolling_30d_std from rolling",
    "lag_changes": "select date_id, country_code, military_flight_count, day_over_day_change, "
                   "week_over_week_change from rolling",
    "activity_rank": "select date_id, country_code, military_flight_count, activity_rank_desc "
                     "from rolling",
    "military_activity": _all_but("activity", "avg_distance_km", "max_distance_km"),
    "anomaly_flags": _all_but("flags", "avg_distance_km", "max_distance_km"),
    "baseline_stats": _all_but("baselines", "baseline_mean", "baseline_std"),
    "anomaly_scores": "select * from scored",
    "percentile_rank": f"select date_id, country_code, military_flight_count, "
                       f"{rnd('percentile_rank')} as percentile_rank from percentiles",
    "weighted_degree": "select * from wdegree",
    "pagerank": f"select id, {rnd('r')} as pagerank from settled",
    "components": "select * from communities",
    "clustering": _all_but("clustered", "clustering"),
    "betweenness": _all_but("centrality", "betweenness"),
    "airport_graph": "select * from graph_mart",
    "supply_graph": "select * from supply_graph_mart",
    "supply_betweenness": _all_but("supply_centrality", "betweenness"),
    "rolling_calendar": f"""
select date_id, country_code, military_flight_count,
       count(*) over short as calendar_7d_days, count(*) over long as calendar_30d_days,
       {rnd("avg(military_flight_count) over short")} as calendar_7d_avg,
       {rnd("avg(military_flight_count) over long")} as calendar_30d_avg,
       {rnd("stddev_samp(military_flight_count) over long")} as calendar_30d_std
from daily window
  short as (partition by country_code order by date_id range between interval 6 days preceding and current row),
  long as (partition by country_code order by date_id range between interval 29 days preceding and current row)""",
    "dedup_pulls": _dedup(),
    "state_vectors": """
select icao24, callsign, origin_country, seconds as time_position, seconds as last_contact,
       value as longitude, value as latitude, value as baro_altitude, false as on_ground,
       value as velocity, value as true_track, value as vertical_rate, value as geo_altitude,
       cast(user_id % 8 as varchar) as squawk, true as spi,
       cast(user_id % 3 as int) as position_source
from state_vectors_raw""",
    "missing_slices": "select day, airport, direction from pull_grid "
                      "except select day, airport, direction from pulls_done",
    "pull_coverage": f"""
select total_slices, done_slices, total_slices - done_slices as remaining_slices,
       {rnd('done_slices * 100::double / total_slices')} as pct_done
from (select (select count(*) from pull_grid) as total_slices,
             (select count(*) from pulls_done) as done_slices) c""",
    "daily_slice": f"select * from raw_flights "
                   f"where firstSeen >= epoch(date '{LOAD_DATE}' - interval 1 day) "
                   f"and firstSeen < epoch(date '{LOAD_DATE}')",
    "tag_source": "select * replace ('EDDF' as _source_airport, 'arrival' as _source_direction) "
                  "from raw_flights",
    "load_flights": f"select {', '.join(RAW_COLUMNS)}, null::varchar as _source_airport, "
                    f"null::varchar as _source_direction, date '{LOAD_DATE}' as source_date "
                    f"from raw_flights",
    "load_summary": "select count(*) as total_rows, count(distinct icao24) as unique_aircraft "
                    "from raw_flights",
    "dq_suite": _suite(),
    "dq_negative_duration": """
select icao24, firstSeen, lastSeen, (lastSeen - firstSeen) / 60::double as flight_duration_min
from raw_flights where lastSeen < firstSeen""",
    "dq_max_24h": f"select flight_id, {rnd('flight_duration_min')} as flight_duration_min, "
                  f"origin_airport_id, destination_airport_id from enriched "
                  f"where flight_duration_min > 1440",
    "dq_military_ratio": f"""
select total_flights, military_flights, {rnd('military_flights * 100::double / total_flights')}
         as military_pct
from (select count(*) as total_flights,
             sum(case when is_military then 1 else 0 end)::bigint as military_flights
      from enriched) s
where military_flights * 100::double / total_flights > 20""",
    "network_map": f"""
select airport_id, airport_name, country_code, latitude, longitude, hub_rank, pagerank_score,
       betweenness_centrality,
       {rnd('case when hi > lo then (pagerank_score - lo) / (hi - lo) * 800 + 50 else 200 end')}
         as marker_size
from map_points, (select min(pagerank_score) as lo, max(pagerank_score) as hi from map_points) b""",
    "network_kpis": """
select count(*) as total_airports, count(distinct country_code) as countries,
       (select coalesce(airport_name, airport_id) from map_points
        order by pagerank_score desc, airport_id limit 1) as top_hub
from map_points""",
    "network_top": "select hub_rank, airport_id, airport_name, country_code, pagerank_score, "
                   "betweenness_centrality from map_points "
                   "order by pagerank_score desc, airport_id limit 15",
    "hub_ranking": "select airport_id, airport_name, country_code, total_degree from network "
                   "order by total_degree desc, airport_id limit 20",
    "top_routes": """
select origin_airport_id, destination_airport_id, origin_airport_name,
       destination_airport_name, total_flights, avg_duration_min, avg_distance_km,
       coalesce(origin_airport_name || ' → ' || destination_airport_name,
                origin_airport_id || ' → ' || destination_airport_id) as route
from performance order by total_flights desc, origin_airport_id, destination_airport_id limit 20""",
    "route_kpis": f"select count(*) as total_routes, sum(total_flights)::bigint as total_flights, "
                  f"{rnd('avg(avg_distance_km)')} as avg_distance_km from performance",
    "anomaly_summary": """
select count(*) filter (where anomaly_level = 'CRITICAL') as critical,
       count(*) filter (where anomaly_level = 'HIGH') as high,
       count(*) filter (where anomaly_level = 'ELEVATED') as elevated,
       count(distinct country_code) as countries_monitored
from scored""",
    "country_series": f"select date_id, military_flight_count, baseline_mean, z_score from scored "
                      f"where country_code = '{SERIES_COUNTRY}'",
    "anomaly_events": f"select date_id, country_code, military_flight_count, baseline_mean, "
                      f"z_score, anomaly_level from scored "
                      f"where country_code = '{SERIES_COUNTRY}' "
                      f"and anomaly_level in ('ELEVATED', 'HIGH', 'CRITICAL')",
}

for _name, _metric in (("pagerank", "pagerank_score"), ("betweenness", "betweenness_centrality")):
    FINAL[f"hub_ranking_{_name}"] = (
        f"select airport_id, airport_name, country_code, {_metric} from map_points "
        f"order by {_metric} desc, airport_id limit 20")
for _name, _metric, _k in (("distance", "avg_distance_km", 20), ("duration", "avg_duration_min", 15)):
    FINAL[f"top_routes_{_name}"] = FINAL["top_routes"].replace(
        "order by total_flights desc", f"order by {_metric} desc nulls last").replace(
        "limit 20", f"limit {_k}")
FINAL["network_map_countries"] = (
    f"select * from ({FINAL['network_map']}) m where country_code in {MAP_COUNTRIES}")
FINAL["map_countries"] = ("select country_code, count(*) as airports from map_points "
                          "where country_code is not null group by 1")

MODELS["digest"] = """
select date_id, country_code, military_flight_count, z_score, anomaly_level
from scored where anomaly_level in ('CRITICAL', 'HIGH')
order by z_score desc, date_id, country_code limit 20"""
FINAL["alert_digest"] = """
select *, '[' || anomaly_level || '] ' || country_code || ' on ' || cast(date_id as varchar)
          || ': ' || military_flight_count || ' flights (z='
          || printf('%.2f', z_score) || ')' as alert_line
from digest"""
FINAL["alert_counts"] = """
select count(*) filter (where anomaly_level = 'CRITICAL') as critical_count,
       count(*) filter (where anomaly_level = 'HIGH') as high_count from scored"""

for _name, _ranges_model in (("range_classify", "military_ranges"),
                             ("range_classify_bucketed", "supplier_ranges")):
    FINAL[_name] = f"""
select flight_id, icao24, range_start, range_end, country_code, military_branch
from staged_flights f left join {_ranges_model} r
  on f.icao24 >= r.range_start and f.icao24 <= r.range_end"""

_STAMPED = (f"select {', '.join(RAW_COLUMNS)}, null::varchar as _source_airport, "
            "null::varchar as _source_direction, make_timestamp((firstSeen + 86400) * 1000000) as loaded_at, "
            f"date '{LOAD_DATE}' as source_date from raw_flights")
FINAL["stamped_flights"] = _STAMPED
FINAL["append_round_trip"] = _STAMPED.replace(
    " callsign,", " case when firstSeen % 2 <> 0 then callsign end as callsign,")
FINAL["seed_round_trip"] = "select * from staged_airports"
FINAL["mart_round_trip"] = FINAL["route_performance"]
FINAL["refresh_run"] = FINAL["anomaly_scores"]
_BY_DATE = "partition by country_code order by date_id"
FINAL["incremental_refresh"] = f"""
select country_code, military_flight_count,
       {rnd(f"avg(military_flight_count) over ({_BY_DATE} rows 6 preceding)")} as rolling_7d_avg,
       {rnd(f"avg(military_flight_count) over ({_BY_DATE} rows 29 preceding)")} as rolling_30d_avg,
       {rnd(f"stddev_samp(military_flight_count) over ({_BY_DATE} rows 29 preceding)")} as rolling_30d_std,
       military_flight_count - lag(military_flight_count) over ({_BY_DATE}) as day_over_day_change,
       military_flight_count - lag(military_flight_count, 7) over ({_BY_DATE}) as week_over_week_change,
       date_id
from daily"""
FINAL["network_in_order"] = """
select row_number() over (order by total_flights desc, airport_id) as position, airport_id, total_flights
from network"""
FINAL["flags_in_order"] = """
select row_number() over (order by date_id desc, simple_z_score desc, country_code) as position,
       date_id, country_code, simple_z_score from flags"""
FINAL["scores_in_order"] = """
select row_number() over (order by date_id, z_score desc, country_code) as position,
       date_id, country_code, z_score from scored"""
_SIZE = ("case when max(total_degree) over () > min(total_degree) over () "
         "then (total_degree - min(total_degree) over ())::double "
         "/ (max(total_degree) over () - min(total_degree) over ()) * 800 + 50 else 200::double end")
FINAL["map_of_network"] = f"""
select airport_id, airport_name, country_code, total_degree, latitude, longitude, {rnd(_SIZE)} as marker_size
from network where latitude is not null and longitude is not null"""
FINAL["map_of_seed"] = """
select airport_id, airport_name, country_code, latitude, longitude, 200::double as marker_size
from staged_airports where latitude is not null and longitude is not null"""
FINAL["map_top_countries"] = f"""
select airport_id, airport_name, country_code, total_degree from network
where latitude is not null and longitude is not null and country_code in {MAP_COUNTRIES}
order by total_degree desc, airport_id limit 15"""
FINAL["series_countries"] = "select country_code, count(*) as days from activity group by 1"

FINAL["interval_classify"] = FINAL["range_classify_bucketed"]
for _name, _ranges_model in (("interval_narrowest", "military_ranges"),
                             ("interval_narrowest_growing", "supplier_ranges")):
    FINAL[_name] = f"""
select flight_id, icao24, range_start, range_end, country_code, military_branch
from staged_flights f left join {_ranges_model} r
  on f.icao24 >= r.range_start and f.icao24 <= r.range_end
qualify row_number() over (partition by flight_id
                           order by range_start desc, range_end, country_code, military_branch) = 1"""
FINAL["interval_text_keys"] = """
select flight_id, callsign, block_start, block_end, block_owner
from staged_flights left join (
  select prefix || low::varchar as block_start, prefix || (low + 7)::varchar as block_end, s_suppkey as block_owner
  from (select s_suppkey, ['RCH', 'GAF', 'CNV', 'HAWK', 'TITAN'][1 + s_suppkey % 5] as prefix,
               s_suppkey * 13 % 1000 as low from supplier) s) b
  on callsign >= block_start and callsign <= block_end"""

_LITERAL = re.compile(r"'[^']*'")
_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _with_models(final: str) -> str:
    """The final SELECT preceded by the models it needs, in dependency order."""
    ordered: dict[str, None] = {}

    def visit(text: str) -> None:
        for word in dict.fromkeys(_WORD.findall(_LITERAL.sub("", text))):
            if word in MODELS and word not in ordered:
                visit(MODELS[word])
                ordered[word] = None

    visit(final)
    ctes = ",\n".join(f"{name} as materialized ({MODELS[name].strip()})" for name in ordered)
    return f"with {ctes}\n{final.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_models(final) for name, final in FINAL.items()}
