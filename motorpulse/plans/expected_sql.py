"""The registered queries in SQL for another engine, over the same tables."""

from __future__ import annotations

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

# Telemetry, dimensions and what the messages of mixed quality hold.
BASE = f"""
with k as (
  select *, cast(json_extract_string(props, '$.k') as int) as k from events
),
tel as (
  select event_type, ts,
         cast(event_id as varchar) as event_id,
         {ISO} || '+00:00' as event_time,
         cast(user_id as int) as car_id,
         cast(floor(value) as int) as speed,
         cast(k * 80 as int) as rpm,
         cast(k % 7 + 1 as int) as gear
  from k
),
mixed as (
  select event_type, ts,
         case when event_type <> 'error' then event_id end as event_id,
         case event_type
           when 'view' then 'garbage'
           when 'purchase' then {ISO.replace('ts,', 'ts + interval 2 hour,')} || '+02:00'
           when 'click' then event_time
         end as event_time,
         case event_type
           when 'purchase' then ts
           when 'click' then ts
         end as event_ts,
         case when event_type <> 'error' then car_id end as car_id,
         case when event_type <> 'error' then speed end as speed,
         case when event_type <> 'error' then rpm end as rpm,
         case when event_type <> 'error' then gear end as gear
  from tel
),
all_cars as (
  select cast(c_custkey as int) as car_id,
         cast(c_custkey + 100000000 as int) as driver_id,
         c_nationkey as model_id,
         cast(c_custkey % 5 as int) as color_id,
         c_acctbal
  from customer
),
cars as (select car_id, driver_id, model_id, color_id from all_cars where c_acctbal >= 0),
models as (
  select n_nationkey as model_id, 'BRAND_' || n_regionkey as brand_name, n_name as model_name
  from nation where n_nationkey < 20
),
colors as (select r_regionkey as color_id, r_name as color_name from region),
en as (
  select tel.event_id, event_time, tel.car_id, speed, rpm, gear, driver_id,
         brand_name, model_name, color_name, cast(round(speed / 30.0) as int) as expected_gear
  from tel
  left join cars on cars.car_id = tel.car_id
  left join models on models.model_id = cars.model_id
  left join colors on colors.color_id = cars.color_id
),
al as (
  select en.*, tel.ts from en join tel using (event_id)
  where en.speed > 120 or expected_gear <> en.gear or en.rpm > 6000
),
slid as (
  select date_trunc('minute', ts) - to_minutes(g.m) as window_start, al.*
  from al, (select unnest(range(0, 15)) as m) g
),
windows as (
  select window_start, window_start + interval 15 minute as window_end,
         count(*) as num_of_rows,
         cast(count(*) filter (where lower(color_name) = 'asia') as bigint) as num_of_asia,
         cast(count(*) filter (where lower(color_name) = 'europe') as bigint) as num_of_europe,
         cast(count(*) filter (where lower(color_name) = 'africa') as bigint) as num_of_africa,
         max(speed) as maximum_speed, max(gear) as maximum_gear, max(rpm) as maximum_rpm
  from slid group by 1, 2
)
"""

RAW = "event_id, event_time, car_id, speed, rpm, gear"
ENRICHED = RAW + ", driver_id, brand_name, model_name, color_name, expected_gear"

LATEST = "select * from windows order by window_end desc limit 1"
PASSED = """
select * from windows
where window_end <= (select max(ts) - interval 20 minute from al)
"""

_BODIES: dict[str, str] = {
    "dimension_scan": "select * exclude (c_acctbal) from all_cars",
    "topic_union": """
        select 'anomaly-alerts' as topic, event_id, car_id from tel where event_type = 'error'
        union all
        select 'alert-data' as topic, event_id, car_id from tel where event_type <> 'error'
    """,
    "literal_colors": """
        select color_name, count(*) as cars
        from all_cars as cars left join (values (1, 'Black'), (2, 'Red'), (3, 'Gray'), (4, 'White'),
                                    (5, 'Green'), (6, 'Blue'), (7, 'Pink')) as c(id, color_name)
          on c.id = cars.car_id % 7 + 1
        group by 1
    """,
    "dimension_written_and_read": "select * exclude (c_acctbal) from all_cars",
    "dimension_preview": "select * exclude (c_acctbal) from all_cars order by car_id limit 20",
    "distinct_cars": "select distinct car_id from tel",
    "pruned_columns": "select event_id, car_id, speed from tel",
    "renamed_models": "select n_nationkey as model_id, n_name as model_name from nation",
    "computed_columns": "select event_id, speed, expected_gear from en",
    "decoded_messages": f"select {RAW} from mixed",
    "quarantined_messages": f"""
        select case when event_type = 'error'
                    then substr('{{"event_id":"' || tel.event_id || '","event_time":"', 1, 20)
               end as malformed,
               mixed.event_id, mixed.event_time, mixed.car_id, mixed.speed, mixed.rpm, mixed.gear
        from tel join mixed using (ts, event_type)
    """,
    "readable_messages": f"select {RAW} from mixed where event_type <> 'error'",
    "encoded_messages": """
        select '{' || concat_ws(',',
            '"event_id":"' || event_id || '"',
            '"event_time":"' || event_time || '"',
            '"car_id":' || car_id,
            '"speed":' || speed,
            '"rpm":' || rpm,
            '"gear":' || gear,
            '"driver_id":' || driver_id,
            '"brand_name":"' || brand_name || '"',
            '"model_name":"' || model_name || '"',
            '"color_name":"' || color_name || '"',
            '"expected_gear":' || expected_gear) || '}' as value
        from en
    """,
    "recoded_messages": f"select {ENRICHED} from en",
    "field_faults": """
        , sent as (
          select event_id, case event_type
                   when 'view' then json_object('car_id', car_id, 'speed', cast(speed as varchar), 'rpm', rpm, 'gear', gear)
                   when 'signup' then json_object('car_id', car_id > 0, 'speed', speed, 'rpm', rpm, 'gear', gear + 0.5)
                   when 'purchase' then json_object('car_id', car_id, 'speed', speed, 'rpm', rpm + 3000000000, 'gear', gear)
                   when 'click' then json_object('car_id', car_id, 'speed', speed, 'rpm', null, 'gear', [gear])
                   else json_object('car_id', car_id, 'speed', speed, 'rpm', null, 'gear', [gear])
                 end as message
          from tel where event_type <> 'error'
        ), fields as (
          select event_id, field, json_type(message, '$.' || field) as type,
                 json_extract_string(message, '$.' || field) as found
          from sent, (select unnest(['car_id', 'speed', 'rpm', 'gear']) as field) f
        )
        select event_id, field, found,
               case type when 'VARCHAR' then 'text' when 'BOOLEAN' then 'boolean' when 'DOUBLE' then 'fraction'
                         when 'ARRAY' then 'list' when 'OBJECT' then 'object' else 'integer' end as kind
        from fields
        where type <> 'NULL' and (type not in ('UBIGINT', 'BIGINT') or cast(found as hugeint) > 2147483647)
    """,
    "window_fields": """
        select event_id, date_trunc('minute', ts) as window_start,
               date_trunc('minute', ts) + interval 1 minute as window_end
        from tel
    """,
    "alert_flags": """
        select event_id,
               speed > 120 or cast(round(speed / 30.0) as int) <> gear or rpm > 6000 as is_alert
        from mixed
    """,
    "timed_events": "select event_id, event_ts from mixed where event_ts is not null",
    "event_times": """
        select cast(event_id as bigint) as event_id,
               case event_type when 'purchase' then ts when 'click' then ts
                               when 'error' then cast(date_trunc('day', ts) as timestamp)
               end as event_ts
        from tel
    """,
    "event_times_or_arrival": "select event_id, coalesce(event_ts, ts) as event_ts from mixed",
    "normalized_colors": """
        select event_id, lower(coalesce(color_name, brand_name)) as color_norm from en
    """,
    "joined_cars": """
        select event_id, tel.car_id, driver_id, model_id, color_id
        from tel left join cars on cars.car_id = tel.car_id
    """,
    "joined_models": """
        select event_id, cars.model_id, brand_name, model_name
        from tel left join cars on cars.car_id = tel.car_id
        left join models on models.model_id = cars.model_id
    """,
    "joined_colors": """
        select event_id, cars.color_id, color_name
        from tel left join cars on cars.car_id = tel.car_id
        left join colors on colors.color_id = cars.color_id
    """,
    "car_profiles": """
        select car_id, driver_id, brand_name, model_name, color_name
        from cars
        left join models on models.model_id = cars.model_id
        left join colors on colors.color_id = cars.color_id
    """,
    "enriched": f"select {ENRICHED} from en",
    "enriched_by_size": f"select {ENRICHED} from en",
    "enriched_salted": f"select {ENRICHED} from en",
    "enriched_with_hot_keys": f"select {ENRICHED} from en",
    "rows_per_model": "select model_name, count(*) as num_of_rows from en group by 1",
    "colors_per_model": """
        select model_name,
               cast(sum(case when lower(color_name) = 'asia' then 1 else 0 end) as bigint)
                 as num_of_asia,
               cast(sum(case when lower(color_name) = 'europe' then 1 else 0 end) as bigint)
                 as num_of_europe,
               cast(sum(case when lower(color_name) = 'africa' then 1 else 0 end) as bigint)
                 as num_of_africa
        from en group by 1
    """,
    "maxima_per_model": """
        select model_name, max(speed) as maximum_speed, max(gear) as maximum_gear,
               max(rpm) as maximum_rpm
        from en group by 1
    """,
    "events_per_car": "select car_id, count(*) as count from tel group by 1",
    "one_event_per_car": """
        select car_id, speed, gear, rpm from (
          select *, row_number() over (partition by car_id order by speed, gear, rpm) as n
          from tel)
        where n = 1
    """,
    "repeated_cars": "select car_id, count(*) as count from tel group by 1 having count(*) > 1",
    "alerts": f"select {ENRICHED} from al",
    "alert_windows": "select * from windows",
    "alert_windows_direct": "select * from windows",
    "alert_windows_uneven": """
        , uneven as (
          select make_timestamp((epoch_us(ts) // 240000000 - g.m) * 240000000) as window_start, al.*
          from al, (select unnest(range(0, 3)) as m) g
        )
        select window_start, window_start + interval 10 minute as window_end, count(*) as num_of_rows,
               cast(count(*) filter (where lower(color_name) = 'asia') as bigint) as num_of_asia,
               cast(count(*) filter (where lower(color_name) = 'europe') as bigint) as num_of_europe,
               cast(count(*) filter (where lower(color_name) = 'africa') as bigint) as num_of_africa,
               max(speed) as maximum_speed, max(gear) as maximum_gear, max(rpm) as maximum_rpm
        from uneven where ts < window_start + interval 10 minute group by 1, 2
    """,
    "message_windows": """
        , arrived as (select coalesce(event_ts, ts) as t, speed, gear, rpm from mixed)
        select date_trunc('minute', t) - to_minutes(g.m) as window_start,
               date_trunc('minute', t) - to_minutes(g.m) + interval 15 minute as window_end,
               count(*) as num_of_rows,
               cast(0 as bigint) as num_of_black,
               cast(0 as bigint) as num_of_white,
               cast(0 as bigint) as num_of_silver,
               max(speed) as maximum_speed, max(gear) as maximum_gear, max(rpm) as maximum_rpm
        from arrived, (select unnest(range(0, 15)) as m) g
        group by 1, 2
    """,
    "latest_window": LATEST,
    "latest_closed_window": """
        select * from windows
        where window_end <= (select date_trunc('minute', max(ts)) + interval 1 minute from al)
        order by window_end desc limit 1
    """,
    "dimension_versions": """
        , versions as (
          select 1 as version, car_id, driver_id, model_id, color_id from cars
          union all select 2, car_id, driver_id, model_id, color_id from all_cars
          union all select 3, car_id, driver_id + 1, model_id, color_id from all_cars
        )
        select version, count(*) as cars, count(brand_name) as known_models,
               count(color_name) as known_colors, cast(sum(driver_id) as bigint) as drivers
        from versions
        left join models on models.model_id = versions.model_id
        left join colors on colors.color_id = versions.color_id
        group by 1
    """,
    "enriched_from_store": f"select {ENRICHED} from en",
    "streamed_messages": f"select {RAW} from tel",
    "streamed_enrichment": f"select {ENRICHED} from en",
    "streamed_refresh": f"""
        select event_id, mixed.event_time, en.car_id, en.speed, en.rpm, en.gear, driver_id,
               brand_name, model_name, color_name, expected_gear, null as malformed
        from mixed join en using (event_id)
        union all
        select null, null, null, null, null, null, null, null, null, null, null,
               substr('{{"event_id":"' || event_id || '","event_time":"' || strftime(ts, '%Y-%m-%d'), 1, 20)
        from tel where event_type = 'error'
    """,
    "streamed_versions": f"""
        select {RAW}, cast(driver_id + cast(event_id as bigint) % 4 as int) as driver_id,
               brand_name, model_name, color_name, expected_gear
        from en
    """,
    "streamed_once": f"select {ENRICHED} from en",
    "streamed_alerts": f"select {ENRICHED} from al",
    "streamed_strays": f"select cast(event_id as bigint) % 7 in (0, 1) as stray, {ENRICHED} from al",
    "streamed_windows_complete": "select * from windows",
    "streamed_windows_update": "select * from windows",
    "streamed_windows_append": PASSED,
    "streamed_windows_append_panes": PASSED,
    "streamed_latest_window": LATEST,
    "streamed_latest_window_bounded": LATEST,
    "streamed_panes": "select * from windows",
    "streamed_late": """
        , bounds as (
          select min(ts) + (max(ts) - min(ts)) * 0.75 as edge from events
        ), newest as (
          select max(al.ts) - interval 20 minute as behind from al, bounds where al.ts > edge
        ), placed as (
          select speed, al.ts <= edge and al.ts < behind as late from al, bounds, newest
        )
        select cast(count(*) filter (where not late) as bigint) as counted,
               max(speed) filter (where not late) as maximum_speed,
               count(*) filter (where late) as late
        from placed
    """,
    "chained_topics": "select * from windows",
}

EXPECTED_SQL: dict[str, str] = {name: BASE + body for name, body in _BODIES.items()}
