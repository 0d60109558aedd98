"""The same queries in plain SQL, over the same tables."""

EVENT = "event_id, ts, user_id, event_type, value, props"
NEWEST = "row_number() over (partition by user_id order by ts desc nulls last, event_id desc)"

LATEST = f"select {EVENT} from (select *, {NEWEST} as rn from events) x where rn = 1"
ALL_EVENTS = f"select {EVENT} from events"

SEGMENT_VERSIONS = """
with pol(tbl, retain_days, min_keep) as (
    values ('BUILDING', 30, 5), ('AUTOMOBILE', 7, 2), ('MACHINERY', 7, 1), ('HOUSEHOLD', 7, 1),
           ('FURNITURE', 7, 1), ('ABSENT', 7, 1)
), sn as (
    select c_mktsegment as tbl, o_orderkey as snapshot_id, o_orderdate as committed_at,
           row_number() over (partition by c_mktsegment order by o_orderdate desc, o_orderkey desc) as rk
    from orders join customer on o_custkey = c_custkey
), due as (
    select sn.*, committed_at < (select max(o_orderdate) from orders) - to_days(retain_days) and rk > min_keep as expired
    from sn join pol on sn.tbl = pol.tbl
)
"""

ORACLE: dict[str, str] = {
    "latest_per_entity": LATEST,
    "gold_stream": LATEST,
    "upsert_current": LATEST,
    "table_overwrite": LATEST,
    "latest_as_of": f"""
        select {EVENT} from (
            select *, {NEWEST} as rn from events where ts <= timestamp '2024-01-10 00:00:00'
        ) x where rn = 1""",
    "filter_then_latest": f"""
        select {EVENT} from (
            select e.*, {NEWEST} as rn from events e
            join customer c on e.user_id = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
            where e.event_type = 'click' and n.n_regionkey = 1
        ) x where rn = 1""",
    "latest_then_filter": f"""
        select x.event_id, x.ts, x.user_id, x.event_type, x.value, x.props
        from (select *, {NEWEST} as rn from events) x
        join customer c on x.user_id = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
        where rn = 1 and event_type = 'click' and n.n_regionkey = 1""",
    "last_known_nonnull": f"""
        select user_id, bg_status, value, ts from (
            select *, {NEWEST} as rn
            from (select *, nullif(nullif(event_type, 'error'), 'view') as bg_status from events) y
            where bg_status is not null
        ) x where rn = 1""",
    "latest_line_per_part": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate from (
            select *, row_number() over (partition by l_partkey order by l_shipdate desc nulls last,
                l_orderkey desc, l_linenumber desc, l_suppkey desc, l_quantity desc) as rn
            from lineitem
        ) x where rn = 1""",
    "star_board": """
        select r_name as dest_name, n_name as park_name, c_name as entity_name, event_type as status,
               value as wait_time, ts as last_updated
        from region join nation on r_regionkey = n_regionkey join customer on n_nationkey = c_nationkey
        join events on c_custkey = user_id
        where r_regionkey = 1 and n_nationkey in (1, 6) order by value desc nulls last""",
    "current_board": f"""
        select c_name as entity_name, event_type as status, value as wait_time, ts as last_updated
        from (select *, {NEWEST} as rn from events) x
        join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey
        where rn = 1 and n_nationkey = 1 and c_mktsegment is not null order by value desc nulls last""",
    "catalogued_only": """
        select event_id, user_id, value from events
        where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
    "top_n": "select event_id, value from events order by value desc nulls last, event_id limit 10",
    "where_text": "select event_id, user_id, value from events where event_type = 'view' and value > 10",
    "status_counts": "select event_type as status, count(*) as cnt from events group by event_type order by cnt desc",
    "operating_ratio": """
        select n_name, count(*) filter (where event_type = 'view') as operating, count(*) as total
        from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey
        group by n_name""",
    "fetch_errors": """
        select user_id, count(*) filter (where event_type = 'error') as errors, count(*) as attempts,
               count(*) filter (where event_type = 'error') = 0 as all_ok
        from events group by user_id""",
    "versions_per_entity": """
        select user_id, count(*) as versions, max(ts) as newest, min(ts) as oldest
        from events group by user_id having count(*) > 1""",
    "dedup_counts": "select count(*) as rows_before, count(distinct user_id) as rows_after from events",
    "batch_summary": """
        select cast(ts as date) as batch, count(*) as rows_written, count(distinct user_id) as entities,
               min(ts) as first_ts, max(ts) as last_ts
        from events group by cast(ts as date)""",
    "park_ids": """
        select distinct c_nationkey as park_id from customer
        where c_nationkey is not null and c_nationkey <> 0 order by park_id""",
    "explode_parks": """
        select c_custkey as destination_id, c_name as destination_name, cast(c_nationkey as bigint) as id,
               'Park ' || c_nationkey as name, c_mktsegment as country, 'UTC' as timezone
        from customer where c_nationkey <> 0
        union all
        select c_custkey, c_name, c_custkey + 1000, 'Second of ' || c_name, c_mktsegment, 'UTC' from customer""",
    "destinations_flat": """
        select c_custkey as id, c_name as name, '2024-02-01T03:00:00+00:00' as ingest_timestamp from customer""",
    "land_flatten": """
        select cast(c_nationkey as bigint) as park_id, cast(length(c_mktsegment) as bigint) as land_id,
               c_mktsegment as land_name, c_custkey as id, c_name as name, c_acctbal > 0 as is_open,
               cast(trunc(c_acctbal) as bigint) as wait_time, cast(null as varchar) as last_updated
        from customer
        union all
        select cast(c_nationkey as bigint), null, null, -c_custkey, 'Outside ' || c_name, null, null, null
        from customer""",
    "error_split": """
        select event_id, user_id, event_type <> 'error' as success,
               case when event_type = 'error' then 'HTTP ' || cast(json_extract(props, '$.k') as bigint) end as error
        from events""",
    "quarantine": """
        select event_id,
               case event_type when 'error' then null when 'click' then '<html>busy</html>'
                    else case when event_id % 2 = 0 then '{"rides": [{"id": "none"}]}'
                         else '{"lands": [{"rides": [{"id": 1, "wait_time": "n/a"}]}]}' end end as body,
               case event_type when 'error' then 'HTTP ' || cast(json_extract(props, '$.k') as bigint)
                    when 'click' then 'body is missing or not JSON' else 'body does not fit the schema' end as error
        from events where event_type <> 'view'""",
    "good_rides": """
        select user_id, cast(null as bigint) as land_id, event_id as id, cast(trunc(value) as bigint) as wait_time
        from events where event_type <> 'error'""",
    "normalize_live": """
        select user_id as park_id, cast(null as bigint) as land_id, cast(null as varchar) as land_name,
               event_id as id, event_type as name, 'ATTRACTION' as "entityType",
               case when event_type <> 'error' then event_type = 'view' end as is_open,
               case when event_type = 'view' then 'OPERATING' else 'CLOSED' end as status,
               cast(trunc(value) as bigint) as wait_time, ts as last_updated,
               timestamp '2024-02-01 03:00:00' as ingest_timestamp
        from events""",
    "queue_flatten": """
        select event_id, k as queue_standby_wait, cast(null as bigint) as queue_single_rider_wait,
               k + 1 as queue_paid_standby_wait, event_type as queue_return_time_state,
               replace(cast(ts as varchar), ' ', 'T') || 'Z' as queue_return_time_start,
               cast(null as varchar) as queue_return_time_end, cast(null as varchar) as queue_boarding_group_wait,
               cast(null as varchar) as queue_boarding_group_start, cast(null as varchar) as queue_boarding_group_end,
               case when event_type = 'view' then 'AVAILABLE' end as queue_boarding_group_status,
               cast(null as varchar) as queue_boarding_group_next_alloc
        from (select *, cast(json_extract(props, '$.k') as bigint) as k from events) x""",
    "json_flatten": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "payload_rows": """
        select c_custkey as body_id, c_custkey as id, c_name as name from customer
        where c_mktsegment in ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
        union all
        select c_custkey, c_custkey + 1000, 'other' from customer where c_mktsegment = 'AUTOMOBILE'""",
    "parse_ts": "select event_id, ts as t from events",
    "cast_times": "select event_id, ts as seen_at from events",
    "iso_times": "select event_id, replace(cast(ts as varchar), ' ', 'T') || 'Z' as iso from events",
    "default_missing_key": """
        select event_id, case event_type when 'view' then 'ATTRACTION' when 'click' then null else event_type end
               as entity_type
        from events""",
    "void_columns": """
        select event_id, cast(null as varchar) as note, user_id as id, cast(null as varchar) as tag from events""",
    "json_encode": """
        select cast(to_json({'c_custkey': c_custkey, 'segment': nullif(c_mktsegment, 'BUILDING')}) as varchar) as value
        from customer""",
    "landing_path": """
        select event_id, 'bronze/' || event_type || '/' || strftime(ts, '%Y/%m/%d/%H%M%S') || '.jsonl.gz' as path
        from events""",
    "union_missing": """
        select c_custkey as id, c_name as name, c_acctbal as acctbal, c_mktsegment as segment,
               cast(null as int) as size
        from customer
        union all
        select p_partkey, p_name, null, null, p_size from part""",
    "latest_batch": """
        select event_id, user_id, cast(ts as date) as batch from events
        where cast(ts as date) = (
            select max(cast(ts as date)) from events where cast(ts as date) <= date '2024-01-15')""",
    "pick_snapshot_rows": """
        select event_id, user_id from events where cast(ts as date) <= (
            select min(b) from (select distinct cast(ts as date) as b from events order by b desc limit 5) x)""",
    "snapshots": """
        select batch, lag(batch) over (order by batch) as parent, added,
               cast(sum(added) over (order by batch rows between unbounded preceding and current row) as bigint) as total
        from (select cast(ts as date) as batch, count(*) as added from events group by 1) x""",
    "snapshots_per_table": """
        select l_returnflag, batch, lag(batch) over w as parent, added, cast(sum(added) over w as bigint) as total
        from (select l_returnflag, cast(l_shipdate as date) as batch, count(*) as added from lineitem group by 1, 2) x
        window w as (partition by l_returnflag order by batch rows between unbounded preceding and current row)""",
    "expire_report": SEGMENT_VERSIONS + """
        select pol.tbl, x.snapshots_before, x.snapshots_after, x.expired,
               case when x.tbl is null then 'skipped' else 'ok' end as status
        from pol left join (
            select tbl, count(*) as snapshots_before, count(*) filter (where not expired) as snapshots_after,
                   count(*) filter (where expired) as expired
            from due group by tbl
        ) x on pol.tbl = x.tbl""",
    "expire_plan": SEGMENT_VERSIONS + "select tbl, snapshot_id, committed_at from due where expired",
    "bronze_retention": """
        select prefix, count(*) as files, count(*) filter (where batch < max_b - keep) as expired
        from (
            select event_type as prefix, cast(ts as date) as batch, max(cast(ts as date)) over () as max_b,
                   case when event_type = 'view' then 30 else 7 end as keep
            from events
        ) x group by prefix""",
    "bronze_roundtrip": ALL_EVENTS,
    "silver_stream": ALL_EVENTS,
    "live_files": """
        select event_id as id, case when event_type = 'view' then 'ATTRACTION' else event_type end as "entityType",
               cast(trunc(value) as bigint) as wait_time, ts as ingest_timestamp
        from events""",
    "csv_roundtrip": """
        select acctbal, id, name, segment, size from (
            select c_custkey as id, c_name as name, c_acctbal as acctbal, c_mktsegment as segment,
                   cast(null as int) as size
            from customer
            union all select p_partkey, p_name, null, null, null from part
            union all select p_partkey, null, null, null, p_size from part where p_size is not null
        ) x""",
    "table_history": """
        select 'append' as operation, count(*) as rows from events where ts <= timestamp '2024-01-10 00:00:00'
        union all select 'append', count(*) from events where ts > timestamp '2024-01-10 00:00:00'
        union all select 'overwrite', count(distinct user_id) from events""",
    "table_as_of": "select * from events where ts <= timestamp '2024-01-10 00:00:00'",
    "star_repeated": "select d.n_name as n_name_first, d.* from nation as d where n_regionkey = 1",
    "clustered_as_of": f"""
        select {EVENT} from (
            select *, {NEWEST} as rn from events where ts <= timestamp '2024-01-10 00:00:00'
        ) x where rn = 1""",
    "colocated_board": f"""
        select user_id, c_name, event_id, event_type, value from (select *, {NEWEST} as rn from events) x
        join customer on user_id = c_custkey where rn = 1 and c_mktsegment = 'BUILDING'""",
    "table_widened": """
        select event_id, user_id as "user", case when ts <= timestamp '2024-01-10 00:00:00' then event_type end as kind,
               case when ts > timestamp '2024-01-10 00:00:00' then value end as value
        from events""",
    "mixed_bodies": """
        with n as (
            select count(*) filter (where event_type = 'view') as v, count(*) filter (where event_type = 'click') as c,
                   count(*) filter (where event_type not in ('view', 'click', 'error')) as o
            from events)
        select path, kind, rows, 'OBJECT<at: OBJECT<x: VARIANT>, id: VARIANT, tags: ARRAY<VARIANT>, wait: VARIANT>' as merged
        from (
            select '$' as path, 'OBJECT' as kind, v + c + o as rows from n
            union all select '$.id', 'BIGINT', v + o from n union all select '$.id', 'STRING', c from n
            union all select '$.wait', 'BIGINT', v from n union all select '$.wait', 'VOID', c from n
            union all select '$.wait', 'STRING', o from n union all select '$.tags', 'ARRAY', v from n
            union all select '$.tags[]', 'STRING', v from n union all select '$.tags[]', 'BIGINT', v from n
            union all select '$.at', 'OBJECT', c + o from n union all select '$.at.x', 'DECIMAL', c from n
            union all select '$.at.x', 'BOOLEAN', o from n) where rows > 0""",
    "stored_board": f"""
        select user_id, c_name as entity_name, event_type as status, value as wait_time,
               row_number() over (order by value desc nulls last, user_id) as position
        from (select *, {NEWEST} as rn from events) x join customer on user_id = c_custkey where rn = 1""",
    "stream_progress": """
        select 0::bigint as failures, count(*) as rows, (count(*) - count(ts))::bigint as without_time from events""",
    "board_positions": """
        select event_id, value, row_number() over (order by value desc nulls last, event_id) as position from events""",
    "landing_report": """
        select user_id as park_id,
               case event_type when 'error' then 'HTTP ' || cast(json_extract(props, '$.k') as bigint)
                    when 'click' then 'body is missing or not JSON' else 'ride' end as what,
               count(*) as rows, (select count(*) from events) as attempts,
               (select count(*) from events where event_type in ('error', 'click')) as failures
        from events group by all""",
    "partitioned_parquet": "select * from lineitem",
    "table_append": """
        select event_id, ts, user_id, event_type,
               case when ts <= timestamp '2024-01-10 00:00:00' then value end as value,
               case when ts > timestamp '2024-01-10 00:00:00' then props end as props
        from events""",
}
