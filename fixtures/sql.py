"""Inputs as SQL that Spark and DuckDB both run on the given tables.

``$events``, ``$customer`` and ``$supplier`` stand for the tables. The texts
cover whole tables; ``%`` only decides what kind of row an input row becomes.
"""

from __future__ import annotations

from string import Template

_NUMBERED = """(
    select *, cast(regexp_extract(props, '[0-9]+', 0) as int) as k, cast(event_id % 97 as int) as f
    from $events
) e"""

# Canonical events, as the summary and the analyses read them.
WORK_ORDER_EVENTS = """
select 'E' || cast(event_id as string) as event_id,
    'W' || cast(user_id as string) || '-' || cast(event_id % 10 as string) as work_order_id,
    'C' || cast(user_id % 8 as string) as client_id,
    case k % 6 when 0 then 'OPENED' when 1 then 'ASSIGNED' when 2 then 'WORK_STARTED'
        when 3 then 'WORK_COMPLETED' when 4 then 'REOPENED' else 'CLOSED' end as event_type,
    ts as event_timestamp_utc,
    ts + (k % 3) * interval '1' hour as updated_at_utc,
    case when k % 7 = 0 then null else 'P' || cast(1 + k % 4 as string) end as priority,
    case when k % 10 = 0 then null else 'T' || cast(k % 40 as string) end as technician_id,
    case when k % 11 = 0 then null else 'S' || cast(user_id as string) end as store_id,
    case when k % 6 = 3 and k % 5 <> 0 then cast(floor(value) as bigint) end as labor_minutes
from """ + _NUMBERED

# Lines of event files. ``f`` selects the fault a line has; keys are sorted and
# nothing is padded, so the canonical payload is the line itself. Event ids
# repeat in pairs, which makes versions.
EVENT_LINES = """
select 'work_order_events_0' || cast(1 + event_id % 3 as string) || '.jsonl' as source_file,
    cast((event_id - event_id % 3) / 3 + 1 as bigint) as source_row_number,
    f,
    case when f = 1 then 'not-json' when f = 2 then '' when f = 3 then '[1]' else
    '{"client_id":"C' || cast(user_id % 8 as string) || '",'
    || case when f = 4 then ''
        else '"event_id":"E' || cast(event_id - event_id % 5 % 2 as string) || '",' end
    || '"event_timestamp":"' || case when f = 5 then 'garbage'
        else replace(substr(cast(ts as string), 1, 19), ' ', 'T') || 'Z' end || '",'
    || '"event_type":"' || case when f = 6 then 'EXPLODED' else
        case k % 6 when 0 then 'opened' when 1 then 'ASSIGNED' when 2 then 'WORK_STARTED'
            when 3 then 'WORK_COMPLETED' when 4 then 'REOPENED' else 'CLOSED' end end || '",'
    || '"labor":{"minutes":' || case when f = 7 then '-5' when f = 8 then '1.5'
        else cast(k as string) end || '},'
    || '"location":{"region":"R1","store_id":"S'
        || case when f = 9 then '-1' else cast(user_id as string) end || '"},'
    || case when f between 12 and 19 then '"meter":' || case f when 12 then '1e1' when 13 then '10.0' when 14 then '10'
        when 15 then '[1.0,1]' when 16 then '[1,1.0]' when 17 then '1000E-2' when 18 then '"1e1"'
        else '123456789012345678901234567890123456789012' end || ',' else '' end
    || '"priority":"' || case when f = 10 then 'P9' else 'p' || cast(1 + k % 4 as string) end || '",'
    || '"technician":{"id":"T' || case when f = 11 then '-1' else cast(k % 40 as string) end || '"},'
    || '"updated_at":"'
        || replace(substr(cast(ts + (k % 3) * interval '1' hour as string), 1, 19), ' ', 'T') || 'Z",'
    || '"work_order_id":"W' || cast(user_id as string) || '-' || cast(event_id % 10 as string) || '"}'
    end as raw
from """ + _NUMBERED

# The canonical text of a line: floats as their doubles print.
CANONICAL = """replace(replace(raw, '"meter":1e1', '"meter":10.0'), '"meter":1000E-2', '"meter":10.0')"""

# How a stored payload prints: as a variant, which keeps no fraction of zero
# and no more than 38 digits.
STORED = """replace(replace(replace(replace(replace(raw, '"meter":10.0', '"meter":10'), '"meter":1e1', '"meter":10.0'),
    '"meter":1000E-2', '"meter":10.0'), '1.0', '1'), '123456789012345678901234567890123456789012', '1.2345678901234568E41')"""

# Rows of the store file: some without key or with a bad flag, some repeating
# the key of the row before or after, some padded, in need of quotes or of two lines.
STORE_ROWS = """
select 'stores.csv' as source_file,
    cast(c_custkey + 2 as bigint) as source_row_number,
    case when c_custkey % 50 = 1 then ' '
        when c_custkey % 50 = 3 then 'S' || cast(c_custkey + 1 as string)
        when c_custkey % 50 = 6 then ' S' || cast(c_custkey - 1 as string)
        else 'S' || cast(c_custkey as string) end as store_id,
    'C' || cast(c_custkey % 8 as string) as client_id,
    cast(2000 + c_custkey as string) as store_number,
    case when c_custkey % 7 = 0 then ' ' || c_mktsegment || ', "A" '
        when c_custkey % 11 in (0, 2) then c_mktsegment || chr(10) || 'annex' else c_mktsegment end as region,
    case when c_custkey % 50 = 2 then 'MAYBE' when c_custkey % 2 = 0 then 'TRUE' else 'false' end
        as active_flag
from $customer
"""

TECHNICIAN_ROWS = """
select 'technicians.csv' as source_file,
    cast(s_suppkey + 2 as bigint) as source_row_number,
    case when s_suppkey % 50 = 1 then '' else 'T' || cast(s_suppkey as string) end as technician_id,
    s_name as technician_name,
    'N' || cast(s_nationkey as string) as home_region,
    case when s_suppkey % 50 = 2 then 'MAYBE' when s_suppkey % 8 = 0 then 'FALSE' else 'TRUE' end
        as active_flag
from $supplier
"""

# Two sets of versions that overlap in events: stored ones and a later batch,
# where some repeated versions have another payload.
_VERSIONS = """
select 'E' || cast(event_id - event_id % 2 as string) as event_id,
    event_type,
    ts + (k % 3) * interval '1' hour as updated_at_utc,
    md5(cast(k as string) || mark) as payload_hash,
    'events' as source_file,
    event_id as source_row_number,
    ts as first_seen_at,
    ts as last_seen_at
from (select *, event_id - event_id % 2 as pair, MARK as mark from """ + _NUMBERED + """) v
where """
MERGE_TARGET = _VERSIONS.replace("MARK", "''") + "event_id % 2 = 0 and pair % 14 <> 0"
MERGE_SOURCE = (
    _VERSIONS.replace("MARK", "case when event_id % 20 = 4 then 'x' else '' end")
    + "(event_id % 2 = 1 or event_id % 10 = 4) and pair % 22 <> 0"
)


def on(text: str, **tables: str) -> str:
    """``text`` with the tables' names, or by default their own names."""
    names = {"events": "events", "customer": "customer", "supplier": "supplier"}
    return Template(text).substitute(names | tables)
