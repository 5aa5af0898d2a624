"""The registered queries in the SQL of an independent engine, on the same tables."""

from __future__ import annotations

_SALES_COLUMNS = """
  cast(event_id as varchar) as event_id,
  event_id as num,
  'acct_' || lpad(cast(user_id as varchar), 4, '0') as account_id,
  case when event_id % 10 <> 3 then 'user_' || lpad(cast(user_id as varchar), 5, '0') end as user_id,
  case when event_type = 'signup' then 'subscription_created' when event_type = 'purchase' then 'upgrade'
       when event_type <> 'error' then 'renewal' when event_id % 3 = 0 then 'chargeback' else 'refund' end
    as event_type,
  case when event_id % 101 = 0 then null when event_id % 103 = 0 then 'gold'
       when (event_id * 13) % 20 < 4 then 'free' when (event_id * 13) % 20 < 17 then 'pro'
       else 'enterprise' end as plan_tier,
  case when event_id % 107 = 0 then 'XX' when user_id % 20 < 9 then 'NA' when user_id % 20 < 14 then 'EU'
       when user_id % 20 < 18 then 'LATAM' else 'APAC' end as region,
  case when user_id % 10 < 7 then 'USD' when user_id % 10 < 9 then 'CAD' else 'EUR' end as currency,
  case when event_id % 109 = 0 then cast(0 as double) when event_id % 113 = 0 then null
       when event_type = 'error' then -value else value end as amount,
  case when event_id % 20 < 9 then 'web' when event_id % 20 < 13 then 'mobile'
       when event_id % 20 < 16 then 'backend' else 'billing' end as source,
  case when event_id % 5 <> 0 then 'trace_' || cast(event_id as varchar) end as trace_id,
  ts as ingest_ts,
  cast(user_id % 3 as int) as kafka_partition,
  copy"""

_OFFSET = "(epoch_us(kafka_ingest_ts) - epoch_us(timestamp '2024-01-01')) * 2 + copy as kafka_offset"

_SALES = f"""
with resent as (
  select *, 0 as copy from events
  union all
  select *, 1 as copy from events where event_id % 50 = 0),
rows_sent as (
  select {_SALES_COLUMNS},
    case when event_id % 20 = 0 then ts - to_seconds(cast(5 + (event_id * 7919) % 596 as int)) else ts end
      as event_ts,
    ts as kafka_ingest_ts,
    cast(floor(date_diff('second', timestamp '2024-01-01', ts) / 259200) as bigint) as batch_id
  from resent),
sales as (select *, {_OFFSET} from rows_sent),
silver as (
  select * from (
    select *, row_number() over (partition by event_id order by kafka_ingest_ts, kafka_offset) as rn from sales
  ) t where rn = 1)"""

_FLAGS = """,
flags as (
  select *,
    (event_id is null or event_ts is null or amount is null or region is null or plan_tier is null
      or currency is null or ingest_ts is null) as n,
    (plan_tier not in ('free', 'pro', 'enterprise') or region not in ('NA', 'EU', 'LATAM', 'APAC')
      or currency not in ('USD', 'CAD', 'EUR')) as d,
    (amount is null or amount = 0 or isnan(amount)) as a,
    epoch(date_trunc('second', ingest_ts)) - epoch(date_trunc('second', event_ts)) > 300 as l
  from {source})"""

_COUNTERS = """
  count(*) as total_records,
  cast(greatest(count(*) - sum(cast((n or d or a) as int)), 0) as bigint) as valid_records_estimate,
  cast(sum(cast(n as int)) as bigint) as null_required_fields,
  cast(coalesce(sum(cast(d as int)), 0) as bigint) as invalid_domain_values,
  cast(sum(cast(a as int)) as bigint) as bad_amounts,
  cast(coalesce(sum(cast(l as int)), 0) as bigint) as latency_sla_breaches"""

_REASON = """concat_ws('|', case when n then 'NULL_REQUIRED' end, case when d then 'INVALID_DOMAIN' end,
  case when a then 'BAD_AMOUNT' end, case when l then 'LATENCY_SLA_BREACH' end)"""


def _gold(source: str, dims: str = "region, plan_tier", where: str = "") -> str:
    """Gold rows; the sum is left as it is, so that later sums do not add up rounded numbers."""
    return f"""select time_bucket(interval 5 minute, event_ts) as window_start,
    time_bucket(interval 5 minute, event_ts) + interval 5 minute as window_end,
    {dims}, sum(amount) as revenue, count(*) as event_count
  from {source} {where} group by window_start, window_end, {dims}"""


_GOLD_OUT = "window_start, window_end, region, plan_tier, round(revenue, 2) + 0.0 as revenue, event_count"

_LATENCY = """
select time_bucket(interval 5 minute, event_ts) as window_start,
  time_bucket(interval 5 minute, event_ts) + interval 5 minute as window_end,
  count(*) as event_count, round(avg(s), 4) as avg_latency_seconds, max(s) as max_latency_seconds,
  cast(sum(cast(s > 300 as int)) as bigint) as latency_sla_breaches
from (select *, cast(epoch(date_trunc('second', ingest_ts)) - epoch(date_trunc('second', event_ts)) as bigint)
      as s from silver) t
group by 1, 2"""

# What is wrong with a record of the poisoned scenario, in the order in which it is noticed.
_POISON = """,
frames as (
  select *,
    case when num % 211 = 0 then 'NULL_VALUE' when num % 223 = 0 or num % 227 = 0 then 'BAD_FRAME'
         when num % 233 = 0 and num % 229 <> 0 then 'BAD_PAYLOAD'
         when num % 229 = 0 then 'UNKNOWN_SCHEMA'
         when num % 239 = 0 then 'NO_EVENT_ID' when num % 241 = 0 then 'BAD_EVENT_TIME' end as reason,
    case when num % 211 = 0 or num % 223 = 0 or num % 227 = 0 then null when num % 229 = 0 then 999
         else 1 end as schema_id,
    case when num % 211 = 0 then null else not (num % 223 = 0 or num % 227 = 0) end as frame_ok
  from sales),
bronze as (
  select *, (reason is null or reason in ('NO_EVENT_ID', 'BAD_EVENT_TIME')) as typed from frames)"""

_ERRORS = """case reason when 'NULL_VALUE' then 'record has no value'
  when 'BAD_FRAME' then 'invalid_confluent_wire_format'
  when 'UNKNOWN_SCHEMA' then 'schema id is not registered'
  when 'BAD_PAYLOAD' then 'body does not decode with its schema'
  when 'NO_EVENT_ID' then 'event_id is missing'
  when 'BAD_EVENT_TIME' then 'event_time is missing or not a timestamp' end"""

_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"

_TYPED_FIELDS = ["account_id", "user_id", "event_type", "plan_tier", "region", "currency", "amount", "source",
                 "trace_id"]

_BAD_TIME = "num % 241 = 0"

# The replay scenario: slices by arrival, of ten days. A row is late if its event time is at or below the
# watermark after the slice before its own.
def _replay(slice_seconds: int = 864000) -> str:
    return f"""
with resent as (
  select *, 0 as copy from events
  union all
  select *, 1 as copy from events where event_id % 50 = 0 or event_id % 40 = 7),
arrivals as (
  select {_SALES_COLUMNS},
    case when event_id % 40 = 7 then ts - to_seconds(8 * 86400)
         when event_id % 20 = 0 then ts - to_seconds(cast(5 + (event_id * 7919) % 596 as int)) else ts end
      as event_ts,
    ts + to_seconds(cast(copy * 7200 as int)) as kafka_ingest_ts
  from resent),
sliced as (
  select *, {_OFFSET}, cast(floor(date_diff('second', timestamp '2024-01-01', kafka_ingest_ts) / {slice_seconds}) as int) as b
  from arrivals),
newest as (select b, max(event_ts) as mx from sliced group by b),
marks as (
  select b, date_trunc('millisecond', max(mx) over (order by b)) - interval 10 minute as w from newest),
late_marks as (select n.b, (select max(w) from marks where marks.b < n.b) as late_w from newest n),
on_time as (
  select s.* from sliced s join late_marks using (b) where late_w is null or event_ts > late_w),
kept as (
  select * from (
    select *, row_number() over (partition by event_id order by kafka_ingest_ts) as rn from on_time
  ) t where rn = 1)"""


_REPLAY = _replay()

_REPLAYED_RANGE = """window_start >= timestamp '2024-01-10'
  and window_end <= timestamp '2024-01-20' - interval 10 minute"""

_PRODUCTION_AND_REPLAY = f""",
production as ({_gold('sales')}),
replayed_silver as (
  select * from (
    select *, row_number() over (partition by event_id order by kafka_ingest_ts, kafka_offset) as rn2
    from sales where kafka_ingest_ts >= timestamp '2024-01-10' and kafka_ingest_ts < timestamp '2024-01-20'
  ) t where rn2 = 1),
replay as (
  select * from ({_gold('replayed_silver')}) t where {_REPLAYED_RANGE})"""


_DIFF = """
select coalesce(p.window_start, r.window_start) as window_start,
  case when p.event_count is not null then p.region else r.region end as region,
  case when p.event_count is not null then p.plan_tier else r.plan_tier end as plan_tier,
  round(p.revenue, 2) + 0.0 as revenue_production, round(r.revenue, 2) + 0.0 as revenue_replay,
  p.event_count as events_production, r.event_count as events_replay,
  case when r.event_count is null then 'only_production' when p.event_count is null then 'only_replay'
       when p.event_count <> r.event_count or (p.revenue is null) <> (r.revenue is null)
         or abs(p.revenue - r.revenue) > 0.005 then 'changed' else 'same' end as status
from production p full outer join replay r
  on p.window_start = r.window_start and p.region is not distinct from r.region
  and p.plan_tier is not distinct from r.plan_tier"""

# The middle of the latency bucket of a rank: one bucket a second below 64, then 32 for each power of two.
_MIDDLE = """case when abs(s) < 64 then s else cast(sign(s) * (
  (abs(s) >> (length(bin(abs(s))) - 6) << (length(bin(abs(s))) - 6)) + (1 << (length(bin(abs(s))) - 6)) // 2) as bigint) end"""


def _totals(side: str) -> str:
    return f"""select '{side}' as side, count(*) as gold_rows,
  cast(coalesce(sum(event_count), 0) as bigint) as event_count, round(sum(revenue), 2) + 0.0 as revenue,
  min(window_start) as first_window, max(window_start) as last_window from {side}"""


def _decoded_columns() -> str:
    fields = ",\n  ".join(f"case when typed then {name} end as {name}" for name in _TYPED_FIELDS)
    return f"""account_key as kafka_key, kafka_ingest_ts, kafka_partition, kafka_offset,
  case when typed and num % 239 <> 0 then event_id end as event_id,
  case when typed then case when {_BAD_TIME} then 'not a time' else {_ISO.format('event_ts')} end end as event_time,
  case when typed then {_ISO.format('ingest_ts')} end as ingest_time,
  {fields},
  case when typed then 1 end as schema_version,
  case when typed and not ({_BAD_TIME}) then event_ts end as event_ts,
  case when typed then ingest_ts end as ingest_ts"""


_DECODED = f"""decoded as (
  select {_decoded_columns()}, schema_id, reason as quarantine_reason
  from (select *, account_id as account_key from bronze) t)"""

_V2 = "num % 3 = 0"


def all_oracles() -> dict[str, str]:
    silver_flags = _SALES + _FLAGS.format(source="silver")
    stream_gold = _REPLAY + f""", gold as ({_gold('kept')})
select {_GOLD_OUT} from gold where window_end <= (select max(w) from marks)"""
    dq_stream = _REPLAY + _FLAGS.format(source="kept") + f"""
select cast(2 * b as bigint) as batch_id, {_COUNTERS} from flags group by b"""
    return {
        "frame_encode": _SALES + f"""
select account_id as kafka_key, kafka_partition, kafka_offset,
  case when {_V2} then '0000000002' else '0000000001' end as header, event_id, region from sales""",
        "frame_check": _SALES + _POISON + """
select kafka_partition, kafka_offset, frame_ok, cast(schema_id as bigint) as schema_id from frames""",
        "decode_registry_join": _SALES + _POISON + """
select kafka_partition, kafka_offset, cast(schema_id as bigint) as schema_id,
  case when schema_id = 1 then 'sales.events.v1-value' end as subject,
  cast(case when schema_id = 1 then 1 end as int) as version,
  case when schema_id = 1 then 'JSON' end as format from frames""",
        "decode_events": _SALES + _POISON + f""",
{_DECODED}
select * exclude (schema_id), cast(schema_id as bigint) as schema_id from decoded""",
        "parse_and_filter": _SALES + _POISON + f""",
{_DECODED}
select * exclude (schema_id, quarantine_reason) from decoded where quarantine_reason is null""",
        "decode_mixed_versions": _SALES + f"""
select kafka_partition, kafka_offset, event_id, case when {_V2} then 2 else 1 end as schema_version, region, amount,
  case when {_V2} then (num % 10) / 10.0 else cast(0 as double) end as discount,
  case when {_V2} and num % 2 = 0 then 'partner' end as channel from sales""",
        "decode_resolved_versions": _SALES + """
select kafka_partition, kafka_offset, event_id, cast(num % 3 + 1 as bigint) as schema_version, amount,
  case when num % 3 >= 1 then (num % 10) / 10.0 else cast(0 as double) end as discount,
  case when num % 3 >= 1 and num % 2 = 0 then 'partner' end as channel,
  cast(case when num % 3 = 2 then num % 5 + 3000000000 else 1 end as bigint) as quantity,
  case when num % 3 < 2 then trace_id end as trace_id from sales""",
        "quarantine_rows": _SALES + _POISON + f"""
select reason, {_ERRORS} as error, account_id as kafka_key, kafka_partition, kafka_offset, kafka_ingest_ts
from frames where reason is not null""",
        "quarantine_by_reason": _SALES + _POISON + """
select reason, count(*) as records, (select count(*) from frames) as total_records,
  round(count(*) / (select count(*) from frames), 6) as rate
from frames where reason is not null group by reason""",
        "net_amount_sign": _SALES + """
select event_type, count(*) as event_count,
  cast(sum(cast(coalesce(amount < 0, false) as int)) as bigint) as negative_count,
  round(sum(amount), 2) + 0.0 as net_amount from sales group by event_type""",
        "silver_dedup": _SALES + """
select event_id, event_ts, ingest_ts, account_id, region, plan_tier, currency, amount, kafka_partition,
  kafka_offset from silver""",
        "duplicate_report": _REPLAY + """
select event_id, count(*) as copies, min(kafka_ingest_ts) as first_arrival_ts,
  max(kafka_ingest_ts) as last_arrival_ts, count(*) - 1 as extra_copies
from sliced group by event_id having count(*) > 1""",
        "revenue_5m": _SALES + f", gold as ({_gold('silver')}) select {_GOLD_OUT} from gold",
        "revenue_5m_by_currency": _SALES + f""", gold as ({_gold('silver', 'region, plan_tier, currency')})
select {_GOLD_OUT}, currency from gold""",
        "revenue_5m_gated": silver_flags + f""", gold as ({_gold('flags', where='where not (n or d or a)')})
select {_GOLD_OUT} from gold""",
        "revenue_5m_closed": _SALES + f""", gold as ({_gold('silver')})
select {_GOLD_OUT} from gold where window_end <=
  (select date_trunc('millisecond', max(event_ts)) - interval 10 minute from sales)""",
        "gold_latest_20": _SALES + f""", gold as ({_gold('silver')})
select {_GOLD_OUT} from gold
order by window_start desc, region asc nulls last, plan_tier asc nulls last limit 20""",
        "dq_flags": silver_flags + """
select event_id, n as f_null_required, d as f_invalid_domain, a as f_bad_amount, l as f_latency_breach,
  (n or d or a) as f_invalid_any from flags""",
        "dq_metrics": silver_flags + f"select {_COUNTERS} from flags",
        "dq_metrics_bronze": _SALES + _POISON + f""",
{_DECODED}""" + _FLAGS.format(source="decoded where event_time is not null") + f"select {_COUNTERS} from flags",
        "dq_metrics_by_batch": silver_flags + f"select batch_id, {_COUNTERS} from flags group by batch_id",
        "dq_violations": silver_flags + f"""
select event_id, event_ts, region, plan_tier, currency, amount, {_REASON} as dq_violation_reason
from flags where n or d or a or l""",
        "dq_samples": silver_flags + f"""
select batch_id, event_id, dq_violation_reason from (
  select batch_id // 2 as batch_id, event_id, {_REASON} as dq_violation_reason,
    row_number() over (partition by batch_id // 2 order by event_id) as rank
  from flags where n or d or a or l) t where rank <= 100""",
        "latency_breaches": _SALES + f"select * from ({_LATENCY}) t where latency_sla_breaches > 0",
        "latency_by_window": _SALES + _LATENCY,
        "latency_percentiles": _SALES + f""",
ranked as (
  select day, s, row_number() over (partition by day order by s) as rank, count(*) over (partition by day) as events
  from (select date_trunc('day', time_bucket(interval 5 minute, event_ts))::timestamp as day,
    cast(epoch(date_trunc('second', ingest_ts)) - epoch(date_trunc('second', event_ts)) as bigint) as s from silver) t
  where s is not null),
listed as (select day, rank, events, {_MIDDLE} as middle from ranked)
select day, events, max(middle) filter (rank = ceil(events * 0.5)) as p50,
  max(middle) filter (rank = ceil(events * 0.95)) as p95, max(middle) filter (rank = ceil(events * 0.99)) as p99
from listed group by day, events""",
        "account_order_check": _SALES + """,
placed as (
  select *, max(event_ts) over (partition by account_id, kafka_partition order by kafka_offset
    rows between unbounded preceding and 1 preceding) as earlier from sales)
select account_id, count(*) as records, count(*) filter (event_ts < earlier) as inversions,
  cast(greatest(coalesce(max(epoch_us(earlier) - epoch_us(event_ts)), 0), 0) as bigint) as worst_micros
from placed group by account_id""",
        "partition_distribution": _SALES + """
select kafka_partition, count(*) as records, min(kafka_offset) as first_offset, max(kafka_offset) as last_offset
from sales group by kafka_partition""",
        "offset_lag": _SALES + """
select kafka_partition, latest_offset, processed_offset,
  latest_offset - coalesce(processed_offset, first_offset - 1) as lag from (
  select kafka_partition, max(kafka_offset) as latest_offset, min(kafka_offset) as first_offset
  from sales group by kafka_partition) a
left join (
  select kafka_partition, max(kafka_offset) as processed_offset from sales
  where batch_id < 9 and kafka_partition <> 2 group by kafka_partition) b using (kafka_partition)""",
        "account_partition_check": _SALES + """
select account_id, count(distinct case when num % 7 = 0 and account_id like '%7' then (kafka_partition + 1) % 3
  else kafka_partition end) as partitions, count(*) as records
from sales group by account_id""",
        "backfill_revenue_5m": _SALES + _POISON + f""",
events_again as (
  select * from (
    select *, row_number() over (partition by event_id order by kafka_ingest_ts, kafka_offset) as rn3
    from frames where reason is null) t where rn3 = 1),
gold as ({_gold('events_again')}) select {_GOLD_OUT} from gold""",
        "replay_by_offset": _SALES + """
select event_id, kafka_partition, kafka_offset, region, amount from sales
where (kafka_partition = 0 and kafka_offset >= 5 * 172800000000 and kafka_offset < 10 * 172800000000)
  or (kafka_partition = 1 and kafka_offset < 20 * 172800000000)
  or (kafka_partition = 2 and kafka_offset >= 12 * 172800000000 and kafka_offset < 100 * 172800000000)""",
        "replay_by_time": _SALES + """
select event_id, kafka_partition, kafka_offset, kafka_ingest_ts, region, amount from sales
where kafka_ingest_ts >= timestamp '2024-01-10' and kafka_ingest_ts < timestamp '2024-01-20 12:00:00'""",
        "backfill_diff": _SALES + _PRODUCTION_AND_REPLAY + _DIFF,
        "backfill_diff_pruned": _SALES + _PRODUCTION_AND_REPLAY + f"select * from ({_DIFF}) t where status <> 'same'",
        "backfill_totals": _SALES + _PRODUCTION_AND_REPLAY + f"""
{_totals('production')} union all {_totals('replay')}""",
        "backfill_promote": _SALES + _PRODUCTION_AND_REPLAY + _FLAGS.format(source="replayed_silver") + f""",
corrected as ({_gold('flags', where='where not (n or d or a)')})
select {_GOLD_OUT} from production where not ({_REPLAYED_RANGE})
union all select {_GOLD_OUT} from corrected where {_REPLAYED_RANGE}""",
        "version_retention": _SALES + _PRODUCTION_AND_REPLAY + """,
dates as (
  select 'first' as run_id, cast(window_start as date) as d from production
  union select 'replay', cast(window_start as date) from replay
  union select 'second', cast(window_start as date) from production
    where window_start >= timestamp '2024-01-10' and window_start < timestamp '2024-01-21')
select run_id, cast(d as varchar) as window_date, case run_id when 'first' then d < date '2024-01-10' or d > date '2024-01-20'
  when 'second' then true else false end as kept from dates""",
        "gold_stream_replay": stream_gold,
        "gold_layers_replay": stream_gold,
        "dq_stream_replay": dq_stream,
        "dq_history": _REPLAY + _FLAGS.format(source="kept") + """
select cast(2 * b as bigint) as batch_id, count(*) as total_records,
  cast(greatest(count(*) - sum(cast((n or d or a) as int)), 0) as bigint) as valid_records_estimate,
  least(100, cast(sum(cast(coalesce(n or d or a or l, n or a) as int)) as bigint)) as sample_rows
from flags group by b""",
        "silver_stream_replay": _REPLAY + """
select event_id, event_ts, ingest_ts, region, plan_tier, amount, kafka_partition, kafka_offset, kafka_ingest_ts from kept""",
        "gold_backlog_replay": _replay(129600) + f""", gold as ({_gold('kept')})
select {_GOLD_OUT} from gold where window_end <= (select max(w) from marks)""",
        "late_incremental": _REPLAY + """,
batches as (select b, row_number() over (order by b) - 1 as as_of from (select distinct b from sliced))
select as_of, event_id, kafka_partition, kafka_offset, event_ts
from sliced join batches on sliced.b <= batches.b
where not exists (select 1 from kept where kept.event_id = sliced.event_id and kept.b <= batches.b)""",
        "reused_ids": _SALES + """,
renamed as (select case when num % 211 = 5 then cast(num // 2 as varchar) else event_id end as event_id, event_ts from sales),
early as (select event_id, min(event_ts) as first_event_ts, max(event_ts) as last_event_ts
  from renamed where event_ts < timestamp '2024-01-16' group by 1),
later as (select event_id, min(event_ts) as reused_event_ts from renamed where event_ts >= timestamp '2024-01-16' group by 1)
select event_id, first_event_ts, reused_event_ts from early join later using (event_id)""",
        "dq_violations_stored": _REPLAY + _FLAGS.format(source="kept") + f"""
select event_id, event_ts, {_REASON} as dq_violation_reason from flags where n or d or a or l""",
        "late_quarantine": _REPLAY + """
select event_id, kafka_partition, kafka_offset, event_ts, kafka_ingest_ts from sliced
where b < (select max(b) from sliced)
  and event_id not in (select event_id from kept where b < (select max(b) from sliced))""",
        "restart_replay": stream_gold,
        "stream_progress": _REPLAY + """
select cast(2 * s.b as bigint) as batch_id, s.n as input_rows, s.n - coalesce(o.n, 0) as rows_dropped_by_watermark
from (select b, count(*) as n from sliced group by b) s left join (select b, count(*) as n from on_time group by b) o using (b)
union all
select cast(2 * b + 1 as bigint), cast(0 as bigint), cast(0 as bigint) from (select distinct b from sliced) t""",
        "dq_retry_replay": dq_stream,
        "registry_rollout_replay": _REPLAY + f"""
select kafka_partition, kafka_offset, event_id, cast(case when {_V2} then 2 else 1 end as bigint) as schema_id,
  case when {_V2} then (num % 10) / 10.0 else cast(0 as double) end as discount,
  case when {_V2} and num % 2 = 0 then 'partner' end as channel, cast(null as varchar) as quarantine_reason,
  ({_V2} and b = (select min(b) from sliced)) as recovered
from sliced""",
    }
