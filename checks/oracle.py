"""The same results as ``checks.queries`` in SQL for DuckDB, from the plain tables."""

# Records of the event topic (``ev``), of the journal in it, and of the second tenant's journal.
_EVENTS = """
ev as (
  select *, concat('user-', user_id) as persistence_id, cast(user_id % 16 as int) as part,
    cast(round(value * 100) as bigint) as cents,
    epoch_us(ts) * 10 + 621355968000000000 + event_id % 10 as ticks,
    event_id % 50 = 0 as is_foreign,
    case when event_id % 100 <> 0 then concat('user-', user_id) end as foreign_key,
    row_number() over (partition by user_id % 16 order by event_id) - 1 as off
  from events),
journal as (
  select *, row_number() over (partition by user_id order by event_id) as seq_nr,
    concat_ws(',', event_type, case when value > 50 then 'high' end) as tags_csv,
    concat('Shop.Events.', upper(event_type[1]), event_type[2:]) as manifest,
    md5(cast(user_id as varchar)) as writer_uuid,
    case when event_type = 'error' then cast(user_id % 7 - 3 as int) end as serializer_id,
    case when event_type = 'error' then 'opaque' else 'json' end as format,
    case when event_type = 'error' then props
      else to_json({'eventId': event_id, 'cents': cents, 'props': props})::varchar end as body
  from ev where not is_foreign),
topic as (
  select ev.event_id, 'akka-journal' as topic, ev.part, ev.off,
    case when ev.is_foreign then ev.foreign_key else ev.persistence_id end as key, j.seq_nr,
    not (ev.is_foreign and ev.event_id % 150 = 0) as has_body
  from ev left join journal j using (event_id)),
chat as (
  select *, 'acme-akka-journal' as topic, concat('conv-', conv_id) as key, turn + 1 as seq_nr,
    cast(conv_id % 8 as int) as part,
    row_number() over (partition by conv_id % 8 order by conv_id, turn) - 1 as off
  from conversations),
marks as (
  select persistence_id, seq_nr - 20 as to_seq_nr from journal where event_type = 'error' and seq_nr % 11 = 0
  union all
  select persistence_id, seq_nr // 4 from journal where event_type = 'view' and seq_nr % 17 = 0),
deleted as (select persistence_id, max(to_seq_nr) as deleted_to_seq_nr from marks group by persistence_id),
journal_index as (
  select persistence_id, max(seq_nr) as highest_seq_nr, min(part) as "partition",
    min(off) as first_offset, max(off) as last_offset, max(ticks) as last_ticks
  from journal group by persistence_id),
ids as (select concat('user-', c_custkey) as persistence_id, cast(c_nationkey as bigint) as nation from customer),
busiest as (select persistence_id from journal_index order by highest_seq_nr desc, persistence_id limit 1)"""

# Saves (S), tombstones for one sequence number (T) and for a range (R), in log order.
_SNAPSHOTS = """
actions as (
  select event_id, 0 as sub, part, persistence_id, 'S' as kind, seq_nr, ticks,
    cast(null as bigint) as min_seq, cast(null as bigint) as max_seq,
    cast(null as bigint) as min_ticks, cast(null as bigint) as max_ticks, cents
  from journal where seq_nr % 10 = 0
  union all
  select event_id, 3, part, persistence_id, 'S', seq_nr - seq_nr % 10, ticks, null, null, null, null, cents
  from journal where event_type = 'purchase' and seq_nr % 9 = 0 and seq_nr > 10
  union all
  select j.event_id, 1, j.part, j.persistence_id, 'T', j.seq_nr - j.seq_nr % 10,
    case when j.seq_nr % 3 = 0 then 0 when j.seq_nr % 3 = 1 then coalesce(s.ticks, 1) else 1 end,
    null, null, null, null, null
  from journal j left join journal s
    on s.persistence_id = j.persistence_id and s.seq_nr = j.seq_nr - j.seq_nr % 10 and s.seq_nr % 10 = 0
  where j.event_type = 'error' and j.seq_nr % 7 = 0
  union all
  select event_id, 2, part, persistence_id, 'R', null, null,
    seq_nr - 25, case when seq_nr % 5 <> 0 then seq_nr else 9223372036854775807 end,
    case when seq_nr % 3 = 0 then ticks - 5184000000000 else 0 end,
    case when seq_nr % 2 = 1 then ticks - 2592000000000 else 3155378975999999999 end, null
  from journal where event_type = 'signup' and seq_nr % 13 = 0),
snaplog as (
  select *, row_number() over (partition by part order by event_id, sub) - 1 as off from actions),
last_saves as (
  select * from snaplog where kind = 'S'
  qualify row_number() over (partition by persistence_id, seq_nr order by off desc) = 1)"""


def _live(kinds: str) -> str:
    return f"""
live as (
  select w.* from last_saves w where not exists (
    select 1 from snaplog d
    where d.persistence_id = w.persistence_id and d.off > w.off and d.kind in ({kinds})
      and ((d.kind = 'T' and d.seq_nr = w.seq_nr and (d.ticks = 0 or d.ticks = w.ticks))
        or (d.kind = 'R' and w.seq_nr between d.min_seq and d.max_seq
          and w.ticks between d.min_ticks and d.max_ticks)))),
best as (
  select * from live qualify row_number() over (partition by persistence_id order by seq_nr desc) = 1)"""


def _events(select: str) -> str:
    return f"with {_EVENTS}\n{select}"


def _snapshots(select: str, kinds: str = "'T', 'R'") -> str:
    return f"with {_EVENTS},{_SNAPSHOTS},{_live(kinds)}\n{select}"


_RECORDS = 'select topic, part as "partition", off as "offset", key from'
_EVENT = 'persistence_id, seq_nr, part as "partition", off as "offset"'
_RECORD_UNION = """(
  select topic, part, off, key from topic union all select topic, part, off, key from chat)"""
_BY_ID = f"select {_EVENT}, ticks, tags_csv from journal join busiest using (persistence_id) where seq_nr >= 2"
_BY_TAG = f"select {_EVENT}, ticks, tags_csv from journal where value > 50"
_TAGS_OF = """select persistence_id, string_agg(distinct tag, ',' order by tag) as tags_csv
  from (select persistence_id, unnest(string_split(tags_csv, ',')) as tag from journal) group by persistence_id"""
_LONGEST_RUN = """select persistence_id, cast(max(n) as bigint) as events, cast(max(run) as bigint) as longest from (
    select persistence_id, island, sum(high) as run, max(total) as n from (
      select persistence_id, case when value > 50 then 1 else 0 end as high,
        count(*) over (partition by persistence_id) as total,
        sum(case when value > 50 then 0 else 1 end) over (partition by persistence_id order by off) as island
      from journal) a
    group by persistence_id, island) b
  group by persistence_id"""
_RESUME = """with_start as (
  select t.*, coalesce(
      max(case when seq_nr <= 20 and part < 12 then off + 1 end) over (partition by part), {edge}) as start
  from topic t)
  select topic, part as "partition", off as "offset", key from with_start where off >= start"""
_ORDER_RESULTS = """
lines as (
  select l_orderkey, l_linenumber * 1000000000000000000 + l_partkey * 100000000 + l_suppkey as pos,
    cast(l_partkey % 16 as int) as part
  from lineitem),
placed as (select *, row_number() over (partition by part order by l_orderkey, pos) - 1 as off from lines)"""
_SIGNED = "((event_id % 2001 - 1000) * 4611686018427387)"
_SIGNED_INT = "cast((event_id % 2001 - 1000) * 2147483 as int)"
_SUBJECT_VERSIONS = """
seen as (
  select event_type as subject, count(distinct length(props)) as versions
  from events where event_type <> 'view' group by event_type),
registry as (
  select subject, cast(unnest(range(1, versions + 1)) as int) as version from seen),
numbered as (
  select subject, version, cast(length(subject) * 100 + version as int) as id, concat('v', version) as schema
  from registry)"""
_ATOMIC = """
atomic as (
  select *, concat(persistence_id, '/', (seq_nr - 1) // 3) as atomic_id from journal),
failed as (select distinct atomic_id from atomic where cents < 300),
accepted as (
  select *, row_number() over (partition by part order by event_id) - 1 as new_off
  from atomic where atomic_id not in (select atomic_id from failed))"""

ORACLE: dict[str, str] = {
    "topic_scan": _events(f"{_RECORDS} {_RECORD_UNION}"),
    "topic_pattern_scan": _events(f"{_RECORDS} {_RECORD_UNION}"),
    "assigned_scan": _events(
        f"""{_RECORDS} {_RECORD_UNION}
        where (topic = 'akka-journal' and part in (3, 7)) or (topic = 'acme-akka-journal' and part = 2)"""
    ),
    "assigned_from_offset": _events(
        f"""{_RECORDS} {_RECORD_UNION}
        where (topic = 'akka-journal' and ((part = 3 and off >= 100) or part = 7))
          or (topic = 'acme-akka-journal' and part = 2 and off >= 10)"""
    ),
    "resume_from_commit": f"with {_EVENTS}, {_RESUME.format(edge='0')}",
    "resume_from_latest": f"with {_EVENTS}, {_RESUME.format(edge='max(off) over (partition by part) + 1')}",
    "committable_scan": _events(
        """select 'billing' as group_id, topic, part as "partition", off as "offset", off + 1 as next_offset
        from topic"""
    ),
    "per_partition_running": _events(
        """select topic, part as "partition", off as "offset", key,
          row_number() over (partition by part order by off) as records,
          cast(sum(coalesce(seq_nr, 0)) over (partition by part order by off) as bigint) as seq_total
        from topic"""
    ),
    "external_offset_scan": _events(
        """select topic, part as "partition", off as "offset", key from (
          select *, (max(off) over (partition by part) + 1) // 2 as start from topic where part % 2 = 0) t
        where off >= start"""
    ),
    "at_most_once": _events(f"{_RECORDS} topic"),
    "read_committed_scan": _events(
        """select 'audit' as topic, part as "partition",
          row_number() over (partition by part order by event_type not in ('purchase', 'click'), event_id) - 1 as "offset",
          persistence_id as key, props as value_text
        from ev"""
    ),
    "compacted_scan": _events("""select 'audit' as topic, part as "partition", off as "offset", persistence_id as key from ev"""),
    "typed_scan": _events("select user_id, event_id, cents, props from journal where event_type <> 'error'"),
    "append_roundtrip": """
        select case when o_orderstatus <> 'P' then cast(o_custkey as varchar) end as key, o_orderkey as order_key,
          case when o_orderstatus <> 'P'
            then row_number() over (partition by o_custkey, o_orderstatus <> 'P' order by o_orderkey) end as key_position
        from orders""",
    "produce_single": """
        select c_custkey as envelope_id, 'customers' as topic, cast(c_custkey % 16 as int) as "partition",
          row_number() over (partition by c_custkey % 16 order by c_custkey) - 1 as "offset", c_name as pass_through
        from customer""",
    "produce_multi": f"""with {_ORDER_RESULTS}
        select l_orderkey as envelope_id, pos, 'lines' as topic, part as "partition", off as "offset",
          o_custkey as pass_through
        from placed join orders on o_orderkey = l_orderkey""",
    "produce_passthrough": """
        select o_orderkey as envelope_id, o_custkey as pass_through, count(l_orderkey) as records,
          case count(l_orderkey) when 0 then 'pass_through' when 1 then 'single' else 'multi' end as kind
        from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_custkey""",
    "produce_arrays": """
        with records as (
          select c_custkey, c_name, unnest(case when c_mktsegment = 'BUILDING' then [0, 1]
            when c_acctbal > 0 then [0] else [] end) as pos from customer),
        placed as (
          select *, row_number() over (partition by c_custkey % 16 order by c_custkey, pos) - 1 as off from records)
        select c.c_custkey as envelope_id, c.c_name as pass_through,
          coalesce(string_agg(off, ',' order by pos), '') as offsets_csv
        from customer c left join placed p on p.c_custkey = c.c_custkey group by c.c_custkey, c.c_name""",
    "exactly_once": _events("select persistence_id, seq_nr, ticks, tags_csv from journal where value > 50"),
    "new_checkpoint": _events("select persistence_id, seq_nr, ticks, tags_csv from journal where value > 50"),
    "append_after_group": _events(
        """select 'high-events' as topic, part as "partition",
          row_number() over (partition by part order by second, event_id) - 1 as "offset", key
        from (select part, event_id, 0 as second, persistence_id as key from journal where value > 50
          union all select part, event_id, 1, persistence_id from ev where event_type = 'error') t"""
    ),
    "two_groups": _events(
        """select g.group_id, part as "partition", max(off) + 1 as consumed_to,
          count(case when g.group_id = 'second' or (value > 50 and not is_foreign) then 1 end) as records,
          count(case when g.group_id = 'second' or (value > 50 and not is_foreign) then 1 end) as offsets,
          nullif(count(case when g.group_id = 'second' or (value > 50 and not is_foreign) then 1 end) - 1, -1) as last_offset
        from ev, (select unnest(['first', 'second']) as group_id) g group by g.group_id, part"""
    ),
    "commit_ledger": _snapshots(
        f"""select 'billing' as group_id, topic, part as "partition", max(off) + 1 as next_offset
        from (select topic, part, off from {_RECORD_UNION}
          union all select 'akka-snapshots', part, off from snaplog) t group by topic, part"""
    ),
    "commit_flow": _events(
        f"""select 'billing' as group_id, topic, part as "partition", max(off) + 1 as next_offset
        from {_RECORD_UNION} group by topic, part"""
    ),
    "commit_batches": _events(
        """select 'billing' as group_id, topic, part as "partition", off // 100 as commit_batch,
          max(off) + 1 as next_offset, count(*) as records
        from topic group by topic, part, off // 100"""
    ),
    "drain": _events(f"{_RECORDS} topic"),
    "typed_append": """
        select cast(o_custkey as varchar) as key, 7 as schema_id,
          to_json({'orderKey': o_orderkey, 'status': o_orderstatus})::varchar as body
        from orders""",
    "journal_append": f"""with {_EVENTS},{_ATOMIC}
        select persistence_id, seq_nr, part as "partition", new_off as "offset", ticks, writer_uuid, manifest,
          serializer_id, tags_csv
        from accepted""",
    "journal_append_results": f"""with {_EVENTS},{_ATOMIC}
        select atomic_id, min(case when cents < 300 then 'no payload' end) as error from atomic group by atomic_id""",
    "journal_index": _events(
        f"""select i.persistence_id, highest_seq_nr, "partition", first_offset, last_offset,
          coalesce(deleted_to_seq_nr, 0) as deleted_to_seq_nr, tags_csv,
          (last_ticks - 621355968000000000) // 10 as last_micros
        from journal_index i join ({_TAGS_OF}) t using (persistence_id) left join deleted using (persistence_id)"""
    ),
    "index_topic_roundtrip": _events(
        f"""select 'akka-journal' as topic, persistence_id, highest_seq_nr, "partition", first_offset, last_offset,
          greatest(coalesce(deleted_to_seq_nr, 0), 0) as deleted_to_seq_nr, tags_csv,
          (last_ticks - 621355968000000000) // 10 as last_micros
        from journal_index i join ({_TAGS_OF}) t using (persistence_id) left join deleted using (persistence_id)"""
    ),
    "delete_marks_roundtrip": _events(
        f"""select {_EVENT} from journal left join deleted using (persistence_id)
        where seq_nr > coalesce(deleted_to_seq_nr, 0)"""
    ),
    "journal_index_live": _events(
        f"""select i.persistence_id, highest_seq_nr, "partition", first_offset, last_offset, tags_csv
        from journal_index i join ({_TAGS_OF}) t using (persistence_id)"""
    ),
    "index_topic_live": _events(
        f"""select 'akka-journal' as topic, i.persistence_id, highest_seq_nr, "partition", first_offset, last_offset, tags_csv
        from journal_index i join ({_TAGS_OF}) t using (persistence_id)"""
    ),
    "compact_latest": _events(
        """select key, part as "partition", off as "offset", seq_nr from topic where key is not null and has_body
        qualify row_number() over (partition by key order by off desc) = 1"""
    ),
    "index_lookup": _events(
        """select persistence_id, highest_seq_nr, "partition", first_offset, last_offset
        from ids left join journal_index using (persistence_id)"""
    ),
    "highest_seq_nr": _events(
        """select persistence_id, coalesce(highest_seq_nr, 0) as highest_seq_nr
        from ids left join journal_index using (persistence_id)"""
    ),
    "logical_delete": _events(
        f"""select {_EVENT} from journal left join deleted using (persistence_id)
        where seq_nr > coalesce(deleted_to_seq_nr, 0)"""
    ),
    "replay": _events(
        f"""select {_EVENT}, ticks, writer_uuid
        from journal join busiest using (persistence_id) left join deleted using (persistence_id)
        where seq_nr >= greatest(3, coalesce(deleted_to_seq_nr, 0) + 1) order by off limit 40"""
    ),
    "bulk_replay": _events(
        """select persistence_id, seq_nr, "partition", "offset" from (
          select persistence_id, seq_nr, part as "partition", off as "offset", nation,
            row_number() over (partition by persistence_id order by off) as n
          from journal join ids using (persistence_id) left join deleted using (persistence_id)
          where seq_nr between greatest(nation % 5 + 1, coalesce(deleted_to_seq_nr, 0) + 1) and nation + 30) t
        where n <= nation + 10"""
    ),
    "fold_state": _events(
        """select persistence_id, count(*) as events, count(*) filter (value > 50) as high_events,
          cast(coalesce(sum(cents) filter (format = 'json'), 0) as bigint) as json_cents,
          arg_max(manifest, off) as last_manifest
        from journal group by persistence_id"""
    ),
    "fold_udf": _events(_LONGEST_RUN),
    "fold_live": _events(_LONGEST_RUN),
    "two_tenants": _events(
        """select concat(tenant, 'akka-journal') as topic, persistence_id, max(seq) as highest_seq_nr, max(saved) as snapshot_seq,
          count(*) filter (seq > greatest(saved, mark)) as tail_events, count(*) filter (seq > mark) as visible,
          least(count(*) filter (seq > mark), 6) as replayed
        from (
          select *, coalesce(max(case
              when tenant = '' and event_type = 'error' and seq % 5 = 0 then seq - 3
              when tenant <> '' and event_type = 'view' and seq % 7 = 0 then seq - 2 end)
            over (partition by tenant, persistence_id), 0) as mark,
            coalesce(max(case when seq % 4 = 0 and next_type is distinct from 'click' then seq end)
            over (partition by tenant, persistence_id), 0) as saved
          from (
            select *, lead(event_type) over own as next_type, row_number() over own as seq
            from (select *, case when event_id % 3 = 0 then 'acme-' else '' end as tenant from ev where not is_foreign) t
            window own as (partition by tenant, persistence_id order by event_id)) n) m
        group by tenant, persistence_id"""
    ),
    "tag_index": _events('select persistence_id, seq_nr, part as "partition", ticks, tags_csv from journal where value > 50'),
    "tag_union": _events(_TAGS_OF),
    "tag_topic": _events(
        """select tag, concat('acme-akka-journal-tag-', tag) as tag_topic, persistence_id, seq_nr,
          part as "partition", off as "offset"
        from (select *, unnest(string_split(tags_csv, ',')) as tag from journal) t"""
    ),
    "tenant_scan": _events(
        """select topic, key as persistence_id, seq_nr, part as "partition", off as "offset", role as tags_csv,
          to_json({'role': role, 'text': text})::varchar as body
        from chat"""
    ),
    "events_by_id": _events(_BY_ID),
    "events_by_id_undeleted": _events(
        f"""select {_EVENT} from journal join busiest using (persistence_id) left join deleted using (persistence_id)
        where seq_nr > coalesce(deleted_to_seq_nr, 0)"""
    ),
    "events_by_id_live": _events(_BY_ID),
    "events_by_id_ordered": _events(
        """select persistence_id, seq_nr, ticks, tags_csv from journal join busiest using (persistence_id)
        where seq_nr between 2 and (select max(highest_seq_nr) from journal_index) - 2"""
    ),
    "events_by_tag": _events(_BY_TAG),
    "events_by_tag_live": _events(_BY_TAG),
    "all_events": _events(
        f"select {_EVENT}, ticks, manifest, serializer_id, format, writer_uuid, tags_csv from journal"
    ),
    "all_events_live": _events(f"select {_EVENT}, ticks, tags_csv from journal"),
    "events_after_offset": _events(
        """select j.persistence_id, j.seq_nr, j.part as "partition", j.off as "offset"
        from journal j join (select part, (max(off) + 1) // 3 as start from topic group by part) p using (part)
        where j.value > 50 and (j.part >= 10 or j.off > start)"""
    ),
    "snapshot_save": _snapshots(
        """select persistence_id, seq_nr, ticks, part as "partition", off as "offset",
          to_json({'eventId': event_id, 'cents': cents})::varchar as body
        from snaplog where kind = 'S'"""
    ),
    "snapshot_delete_seq": _snapshots('select persistence_id, seq_nr, ticks, off as "offset" from live', "'T'"),
    "snapshot_delete_range": _snapshots('select persistence_id, seq_nr, ticks, off as "offset" from live', "'R'"),
    "snapshot_live_set": _snapshots('select persistence_id, seq_nr, ticks, off as "offset" from live'),
    "snapshot_load": _snapshots(
        """select i.persistence_id, b.seq_nr, b.ticks, b.off as "offset" from ids i left join (
          select l.* from live l join ids using (persistence_id) where l.seq_nr between 11 and nation * 2 + 20
          qualify row_number() over (partition by l.persistence_id order by l.seq_nr desc) = 1) b
        using (persistence_id)"""
    ),
    "recover_all": _snapshots(
        """select i.persistence_id, i.highest_seq_nr, coalesce(any_value(b.seq_nr), 0) as snapshot_seq,
          count(j.seq_nr) as tail_events, cast(sum(j.cents) filter (j.format = 'json') as bigint) as tail_cents,
          min(j.seq_nr) as first_tail_seq, arg_max(j.manifest, j.off) as last_manifest
        from journal_index i left join best b using (persistence_id) left join deleted d using (persistence_id)
        left join journal j on j.persistence_id = i.persistence_id
          and j.seq_nr > greatest(coalesce(b.seq_nr, 0), coalesce(d.deleted_to_seq_nr, 0))
        group by i.persistence_id, i.highest_seq_nr"""
    ),
    "encode_headers": f"""
        select event_id, lpad(hex({_SIGNED}), 16, '0') as long_hex,
          right(lpad(hex(cast({_SIGNED_INT} as bigint)), 16, '0'), 8) as int_hex, hex(encode(props)) as string_hex
        from events""",
    "decode_headers": f"""
        select event_id, {_SIGNED} as long_value, {_SIGNED_INT} as int_value,
          case when event_type <> 'view' then props end as string_value
        from events""",
    "tags_codec": """
        select event_id, concat_ws('|', event_type, case when value > 50 then 'high|value' end, concat('user ', user_id))
            as tags,
          cast(case when value > 50 then 4 else 2 end as int) as n
        from events""",
    "header_project": _events(
        """select t.part as "partition", t.off as "offset",
          case j.format when 'opaque' then 'application/x-hyperion' when 'json' then 'application/json' end
            as content_type,
          j.seq_nr as seq_header, j.manifest, j.writer_uuid, j.tags_csv
        from topic t left join journal j using (event_id)"""
    ),
    "ticks_codec": _events(
        "select event_id, ticks, epoch_us(ts) as micros, epoch_us(ts) * 10 + 621355968000000000 as whole_ticks from ev"
    ),
    "content_type_split": """
        select event_id, case event_type when 'purchase' then 'protobuf' when 'error' then 'opaque' else 'json' end
          as format
        from events""",
    "wire_frame": """
        select event_id, true as framed, cast(user_id * 65537 as int) as schema_id, props as body from events""",
    "json_decode": _events(
        """select persistence_id, seq_nr, case when event_type = 'purchase' then cents end as purchase_cents,
          case when event_type = 'click' then event_id end as click_event_id, event_id, props
        from journal where format = 'json'"""
    ),
    "json_encode": """
        select event_id,
          to_json({'eventId': event_id, 'user_id': user_id, 'eventType': event_type, 'urlValue': props,
            'id': case when event_id % 3 > 0 then event_id end})::varchar as body
        from events""",
    "derive_schemas": """
        with fields as (
          select distinct concat('Shop.Events.', upper(event_type[1]), event_type[2:]) as manifest,
            upper(event_type[1]) || event_type[2:] as title, e.key as field,
            case when e.type in ('UBIGINT', 'BIGINT') then 'integer' when e.type = 'VARCHAR' then 'string'
              when e.type = 'BOOLEAN' then 'boolean' when e.type = 'DOUBLE' then 'number' else 'object' end as kind
          from events, json_each(props) e)
        select manifest, concat('{"$schema":"http://json-schema.org/draft-07/schema#","title":"', title,
          '","type":"object","properties":{',
          string_agg(concat('"', field, '":{"type":"', kind, '"}'), ',' order by field), '},"required":[',
          string_agg(concat('"', field, '"'), ',' order by field), ']}') as schema
        from fields group by manifest, title""",
    "subject_names": """
        select event_id, case user_id % 4 when 0 then 'akka-journal-value'
            when 1 then concat('Shop.Events.', upper(event_type[1]), event_type[2:])
            else concat('akka-journal-Shop.Events.', upper(event_type[1]), event_type[2:]) end as subject
        from events""",
    "resolve_schema": f"""with {_SUBJECT_VERSIONS}
        select event_id, event_type as subject, id as schema_id, case when id is not null then 'JSON' end as schema_type
        from events left join (
          select * from numbered qualify row_number() over (partition by subject order by version desc) = 1) n
        on n.subject = event_type""",
    "register_schemas": f"""with {_SUBJECT_VERSIONS},
        wanted as (select distinct event_type as subject, concat('v', length(props)) as schema from events),
        fresh as (select * from wanted w where not exists (
          select 1 from numbered n where n.subject = w.subject and n.schema = w.schema))
        select f.subject,
          cast(coalesce((select max(version) from numbered n where n.subject = f.subject), 0)
            + row_number() over (partition by f.subject order by f.schema) as int) as version,
          cast((select max(id) from numbered) + row_number() over (order by f.subject, f.schema) as int) as id,
          'JSON' as type, f.schema
        from fresh f""",
    "event_serialize": _events(
        """select event_id, persistence_id as key,
          case format when 'opaque' then 'application/x-hyperion' else 'application/json' end as content_type,
          manifest, seq_nr, tags_csv, case when format = 'json' then cast(1000 + length(event_type) as int) end
            as schema_id,
          body
        from journal"""
    ),
    "snapshot_decode": _snapshots(
        "select persistence_id, seq_nr, 'Shop.State' as manifest, 'json' as format, event_id, cents from best"
    ),
}
