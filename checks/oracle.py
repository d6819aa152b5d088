"""The queries of `checks.queries` as DuckDB SQL over the test tables."""

from __future__ import annotations

from checks.views import RECIPIENTS
from runtide.functions.text import STYLE_SHEET

AS_OF_MS = 1705381199000
DAY_MS = 86400000


def eastern(ms: str) -> str:
    return zoned(ms, "US/Eastern")


def zoned(ms: str, tz: str) -> str:
    return f"timezone('{tz}', timezone('UTC', make_timestamp(nullif({ms}, 0) * 1000)))"


def minutes(ms: str) -> str:
    return f"cast((nullif({ms}, 0) + 3000) // 6000 / 10.0 as float)"


LAYER_OF_JOB = "case {id} % 3 when 0 then 'Bronze' when 1 then 'Gold' else 'Platinum' end"
SLA_OF_LAYER = "case layer when 'Bronze' then '4:30 AM EST' when 'Gold' then '5:30 AM EST' end"
LATEST = """row_number() over (partition by {key} order by nullif(end_time_in_ms, 0) desc nulls last,
    try_cast(run_id as bigint) nulls last, run_id nulls last, attempt_number nulls last)"""


def cell(value: str) -> str:
    shown = f"upper(trim({value}, ' \t\n'))"
    return f"""concat('<td', case when {shown} = 'NOT STARTED' then ' class=''not-started'''
        when {shown} in ('FAILED', 'N') then ' class=''fail'''
        when {shown} in ('SUCCESS', 'Y', 'COMPLETED') or {shown} like '%COMPLETED%' then ' class=''success'''
        else '' end, '>', coalesce({value}, 'None'), '</td>')"""


def html_table(columns: dict[str, str], source: str, order: str) -> str:
    titles = "".join(f"<th>{title}</th>" for title in columns)
    row = "concat('<tr>', " + ", ".join(cell(value) for value in columns.values()) + ", '</tr>')"
    return f"""(select concat('<br><br><table border=''1''><thead><tr>{titles}</tr></thead><tbody>',
        coalesce(string_agg({row}, '' order by {order}), ''), '</tbody></table>') from {source})"""


STYLE = "'" + STYLE_SHEET.replace("'", "''") + "'"
SIGNED = "'<br><br>Thank you,<br>Team Data Integration'"


def phrase(names: str) -> str:
    """A sorted list of distinct names as a phrase."""
    return f"""case when coalesce(len({names}), 0) < 2 then coalesce({names}[1], '')
        else concat(array_to_string({names}[:len({names}) - 1], ', '), ' and ', {names}[len({names})]) end"""


def label(column: str, source: str) -> str:
    names = f"list(distinct {column} order by lower({column})) filter ({column} is not null)"
    return f"(select {phrase('names')} from (select {names} as names from {source}))"


def layer_status(source: str, second_shift: bool) -> str:
    latest = "max(case when run_name <> 'DE-Bronze-Audit_Smartsheets' then end_time_in_est end)"
    if second_shift:
        latest = f"timezone('US/Eastern', timezone('UTC', {latest}))"
    return f"""
    select *, concat(strftime(LatestRunTime, '%-I:%M %p'), case when LatestRunTime is not null then ' EST' end)
             as LatestRunTime_text,
        case when DependsOnWorkflowCount = SuccessCount then 'Completed' else 'Failed' end as Status,
        timestamp '1970-01-01' + to_minutes(sla_minute) as SLA_ts,
        timestamp '1970-01-01' + to_minutes(run_minute) as LatestRunTime_ts,
        case when run_minute <= sla_minute then 'Y' else 'N' end as SLA_MET, '' as Comment
    from (
      select *, hour(LatestRunTime) * 60 + minute(LatestRunTime) as run_minute,
        hour(try_strptime(replace(SLA, ' EST', ''), '%I:%M %p')) * 60
          + minute(try_strptime(replace(SLA, ' EST', ''), '%I:%M %p')) as sla_minute
      from (
        select layer as Layer, SLA, count(distinct DependsOn) as DependsOnWorkflowCount,
          count(distinct run_name) as RunWorkflowCount,
          count(distinct case when result_state = 'SUCCESS' then run_name end) as SuccessCount,
          count(distinct case when result_state <> 'SUCCESS' then run_name end) as FailCount,
          {latest} as LatestRunTime
        from {source} group by layer, SLA))"""


LAYER_COLUMNS = """Layer, SLA, DependsOnWorkflowCount, RunWorkflowCount, SuccessCount, FailCount, LatestRunTime,
    nullif(LatestRunTime_text, '') as LatestRunTime_only, Status, SLA_ts, LatestRunTime_ts, SLA_MET, Comment"""

REPORT_CELLS = {
    "Data Layer": '"Data Layer"',
    "SLA": "SLA",
    "Completion Time": '"Completion Time"',
    "Status": "Status",
    "SLA Met(Y/N)": '"SLA Met(Y/N)"',
    "Comment": "Comment",
}
FAILURE_CELLS = {name: name for name in ("WorkflowName", "RunId", "Layer", "SLA", "Status", "StatusMessage")}
REPORT_TABLE = html_table(REPORT_CELLS, "report", '"Data Layer" nulls first')
FAILURE_TABLE = html_table(FAILURE_CELLS, "failures", "SLA nulls first, WorkflowName, RunId")
SUCCESS_INTRO = f"""concat('Hello All,<br><br>Data refresh for ', {label('Layer', 'layers')},
    ' layer tables has completed successfully.<br>')"""
FAILURE_INTRO = f"""concat('Hello All,<br><br>Data refresh for ', {label('Layer', 'failures')},
    ' layer tables has failed. Below are the failed refresh timings.<br>')"""
STATUS_FROM = f"""
    select d.SubjectArea, d.WorkflowName, d.DependsOn, d.layer, {SLA_OF_LAYER} as SLA, t.* exclude (result_state),
      case when state_message = 'In run' and run_name is not null then 'SUCCESS' else result_state end as result_state,
      case when state_message = 'In run' and run_name is not null then 'SUCCESS' else result_state end as EventType
    from {{deps}} d left join today t on d.DependsOn = t.run_name"""
FRESH_FROM = """
    select * from {status} s where not exists (
      select 1 from notified n where n.job_id = s.job_id and n.EventType = s.EventType)"""

VIEWS = {
    "raw_runs": """
    select event_id as run_id, user_id as job_id, concat('WF-', user_id) as run_name,
      (epoch_us(ts) // 1000) as start_time, (event_id % 7) * 1000 as setup_duration,
      cast(round(value * 100) as bigint) * 600 as run_duration,
      case when event_type = 'view' then 0 else (epoch_us(ts) // 1000) + (event_id % 7) * 1000
        + cast(round(value * 100) as bigint) * 600 end as end_time,
      case when event_id % 5 = 0 then null else cast(event_id % 3 as int) end as attempt_number,
      case when event_id % 2 = 0 then 'PERIODIC' else 'ONE_TIME' end as "trigger",
      concat('https://jobs.example.com/', user_id, '/', event_id) as run_page_url,
      case event_type when 'error' then 'FAILED' when 'view' then null else 'SUCCESS' end as result_state,
      case event_type when 'view' then 'In run' else '' end as state_message,
      event_type = 'error' and event_id % 2 = 1 as stopped,
      case when event_id % 4 <> 0 then concat('c-', user_id % 8) end as cluster_id,
      event_type <> 'click' as has_spec, event_type = 'signup' as unnamed, 'MULTI_TASK' as format
    from events""",
    "flat": f"""
    select cast(run_id as varchar) as run_id, cast(job_id as varchar) as job_id, run_name,
      start_time as start_time_in_ms, {zoned('start_time', 'US/Pacific')} as start_time_in_pst,
      {eastern('start_time')} as start_time_in_est, {minutes('setup_duration')} as setup_duration_min,
      {minutes('run_duration')} as run_duration_min, end_time as end_time_in_ms,
      {zoned('end_time', 'US/Pacific')} as end_time_in_pst, {eastern('end_time')} as end_time_in_est,
      run_page_url, "trigger", attempt_number, result_state, state_message,
      cast(stopped as varchar) as user_cancelled_or_timedout, cluster_id,
      case when has_spec and not unnamed then concat('pool-', job_id % 4) else 'CUSTOM' end as cluster_name,
      case when has_spec then concat('v', run_id % 3) end as spark_version,
      case when has_spec and job_id % 2 = 0 then concat('ip-', job_id % 4) end as instance_pool_id,
      case when has_spec then concat('node-', run_id % 5) end as node_type_id,
      case when has_spec then case when job_id % 3 = 0 then 'SINGLE_USER' else 'NONE' end end as data_security_mode,
      case when has_spec and run_id % 2 = 0 then cast(run_id % 10 as varchar) end as num_workers,
      case when has_spec and run_id % 2 = 1 then cast(run_id % 3 as varchar) end as min_workers,
      case when has_spec and run_id % 2 = 1 then cast(run_id % 3 + 4 as varchar) end as max_workers, format
    from raw_runs""",
    "lookback": f"""
    select * from flat where start_time_in_ms between {AS_OF_MS - DAY_MS} and {AS_OF_MS}""",
    "today": f"""
    select * exclude (place), run_name as BronzeWorkFlowName
    from (select *, {LATEST.format(key='job_id')} as place from lookback)
    where place = 1 and cast(start_time_in_est as date) = date '2024-01-15'""",
    "dependencies": f"""
    select 'Area' as SubjectArea, concat('DE-Gold-', job_id % 3) as WorkflowName, concat('WF-', job_id) as DependsOn,
      {LAYER_OF_JOB.format(id='job_id')} as layer
    from (select distinct user_id as job_id from events)
    union all select 'Area', 'DE-Gold-0', 'WF-never', 'Bronze'""",
    "dependencies_ok": """
    select * from dependencies where DependsOn in (
      select run_name from today where result_state = 'SUCCESS' or state_message = 'In run')""",
    "notification_log": f"""
    select 'WF' as ObjectType, run_name as WorkflowName, job_id,
      case when failed = (j % 8 = 2) then 'SUCCESS' else 'FAILED' end as EventType,
      EventDTMM, inserted as NotificationDttm, '{RECIPIENTS}' as NotificationSentTo,
      'earlier report' as NotificationEmailContent, {LAYER_OF_JOB.format(id='j')} as layer, inserted as InsertedOn
    from (select *, cast(job_id as bigint) as j,
        case when j % 4 = 0 or j % 8 = 2 then timestamp '2024-01-15 12:00:00'
          when j % 4 = 1 then timestamp '2024-01-14 12:00:00' else timestamp '2024-01-13 12:00:00' end as inserted
      from (select job_id, run_name, coalesce(result_state, 'SUCCESS') = 'FAILED' as failed,
          end_time_in_est as EventDTMM
        from flat where cast(start_time_in_est as date) = date '2024-01-15'
        qualify row_number() over (partition by job_id order by end_time_in_ms desc, cast(run_id as bigint) desc) = 1))
    """,
    "notified": """
    select distinct job_id, EventType from notification_log where cast(InsertedOn as date) = date '2024-01-15'""",
    "status": STATUS_FROM.format(deps="dependencies"),
    "fresh": FRESH_FROM.format(status="status"),
    "failed": """
    select * from fresh where result_state = 'FAILED' and job_id not in (select job_id from notified)""",
    "layers": layer_status("fresh", second_shift=True),
    "report": """
    select Layer as "Data Layer", SLA, nullif(LatestRunTime_text, '') as "Completion Time", Status,
      SLA_MET as "SLA Met(Y/N)", Comment
    from layers""",
    "failures": """
    select distinct run_name as WorkflowName, run_id as RunId, layer as Layer, SLA, result_state as Status,
      state_message as StatusMessage
    from failed""",
    "status_ok": STATUS_FROM.format(deps="dependencies_ok"),
    "fresh_ok": FRESH_FROM.format(status="status_ok"),
    "layers_ok": layer_status("fresh_ok", second_shift=True),
    "report_ok": """
    select Layer as "Data Layer", SLA, nullif(LatestRunTime_text, '') as "Completion Time", Status,
      SLA_MET as "SLA Met(Y/N)", Comment
    from layers_ok""",
}

STATUS_OUTPUT = "layer, SLA, DependsOn, run_id, job_id, run_name, result_state, EventType"
RUN_LOG_UPSERT = """
    , old as (
      select cast(run_id as bigint) as RunId,
        coalesce(attempt_number, 0) + case when cast(run_id as bigint) % 3 = 0 then 0 else 100 end as attempt_number,
        cast(job_id as bigint) as WorkFlowId, {old}
      from flat),
    new as (
      select cast(run_id as bigint) as RunId, coalesce(attempt_number, 0) as attempt_number,
        cast(job_id as bigint) as WorkFlowId, {new}
      from flat)
    select n.* replace (o.WorkFlowMetSLAFlag as WorkFlowMetSLAFlag) from new n
      left join old o on n.RunId = o.RunId and n.WorkFlowId = o.WorkFlowId and n.attempt_number = o.attempt_number
    union all
    select * from old o where not exists (select 1 from new n
      where n.RunId = o.RunId and n.WorkFlowId = o.WorkFlowId and n.attempt_number = o.attempt_number)"""
#: Runs start at whole seconds of UTC, and their partition is the date of that.
RUN_LOG_DAY = ", cast(epoch_ms(start_time_in_ms) as date) as PartitionDate"
GATE = """
    select count(*) as total_layers, count(*) filter (DependsOnWorkflowCount = SuccessCount) as matched_layers,
      count(*) > 0 and count(*) = count(*) filter (DependsOnWorkflowCount = SuccessCount) as gate_open"""
LOGGED = """
    select distinct 'WF' as ObjectType, run_name as WorkflowName, job_id, result_state as EventType,
      end_time_in_est as EventDTMM, timestamp '2024-01-15 23:59:59' as NotificationDttm,
      '{to}' as NotificationSentTo, {body} as NotificationEmailContent, layer,
      timestamp '2024-01-15 23:59:59' as InsertedOn, date '2024-01-15' as InsertedDate
    from {source}"""
ORDINAL = """case when day({d}) between 11 and 13 then 'th' when day({d}) % 10 = 1 then 'st'
    when day({d}) % 10 = 2 then 'nd' when day({d}) % 10 = 3 then 'rd' else 'th' end"""
RUN_LOG_VALUES = """
    "trigger" as WorkFlowStartType, cast(start_time_in_est as varchar) as WorkFlowStartDttm,
    {end} as WorkFlowEndDttm, {duration} as WorkFlowDuration, {state} as WorkFlowState,
    state_message as WorkFlowMessage, {flag} as WorkFlowMetSLAFlag, {inserted} as InsertedOn"""
OLD_VALUES = {
    "end": "cast(null as varchar)",
    "duration": "cast(null as varchar)",
    "state": "'OLD'",
    "flag": "'Y'",
    "inserted": "timestamp '2024-01-14 12:00:00'",
}
NEW_VALUES = {
    "end": "cast(end_time_in_est as varchar)",
    "duration": "cast(run_duration_min as varchar)",
    "state": "result_state",
    "inserted": "timestamp '2024-01-15 23:59:59'",
}


def one_body(intro: str, table: str, more: str = "''") -> str:
    return f"concat({intro}, {STYLE}, {table}, {more}, {SIGNED})"


def in_ok(sql: str) -> str:
    """SQL about the report of the day on which every layer is complete."""
    return sql.replace("from layers", "from layers_ok").replace("from report", "from report_ok")


SUCCESS_BODY_OK = in_ok(one_body(SUCCESS_INTRO, REPORT_TABLE))

#: Once for each way to leave out what was notified: one message, logged for each failed row.
CYCLES = f"""
    select dedupe, 'failure' as kind, 'Prod - EDW - Data refresh - 15th January 2024' as subject,
      '{RECIPIENTS.replace(';', ', ')}' as recipients, '' as cc, cast(0 as int) as part, cast(1 as int) as parts,
      {one_body(FAILURE_INTRO, FAILURE_TABLE)} as body, timestamp '2024-01-15 23:59:59' as CreatedOn,
      (select count(*) from (select distinct run_name, job_id, result_state, end_time_in_est, layer from failed)) as n_logged
    from (select unnest(['before_status', 'after_status']) as dedupe)
    where (select count(*) from failures) > 0"""

RUN_LOG_WRITTEN = RUN_LOG_UPSERT.format(
    old=RUN_LOG_VALUES.format(**OLD_VALUES) + RUN_LOG_DAY,
    new=RUN_LOG_VALUES.format(flag="cast(null as varchar)", **NEW_VALUES) + RUN_LOG_DAY,
)
CHAINS = """
    , chains as (
      select concat('WF-', job) as WorkflowName, concat('WF-', above) as DependsOn
      from (select job, unnest(case when job = 1 then [0, 4] else [job // 3] end) as above
        from (select distinct user_id as job from events) where job > 0)),
    walk as (
      select WorkflowName, DependsOn as Ancestor, 1 as Depth from chains
      union select walk.WorkflowName, chains.DependsOn, Depth + 1 from walk join chains on Ancestor = chains.WorkflowName
      where Depth < 16),
    closure as (select WorkflowName, Ancestor, min(Depth) as Depth from walk group by all)"""
MONTH = f"""
    select d.layer, {SLA_OF_LAYER} as SLA, d.DependsOn, t.run_name, t.result_state, cast(start_time_in_est as date) as day
    from dependencies d left join flat t on d.DependsOn = t.run_name"""

FINAL = {
    "run_log_bucketed": RUN_LOG_WRITTEN,
    "runs_scan_indexed": f"""
    select * from flat where start_time_in_ms between {AS_OF_MS - 2 * DAY_MS} and {AS_OF_MS}""",
    "pages_quarantined": """
    select run_id, null::varchar as page from flat where cast(run_id as bigint) // 100 % 7 <> 3
    union all select null, concat('{"runs": [{"run_id": ', page, ', ')
    from (select distinct cast(run_id as bigint) // 100 as page from flat) where page % 7 = 3""",
    "run_schema_of_ddl": "select * from flat",
    "runs_newest_first": """
    select run_id, row_number() over (order by start_time_in_pst desc nulls last, cast(run_id as bigint)) - 1 as position
    from flat""",
    "notifications_today_in_order": """
    select *, row_number() over (order by ObjectType desc, WorkflowName nulls first, job_id nulls first) - 1 as position
    from notification_log where cast(NotificationDttm as date) = date '2024-01-15'""",
    "latest_run_streamed": f"""
    select * exclude (place) from (select *, {LATEST.format(key='job_id')} as place from flat) where place = 1""",
    "dependency_closure": f"{CHAINS} select WorkflowName, Ancestor, cast(Depth as int) as Depth from closure",
    "failed_root_causes": f"""{CHAINS},
    broke as (
      select run_name as name from (select *, {LATEST.format(key='job_id')} as place from flat)
      where place = 1 and result_state = 'FAILED'),
    above as (select * from closure where WorkflowName in (from broke) and Ancestor in (from broke)),
    roots as (
      select name from broke where not exists (select 1 from above a where a.WorkflowName = name and not exists (
        select 1 from closure c where c.WorkflowName = a.Ancestor and c.Ancestor = name)))
    select name as WorkflowName, name as RootCause, cast(0 as int) as Depth from roots
    union all select WorkflowName, Ancestor, cast(Depth as int) from above where Ancestor in (from roots) and WorkflowName <> Ancestor""",
    "sla_as_of": f"""
    , history as (
      select layer, case when n < 2 or layer <> 'Platinum' then concat(length(layer) + n, ':30 AM EST') end as sla_text,
        [date '2024-01-05', date '2024-01-12', date '2024-01-20'][n + 1] as valid_from
      from (select distinct {LAYER_OF_JOB.format(id='user_id')} as layer from events), (select unnest([0, 1, 2]) as n)),
    runs as (
      select run_id, {LAYER_OF_JOB.format(id='cast(job_id as bigint)')} as layer, cast(start_time_in_est as date) as day,
        end_time_in_est from flat),
    dated as (
      select r.*, h.sla_text as SLA, r.day + interval 1 day + to_minutes(
        30 + 60 * cast(split_part(h.sla_text, ':', 1) as bigint)) as deadline
      from runs r asof left join history h on r.layer = h.layer and r.day >= h.valid_from)
    select *, case when end_time_in_est < deadline + interval 1 minute then 'Y' else 'N' end as SLA_MET from dated""",
    "layer_counts_rollup": f"""
    , month as ({MONTH})
    select layer, SLA, day, count(distinct DependsOn) as DependsOnWorkflowCount, count(distinct run_name) as RunWorkflowCount,
      count(distinct case when result_state = 'SUCCESS' then run_name end) as SuccessCount,
      count(distinct case when result_state <> 'SUCCESS' then run_name end) as FailCount
    from month group by grouping sets ((layer, SLA), (layer, SLA, day)) having grouping(day) = 1 or day is not null""",
    "run_cycle_twice": CYCLES,
    "run_cycle_interrupted": CYCLES,
    "run_count_observed": f"""
    select count(*) as run_count from flat where start_time_in_ms between {AS_OF_MS - 2 * DAY_MS} and {AS_OF_MS}""",
    "runs_scan": "select * from flat",
    "runs_scan_window": f"""
    select * from flat where start_time_in_ms >= {1_705_104_000_000} and start_time_in_ms < {1_705_104_000_000 + 3 * DAY_MS}""",
    "dependencies_scan": "select * from dependencies",
    "file_inventory_of_pages": """
    select distinct concat('day=', cast(cast(ts as date) as varchar)) as folder, cast(1 as bigint) as folders,
      true as has_files from events""",
    "file_inventory_of_listing": """
    , listing as (
      select concat('store/', regexp_replace(url, '^[a-z]+://', '')) as path, page_id * 1000 as modificationTime
      from pages where url is not null),
    parts as (select *, string_split(rtrim(path[7:], '/'), '/') as p, path not like '%/' as is_file from listing),
    above as (
      select concat('store/', array_to_string(p[:n], '/')) as path, max(modificationTime) as modificationTime
      from (select p, modificationTime, unnest(range(1, len(p) - is_file::int + 1)) as n from parts) group by 1),
    every as (
      select path, modificationTime, 'file' as type from parts where is_file
      union all select path, modificationTime, 'folder' from above)
    select path, string_split(path, '/')[-1] as name, modificationTime, type from every""",
    "runs_flatten": "select * from flat",
    "path_lookup": """
    select f.run_id, f.result_state, f.max_workers, cast(null as varchar) as no_such_key,
      cast(null as varchar) as not_an_object, cast(json_extract_string(e.props, '$.k') as int) as k
    from (select cast(run_id as bigint) as run_id, result_state, cast(max_workers as int) as max_workers from flat) f
    join events e on e.event_id = f.run_id""",
    "runs_lookback_two_days": f"""
    select run_id, job_id, start_time_in_ms from flat
    where start_time_in_ms between {AS_OF_MS - 2 * DAY_MS} and {AS_OF_MS}""",
    "runs_recent_top_1000": """
    select run_id, job_id, start_time_in_ms from flat
    order by start_time_in_ms desc nulls last, cast(run_id as bigint) limit 1000""",
    "latest_run_of_each_job": f"""
    select * exclude (place) from (select *, {LATEST.format(key='job_id')} as place from flat) where place = 1""",
    "runs_today_latest": "select * from today",
    "run_count": "select count(*) as run_count from flat",
    "effective_state": """
    select run_id, state as result_state, state as EventType
    from (select run_id, case when state_message = 'In run' and run_name is not null then 'SUCCESS'
      else result_state end as state from flat)""",
    "run_log_upsert": RUN_LOG_UPSERT.format(
        old=RUN_LOG_VALUES.format(**OLD_VALUES), new=RUN_LOG_VALUES.format(flag="cast(null as varchar)", **NEW_VALUES)
    ),
    "run_log_written": RUN_LOG_WRITTEN,
    "notifications_appended": LOGGED.format(to=RECIPIENTS, body="'body'", source="failed"),
    "dependency_status": "select d.*, t.* from dependencies d left join today t on d.DependsOn = t.run_name",
    "dependency_rejoin": """
    , shared as (
      select * replace (concat('WF-', cast(job_id as bigint) % 50) as run_name) from today)
    select d.DependsOn, d.layer, a.run_id, a.job_id, a.run_name, count(*) as copies
    from dependencies d left join shared a on d.DependsOn = a.run_name left join shared b on d.DependsOn = b.run_name
    group by all""",
    "sla_by_layer": f"select *, {SLA_OF_LAYER} as SLA from dependencies",
    "sla_by_layer_table": "select *, concat(length(layer), ':30 PM EST') as SLA from dependencies",
    "notified_today": "select * from notified",
    "not_yet_notified": f"select {STATUS_OUTPUT} from fresh",
    "failed_runs": f"select {STATUS_OUTPUT} from failed",
    "failed_runs_by_event": f"select {STATUS_OUTPUT} from fresh where result_state = 'FAILED'",
    "layer_status": f"select {LAYER_COLUMNS} from layers",
    "layer_status_before_dedupe": f"select {LAYER_COLUMNS} from ({layer_status('status', second_shift=False)})",
    "layer_report": "select * from report",
    "failure_report": "select * from failures",
    "all_layers_gate": f"{GATE} from layers",
    "all_layers_gate_open": f"{GATE} from ({layer_status('status_ok', second_shift=True)})",
    "layer_label": f"select {label('layer', 'dependencies')} as layer_label",
    "name_phrases": f"""
    select o_custkey, {phrase('names')} as phrase from (
      select o_custkey, list(distinct o_orderpriority order by lower(o_orderpriority)) as names
      from orders group by o_custkey)""",
    "date_labels": f"""
    select o_orderkey, concat(day(o_orderdate), {ORDINAL.format(d='o_orderdate')}, strftime(o_orderdate, ' %B %Y'))
      as label from orders""",
    "recipients_of_text": """
    select c_custkey, place, case place when 0 then concat(lower(replace(c_name, '#', '.')), '@example.com')
      when 1 then concat(c_mktsegment, '@example.com') else '' end as address
    from customer cross join (select cast(unnest([0, 1, 2]) as int) as place)""",
    "cell_classes": """
    select event_id, case event_type when 'error' then 'fail' when 'view' then 'not-started'
      when 'click' then 'success' when 'purchase' then case event_id % 3 when 0 then 'success' when 1 then 'fail' end
      end as css_class from events""",
    "html_layer_report": f"""
    select cast(0 as int) as part, cast(1 as int) as parts, {one_body(SUCCESS_INTRO, REPORT_TABLE)} as body""",
    "html_long_report": f"""
    select cast(place // 1000 as int) as part, cast(any_value(parts) as int) as parts,
      concat('<br><br><table border=''1''><thead><tr><th>o_orderpriority</th><th>o_orderstatus</th><th>o_orderkey</th></tr></thead><tbody>',
        string_agg(line, '' order by place), '</tbody></table>') as html
    from (select concat('<tr>', {cell('o_orderpriority')}, {cell('o_orderstatus')}, {cell('cast(o_orderkey as varchar)')}, '</tr>') as line,
        row_number() over (order by o_orderpriority, cast(o_orderkey as varchar)) - 1 as place,
        (count(*) over () + 999) // 1000 as parts from orders)
    group by place // 1000""",
    "html_two_tables": f"""
    select cast(0 as int) as part, cast(1 as int) as parts,
      {one_body(FAILURE_INTRO, FAILURE_TABLE, f"'<br><br>SFTP Workflow Status', {STYLE}, {REPORT_TABLE}")} as body""",
    "notification_rows_of_failures": LOGGED.format(to=RECIPIENTS, body="'body'", source="failed"),
    "notifications_today": """
    select * from notification_log where cast(NotificationDttm as date) = date '2024-01-15'""",
    "monitor_outbox": f"""
    select 'failure' as kind, 'Prod - EDW - Data refresh - 15th January 2024' as subject,
      '{RECIPIENTS.replace(';', ', ')}' as recipients, cast(0 as int) as part, cast(1 as int) as parts,
      {one_body(FAILURE_INTRO, FAILURE_TABLE)} as body, timestamp '2024-01-15 23:59:59' as CreatedOn
    where (select count(*) from failures) > 0""",
    "monitor_notifications": f"""
    {LOGGED.format(to=RECIPIENTS, body=SUCCESS_BODY_OK, source='fresh_ok')}
    where (select count(*) > 0 and count(*) = count(*) filter (DependsOnWorkflowCount = SuccessCount)
      from layers_ok)""",
}


def with_views(final: str) -> str:
    views = ",\n".join(f"{name} as ({sql}\n)" for name, sql in VIEWS.items())
    return f"with recursive {views}\n{final.strip()}"


ORACLE_SQL = {name: with_views(final) for name, final in FINAL.items()}
