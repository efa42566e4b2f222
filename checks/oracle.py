"""DuckDB SQL for the registered queries, over the given tables."""

from __future__ import annotations

import zlib

# The given events read as bronze pitches and corrections.
PITCHES = """
pitches as (
  select event_id,
    ts as event_time,
    ts + to_seconds(event_id % 97) as ingest_time,
    event_id // 1000 as game_pk,
    cast((event_id % 1000) // 5 + 1 as integer) as at_bat_number,
    cast(event_id % 1000 % 5 + 1 as integer) as pitch_number,
    cast((event_id % 1000) // 100 + 1 as integer) as inning,
    case when ((event_id % 1000) // 50) % 2 = 0 then 'Top' else 'Bot' end as inning_topbot,
    user_id % 4 + case when ((event_id % 1000) // 50) % 2 = 0 then 100 else 200 end as pitcher_id,
    event_id % 97 + 700 as batter_id,
    case event_type when 'view' then 'FF' when 'click' then 'SL'
      when 'signup' then 'CH' when 'purchase' then 'CU' end as pitch_type,
    case when event_id % 50 <> 7
      then 85 + (cast(round(value * 100) as bigint) % 1500) / 100.0::double end as release_speed,
    cast(2000 + 5 * cast(json_extract_string(props, '$.k') as integer) as double) as release_spin_rate,
    (event_id % 41 - 20) / 10.0::double as plate_x,
    (event_id % 37) / 10.0::double as plate_z,
    cast(event_id % 14 + 1 as integer) as zone,
    cast(event_id % 4 as integer) as balls,
    cast(event_id % 3 as integer) as strikes,
    cast((event_id // 5) % 3 as integer) as outs_when_up,
    case when event_id % 3 = 0 then 700 + event_id % 89 end as on_1b,
    case when event_id % 5 = 0 then 700 + event_id % 83 end as on_2b,
    case when event_id % 7 = 0 then 700 + event_id % 79 end as on_3b,
    event_type as description,
    case when event_id % 5 = 4 then event_type end as events,
    cast((event_id % 1000) // 90 as integer) as home_score,
    cast((event_id % 1000) // 70 as integer) as away_score,
    cast(null as varchar) as correction_of,
    event_id as source_offset,
    cast(event_id // 1000 % 3 as integer) as kafka_partition
  from events
)"""

BRONZE = (
    PITCHES
    + """,
bronze as (
  select * exclude (event_id), false as is_late_arrival, false as is_duplicate from pitches
  union all
  select * exclude (event_id), false, true from pitches where event_id % 200 = 0
  union all
  select * exclude (event_id) replace (event_time - to_seconds(event_id % 571 + 30) as event_time), true, false
  from pitches where event_id % 33 = 0
)"""
)

CORRECTIONS = """
corrections as (
  select event_time + to_minutes(m) as event_time, event_time + to_minutes(m) as ingest_time, game_pk,
    uid as original_pitch_uid, field, old_value, new_value
  from (
    select *, concat_ws(':', game_pk, at_bat_number, pitch_number) as u from pitches
  ) p, lateral (values
    (event_id % 100 = 0, 'pitch_type', case when event_id % 300 <> 0 then 'SI' end, pitch_type, 5, u),
    (event_id % 200 = 0, 'pitch_type', case when event_id % 600 <> 0 then 'FC' end, pitch_type, 30, u),
    (event_id % 150 = 0, 'zone', cast(event_id % 9 + 1 as varchar), cast(zone as varchar), 12, u),
    (event_id % 250 = 0, 'release_speed', 'n/a', cast(release_speed as varchar), 7, u),
    (event_id % 350 = 0, 'release_speed', '91.5', cast(release_speed as varchar), 9, u),
    (event_id % 400 = 0, 'pitch_type', 'KC', null, 45, '0' || u)
  ) v(hit, field, new_value, old_value, m, uid)
  where hit
)"""

# Canonical pitches.
STAGED = (
    BRONZE
    + ","
    + CORRECTIONS
    + """,
dedup as (
  select * from bronze where is_duplicate = false
  qualify row_number() over (
    partition by game_pk, at_bat_number, pitch_number
    order by ingest_time desc, is_late_arrival, event_time desc, kafka_partition desc, source_offset desc) = 1
),
latest as (
  select original_pitch_uid, field, new_value from corrections
  qualify row_number() over (
    partition by original_pitch_uid, field
    order by ingest_time desc, event_time desc, new_value desc nulls last) = 1
),
staged as (
  select d.* exclude (is_late_arrival, is_duplicate, correction_of, source_offset, kafka_partition)
    replace (coalesce(l.new_value, d.pitch_type) as pitch_type)
  from dedup d left join latest l
    on l.field = 'pitch_type'
    and l.original_pitch_uid = cast(d.game_pk as varchar) || ':' || cast(d.at_bat_number as varchar)
      || ':' || cast(d.pitch_number as varchar)
)"""
)

ORDINAL = "partition by game_pk, pitcher_id order by at_bat_number, pitch_number"


def mean(column: str, frame: str) -> str:
    """Mean by whole millionths over a frame, which no row order can change."""
    unit = f"cast(round(({column}) * 1000000.0::double) as bigint)"
    return f"cast(sum({unit}) over ({frame}) as bigint) / (count({unit}) over ({frame}) * 1000000.0::double)"


def rounded(x: str, digits: int) -> str:
    unit = f"1e{digits}"
    return f"floor(({x}) * {unit} + 0.5e0) / {unit}"


def group_mean(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,6))) as double) / count({column})"


def _last(n: int) -> str:
    return f"{ORDINAL} rows between {n - 1} preceding and current row"


def _all_fields() -> str:
    types = {
        "pitch_type": "varchar",
        "release_speed": "double",
        "release_spin_rate": "double",
        "plate_x": "double",
        "plate_z": "double",
        "zone": "integer",
        "description": "varchar",
        "events": "varchar",
    }
    sets = ", ".join(
        f"coalesce(try_cast((select new_value from latest l where l.field = '{f}' and l.original_pitch_uid = "
        f"concat_ws(':', d.game_pk, d.at_bat_number, d.pitch_number)) as {t}), d.{f}) as {f}"
        for f, t in types.items()
    )
    return f"""
select d.* exclude (is_late_arrival, is_duplicate, correction_of, source_offset, kafka_partition)
  replace ({sets})
from dedup d"""


# Canonical pitches with every correctable field corrected.
CORRECTED = f"{STAGED}, corrected as ({_all_fields()})"


def windowed(relation: str) -> str:
    return f"""
ordered as (
  select *, row_number() over ({ORDINAL}) as idx from {relation}
),
windowed as (
  select event_time, game_pk, pitcher_id, at_bat_number, pitch_number, idx as pitches_thrown_so_far,
    {mean("release_speed", _last(20))} as velocity_last_20_avg,
    {mean("release_spin_rate", _last(20))} as spin_last_20_avg,
    {mean("case when idx <= 20 then release_speed end", "partition by game_pk, pitcher_id")} as velocity_first_20_avg,
    {mean("case when idx <= 20 then release_spin_rate end", "partition by game_pk, pitcher_id")} as spin_first_20_avg
  from ordered
)"""


ORACLE: dict[str, str] = {
    "stg_pitches": f"with {STAGED} select * from staged",
    "stg_all_fields": f"with {CORRECTED} select * from corrected",
    "pitcher_game_window": f"with {STAGED}, {windowed('staged')} select * from windowed",
    "silver_pitch_events": f"""with {BRONZE}
select concat_ws(':', game_pk, at_bat_number, pitch_number) as pitch_id, * exclude (ingest_time),
  cast(event_time as date) as event_day
from bronze""",
    "pitcher_game_fatigue": f"""with {STAGED}
select game_pk, pitcher_id, min(event_time) as first_pitch_time, max(event_time) as last_pitch_time,
  count(*) as pitch_count, max(inning) as max_inning,
  {group_mean("release_speed")} as avg_release_speed, {group_mean("release_spin_rate")} as avg_release_spin_rate,
  case when count(*) < 25 then 'low' when count(*) < 50 then 'medium' else 'high' end as fatigue_bucket
from dedup group by all""",
    "pitcher_game_fatigue_raw": f"""with {BRONZE}
select game_pk, pitcher_id, min(event_time) as first_pitch_time, max(event_time) as last_pitch_time,
  count(*) as pitch_count, max(inning) as max_inning,
  {group_mean("release_speed")} as avg_release_speed, {group_mean("release_spin_rate")} as avg_release_spin_rate,
  case when count(*) < 25 then 'low' when count(*) < 50 then 'medium' else 'high' end as fatigue_bucket
from bronze where not is_duplicate group by all""",
    "workload_ranking": f"""with {STAGED}
select game_pk, pitcher_id, count(*) as pitch_count, {group_mean("release_speed")} as avg_release_speed,
  case when count(*) < 25 then 'low' when count(*) < 50 then 'medium' else 'high' end as fatigue_bucket
from dedup group by all order by pitch_count desc, game_pk, pitcher_id""",
}


# Game-state events by comparing neighbouring pitches of a game.
GAME_ORDINAL = "partition by game_pk order by inning, inning_topbot desc, at_bat_number, pitch_number"


def transitions_of(relation: str) -> str:
    return f"""
stepped as (
  select *, lag(inning) over w as p_inning, lag(inning_topbot) over w as p_half, lag(pitcher_id) over w as p_pitcher,
    lag(home_score) over w as p_home, lag(away_score) over w as p_away, row_number() over w as step
  from {relation} window w as ({GAME_ORDINAL})
),
state_kinds as (
  select *, 'game_start' as event_type, true as named from stepped where step = 1
  union all select *, 'inning_start', false from stepped
    where step > 1 and (inning <> p_inning or inning_topbot <> p_half)
  union all select *, 'pitching_change', true from stepped
    where step > 1 and inning = p_inning and inning_topbot = p_half and pitcher_id <> p_pitcher
  union all select *, 'scoring_play', false from stepped
    where step > 1 and (home_score > p_home or away_score > p_away)
),
states as (
  select event_time, ingest_time, game_pk, inning, inning_topbot, home_score, away_score,
    case when named and inning_topbot = 'Top' then pitcher_id end as home_pitcher_id,
    case when named and inning_topbot = 'Bot' then pitcher_id end as away_pitcher_id,
    batter_id as next_batter_id, event_type
  from state_kinds
)"""


STATES = STAGED + "," + transitions_of("staged")


def _word(seed: int, tag: str, at: int) -> str:
    digest = f"md5(concat_ws(':', game_pk, at_bat_number, pitch_number) || '|{seed}|{tag}')"
    return f"cast(('0x' || substr({digest}, {8 * at + 1}, 8)) as bigint)"


def _hit(seed: int, at: int, rate: float) -> str:
    return f"{_word(seed, 'draw', at)} < {round(rate * 2**32)}"


PERTURBED = (
    PITCHES
    + f""",
clean as (select * exclude (event_id), false as is_late_arrival, false as is_duplicate from pitches),
perturbed as (
  select * from clean
  union all select * replace (true as is_duplicate) from clean where {_hit(7, 0, 0.005)}
  union all select * replace (true as is_late_arrival,
    event_time - to_seconds({_word(7, "amount", 0)} % 271 + 30) as event_time) from clean where {_hit(7, 1, 0.03)}
),
drawn as (
  select event_time + to_minutes({_word(7, "amount", 2)} % 41 + 5) as event_time,
    ingest_time + to_minutes({_word(7, "amount", 3)} % 41 + 5) as ingest_time, game_pk,
    concat_ws(':', game_pk, at_bat_number, pitch_number) as original_pitch_uid, 'pitch_type' as field,
    pitch_type as old_value,
    case pitch_type
      when 'FF' then ['FT', 'SI'][{_word(7, "amount", 1)} % 2 + 1]
      when 'SL' then ['CU', 'FC'][{_word(7, "amount", 1)} % 2 + 1]
      when 'CU' then ['SL', 'KC'][{_word(7, "amount", 1)} % 2 + 1]
      when 'CH' then 'FS' end as new_value
  from clean where pitch_type is not null and {_hit(7, 2, 0.01)}
)"""
)

RAW = (
    PITCHES
    + """,
raw_text as (
  select event_id, event_time, ingest_time, game_pk, case when event_id % 501 <> 500 then at_bat_number end as at_bat_number,
    pitch_number, inning,
    case when event_id % 8 in (0, 1) then 'Top' else 'Bot' end as inning_topbot,
    pitcher_id, batter_id,
    case event_id % 6 when 0 then null when 1 then null when 2 then 'SL' else pitch_type end as pitch_type,
    case event_id % 7 when 0 then null when 1 then null when 2 then null when 3 then 95.1::double
      else release_speed end as release_speed,
    release_spin_rate, plate_x, plate_z,
    case event_id % 5 when 0 then null when 1 then 5 when 2 then null when 3 then -2 else zone end as zone,
    balls, strikes, outs_when_up, on_1b, on_2b, on_3b, description, events, 0 as home_score, away_score,
    false as is_late_arrival, false as is_duplicate, correction_of
  from pitches
)"""
)


def _null_checks(table: str, relation: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select 'not_null' as check_name, '{table}.{c}' as subject, count(*) filter ({c} is null) as violations "
        f"from {relation}"
        for c in columns
    )


def _unique_check(table: str, relation: str, keys: list[str]) -> str:
    k = ",".join(keys)
    return (
        f"select 'unique', '{table}({k})', count(*) from "
        f"(select {k} from {relation} group by all having count(*) > 1)"
    )


def _allowed_check(table: str, relation: str, column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"select 'allowed_values', '{table}.{column}', count(*) filter ({column} not in ({listed})) from {relation}"


def _reference_check(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"select 'references', '{child}.{column}', count(*) from {child} c "
        f"where {column} is not null and not exists (select 1 from {parent} p where p.{key} = c.{column})"
    )


_REQUIRED = (
    "event_time ingest_time game_pk at_bat_number pitch_number inning inning_topbot pitcher_id batter_id "
    "balls strikes outs_when_up home_score away_score is_late_arrival is_duplicate"
).split()

_QUALITY = " union all ".join(
    [
        _null_checks("pitches", "bronze", _REQUIRED + ["pitch_type", "release_speed", "on_1b"]),
        _null_checks("lineitem", "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"]),
        _unique_check("pitches", "bronze", ["game_pk", "at_bat_number", "pitch_number"]),
        _unique_check("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
        _unique_check("orders", "orders", ["o_orderkey"]),
        _unique_check("documents", "documents", ["doc_id"]),
        _allowed_check("pitches", "bronze", "inning_topbot", ["Top", "Bot"]),
        _allowed_check("events", "events", "event_type", ["view", "click"]),
        _allowed_check("orders", "orders", "o_orderstatus", ["F", "O", "P"]),
        _reference_check("lineitem", "l_orderkey", "orders", "o_orderkey"),
        _reference_check("orders", "o_custkey", "customer", "c_custkey"),
        _reference_check("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _reference_check("customer", "c_nationkey", "nation", "n_nationkey"),
        _reference_check("documents", "doc_id", "labels", "doc_id"),
    ]
)

_PLAYS = """
select o_orderkey as game_pk, cast(o_orderkey % 9 + 1 as integer) as inning, half as inning_topbot,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as about_time, incoming as incoming_pitcher_id,
  outgoing as outgoing_pitcher_id
from orders, lateral (values
  (o_orderstatus = 'F', 'Top', o_custkey, o_orderkey),
  (o_orderkey % 3 = 0, 'Top', o_custkey + 1, o_custkey),
  (o_orderkey % 5 = 0, case when o_orderkey % 2 = 0 then 'Bottom' else '' end, o_orderkey, o_custkey)
) v(hit, half, incoming, outgoing)
where hit"""

_LINEUPS = """
select o_orderkey as game_pk, side, batting_slot, batter_id
from orders, lateral (values
  (o_orderkey % 4 <> 0, 'home', 1, o_orderkey),
  (o_orderkey % 4 <> 0, 'home', 2, o_custkey),
  (o_orderkey % 7 <> 0, 'away', 1, o_custkey),
  (o_orderkey % 7 <> 0, 'away', 2, o_orderkey),
  (o_orderkey % 7 <> 0, 'away', 3, o_orderkey + 1)
) v(present, side, batting_slot, batter_id)
where present"""

ORACLE |= {
    "dedup_natural": """
select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc, l_discount desc,
    l_tax desc, l_returnflag desc, l_linestatus desc) = 1""",
    "first_20_pitches": f"""with {STAGED}
select game_pk, pitcher_id, at_bat_number, pitch_number, release_speed from dedup
qualify row_number() over ({ORDINAL}) <= 20""",
    "game_state_events": f"with {STATES} select * from states",
    "game_state_counts": f"with {STATES} select event_type, count(*) as n from states group by 1",
    "role_changes": """
select * from (select conv_id, turn, role,
  lag(role) over (partition by conv_id order by turn, role) as previous_role from conversations)
where role <> previous_role""",
    "synth_event_time": f"""with {STAGED},
stepped as (
  select *, lag(at_bat_number) over ({GAME_ORDINAL}) as p from staged
),
gapped as (
  select *, case when p is null then 0 when p <> at_bat_number then 90 else 23 end as gap from stepped
)
select game_pk, at_bat_number, pitch_number, inning, inning_topbot,
  cast(cast(event_time as date) as timestamp) + interval 19 hours
    + to_seconds(cast(sum(gap) over ({GAME_ORDINAL}) as bigint)) as event_time
from gapped""",
    "late_split": f"""with {BRONZE}
select game_pk, pitcher_id, event_time, kafka_partition, source_offset, is_late_arrival, is_duplicate,
  event_time < max(event_time) over (partition by game_pk, pitcher_id
    order by kafka_partition, source_offset, is_late_arrival, is_duplicate
    rows between unbounded preceding and current row) - interval 5 minutes as is_late
from bronze""",
    "clean_rows": f"with {RAW} select * exclude (event_id) from raw_text where at_bat_number is not null",
    "quarantined_rows": f"""with {RAW}
select event_time, game_pk, at_bat_number, pitch_number, pitcher_id from raw_text where at_bat_number is null""",
    "canonical_top": f"""with {STAGED}
select game_pk, at_bat_number, pitch_number, inning, inning_topbot, event_time from dedup
order by game_pk, inning, inning_topbot desc, at_bat_number, pitch_number limit 250""",
    "games_list": f"with {BRONZE} select distinct game_pk from bronze",
    "one_game": f"""with {BRONZE}
select game_pk, at_bat_number, pitch_number, event_time, is_late_arrival from bronze where game_pk = 3""",
    "time_bounds": f"""with {BRONZE}
select count(*) as rows, count(distinct game_pk) as games, min(event_time) as first_event_time,
  max(event_time) as last_event_time from bronze""",
    "bronze_profile": f"""with {BRONZE}
select count(*) as rows, count(distinct pitcher_id) as pitchers,
  count(distinct (game_pk, at_bat_number, pitch_number)) as pitches from bronze""",
    "route_events": f"""with {STATES}
select 'pitches.raw' as topic, concat_ws(':', game_pk, at_bat_number, pitch_number) as key,
  epoch_us(event_time) // 1000 as event_millis, 28 as fields from bronze
union all select 'game_state.raw', concat_ws(':', game_pk, event_type), epoch_us(event_time) // 1000, 11 from states
union all select 'corrections.cdc', original_pitch_uid, epoch_us(event_time) // 1000, 7 from corrections""",
    "wire_roundtrip": f"""with {BRONZE}
select concat_ws(':', game_pk, at_bat_number, pitch_number) as key, * exclude (source_offset, kafka_partition)
  replace (date_trunc('milliseconds', event_time) as event_time, date_trunc('milliseconds', ingest_time) as ingest_time)
from bronze""",
    "iso_encoding": f"""with {BRONZE}
select concat_ws(':', game_pk, at_bat_number, pitch_number) as key,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') as event_time from bronze""",
    "perturbed_pitches": f"""with {PERTURBED}
select game_pk, at_bat_number, pitch_number, event_time, ingest_time, is_late_arrival, is_duplicate from perturbed""",
    "drawn_corrections": f"with {PERTURBED} select * from drawn where new_value is not null",
    "kind_counts": f"""with {PERTURBED}, {transitions_of("clean")}
select case when is_duplicate then 'duplicate' when is_late_arrival then 'late' else 'pitch' end as kind,
  count(*) as n from perturbed group by 1
union all select 'correction', count(*) from drawn where new_value is not null
union all select 'game_state', count(*) from states""",
    "nested_plays": _PLAYS,
    "nested_lineups": _LINEUPS,
    "quality_report": f"with {BRONZE} {_QUALITY}",
}


# Signals: the canonical side over staged pitches, the provisional side over rows as they arrive.
def _features(name: str, relation: str, order: str, running: bool) -> str:
    by = f"partition by game_pk, pitcher_id order by {order}"
    frame = f"{by} rows between 15 preceding and current row"
    base = f"{by} rows between unbounded preceding and current row" if running else "partition by game_pk, pitcher_id"
    speed = mean("case when pitch_idx <= 20 then release_speed end", base)
    spin = mean("case when pitch_idx <= 20 then release_spin_rate end", base)
    return f"""
{name}_idx as (select *, row_number() over ({by}) as pitch_idx from {relation}),
{name}_features as (
  select *, {mean("release_speed", frame)} as velocity_mean, {mean("release_spin_rate", frame)} as spin_mean,
    count(*) filter (zone <= 9) over ({frame}) / cast(count(*) over ({frame}) as double) as zone_share,
    {speed} as velocity_baseline, {spin} as spin_baseline
  from {name}_idx
)"""


def _clamp(x: str) -> str:
    return f"case when ({x}) is not null then greatest(0e0, least(1e0, {x})) end"


def _snapshots(name: str, where: str) -> str:
    return f"""
{name}_raw as (
  select *, {_clamp("-(velocity_mean - velocity_baseline) / 3.5e0")} as v,
    {_clamp("-(spin_mean - spin_baseline) / 200e0")} as s,
    {_clamp("(0.68e0 - zone_share) / 0.3e0")} as c, least(1e0, pitch_idx / 110e0) as n
  from {name}_features where pitch_idx >= 20 {where}
),
{name}_scored as (
  select *, 0.3e0 * coalesce(v, 0e0) + 0.2e0 * coalesce(s, 0e0) + 0.2e0 * coalesce(c, 0e0) + 0.3e0 * n as f from {name}_raw
),
{name}_signals as (
  select event_time, ingest_time, game_pk, pitcher_id, at_bat_number, pitch_number, pitch_idx,
    {rounded("f", 3)} as fatigue, {rounded("v", 3)} as fatigue_velocity_component,
    {rounded("s", 3)} as fatigue_spin_component, {rounded("c", 3)} as fatigue_command_component,
    {rounded("""case when pitch_idx < 50 then 0.8e0 + pitch_idx / 200e0
      when pitch_idx < 80 then 1.1e0 + (pitch_idx - 50) * 0.02e0
      else 1.7e0 + (pitch_idx - 80) * 0.08e0 end""", 2)} as leverage,
    {rounded("-0.02e0 + (f - 0.4e0) * 0.08e0", 3)} as matchup_edge
  from {name}_scored
),
{name} as (
  select *, {rounded(f"""0.6e0 * fatigue + 0.3e0 * {_clamp("leverage / 3.5e0")}
    + 0.1e0 * {_clamp("(matchup_edge + 0.1e0) / 0.2e0")}""", 3)} as composite
  from {name}_signals
)"""


CANONICAL = (
    CORRECTED
    + ","
    + _features("canonical", "corrected", "at_bat_number, pitch_number", False)
    + ","
    + _snapshots("canonical", "")
)
BOTH = (
    CANONICAL
    + ", arrived as (select * from bronze where not is_duplicate),"
    + _features("provisional", "arrived", "at_bat_number, pitch_number, is_late_arrival, source_offset", True)
    + ","
    + _snapshots("provisional", "and not is_late_arrival")
)

SEVERITY = "case when {0} >= 0.7e0 then 'action' when {0} >= 0.55e0 then 'warning' when {0} >= 0.4e0 then 'info' end"
RANK = "case {0} when 'action' then 3 when 'warning' then 2 when 'info' then 1 else 0 end"
POSITION = "(cast(at_bat_number as bigint) * 4294967296 + pitch_number)"

ALERTS = (
    BOTH
    + f""",
banded as (select *, composite as score, {SEVERITY.format("composite")} as severity from provisional),
ranked as (select *, {RANK.format("severity")} as rnk from banded),
risen as (
  select *, coalesce(lag(rnk) over ({ORDINAL}), 0) as before from ranked
),
alerts as (
  select event_time, ingest_time as emitted_time,
    concat_ws('-', game_pk, pitcher_id, at_bat_number, pitch_number, severity) as alert_uid, game_pk, pitcher_id,
    'composite' as signal_type, severity, score,
    case severity when 'action' then 0.7e0 when 'warning' then 0.55e0 else 0.4e0 end as score_threshold,
    'composite reached ' || severity as rationale,
    concat_ws(':', 'snap', game_pk, pitcher_id, at_bat_number, pitch_number) as inputs_snapshot_uid,
    'fatigue_v1.0' as model_version, at_bat_number, pitch_number, fatigue, leverage, matchup_edge
  from risen where rnk > before
)"""
)

_MILLI = "(cast(round({0} * 1000e0) as bigint) - cast(round({1} * 1000e0) as bigint)) / 1000e0"

RECONCILED = (
    ALERTS
    + f""",
reached as (
  select game_pk, pitcher_id, max({POSITION}) filter (composite >= 0.4e0) as last_info,
    max({POSITION}) filter (composite >= 0.55e0) as last_warning,
    max({POSITION}) filter (composite >= 0.7e0) as last_action
  from canonical group by all
),
said as (
  select game_pk, pitcher_id, at_bat_number, pitch_number, alert_uid, severity, score as streaming_score, false as near
  from alerts
  union all
  select game_pk, pitcher_id, at_bat_number, pitch_number, null, null, composite, true
  from provisional where composite < 0.4e0 and composite >= 0.35e0
),
faced as (
  select s.*, c.composite as canonical_score, r.last_info, r.last_warning, r.last_action,
    {RANK.format("s.severity")} as said_rank,
    {RANK.format(SEVERITY.format("coalesce(c.composite, 0e0)"))} as meant_rank
  from said s left join canonical c using (game_pk, pitcher_id, at_bat_number, pitch_number)
    left join reached r using (game_pk, pitcher_id)
),
judged as (
  select *, case
    when near then case when meant_rank > 0 then 'suppressed_but_warranted' end
    when meant_rank = said_rank then 'confirmed'
    when meant_rank > said_rank then 'escalated'
    when case severity when 'action' then last_action when 'warning' then last_warning else last_info end
      > {POSITION} then 'confirmed_late'
    when meant_rank > 0 then 'softened'
    else 'reversed' end as outcome
  from faced
),
reconciled as (
  select game_pk, pitcher_id, at_bat_number, pitch_number, alert_uid, severity, streaming_score, canonical_score,
    {_MILLI.format("canonical_score", "streaming_score")} as delta, outcome, replace(outcome, '_', ' ') as outcome_label
  from judged where outcome is not null
)"""
)

_SIGNAL_VALUES = """lateral (values
  ('fatigue', s.fatigue, c.fatigue), ('leverage', s.leverage, c.leverage),
  ('matchup_edge', s.matchup_edge, c.matchup_edge)) v(signal, streaming_value, canonical_value)"""

DELTAS = (
    BOTH
    + f""",
deltas as (
  select s.game_pk, s.pitcher_id, s.at_bat_number, s.pitch_number, signal, streaming_value, canonical_value,
    {_MILLI.format("canonical_value", "streaming_value")} as delta
  from provisional s join canonical c using (game_pk, pitcher_id, at_bat_number, pitch_number), {_SIGNAL_VALUES}
)"""
)

_STATE_COLUMNS = "inning_bin, inning_topbot, outs_when_up, bases, score_bin"

LEVERAGE = f"""with {STAGED},
stated as (
  select *, least(inning, 9) as inning_bin,
    (on_1b is not null)::integer + 2 * (on_2b is not null)::integer + 4 * (on_3b is not null)::integer as bases,
    greatest(-3, least(3, home_score - away_score)) as score_bin,
    lag(home_score) over ({GAME_ORDINAL}) as p_home, lag(away_score) over ({GAME_ORDINAL}) as p_away
  from dedup
),
marked as (
  select *, coalesce(home_score > p_home or away_score > p_away, false)::integer as moved,
    row(inning, inning_topbot, outs_when_up, bases, home_score, away_score, balls, strikes) as state from stated
),
li as (
  select {_STATE_COLUMNS}, cast(sum(moved) as double) / count(*)
    / (select cast(sum(moved) as double) / count(*) from marked) as leverage_index
  from marked group by all
)"""

_HANDED = STAGED + ", handed as (select *, case when batter_id % 2 = 0 then 'L' else 'R' end as batter_hand from staged)"

_USAGE = ", ".join(
    f"count(*) filter (pitch_type = '{t}') / cast(count(pitch_type) as double) as usage_{t.lower()}"
    for t in ["FF", "SL", "CH", "CU", "SI", "FC", "KC", "FT", "FS"]
)

PITCHER_SEASON = f"""
select pitcher_id, cast(year(event_time) as integer) as season, count(*) as pitches,
  count(distinct game_pk) as games,
  {group_mean("release_speed")} as season_velocity, {group_mean("release_spin_rate")} as season_spin, {_USAGE}
from staged group by 1, 2"""

ORACLE |= {
    "pace_trend": f"""with {STAGED},
paced as (
  select *, epoch_us(event_time) - lag(epoch_us(event_time)) over ({ORDINAL}) as pace from staged
),
listed as (
  select *, list(pace) filter (pace is not null) over ({_last(10)}) as paces from paced
),
summed as (
  select *, coalesce(len(paces), 0) as n, coalesce(cast(list_sum(paces) as bigint), 0) as y,
    coalesce(cast(list_sum(list_transform(paces, lambda v, i: v * i)) as bigint), 0) as xy
  from listed
)
select game_pk, pitcher_id, at_bat_number, pitch_number, event_time, pace / 1000000e0 as pace_seconds,
  case when n >= 2 then cast((n * xy * 2 - n * (n + 1) * y) * 6 as double)
    / cast(n * n * (n * n - 1) * 1000000 as double) end as pace_trend_last_10
from summed""",
    "signals_canonical": f"with {CANONICAL} select * from canonical",
    "signals_provisional": f"with {BOTH} select * from provisional",
    "signal_display": f"""with {CANONICAL},
starts as (select game_pk, min(event_time) as first_pitch from canonical_features group by 1)
select game_pk, pitcher_id, at_bat_number, pitch_number, pitch_idx,
  strftime(event_time, '%H:%M:%S') || ' UTC' as clock, first_pitch + to_seconds(pitch_idx * 25) as scheduled_time,
  cast(least((pitch_idx - 1) // 15 + 1, 7) as integer) as scheduled_inning,
  cast((pitch_idx - 1) // 4 + 1 as integer) as scheduled_at_bat,
  cast((pitch_idx - 1) % 4 + 1 as integer) as scheduled_pitch, leverage / 3.5e0 as leverage_scaled,
  {rounded("case when pitch_idx > 70 then fatigue + 0.03e0 else fatigue - 0.01e0 end", 3)} as fatigue_shifted
from canonical join starts using (game_pk)""",
    "velocity_line": f"""with {STAGED}
select game_pk, pitcher_id, at_bat_number, pitch_number, release_speed,
  {mean("release_speed", _last(10))} as velocity_rolling from staged""",
    "snapshot_at": f"with {CANONICAL} select * from canonical where game_pk = 0 and pitcher_id = 101 and pitch_idx = 92",
    "alerts_banded": f"with {ALERTS} select * from alerts",
    "latest_alert": f"""with {ALERTS} select alert_uid, emitted_time, severity from alerts
order by emitted_time desc, alert_uid desc limit 1""",
    "alert_values": f"""with {ALERTS},
valued as (
  select s.game_pk, s.pitcher_id, s.at_bat_number, s.pitch_number, s.alert_uid, signal, streaming_value, canonical_value,
    {_MILLI.format("canonical_value", "streaming_value")} as delta
  from alerts s join canonical c using (game_pk, pitcher_id, at_bat_number, pitch_number), {_SIGNAL_VALUES}
)
select *, case when delta >= 0 then 'positive' else 'negative' end as delta_class,
  printf('%+.3f', delta) as delta_text, printf('%+.3f', streaming_value) as streaming_text from valued""",
    "alert_reconciliation": f"with {RECONCILED} select * from reconciled",
    "stored_alert_reconciliation": f"with {RECONCILED} select * from reconciled",
    "outcome_distribution": f"""with {RECONCILED}
select outcome, count(*) as n, count(*) filter (severity = 'action') as n_action from reconciled group by 1""",
    "correction_rate": f"""with {RECONCILED}
select count(*) as alerts, count(*) filter (outcome <> 'confirmed') / cast(count(*) as double) as correction_rate,
  count(*) filter (severity = 'action' and outcome <> 'reversed') as action_preserved,
  count(*) filter (severity = 'action' and outcome = 'reversed') as action_reversed
from reconciled where alert_uid is not null""",
    "signal_delta": f"with {DELTAS} select * from deltas",
    "delta_histogram": f"""with {DELTAS}
select signal, cast(case when delta < -0.5e0 then 0 when delta >= 0.5e0 then 21
  else floor((delta + 0.5e0) * 20) + 1 end as bigint) as bin, count(*) as n
from deltas group by all""",
    "decision_outcomes": f"""with {BOTH},
crossed as (
  select side, game_pk, pitcher_id, severity, min({POSITION}) filter (composite >= floor) as first_at
  from (select 's' as side, * from provisional union all select 'c', * from canonical),
    (values ('info', 0.4e0), ('warning', 0.55e0), ('action', 0.7e0)) b(severity, floor)
  group by all
),
sides as (
  select game_pk, pitcher_id, severity, max(first_at) filter (side = 's') as streaming_first,
    max(first_at) filter (side = 'c') as canonical_first
  from crossed group by all
)
select *, case when streaming_first is null and canonical_first is null then 'neither'
  when canonical_first is null then 'streaming_only' when streaming_first is null then 'canonical_only'
  when streaming_first < canonical_first then 'streaming' when streaming_first > canonical_first then 'canonical'
  else 'together' end as fired_first
from sides""",
    "kpi_latency": f"""with {ALERTS},
timed as (select severity, epoch_us(emitted_time) // 1000000 - epoch_us(event_time) // 1000000 as latency from alerts)
select severity, count(*) as n, round(quantile_cont(latency, 0.5), 3) as p50,
  round(quantile_cont(latency, 0.95), 3) as p95, round(quantile_cont(latency, 0.99), 3) as p99
from timed group by 1""",
    "stationarity_probe": f"""with {CANONICAL},
gaps as (
  select case when cast(event_time as date) < date '2024-01-15' then 'before' else 'after' end as period,
    cast(round((0.4e0 - composite) * 1000) as bigint) as gap from canonical
)
select period, count(*) as states, count(*) filter (gap <= 0) / cast(count(*) as double) as activation_rate,
  count(*) filter (gap > 0 and gap <= 50) / cast(count(*) as double) as near_miss_rate,
  round(quantile_cont(gap, 0.5), 3) as evidence_gap_median, round(quantile_cont(gap, 0.9), 3) as evidence_gap_p90
from gaps group by 1""",
    "matchup_revisions": f"""with {BOTH},
confirmed as (
  select game_pk, at_bat_number, pitch_number, batter_id from pitches where event_id % 10 <> 0
),
revised as (
  select s.game_pk, s.pitcher_id, s.at_bat_number, s.pitch_number, s.pitch_idx,
    {_MILLI.format("c.matchup_edge", "s.matchup_edge")} as delta, b.batter_id
  from provisional s join canonical c using (game_pk, pitcher_id, at_bat_number, pitch_number)
    left join confirmed b on b.game_pk = s.game_pk and b.at_bat_number = s.at_bat_number
      and b.pitch_number = s.pitch_number
)
select game_pk, pitcher_id, at_bat_number, pitch_number, delta,
  case when batter_id is null then 'BATTER_UNCERTAIN' else 'BATTER_CONFIRMED' end as batter_state,
  case when pitch_idx < 30 then 'suppressed_by_governance' when abs(delta) >= 0.002e0 then 'material_update'
    else 'baseline_confirmed' end as revision
from revised""",
    "leverage_lookup": f"""{LEVERAGE},
stepped as (
  select *, lag(state) over ({GAME_ORDINAL}) as was,
    cast(sum(is_late_arrival::integer) over ({GAME_ORDINAL} rows between 9 preceding and current row) as bigint) as recent_late
  from marked
)
select game_pk, at_bat_number, pitch_number, home_score - away_score as score_differential, recent_late, leverage_index
from stepped left join li using ({_STATE_COLUMNS})
where was is null or was <> state""",
    "matchup_edge": f"""with {_HANDED},
thrown as (
  select pitcher_id, balls, strikes, batter_hand, pitch_type, count(*) as thrown from handed
  where pitch_type is not null group by all
),
mix as (
  select *, sum(thrown) over (partition by pitcher_id, balls, strikes, batter_hand) as total from thrown
),
splits as (
  select batter_id, pitch_type, batter_hand, cast(count(events) as double) / count(*) as xwoba from handed
  where pitch_type is not null group by all
),
matchups as (
  select distinct pitcher_id, batter_id, balls, strikes, batter_hand, game_pk % 25 as park_id from handed
),
terms as (
  select m.*, x.pitch_type, cast(x.thrown as double) / cast(x.total as double) * p.xwoba as term
  from matchups m join mix x using (pitcher_id, balls, strikes, batter_hand)
    join splits p on p.batter_id = m.batter_id and p.pitch_type = x.pitch_type and p.batter_hand = m.batter_hand
),
summed as (
  select pitcher_id, batter_id, balls, strikes, batter_hand, park_id, {rounded("sum(term)", 6)} as expected,
    max(row(round(term, 9), pitch_type)) as top from terms group by all
),
edged as (
  select s.*, {rounded("expected * (0.9e0 + (n_nationkey % 20) / 100e0) - 0.25e0", 6)} as matchup_edge
  from summed s join nation on n_nationkey = park_id
)
select pitcher_id, batter_id, balls, strikes, batter_hand, park_id, matchup_edge,
  case when matchup_edge >= 0.08e0 then 'REPLACE' when matchup_edge >= 0.02e0 then 'WARM' else 'KEEP' end as recommendation,
  top[2] as top_contributing_pitch_type
from edged""",
    "pitcher_season": f"with {STAGED} {PITCHER_SEASON}",
    "batter_season": f"""with {_HANDED}
select batter_id, cast(year(event_time) as integer) as season, batter_hand, pitch_type, count(*) as pitches,
  count(events) as outcomes, {group_mean("release_speed")} as mean_speed_faced
from handed group by all""",
    "canonical_pitches": f"""with {STAGED}, dim as ({PITCHER_SEASON})
select game_pk, at_bat_number, pitch_number, s.pitcher_id, d.season, pitch_type, season_velocity, season_spin,
  release_speed - season_velocity as velocity_vs_season
from staged s join dim d on d.pitcher_id = s.pitcher_id and d.season = year(s.event_time)""",
    "removal_label": f"""with {STAGED},
at_bats as (
  select game_pk, inning_topbot, at_bat_number, max(row(pitch_number, event_time, pitcher_id))[3] as pitcher_id
  from staged group by all
)
select *, coalesce(lead(pitcher_id, 1) over w <> pitcher_id, false)
    or coalesce(lead(pitcher_id, 2) over w <> pitcher_id, false) as removed_soon
from at_bats window w as (partition by game_pk, inning_topbot order by at_bat_number)""",
}


# Streams: what the sinks hold after all input.
_COUNTED = (
    BRONZE
    + """,
counted as (
  select game_pk, pitcher_id, time_bucket(interval 1 minute, event_time) as window_start,
    time_bucket(interval 1 minute, event_time) + interval 1 minute as window_end, count(*) as pitch_count
  from bronze group by all
),
closed as (
  select * from counted where window_end <=
    (select date_trunc('milliseconds', max(event_time)) - interval 5 minutes from bronze)
)"""
)

_ARRIVED = "partition by game_pk, pitcher_id order by at_bat_number, pitch_number, is_late_arrival, source_offset"


def _arrived_last(n: int) -> str:
    return f"{_ARRIVED} rows between {n - 1} preceding and current row"


_EDGE = """((abs(abs(plate_x) - 0.83e0) <= 0.25e0 and plate_z between 1.25e0 and 3.75e0)
    or ((abs(plate_z - 1.5e0) <= 0.25e0 or abs(plate_z - 3.5e0) <= 0.25e0) and abs(plate_x) <= 1.08e0))"""

_THROWN = ", ".join(
    f"count(*) filter (pitch_type = '{t}') over ({_ARRIVED}) as thrown_{t.lower()}"
    for t in ["FF", "SL", "CH", "CU", "SI", "FC", "KC", "FT", "FS"]
)

LIVE = (
    BOTH
    + f""",
paced as (
  select *, epoch_us(event_time) - lag(epoch_us(event_time)) over ({_ARRIVED}) as pace from provisional_features
),
live_raw as (
  select *, {mean("release_speed", _arrived_last(20))} as velocity_last_20_avg,
    {mean("release_spin_rate", _arrived_last(20))} as spin_last_20_avg,
    {mean("pace / 1000000e0", _arrived_last(10))} as pace_last_10_avg,
    count(*) filter (zone <= 9) over ({_arrived_last(15)})
      / cast(count(*) over ({_arrived_last(15)}) as double) as zone_last_15_share,
    count(*) filter (zone <= 9 or {_EDGE}) over ({_arrived_last(15)})
      / cast(count(*) over ({_arrived_last(15)}) as double) as command_last_15_share, {_THROWN}
  from paced
)"""
)

ORACLE |= {
    "tumble_counts_batch": f"with {_COUNTED} select * from counted",
    "tumble_counts_stream": f"with {_COUNTED} select * from closed",
    "bronze_stream_append": f"""with {BRONZE}
select * exclude (ingest_time), cast(event_time as date) as event_day from bronze""",
    "multi_sink": f"""with {_COUNTED}
select 'arrivals' as sink, pitcher_id, count(*) as n, max(event_time) as latest from bronze group by all
union all select 'bronze', pitcher_id, count(*), max(event_time) from bronze group by all
union all select 'counts', pitcher_id, cast(sum(pitch_count) as bigint), max(window_end) from closed group by all""",
    "stream_features": f"""with {LIVE}
select game_pk, pitcher_id, at_bat_number, pitch_number, is_late_arrival, event_time, pitch_idx, velocity_last_20_avg,
  spin_last_20_avg, pace_last_10_avg, zone_last_15_share, command_last_15_share, columns('thrown_.*')
from live_raw""",
    "stream_alerts": f"with {ALERTS} select * from alerts",
    "stream_game_state": f"with {PITCHES}, {transitions_of('pitches')} select * from states",
    "stream_late_rows": ORACLE["late_split"].replace(
        "from bronze", "from bronze qualify is_late"
    ),
    "stream_corrections": f"""with {PITCHES}, {CORRECTIONS}
select * from corrections qualify row_number() over (partition by original_pitch_uid, field
  order by ingest_time desc, event_time desc, new_value desc nulls last) = 1""",
    "snapshot_query": f"""with {BRONZE},
loads as (
  select *, case when source_offset > (select max(event_id) // 2 from events) or is_late_arrival then 1 else 0 end as load
  from bronze
)
select cast(s as integer) as snapshot_id, pitcher_id, count(*) as n, count(distinct game_pk) as games
from loads, (values (0), (1)) v(s) where load <= s group by all""",
    "count_where": f"""with {BRONZE}
select 'all' as predicate, count(*) as n from bronze
union all select 'is_duplicate', count(*) from bronze where is_duplicate
union all select 'inning_topbot = ''Top'' AND event_day >= DATE''2024-01-10''', count(*) from bronze
  where inning_topbot = 'Top' and cast(event_time as date) >= date '2024-01-10'""",
    "incremental_equals_full": f"with {CORRECTED}, {windowed('corrected')} select * from windowed",
}

ORACLE |= {
    "kpi_first_signal": f"""with {ALERTS}
select game_pk, (epoch_us(f.first) - epoch_us(g.start)) / 1e6 as first_signal_seconds,
  (epoch_us(g.complete) - epoch_us(g.start)) / 1e6 as canonical_seconds
from (select game_pk, min(event_time) as start, max(ingest_time) as complete from staged group by 1) g
  left join (select game_pk, min(emitted_time) as first from alerts group by 1) f using (game_pk)""",
    "pinned_alerts": f"with {ALERTS} select * replace ('fatigue_v1.1' as model_version) from alerts",
    "leverage_facts": f"""{LEVERAGE}
select game_pk, at_bat_number, pitch_number, {_STATE_COLUMNS}, leverage_index from marked left join li using ({_STATE_COLUMNS})""",
    "splits_as_of": f"""with {_HANDED},
seen_before as (
  select *, cast(year(event_time) as integer) as season, count(*) over w as seen, count(events) over w as hits
  from handed where pitch_type is not null
  window w as (partition by batter_id, year(event_time), batter_hand, pitch_type
    order by event_time, game_pk, at_bat_number, pitch_number rows between unbounded preceding and 1 preceding)
)
select game_pk, at_bat_number, pitch_number, batter_id, season, batter_hand, pitch_type, seen,
  case when seen > 0 then cast(hits as double) / seen end as xwoba_as_of
from seen_before""",
    "batter_context": f"""with {_HANDED}
select game_pk, at_bat_number, pitch_number, batter_id, batter_hand, pitch_type,
  count(*) over w as batter_pitches_seen,
  cast(sum(cast(release_speed as decimal(18,6))) over w as double) / count(release_speed) over w as batter_mean_speed_faced
from handed window w as (partition by batter_id, year(event_time), batter_hand, pitch_type)""",
    **{
        f"resumed_{name}": ORACLE[single]
        for name, single in {
            "features": "stream_features",
            "alerts": "stream_alerts",
            "game_state": "stream_game_state",
            "late_rows": "stream_late_rows",
            "corrections": "stream_corrections",
            "bronze": "bronze_stream_append",
        }.items()
    },
}


# Late copies come one load after their pitch; a start of the stream refuses windows that the watermark of all loads before closed.
_LATE_LOADS = (
    BRONZE
    + """,
bounds as (select min(event_id) as low, max(event_id) as high from events),
loads as (
  select b.*, time_bucket(interval 1 minute, event_time) as window_start,
    time_bucket(interval 1 minute, event_time) + interval 1 minute as window_end,
    least(3, (source_offset - low) * 4 // (high + 1 - low) + is_late_arrival::integer) as load
  from bronze b, bounds
),
marks as (
  select n as load, (select date_trunc('milliseconds', max(event_time)) - interval 5 minutes from loads where load < n) as closed
  from range(5) r(n)
),
judged as (select l.*, coalesce(window_end <= closed, false) as refused from loads l join marks m using (load)),
counted as (
  select game_pk, pitcher_id, window_start, window_end, count(*) as pitch_count from judged
  where not refused and window_end <= (select closed from marks where load = 4) group by all
)"""
)

_LIVE_LEVERAGE = f"""{LEVERAGE},
arriving as (
  select *, least(inning, 9) as inning_bin,
    (on_1b is not null)::integer + 2 * (on_2b is not null)::integer + 4 * (on_3b is not null)::integer as bases,
    greatest(-3, least(3, home_score - away_score)) as score_bin,
    row(inning, inning_topbot, outs_when_up, (on_1b is not null)::integer + 2 * (on_2b is not null)::integer
      + 4 * (on_3b is not null)::integer, home_score, away_score, balls, strikes) as context
  from bronze where not is_duplicate
),
paced_states as (
  select *, lag(context) over w as was, cast(sum(is_late_arrival::integer) over (w rows between 9 preceding and current row) as bigint) as recent_late,
    count(*) over (w rows between 9 preceding and current row) as recent
  from arriving
  window w as (partition by game_pk order by inning, inning_topbot desc, at_bat_number, pitch_number, is_late_arrival, source_offset)
),
ended as (
  select game_pk, max(row(at_bat_number, pitch_number, home_score - away_score))[3] as final from marked group by 1
),
wins as (
  select {_STATE_COLUMNS}, sum(case when final > 0 then 1e0 when final = 0 then 0.5e0 else 0e0 end) / count(*) as win_prob_home
  from marked join ended using (game_pk) group by all
),
live_leverage as (
  select game_pk, at_bat_number, pitch_number, pitcher_id, event_time, home_score - away_score as score_differential, recent_late,
    1 - cast(recent_late as double) / recent as confidence, leverage_index, win_prob_home
  from paced_states left join li using ({_STATE_COLUMNS}) left join wins using ({_STATE_COLUMNS})
  where was is null or was <> context
)"""

_MATCHUP_CTES = f"""
bounds as (select min(event_id) as low, max(event_id) as high from events),
seen as (
  select p.*, case when batter_id % 2 = 0 then 'L' else 'R' end as batter_hand,
    (select count(*) from range(1, 4) r(n) where low + (high + 1 - low) * n // 4 <= event_id) as load
  from pitches p, bounds
),
versions as (select v, (select max(event_time) from seen where load < v) as valid_from from range(1, 4) r(v)),
thrown_by as (
  select v, pitcher_id, balls, strikes, batter_hand, pitch_type, count(*) as thrown from seen, versions
  where load < v and pitch_type is not null group by all
),
mixed as (select *, sum(thrown) over (partition by v, pitcher_id, balls, strikes, batter_hand) as total from thrown_by),
split_by as (
  select v, batter_id, batter_hand, pitch_type, cast(count(events) as double) / count(*) as xwoba from seen, versions
  where load < v and pitch_type is not null group by all
),
dated as (select s.*, (select max(v) from versions where v <= s.load and valid_from <= s.event_time) as v from seen s),
known as (select distinct v, pitcher_id, balls, strikes, batter_hand, total from mixed),
term_rows as (
  select d.event_id, m.pitch_type, cast(m.thrown as double) / cast(m.total as double) * x.xwoba as term
  from dated d join mixed m using (v, pitcher_id, balls, strikes, batter_hand)
    join split_by x on x.v = d.v and x.batter_id = d.batter_id and x.batter_hand = d.batter_hand and x.pitch_type = m.pitch_type
),
summed_terms as (
  select event_id, {rounded("list_sum(list(term order by pitch_type))", 6)} as expected, max(row(round(term, 9), pitch_type)) as top
  from term_rows group by all
),
live_matchup as (
  select d.game_pk, d.at_bat_number, d.pitch_number, d.pitcher_id, d.batter_id, d.event_time, k.v as version,
    {rounded("expected * (0.9e0 + (n_nationkey % 20) / 100e0) - 0.25e0", 6)} as edge, top[2] as top_contributing_pitch_type,
    cast(k.total as double) / (cast(k.total as double) + 50e0) as confidence
  from dated d join nation on n_nationkey = d.game_pk % 25
    left join known k using (v, pitcher_id, balls, strikes, batter_hand) left join summed_terms using (event_id)
)"""

_LIVE_SCORES = f"""{_LIVE_LEVERAGE}, {_MATCHUP_CTES}, arrived as (select * from bronze where not is_duplicate),
{_features("provisional", "arrived", "at_bat_number, pitch_number, is_late_arrival, source_offset", True)},
{_snapshots("provisional", "and not is_late_arrival")},
tired as (select event_time, ingest_time, game_pk, pitcher_id, at_bat_number, pitch_number, pitch_idx, fatigue from provisional),
levered as (
  select t.*, l.leverage_index from tired t left join live_leverage l
    on l.game_pk = t.game_pk and l.event_time <= t.event_time and l.event_time >= t.event_time - interval 10 minutes
  qualify row_number() over (partition by t.game_pk, t.pitcher_id, t.at_bat_number, t.pitch_number order by l.event_time desc nulls last) = 1
),
matched as (
  select t.*, m.edge from levered t left join live_matchup m
    on m.game_pk = t.game_pk and m.pitcher_id = t.pitcher_id and m.event_time <= t.event_time
      and m.event_time >= t.event_time - interval 10 minutes
  qualify row_number() over (partition by t.game_pk, t.pitcher_id, t.at_bat_number, t.pitch_number order by m.event_time desc nulls last) = 1
),
combined as (
  select * exclude (leverage_index, edge), {rounded("coalesce(leverage_index, 1e0)", 2)} as leverage,
    {rounded("coalesce(edge, 0e0)", 3)} as matchup_edge from matched
),
scored as (
  select *, {rounded(f"""0.6e0 * fatigue + 0.3e0 * {_clamp("leverage / 3.5e0")}
    + 0.1e0 * {_clamp("(matchup_edge + 0.1e0) / 0.2e0")}""", 3)} as score from combined
)"""

ORACLE |= {
    "resumed_tumble": f"with {_LATE_LOADS} select * from counted",
    "refused_windows": f"""with {_LATE_LOADS}
select cast(n as integer) as load, (select count(*) from (
  select distinct game_pk, pitcher_id, window_start from judged where refused and judged.load = n)) as refused
from range(4) r(n)""",
    "refused_rows": f"""with {_LATE_LOADS}
select game_pk, pitcher_id, window_start, count(*) as refused from judged
where refused and window_end <= (select max(window_end) from counted) group by all""",
    "live_leverage": f"{_LIVE_LEVERAGE} select * from live_leverage",
    "win_table": f"{_LIVE_LEVERAGE} select * from wins",
    "live_matchup": f"""with {PITCHES}, {_MATCHUP_CTES}
select * exclude (edge), edge as matchup_edge,
  case when edge >= 0.08e0 then 'REPLACE' when edge >= 0.02e0 then 'WARM' when edge is not null then 'KEEP' end as recommendation
from live_matchup""",
    "live_scores": f"{_LIVE_SCORES} select * from scored",
    "live_alerts": f"""{_LIVE_SCORES},
banded as (select *, {SEVERITY.format("score")} as severity from scored),
ranked as (select *, {RANK.format("severity")} as rnk from banded),
risen as (select *, coalesce(lag(rnk) over ({ORDINAL}), 0) as before from ranked)
select event_time, ingest_time as emitted_time,
  concat_ws('-', game_pk, pitcher_id, at_bat_number, pitch_number, severity) as alert_uid, game_pk, pitcher_id,
  'composite' as signal_type, severity, score,
  case severity when 'action' then 0.7e0 when 'warning' then 0.55e0 else 0.4e0 end as score_threshold,
  'composite reached ' || severity as rationale,
  concat_ws(':', 'snap', game_pk, pitcher_id, at_bat_number, pitch_number) as inputs_snapshot_uid,
  'fatigue_v1.0' as model_version, at_bat_number, pitch_number, fatigue, leverage, matchup_edge
from risen where rnk > before""",
}


def _newton(rounds: int, ridge: float) -> str:
    """Newton steps of a logistic fit of y to x1..x4 of `train`, as a recursive relation fit(k, w0..w4).

    Each step solves the five normal equations by a Cholesky factor; later columns of a select may use earlier ones.
    """
    size = 5
    lower = [(i, j) for i in range(size) for j in range(i + 1)]
    grams = ", ".join(f"sum(v * x{i} * x{j}) as a{i}{j}" for i, j in lower)
    slopes = ", ".join(f"sum((y - p) * x{i}) as g{i}" for i in range(size))
    weights = ", ".join(f"w{i}" for i in range(size))
    columns = []
    for i, j in lower:
        base = f"a{i}{j}" + (f" + {ridge} * n" if i == j and i else "")
        rest = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        columns.append(f"sqrt({base}{rest}) as l{i}{i}" if i == j else f"({base}{rest}) / l{j}{j} as l{i}{j}")
    for i in range(size):
        own = f"g{i}" + (f" - {ridge} * n * w{i}" if i else "")
        columns.append(f"({own}{''.join(f' - l{i}{k} * z{k}' for k in range(i))}) / l{i}{i} as z{i}")
    for i in reversed(range(size)):
        columns.append(f"(z{i}{''.join(f' - l{k}{i} * d{k}' for k in range(i + 1, size))}) / l{i}{i} as d{i}")
    return f"""
fit as (
  select 0 as k, {", ".join(f"0e0 as w{i}" for i in range(size))}
  union all
  select k + 1, {", ".join(f"w{i} + d{i}" for i in range(size))} from (
    select k, {weights}, {", ".join(columns)} from (
      select k, {weights}, count(*) as n, {grams}, {slopes} from (
        select *, p * (1 - p) as v from (
          select *, 1 / (1 + exp(-(w0{"".join(f" + w{i} * x{i}" for i in range(1, size))}))) as p from fit, train where k < {rounds}
        )
      ) group by k, {weights}
    )
  )
)"""


_PARTS = ["velocity", "spin", "command", "pitch_count"]
_POSITIVE = " + ".join(f"greatest(w{i}, 0e0)" for i in range(1, 5))

ORACLE["calibrated_weights"] = f"""with recursive {CANONICAL},
at_bats as (
  select game_pk, inning_topbot, at_bat_number, max(row(pitch_number, event_time, pitcher_id))[3] as pitcher_id
  from staged group by all
),
removed as (
  select game_pk, at_bat_number, pitcher_id, (coalesce(lead(pitcher_id, 1) over w <> pitcher_id, false)
    or coalesce(lead(pitcher_id, 2) over w <> pitcher_id, false))::integer as y
  from at_bats window w as (partition by game_pk, inning_topbot order by at_bat_number)
),
train as materialized (
  select 1e0 as x0, coalesce(fatigue_velocity_component, 0e0) as x1, coalesce(fatigue_spin_component, 0e0) as x2,
    coalesce(fatigue_command_component, 0e0) as x3, least(1e0, pitch_idx / 110e0) as x4, y
  from canonical join removed using (game_pk, at_bat_number, pitcher_id)
), {_newton(8, 0.01)}
select 'fatigue_v1.1' as model_version,
  {", ".join(f"round(greatest(w{i}, 0e0) / nullif({_POSITIVE}, 0), 6) as {n}" for i, n in enumerate(_PARTS, 1))},
  round(w0, 6) as intercept, {", ".join(f"round(w{i}, 6) as {n}_coefficient" for i, n in enumerate(_PARTS, 1))},
  concat_ws(',', {", ".join(f"case when w{i} < 0 then '{n}' end" for i, n in enumerate(["fatigue_velocity_component", "fatigue_spin_component", "fatigue_command_component", "pitch_count_component"], 1))}) as negative,
  (select count(*) from train) as n
from fit where k = 8"""

_RISEN = """{0}_banded as (select *, """ + SEVERITY.format("composite") + """ as severity from {0}),
{0}_ranked as (select *, """ + RANK.format("severity") + """ as rnk from {0}_banded),
{0}_risen as (
  select *, coalesce(lag(rnk) over (""" + ORDINAL + """), 0) as before, """ + POSITION + """ as position from {0}_ranked
),
{0}_alerts as (
  select *, concat_ws('-', game_pk, pitcher_id, at_bat_number, pitch_number, severity) as alert_uid from {0}_risen where rnk > before
)"""

_MATCHED = f"""{BOTH}, {_RISEN.format("provisional")}, {_RISEN.format("canonical")},
paired as (
  select s.*, c.severity as c_severity, c.composite as c_score, c.position as c_position, c.rnk as c_rnk,
    abs(s.at_bat_number - c.at_bat_number) as apart
  from provisional_alerts s left join canonical_alerts c on c.game_pk = s.game_pk and c.pitcher_id = s.pitcher_id
    and abs(s.at_bat_number - c.at_bat_number) <= 2
  qualify row_number() over (partition by s.game_pk, s.pitcher_id, s.position order by apart nulls last, c.position) = 1
),
matched as (
  select game_pk, pitcher_id, at_bat_number, pitch_number, alert_uid, severity, composite as streaming_score,
    c_severity as canonical_severity, c_score as canonical_score, apart as at_bats_apart,
    case when c_rnk is null then 'reversed' when c_rnk > rnk then 'escalated' when c_rnk < rnk then 'softened'
      when c_position > position then 'confirmed_late' else 'confirmed' end as outcome
  from paired
  union all
  select game_pk, pitcher_id, at_bat_number, pitch_number, null, null, null, severity, composite, null, 'suppressed_but_warranted'
  from canonical_alerts c where not exists (
    select 1 from provisional_alerts s where s.game_pk = c.game_pk and s.pitcher_id = c.pitcher_id
      and abs(s.at_bat_number - c.at_bat_number) <= 2)
)"""


def _changes(column: str) -> str:
    return f"""select '{column}' as signal, event_time, ingest_time from (
    select *, lag({column}) over ({ORDINAL}) as was from provisional) where was is null or was <> {column}"""


ORACLE |= {
    "matched_alerts": f"with {_MATCHED} select * from matched",
    "matched_outcomes": f"with {_MATCHED} select outcome, count(*) as n from matched group by 1",
    "kpi_signal_latency": f"""with {BOTH},
emitted as (
  select 'fatigue' as signal, event_time, ingest_time from provisional
  union all {_changes("leverage")} union all {_changes("matchup_edge")}
),
timed as (select signal, cast(event_time as date) as day, epoch_us(ingest_time) // 1000000 - epoch_us(event_time) // 1000000 as latency from emitted),
spread as (select signal, day, latency from timed union all select signal, null, latency from timed)
select signal, day, count(*) as n, round(quantile_cont(latency, 0.5), 3) as p50, round(quantile_cont(latency, 0.95), 3) as p95,
  round(quantile_cont(latency, 0.99), 3) as p99, true as sketch_within_error
from spread group by 1, 2""",
    "matchup_facts": f"""with {_HANDED},
valued as (select *, (events is not null)::integer as v from handed where pitch_type is not null),
hand_rates as (select batter_hand, cast(sum(v) as double) / count(v) as r0 from valued group by 1),
type_rates as (
  select batter_hand, pitch_type, (cast(sum(v) as double) + 20e0 * any_value(r0)) / (count(v) + 20e0) as r1
  from valued join hand_rates using (batter_hand) group by 1, 2
),
batter_rates as (
  select batter_id, batter_hand, pitch_type, (cast(sum(v) as double) + 20e0 * any_value(r1)) / (count(v) + 20e0) as r2
  from valued join type_rates using (batter_hand, pitch_type) group by 1, 2, 3
),
met as (
  select pitcher_id, batter_id, batter_hand, count(*) as meetings, sum(0.9e0 + (n_nationkey % 20) / 100e0) / count(*) as park
  from handed join nation on n_nationkey = game_pk % 25 group by 1, 2, 3
),
thrown as (select pitcher_id, batter_hand, pitch_type, count(*) as n from valued group by 1, 2, 3),
mix as (select *, cast(n as double) / cast(sum(n) over (partition by pitcher_id, batter_hand) as double) as share from thrown),
terms as (
  select m.*, x.pitch_type, r2, share * coalesce(r2, r1) as term
  from met m join mix x using (pitcher_id, batter_hand) join type_rates t on t.batter_hand = m.batter_hand and t.pitch_type = x.pitch_type
    left join batter_rates b on b.batter_id = m.batter_id and b.batter_hand = m.batter_hand and b.pitch_type = x.pitch_type
),
summed as (
  select pitcher_id, batter_id, batter_hand, meetings, park, {rounded("sum(term)", 6)} as expected,
    max(row(round(term, 9), pitch_type))[2] as top_contributing_pitch_type, count(r2) as types_seen
  from terms group by 1, 2, 3, 4, 5
)
select * exclude (park), {rounded("expected * round(park, 9) - 0.25e0", 6)} as matchup_edge from summed""",
}

ORACLE |= {
    "stream_violations": f"""with {BRONZE},
bounds as (select min(event_id) as low, max(event_id) as high from events),
loads as (
  select b.*, cast((select count(*) from range(1, 4) r(n) where low + (high + 1 - low) * n // 4 <= source_offset) as integer) as load
  from bronze b, bounds
)
select load, count(*) as rows, count(*) filter (pitch_type is null) as no_pitch_type,
  count(*) filter (release_speed is null) as no_release_speed, count(*) filter (is_duplicate) as flagged
from loads group by 1""",
    "missing_fields": """select unnest(['pitcher_id', 'batter_id', 'home_score', 'is_late_arrival', 'is_duplicate', 'correction_of']) as field,
  (select count(*) from events) as rows""",
    "raw_day": """select ts as event_time, cast(event_id // 1000 as varchar) as game_pk,
  cast(user_id % 4 + case when ((event_id % 1000) // 50) % 2 = 0 then 100 else 200 end as varchar) as pitcher,
  case event_id % 5 when 0 then 'nan' when 1 then '5.9' when 2 then 'inf' when 3 then '-2.7'
    else cast(event_id % 14 + 1 as varchar) end as zone, cast(ts as date) as game_date
from events where cast(ts as date) = date '2024-01-10'""",
    "source_positions": f"""select event_id, row_number() over (order by event_id) - 1 as source_offset,
  {zlib.crc32(b"events.parquet") % 3}::integer as kafka_partition from events""",
    "ingestion_stamps": f"with {BRONZE} select count(*) as rows, count(*) as stamped, 1::bigint as batches from bronze",
    "declared_relations": f"""with {STATES}, other as (with {ALERTS} select cast(event_time as date) as event_day from alerts)
select 'pitches' as relation, cast(event_time as date) as event_day, count(*) as n from bronze group by all
union all select 'game_state', cast(event_time as date), count(*) from states group by all
union all select 'corrections', cast(event_time as date), count(*) from corrections group by all
union all select 'alerts', event_day, count(*) from other group by all""",
}

ORACLE["fatigue_parts"] = f"""with {CORRECTED},
games as (
  select pitcher_id, game_pk, min(event_time) as start, year(min(event_time)) as season, count(*) as n from corrected group by 1, 2
),
usual as (
  select pitcher_id, game_pk, sum(n) over w / cast(count(n) over w as double) as usual_pitches from games
  window w as (partition by pitcher_id, season order by start, game_pk rows between unbounded preceding and 1 preceding)
),
typed as (
  select pitcher_id, game_pk, pitch_type, sum(cast(release_spin_rate as decimal(18,6))) as spin, count(release_spin_rate) as spins
  from corrected where pitch_type is not null group by 1, 2, 3
),
usual_spins as (
  select t.pitcher_id, t.game_pk, pitch_type,
    case when sum(spins) over w > 0 then cast(sum(spin) over w as double) / sum(spins) over w end as usual_spin
  from typed t join games g on g.pitcher_id = t.pitcher_id and g.game_pk = t.game_pk
  window w as (partition by t.pitcher_id, season, pitch_type order by start, t.game_pk rows between unbounded preceding and 1 preceding)
),
rows_seen as (
  select c.*, release_spin_rate - usual_spin as gap, zone <= 9 or {_EDGE} as commanded
  from corrected c left join usual_spins u on u.pitcher_id = c.pitcher_id and u.game_pk = c.game_pk and u.pitch_type = c.pitch_type
),
parts as (
  select *, row_number() over ({ORDINAL}) as pitch_idx, {mean("gap", _last(20))} as spin_vs_type_last_20,
    count(*) filter (commanded) over ({_last(15)}) / cast(count(*) over ({_last(15)}) as double) as command_last_15
  from rows_seen
)
select game_pk, pitcher_id, at_bat_number, pitch_number, pitch_idx, pitch_idx / usual_pitches as relative_pitch_count,
  spin_vs_type_last_20, command_last_15
from parts left join usual using (pitcher_id, game_pk)"""

ORACLE["quality_one_pass"] = ORACLE["quality_report"]
