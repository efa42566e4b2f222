"""One StructType per entity, plus the rules the quality checks read."""

from __future__ import annotations

import json

from pyspark.sql import types as T

_TS, _L, _I, _D, _S, _B = (
    T.TimestampType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.BooleanType(),
)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Field names, types and nullability of the wire entities.
PITCH = _struct(
    ("event_time", _TS, False),
    ("ingest_time", _TS, False),
    ("game_pk", _L, False),
    ("at_bat_number", _I, False),
    ("pitch_number", _I, False),
    ("inning", _I, False),
    ("inning_topbot", _S, False),
    ("pitcher_id", _L, False),
    ("batter_id", _L, False),
    ("pitch_type", _S, True),
    ("release_speed", _D, True),
    ("release_spin_rate", _D, True),
    ("plate_x", _D, True),
    ("plate_z", _D, True),
    ("zone", _I, True),
    ("balls", _I, False),
    ("strikes", _I, False),
    ("outs_when_up", _I, False),
    ("on_1b", _L, True),
    ("on_2b", _L, True),
    ("on_3b", _L, True),
    ("description", _S, True),
    ("events", _S, True),
    ("home_score", _I, False),
    ("away_score", _I, False),
    ("is_late_arrival", _B, False),
    ("is_duplicate", _B, False),
    ("correction_of", _S, True),
)

GAME_STATE = _struct(
    ("event_time", _TS, False),
    ("ingest_time", _TS, False),
    ("game_pk", _L, False),
    ("inning", _I, False),
    ("inning_topbot", _S, False),
    ("home_score", _I, False),
    ("away_score", _I, False),
    ("home_pitcher_id", _L, True),
    ("away_pitcher_id", _L, True),
    ("next_batter_id", _L, True),
    ("event_type", _S, False),
)

CORRECTION = _struct(
    ("event_time", _TS, False),
    ("ingest_time", _TS, False),
    ("game_pk", _L, False),
    ("original_pitch_uid", _S, False),
    ("field", _S, False),
    ("old_value", _S, True),
    ("new_value", _S, True),
)

ALERT = _struct(
    ("event_time", _TS, False),
    ("emitted_time", _TS, False),
    ("alert_uid", _S, False),
    ("game_pk", _L, False),
    ("pitcher_id", _L, False),
    ("signal_type", _S, False),
    ("severity", _S, False),
    ("score", _D, False),
    ("score_threshold", _D, False),
    ("rationale", _S, False),
    ("inputs_snapshot_uid", _S, False),
)

AUDIT_COLUMNS = _struct(
    ("ingestion_time", _TS, False),
    ("source_offset", _L, False),
    ("kafka_partition", _I, False),
)

# Bronze keeps the pitch without its wire ingest time and adds where and when it was read.
BRONZE_PITCH = T.StructType([f for f in PITCH if f.name != "ingest_time"] + list(AUDIT_COLUMNS))

ENTITIES = {"pitch": PITCH, "game_state": GAME_STATE, "correction": CORRECTION, "alert": ALERT}

# Closed vocabularies.
ALLOWED_VALUES = {
    "inning_topbot": ["Top", "Bot"],
    "event_type": [
        "inning_start",
        "pitching_change",
        "pinch_hit",
        "scoring_play",
        "game_start",
        "game_end",
    ],
    "signal_type": ["fatigue", "leverage", "matchup", "composite"],
    "severity": ["info", "warning", "action"],
}

# Topic names by entity.
TOPICS = {
    "pitch": "pitches.raw",
    "game_state": "game_state.raw",
    "correction": "corrections.cdc",
    "fatigue": "features.fatigue.v1",
    "leverage": "features.leverage.v1",
    "matchup": "features.matchup.v1",
    "alert": "alerts.v1",
}

PITCH_KEY = ["game_pk", "at_bat_number", "pitch_number"]
PITCHER_GAME_KEY = ["game_pk", "pitcher_id"]


def required_fields(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def wire_schema(schema: T.StructType) -> T.StructType:
    """The same entity with its timestamps as epoch milliseconds."""
    return T.StructType(
        [
            T.StructField(f.name, _L if isinstance(f.dataType, T.TimestampType) else f.dataType, f.nullable)
            for f in schema
        ]
    )


_AVRO_NAMES = {"timestamp": "long", "bigint": "long"}


def avro_schema(name: str) -> str:
    """Avro record text derived from the StructType, for to_avro / from_avro."""
    fields = []
    for f in ENTITIES[name]:
        base = f.dataType.simpleString()
        kind = _AVRO_NAMES.get(base, base)
        if base == "timestamp":
            kind = {"type": "long", "logicalType": "timestamp-millis"}
        field = {"name": f.name, "type": ["null", kind] if f.nullable else kind}
        if f.nullable:
            field["default"] = None
        fields.append(field)
    return json.dumps({"type": "record", "name": name, "fields": fields})
