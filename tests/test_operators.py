import datetime

import pytest
from pyspark.sql import functions as F

from conftest import START, frame, pitch, twelve_rows
from dualpath import schemas
from dualpath.functions import cleaning
from dualpath.operators import corrections, dedup, event_time, nested, perturb, quality, transitions
from dualpath.operators.ordered import OrderedGroups
from dualpath.plans import staging
from dualpath.sources import raw, topics


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_half_inning(spark):
    assert one(spark, cleaning.half_inning, "top", "TOP 3", "Bottom", "", None) == ["Top", "Top", "Bot", "Bot", "Bot"]


def test_lenient_numbers(spark):
    text = ["95.1", " 95.1 ", "NaN", "nan", "", "abc", None]
    assert one(spark, cleaning.lenient_double, *text) == [95.1, 95.1, None, None, None, None, None]
    assert one(spark, cleaning.lenient_int, "5.9", "-2.7", "inf", "x", None) == [5, -2, None, None, None]


def test_clean_text(spark):
    assert one(spark, cleaning.clean_text, "FF", "  ", "", "NaN", "\tx\n", None) == ["FF", None, None, None, "x", None]


def test_absent_score_columns_default_to_zero(spark):
    df = frame(spark, [pitch()]).withColumnsRenamed({"pitcher_id": "pitcher", "batter_id": "batter"})
    got = raw.typed_pitches(df.drop("home_score", "away_score")).first()
    assert (got["home_score"], got["away_score"], got["pitcher_id"]) == (0, 0, 5150)


def test_twelve_pitch_game(spark):
    got = transitions.game_state_events(frame(spark, twelve_rows()))
    counts = {r["event_type"]: r["count"] for r in got.groupBy("event_type").count().collect()}
    assert counts == {"game_start": 1, "inning_start": 2, "pitching_change": 2, "scoring_play": 2}


@pytest.mark.parametrize(
    "second, expected",
    [
        ({}, []),
        ({"inning_topbot": "Bot"}, ["inning_start"]),
        ({"inning": 2}, ["inning_start"]),
        ({"pitcher_id": 2}, ["pitching_change"]),
        ({"inning": 2, "pitcher_id": 2}, ["inning_start"]),
        ({"home_score": 1}, ["scoring_play"]),
        ({"away_score": 1}, ["scoring_play"]),
        ({"inning": 2, "away_score": 1}, ["inning_start", "scoring_play"]),
        ({"pitcher_id": 2, "home_score": 1}, ["pitching_change", "scoring_play"]),
    ],
)
def test_transition_pairs(spark, second, expected):
    rows = [pitch(), pitch(minute=1, pitch_number=2, **second)]
    got = transitions.game_state_events(frame(spark, rows)).where("event_type != 'game_start'").collect()
    assert sorted(r["event_type"] for r in got) == sorted(expected)
    for r in got:
        named = r["home_pitcher_id"] or r["away_pitcher_id"]
        assert (named == 2) == (r["event_type"] == "pitching_change")


@pytest.mark.parametrize("half, home, away", [("Top", 5150, None), ("Bot", None, 5150)])
def test_game_start_names_the_fielding_pitcher(spark, half, home, away):
    got = transitions.game_state_events(frame(spark, [pitch(inning_topbot=half)])).first()
    assert (got["home_pitcher_id"], got["away_pitcher_id"]) == (home, away)


def test_falling_score_emits_nothing(spark):
    rows = [pitch(home_score=2), pitch(minute=1, pitch_number=2, home_score=1)]
    got = transitions.game_state_events(frame(spark, rows))
    assert [r["event_type"] for r in got.collect()] == ["game_start"]


def test_synthesized_clock(spark):
    rows = frame(spark, twelve_rows()).withColumn("game_date", F.to_date("event_time"))
    got = event_time.synthesize_event_time(rows).orderBy("event_time").collect()
    start = datetime.datetime.combine(START.date(), datetime.time(19))
    offsets = [int((r["event_time"] - start).total_seconds()) for r in got]
    assert offsets == [0, 23, 46, 136, 159, 249, 272, 295, 385, 475, 498, 521]


def test_late_rows_follow_the_key_clock(spark):
    rows = [pitch(minute=m, pitch_number=i) for i, m in enumerate([0, 10, 6, 4, 11])]
    groups = OrderedGroups(("game_pk",), (F.asc("source_offset"),))
    got = event_time.tag_late(frame(spark, rows, position=True), groups).orderBy("source_offset").collect()
    assert [r["is_late"] for r in got] == [False, False, False, True, False]


def test_dedup_prefers_newest_then_on_time(spark):
    later = START + datetime.timedelta(minutes=9)
    rows = [
        pitch(is_late_arrival=True),
        pitch(),
        pitch(pitch_number=2),
        pitch(pitch_number=2, ingest_time=later, release_speed=90.0),
        pitch(pitch_number=3, is_duplicate=True),
    ]
    got = staging.deduplicated(frame(spark, rows, position=True)).orderBy("pitch_number").collect()
    assert [(r["pitch_number"], r["is_late_arrival"], r["release_speed"]) for r in got] == [
        (1, False, 93.5),
        (2, False, 90.0),
    ]


def fixes(spark, *rows):
    at = [START + datetime.timedelta(minutes=m) for _, _, _, m in rows]
    data = [(t, t, 41007, uid, field, None, new) for t, (uid, field, new, _) in zip(at, rows)]
    return spark.createDataFrame(data, schemas.CORRECTION)


def test_corrections(spark):
    rows = [pitch(pitch_number=n) for n in (1, 2, 3, 4)]
    log = fixes(
        spark,
        ("41007:1:1", "pitch_type", "SI", 1),
        ("41007:1:1", "pitch_type", "FC", 2),
        ("41007:1:2", "pitch_type", "SI", 1),
        ("41007:1:2", "pitch_type", None, 2),
        ("041007:1:3", "pitch_type", "KC", 1),
        ("41007:1:3", "zone", "9", 1),
        ("41007:1:4", "release_speed", "n/a", 1),
        ("1:1:1", "pitch_type", "KC", 1),
    )
    bronze = frame(spark, rows, position=True)
    typed = {r["pitch_number"]: r for r in staging.staged_pitches(bronze, log).collect()}
    assert [typed[n]["pitch_type"] for n in (1, 2, 3, 4)] == ["FC", "FF", "FF", "FF"]
    assert typed[3]["zone"] == 4
    full = {r["pitch_number"]: r for r in staging.staged_pitches_all_fields(bronze, log).collect()}
    assert [full[n]["pitch_type"] for n in (1, 2, 3, 4)] == ["FC", "FF", "FF", "FF"]
    assert (full[3]["zone"], full[4]["release_speed"]) == (9, 93.5)
    assert corrections.latest_corrections(log).count() == 6


def test_perturbation_rates(spark):
    df = frame(spark, [pitch(745642)])
    none, every = perturb.Rates(0, 0, 0), perturb.Rates(1, 1, 1)
    assert perturb.with_copies(df, none).count() == 1
    assert perturb.drawn_corrections(df, none).count() == 0
    copies = perturb.with_copies(df, every).collect()
    assert sorted((r["is_duplicate"], r["is_late_arrival"]) for r in copies) == [
        (False, False),
        (False, True),
        (True, False),
    ]
    late = next(r for r in copies if r["is_late_arrival"])
    assert 30 <= (START - late["event_time"]).total_seconds() <= 300
    fix = perturb.drawn_corrections(df, every).first()
    assert (fix["field"], fix["old_value"], fix["original_pitch_uid"]) == ("pitch_type", "FF", "745642:1:1")
    assert fix["new_value"] in ("FT", "SI")
    assert 5 <= (fix["event_time"] - START).total_seconds() / 60 <= 45


@pytest.mark.parametrize("seed", [0, 1, 42, 2024])
def test_perturbation_is_repeatable_and_undone_by_dedup(spark, seed):
    rows = [pitch(minute=m, at_bat_number=m // 4 + 1, pitch_number=m % 4 + 1) for m in range(200)]
    clean = frame(spark, rows, position=True)
    rates = perturb.Rates(0.2, 0.2, 0.2)
    once = perturb.with_copies(clean, rates, seed)
    again = perturb.with_copies(clean.repartition(7), rates, seed)
    assert once.exceptAll(again).count() == 0 and once.count() > 200
    assert clean.exceptAll(staging.deduplicated(once)).count() == 0


def test_unknown_type_gets_no_correction(spark):
    df = frame(spark, [pitch(pitch_type="EP"), pitch(pitch_type=None, pitch_number=2)])
    assert perturb.drawn_corrections(df, perturb.Rates(1, 1, 1)).count() == 0


def test_wire_encoding(spark):
    at = datetime.datetime(2024, 7, 4, 19, 30, 0, 500_999)
    df = frame(spark, [pitch(event_time=at)])
    wire = topics.to_wire(df, "pitch").first()
    assert wire["event_time"] == 1720121400500
    assert list(wire.asDict()) == [f.name for f in schemas.PITCH] and wire["events"] is None
    back = topics.decode(topics.route(df, "pitch"), "pitch").first()
    assert back["event_time"] == at.replace(microsecond=500_000) and back["on_1b"] is None
    assert [len(schemas.ENTITIES[e]) for e in ("pitch", "game_state", "correction", "alert")] == [28, 11, 7, 11]
    with pytest.raises(ValueError):
        topics.wire_value("pitch", "xml")


def test_avro_schema_marks_times_and_optional_fields():
    import json

    fields = {f["name"]: f for f in json.loads(schemas.avro_schema("pitch"))["fields"]}
    assert fields["event_time"]["type"] == {"type": "long", "logicalType": "timestamp-millis"}
    assert fields["zone"]["type"] == ["null", "int"] and fields["zone"]["default"] is None
    assert fields["pitcher_id"]["type"] == "long"


def test_bronze_schema_drops_wire_time_and_adds_audit():
    names = [f.name for f in schemas.BRONZE_PITCH]
    assert len(names) == 30 and "ingest_time" not in names
    assert names[-3:] == ["ingestion_time", "source_offset", "kafka_partition"]


def test_quality_checks(spark):
    df = frame(spark, [pitch(), pitch(), pitch(pitch_number=2, inning_topbot="Mid", zone=None)])
    found = quality.report(
        quality.column_checks(df, "p", ["zone", "game_pk"], {"inning_topbot": ["Top", "Bot"]}),
        quality.unique(df, schemas.PITCH_KEY, "p"),
        quality.references(df, "pitch_number", df.where("pitch_number = 1"), "pitch_number", "p.pitch_number"),
    )
    assert [r["violations"] for r in found.collect()] == [1, 0, 1, 1, 1]
    good, bad = quality.quarantine_split(df, schemas.PITCH, schemas.ALLOWED_VALUES)
    assert (good.count(), bad.count()) == (2, 1)
    assert quality.missing_columns(df.drop("zone"), schemas.PITCH) == ["zone"]


def test_nested_documents(spark):
    doc = (
        '{"allPlays":[{"about":{"inning":3,"halfInning":"bottom"},"playEvents":['
        '{"startTime":"t1","details":{"eventType":"pitching_substitution","replacementPlayerId":7,"playerId":6}},'
        '{"startTime":"t2","details":{"eventType":"ball"}}]},{"about":{},"playEvents":[]}]}'
    )
    docs = spark.createDataFrame([(1, doc), (2, "{}")], "game_pk long, document string")
    assert [tuple(r) for r in nested.pitching_changes(docs).collect()] == [(1, 3, "Bottom", "t1", 7, 6)]
    assert [tuple(r) for r in nested.lineups(docs).collect()] == [(1, [], []), (2, [], [])]


def test_first_n_and_canonical_order(spark):
    df = frame(spark, twelve_rows()).repartition(5)
    got = [(r["inning"], r["inning_topbot"], r["at_bat_number"]) for r in raw.first_pitches(df, 6).collect()]
    assert got == [(1, "Top", 1)] * 3 + [(1, "Top", 2)] * 2 + [(1, "Bot", 3)]
    order = [F.asc("at_bat_number"), F.asc("pitch_number")]
    assert dedup.first_n_per_key(df, ["pitcher_id"], order, 2).count() == 7


def test_load_day_reads_one_day(spark, tmp_path):
    days = [START.date(), START.date() + datetime.timedelta(days=1)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "game_date date, game_pk long")
    df.write.parquet(str(tmp_path / "raw"))
    got = raw.load_day(spark, str(tmp_path / "raw"), days[1])
    assert [r["game_pk"] for r in got.collect()] == [1]
    assert "PushedFilters: [IsNotNull(game_date), EqualTo(game_date" in got._jdf.queryExecution().toString()


def test_topic_files_keep_topic_and_key(spark, tmp_path):
    pitches = frame(spark, twelve_rows())
    routed = topics.route_all({"pitch": pitches, "game_state": transitions.game_state_events(pitches)})
    topics.write_topics(routed, str(tmp_path / "topics"))
    back = spark.read.parquet(str(tmp_path / "topics"))
    counts = {r["topic"]: r["count"] for r in back.groupBy("topic").count().collect()}
    assert counts == {"pitches.raw": 12, "game_state.raw": 7}
    states = topics.decode(back.where("topic = 'game_state.raw'"), "game_state")
    assert states.where("key = concat(game_pk, ':', event_type)").count() == 7
