import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest

from tests.conftest import by_user, day
from tidemark.config import JobConfig
from tidemark.operators import gamemix, sessions

SCHEMA = "user_id bigint, rid bigint, date date, lpi double, hour string, gameId string"
CHANGES = sessions.CHANGE_COLUMNS


def play(spark, lpi_by_user):
    rows = [
        (u, i, day(f"2020-01-{i + 1:02d}"), v, "9", "1")
        for u, values in lpi_by_user.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SCHEMA)


FIXTURE = {
    1: [100.0, 110.0, 105.0, 120.0, 130.0, 125.0],
    2: [50.0, 60.0],
    3: [None, 40.0, None],
    4: [None],
}


def test_first_lpi_skips_missing(spark):
    got = by_user(sessions.first_lpi(play(spark, FIXTURE)), "first_recorded_lpi")
    assert got == {1: (100.0,), 2: (50.0,), 3: (40.0,), 4: (None,)}


@pytest.mark.parametrize(
    "align,second", [("left", (0, 10, 0, 0, 0)), ("right", (0, 0, 0, 0, 10))]
)
def test_last_five(spark, align, second):
    got = by_user(sessions.last_five_changes(play(spark, FIXTURE), align), *CHANGES)
    assert got[1] == (10, -5, 15, 10, -5)
    assert got[2] == second
    assert got[3] == got[4] == (0, 0, 0, 0, 0)


def test_last_five_list_keeps_missing_changes(spark):
    got = by_user(sessions.last_five_list(play(spark, FIXTURE)), "last_5_deltas")
    assert got == {1: ([10, -5, 15, 10, -5],), 2: ([None, 10],), 3: ([None] * 3,), 4: ([None],)}


def test_unknown_alignment_is_refused(spark):
    with pytest.raises(ValueError):
        sessions.last_five_changes(play(spark, FIXTURE), "middle")


def test_hours_fixture(spark):
    rows = [(2, 1, day("2020-01-01"), 1.0, "9,10,11", "1"), (2, 2, day("2020-01-02"), 1.0, "23,0", "2")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert by_user(sessions.session_length(df), "length_of_session_avgs")[2] == (12.5,)
    mean, std = by_user(sessions.hour_stats(df), "hour_avg", "hour_std")[2]
    assert mean == pytest.approx(10.6)
    assert std == pytest.approx(math.sqrt(53.84))


def test_equal_hours_have_exactly_no_deviation(spark):
    rows = [(1, i, day("2020-01-01"), 1.0, "7,7,7", "1") for i in range(101)]
    assert by_user(sessions.hour_stats(spark.createDataFrame(rows, SCHEMA)), "hour_std")[1] == (0.0,)


def test_a_token_that_is_no_number_fails(spark):
    df = spark.createDataFrame([(1, 1, day("2020-01-01"), 1.0, "7,x", "1")], SCHEMA)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sessions.hour_stats(df).collect()


def random_play(spark, seed, rows=1200):
    rng = random.Random(seed)
    data = []
    for rid in rng.sample(range(20 * rows), rows):
        user = 0 if rng.random() < 0.4 else rng.randrange(1, 150)
        date = pd.Timestamp("2020-01-01") + pd.Timedelta(days=rng.randrange(12))
        hours = ",".join(str(rng.randrange(24)) for _ in range(rng.randrange(1, 5)))
        games = ",".join(str(rng.randrange(30)) for _ in range(rng.randrange(1, 5)))
        lpi = None if rng.random() < 0.2 else round(rng.uniform(0, 500), 2)
        data.append((user, rid, date.date(), lpi, hours, games))
    return spark.createDataFrame(data, SCHEMA)


def brute_features(pdf, align):
    out = {}
    for user, g in pdf.sort_values(["date", "rid"]).groupby("user_id"):
        known = g["lpi"].dropna()
        if known.empty:
            continue
        deltas = g["lpi"].diff().tolist()[-5:]
        pad = [0.0] * (5 - len(deltas))
        deltas = [0.0 if math.isnan(d) else d for d in deltas]
        slots = deltas + pad if align == "left" else pad + deltas
        lists = [[int(x) for x in h.split(",")] for h in g["hour"]]
        flat = [x for h in lists for x in h]
        out[user] = (
            known.iloc[0],
            *slots,
            np.mean([abs(h[-1] - h[0]) for h in lists]),
            np.mean(flat),
            np.std(flat),
        )
    return out


@pytest.mark.parametrize("align", ["left", "right"])
@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_features_match_brute_force_in_any_layout(spark, align, partitions):
    df = random_play(spark, 5).repartition(partitions)
    want = brute_features(df.toPandas(), align)
    result = sessions.session_features(df, JobConfig(align=align))
    got = by_user(result, *[c for c in result.columns if c != "user_id"])
    assert got.keys() == want.keys()
    for user, values in want.items():
        assert got[user] == pytest.approx(values), user


@pytest.mark.parametrize("max_rows", [3, 40, 1_000_000])
def test_deltas_match_pandas_when_users_are_cut(spark, max_rows):
    df = random_play(spark, 6)
    pdf = df.toPandas().sort_values(["user_id", "date", "rid"])
    pdf["delta"] = pdf.groupby("user_id")["lpi"].diff()
    got = sessions.lpi_deltas(df, max_rows=max_rows).toPandas().set_index("rid")["delta"].sort_index()
    pd.testing.assert_series_equal(got, pdf.set_index("rid")["delta"].sort_index())


@pytest.mark.parametrize("max_rows", [11, 1_000_000])
@pytest.mark.parametrize("max_sessions", [10, 10_000])
def test_games_string_segments_join_to_the_whole(spark, max_rows, max_sessions):
    df = random_play(spark, 7)
    pdf = df.toPandas().sort_values(["date", "rid"])
    want = pdf.groupby("user_id")["gameId"].agg(",".join).to_dict()
    sizes = pdf.groupby("user_id").size()
    parts = sessions.games_string(df, max_sessions, max_rows).toPandas().sort_values("segment")
    assert parts.groupby("user_id")["games"].agg(",".join).to_dict() == want
    segments = parts.groupby("user_id").size()
    assert (segments == -(-sizes // max_sessions)).all()


def test_slices_follow_the_time_of_day(spark):
    """Slices of any size give the deltas of one window, with rows numbered against time."""
    start = dt.datetime(2024, 1, 1)
    rows = [(1, start + dt.timedelta(minutes=7 * i), 500 - i, float(i * i)) for i in range(40)]
    rows += [(1, start, 900 + i, float(i)) for i in range(10)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"user_id bigint, date {kind}, rid bigint, lpi double")
        want = sorted(map(str, sessions.lpi_deltas(df).collect()))
        for size in (1, 5, 17):
            assert sorted(map(str, sessions.lpi_deltas(df, max_rows=size).collect())) == want


def test_missing_hours_do_not_count(spark):
    df = spark.createDataFrame([(1, "5,10"), (1, None)], "user_id bigint, hour string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert sessions.hour_stats(df).first()["hour_avg"] == 7.5
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_folded_plays_give_the_features_of_the_lists(spark):
    rng = random.Random(8)
    rows, start = [], dt.datetime(2024, 1, 1)
    for rid in rng.sample(range(9000), 900):
        at = start + dt.timedelta(minutes=rng.randrange(6 * 1440) // 30 * 30)
        lpi = None if rng.random() < 0.2 else round(rng.uniform(0, 500), 2)
        rows.append((rng.choice([1, 1, 2, 3, 4]), at, rid, None if rng.random() < 0.1 else at.hour, lpi, rng.randrange(9)))
    plays = spark.createDataFrame(rows, "user_id bigint, at timestamp_ntz, rid bigint, hour int, lpi double, game_id int")
    lists: dict = {}
    for user, at, rid, hour, lpi, game in sorted(rows, key=lambda r: (r[1], r[2])):
        lists.setdefault((user, at.date()), []).append((rid, hour, lpi, game))
    sessions_rows = []
    for (user, date), played in lists.items():
        known = [x for _, _, x, _ in played if x is not None]
        hours = ",".join(str(h) for _, h, _, _ in played if h is not None)
        games = ",".join(str(g) for _, _, _, g in played)
        sessions_rows.append((user, min(p[0] for p in played), date, sum(known) / len(known) if known else None, hours or None, games))
    listed = spark.createDataFrame(sessions_rows, SCHEMA)
    folded = sessions.fold_plays(plays)
    assert folded.count() == len(sessions_rows)
    for fn in (sessions.session_features, sessions.session_length, sessions.hour_stats):
        a, b = fn(folded), fn(listed)
        columns = [c for c in a.columns if c != "user_id"]
        got, want = by_user(a, *columns), by_user(b, *columns)
        assert got.keys() == want.keys() and all(got[u] == pytest.approx(want[u]) for u in got)
    for fn in (gamemix.game_counts, gamemix.game_totals, gamemix.game_proportions):
        assert sorted(fn(plays).collect()) == sorted(fn(listed).collect())
    assert gamemix.games_played(plays) == gamemix.games_played(listed)
