import datetime as dt
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import by_user, day
from tidemark import storage
from tidemark.config import JobConfig
from tidemark.plans import jobs, restart
from tidemark.sources.byuser import read_by_user, write_by_user
from tidemark.sources.checked import read_checked, reason_counts
from tidemark.sources.tables import SCHEMAS, Dataset, load, read_back, read_table, write_table


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_reads_by_name_and_keeps_extra_columns(spark, tmp_path):
    path = put(tmp_path, "d.csv", "language,extra,age,userId,gender\nen,x,30.0,7,m\n,y,,8,\n")
    df = read_table(spark, "demographics", Dataset(path))
    assert df.columns == ["user_id", "age", "gender", "language", "extra"]
    assert by_user(df, "age", "gender", "language", "extra") == {7: (30, "m", "en", "x"), 8: (None, None, None, "y")}


def test_single_numbers_stay_text(spark, tmp_path):
    path = put(tmp_path, "s.csv", "user_id,date,lpi,hour,gameId\n1,2020-01-02 23:10:00,1.5,7,3\n")
    row = read_table(spark, "sessions", Dataset(path)).first()
    assert (row.date, row.lpi, row.hour, row.gameId, row.rid) == (day("2020-01-02"), 1.5, "7", "3", 0)


def test_nan_text_becomes_missing(spark, tmp_path):
    path = put(tmp_path, "v.csv", "user_id,weekOfYear,lpi,gameVariety\n1,2,NaN,NaN\n")
    row = read_table(spark, "variety", Dataset(path)).first()
    assert (row.lpi, row.gameVariety) == (None, None)


def test_parquet_types_are_aligned(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.sql(
        "SELECT 1 AS userId, 3L AS weekOfYear, cast('NaN' AS double) AS lpi, 4 AS gameVariety"
    ).write.parquet(path)
    df = read_table(spark, "variety", Dataset(path, format="parquet"))
    assert df.schema["user_id"].dataType.simpleString() == "bigint"
    assert [f.dataType.simpleString() for f in df.schema][1:] == ["int", "double", "double"]
    assert tuple(df.first()) == (1, 3, None, 4.0)


def test_named_row_id(spark, tmp_path):
    path = put(tmp_path, "s.csv", "user_id,date,state,workout_day,gameplay_day,seq\n1,2020-01-02,subs,1,2,55\n")
    df = read_table(spark, "subscriptions", Dataset(path, row_id="seq"))
    assert df.columns == [*SCHEMAS["subscriptions"].fieldNames(), "rid"]
    assert df.first().rid == 55


def test_row_limit_follows_the_stated_order(spark, tmp_path):
    lines = "\n".join(f"{u},2020-01-01,subs,1,2" for u in (9, 3, 5, 1))
    path = put(tmp_path, "s.csv", "user_id,date,state,workout_day,gameplay_day\n" + lines)
    df = read_table(spark, "subscriptions", Dataset(path), row_limit=2)
    assert sorted(r.user_id for r in df.collect()) == [1, 3]


def test_missing_column_and_unknown_dataset_are_named(spark, tmp_path):
    path = put(tmp_path, "d.csv", "user_id,age\n1,2\n")
    with pytest.raises(ValueError, match="gender"):
        read_table(spark, "demographics", Dataset(path))
    with pytest.raises(KeyError, match="sessions"):
        load(spark, {"sessions": Dataset(path)}, "variety")


@pytest.mark.parametrize("format", ["tsv", "parquet"])
def test_round_trip(spark, tmp_path, format):
    df = spark.createDataFrame(
        [(1, "a\tb", None, dt.date(2020, 1, 2)), (2, None, 1.5, None)], "user_id bigint, t string, x double, d date"
    )
    path = str(tmp_path / "out")
    write_table(df, path, format)
    write_table(df, path, format)
    got = sorted(map(tuple, read_back(spark, path, df.schema, format).collect()))
    assert got == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        write_table(df, path, "xml")


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert storage.fresh_path(spark, "a").startswith(configured)
    df = spark.range(5).toDF("user_id")
    kept = storage.materialize(df, "five")
    assert all(f.startswith(f"file://{configured}") or configured in f for f in kept.inputFiles())
    assert kept.count() == 5


REGISTRY_TEXT = {
    "demographics": "user_id,age,gender,language\n1,30,m,en\n2,200,f,en\n3,40,f,de\n",
    "sessions": "user_id,date,lpi,hour,gameId\n"
    '1,2020-01-01,10,"9,10","1,2"\n1,2020-01-03,14,"11,9",2\n2,2020-01-01,5,7,1\n3,2020-01-01,8,"1,2",3\n',
    "variety": "user_id,weekOfYear,lpi,gameVariety\n1,1,1,2\n1,2,1,4\n2,1,1,3\n3,1,1,1\n",
    "subscriptions": "user_id,date,state,workout_day,gameplay_day\n"
    "1,2020-01-01,subs,1,2\n1,2020-02-01,subs,3,\n2,2020-01-01,free,1,5\n3,2020-01-01,free,2,7\n3,2020-01-05,free,4,9\n",
}


@pytest.fixture
def registry(tmp_path):
    return {name: Dataset(put(tmp_path, f"{name}.csv", text)) for name, text in REGISTRY_TEXT.items()}


@pytest.mark.parametrize("format", [None, "tsv", "parquet"])
def test_matrix_from_csv_files(spark, tmp_path, registry, format):
    config = JobConfig(
        intermediates=str(tmp_path / "kept") if format else None, intermediates_format=format or "tsv"
    )
    matrix = jobs.matrix_job(spark, registry, config)
    assert len(matrix.columns) == 19  # user_id, label, 17 features
    got = by_user(
        matrix, "workout_day", "gameplay_day", "churned", "prior_churn_count", "first_recorded_lpi",
        "ffth_last_lpi_change", "frth_last_lpi_change", "length_of_session_avgs", "hour_avg", "gv_avg", "age", "is_male",
    )
    assert got == {
        1: (3.0, 7.0, 1, 0, 10.0, 0.0, 4.0, 1.5, 9.75, 3.0, 30, 1),
        3: (4.0, 9.0, 0, 0, 8.0, 0.0, 0.0, 1.0, 1.5, 1.0, 40, 0),
    }
    if format:
        written = {p.name for p in (tmp_path / "kept").iterdir()}
        assert written == {"intermed_demograph", "intermed_gameid", "intermed_gamevar", "intermed_subs", "final_matrix"}


@pytest.fixture
def kept(tmp_path):
    return JobConfig(intermediates=str(tmp_path / "kept"))


def folders(tmp_path):
    """{table: its data folders}"""
    return {p.name: sorted(d.name for d in p.iterdir() if d.name.startswith("data-")) for p in (tmp_path / "kept").iterdir()}


def test_a_killed_job_resumes(spark, tmp_path, registry, kept, monkeypatch):
    written = []

    def dies(df, path, format):
        if len(written) == 2:
            # Half a table, and then the end.
            df.limit(1).write.parquet(path)
            raise KeyboardInterrupt
        written.append(path)
        return write_table(df, path, format)

    monkeypatch.setattr(restart, "write_table", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.matrix_job(spark, registry, kept)
    before = folders(tmp_path)
    assert sorted(map(len, before.values())) == [1, 1, 1]
    monkeypatch.setattr(restart, "write_table", lambda *a: written.append(a[1]) or write_table(*a))
    matrix = jobs.matrix_job(spark, registry, kept)
    assert len(written) == 5 and sorted(r.user_id for r in matrix.collect()) == [1, 3]
    whole = {p.split("/")[-2] for p in written[:2]}
    after = folders(tmp_path)
    assert all(after[t] == before[t] for t in whole) and len(after) == 5
    assert jobs.matrix_job(spark, registry, kept).count() == 2 and len(written) == 5


def test_other_options_or_input_are_built_anew(spark, tmp_path, registry, kept):
    assert jobs.subscriptions_job(spark, registry, kept).where("user_id = 1").first().churned == 1
    other = replace(kept, churn_threshold=500)
    assert jobs.subscriptions_job(spark, registry, other).where("user_id = 1").first().churned == 0
    assert len(folders(tmp_path)["intermed_subs"]) == 2
    put(tmp_path, "subscriptions.csv", REGISTRY_TEXT["subscriptions"] + "9,2020-01-01,subs,1,2\n")
    assert jobs.subscriptions_job(spark, registry, kept).count() == 4
    assert len(folders(tmp_path)["intermed_subs"]) == 3
    games = [jobs.game_matrix_job(spark, registry, g, kept).columns for g in ([1, 2, 3], None, [1, 2, 3, 4], [1, 2, 3])]
    assert [len(g) for g in games] == [4, 4, 5, 4] and len(folders(tmp_path)["knn_matrix"]) == 3


def test_forgotten_versions_go(spark, tmp_path, registry, kept):
    jobs.variety_job(spark, registry, kept)
    jobs.variety_job(spark, registry, replace(kept, null_policy="skip"))
    folder = f"{kept.intermediates}/intermed_gamevar"
    mark = restart.fingerprint(spark, "variety", kept, {"variety": registry["variety"]})
    assert restart.forget(spark, folder, [mark]) == 2
    assert restart.finished(spark, folder, mark) and jobs.variety_job(spark, registry, kept).count() == 3
    assert restart.forget(spark, f"{folder}-none", []) == 0


def test_two_writers_of_one_table(spark, tmp_path, registry, kept):
    folder, schema = f"{kept.intermediates}/x", spark.range(1).schema
    restart.publish(spark, folder, "m", "data-1", schema, "parquet")
    restart.publish(spark, folder, "m", "data-2", schema, "parquet")
    assert restart.finished(spark, folder, "m")[0].endswith("data-1")
    assert not [p for p in (tmp_path / "kept" / "x").iterdir() if "writing" in p.name]


def test_matrix_and_funnel_of_one_pass(spark, registry):
    tables = jobs.all_features(spark, registry)
    rows, funnel = tables.matrix_and_funnel()
    assert rows.columns == tables.matrix().columns
    assert sorted(rows.collect()) == sorted(tables.matrix().collect())
    assert sorted(funnel.collect()) == sorted(tables.funnel().collect())
    twice = replace(tables, demographics=tables.demographics.unionAll(tables.demographics))
    with pytest.raises(Exception, match="more than one row"):
        twice.matrix_and_funnel()


def test_game_matrix_from_csv_files(spark, registry):
    wide = jobs.game_matrix_job(spark, registry, [1, 2, 3])
    assert by_user(wide, "game_1", "game_2", "game_3")[3] == (0.0, 0.0, 1.0)


def test_funnel_of_the_jobs(spark, registry):
    steps = {(r.step, r.side): r.users for r in jobs.all_features(spark, registry).funnel().collect()}
    assert steps[(3, "demographics")] == 2 and steps[(4, "matrix")] == 2 and steps[(1, "subs")] == 3


def test_bad_options_are_refused():
    with pytest.raises(ValueError):
        JobConfig(align="middle")
    with pytest.raises(ValueError):
        JobConfig(null_policy="zero")


def test_files_with_other_headers_fail_and_paths_join_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("user_id,age,gender,language\n1,20,m,en\n")
    (tmp_path / "b.csv").write_text("language,gender,age,userId\nfr,f,30,2\n")
    paths = (str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    rows = read_table(spark, "demographics", Dataset(paths)).collect()
    assert sorted((r["user_id"], r["age"], r["gender"]) for r in rows) == [(1, 20, "m"), (2, 30, "f")]
    with pytest.raises(Exception):
        read_table(spark, "demographics", Dataset(str(tmp_path))).collect()


def test_texts_survive_tab_separated_files(spark, tmp_path):
    values = ["  a ", "", None, "line\nbreak", 'say "hi"', "tab\there", "back\\slash"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    path = write_table(df, str(tmp_path / "t"))
    assert sorted(read_back(spark, path, df.schema).collect()) == sorted(df.collect())


@pytest.fixture
def small_splits(spark):
    """Sets the size of a task's piece of a file."""
    options = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def cut(size):
        for option in options:
            spark.conf.set(option, size)

    yield cut
    for option in options:
        spark.conf.unset(option)


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_positions_hold_under_any_partitioning(spark, tmp_path, small_splits, format):
    rows = spark.range(3000).selectExpr("id % 50 AS user_id", "date'2020-01-01' AS date", "'free' AS state", "1 AS workout_day", "1 AS gameplay_day", "id")
    paths = [str(tmp_path / n) for n in "ba"]
    rows.where("id < 2000").repartitionByRange(3, "id").sortWithinPartitions("id").write.option("header", True).option(
        "parquet.block.size", 2048
    ).format(format).save(paths[0])
    rows.where("id >= 2000").coalesce(1).sortWithinPartitions("id").write.option("header", True).format(format).save(paths[1])
    tasks = []
    for size in ("100m", "2k"):
        small_splits(size)
        df = read_table(spark, "subscriptions", Dataset(tuple(paths), format=format))
        tasks.append(spark.read.option("header", True).format(format).load(paths[0]).rdd.getNumPartitions())
        got = [(int(r["id"]), r["rid"]) for r in df.collect()]
        assert sorted(got) == [(i, i) for i in range(3000)]
    assert tasks[1] > tasks[0]


def test_positions_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).selectExpr("id AS user_id", "date'2020-01-01' AS date", "'a' AS state", "1 AS workout_day", "1 AS gameplay_day").write.parquet(path)
    assert read_table(spark, "subscriptions", Dataset(path, format="parquet")).count() == 0


def test_a_heavy_user_is_spread_over_files(spark, tmp_path):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 9 = 0 THEN NULL ELSE id % 40 END AS user_id", "id AS rid")
    path = write_by_user(rows, str(tmp_path / "t"), 5, ["user_id", "rid"], max_rows=300)
    back = read_by_user(spark, path)
    assert back.columns == ["user_id", "rid"]
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    files = back.where("user_id = 7").groupBy(F.input_file_name()).count()
    assert files.count() >= 7 and files.agg(F.max("count")).first()[0] <= 300
    with pytest.raises(AnalysisException):
        write_by_user(rows, path, 5)


def test_scratch_tables_go_and_results_stay(spark):
    kept = storage.fresh_path(spark, "kept")
    with pytest.raises(ZeroDivisionError):
        with storage.scratch(spark, "failed") as failed:
            storage.materialize(spark.range(3), "x")
            raise ZeroDivisionError
    with storage.scratch(spark, "work") as work:
        inner = storage.materialize(spark.range(5), "inner")
        assert all(f.startswith(("file:", "/")) and work.split(":")[-1] in f for f in inner.inputFiles())
        with storage.scratch(spark, "nested") as nested:
            storage.materialize(spark.range(2), "y")
            assert nested.startswith(work)
        inner.write.parquet(kept)
    assert spark.read.parquet(kept).count() == 5
    for gone in (failed, work):
        with pytest.raises(AnalysisException):
            spark.read.parquet(gone)
    assert not storage.fresh_path(spark, "after").startswith(work)


def test_rejected_rows_have_their_reasons(spark, tmp_path):
    text = (
        "userId,date,lpi,hour,gameId,extra\n"
        "1,2020-01-01,1.5,9,1,a\n"
        "2,2020-01-02,NaN,\"9,10\",\"1,2\",b\n"
        "3,2020-01-03\n"
        "4,2020-13-01,x,9,1,c\n"
        ",2020-01-04,2,9,1,d\n"
        "5,2020-01-05,2,\"9,ten\",1,e\n"
        "6,,2,9,1,f\n"
        "7,2020-01-07,2,9,1,g,more\n"
        "8.0,2020-01-08 10:00:00,,9,1,\n"
    )
    found = read_checked(spark, "sessions", Dataset(put(tmp_path, "s.csv", text)))
    good = {r.user_id: tuple(r)[1:] for r in found.good.collect()}
    assert found.good.columns == ["user_id", "date", "lpi", "hour", "gameId", "extra", "rid"]
    assert good == {
        1: (day("2020-01-01"), 1.5, "9", "1", "a", 0),
        2: (day("2020-01-02"), None, "9,10", "1,2", "b", 1),
        8: (day("2020-01-08"), None, "9", "1", None, 8),
    }
    rejected = {r["at"]: r.reasons for r in found.rejected.collect()}
    fields = "the line has another number of fields than the header"
    assert rejected == {
        2: [fields],
        3: ["date: not a date: 2020-13-01", "lpi: not a number: x"],
        4: ["user_id: missing"],
        5: ["hour: not a list of whole numbers: 9,ten"],
        6: ["date: missing"],
        7: [fields],
    }
    raw = {r["at"]: r.raw for r in found.rejected.collect()}
    assert raw[2] == "3,2020-01-03" and '"lpi":"x"' in raw[3]
    counts = {r.reason: r.rows for r in reason_counts(found.rejected).collect()}
    assert counts == {fields: 2, "date: not a date": 1, "lpi: not a number": 1, "user_id: missing": 1,
                      "hour: not a list of whole numbers": 1, "date: missing": 1}


@pytest.mark.parametrize("table", ["demographics", "variety", "sessions", "subscriptions"])
def test_checked_reads_good_files_as_ever(spark, registry, table):
    found = read_checked(spark, table, registry[table])
    assert found.rejected.count() == 0
    plain = read_table(spark, table, registry[table])
    assert found.good.columns == plain.columns and sorted(map(str, found.good.collect())) == sorted(map(str, plain.collect()))


def test_checked_typed_files(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.sql("SELECT 1 AS userId, 3L AS weekOfYear, cast('NaN' AS double) AS lpi, 4 AS gameVariety UNION ALL SELECT NULL, 1, 1, 1").write.parquet(path)
    found = read_checked(spark, "variety", Dataset(path, format="parquet"))
    assert [tuple(r) for r in found.good.collect()] == [(1, 3, None, 4.0)]
    assert [r.reasons for r in found.rejected.collect()] == [["user_id: missing"]]
    with pytest.raises(ValueError, match="lacks columns"):
        read_checked(spark, "sessions", Dataset(path, format="parquet"))
