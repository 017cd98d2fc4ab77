"""Sources, sinks, the full run and the command line."""

import shutil
from dataclasses import replace
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql.types import StructType

from farm_fixture import PARAMS, farm_tables
from pulse import operators as op
from pulse.__main__ import main
from pulse.plans import DATASETS, build_dataset, job, run, source_tables
from pulse.session import LEGACY_DATE_SETTINGS, configure, scratch_path, shared_folder
from pulse.sinks import files, paths, publish_single_file, write_dataset
from pulse.sources import (
    CountedTables, load_table, load_tables, named_views, read_parquet, register_views, sql_over,
)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The fixture tables as a folder of Parquet tables."""
    path = tmp_path_factory.mktemp("tables")
    for name, df in farm_tables(spark).items():
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


# Sources


def test_load_from_folder_and_catalog(spark, folder, tmp_path):
    from_folder = load_table(spark, "users", folder=folder)
    spark.sql(f"create database farm_db location '{tmp_path}'")
    try:
        from_folder.write.saveAsTable("farm_db.users")
        assert op.row_diff(from_folder, load_table(spark, "users", database="farm_db")).count() == 0
        assert load_table(spark, "farm_db.users").count() == 3
    finally:
        spark.sql("drop database farm_db cascade")


def test_only_named_tables_are_persisted(spark, folder):
    tables = load_tables(spark, ["users", "farms"], folder=folder, persist=["users"])
    try:
        assert tables["users"].storageLevel.useMemory
        assert not tables["farms"].storageLevel.useMemory
    finally:
        tables["users"].unpersist()


def test_views(spark, folder):
    register_views(load_tables(spark, ["users", "farm_user"], folder=folder))
    joined = spark.sql("select name from users join farm_user on user_id = id where farm_id = 2")
    assert [row.name for row in joined.collect()] == ["Ana"]


def test_read_parquet_counts_rows_on_the_way(spark, folder):
    df, seen = read_parquet(spark, f"{folder}/users.parquet")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n_rows"] == 3


def test_legacy_date_settings(spark):
    before = {key: spark.conf.get(key) for key in LEGACY_DATE_SETTINGS}
    try:
        configure(spark, legacy_dates=True)
        assert {spark.conf.get(key) for key in LEGACY_DATE_SETTINGS} == {"LEGACY"}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# Sinks


def no_staging(path):
    return not list(Path(path).glob("**/_staging_*"))


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_round_trip(spark, tmp_path, fmt, single):
    df = build_dataset("animals", farm_tables(spark), PARAMS).repartition(3)
    path = write_dataset(df, str(tmp_path), "animals", fmt, single_file=single)
    assert path == f"{tmp_path}/animals.{fmt}"
    assert Path(path).is_file() == single
    assert op.row_diff(df, op.read_any(spark, path, df.schema)).count() == 0
    assert no_staging(tmp_path)


def test_csv_has_a_header_and_tells_null_from_empty(spark, tmp_path):
    df = spark.sql("select 1 as id, 'a,b' as note union all select 2, '' union all select 3, null")
    path = write_dataset(df, str(tmp_path), "notes", "csv", single_file=True, order_by=["id"])
    assert Path(path).read_text() == 'id,note\n1,"a,b"\n2,""\n3,\n'


def test_csv_times_read_like_instants_in_utc(spark, tmp_path):
    naive = spark.sql("select timestamp_ntz'2025-03-01 10:00:00' as t")
    path = write_dataset(naive, str(tmp_path), "naive", "csv", single_file=True)
    instant = naive.selectExpr("cast(t as timestamp) as t")
    other = write_dataset(instant, str(tmp_path), "instant", "csv", single_file=True)
    assert Path(path).read_text() == Path(other).read_text() == "t\n2025-03-01T10:00:00.000Z\n"


def test_an_output_may_read_from_the_one_it_replaces(spark, tmp_path):
    path = write_dataset(spark.range(10), str(tmp_path), "ids")
    more = spark.read.parquet(path).selectExpr("id + 1 as id")
    write_dataset(more, str(tmp_path), "ids")
    assert sorted(row.id for row in spark.read.parquet(path).collect()) == list(range(1, 11))


def test_a_failed_write_keeps_the_old_output(spark, tmp_path):
    path = write_dataset(spark.range(3), str(tmp_path), "ids")
    with pytest.raises(Exception):
        write_dataset(spark.range(3).selectExpr("raise_error('no') as id"), str(tmp_path), "ids")
    assert spark.read.parquet(path).count() == 3
    assert no_staging(tmp_path)


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_an_empty_dataset_keeps_its_columns(spark, tmp_path, fmt, single):
    df = spark.range(10).selectExpr("id", "id as n").filter("id < 0")
    path = write_dataset(df, str(tmp_path), "none", fmt, single_file=single, order_by=["id"])
    stored = op.read_any(spark, path)
    assert (stored.columns, stored.count()) == (["id", "n"], 0)
    assert Path(path).is_file() == single


def test_in_place_replaces_the_folder(spark, tmp_path):
    for n in (5, 3):
        path = write_dataset(spark.range(n), str(tmp_path), "ids", in_place=True)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["ids.parquet"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_large_output_stays_a_whole_folder(spark, tmp_path, fmt):
    df = spark.range(1000).repartition(4).sort("id")
    path = write_dataset(
        df, str(tmp_path), "ids", fmt, single_file=True, order_by=["id"], single_file_limit=100
    )
    assert Path(path).is_dir()
    assert op.row_diff(df, op.read_any(spark, path, df.schema)).count() == 0


def test_a_single_file_keeps_its_order(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 as kind").repartition(5).sort("kind", "id")
    path = write_dataset(
        df, str(tmp_path), "ids", "csv", single_file=True, order_by=["kind", "id"]
    )
    stored = [tuple(map(int, line.split(","))) for line in Path(path).read_text().split()[1:]]
    assert stored == [(row.id, row.kind) for row in df.collect()]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_single_file_is_sorted_in_slices(spark, tmp_path, monkeypatch, fmt):
    monkeypatch.setattr(files, "SORTED_ROWS", 100, raising=False)
    saved, save = {}, files._save

    def spy(df, path, *more):
        save(df, path, *more)
        name = path.rsplit("/", 1)[1]
        saved[name] = df._jdf.queryExecution().executedPlan().toString()
        if name == "slices":
            parts = spark.read.parquet(path).groupBy("_metadata.file_name").count()
            saved["sizes"] = [row["count"] for row in parts.collect()]

    monkeypatch.setattr(files, "_save", spy)
    # A third of the rows have one key; one key is null.
    df = spark.range(0, 2000, 1, 4).selectExpr(
        "case when id % 3 = 0 then 7 when id <> 1 then 2000 - id end as key", "id as __place"
    )
    path = write_dataset(df, str(tmp_path), "ids", fmt, single_file=True, order_by=["key"])
    assert Path(path).is_file()
    assert "Sort" not in saved["one"]
    assert sum(saved["sizes"]) == 2000 and max(saved["sizes"]) < 400
    rows = [(row.key, row["__place"]) for row in op.read_any(spark, path).collect()]
    assert [key for key, _ in rows] == sorted((key for key, _ in rows), key=lambda x: x or -1)
    assert sorted(rows, key=str) == sorted(map(tuple, df.collect()), key=str)


def test_publishing_needs_one_part(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/two")
    with pytest.raises(FileNotFoundError):
        publish_single_file(spark, f"{tmp_path}/two", f"{tmp_path}/x.parquet", "parquet")


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        write_dataset(spark.range(1), str(tmp_path), "ids", "xml")


# The full run


def test_run_writes_every_dataset_twice(spark, tmp_path):
    tables = farm_tables(spark)
    paths = run(tables, PARAMS, str(tmp_path), single_file=True)
    assert list(paths) == list(DATASETS)
    for name, dataset in DATASETS.items():
        assert paths[name] == {
            "parquet": f"{tmp_path}/etl_parquet/{dataset.file}.parquet",
            "csv": f"{tmp_path}/etl_csv/{dataset.file}.csv",
        }
        planned = build_dataset(name, tables, PARAMS)
        for path in paths[name].values():
            assert Path(path).is_file()
            assert op.row_diff(planned, op.read_any(spark, path, planned.schema)).count() == 0
    assert no_staging(tmp_path)


def test_run_of_one_dataset_in_one_format(spark, tmp_path, caplog):
    tables = farm_tables(spark, c_envs=("id farm_id", [(33, 99)]))
    paths = run(tables, PARAMS, str(tmp_path), ["csv"], ["c_env_list", "contagem_acessos"])
    assert set(paths) == {"c_env_list", "contagem_acessos"}
    assert spark.read.csv(paths["contagem_acessos"]["csv"], header=True).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["etl_csv"]
    assert "c_env_list is empty" in caplog.text


def test_run_refuses_unknown_names(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing"):
        run(farm_tables(spark), PARAMS, str(tmp_path), only=["nothing"])


def test_source_tables():
    assert source_tables(["c_env_list"]) == (["c_envs", "farms"], [])
    must, may = source_tables(DATASETS)
    assert len(must) == 19 and may == ["page_labels"]
    assert "user_activities" in source_tables(["contagem_acessos"])[0]


def test_command_line(spark, folder, tmp_path):
    main([
        "--folder", folder, "--out", str(tmp_path), "--as-of", "2025-03-10T12:00:00",
        "--page-labels", f"{folder}/page_labels.parquet", "--only", "users_active",
        "--formats", "parquet",
    ])
    stored = spark.read.parquet(f"{tmp_path}/etl_parquet/users_active.parquet")
    assert op.row_diff(
        stored, build_dataset("users_active", farm_tables(spark), PARAMS)
    ).count() == 0


# Replacing with a way back


def failing(monkeypatch, fits):
    """Let renames whose source fits fail, as a full or unreachable file system would."""
    real = paths.rename_path

    def rename(spark, source, target):
        if fits(source):
            raise OSError("no space")
        real(spark, source, target)

    for module in (paths, files):
        monkeypatch.setattr(module, "rename_path", rename)


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_move_brings_the_old_output_back(spark, tmp_path, monkeypatch, fmt, single):
    old, new = spark.range(3), spark.range(7).selectExpr("id", "'x' as more")
    path = write_dataset(old, str(tmp_path), "ids", fmt, single_file=single)
    before = sorted(p.name for p in tmp_path.iterdir())
    with monkeypatch.context() as patch:
        failing(patch, lambda source: "_staging_" in source)
        with pytest.raises(OSError, match="no space"):
            write_dataset(new, str(tmp_path), "ids", fmt, single_file=single)
    assert op.row_diff(old, op.read_any(spark, path)).count() == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == before
    write_dataset(new, str(tmp_path), "ids", fmt, single_file=single)
    assert op.row_diff(new, op.read_any(spark, path)).count() == 0


def test_a_failed_setting_aside_leaves_the_old_output(spark, tmp_path, monkeypatch):
    path = write_dataset(spark.range(3), str(tmp_path), "ids")
    failing(monkeypatch, lambda source: source.endswith("ids.parquet"))
    with pytest.raises(OSError):
        write_dataset(spark.range(7), str(tmp_path), "ids")
    assert spark.read.parquet(path).count() == 3
    assert no_staging(tmp_path)


def test_a_replacement_left_halfway_is_undone(spark, tmp_path):
    path = write_dataset(spark.range(3), str(tmp_path), "ids")
    Path(path).rename(paths.aside(path))
    paths.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    # Here the new output had taken its place.
    write_dataset(spark.range(4), str(tmp_path), "_old_ids")
    paths.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["ids.parquet"]


def test_a_folder_and_a_file_replace_each_other(spark, tmp_path):
    for single, more in ((True, "1"), (False, "'a'"), (True, "true")):
        df = spark.range(5).selectExpr("id", f"{more} as more")
        path = write_dataset(df, str(tmp_path), "ids", "csv", single_file=single)
        back = op.read_any(spark, path)
        assert back.schema["more"].dataType == df.schema["more"].dataType
        assert op.row_diff(df, back).count() == 0
    names = sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc"))
    assert names == ["_ids.csv_schema.json", "ids.csv"]


def test_texts_beside_outputs(spark, tmp_path):
    path = f"{tmp_path}/sub/x.json"
    assert paths.read_text(spark, path) is None
    for text in ("é\n" * 1000, ""):
        paths.write_text(spark, path, text)
        assert paths.read_text(spark, path) == text
    assert [p.name for p in (tmp_path / "sub").iterdir() if not p.name.endswith(".crc")] == ["x.json"]


# CSV there and back

HARD_TEXTS = [
    None, "", " ", " a ", "\t", '"', '""', 'a"b', "a,b", "\n", "a\nb", "\r", "a\r\nb\r", "\\", '\\"', "\\N",
    "null", "#x", "'", "é日\U00010000", "a\x00b", "1", "true", '"a', 'a"', '",\n"',
]


@pytest.mark.parametrize("single", [False, True])
def test_csv_reads_back_as_it_was(spark, tmp_path, single):
    rows = [(n, text, text, HARD_TEXTS[-n]) for n, text in enumerate(HARD_TEXTS)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string").selectExpr(
        "*", "if(id % 3 = 0, null, id / 7) as d", "if(id % 4 = 0, null, id > 9) as flag",
        "cast(id * 1.5 as decimal(12, 4)) as price", "date_add(date'2020-02-28', id) as day",
        "if(id = 5, null, timestamp_ntz'1900-01-01 23:59:59.000001' + make_interval(0, 0, 0, id)) as naive",
        "timestamp'2024-03-10 02:30:00.123456Z' as instant", "double('NaN') as nan", "-double('Infinity') as inf",
    )
    path = write_dataset(df, str(tmp_path), "hard", "csv", single_file=single, exact_times=True)
    back = op.read_any(spark, path)
    assert back.dtypes == df.dtypes
    assert op.row_diff(df, back).count() == 0
    assert back.count() == len(rows)


@pytest.mark.parametrize("kind", ["string", "int"])
def test_csv_of_one_column_keeps_its_nulls(spark, tmp_path, kind):
    values = [None, "", "a", None] if kind == "string" else [None, 1, None]
    df = spark.createDataFrame([(value,) for value in values], f"only {kind}")
    path = write_dataset(df, str(tmp_path), "one", "csv")
    assert op.row_diff(df, op.read_any(spark, path)).count() == 0


def test_other_csv_files_have_text_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n,\n')
    back = op.read_any(spark, f"{tmp_path}/x.csv", multi_line=True)
    assert sorted(back.collect(), key=str) == [("1", "two\nlines"), (None, None)]
    typed = op.read_any(spark, f"{tmp_path}/x.csv", StructType.fromDDL("a int, b string"), multi_line=True)
    assert typed.filter("a = 1").count() == 1


# A run that is started again


def writes(monkeypatch, fail_at=None):
    """Names and formats written by a run; the write of `fail_at` fails."""
    done = []
    real = job.write_dataset

    def write(df, folder, name, fmt="parquet", **options):
        if (name, fmt) == fail_at:
            raise OSError("lost")
        done.append((name, fmt))
        return real(df, folder, name, fmt, **options)

    monkeypatch.setattr(job, "write_dataset", write)
    return done


def test_a_run_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    tables = farm_tables(spark)
    everything = {(d.file, fmt) for d in DATASETS.values() for fmt in ("parquet", "csv")}
    with monkeypatch.context() as patch:
        first = writes(patch, fail_at=("farm_states", "csv"))
        with pytest.raises(OSError):
            run(tables, PARAMS, str(tmp_path), run_id="d1")
    with monkeypatch.context() as patch:
        second = writes(patch)
        found = run(tables, PARAMS, str(tmp_path), run_id="d1")
    assert not set(first) & set(second)
    assert set(first) | set(second) == everything
    for name, dataset in DATASETS.items():
        planned = build_dataset(name, tables, PARAMS)
        assert list(found[name]) == ["parquet", "csv"]
        for path in found[name].values():
            assert op.row_diff(planned, op.read_any(spark, path, planned.schema)).count() == 0
    with monkeypatch.context() as patch:
        third = writes(patch)
        assert run(tables, PARAMS, str(tmp_path), run_id="d1") == found
    assert third == []


def test_what_a_commit_depends_on(spark, tmp_path, monkeypatch):
    tables, only = farm_tables(spark), ["c_env_list"]
    done = writes(monkeypatch)

    def again(params=PARAMS, **options):
        done.clear()
        run(tables, params, str(tmp_path), ["parquet"], only, **options)
        return len(done)

    assert again(run_id="a") == 1
    assert again(run_id="a") == 0
    assert again(run_id="a", single_file=True) == 1
    assert again(run_id="b") == 1
    # The output is of run b now.
    assert again(run_id="a") == 1
    assert again(replace(PARAMS, shift_hours=1), run_id="a") == 1
    assert again() == 1
    # Without an id the output was replaced, and nothing is marked.
    assert again(run_id="a") == 1
    shutil.rmtree(tmp_path / "etl_parquet")
    assert again(run_id="a") == 1


def test_a_failed_write_is_not_committed(spark, tmp_path, monkeypatch):
    tables, only = farm_tables(spark), ["c_env_list"]
    run(tables, PARAMS, str(tmp_path), ["csv"], only, run_id="a")
    with monkeypatch.context() as patch:
        writes(patch, fail_at=("c_env_list", "csv"))
        with pytest.raises(OSError):
            run(tables, PARAMS, str(tmp_path), ["csv"], only, run_id="b")
    assert not list((tmp_path / "_committed").glob("*.json"))


# Views and counted tables


def test_views_of_two_uses_do_not_meet(spark):
    one, two = spark.range(1), spark.range(2)
    with named_views({"t": one}) as first, named_views({"t": two}) as second:
        assert first["t"] != second["t"]
        planned = spark.sql(f"select * from {first['t']}")
        assert spark.table(second["t"]).count() == 2
    assert planned.count() == 1
    assert not spark.catalog.tableExists(first["t"])
    assert sql_over({"a": one, "b": two}, "select count(*) n from {a} join {b} using (id)").first().n == 1


def test_views_go_after_an_error(spark):
    with pytest.raises(Exception):
        sql_over({"t": spark.range(1)}, "select nothing from {t}")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("v_")]


def test_counted_tables(spark, folder):
    counted = CountedTables(load_tables(spark, ["users", "farms"], folder=folder))
    for df in counted.tables.values():
        df.write.format("noop").mode("overwrite").save()
    rows = counted.check({"users": 3})
    assert rows["users"] == 3 and rows["farms"] > 0
    with pytest.raises(ValueError, match="users"):
        counted.check({"users": 4})
    with pytest.raises(ValueError, match="nowhere"):
        counted.check({"nowhere": 1})
    empty = CountedTables({"none": spark.range(0)})
    empty.tables["none"].collect()
    assert empty.check() == {"none": 0}
    with pytest.raises(ValueError, match="empty"):
        empty.check(strict=True)


# The shared folder


def test_a_cluster_needs_a_shared_folder(spark):
    def session(master, folder=None):
        seen = []
        context = SimpleNamespace(
            master=master, setCheckpointDir=seen.append,
            getCheckpointDir=lambda: seen[-1] if seen else None,
        )
        return SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": folder} if folder else {})

    with pytest.raises(RuntimeError):
        shared_folder(session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_folder(session("local-cluster[2,1,1024]"))
    assert shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert Path(shared_folder(session("local[4]"))).is_dir()
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert shared_folder(spark) in path
