"""Scripts of changes: whole or not at all."""

import pytest
from compare import rows

from churnlake.plans.scripts import Outcome, run_script
from churnlake.sinks import versions


@pytest.fixture
def root(spark, tmp_path):
    path = f"{tmp_path}/it's here"
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "7")], "id int, name string")
    versions.publish(spark, path, versions.stage(df, path))
    return path


def _now(spark, root):
    return rows(versions.read_current(spark, root), "id", "name")


def _folders(tmp_path):
    return len(list(tmp_path.glob("*/data-*")))


def test_steps_follow_each_other_and_are_published_once(spark, root, tmp_path):
    done = run_script(spark, root, ["SELECT id + 1 AS id, name FROM {rows}", "SELECT * FROM {rows} WHERE id < 4"], {"not empty": "SELECT COUNT(*) = 3 FROM {rows}"})
    assert done == Outcome("published", "publishing")
    assert _now(spark, root) == [(2, "a"), (3, None), (3, None)] and versions._current(spark, root)[0] == 2
    assert run_script(spark, root, []).state == "published"
    assert _now(spark, root) == [(2, "a"), (3, None), (3, None)] and versions._current(spark, root)[0] == 3


def test_a_failing_step_leaves_the_old_version(spark, root, tmp_path):
    before, folders, tables = _now(spark, root), _folders(tmp_path), len(spark.catalog.listTables())
    done = run_script(spark, root, ["SELECT id, name FROM {rows} WHERE id > 0", "SELECT CAST(name AS INT) AS id, name FROM {rows}"])
    assert done == Outcome("rolled back", "writing")
    assert _now(spark, root) == before and versions._current(spark, root)[0] == 1
    assert _folders(tmp_path) == folders and len(spark.catalog.listTables()) == tables


@pytest.mark.parametrize("check", ["SELECT COUNT(*) > 9 FROM {rows}", "SELECT CAST(NULL AS BOOLEAN)", "SELECT 1 / 0 > 1"])
def test_a_failing_check_leaves_the_old_version(spark, root, tmp_path, check):
    before, folders = _now(spark, root), _folders(tmp_path)
    done = run_script(spark, root, ["SELECT id, 'x' AS name FROM {rows}"], {"fine": "SELECT TRUE", "it's enough": check})
    assert done == Outcome("rolled back", "it's enough")
    assert _now(spark, root) == before and _folders(tmp_path) == folders


def test_an_empty_result_is_published(spark, root):
    assert run_script(spark, root, ["SELECT * FROM {rows} WHERE FALSE"]).state == "published"
    assert _now(spark, root) == []


def test_a_step_that_is_no_sql_is_raised(spark, root):
    before = _now(spark, root)
    with pytest.raises(Exception):
        run_script(spark, root, ["SELEC * FROM {rows}"])
    assert _now(spark, root) == before


def test_without_a_version_there_is_nothing_to_change(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_script(spark, str(tmp_path / "none"), [])
