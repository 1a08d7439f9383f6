"""Versioned folders: a writer killed at any point leaves a whole version readable."""
import os

import pytest

from tessera.session import local_path, scratch_dir
from tessera.sources import text_tables as tt
from tessera.sources import versions


class Killed(BaseException):
    """Stands for the end of the writer's process."""


def _table(spark, tag, n=50):
    return spark.range(n).selectExpr("id", f"'{tag}' as tag").repartition(3)


def _read(spark, path):
    rows = tt.read_csv(spark, path).collect()
    tags = {r["tag"] for r in rows}
    assert len(rows) == 50 and len(tags) == 1          # whole, and of one version
    return tags.pop()


def _kill(*args, **kwargs):
    raise Killed


@pytest.mark.parametrize("point", ["task", "before_commit", "commit", "after_commit", "prune_commit", "prune_data"])
def test_a_killed_writer_leaves_a_whole_version(spark, monkeypatch, point):
    path = scratch_dir(spark, "killed")
    for tag in ("one", "two"):
        tt.write_csv(_table(spark, tag), path, versioned=True)
    new = _table(spark, "three")
    with monkeypatch.context() as m:
        if point == "task":                            # a task fails after others have written their files
            new = new.selectExpr("id", "if(id = 33, raise_error('lost'), tag) as tag")
        elif point == "before_commit":
            m.setattr(versions, "commit", _kill)
        elif point == "commit":
            m.setattr(versions, "history", lambda *a: _kill())
        elif point == "after_commit":
            m.setattr(versions, "prune", _kill)
        else:
            deleted, delete = [], versions._delete

            def stop(session, target):
                if len(deleted) == (point == "prune_data"):
                    raise Killed
                deleted.append(target)
                delete(session, target)
            m.setattr(versions, "_delete", stop)
        with pytest.raises(BaseException):  # noqa: B017
            tt.write_csv(new, path, versioned=True)
    done = point in ("after_commit", "prune_commit", "prune_data")
    assert _read(spark, path) == ("three" if done else "two")
    tt.write_csv(_table(spark, "four"), path, versioned=True)   # the next writer is not held up
    assert _read(spark, path) == "four"
    versions.prune(spark, path, keep=1, abandoned_hours=0)
    assert len([n for n in os.listdir(local_path(path)) if n.startswith("v-")]) == 1
    assert _read(spark, path) == "four"


def test_rewrite_in_place_and_running_readers(spark):
    path = scratch_dir(spark, "inplace")
    tt.write_csv(_table(spark, "a"), path, versioned=True)
    before = tt.read_csv(spark, path)
    tt.write_csv(before.selectExpr("id", "concat(tag, 'b') as tag"), path, versioned=True)
    assert {r["tag"] for r in before.collect()} == {"a"}        # began before the commit
    assert _read(spark, path) == "ab"
    first, second = versions.history(spark, path)
    assert (first[0], second[0]) == (1, 2)
    old = spark.read.option("header", True).csv(versions.current(spark, path, 1))
    assert {r["tag"] for r in old.collect()} == {"a"}
    with pytest.raises(ValueError, match="no version 9"):
        versions.current(spark, path, 9)


def test_plain_folders_become_the_first_version(spark):
    path = scratch_dir(spark, "plain")
    tt.write_csv(_table(spark, "plain"), path)
    tt.write_csv(tt.read_csv(spark, path).selectExpr("id", "'x' as tag"), path, versioned=True)
    assert _read(spark, path) == "x"
    assert any(n.startswith("part-") for n in os.listdir(local_path(path)))   # the version before
    tt.write_csv(_table(spark, "y"), path, versioned=True)
    assert not any(n.startswith("part-") for n in os.listdir(local_path(path)))
    assert _read(spark, path) == "y"


def test_writers_at_the_same_moment(spark):
    path = scratch_dir(spark, "race")
    for folder, tag in (("v-a", "a"), ("v-b", "b")):
        _table(spark, tag).write.option("header", True).csv(f"{path}/{folder}")
    os.makedirs(os.path.join(local_path(path), "_versions"))
    for folder in ("v-b", "v-a"):                      # both saw no commit: both are number 1
        open(os.path.join(local_path(path), "_versions", f"0000000001.{folder}"), "w").close()
    assert _read(spark, path) == "b"
    assert versions.commit(spark, path, "v-a") == 2
    assert _read(spark, path) == "a"


@pytest.mark.parametrize("orient", ["lines", "columns"])
def test_json_versions_and_empty_tables(spark, orient):
    path = scratch_dir(spark, "jsonv")
    df = spark.range(5).selectExpr("id", "cast(null as string) as s")
    for rows in (df, df.where("id < 2")):
        tt.write_json(rows, path, orient=orient, versioned=True)
        assert tt.read_json(spark, path, orient=orient, schema=df.schema).count() == rows.count()


def test_a_file_is_no_folder_of_versions(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match="is a file"):
        tt.write_csv(spark.range(1), str(tmp_path / "x.csv"), versioned=True)
    assert tt.read_csv(spark, str(tmp_path / "x.csv")).count() == 1
