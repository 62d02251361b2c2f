import pytest

from vetmill.sources import partitioned

TABLE = "id long, day string, status string, note string"
CHANGES = "id long, day string, status string, changed_at int"
ROWS = [(i, f"2024-01-0{i % 5 + 1}" if i % 7 else None, "booked", f"n{i}") for i in range(40)]
#: Two days' rows change, one of them twice; all rows without a day go to a new day; one key is new, one has no value.
NEW = [(1, None, "old", 1), (1, None, "new", 2), (2, None, None, 1), *[(i, "2025 a/b", None, 1) for i in range(0, 40, 7)], (99, "2024-01-02", "added", 1), (None, "2024-01-05", "x", 1)]


def files(path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in path.glob("day=*")}


def expected(insert):
    rows = {r[0]: list(r) for r in ROWS}
    rows[1][2] = "new"
    for i in range(0, 40, 7):
        rows[i][1] = "2025 a/b"
    return sorted(map(repr, [tuple(r) for r in rows.values()] + [(99, "2024-01-02", "added", None)] * insert))


def table(spark, path):
    partitioned.write(spark.createDataFrame(ROWS, TABLE), str(path), "day")
    return spark.createDataFrame(NEW, CHANGES)


def rows(spark, path):
    return sorted(repr(tuple(r)) for r in partitioned.read(spark, str(path), TABLE).select("id", "day", "status", "note").collect())


@pytest.mark.parametrize("insert", [False, True])
def test_only_touched_partitions_are_rewritten(spark, tmp_path, insert):
    path = tmp_path / "t"
    changes, before = table(spark, path), files(path)
    assert partitioned.merge(changes, str(path), TABLE, "id", "day", "m", insert=insert)
    after = files(path)
    assert rows(spark, path) == expected(insert)
    assert set(before) - set(after) == {"day=__HIVE_DEFAULT_PARTITION__"} and len(set(after) - set(before)) == 1
    assert {d for d in before if before[d] == after.get(d)} == {"day=2024-01-01", "day=2024-01-04", "day=2024-01-05"}
    assert not partitioned.merge(changes, str(path), TABLE, "id", "day", "m", insert=insert) and files(path) == after
    assert partitioned.merge(changes.limit(0), str(path), TABLE, "id", "day", "none") and files(path) == after


@pytest.mark.parametrize("step", ["write", "_note", "_overwrite", "_rename", "_delete"])
def test_a_merge_that_died_is_finished(spark, tmp_path, monkeypatch, step):
    path = tmp_path / "t"
    changes = table(spark, path)
    for late in (False, True):  # before and after the step has done its work
        own = getattr(partitioned, step)

        def fail(*args, own=own, late=late):
            if late:
                own(*args)
            raise OSError("lost")

        monkeypatch.setattr(partitioned, step, fail)
        try:
            partitioned.merge(changes, str(path), TABLE, "id", "day", "m", insert=True)
        except OSError:
            pass
        monkeypatch.undo()
    partitioned.merge(changes, str(path), TABLE, "id", "day", "m", insert=True)
    assert rows(spark, path) == expected(True)
    assert not partitioned.merge(changes, str(path), TABLE, "id", "day", "m", insert=True)
