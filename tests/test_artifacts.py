"""Versioned artifacts: whole versions, pinned readers, dead and rival saves, pruning."""

import pytest

from cartwise.sources import artifacts
from cartwise.sources.artifacts import load_artifacts, prune_versions, read_manifest, save_artifacts, versions


def table(spark, v):
    return spark.createDataFrame([(u, float(v)) for u in range(3)], "user_id long, avg_days_since_prior double")


def marks(art):
    """The version that each part says it comes from."""
    return {r.avg_days_since_prior for r in art.interval.collect()} | {float(art.parameters["v"])}


def test_versions_are_pinned_and_inherit(spark, tmp_path):
    root = str(tmp_path / "a")
    with pytest.raises(FileNotFoundError):
        load_artifacts(spark, root)
    assert save_artifacts(root, interval=table(spark, 1), parameters={"v": 1}, feature_cols=["x", "y"]) == 1
    first = load_artifacts(spark, root, with_model=False)
    assert save_artifacts(root, interval=table(spark, 2), parameters={"v": 2}) == 2
    second = load_artifacts(spark, root, with_model=False)
    assert marks(first) == {1.0} and first.version == 1  # read after the second save
    assert marks(second) == {2.0} and second.feature_cols == ["x", "y"]  # the part not given is the one before
    assert marks(load_artifacts(spark, root, with_model=False, version=1)) == {1.0}
    save_artifacts(root, parameters={"v": 3}, inherit=False)
    assert load_artifacts(spark, root, with_model=False).interval is None
    for missing in ({"version": 9, "with_model": False}, {"with_model": True}):
        with pytest.raises(FileNotFoundError):
            load_artifacts(spark, root, **missing)


def test_a_dead_save_leaves_the_version_before_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "a")
    save_artifacts(root, interval=table(spark, 1), parameters={"v": 1}, rules=table(spark, 1))
    write, calls = artifacts.write_table, []

    def dying(df, path, *args):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("killed")
        write(df, path, *args)

    monkeypatch.setattr(artifacts, "write_table", dying)
    with pytest.raises(RuntimeError):
        save_artifacts(root, interval=table(spark, 2), parameters={"v": 2}, rules=table(spark, 2))
    monkeypatch.undo()
    assert len(calls) == 3 and versions(spark, root) == [1]
    assert marks(load_artifacts(spark, root, with_model=False)) == {1.0}
    assert save_artifacts(root, interval=table(spark, 4), parameters={"v": 4}) == 2


def test_rival_saves_get_numbers_of_their_own(spark, tmp_path):
    root = str(tmp_path / "a")
    save_artifacts(root, interval=table(spark, 1), parameters={"v": 1})
    parts = read_manifest(spark, root)[1]
    # two more savers that both saw version 1
    assert [artifacts._commit(spark, root, parts, 1), artifacts._commit(spark, root, {}, 1)] == [2, 3]
    assert versions(spark, root) == [1, 2, 3] and read_manifest(spark, root, 2)[1] == parts


def test_pruning_keeps_what_kept_versions_name(spark, tmp_path):
    root = str(tmp_path / "a")
    save_artifacts(root, interval=table(spark, 1), parameters={"v": 1})
    for v in (2, 3, 4):
        save_artifacts(root, parameters={"v": v})
    assert prune_versions(spark, root, keep=2) == [1, 2]
    assert versions(spark, root) == [3, 4]
    art = load_artifacts(spark, root, with_model=False, version=3)
    assert art.parameters == {"v": 3} and marks(art) == {1.0, 3.0}  # the table of version 1 is still named
    assert len(list((tmp_path / "a" / "parts").iterdir())) == 3
