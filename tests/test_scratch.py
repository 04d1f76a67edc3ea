import os

import pytest

from orderline_kpi.sources.scratch import WorkArea, work_scope


def areas(root):
    return sorted(os.listdir(root)) if os.path.isdir(root) else []


def test_a_scope_deletes_what_was_made_inside(spark, tmp_path):
    root = str(tmp_path / "work")
    kept = WorkArea(spark, "before", root)
    before = kept.table(spark.range(3), "numbers")
    with work_scope():
        inside = WorkArea(spark, "inside", root).table(before.where("id > 0"), "numbers")
        assert inside.count() == 2 and len(areas(root)) == 2
    assert len(areas(root)) == 1 and before.count() == 3


def test_scopes_nest_and_end_with_an_error_too(spark, tmp_path):
    root = str(tmp_path / "work")
    with work_scope():
        outer = WorkArea(spark, "outer", root).table(spark.range(2), "numbers")
        with pytest.raises(ValueError):
            with work_scope():
                WorkArea(spark, "inner", root).table(spark.range(2), "numbers")
                raise ValueError
        assert [name.split("-")[0] for name in areas(root)] == ["outer"] and outer.count() == 2
    assert areas(root) == []
