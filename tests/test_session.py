"""Working folders: asked for under the shared folder, removed on release."""

import os

import pytest

from laminar import session


def test_release_removes_only_what_it_is_given(spark):
    kept, gone = (session.workspace(spark, name) for name in ("kept", "gone"))
    for path in (kept, gone):
        spark.range(3).write.parquet(path)
    assert session.workspaces()[-2:] == [kept, gone]
    session.release(spark, [gone])
    local = [p.removeprefix("file:") for p in (kept, gone)]
    assert os.path.isdir(local[0]) and not os.path.exists(local[1])
    assert gone not in session.workspaces() and spark.read.parquet(kept).count() == 3
    session.release(spark, [kept])


def test_a_session_that_is_not_local_needs_the_shared_folder():
    class Remote:                               # a Connect session has no SparkContext
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        @property
        def sparkContext(self):
            raise RuntimeError("not on Connect")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Remote())
