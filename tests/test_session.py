import os
from types import SimpleNamespace

import pytest

from cartwise import session


def test_cluster_without_a_shared_folder_is_an_error():
    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        fake = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master), conf=conf)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake)


def test_intermediates_are_removed(spark):
    with session.intermediates(spark):
        a = session.cut_lineage(spark.range(5))
        b = session.cut_lineage(a)
        paths = [x._cartwise_path.removeprefix("file:") for x in (a, b)]
        assert b.count() == 5 and all(map(os.path.isdir, paths))
        session.discard(a)
        assert not os.path.exists(paths[0])
    assert not os.path.exists(paths[1])
