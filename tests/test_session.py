import threading

import pytest

from rawmart import session


def test_an_unset_checkpoint_folder_raises_off_local_masters():
    class Conf:
        def get(self, key, default=None):
            return default

    class Spark:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"):
        Spark.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(Spark)


def test_scopes_of_threads_keep_apart(spark):
    import os

    kept, release = [], threading.Event()

    def other():
        with session.scratch_scope(spark):
            df = session.materialize(spark.range(3), "scope_test")
            kept.append(df.inputFiles()[0].removeprefix("file:"))
            release.wait(60)

    thread = threading.Thread(target=other)
    thread.start()
    with session.scratch_scope(spark):
        own = session.materialize(spark.range(3), "scope_test").inputFiles()[0].removeprefix("file:")
        while not kept:
            pass
    assert not os.path.exists(own) and os.path.exists(kept[0])
    release.set()
    thread.join()
    assert not os.path.exists(kept[0])


def test_a_scope_cleans_up_after_a_failure(spark):
    import os

    with pytest.raises(RuntimeError), session.scratch_scope(spark):
        path = session.materialize(spark.range(3), "scope_test").inputFiles()[0].removeprefix("file:")
        raise RuntimeError
    assert not os.path.exists(path)
