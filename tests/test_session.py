"""Scratch data lives under the session's checkpoint folder."""

from __future__ import annotations

from sluice.session import checkpoint_root, cluster_conf, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/sluice/x-") and a != b


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(shuffle_bytes=10 * 2**40)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(conf["spark.sql.shuffle.partitions"]) == 20480
    assert int(cluster_conf(shuffle_bytes=1)["spark.sql.shuffle.partitions"]) == 200


def test_ship_package_once_with_all_modules(spark):
    import os
    import zipfile

    from sluice import session as S
    S._SHIPPED.discard(spark.sparkContext.applicationId)
    S.ship_package(spark)
    S.ship_package(spark)  # second call is a no-op
    assert spark.sparkContext.applicationId in S._SHIPPED
    pkg = os.path.dirname(os.path.abspath(S.__file__))
    wanted = {os.path.relpath(os.path.join(r, f), os.path.dirname(pkg))
              for r, _, fs in os.walk(pkg) for f in fs if f.endswith(".py")}
    root = checkpoint_root(spark).replace("file:", "")
    found = [os.path.join(r, f) for r, _, fs in os.walk(root) for f in fs if f == "sluice.zip"]
    assert found and wanted <= set(zipfile.ZipFile(found[-1]).namelist())
