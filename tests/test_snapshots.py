"""Snapshots: one rename commits a version, writers at once never mix, the manifest stays small."""

import datetime as dt
import threading

import pytest

from fetchplan.sources import sinks

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def values(df):
    return sorted(r[0] for r in df.collect())


def test_writers_at_once_never_mix_a_version(spark, tmp_path):
    """Four writers miss together at one instant; all get one writer's rows, whole, and so does every later reader."""
    path, gate, got = str(tmp_path / "snap"), threading.Barrier(4), {}

    def writer(k):
        def build():
            gate.wait(60)  # all have missed
            return spark.range(100 * k, 100 * k + 50, numPartitions=3)

        df, hit = sinks.snapshot(spark, build, path, 300, T0)
        got[k] = (values(df), hit)

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    whole = [list(range(100 * k, 100 * k + 50)) for k in range(4)]
    assert len(got) == 4 and all(rows in whole and not hit for rows, hit in got.values())
    later = [sinks.snapshot(spark, lambda: spark.range(0), path, 300, at(k)) for k in (1, 2)]
    assert all(hit for _, hit in later) and values(later[0][0]) == values(later[1][0]) in whole


def test_a_version_is_current_only_once_it_is_whole(spark, tmp_path):
    """A build that fails, or is seen half-way, leaves the current version as it is."""
    path = str(tmp_path / "snap")
    sinks.snapshot(spark, lambda: spark.range(3), path, 10, T0)

    def failing():
        assert values(sinks.snapshot(spark, lambda: None, path, 100, at(20))[0]) == [0, 1, 2]
        return spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('no') ELSE id END AS id")

    with pytest.raises(Exception, match="no"):
        sinks.snapshot(spark, failing, path, 10, at(20))
    df, hit = sinks.snapshot(spark, lambda: None, path, 100, at(21))
    assert hit and values(df) == [0, 1, 2]


def test_an_expiry_during_a_build_wins(spark, tmp_path):
    path = str(tmp_path / "snap")
    sinks.snapshot(spark, lambda: spark.range(1), path, 10, T0)

    def build():
        sinks.expire_snapshot(spark, path, at(20))
        return spark.range(2)

    df, hit = sinks.snapshot(spark, build, path, 10, at(20))
    assert not hit and values(df) == [0, 1]  # its caller still gets what it computed
    df, hit = sinks.snapshot(spark, lambda: spark.range(3), path, 300, at(21))
    assert not hit and values(df) == [0, 1, 2]


def test_manifest_and_versions_do_not_grow(spark, tmp_path):
    path = tmp_path / "snap"
    first, _ = sinks.snapshot(spark, lambda: spark.range(1), str(path), 1, T0)
    for k in range(1, 25):
        df, hit = sinks.snapshot(spark, lambda k=k: spark.range(k), str(path), 1, at(10 * k), retention_seconds=0 if k > 20 else 86_400)
        assert not hit and df.count() == k
        if k == 20:  # within the retention replaced versions are still read
            assert values(first) == [0] and len(list(path.glob("v-*"))) == 21
    assert len(list(path.glob("v-*"))) == 1
    assert len(list((path / "_manifest").glob("part-*"))) <= sinks.KEPT_ENTRIES + 1
    df, hit = sinks.snapshot(spark, lambda: None, str(path), 100, at(241))
    assert hit and df.count() == 24


def test_left_over_versions_are_removed(spark, tmp_path):
    """A writer that died left a version that no entry names."""
    path = tmp_path / "snap"
    spark.range(9).write.parquet(str(path / "v-20230101T000000000000-dead"))
    sinks.snapshot(spark, lambda: spark.range(2), str(path), 1, T0)
    assert len(list(path.glob("v-*"))) == 2  # written just now: perhaps it is still being written
    sinks.snapshot(spark, lambda: spark.range(3), str(path), 1, at(5), retention_seconds=0)
    assert len(list(path.glob("v-*"))) == 1


def test_expiring_nothing(spark, tmp_path):
    sinks.expire_snapshot(spark, str(tmp_path / "none"), T0)
    assert not (tmp_path / "none").exists()
