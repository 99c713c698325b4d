"""Session helpers in a session that did not pin the zone itself (as the
driver's may not)."""

import __spark_entry__ as entry


def test_entry_runs_when_zone_was_never_set(spark):
    from clickguard.session import ensure_utc

    spark.conf.unset("spark.sql.session.timeZone")
    try:
        ensure_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        spark.conf.unset("spark.sql.session.timeZone")
        df = entry.entry(spark)
        assert df.columns == ["ip", "lastEvent", "reason"] and df.count() == 58
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_shuffle_partitions_for():
    from clickguard.session import shuffle_partitions_for

    assert shuffle_partitions_for(0, cores=8) == 16
    assert shuffle_partitions_for(10 << 40, cores=8) == 40960       # 10 TiB / 256 MiB
    assert shuffle_partitions_for(1 << 60, cores=8) == 1 << 32
