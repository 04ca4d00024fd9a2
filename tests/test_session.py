from __future__ import annotations

from lakeweir import session


def test_shared_settings_apply(spark):
    for name, value in session.SETTINGS.items():
        assert spark.conf.get(name) == value


def test_building_again_takes_overrides(spark):
    again = session.build("again", spark__sql__files__maxPartitionBytes="64MB")
    assert again.conf.get("spark.sql.files.maxPartitionBytes") == "64MB"
    again.conf.unset("spark.sql.files.maxPartitionBytes")
