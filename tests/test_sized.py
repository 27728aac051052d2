"""Tasks that stay as large as they are when the input grows: the registered queries have partitions by their input."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from wayfarer import session
from wayfarer.sources.testdata import raw_bytes

PARTITIONS, READ, SHUFFLED = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_partitions_grow_with_the_input(spark):
    before = dict(spark.conf.getAll)
    per = session.BYTES_PER_PARTITION
    assert session.sized_session(spark, 10).conf.get(PARTITIONS) == "4"
    assert [int(session.sized_session(spark, n * per).conf.get(PARTITIONS)) for n in (100, 1000)] == [100, 1000]
    sized = session.sized_session(spark, 1)
    assert sized.conf.get(READ) == str(16 << 20) and sized.conf.get(SHUFFLED) == str(8 << 20)
    assert dict(spark.conf.getAll) == before


def test_settings_of_the_caller_hold(spark):
    name, also = "spark.sql.adaptive.skewJoin.skewedPartitionFactor", SHUFFLED
    try:
        spark.conf.set(name, "7")
        spark.conf.set(also, "64k")
        sized = session.sized_session(spark, 1)
        assert sized.conf.get(name) == "7" and sized.conf.get(also) == "64k"
        assert sized.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.unset(name)
        spark.conf.unset(also)


@pytest.mark.parametrize("name", ["user_month", "city_quarter", "user_portrait", "favorite_city"])
def test_queries_have_partitions_for_their_input(spark, monkeypatch, name):
    stored = raw_bytes(spark, SF_SMALL)
    assert stored > 100_000 and raw_bytes(spark, "/root/testdata/none") == 0
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", stored // 37 + 1)
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert set(re.findall(r"hashpartitioning\(.*, (\d+)\)", p)) == {"37"}


def under_the_first_shuffle(p: str, columns: str) -> list[str]:
    """The operators between the scan that reads ``columns`` and the shuffle over it, in the text of a plan."""
    lines = p.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and columns in line)
    depth, found = re.search(r"\w", lines[at]).start(), []
    for line in reversed(lines[:at]):
        start = re.search(r"\w", line).start()
        if start < depth:
            depth = start
            if "Exchange" in line:
                return found
            found.append(line.strip())
    raise AssertionError("no shuffle over the scan")


@pytest.mark.parametrize("name", ["user_status", "favorite_category", "favorite_partner", "user_level", "city_growth_strict", "city_quarter",
                                  "region_quarter", "rising_flag"])
def test_nothing_is_collected_or_sorted_by_row_group(spark, name):
    """A task reads whole row groups, whatever the partitions: it must not hold their rows in memory."""
    p = plan(E.queries()[name](spark, SF_SMALL))
    for columns in ("[l_orderkey#", "[p_partkey#"):
        below = under_the_first_shuffle(p, columns)
        assert not [op for op in below if re.search("Aggregate|Sort|Window", op)], below


def test_rows_do_not_depend_on_row_groups(spark, tmp_path):
    for name in ("part", "orders", "lineitem"):
        rows_in = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        rows_in.coalesce(1).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/small/{name}.parquet")
        rows_in.coalesce(1).write.parquet(f"{tmp_path}/whole/{name}.parquet")
    for name in ("city_quarter", "user_level"):
        want = rows(E.queries()[name](spark, SF_SMALL))
        assert want and all(rows(E.queries()[name](spark, f"{tmp_path}/{n}")) == want for n in ("small", "whole"))
