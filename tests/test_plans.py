"""What reaches the scans, and what does not shuffle."""

from types import SimpleNamespace

import pytest

from wagegrid import settings
from wagegrid.operators import cleaning, features, grid, positions, stats
from wagegrid.plans import standins
from wagegrid.sources import readers, writers


def _plan(df):
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan =="):]


def _scan(df):
    return [line for line in _plan(df).splitlines() if "ReadSchema" in line]


def test_projection_is_pruned(spark, sf):
    df = readers.read_projected(spark, f"{sf}/orders.parquet", {"o_orderkey": "job_id"})
    assert "ReadSchema: struct<o_orderkey:bigint>" in _scan(df)[0]


def test_range_is_pushed(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    df = readers.read_date_range(events, "ts", "2024-01-10", "2024-01-20").select("event_id")
    assert "GreaterThanOrEqual(ts" in _scan(df)[0] and "LessThanOrEqual(ts" in _scan(df)[0]


def test_day_is_pruned(spark, sf, tmp_path):
    path = str(tmp_path / "days")
    events = spark.read.parquet(f"{sf}/events.parquet")
    writers.append_search_day(events, path, "ts")
    writers.append_search_day(events, path, "ts")
    df = readers.read_day(spark, path, "2024-01-15")
    assert "PartitionFilters: [isnotnull(search_date" in _scan(df)[0]
    once = events.where("cast(ts as date) = date'2024-01-15'").count()
    assert df.count() == 2 * once > 0


@pytest.mark.parametrize("step", [
    lambda df: cleaning.annual_only(cleaning.drop_sentinel(df)),
    lambda df: features.title_flags(df),
    lambda df: features.one_hot(df, "Title", ["1-URGENT", "2-HIGH"]),
])
def test_row_steps_do_not_shuffle(spark, sf, step):
    assert "Exchange" not in _plan(step(standins.listings(spark, sf)))


def test_search_grid_is_no_join(spark, sf):
    parsed = grid.parse_search_request(standins.requests(spark, sf), "request")
    plan = _plan(grid.search_grid(parsed))
    assert "Join" not in plan and "Cartesian" not in plan and "Exchange" not in plan


def test_counts_are_combined_before_the_shuffle(spark, sf):
    plan = _plan(stats.value_counts(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderstatus"))
    assert "partial_count" in plan


def test_slices_are_joined_by_broadcast(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    plan = _plan(positions.row_numbers(orders, "o_orderkey", rows_per_slice=300))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_broadcast_is_checked(spark):
    assert "broadcast" in settings.small_side(spark.range(5), 5)._jdf.queryExecution().toString()
    assert "broadcast" not in settings.small_side(spark.range(6), 5)._jdf.queryExecution().toString()


class _Session:
    """As much of a session as the folder choice looks at."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default: folder or default)


def test_shared_folder_comes_from_the_session(spark):
    assert settings.new_folder(_Session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        settings.shared_folder(_Session("yarn"))
    local = settings.shared_folder(_Session("local[2]"))
    assert local == settings.shared_folder(_Session("local[2]"))
    given = spark.conf.get("spark.checkpoint.dir", None)
    assert given is None or settings.shared_folder(spark) == given
