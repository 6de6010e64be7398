"""Random inputs against plain Python."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillhouse.operators import history
from tillhouse.operators.skew import split_hot_join

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
START = datetime(2026, 1, 1)

load = st.dictionaries(st.integers(1, 5), st.integers(0, 6), max_size=5)


def brute_force(loads):
    """Open and closed versions per key as (key, from, to)."""
    open_since, closed = {}, []
    for rows in loads:
        for key, day in rows.items():
            if key not in open_since:
                open_since[key] = day
            elif day > open_since[key]:
                closed.append((key, open_since[key], day))
                open_since[key] = day
    return sorted(closed + [(key, day, None) for key, day in open_since.items()], key=str)


@FEW
@given(st.lists(load, min_size=1, max_size=3))
def test_history_of_random_loads(spark, loads):
    stored = None
    for rows in loads:
        master = spark.createDataFrame(
            [(key, START + timedelta(days=day)) for key, day in rows.items()], "menu_id int, updated_at timestamp"
        )
        stored = history.first_load(master, "menu_id") if stored is None else history.merge(stored, master, "menu_id")
    found = [
        (int(row.menu_id), (row.valid_from - START).days, row.valid_to and (row.valid_to - START).days)
        for row in stored.collect()
    ]
    assert sorted(found, key=str) == brute_force(loads)


keys = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=60)


@FEW
@given(keys, keys, st.integers(1, 20), st.sampled_from(["left", "inner"]))
def test_split_join_of_random_keys(spark, left_keys, right_keys, rows_per_split, how):
    left = spark.createDataFrame(list(enumerate(left_keys)), "a int, k int")
    right = spark.createDataFrame([(key, n) for n, key in enumerate(right_keys)], "k int, b int")
    found = split_hot_join(left, right, ["k"], how, rows_per_split).select("a", "k", "b")
    expected = []
    for a, key in enumerate(left_keys):
        matches = [b for b, other in enumerate(right_keys) if key is not None and other == key]
        expected += [(a, key, b) for b in matches]
        if not matches and how == "left":
            expected.append((a, key, None))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=40))
def test_unique_of_random_values(spark, numbers):
    from tillhouse.operators.checks import unique

    found = unique(spark.createDataFrame([(n,) for n in numbers], "n int"), "n").select("n", F.col("n_records"))
    expected = [(n, numbers.count(n)) for n in set(numbers) if n is not None and numbers.count(n) > 1]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
