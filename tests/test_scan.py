"""Bucketed scans with many small buckets and a hot key, against brute force.

These tests force hundreds of buckets and a key holding a
third of all rows, and compare with plain SQL window functions in DuckDB over
the whole sf0.01 events table.
"""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators import counting, rolling, scan, windows
from eventide.plans.verify import duck, value_hash
from tests.conftest import SF001

HOT = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.fixture(scope="module")
def ev(spark):
    # key: a third of all rows on key -1 (the hot key), the rest by user
    return spark.read.parquet(f"{SF001}/events.parquet").select(
        F.col("event_id").alias("seq"), F.col("ts").alias("event_time"), "event_type",
        F.expr(HOT).alias("k"))


def _same(spark_df, con, sql):
    a = spark_df.toPandas()
    b = con.execute(sql).df()
    assert len(a) == len(b)
    assert sorted(a.columns) == sorted(b.columns)
    assert value_hash(a) == value_hash(b)


@pytest.mark.parametrize("width", [37, 1000])
def test_running_sums_hot_key(ev, con, width):
    out = scan.running_sums(ev, "seq", {"n": F.lit(1).cast("long"),
                                        "m": F.when(F.col("event_type") == "signup", 1).otherwise(0).cast("long")},
                            keys=["k"], width=width).select("seq", "k", "n", "m")
    _same(out, con, f"""
        SELECT event_id AS seq, {HOT} AS k,
               count(*) OVER (PARTITION BY {HOT} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n,
               CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY {HOT} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS m
        FROM events""")


def test_running_sums_global(ev, con):
    out = scan.running_sums(ev, "seq", {"n": F.lit(1).cast("long")},
                            width=101).select("seq", "n")
    _same(out, con, "SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) AS n FROM events")


def test_last_n_hot_key_sparse_buckets(ev, con):
    # width 7: nearly every key is split, with halos of most of a bucket
    out = rolling.last_n_by_key(ev, "seq", ["k"], 5, "seq", "last5",
                                width=7).select("seq", "k", "last5")
    _same(out, con, f"""
        SELECT event_id AS seq, {HOT} AS k,
               array_to_string(list(event_id) OVER (PARTITION BY {HOT} ORDER BY event_id
                               ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS last5
        FROM events""")


def test_last_n_per_type_small_buckets(ev, con):
    out = rolling.last_n_per_type(ev, "seq", ["k"], "event_type",
                                  {"purchase": "a", "click": "r"}, 3, "seq",
                                  width=53).select("seq", "k", "a", "r")
    l3 = (f"array_to_string(list(event_id) OVER (PARTITION BY {HOT}, event_type ORDER BY event_id "
          "ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), ',')")
    _same(out, con, f"""
        WITH x AS (SELECT event_id, {HOT} AS k, event_type, {l3} AS l FROM events)
        SELECT event_id AS seq, k,
               last_value(CASE WHEN event_type = 'purchase' THEN l END IGNORE NULLS)
                   OVER (PARTITION BY k ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS a,
               last_value(CASE WHEN event_type = 'click' THEN l END IGNORE NULLS)
                   OVER (PARTITION BY k ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS r
        FROM x""")


def test_forward_fill_small_buckets(ev, con):
    out = scan.forward_fill(ev, "seq", {"last_signup": F.when(F.col("event_type") == "signup", F.col("seq"))},
                            keys=["k"], width=11).select("seq", "k", "last_signup")
    _same(out, con, f"""
        SELECT event_id AS seq, {HOT} AS k,
               last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
                   OVER (PARTITION BY {HOT} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_signup
        FROM events""")


def test_running_max_struct(ev, con):
    # running arg-max of a pseudo score, first max wins (struct of score, -seq)
    score = F.col("seq") % 97
    out = scan.running_max(ev, "seq", "b", F.struct(score.alias("s"), (-F.col("seq")).alias("o")),
                           keys=["k"], width=29)
    out = out.select("seq", "k", F.col("b.s").alias("best"), (-F.col("b.o")).alias("at"))
    _same(out, con, f"""
        WITH x AS (SELECT event_id, {HOT} AS k, event_id % 97 AS s FROM events),
             y AS (SELECT *, max(s) OVER (PARTITION BY k ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best
                   FROM x)
        SELECT event_id AS seq, k, best,
               min(CASE WHEN s = best THEN event_id END)
                   OVER (PARTITION BY k, best ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS at
        FROM y""")


@pytest.mark.parametrize("width", [3, 200])
def test_sessions_hot_key(ev, con, width):
    out = windows.sessions(ev, "event_time", "30 minutes", {"n": windows.count_measure()}, keys=["k"],
                           width=width)
    _same(out, con, f"""
        WITH o AS (SELECT {HOT} AS k, ts, event_id,
                          lag(ts) OVER (PARTITION BY {HOT} ORDER BY ts, event_id) AS p FROM events),
             s AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > 1800000000 THEN 1 ELSE 0 END)
                             OVER (PARTITION BY k ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM o)
        SELECT k, min(ts) AS window_start, max(ts) + INTERVAL '30 minutes' AS window_end, count(*) AS n
        FROM s GROUP BY k, sid""")


def test_count_trigger_small_buckets(ev, con):
    out = counting.count_trigger(ev, "seq", 7, {"m": windows.count_measure(F.col("event_type") == "view")},
                                 keys=["k"], width=13)
    _same(out, con, f"""
        WITH r AS (SELECT {HOT} AS k,
                          row_number() OVER (PARTITION BY {HOT} ORDER BY event_id) AS pos,
                          sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)
                              OVER (PARTITION BY {HOT} ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS m
                   FROM events)
        SELECT k, CAST(pos // 7 AS BIGINT) AS fire, CAST(pos AS BIGINT) AS n_seen, CAST(m AS BIGINT) AS m
        FROM r WHERE pos % 7 = 0""")


def test_history_pages_small(ev, con):
    out = rolling.history_pages(ev, "seq", ["k"], "seq", page_size=50, width=97)
    _same(out, con, f"""
        SELECT k, CAST((rn - 1) // 50 AS BIGINT) AS page, min(event_id) AS first_seq,
               max(event_id) AS last_seq, count(*) AS n_events,
               string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS history
        FROM (SELECT {HOT} AS k, event_id, row_number() OVER (PARTITION BY {HOT} ORDER BY event_id) AS rn
              FROM events)
        GROUP BY k, (rn - 1) // 50""")


@pytest.mark.parametrize("keys", [[], ["k"], ["g"]])
def test_bounds_do_not_grow_with_the_table(spark, monkeypatch, keys):
    """A small width is widened on a long table; the results stay the same."""
    monkeypatch.setattr(scan, "MAX_BUCKETS", 50)
    df = spark.range(6000).selectExpr("id as seq", "IF(id % 3 = 0, 0, id % 40) as k", "id % 500 as g", "id % 7 as v")
    found, made = [], scan.bounds

    def bounds(*args):
        found.append(made(*args))
        return found[-1]

    monkeypatch.setattr(scan, "bounds", bounds)
    got = scan.running_sums(df, "seq", {"n": F.lit(1), "t": F.col("v")}, keys, width=2)
    last = scan.last_n(df, "seq", 3, F.col("v"), "l", keys=keys, width=2)
    for rows in found:
        assert sum(len(r["_bounds"]) for r in rows) <= 60
    w = Window.partitionBy(*keys).orderBy("seq")
    want = df.select("seq", F.count("*").over(w).alias("n"), F.sum("v").over(w).alias("t"),
                     F.collect_list("v").over(w.rowsBetween(-2, 0)).alias("l"))
    assert sorted(got.select("seq", "n", "t").collect()) == sorted(want.select("seq", "n", "t").collect())
    assert sorted(last.select("seq", "l").collect()) == sorted(want.select("seq", "l").collect())


@pytest.mark.parametrize("width", [3, 8, 1 << 20])
def test_last_n_of_types_with_nulls_and_rare_types(spark, width):
    """Types that many buckets lack, null keys, types and values, against a Python loop."""
    rows = [(i, None if i % 4 == 0 else i % 3, "rare" if i in (2, 5, 33) else None if i % 11 == 0 else "abc"[i % 3],
             None if i % 5 == 0 else f"v{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "seq long, k long, t string, v string").repartition(3)
    types = {"a": "la", "rare": "lr", "never": "ln"}
    for keys in (["k"], []):
        got = scan.last_n_of_types(df, "seq", 4, F.col("v"), "t", types, keys, width)
        assert got.columns == [*df.columns, *types.values()]
        want = []
        for s, k, _, _ in rows:
            so_far = [r for r in rows if r[0] <= s and (not keys or r[1] == k)]
            want.append((s, *[[r[3] for r in so_far if r[2] == t][-4:] or None for t in types]))
        assert sorted(map(tuple, got.select("seq", *types.values()).collect())) == want


def test_an_empty_keyless_table_has_no_bounds(spark):
    assert scan.running_sums(spark.range(0).withColumnRenamed("id", "seq"), "seq", {"n": F.lit(1)}).count() == 0
    df = spark.range(3).withColumnRenamed("id", "seq")
    assert sorted(r["n"] for r in scan.running_sums(df, "seq", {"n": F.lit(1)}).collect()) == [1, 2, 3]
