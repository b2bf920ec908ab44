"""Per-event watermarks, accumulators and whole-window functions against Python loops."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventide.operators import watermarks, window_functions, windows

START = dt.datetime(2024, 1, 1)


def _at(seconds):
    return START + dt.timedelta(seconds=seconds)


def _events(spark, n=400, seed=1, hot=0):
    rnd = random.Random(seed)
    rows = [(i, _at(i + rnd.randint(-40, 40) + rnd.choice([0, 0, 0, 0.0005])), rnd.choice("abc"), None if i % 9 == 0 else rnd.randrange(5)) for i in range(n)]
    rows += [(n + i, _at(5), "h", i % 3) for i in range(hot)]
    return rows, spark.createDataFrame(rows, "seq long, t timestamp_ntz, kind string, v long").repartition(5)


def _windows(t, size, slide):
    s = (t - dt.datetime(1970, 1, 1)).total_seconds()
    first = s // slide * slide
    return [dt.datetime(1970, 1, 1) + dt.timedelta(seconds=first - k * slide) for k in range(size // slide)]


def brute(rows, size, slide, emitted):
    """(seq, window start, late) with the watermark of the events before."""
    mark, out = None, []
    for r in sorted(rows):
        for w in _windows(r[1], size, slide):
            last = w + dt.timedelta(seconds=size) - dt.timedelta(milliseconds=1)
            out.append((r[0], w, mark is not None and mark >= last))
        e = emitted(r)
        if e is not None and (mark is None or e > mark):
            mark = e
    return out


@pytest.mark.parametrize(("size", "slide"), [(20, 20), (30, 10)])
@pytest.mark.parametrize("kind", ["bounded", "source", "custom"])
def test_lateness_against_a_loop(spark, size, slide, kind):
    rows, df = _events(spark)
    delay = {"bounded": "7 seconds", "source": "0 seconds"}.get(kind)
    column = watermarks.bounded("t", delay) if delay else F.when(F.col("kind") == "b", F.col("t"))
    back = dt.timedelta(seconds=7 if kind == "bounded" else 0)
    expected = brute(rows, size, slide, (lambda r: r[1] - back) if delay else lambda r: r[1] if r[2] == "b" else None)
    own = {"slide": f"{slide} seconds"} if slide != size else {}
    got = watermarks.judged(df, "t", "seq", f"{size} seconds", column, width=37, **own)
    assert sorted(map(tuple, got.select("seq", windows.START, "late").collect())) == sorted(expected)
    late = watermarks.late_rows(df, "t", "seq", f"{size} seconds", column, width=37, **own)
    assert late.count() == sum(x[2] for x in expected) > 0
    sums = watermarks.on_time_sums(df, "t", "seq", f"{size} seconds", {"n": windows.count_measure()}, column, width=37, **own)
    on_time, dropped = Counter(w for _, w, x in expected if not x), Counter(w for _, w, x in expected if x)
    assert sorted((r[windows.START], r["n"], r["n_late"]) for r in sums.collect()) == sorted((w, n, dropped[w]) for w, n in on_time.items())


def test_the_own_watermark_does_not_make_an_event_late(spark):
    df = spark.createDataFrame([(1, _at(9.999)), (2, _at(9.0)), (3, _at(10.5)), (4, _at(9.9995))], "seq long, t timestamp_ntz")
    got = watermarks.judged(df, "t", "seq", "10 seconds", watermarks.bounded("t", "0 seconds"))
    assert sorted((r["seq"], r["late"]) for r in got.collect()) == [(1, False), (2, True), (3, False), (4, True)]
    assert watermarks.judged(df.limit(0), "t", "seq", "10 seconds", watermarks.bounded("t", "0 seconds")).count() == 0


class Distinct:
    """The distinct values (nulls too) and the number of rows: a set that merges."""

    def create(self):
        return set(), 0

    def add(self, acc, rows):
        assert rows.schema.names == ["v"]
        return acc[0] | set(rows.column("v").to_pylist()), acc[1] + rows.num_rows

    def merge(self, a, b):
        return a[0] | b[0], a[1] + b[1]

    def result(self, acc):
        return {"values": sorted(x for x in acc[0] if x is not None), "n": acc[1], "has_null": None in acc[0]}


@pytest.mark.parametrize("open_", [3, 20_000])
@pytest.mark.parametrize(("size", "slide", "keys"), [(20, None, []), (30, 10, ["kind"])])
def test_accumulators_against_a_loop(spark, monkeypatch, open_, size, slide, keys):
    monkeypatch.setattr(window_functions, "OPEN", open_)
    monkeypatch.setattr(window_functions, "FAN", 2)
    rows, df = _events(spark, hot=300)
    rows.append((9999, _at(3), None, 1))  # a null key
    df = df.unionByName(spark.createDataFrame(rows[-1:], df.schema))
    got = window_functions.aggregate_windows(df, "t", f"{size} seconds", Distinct(), {"v": F.col("v")}, "values array<long>, n long, has_null boolean",
                                             slide=f"{slide} seconds" if slide else None, keys=keys)
    assert got.columns == [windows.START, windows.END, *keys, "values", "n", "has_null"]
    want = {}
    for r in rows:
        for w in _windows(r[1], size, slide or size):
            want.setdefault((w, *([r[2]] if keys else [])), []).append(r[3])
    expected = [(*k, sorted({x for x in v if x is not None}), len(v), None in v) for k, v in want.items()]
    assert sorted(map(str, [(r[windows.START], *[r[c] for c in keys], r["values"], r["n"], r["has_null"]) for r in got.collect()])) == sorted(map(str, expected))
    assert window_functions.aggregate_windows(df.limit(0), "t", "20 seconds", Distinct(), {"v": F.col("v")}, "values array<long>, n long, has_null boolean").count() == 0


def test_only_accumulators_are_shuffled(spark):
    """One partial per task and window, however many rows: the exchanges carry no rows."""
    _, df = _events(spark, n=10, hot=20_000)
    got = window_functions.aggregate_windows(df, "t", "1 hour", Distinct(), {"v": F.col("v")}, "values array<long>, n long, has_null boolean")
    assert sum(r["n"] for r in got.collect()) == 20_010
    plan = got._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.split("== Initial Plan ==")[0].split("\n") if "MapInArrow partial" in line or "Exchange hashpartitioning" in line]
    assert first[0].count("_salt") == 0 and "_salt" in first[1] and "partial" in first[2]


def test_whole_window_functions_stream_their_rows(spark):
    """A window far larger than an Arrow batch reaches the function in order, batch by batch;
    a function may stop early or yield many rows."""
    rows, df = _events(spark, n=300, hot=30_000)

    def told(window, batches):
        n = most = 0
        last = -1
        for b in batches:
            assert b.schema.names == ["seq", "kind"] and b.column("seq")[0].as_py() > last
            last, n, most = b.column("seq")[-1].as_py(), n + b.num_rows, max(most, b.num_rows)
        yield {"n": n, "largest_batch": most, "last": last}

    got = window_functions.apply_windows(df, "t", "20 seconds", told, {"seq": F.col("seq"), "kind": F.col("kind")}, "n long, largest_batch long, last long", order=["seq"])
    want = {}
    for r in rows:
        want.setdefault(_windows(r[1], 20, 20)[0], []).append(r[0])
    assert sorted((r[windows.START], r["n"], r["last"]) for r in got.collect()) == sorted((w, len(s), max(s)) for w, s in want.items())
    assert max(r["n"] for r in got.collect()) > 30_000 and max(r["largest_batch"] for r in got.collect()) <= 10_000

    def early(window, batches):
        first = next(batches)
        assert window.end - window.start == dt.timedelta(seconds=20) and set(window.keys) == {"kind"}
        yield {"seq": first.column("seq")[0].as_py()}
        yield {"seq": None}

    got = window_functions.apply_windows(df, "t", "20 seconds", early, {"seq": F.col("seq")}, "seq long", order=["seq"], keys=["kind"])
    want = {}
    for r in rows:
        k = (_windows(r[1], 20, 20)[0], r[2])
        want[k] = min(want.get(k, r[0]), r[0])
    assert sorted((r[windows.START], r["kind"], r["seq"]) for r in got.where("seq IS NOT NULL").collect()) == sorted((*k, v) for k, v in want.items())
    assert got.count() == 2 * len(want)
    assert window_functions.apply_windows(df.limit(0), "t", "20 seconds", early, {"seq": F.col("seq")}, "seq long", order=["seq"], keys=["kind"]).count() == 0



def test_instants_keep_their_zone(spark):
    df = spark.createDataFrame([(1, 5), (2, 6)], "seq long, s long").select("seq", F.timestamp_seconds("s").alias("t"))
    got = window_functions.aggregate_windows(df, "t", "10 seconds", Distinct(), {"v": F.col("seq")}, "values array<long>, n long, has_null boolean").collect()
    assert [(r[windows.START].timestamp(), r["n"]) for r in got] == [(0.0, 2)]
