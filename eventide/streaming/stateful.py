"""Keyed state on streams: StatefulProcessors for ``transformWithStateInPandas``.

Streams refuse non-time window functions, so the per-event "so far" reports
(running count/sum, type counts, last-n lists, count triggers inside a
window) run as stateful processors here, keyed by ``groupBy(key)``: Spark
hash-partitions the stream by key and keeps each key's state in the state
store (RocksDB, checkpointed per micro-batch).

Rules kept from the reference:

* one output row per input row, in arrival order: rows of a micro-batch come
  unordered, so each call sorts its rows by the order column; across
  micro-batches the order is arrival order;
* state is set up in ``init`` (state handles) and never cleared in
  ``close``: ``close`` runs when a task ends, not when the key is done;
* value / list / map state map to ``getValueState`` / ``getListState`` /
  ``getMapState``;
* state may be given at the start (``apply_stateful(initial=...)``): ``state_of`` makes it
  from a table with the batch operators, so a stream goes on where a batch has ended;
* state of a time window ends with it: ``WindowCountTrigger`` sets an event-time timer.

Each processor works on pandas frames per key and batch (vectorised where
the logic allows), and the same processors run on a bounded DataFrame too
(one call per key), which is how tests compare stream and batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide.operators import rolling, scan


class _Keyed(StatefulProcessor):
    """Common parts: key columns, order column, optional state TTL.

    ``ttl_ms`` expires a key's state that was not updated for that long
    (processing time), e.g. the counters of windows that have closed, or
    histories of users gone quiet.  Set through ``apply_stateful(..., ttl_ms=...)``.
    """

    ttl_ms: int | None = None

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """One row per key, as ``state_of`` makes it."""
        self.restore(initialState.iloc[0])

    def restore(self, row: pd.Series) -> None:
        raise NotImplementedError(f"{type(self).__name__} takes no initial state")

    def state_of(self, df: DataFrame) -> DataFrame:
        """The keys' state after the rows of a table: keys and the columns of ``restore``."""
        raise NotImplementedError(f"{type(self).__name__} takes no initial state")


def _rows(rows: Iterator[pd.DataFrame], order: str) -> pd.DataFrame:
    frames = [r for r in rows if len(r)]
    if not frames:
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
    return pdf.sort_values(order, kind="stable").reset_index(drop=True)


def _plain(column: pd.Series) -> list:
    """The values as state takes them: Python numbers and strings, tuples for
    structs, None for nulls (which keep their place)."""
    return [None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else tuple(v.values()) if isinstance(v, dict)
            else v.item() if isinstance(v, np.generic) else v for v in column]


def _text(values: Sequence) -> str:
    """Comma-joined; a struct's fields are joined with colons."""
    return ",".join("null" if v is None else ":".join(map(str, v)) if isinstance(v, tuple) else str(v) for v in values)


class RunningSum(_Keyed):
    """Rolling reduce (+) per key; value state holds the sum so far.
    ``value=None`` counts rows (the per-user event counter)."""

    def __init__(self, keys: Sequence[str], order: str, value: str | None, out: str):
        self.keys, self.order, self.value, self.out = list(keys), order, value, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint", self.ttl_ms)

    def state_of(self, df: DataFrame) -> DataFrame:
        value = F.lit(1) if self.value is None else F.col(self.value)
        return df.groupBy(*self.keys).agg(F.sum(value).cast("long").alias("total"))

    def restore(self, row: pd.Series) -> None:
        self.total.update((int(row["total"]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.order)
        if pdf.empty:
            return
        start = self.total.get()[0] if self.total.exists() else 0
        inc = np.ones(len(pdf), dtype="int64") if self.value is None else pdf[self.value].astype("int64").to_numpy()
        run = start + np.cumsum(inc)
        self.total.update((int(run[-1]),))
        yield pd.DataFrame({**{k: pdf[k] for k in self.keys}, self.order: pdf[self.order], self.out: run})


class TypeCounts(_Keyed):
    """Map state type -> count; every row reports the counts of all listed
    types so far (0 while unseen)."""

    def __init__(self, keys: Sequence[str], order: str, type_col: str, types: Sequence[str],
                 prefix: str = "n_"):
        self.keys, self.order, self.type_col = list(keys), order, type_col
        self.types, self.prefix = list(types), prefix

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "type string", "n bigint", self.ttl_ms)

    def state_of(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.keys).agg(*[F.count_if(F.col(self.type_col) == t).alias(f"{self.prefix}{t}") for t in self.types])

    def restore(self, row: pd.Series) -> None:
        for t in self.types:
            if n := int(row[f"{self.prefix}{t}"]):
                self.counts.updateValue((t,), (n,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.order)
        if pdf.empty:
            return
        out = {k: pdf[k] for k in self.keys}
        out[self.order] = pdf[self.order]
        for t in self.types:
            prev = self.counts.getValue((t,))[0] if self.counts.containsKey((t,)) else 0
            run = prev + np.cumsum((pdf[self.type_col] == t).to_numpy().astype("int64"))
            if run[-1] != prev:
                self.counts.updateValue((t,), (int(run[-1]),))
            out[f"{self.prefix}{t}"] = run
        yield pd.DataFrame(out)


class LastN(_Keyed):
    """List state trimmed to the last n values (oldest removed first), of any type
    (``value_type``, e.g. a struct of the event)."""

    def __init__(self, keys: Sequence[str], order: str, value: str, n: int, out: str = "last_n",
                 value_type: str = "bigint"):
        self.keys, self.order, self.value, self.n, self.out = list(keys), order, value, n, out
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getListState("tail", f"v {self.value_type}", self.ttl_ms)

    def state_of(self, df: DataFrame) -> DataFrame:
        lists = scan.last_n(df.select(*self.keys, self.order, F.col(self.value).alias("_v")), self.order, self.n, F.col("_v"), "tail", self.keys)
        return lists.groupBy(*self.keys).agg(F.max_by("tail", self.order).alias("tail"))

    def restore(self, row: pd.Series) -> None:
        self.tail.put([(v,) for v in _plain(pd.Series(list(row["tail"]), dtype=object))])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.order)
        if pdf.empty:
            return
        prev = [t[0] for t in self.tail.get()] if self.tail.exists() else []
        values = prev + _plain(pdf[self.value])
        lists = [_text(values[max(0, i + 1 - self.n):i + 1]) for i in range(len(prev), len(values))]
        self.tail.put([(v,) for v in values[-self.n:]])
        yield pd.DataFrame({**{k: pdf[k] for k in self.keys}, self.order: pdf[self.order], self.out: lists})


class LastNPerType(_Keyed):
    """Map state type -> last-n list; every row reports the lists of the
    listed types side by side (null while a type is unseen)."""

    def __init__(self, keys: Sequence[str], order: str, type_col: str, value: str,
                 types: Mapping[str, str], n: int, value_type: str = "bigint"):
        self.keys, self.order, self.type_col, self.value = list(keys), order, type_col, value
        self.value_type = value_type
        self.types, self.n = dict(types), n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lists = handle.getMapState("lists", "type string", f"ids array<{self.value_type}>", self.ttl_ms)

    def state_of(self, df: DataFrame) -> DataFrame:
        d = df.select(*self.keys, self.order, F.col(self.type_col).alias("_t"), F.col(self.value).alias("_v"))
        lists = scan.last_n_of_types(d, self.order, self.n, F.col("_v"), "_t", self.types, self.keys)
        return lists.groupBy(*self.keys).agg(F.max_by(F.struct(*self.types.values()), self.order).alias("_s")).select(*self.keys, "_s.*")

    def restore(self, row: pd.Series) -> None:
        for t, c in self.types.items():
            if row[c] is not None:
                self.lists.updateValue((t,), (_plain(pd.Series(list(row[c]), dtype=object)),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.order)
        if pdf.empty:
            return
        cur = {t: (list(self.lists.getValue((t,))[0]) if self.lists.containsKey((t,)) else None)
               for t in self.types}
        outs = {}
        for t, c in self.types.items():
            # a type's list changes at its own rows only: one text each, carried to the rows between
            own = np.flatnonzero((pdf[self.type_col] == t).to_numpy())
            before = cur[t] or []
            values = before + _plain(pdf[self.value].iloc[own])
            texts = [None if cur[t] is None else _text(before)]
            texts += [_text(values[max(0, i + 1 - self.n):i + 1]) for i in range(len(before), len(values))]
            outs[c] = np.array(texts, object)[np.searchsorted(own, np.arange(len(pdf)), side="right")]
            if len(own):
                self.lists.updateValue((t,), (values[-self.n:],))
        yield pd.DataFrame({**{k: pdf[k] for k in self.keys}, self.order: pdf[self.order], **outs})


class CountTrigger(_Keyed):
    """Fire every n rows of the key (e.g. of a time window): emits
    (keys, fire, n_seen, n_match) at each n-th row.  ``purge`` clears the
    contents after each fire, so a fire covers the last n rows only."""

    def __init__(self, keys: Sequence[str], order: str, n: int, match: str, purge: bool = False):
        self.keys, self.order, self.n, self.match, self.purge = list(keys), order, n, match, purge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "seen bigint, matched bigint, fires bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.order)
        if pdf.empty:
            return
        seen, matched, fires = self.acc.get() if self.acc.exists() else (0, 0, 0)
        m = pdf[self.match].fillna(False).astype(bool).to_numpy().astype("int64")
        pos = seen + np.arange(1, len(m) + 1, dtype="int64")   # rows since the last purge (or ever)
        cm = matched + np.cumsum(m)                              # matches over the same span
        at = np.nonzero(pos % self.n == 0)[0]
        if self.purge:
            base = np.concatenate([[0], cm[at[:-1]]]) if len(at) else np.zeros(0, dtype="int64")
            n_seen, n_match = np.full(len(at), self.n, dtype="int64"), cm[at] - base
            last = at[-1] if len(at) else None
            seen = int(pos[-1] - (pos[last] if last is not None else 0))
            matched = int(cm[-1] - (cm[last] if last is not None else 0))
        else:
            n_seen, n_match = pos[at], cm[at]
            seen, matched = int(pos[-1]), int(cm[-1])
        self.acc.update((seen, matched, fires + len(at)))
        if len(at):
            first = pdf.iloc[0]
            yield pd.DataFrame({**{k: [first[k]] * len(at) for k in self.keys},
                                "fire": fires + np.arange(1, len(at) + 1, dtype="int64"),
                                "n_seen": n_seen, "n_match": n_match})


class WindowCountTrigger(CountTrigger):
    """``CountTrigger`` whose keys are event-time windows: a timer at the window's end
    (column ``end_ms``, epoch milliseconds, from ``in_windows``) drops the window's state once
    the watermark has passed it.  Run it with ``apply_stateful(..., event_time=True)`` on a
    stream with a watermark, which drops rows that are late for their window."""

    def __init__(self, keys: Sequence[str], order: str, n: int, match: str, end_ms: str = "end_ms", purge: bool = False):
        super().__init__(keys, order, n, match, purge)
        self.end_ms = end_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [r for r in rows if len(r)]
        if not frames:
            return
        end = int(frames[0][self.end_ms].iloc[0])
        if end <= timerValues.getCurrentWatermarkInMs():
            return  # reported and dropped: not opened again
        if not self.acc.exists():
            self.handle.registerTimer(end)
        yield from super().handleInputRows(key, iter(frames), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.acc.clear()
        yield from ()


def in_windows(stream: DataFrame, time_col: str, size: str, start: str = "window_start", end: str = "window_end", end_ms: str = "end_ms") -> DataFrame:
    """The rows with their tumbling window, and its end in milliseconds; ``time_col`` keeps its
    watermark."""
    w = stream.withColumn("_w", F.window(time_col, size)).withColumns({start: F.col("_w.start"), end: F.col("_w.end")})
    return w.withColumn(end_ms, F.unix_millis(end)).drop("_w")


class HistoryPages(_Keyed):
    """All events so far per key, as bounded pages: list state holds the open
    page only.  Each row reports its position and page; the page's text so far comes
    with the last row of the page in the micro-batch (null before it)."""

    def __init__(self, keys: Sequence[str], order: str, value: str, page_size: int = 1000,
                 value_type: str = "bigint"):
        self.keys, self.order, self.value, self.page_size = list(keys), order, value, page_size
        self.value_type = value_type

    def state_of(self, df: DataFrame) -> DataFrame:
        pages = rolling.history_pages(df, self.order, self.keys, self.value, self.page_size).groupBy(*self.keys).agg(F.sum("n_events").alias("pos"))
        open_ = F.when(F.col("pos") % self.page_size > 0, F.slice("tail", -(F.col("pos") % self.page_size), F.col("pos") % self.page_size))
        lists = LastN(self.keys, self.order, self.value, self.page_size).state_of(df)
        both = pages.alias("a").join(lists.alias("b"), scan.same_keys("a", "b", self.keys))
        return both.select(*[F.col(f"a.{k}") for k in self.keys], "pos", "tail").select(*self.keys, "pos", F.coalesce(open_, F.expr("slice(tail, 1, 0)")).alias("page"))

    def restore(self, row: pd.Series) -> None:
        self.pos.update((int(row["pos"]),))
        if len(row["page"]):
            self.page.put([(v,) for v in _plain(pd.Series(list(row["page"]), dtype=object))])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pos = handle.getValueState("pos", "pos bigint", self.ttl_ms)
        self.page = handle.getListState("page", f"v {self.value_type}", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows, self.order)
        if pdf.empty:
            return
        pos = self.pos.get()[0] if self.pos.exists() else 0
        page = [t[0] for t in self.page.get()] if self.page.exists() else []
        positions = np.arange(pos + 1, pos + len(pdf) + 1)
        pages = (positions - 1) // self.page_size
        texts = np.full(len(pdf), None, object)
        values, start = _plain(pdf[self.value]), 0
        for end in (np.flatnonzero(np.diff(pages, append=-1)) + 1).tolist():
            page += values[start:end]
            texts[end - 1], start = _text(page), end
            if len(page) == self.page_size:
                page = []
        self.pos.update((int(positions[-1]),))
        if page:
            self.page.put([(v,) for v in page])
        else:
            self.page.clear()
        yield pd.DataFrame({**{k: pdf[k] for k in self.keys}, self.order: pdf[self.order],
                            "position": positions, "page": pages, "history": texts})


def apply_stateful(df: DataFrame, keys: Sequence[str], processor: StatefulProcessor,
                   output_schema: str, output_mode: str = "Append", ttl_ms: int | None = None,
                   event_time: bool = False, initial: DataFrame | None = None) -> DataFrame:
    """``groupBy(keys).transformWithStateInPandas(processor)``.  With
    ``ttl_ms`` the processor's state expires after that much processing time
    without an update (processing-time mode, needed for TTL).  A query in that
    mode keeps running micro-batches for expiry, so use it with a continuous
    trigger, not ``availableNow``.  ``event_time`` lets the processor set timers on
    the stream's watermark.  ``initial`` is a table with one row per key, the state
    before the first row of the stream (``processor.state_of(table)``); a restart
    from a checkpoint does not read it again."""
    if ttl_ms is not None:
        if event_time:
            raise ValueError("a TTL is processing time: it cannot be had with event-time timers")
        processor.ttl_ms = int(ttl_ms)
    mode = "EventTime" if event_time else "ProcessingTime" if ttl_ms is not None else "None"
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output_schema, outputMode=output_mode, timeMode=mode,
        initialState=None if initial is None else initial.groupBy(*keys))
