"""Order-dependent operators per key: runs of labelled rows, and repeat
suppression with a time-to-live."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripwire.config import LABEL, SUPPRESS_TTL_SECONDS, TS, WATERMARK
from tripwire.functions.columns import iso
from tripwire.operators.analytics import width_seconds


_PIECE = ("user_id string, first_us long, first_id string, last_us long, last_id string, n long, "
          "countries array<string>, slot long, pid int, place int, at_start boolean, at_end boolean")
_PIECE_ARROW = pa.schema([
    ("user_id", pa.string()), ("first_us", pa.int64()), ("first_id", pa.string()), ("last_us", pa.int64()),
    ("last_id", pa.string()), ("n", pa.int64()), ("countries", pa.list_(pa.string())), ("slot", pa.int64()),
    ("pid", pa.int32()), ("place", pa.int32()), ("at_start", pa.bool_()), ("at_end", pa.bool_())])


def _batch_runs(batch: pa.RecordBatch, positive: np.ndarray, start: np.ndarray) -> list[pa.Array]:
    """Runs of one sorted batch, in order: user, first and last (time, id), length, known countries."""
    at = np.flatnonzero(positive)
    run = np.cumsum(start)[at]
    cuts = np.append(True, run[1:] != run[:-1])
    first, last = at[cuts], at[np.append(np.flatnonzero(cuts)[1:] - 1, len(at) - 1)]
    number = np.cumsum(cuts) - 1
    country = batch.column("country").take(pa.array(at)).dictionary_encode()
    codes = country.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    known = codes >= 0
    pairs = np.unique(number[known] * (len(country.dictionary) + 1) + codes[known])
    owner, code = pairs // (len(country.dictionary) + 1), pairs % (len(country.dictionary) + 1)
    offsets = np.searchsorted(owner, np.arange(len(first) + 1))
    countries = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), country.dictionary.take(pa.array(code)))
    take = lambda name, rows: batch.column(name).take(pa.array(rows))
    return [take("user_id", first), take("us", first), take("transaction_id", first), take("us", last),
            take("transaction_id", last), pa.array(np.diff(np.append(np.flatnonzero(cuts), len(at))), pa.int64()), countries]


def _run_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition, sorted by (user, time, id), as an element of the monoid of run segments: the runs
    inside it, each with a slot of its own, and in slot 0 what meets the neighbours at both ends: a
    run or, with length 0, none. A partition of one single run is both ends at once."""
    pid = TaskContext.get().partitionId()
    waiting, waits_at_start, user, positive_before, rows, runs = None, False, None, False, 0, 0

    def piece(values, slot, place, at_start, at_end):
        return pa.record_batch([*(pa.array([v], t) for v, t in zip(values, _PIECE_ARROW.types)),
                                *(pa.array([v], t) for v, t in zip((slot, pid, place, at_start, at_end), _PIECE_ARROW.types[7:]))],
                               schema=_PIECE_ARROW)

    def closed():
        nonlocal runs
        runs += 1
        return piece(waiting, 0 if waits_at_start else (pid << 40) + runs, 0, waits_at_start, False)

    nothing = (None, None, None, None, None, 0, [])
    for batch in batches:
        if batch.num_rows == 0:
            continue
        users, positive = batch.column("user_id"), batch.column("positive").to_numpy(zero_copy_only=False)
        same = np.append(rows > 0 and users[0].as_py() == user, pc.equal(users[1:], users[:-1]).to_numpy(zero_copy_only=False))
        follows = same & np.append(positive_before, positive[:-1])
        if rows == 0 and not positive[0]:
            yield piece(nothing, 0, 0, True, False)
        if waiting is not None and not (positive[0] and follows[0]):
            yield closed()
            waiting = None
        if positive.any():
            found = _batch_runs(batch, positive, positive & ~follows)
            count = len(found[0])
            lo = 0
            if waiting is not None:  # the first run goes on from the last batch
                more = [c[0].as_py() for c in found]
                waiting = [*waiting[:3], *more[3:5], waiting[5] + more[5], sorted(set(waiting[6]) | set(more[6]))]
                lo = 1
                if count > 1 or not positive[-1]:
                    yield closed()
                    waiting = None
            hi = count - 1 if positive[-1] else count
            if lo == 0 and hi > 0 and rows == 0 and positive[0]:  # the partition's first run ends in this batch
                yield piece([c[0].as_py() for c in found], 0, 0, True, False)
                lo = 1
            if hi > lo:
                inner = [c.slice(lo, hi - lo) for c in found]
                k = hi - lo
                slots = (pid << 40) + runs + 1 + np.arange(k)
                runs += k
                yield pa.record_batch([*inner, pa.array(slots, pa.int64()), pa.array(np.full(k, pid), pa.int32()),
                                       pa.array(np.zeros(k), pa.int32()), pa.array(np.zeros(k, bool)), pa.array(np.zeros(k, bool))],
                                      schema=_PIECE_ARROW)
            if positive[-1] and waiting is None:
                waiting = [c[count - 1].as_py() for c in found]
                waits_at_start = rows == 0 and count == 1 and bool(positive[0])
        user, positive_before, rows = users[-1].as_py(), bool(positive[-1]), rows + batch.num_rows
    if waiting is not None:
        yield piece(waiting, 0, 1, waits_at_start, True)
    elif rows:
        yield piece(nothing, 0, 1, False, True)


def label_runs(enriched: DataFrame) -> DataFrame:
    """Maximal runs of consecutive labelled rows (is_fraud = 1) of one user,
    rows ordered by (ts, transaction_id): start, end, length, time span and
    number of distinct known countries, plus the length's usual pattern
    (1 single, 3 hop, 5 or more burst). Rows without a user or a time are in no run.

    The rows are dealt to sorted ranges of (user, time, id) of about equal row counts, so that a
    user with very many rows spreads over many ranges. A range is reduced to the runs
    inside it and the pieces that touch its two ends; the pieces of neighbouring ranges that meet are
    merged in order. Only these, two rows per range, come together in one task."""
    rows = enriched.filter(F.col(TS).isNotNull() & F.col("user_id").isNotNull()).select(
        "user_id", F.unix_micros(F.col(TS)).alias("us"), "transaction_id", "country",
        F.coalesce(F.col(LABEL) == 1, F.lit(False)).alias("positive"))
    order = ["user_id", "us", "transaction_id"]
    pieces = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(_run_pieces, _PIECE))
    w = Window.partitionBy("slot").orderBy("pid", "place")
    before = lambda c: F.lag(c).over(w)
    meets = F.coalesce(F.col("at_start") & before("at_end") & (F.col("n") > 0) & (before("n") > 0)
                       & (F.col("user_id") == before("user_id")), F.lit(False))
    runs = (pieces.withColumn("new", (~meets).cast("int")).withColumn("chain", F.sum("new").over(w)).filter("n > 0")
            .groupBy("slot", "chain").agg(
                F.first("user_id").alias("user_id"),
                F.min(F.struct("first_us", "first_id")).alias("first"), F.max(F.struct("last_us", "last_id")).alias("last"),
                F.sum("n").alias("run_length"), F.size(F.array_distinct(F.flatten(F.collect_list("countries")))).alias("n_countries")))
    length = F.col("run_length")
    return runs.select(
        "user_id",
        F.col("first.first_id").alias("first_transaction_id"),
        iso(F.timestamp_micros(F.col("first.first_us"))).alias("run_start"),
        iso(F.timestamp_micros(F.col("last.last_us"))).alias("run_end"),
        "run_length",
        ((F.col("last.last_us") - F.col("first.first_us")) / F.lit(1_000_000.0)).alias("span_seconds"),
        F.col("n_countries").cast("long").alias("n_countries"),
        F.when(length == 1, "single").when(length == 3, "hop").when(length >= 5, "burst")
         .otherwise("other").alias("pattern"))


# ------------------------------------------------------ suppression with a time-to-live

def first_at_least(group: np.ndarray, t: np.ndarray, of: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query (group `of`, time `least`): the place of its group's first element with
    t >= least, or len(t) if there is none. Elements are sorted by (group, t)."""
    element = np.append(np.ones(len(t), np.int64), np.zeros(len(of), np.int64))
    order = np.lexsort((element, np.append(t, least), np.append(group, of)))
    passed = np.cumsum(element[order])
    at = np.empty(len(of), np.int64)
    queries = element[order] == 0
    at[order[queries] - len(t)] = passed[queries]
    inside = at < len(t)
    inside[inside] = group[at[inside]] == of[inside]
    return np.where(inside, at, len(t))


def ends_of_walks(after: np.ndarray) -> np.ndarray:
    """The last place of a walk from each place, by pointer doubling; `after` is len(after) at an end."""
    last = np.where(after < len(after), after, np.arange(len(after)))
    while not np.array_equal(last, last[last]):
        last = last[last]
    return last


def places_on_walks(after: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each place lies on a walk from one of the starts, by doubling: after k rounds
    the first 2^k places of all walks are marked."""
    n = len(after)
    jump, on = np.append(after, n), np.zeros(n + 1, bool)
    on[starts] = True
    while (jump[np.flatnonzero(on)] < n).any():
        on[jump[np.flatnonzero(on)]] = True
        jump = jump[jump]
    return on[:n]


def _whole_groups(keys: list[str], fn):
    """mapInArrow function over batches sorted by `keys`: `fn` gets tables of whole groups with the
    group number of each row, many groups at a time; only the last group of a batch waits."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def numbered(table):
            new = np.zeros(table.num_rows, bool)
            for k in keys:
                c = table.column(k).combine_chunks()
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            return np.cumsum(new)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            ends = [held[0].column(held[0].schema.get_field_index(k))[0] for k in keys]
            if ends == [batch.column(batch.schema.get_field_index(k))[-1] for k in keys]:
                continue  # one group so far
            table = pa.Table.from_batches(held)
            group = numbered(table)
            cut = int(np.searchsorted(group, group[-1]))
            yield from fn(table.slice(0, cut), group[:cut]).to_batches()
            held = table.slice(cut).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from fn(table, numbered(table)).to_batches()
    return run


def _steps(ttl_us: int, chunk_us: int):
    """(key, chunk) groups of distinct times: where a walk that enters the chunk leaves it, as steps
    (eligible time up to `entry`, last kept time `leave`). A walk enters before chunk start + ttl
    or at the first time after that, and walks soon meet, so few steps remain."""
    def fn(table: pa.Table, group: np.ndarray) -> pa.Table:
        t, c = table.column("_t").to_numpy(), table.column("_c").to_numpy()
        leave = t[ends_of_walks(first_at_least(group, t, group, t + ttl_us))]
        opens = np.append(True, group[1:] != group[:-1])
        reach = opens | np.append(True, t[:-1] < c[:-1] * chunk_us + ttl_us)
        closes = np.append(opens[1:] | ~reach[1:] | (leave[1:] != leave[:-1]), True)
        at = pa.array(np.flatnonzero(reach & closes))
        return pa.table({"_k": table.column("_k").take(at), "_c": table.column("_c").take(at),
                         "entry": table.column("_t").take(at), "leave": pa.array(leave).take(at)})
    return _whole_groups(["_k", "_c"], fn)


#: Before any time.
_EVER = -2 ** 62


def _walk_chunks(ttl_us: int):
    """Groups of one key's steps in order: the chunks where a row is kept, each with the time from
    which a row may be kept."""
    def fn(table: pa.Table, group: np.ndarray) -> pa.Table:
        entry, leave = table.column("entry").to_numpy(), table.column("leave").to_numpy()
        after = first_at_least(group, entry, group, leave + ttl_us)
        on = places_on_walks(after, np.flatnonzero(np.append(True, group[1:] != group[:-1])))
        eligible = np.full(len(entry) + 1, _EVER)
        eligible[after[on]] = leave[on] + ttl_us
        at = np.flatnonzero(on)
        return pa.table({"_k": table.column("_k").take(pa.array(at)), "_c": table.column("_c").take(pa.array(at)),
                         "_m": pa.array(np.zeros(len(at), np.int32)), "_t": pa.array(eligible[at])})
    return _whole_groups(["_k"], fn)


def _walk_times(ttl_us: int):
    """(key, chunk) groups of times, led by the chunk's eligible time (_m = 0) if it has one: the
    kept times."""
    def fn(table: pa.Table, group: np.ndarray) -> pa.Table:
        t, lead = table.column("_t").to_numpy(), table.column("_m").to_numpy() == 0
        rows = np.flatnonzero(~lead)
        group_of, times = group[rows], t[rows]
        after = first_at_least(group_of, times, group_of, times + ttl_us)
        starts = first_at_least(group_of, times, group[lead], t[lead])
        on = rows[places_on_walks(after, starts)]
        return pa.table({"_k": table.column("_k").take(pa.array(on)), "_t": pa.array(t[on])})
    return _whole_groups(["_k", "_c"], fn)


def suppress_repeats(df: DataFrame, keys: list[str], time_col: str = TS,
                     ttl_seconds: int = SUPPRESS_TTL_SECONDS,
                     order_cols: tuple[str, ...] = (), chunk: str = "1 day") -> DataFrame:
    """Keep the first row of each key, then the next row at least `ttl_seconds`
    (event time) after the last *kept* row; repeats in between are dropped and
    do not extend the suppression. Rows of one time are ordered by `order_cols`, then by a
    hash of the row; rows without a time are dropped; NULL keys are a key. Batch operator.

    Which rows are kept depends on the distinct times of a key alone. They are cut into chunks
    of time; each chunk is reduced to the few ways through it, a key's chunks are walked in
    order over these, and then every chunk marks its kept times by itself. So no task holds a
    key's rows: a chunk's task has its distinct times, and a key's walk a few short entries per chunk.
    All walks of a batch, whatever their keys, go forward together by pointer doubling."""
    ttl_us = int(ttl_seconds * 1_000_000)
    chunk_us = width_seconds(chunk) * 1_000_000
    cols = df.columns
    base = (df.withColumn("_t", F.unix_micros(F.col(time_col))).filter(F.col("_t").isNotNull())
              .withColumn("_k", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))
    times = base.select("_k", F.floor(F.col("_t") / F.lit(chunk_us)).cast("long").alias("_c"), "_t").distinct()
    def dealt(frame, by, then):
        return frame.repartition(*by).sortWithinPartitions(*by, *then)
    steps = dealt(times, ["_k", "_c"], ["_t"]).mapInArrow(_steps(ttl_us, chunk_us), "_k string, _c long, entry long, leave long")
    eligible = dealt(steps, ["_k"], ["_c", "entry"]).mapInArrow(_walk_chunks(ttl_us), "_k string, _c long, _m int, _t long")
    led = times.select("_k", "_c", F.lit(1).alias("_m"), "_t").union(eligible)
    kept = dealt(led, ["_k", "_c"], ["_m", "_t"]).mapInArrow(_walk_times(ttl_us), "_k string, _t long")
    row = F.struct(*[F.col(c) for c in cols])
    first = F.struct(*[F.col(c) for c in order_cols], F.xxhash64(*[F.col(c) for c in cols]))
    return (base.join(kept, ["_k", "_t"]).groupBy("_k", "_t").agg(F.min_by(row, first).alias("row"))
            .select(*[F.col("row")[c].alias(c) for c in cols]))


class RepeatFilter(StatefulProcessor):
    """Per key: the last kept time as a value state, and a timer that clears it once the watermark has
    passed it by the time-to-live (no row that it could suppress is accepted any more)."""

    def __init__(self, cols: list[str], order_cols: tuple[str, ...], ttl_us: int):
        self.cols, self.order_cols, self.ttl_us = cols, order_cols, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long")

    def _order(self, row):
        return row["_t"], *((row[c] is not None, row[c]) for c in self.order_cols), row["_h"]

    def handleInputRows(self, key, rows, timerValues):
        before = self.last.get()[0] if self.last.exists() else None
        last = before
        # A key's rows of one micro-batch; their number is bounded by the source's trigger limits.
        for row in sorted(rows, key=self._order):
            if last is None or row["_t"] >= last + self.ttl_us:
                last = row["_t"]
                yield Row(**{c: row[c] for c in self.cols})
        if last != before:
            self.last.update((last,))
            if before is not None:
                self.handle.deleteTimer(self._expiry(before))
            self.handle.registerTimer(self._expiry(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass

    def _expiry(self, last: int) -> int:
        return (last + self.ttl_us) // 1000 + 1


def suppress_repeats_stream(df: DataFrame, keys: list[str], time_col: str = TS,
                            ttl_seconds: int = SUPPRESS_TTL_SECONDS, delay: str = WATERMARK,
                            order_cols: tuple[str, ...] = ()) -> DataFrame:
    """The same rule on a stream, with state and event-time timers per key (`RepeatFilter`); NULL keys are
    a key. Rows are judged batch by batch, within a batch by time, `order_cols` and a hash of the row; a
    row before the last kept one is a repeat, rows later than `delay` are dropped."""
    cols = df.columns
    ttl_us = int(ttl_seconds * 1_000_000)
    keyed = (df.filter(F.col(time_col).isNotNull()).withWatermark(time_col, delay)
             .withColumns({"_t": F.unix_micros(F.col(time_col)), "_h": F.xxhash64(*cols),
                           "_k": F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})}))
    return keyed.groupBy("_k").transformWithState(
        RepeatFilter(cols, tuple(order_cols), ttl_us), outputStructType=df.schema, outputMode="append", timeMode="EventTime")
