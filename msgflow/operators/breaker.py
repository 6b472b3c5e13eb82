"""Circuit breaker: failure runs, full replay, summary."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple, Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgflow.config import BreakerPolicy
from msgflow.operators.batching import order_for
from msgflow.operators.lookup_files import first_at_least, write_lookup
from msgflow.operators.segments import (
    DEFAULT_SPAN,
    NEVER,
    NO_TIME,
    SEGMENT,
    TAG,
    as_start,
    carried,
    chain_ends,
    earlier_segments,
    first_reaching,
    fold_summaries,
    give_back,
    identity_of,
    in_segment,
    key_arrays,
    key_fields,
    micros,
    moment_us,
    settled,
    tagged,
    with_segments,
)
from msgflow.schema import LOG_KEY, check_columns
from msgflow.session import run_dir

# The three state names.
CLOSED, OPEN, HALF_OPEN = "closed", "open", "half-open"

STATES = (CLOSED, HALF_OPEN, OPEN)
ACTIONS = ("ok", "tripped", "probe", "closed", "reopened", "continue", "rejected")
#: Ends of an inherited open breaker that a summary holds itself; more go to a file.
INLINE_PROBES = 64
#: In place of a failure count: the one that the breaker came with.
KEPT = -1

#: Columns that a replay adds.
ADDED = ("state_before", "state_after", "failure_count", "success_count", "action", "fatal")

STATE_SCHEMA = "state STRING, failure_count BIGINT, success_count BIGINT, last_change BIGINT"


class Breaker(NamedTuple):
    """State of one breaker.

    ``successes`` counts in half-open only and ``last`` (microseconds) is when it
    opened; both are 0 in states that do not read them. ``failures`` stays at the
    threshold after a trip and is 0 after a reopening.
    """

    state: str = CLOSED
    failures: int = 0
    successes: int = 0
    last: int = 0


def breaker_step(b: Breaker, ok: bool, now: int, policy: BreakerPolicy) -> tuple[Breaker, str]:
    """The state after one outcome, and the action taken.

    ``now`` is ``NO_TIME`` for a row without a time: it ends no cooldown, and the
    cooldown of a breaker that opened at such a row does not end.
    """
    opened_at = NEVER if now <= NO_TIME else now
    if b.state == CLOSED:
        if ok:
            return Breaker(), "ok"
        failures = b.failures + 1
        if failures >= policy.threshold:
            return Breaker(OPEN, failures, 0, opened_at), "tripped"
        return Breaker(CLOSED, failures), "continue"
    if b.state == OPEN:
        if ok:
            return b, "ok"
        if now - b.last >= policy.cooldown_ms * 1000:
            return Breaker(HALF_OPEN, b.failures), "probe"
        return b, "rejected"
    if not ok:
        return Breaker(OPEN, 0, 0, opened_at), "reopened"
    if b.successes + 1 >= policy.half_open_attempts:
        return Breaker(), "closed"
    return b._replace(successes=b.successes + 1), "ok"


def failure_runs(
    df: DataFrame, by: Sequence[str] = LOG_KEY, span: int = DEFAULT_SPAN
) -> DataFrame:
    """Length of the run of consecutive failures that ends at each row (0 on success).

    A row's run is its position minus the position of the last success, and the
    last success before a segment is a maximum over segment summaries.
    """
    by, order = list(by), order_for(by)
    check_columns(df, [*by, *order, "ok"], "failure_runs")
    # Repeated deliveries of a position are put in one order wherever they are ranked.
    here = in_segment(by, [*order, "ok"])
    running = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def placed(frame: DataFrame) -> DataFrame:
        ranked = frame.withColumn("_rank", F.row_number().over(here).cast("bigint"))
        return ranked.withColumn("_ok_at", F.max(F.when(F.col("ok"), F.col("_rank"))).over(running))

    segmented = with_segments(settled(df), order, span, by)
    slim = placed(segmented.select(*dict.fromkeys([*by, *order, "ok", SEGMENT])))
    summary = slim.groupBy(*by, SEGMENT).agg(
        F.max("_rank").alias("_rows"), F.max("_ok_at").alias("_last_ok")
    )
    before = earlier_segments(by)
    summary = summary.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inherited = summary.withColumn(
        "_run",
        F.col("_base")
        - F.coalesce(F.max(F.col("_base") + F.col("_last_ok")).over(before), F.lit(0)),
    ).select(*by, SEGMENT, "_run")
    run = F.when(F.col("_ok_at").isNull(), F.col("_run") + F.col("_rank")).otherwise(
        F.col("_rank") - F.col("_ok_at")
    )
    return (
        placed(segmented.join(inherited, [*by, SEGMENT]))
        .withColumn("failure_run", run.cast("bigint"))
        .drop("_rank", "_ok_at", "_run", SEGMENT)
    )


# --------------------------------------------------------------------------
# Segment summary: the breaker as jumps between its state changes.
# --------------------------------------------------------------------------


def _next_true(flag: np.ndarray) -> np.ndarray:
    """For every i in 0..n: position of the first True at or after i, n when none."""
    n = len(flag)
    at = np.where(flag, np.arange(n), n)
    return np.append(np.minimum.accumulate(at[::-1])[::-1], n).astype(np.int64)


class _Jumps:
    """The breaker of a segment as jumps between its state changes.

    Nodes are moments at which the future depends on the rows alone: closed with
    no failures before row i, half-open with no successes before row i, opened at
    row i (the last two by trip and by reopening, which keep different failure
    counts). Each node jumps forward to the next one, or to itself at the end.
    """

    def __init__(self, ok: np.ndarray, us: np.ndarray, policy: BreakerPolicy):
        self.ok, self.us, self.policy = ok, us, policy
        n, width = len(ok), len(ok) + 1
        self.n, self.width = n, width
        threshold, attempts = policy.threshold, policy.half_open_attempts
        rows = np.arange(width, dtype=np.int64)
        self.next_fail, self.next_ok = _next_true(~ok), _next_true(ok)
        self.fails = np.flatnonzero(~ok).astype(np.int64)
        self.fail_us = us[self.fails]

        # Closed at i: the first `threshold` failures in a row that start at or after i.
        starts_run = ~ok & (self.next_ok[:n] - rows[:n] >= threshold)
        trip = np.minimum(_next_true(starts_run) + threshold - 1, n)
        # Opened at i: the first later failure past the cooldown is the probe.
        after = np.searchsorted(self.fails, rows[:n], side="right")
        probe = np.append(self.fails, n)[
            first_reaching(self.fail_us, after, as_start(us) + policy.cooldown_ms * 1000)
        ]
        self.closed, self.half_t, self.half_r, self.open_t, self.open_r = (k * width for k in range(5))
        jump = np.arange(5 * width, dtype=np.int64)
        jump[:width] = np.where(trip < n, self.open_t + trip, rows)
        for half, opened in ((self.half_t, self.open_t), (self.half_r, self.open_r)):
            jump[half : half + width] = np.where(
                self.next_fail - rows >= attempts,
                self.closed + np.minimum(rows + attempts, n),
                np.where(self.next_fail < n, self.open_r + self.next_fail, half + rows),
            )
            jump[opened : opened + n] = np.where(probe < n, half + probe + 1, opened + rows[:n])
        self.jump = jump

    def probe_from(self, opened: int) -> int:
        """The row that probes a breaker opened at this time before the segment; n when none does."""
        late = first_reaching(self.fail_us, np.array([0]), np.array([opened + self.policy.cooldown_ms * 1000]))
        return int(np.append(self.fails, self.n)[late[0]])

    def path(self, node: int) -> np.ndarray:
        """The node and all that follow it, by doubling."""
        path, hop = np.array([node]), self.jump
        while hop[path[-1]] != path[-1]:
            path, hop = np.concatenate([path, hop[path]]), hop[hop]
        steady = np.flatnonzero(self.jump[path] == path)
        return path[: steady[0] + 1] if len(steady) else path


def _segment_ends(ok: np.ndarray, us: np.ndarray, policy: BreakerPolicy, folder: str = "") -> dict:
    """What a segment makes of every breaker it could inherit.

    Doubling the jumps gives the last node of all of them in O(n log n) array operations. An
    inherited open breaker can end in as many states as there are failures to probe it; where
    these are more than ``INLINE_PROBES``, they go to a file that answers the one question
    that the fold has, and the summary holds its path.
    """
    jumps = _Jumps(ok, us, policy)
    n, width, threshold = jumps.n, jumps.width, policy.threshold
    end = chain_ends(jumps.jump)
    oks = np.flatnonzero(ok)
    fail_tail = n - (int(oks[-1]) + 1 if len(oks) else 0)

    def ends_at(nodes: np.ndarray, entered: bool = False) -> np.ndarray:
        """State number, failures, successes and time of opening, one row for each node."""
        kind, row = np.divmod(end[nodes], width)
        out = np.zeros((len(nodes), 4), np.int64)
        out[:, 0] = np.array([0, 1, 1, 2, 2])[kind]
        out[:, 1] = np.select(
            [kind == 0, (kind == 1) | (kind == 3)], [np.minimum(fail_tail, n - row), threshold], 0
        )
        if entered:  # entered half-open and stayed there: keeps the failure count it came with
            out[end[nodes] == nodes, 1] = KEPT
        out[:, 2] = np.where((kind == 1) | (kind == 2), n - row, 0)
        opened = kind >= 3
        out[opened, 3] = as_start(us[row[opened]])
        return out

    one = lambda node: _breaker_of(ends_at(np.array([node]))[0].tolist())._asdict()
    some = lambda nodes: [_breaker_of(r)._asdict() for r in ends_at(np.asarray(nodes, np.int64)).tolist()]
    lead_fails, lead_oks = int(jumps.next_ok[0]), int(jumps.next_fail[0])
    probes, probe_us, file = [], [], None
    if len(jumps.fails):
        # Neighbouring probes mostly lead to one end: keep one entry per end.
        nodes = jumps.half_r + jumps.fails + 1
        lasts = np.append(np.flatnonzero(np.diff(end[nodes])), len(nodes) - 1)
        reached, found = np.maximum.accumulate(jumps.fail_us)[lasts], ends_at(nodes[lasts], entered=True)
        if len(lasts) > INLINE_PROBES:
            file = f"{folder}/probes-{uuid.uuid4().hex}"
            write_lookup(file, reached, found)
        else:
            probes = [_breaker_of(r)._asdict() for r in found.tolist()]
            probe_us = reached.tolist()
    return {
        "_rows": n,
        "_lead_fails": lead_fails,
        "_lead_oks": lead_oks,
        "_trips": some(jumps.open_t + np.arange(min(threshold, lead_fails))),
        "_resets": one(jumps.closed + lead_fails),
        "_closes": some(jumps.closed + np.arange(1, min(policy.half_open_attempts, lead_oks) + 1)),
        "_reopens": one(jumps.open_r + lead_oks) if lead_oks < n else Breaker()._asdict(),
        "_probes": probes,
        "_probe_us": probe_us,
        "_probe_file": file,
        "_last_probe_us": int(jumps.fail_us.max()) if len(jumps.fails) else NO_TIME,
    }


def _breaker_of(row: list[int]) -> Breaker:
    return Breaker(STATES[row[0]], *row[1:])


def _inherit_breaker(b: Breaker, row: dict, policy: BreakerPolicy) -> Breaker:
    """The breaker after a segment, from the one before it and the segment's summary."""
    n = row["_rows"]
    if b.state == CLOSED:
        if b.failures + row["_lead_fails"] >= policy.threshold:
            return Breaker(**row["_trips"][policy.threshold - b.failures - 1].as_py())
        if row["_lead_fails"] == n:
            return Breaker(CLOSED, b.failures + n)
        return Breaker(**row["_resets"])
    if b.state == HALF_OPEN:
        if b.successes + row["_lead_oks"] >= policy.half_open_attempts:
            return Breaker(**row["_closes"][policy.half_open_attempts - b.successes - 1].as_py())
        if row["_lead_oks"] == n:
            return b._replace(successes=b.successes + n)
        return Breaker(**row["_reopens"])
    due = b.last + policy.cooldown_ms * 1000
    if row["_last_probe_us"] < due:
        return b
    if row["_probe_file"] is not None:
        after = _breaker_of(first_at_least(row["_probe_file"], due))
    else:
        at = int(np.searchsorted(row["_probe_us"].to_numpy(), due, "left"))
        after = Breaker(**row["_probes"][at].as_py())
    return after._replace(failures=b.failures) if after.failures == KEPT else after


def _pieces(b: Breaker, jumps: _Jumps) -> list[np.ndarray]:
    """The stretches of rows between state changes: state number, first row, failures, successes.

    ``failures`` is what an open or half-open breaker keeps, or what a closed one came with.
    The stretch in which the inherited state counts is worked out here; from the next
    node on, all follows from the jumps.
    """
    policy, n = jumps.policy, jumps.n
    first: list[tuple[int, int, int, int]] = []
    state, row, failures, successes, node = STATES.index(b.state), 0, b.failures, b.successes, None
    if b.state == OPEN:
        first.append((2, 0, failures, 0))
        probe = jumps.probe_from(b.last)
        state, row, successes = (2, n, 0) if probe >= n else (1, probe + 1, 0)
    if state == 1:
        first.append((1, row, failures, successes))
        fail = int(jumps.next_fail[row])
        if fail - row >= policy.half_open_attempts - successes:
            node = jumps.closed + row + policy.half_open_attempts - successes
        elif fail < n:
            node = jumps.open_r + fail
    elif state == 0:
        lead = int(jumps.next_ok[0])
        if failures == 0:
            node = jumps.closed
        else:
            first.append((0, 0, failures, 0))
            if failures + lead >= policy.threshold:
                node = jumps.open_t + policy.threshold - failures - 1
            elif lead < n:
                node = jumps.closed + lead
    head = np.array(first, np.int64).reshape(-1, 4).T
    if node is None:
        return list(head)
    kind, at = np.divmod(jumps.path(node), jumps.width)
    kept = np.array([0, policy.threshold, 0, policy.threshold, 0])[kind]
    tail = (np.array([0, 1, 1, 2, 2])[kind], at + (kind >= 3), kept, np.zeros_like(at))
    return [np.concatenate([a, t]) for a, t in zip(head, tail)]


def _replayed(b: Breaker, ok: np.ndarray, us: np.ndarray, policy: BreakerPolicy) -> dict[str, np.ndarray]:
    """State before and after, counts and action of every row, as arrays."""
    n = len(ok)
    states, starts, failures, successes = _pieces(b, _Jumps(ok, us, policy))
    lengths = np.diff(np.append(starts, n))
    here = lambda x: np.repeat(x, lengths)
    rows, state, start, came = np.arange(n), here(states), here(starts), here(failures)
    # The last row of a stretch makes the change to the next one's state.
    after = state.copy()
    ends = starts[1:] - 1
    moved = (ends >= 0) & (lengths[:-1] > 0)
    after[ends[moved]] = states[1:][moved]
    changed = after != state
    since_ok = rows - np.maximum.accumulate(np.where(ok, rows, -1))  # failures in a row up to each row
    inside = rows - start + 1
    run = np.where(since_ok >= inside, inside + came, since_ok)
    closed, half = state == 0, state == 1
    count = np.select([closed, half & changed], [np.where(ok, 0, run), 0], came)
    wins = np.where(half & ~changed, here(successes) + inside, 0)
    action = np.select(
        [changed & closed, changed & (state == 2), changed & (after == 0), changed, ok, closed],
        [1, 2, 3, 4, 0, 5], 6,
    )
    return {"before": state, "after": after, "failures": count, "successes": wins, "action": action}


_BREAKER_STRUCT = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("successes", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)


def circuit_breaker(
    df: DataFrame, policy: BreakerPolicy = BreakerPolicy(), by: Sequence[str] = LOG_KEY,
    span: int = DEFAULT_SPAN, initial: Optional[DataFrame] = None, inherited: Optional[DataFrame] = None,
) -> DataFrame:
    """Replay the breaker of each key over its outcomes, by row timestamps.

    Adds ``state_before, state_after, failure_count, success_count, action,
    fatal``. ``initial`` holds a breaker per key to go on from (``breaker_state``
    of an earlier frame); other keys start closed. Every row of ``df`` is returned
    once, rows delivered twice as often as they come. ``inherited`` is a table of
    ``inherited_breakers`` of the same frame and span, where one was written already.
    """
    by, order = list(by), order_for(by)
    check_columns(df, [*by, *order, "timestamp", "ok"], "circuit_breaker")
    rows = tagged(settled(df), "timestamp", "ok")
    keys, identity = [*by, SEGMENT], identity_of(by, order)
    sort_keys = _log_order(order)
    more = carried(rows, _slim_columns(by, order), order, span, ADDED)
    if inherited is None:
        inherited, slim = _inherited_breakers(rows, policy, by, order, span, initial)
    else:
        slim = _slim(rows, by, order, span)
    if more:
        slim = _slim(rows, by, order, span, more)
    given = identity if more is None else df.columns
    result_schema = T.StructType(
        [T.StructField(c, slim.schema[c].dataType) for c in given]
        + [
            T.StructField("state_before", T.StringType()),
            T.StructField("state_after", T.StringType()),
            T.StructField("failure_count", T.LongType()),
            T.StructField("success_count", T.LongType()),
            T.StructField("action", T.StringType()),
        ]
    )

    def replay(log: pa.Table, start: pa.Table) -> pa.Table:
        log = log.sort_by(sort_keys)
        done = _replayed(
            Breaker(**start.column("_before")[0].as_py()),
            log.column("ok").to_numpy().astype(bool), micros(log.column("_us")), policy,
        )
        return pa.table(
            {
                **{c: log.column(c) for c in given},
                "state_before": pa.array(STATES).take(pa.array(done["before"])),
                "state_after": pa.array(STATES).take(pa.array(done["after"])),
                "failure_count": pa.array(done["failures"], pa.int64()),
                "success_count": pa.array(done["successes"], pa.int64()),
                "action": pa.array(ACTIONS).take(pa.array(done["action"])),
            }
        )

    log = slim.groupBy(*keys).cogroup(inherited.groupBy(*keys)).applyInArrow(replay, result_schema)
    fatal = ["tripped", "rejected"] + ([] if policy.retry else ["reopened"])
    results = give_back(rows, log, identity) if more is None else log
    return results.withColumn("fatal", F.col("action").isin(fatal))


def _log_order(order: Sequence[str]) -> list[tuple[str, str]]:
    return [(c if c != "timestamp" else "_us", "ascending") for c in [*order, TAG]]


def _slim_columns(by: Sequence[str], order: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*by, *order, "timestamp", "ok", TAG]))


def _slim(df: DataFrame, by: Sequence[str], order: Sequence[str], span: int, more: Sequence[str] = ()) -> DataFrame:
    """What the breaker depends on, and ``more`` columns, cut into segments."""
    columns = [*_slim_columns(by, order), *more]
    return with_segments(df.select(*columns), order, span, by).withColumn("_us", moment_us())


def inherited_breakers(
    df: DataFrame, policy: BreakerPolicy = BreakerPolicy(), span: int = DEFAULT_SPAN, initial: Optional[DataFrame] = None,
) -> DataFrame:
    """Per segment of a (topic, partition): the breaker before and after it (``_before``, ``_after``).

    Written once, it serves both the replay and the state after all rows.
    """
    rows = tagged(settled(df), "timestamp", "ok")
    return _inherited_breakers(rows, policy, list(LOG_KEY), order_for(LOG_KEY), span, initial)[0]


def state_after(inherited: DataFrame, by: Sequence[str] = LOG_KEY) -> DataFrame:
    """The breaker of each key after its last segment: ``state, failures, successes, last``."""
    return inherited.groupBy(*by).agg(F.max_by("_after", SEGMENT).alias("_b")).select(*by, "_b.*")


def _inherited_breakers(df, policy, by, order, span, initial):
    """Per segment: the breaker before it and after it."""
    slim = _slim(df, by, order, span)
    sort_keys = _log_order(order)
    summary_schema = T.StructType(
        [
            *key_fields(slim, by),
            T.StructField("_rows", T.LongType()),
            T.StructField("_lead_fails", T.LongType()),
            T.StructField("_lead_oks", T.LongType()),
            T.StructField("_trips", T.ArrayType(_BREAKER_STRUCT)),
            T.StructField("_resets", _BREAKER_STRUCT),
            T.StructField("_closes", T.ArrayType(_BREAKER_STRUCT)),
            T.StructField("_reopens", _BREAKER_STRUCT),
            T.StructField("_probes", T.ArrayType(_BREAKER_STRUCT)),
            T.StructField("_probe_us", T.ArrayType(T.LongType())),
            T.StructField("_probe_file", T.StringType()),
            T.StructField("_last_probe_us", T.LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    summary_arrow = to_arrow_schema(summary_schema)
    folder = run_dir(df.sparkSession, "breaker")

    def summarise(table: pa.Table) -> pa.Table:
        table = table.sort_by(sort_keys)
        ends = _segment_ends(
            table.column("ok").to_numpy().astype(bool),
            micros(table.column("_us")), policy, folder,
        )
        keys = {c: a[0].as_py() for c, a in key_arrays(table, by).items()}
        return pa.Table.from_pylist([{**keys, **ends}], schema=summary_arrow)

    summaries = slim.groupBy(*by, SEGMENT).applyInArrow(summarise, summary_schema)
    if initial is not None:
        start = initial.select(*by, F.struct(*_BREAKER_STRUCT.fieldNames()).alias("_initial"))
        summaries = summaries.join(start, by, "left")

    def first(row: dict) -> Breaker:
        given = row.get("_initial")
        return Breaker(**given) if given else Breaker()

    def advance(b: Breaker, row: dict):
        after = _inherit_breaker(b, row, policy)
        return {"_before": b._asdict(), "_after": after._asdict()}, after

    inherited = fold_summaries(
        summaries, by, first, advance,
        T.StructType(
            [
                *key_fields(slim, by),
                T.StructField("_before", _BREAKER_STRUCT),
                T.StructField("_after", _BREAKER_STRUCT),
            ]
        ),
    )
    return inherited, slim


def breaker_state(
    df: DataFrame, policy: BreakerPolicy = BreakerPolicy(), by: Sequence[str] = LOG_KEY,
    span: int = DEFAULT_SPAN, initial: Optional[DataFrame] = None,
) -> DataFrame:
    """The breaker of each key after all its rows: ``state, failures, successes, last``."""
    by, order = list(by), order_for(by)
    inherited, _ = _inherited_breakers(tagged(settled(df), "timestamp", "ok"), policy, by, order, span, initial)
    return state_after(inherited, by)


def breaker_summary(log: DataFrame, by: Sequence[str] = LOG_KEY) -> DataFrame:
    """Trips, reopenings, probes, closings, rejected rows and time spent open, per key.

    A key is open from a ``tripped`` or ``reopened`` row to the next ``probe``
    row, or to its last row. Only those state changes are ordered, not the log.
    """
    by, order = list(by), order_for(by)
    check_columns(log, [*by, *order, "timestamp", "action"], "breaker_summary")
    us = F.unix_micros("timestamp")
    action = F.col("action")
    count = lambda name: F.count_if(action == name)
    opened, probed = action.isin("tripped", "reopened"), action == "probe"
    # Openings and probes alternate, so the open spans add up from sums of times.
    return log.groupBy(*by).agg(
        count("tripped").alias("trips"),
        count("reopened").alias("reopenings"),
        count("probe").alias("probes"),
        count("closed").alias("closings"),
        count("rejected").alias("rejected"),
        F.expr(
            # DECIMAL: many epoch microseconds added up do not fit a BIGINT.
            "coalesce(sum(CAST(CASE WHEN action = 'probe' THEN unix_micros(timestamp)"
            " WHEN action IN ('tripped', 'reopened') THEN -unix_micros(timestamp) END"
            " AS DECIMAL(20,0))), 0)"
        ).alias("_closed_us"),
        (F.count_if(opened) - F.count_if(probed)).alias("_open_now"),
        F.max_by(us, F.struct(*order)).alias("_last_us"),
    ).select(
        *by, "trips", "reopenings", "probes", "closings", "rejected",
        F.expr("(_closed_us + _open_now * _last_us) div 1000").alias("open_ms"),
    )
