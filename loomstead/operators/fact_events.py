"""Mixed sequences of added facts and endings, applied as if one by one.

Whether an event takes effect depends on the open facts its key has at that moment, so a key's
events must be followed in order, yet one key may hold a large part of them. The events are
therefore cut by their rank in ``seq`` order into chunks of bounded size, whatever their keys:

1. each chunk is summed up, per key, as a function from the state on entry to the state on exit;
2. such functions compose, so ``FAN_IN`` consecutive chunks of a key become one function, level
   by level, until a key has few enough left to be followed in one go from what is stored;
3. going down the levels again, each group of chunks is followed from its own entry state, so
   that every chunk knows its own, and no task ever follows more than ``FAN_IN`` chunks of a key;
4. each chunk is replayed from its entry state.

The state of a key is what its events can tell apart: the least id and the latest start among its
open facts. An event adds a fact only where none is open, and an ending that takes effect closes
all of them, so more than one can be open only in what was stored before.
"""

from bisect import bisect_left
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import end_key, malformed, start_key
from ..schemas import TRIPLE_SCHEMA
from ..session import join_per_key, written
from .fact_writes import (
    FACT_ERROR,
    KEY,
    FactWrite,
    _filled,
    _open_per_key,
    add_mentioned,
    fact_id_sql,
    inserted_facts,
    keyed,
)

# Most events of a chunk, and most chunks of a key that one task follows.
CHUNK_SPAN = 10_000
FAN_IN = 64

OPEN, CLOSED, END = "open", "closed", "end"


class Open(NamedTuple):
    """The open facts of a key: the least id, the latest start. An unknown start sorts before
    every ending."""

    id: str
    start: str


def follow(events, state):
    """Replay (kind, fact id, time key) triples of one key from ``state``: the outcome of
    each as (status, fact id), and the state after the last."""
    outcomes = []
    for kind, new_id, at in events:
        if kind == END:
            if state is None:
                outcomes.append(("nothing open", None))
            elif at < state.start:
                outcomes.append(("rejected", None))
            else:
                outcomes.append(("closed", state.id))
                state = None
        elif state is not None:
            outcomes.append(("existing", state.id))
        else:
            outcomes.append(("inserted", new_id))
            if kind == OPEN:
                state = Open(new_id, at)
    return outcomes, state


def summarize(events):
    """The exit state for every entry state: (exit from none, [(bar, exit), ...]), where an
    open fact on entry leaves by the first bar not below its start, or else stays."""
    after = None  # exit state when nothing is open just before the current event
    bars, exits = [], []  # endings ahead that an open fact can meet first, nearest last
    for kind, new_id, at in reversed(events):
        if kind == END:
            while bars and bars[-1] <= at:
                bars.pop(), exits.pop()
            bars.append(at), exits.append(after)
        elif kind == OPEN:
            met = _first_bar(bars, at)
            after = Open(new_id, at) if met is None else exits[met]
    steps = []
    for bar, out in zip(reversed(bars), reversed(exits)):
        if steps and steps[-1][1] == out:
            steps[-1] = (bar, out)
        else:
            steps.append((bar, out))
    return after, steps


def _first_bar(bars, start):
    """Index of the nearest ending at or after ``start``; ``bars`` decreases along the list."""
    low, high = 0, len(bars)
    while low < high:
        middle = (low + high) // 2
        if bars[middle] >= start:
            low = middle + 1
        else:
            high = middle
    return low - 1 if low else None


def chain(summary, state):
    from_none, steps = summary
    if state is None:
        return from_none
    at = bisect_left([bar for bar, _ in steps], state.start)
    return state if at == len(steps) else steps[at][1]


def compose(first, then):
    """The summary of two stretches of events, one after the other."""
    from_none, steps = first
    joined = []
    for bar, out in steps:
        out = chain(then, out)
        if joined and joined[-1][1] == out:
            joined[-1] = (bar, out)
        else:
            joined.append((bar, out))
    # a state that meets no ending of the first stretch enters the second one unchanged
    last = steps[-1][0] if steps else None
    for bar, out in then[1]:
        if last is None or bar > last:
            if joined and joined[-1][1] == out:
                joined[-1] = (bar, out)
            else:
                joined.append((bar, out))
    return chain(then, from_none), joined


_STATE = "STRUCT<id: STRING, start: STRING>"
_SUMMARY = f"chunk LONG, key STRING, none {_STATE}, steps ARRAY<STRUCT<bar: STRING, out: {_STATE}>>"


def _pack(state):
    return None if state is None else {"id": state.id, "start": state.start}


def _unpack(value):
    return None if value is None else Open(value["id"], value["start"])


def _per_key(events: pd.DataFrame):
    """(key, seqs, events) for each key, its events in order."""
    rows = sorted(zip(*(events[c] for c in ("key", "seq", "kind", "id", "at"))), key=itemgetter(0, 1))
    for key, group in groupby(rows, key=itemgetter(0)):
        _, seqs, *columns = zip(*group)
        yield key, seqs, list(zip(*columns))


def _summarize_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    chunk = pdf["chunk"].iloc[0]
    rows = [(chunk, key, *_rows_of(summarize(events))) for key, _, events in _per_key(pdf)]
    return pd.DataFrame(rows, columns=["chunk", "key", "none", "steps"])


def _rows_of(summary):
    none, steps = summary
    return _pack(none), [{"bar": b, "out": _pack(o)} for b, o in steps]


def _summary_of(row):
    return _unpack(row.none), [(s["bar"], _unpack(s["out"])) for s in row.steps]


def _compose_sorted(batches):
    """Summaries sorted by key, block and chunk -> one summary for each block of a key."""
    at, summary = None, None
    for pdf in batches:
        rows = []
        for row in pdf.itertuples(index=False):
            if (row.key, row.block) == at:
                summary = compose(summary, _summary_of(row))
                continue
            if at:
                rows.append((at[1], at[0], *_rows_of(summary)))
            at, summary = (row.key, row.block), _summary_of(row)
        yield pd.DataFrame(rows, columns=["chunk", "key", "none", "steps"])
    if at:
        yield pd.DataFrame([(at[1], at[0], *_rows_of(summary))], columns=["chunk", "key", "none", "steps"])


def _chain_sorted(batches):
    """Summaries sorted by key, block and chunk, each with the state its block is entered with
    -> the entry state of each; only the state of the block in hand is kept."""
    at, state = None, None
    for pdf in batches:
        rows = []
        for row in pdf.itertuples(index=False):
            if (row.key, row.block) != at:
                at, state = (row.key, row.block), _unpack(row.entered)
            if state is not None:
                rows.append((row.chunk, row.key, state.id, state.start))
            state = chain(_summary_of(row), state)
        yield pd.DataFrame(rows, columns=["chunk", "key", "open_id", "open_start"])


_ENTRY = "chunk LONG, key STRING, open_id STRING, open_start STRING"


def _blocks(summaries: DataFrame, width: int) -> DataFrame:
    return summaries.withColumn("block", F.floor(F.col("chunk") / width))


def _ordered(summaries: DataFrame) -> DataFrame:
    return summaries.repartition("key", "block").sortWithinPartitions("key", "block", "chunk")


def entry_states(summaries: DataFrame, stored: DataFrame, chunks: int, fan_in: int = FAN_IN) -> DataFrame:
    """(chunk, key, open_id, open_start): the state with which each chunk is entered, where any
    fact is open. ``summaries`` number the chunks 0 to ``chunks - 1``; ``stored`` has the state
    before the first."""
    # with one level only, the summaries are read once
    levels = [summaries if chunks <= fan_in else written(summaries)]
    while chunks > fan_in:
        up = _ordered(_blocks(levels[-1], fan_in)).mapInPandas(_compose_sorted, _SUMMARY)
        levels.append(written(up))
        chunks = -(-chunks // fan_in)
    entries = stored.select("key", F.lit(0).cast("long").alias("block"), F.col("stored").alias("entered"))
    for level in reversed(levels):
        # on the top level all chunks of a key are one block, entered with what is stored
        blocks = _blocks(level, fan_in if level is not levels[-1] else chunks + 1)
        found = _ordered(join_per_key(blocks, entries, ["key", "block"], "left")).mapInPandas(_chain_sorted, _ENTRY)
        entries = found.select("key", F.col("chunk").alias("block"), F.struct(F.col("open_id").alias("id"), F.col("open_start").alias("start")).alias("entered"))
    return found


def chunked(events: DataFrame, span: int = CHUNK_SPAN) -> tuple[DataFrame, int]:
    """The events with ``chunk``, numbered in the order of ``seq`` and of at most ``span`` rows
    each, and the number of chunks. Ranges of ``seq`` are sorted apart from each other; only
    their sizes come to the driver, so gaps between values cost nothing."""
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = events.repartitionByRange(parts, "seq").sortWithinPartitions("seq")
    # this id is the partition in the upper bits and the row's number in it in the lower 33
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, first = 0, {}
    for row in sorted(sizes):
        first[row.part] = before
        before += -(-row.n // span)
    starts = events.sparkSession.createDataFrame(sorted(first.items()), "part long, first long")
    numbered = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    chunk = F.col("first") + F.floor(F.col("_place").bitwiseAND(2**33 - 1) / span)
    return numbered.withColumn("chunk", chunk).drop("part", "first", "_place"), before


def _replay_chunk(events: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    entry = {e.key: Open(e.open_id, e.open_start) for e in entries.itertuples(index=False)}
    rows = []
    for key, seqs, events_of_key in _per_key(events):
        outcomes, _ = follow(events_of_key, entry.get(key))
        rows.extend((seq, *outcome) for seq, outcome in zip(seqs, outcomes))
    return pd.DataFrame(rows, columns=["seq", "status", "fact_id"])


def _key_text():
    return F.to_json(F.array(*[F.col(c) for c in KEY]))


def _open_states(triples: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, stored) for the given keys that have open facts."""
    start = F.coalesce(start_key("valid_from"), F.lit(""))
    found = _open_per_key(triples, keys).select(_key_text().alias("key"), "id", start.alias("start"))
    state = F.struct(F.min("id").alias("id"), F.max("start").alias("start"))
    return found.groupBy("key").agg(state.alias("stored"))


def judged_events(triples: DataFrame, events: DataFrame, id_salt: str, span: int = CHUNK_SPAN, fan_in: int = FAN_IN) -> DataFrame:
    """The events with ``status``, ``fact_id`` and ``reason``. ``events`` has ``seq`` (unique
    long), ``kind`` (add or end), the names of the key, and the fact's columns or ``ended``."""
    again = events.groupBy("seq").agg(F.count("*").alias("_times")).filter("_times > 1")
    # read by the sampling of ranges, the chunks and the final join
    rows = written(_filled(keyed(events)).join(again, "seq", "left").selectExpr(
        "*",
        f"""CASE WHEN seq IS NULL THEN 'seq is missing' WHEN _times > 1 THEN 'seq is repeated'
            WHEN kind IS NULL OR kind NOT IN ('add', 'end') THEN 'kind is neither add nor end'
            WHEN kind = 'end' THEN CASE WHEN ended IS NULL OR {malformed('ended')}
            THEN 'ended is not an ISO date or date-time' END ELSE {FACT_ERROR} END AS reason""",
        f"CASE WHEN kind = 'add' THEN {fact_id_sql(id_salt)} END AS id",
    ).drop("_times"))
    start = F.coalesce(start_key("valid_from"), F.lit(""))
    slim, chunks = chunked(
        rows.filter("reason IS NULL").select(
            "seq",
            _key_text().alias("key"),
            F.expr(f"CASE WHEN kind = 'end' THEN '{END}' WHEN valid_to IS NULL THEN '{OPEN}' ELSE '{CLOSED}' END AS kind"),
            "id",
            F.when(F.col("kind") == "end", end_key("ended")).otherwise(start).alias("at"),
        ),
        span,
    )
    stored = _open_states(triples, rows.filter("reason IS NULL").select(KEY).distinct())
    summaries = slim.groupBy("chunk").applyInPandas(_summarize_chunk, _SUMMARY)
    entries = entry_states(summaries, stored, chunks, fan_in)
    outcomes = (
        slim.groupBy("chunk")
        .cogroup(entries.groupBy("chunk"))
        .applyInPandas(_replay_chunk, "seq LONG, status STRING, fact_id STRING")
    )
    late = "CASE WHEN status = 'rejected' THEN 'the interval ends before it starts' END"
    judged = {"status": F.expr("coalesce(status, 'rejected')"), "reason": F.expr(f"coalesce(reason, {late})")}
    return rows.join(outcomes, "seq", "left").withColumns(judged).drop("id")


def changes(triples: DataFrame, judgement: DataFrame, batch_ts) -> tuple[DataFrame, DataFrame]:
    """What judged events do to the facts: the new ones, ended where an event ends them, and
    (key, _ended) for the keys whose stored open facts all end.

    An ending names the least id of its key's open facts, and closes all of them.
    """
    closings = judgement.filter("status = 'closed'").select(F.col("fact_id").alias("_closed"), F.col("ended").alias("_ended"))
    new = inserted_facts(judgement, batch_ts).join(closings, F.col("id") == F.col("_closed"), "left")
    ended = F.coalesce("valid_to", "_ended").alias("valid_to")
    new = new.select(*[ended if c == "valid_to" else c for c in TRIPLE_SCHEMA.names])
    stored = _open_states(triples, judgement.filter("status = 'closed'").select(KEY).distinct())
    stored = stored.select("key", F.col("stored.id").alias("_closed")).join(closings, "_closed")
    return new, stored.select("key", "_ended")


def with_endings(triples: DataFrame, ended: DataFrame, how: str = "left") -> DataFrame:
    """Open facts with the endings of their keys; with ``how`` inner only those that end."""
    found = join_per_key(triples.withColumn("key", _key_text()), ended, ["key"], how)
    return found.withColumn("valid_to", F.col("_ended")).select(TRIPLE_SCHEMA.names)


def apply_events(
    entities: DataFrame,
    triples: DataFrame,
    events: DataFrame,
    batch_ts: str,
    span: int = CHUNK_SPAN,
    id_salt: str | None = None,
    fan_in: int = FAN_IN,
) -> FactWrite:
    """Apply added facts and endings in ``seq`` order. Fact ids are made from ``id_salt``, by
    default ``batch_ts``. The judgement is made once and kept in the shared folder; the tables
    that come of it are plans."""
    judgement = written(judged_events(triples, events, id_salt or batch_ts, span, fan_in))
    added = judgement.filter("kind = 'add' AND status IN ('inserted', 'existing')")
    new, ended = changes(triples, judgement, batch_ts)
    finished = triples.filter("valid_to IS NOT NULL").select(TRIPLE_SCHEMA.names)
    still = with_endings(triples.filter("valid_to IS NULL"), ended)
    return FactWrite(
        add_mentioned(entities, added, batch_ts),
        finished.unionByName(still).unionByName(new),
        judgement.select("seq", "kind", "status", "fact_id", "reason"),
    )
