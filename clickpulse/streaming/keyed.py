"""Streaming operators that keep their own state per key, with event-time timers."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickpulse.schema import SESSION_GAP_MS

# The processors travel whole: the worker that Spark starts beside the driver for them sees no shipped files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Groups that users are dealt to by hash. A call, a timer and the state are a whole group's, and a micro-batch writes
#: the sessions of all users of the groups that it touches: more groups suit far more users, fewer call less often.
USER_GROUPS = 4096


class SessionNumbers(StatefulProcessor):
    """Numbers each user's rows in order of time, once no earlier row can come any more, for a group of users.

    State per group: the rows that the watermark has not passed, one timer at the first of them, and for each user
    the last time, whether it was a purchase, and the session's number. So what grows is the number of users, and
    rows stay no longer than the lateness bound. A call to the state costs as much as hundreds of rows, so a
    frame's rows are one value in it, as JSON text, and so are the sessions of a group. Rows without a user leave
    at once.
    """

    def __init__(self, gap_ms: int, names: tuple[str, str]) -> None:
        self.gap_ms, self.names = gap_ms, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows string")
        self.last = handle.getValueState("last", "sessions string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        firsts = []
        for frame in rows:
            fresh = [*zip(*(frame[c].tolist() for c in ("owner", "event_ms", "event_id", "behavior")))]
            known = [r for r in fresh if r[0] is not None]
            if len(known) < len(fresh):
                nobody = [r for r in fresh if r[0] is None]
                yield self._numbered(nobody, [None] * len(nobody))
            if known:
                self.waiting.appendValue((_text(known),))
                firsts.append(min(r[1] for r in known))
        if firsts:
            self._wake_at(min(firsts))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()  # rows before it are late from now on
        due, left = [], []
        for (rows,) in self.waiting.get():
            for row in json.loads(rows):
                (due if row[1] < passed else left).append(row)
        if left:
            self.waiting.put([(_text(left),)])
            self._wake_at(min(r[1] for r in left), passed)
        else:
            self.waiting.clear()
        if not due:
            return
        due.sort(key=lambda r: (r[0], r[1], r[3] == "buy", r[2] is not None, r[2] or ""))
        stored = self.last.get()
        last = json.loads(stored[0]) if stored else {}
        numbers = []
        for user, ms, _, behavior in due:
            before, bought, number = last.get(user) or (ms, False, 1)
            number += bool(bought or ms - before > self.gap_ms)
            numbers.append(number)
            last[user] = ms, behavior == "buy", number
        self.last.update((_text(last),))
        yield self._numbered(due, numbers)

    def _numbered(self, rows: list, numbers: list) -> pd.DataFrame:
        user, ms, tie, behavior = zip(*rows)
        frame = {self.names[0]: user, self.names[1]: tie, "event_ms": ms, "behavior": behavior}
        return pd.DataFrame(frame | {"session_no": pd.array(numbers, "Int64")})

    def _wake_at(self, ms: int, fired: int = -1) -> None:
        """One timer, right after the first waiting row; those up to ``fired`` are spent but still listed."""
        for timer in list(self.handle.listTimers()):
            if fired < timer <= ms + 1:
                return
            if timer > fired:
                self.handle.deleteTimer(timer)
        self.handle.registerTimer(ms + 1)

    def close(self) -> None:
        pass


def _text(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def sessionize_stream(
    events: DataFrame,
    gap_ms: int = SESSION_GAP_MS,
    *,
    user: str = "userId",
    tie: str = "eventId",
    groups: int = USER_GROUPS,
) -> DataFrame:
    """The rows of :func:`clickpulse.operators.sessions.sessionize` on a stream: a session ends after ``gap_ms``
    without a row, and after a purchase.

    ``events`` has a watermark on ``event_ts``. A row comes out with its number once the watermark has
    passed it. Rows without a user come out at once, with a null number, however late: to the
    watermark their time is null. They are spread over the groups, and read in the same pass as the others.
    """
    nobody = F.col(user).isNull()
    spread = F.when(nobody, F.xxhash64(tie, "event_ts")).otherwise(F.xxhash64(user))
    rows = events.filter(F.col("event_ts").isNotNull()).select(
        F.pmod(spread, F.lit(groups)).alias("users"),
        F.when(~nobody, F.col("event_ts")).alias("event_ts", metadata=events.schema["event_ts"].metadata),
        F.col(user).cast("string").alias("owner"),
        F.unix_millis("event_ts").alias("event_ms"),
        F.col(tie).alias("event_id"),
        F.coalesce("behavior", F.lit("")).alias("behavior"),
    )
    return rows.groupBy("users").transformWithStateInPandas(
        statefulProcessor=SessionNumbers(gap_ms, (user, tie)),
        outputStructType=f"`{user}` string, `{tie}` string, event_ms bigint, behavior string, session_no bigint",
        outputMode="Append",
        timeMode="EventTime",
    )


class Largest(StatefulProcessor):
    """The ``n`` largest counts of a window. All counts of a closed window come in one micro-batch, so they leave at
    once and no state stays; while a group is read, ``n`` rows of it are held."""

    def __init__(self, n: int, ranked: bool) -> None:
        self.n, self.ranked = n, ranked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:
            both = frame[["word", "n"]] if best is None else pd.concat([best, frame[["word", "n"]]])
            best = both.sort_values(["n", "word"], ascending=[False, True]).head(self.n)
        out = pd.DataFrame({"window_end": key[0], "word": best["word"].to_numpy(), "n": best["n"].to_numpy()})
        if self.ranked:
            out.insert(1, "rank", range(1, len(out) + 1))
        yield out

    def close(self) -> None:
        pass


def topn_stream(counts: DataFrame, n: int, *, salts: int = 8) -> DataFrame:
    """``window_end, rank, word, n`` as :func:`clickpulse.operators.ranking.hot_search_topn` gives them, on a stream of
    window counts: one chained query without a writer that ranks. A window's words are cut in ``salts`` groups
    first, of which ``n`` rows each go on."""
    columns = "window_end bigint, word string, n bigint"
    salt = F.pmod(F.xxhash64("word"), F.lit(salts)).alias("salt")
    options = {"outputMode": "Append", "timeMode": "None"}
    some = counts.select("*", salt).groupBy("window_end", "salt").transformWithStateInPandas(Largest(n, False), columns, **options)
    ranked = "window_end bigint, rank int, word string, n bigint"
    return some.groupBy("window_end").transformWithStateInPandas(Largest(n, True), ranked, **options)
