"""The life of a request, kept in the state of a stream.

Requests and the answers to them arrive as rows ``(id, kind, attempt, status, body, at)``; ``at``
is when the row was recorded, so it grows, but for the lateness declared. Per id the
stream keeps a state, the number of the attempt and a deadline, and gives a row for every
change:

``pending``   an attempt is to be fetched (the rows of this state are the manifest)
``landed``    an answer with status 200 came; its body goes along. Final
``failed``    the attempt was answered otherwise, or not in time; the next one is due later
``given up``  the last attempt failed. Final, but for a 200 that still comes

Every failure doubles the delay before the next attempt. A repeated request, a second 200, and
a failure of an attempt that is no longer the current one change nothing. The state lies
in the stream's checkpoint, so it survives a restart; timers are event-time timers, so a
replay gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "id long, kind string, attempt int, status int, body string, at timestamp"      # kind: request, answer
CHANGES = "id long, state string, attempt int, status int, body string, at timestamp"
HELD = "state string, attempt int, due long"
PENDING, LANDED, FAILED, GIVEN_UP = "pending", "landed", "failed", "given up"


def life_cycle(events: DataFrame, most_attempts: int = 3, answer_within: int = 60, retry_after: int = 60,
               lateness: str = "1 minute") -> DataFrame:
    """The changes of state of every request (``CHANGES``) in a stream of ``EVENTS``; times in seconds."""
    wait, delay = 1000 * answer_within, 1000 * retry_after

    def step(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        state, attempt, due = held.get if held.exists else (None, 0, 0)

        def give(now, status=None, body=None):
            out.append((key[0], state, attempt, status, body, pd.Timestamp(now, unit="ms")))

        def fail(now, status=None):
            nonlocal state, due
            state = GIVEN_UP if attempt >= most_attempts else FAILED
            due = now + delay * 2 ** (attempt - 1)
            give(now, status)

        def attempt_again(now):
            nonlocal state, attempt, due
            state, attempt, due = PENDING, attempt + 1, now + wait
            give(now)

        if held.hasTimedOut:
            now = max(due, held.getCurrentWatermarkMs())
            if state == PENDING:
                fail(now)
            elif state == FAILED:
                attempt_again(now)
        else:
            rows = pd.concat(list(batches)).sort_values(["at", "kind"], ascending=[True, False], kind="stable")
            for kind, of, status, body, at in zip(rows.kind, rows.attempt, rows.status, rows.body, rows["at"]):
                now = at.value // 1_000_000
                status = None if pd.isna(status) else int(status)
                if kind == "request" and state is None:
                    attempt_again(now)
                elif kind == "answer" and status == 200 and state != LANDED:
                    state = LANDED
                    give(now, status, None if pd.isna(body) else body)
                elif kind == "answer" and status != 200 and state == PENDING and (pd.isna(of) or int(of) == attempt):
                    fail(now, status)
        if state is not None:
            held.update((state, attempt, due))
            if state in (PENDING, FAILED):
                held.setTimeoutTimestamp(max(due, held.getCurrentWatermarkMs() + 1))
        if out:
            frame = pd.DataFrame(out, columns=["id", "state", "attempt", "status", "body", "at"])
            frame["status"] = frame["status"].astype("Int32")
            yield frame

    return (events.where("id IS NOT NULL AND at IS NOT NULL").withWatermark("at", lateness).groupBy("id")
            .applyInPandasWithState(step, CHANGES, HELD, "append", GroupStateTimeout.EventTimeTimeout))


def start(spark: SparkSession, source_dir: str, changes_path: str, checkpoint: str, fmt: str = "parquet",
          max_files_per_trigger: int | None = None, **options) -> StreamingQuery:
    """Follow a folder of ``EVENTS``; every micro-batch's changes go to a folder of their own
    (``batch_id=<n>``, overwritten by a replay). Drains what is there, then stops."""
    reader = spark.readStream.schema(EVENTS).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changes = life_cycle(reader.load(source_dir), **options)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes_path}/batch_id={number}")

    return (changes.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def latest(changes: DataFrame) -> DataFrame:
    """The state of every request now: the change of the latest time, of the highest attempt."""
    rank = F.create_map(*[F.lit(x) for pair in ((PENDING, 0), (FAILED, 1), (GIVEN_UP, 2), (LANDED, 3)) for x in pair])
    newest = F.max_by(F.struct("state", "attempt", "status", "body", "at"),
                      F.struct("at", "attempt", F.element_at(rank, F.col("state"))))
    return changes.groupBy("id").agg(newest.alias("x")).select("id", "x.*")
