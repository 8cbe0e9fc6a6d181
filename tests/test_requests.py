"""The life cycle of requests: late, repeated and failing answers, timers, restarts."""

import datetime as dt

from nestrel.streaming import requests as RQ

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def ask(i, s):
    return (i, "request", None, None, None, at(s))


def answer(i, s, status, attempt=1, body=None):
    return (i, "answer", attempt, status, body, at(s))


# each list is one file and one micro-batch; id 0 only moves the clock on
FILES = [
    [ask(1, 0), ask(2, 0), ask(3, 0), ask(4, 1), ask(5, 1), ask(1, 2), (None, "request", None, None, None, at(0))],
    [answer(1, 5, 200, body="one"), answer(1, 6, 200, body="again"), answer(2, 5, 500), answer(4, 6, 404)],
    [ask(0, 40)],                        # 2 and 4 are due again (10 s after their failures); 3 and 5 are out of time (30 s)
    [answer(3, 45, 500), answer(2, 46, 200, 2, "two"), answer(5, 47, 200, 1, "late")],
    [ask(0, 120)], [ask(0, 200)], [ask(0, 300)], [ask(0, 400)], [ask(0, 500)],
    [answer(4, 510, 200, 3, "at last"), answer(3, 511, 404, 1), answer(2, 512, 500, 2)],
]


def run(spark, scratch, restart):
    for n, rows in enumerate(FILES):
        spark.createDataFrame(rows, RQ.EVENTS).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        if restart or n == len(FILES) - 1:
            RQ.start(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/check", max_files_per_trigger=1,
                     most_attempts=3, answer_within=30, retry_after=10, lateness="0 seconds").awaitTermination()
    return spark.read.schema(RQ.CHANGES).parquet(f"{scratch}/out")


def test_requests_are_followed_through_restarts(spark, scratch):
    changes = run(spark, scratch, restart=True)
    rows = changes.where("id > 0").orderBy("id", "at").collect()
    of = {i: [(r.state, r.attempt) for r in rows if r.id == i] for i in range(1, 6)}
    assert of[1] == [("pending", 1), ("landed", 1)]                               # the second 200 changes nothing
    assert of[2] == [("pending", 1), ("failed", 1), ("pending", 2), ("landed", 2)]
    # 3 is never answered in time, and its 500 came when that attempt was over
    assert of[3] == [("pending", 1), ("failed", 1), ("pending", 2), ("failed", 2), ("pending", 3), ("given up", 3)]
    assert of[4][:3] == [("pending", 1), ("failed", 1), ("pending", 2)] and of[4][-2:] == [("given up", 3), ("landed", 3)]
    assert of[5] == [("pending", 1), ("failed", 1), ("landed", 1)]                # an answer after the deadline still lands
    bodies = {r.id: r.body for r in rows if r.state == "landed"}
    assert bodies == {1: "one", 2: "two", 4: "at last", 5: "late"}
    now = {r.id: (r.state, r.attempt) for r in RQ.latest(changes).where("id > 0").collect()}
    assert now == {1: ("landed", 1), 2: ("landed", 2), 3: ("given up", 3), 4: ("landed", 3), 5: ("landed", 1)}
