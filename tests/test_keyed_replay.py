"""Replay in keyed state: calls follow buckets, not changes."""

import random

import pandas as pd

from changeflow.operators.replay import replay
from changeflow.streaming import keyed_replay as keyed

COLUMNS = ["change_id", "part", "path", "change_action"]


class Listed(list):
    def appendValue(self, value):
        self.append(value)

    def put(self, values):
        self[:] = values

    def get(self):
        return iter(list(self))


class Mapped(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


class Handle:
    def __init__(self):
        self.timers = set()

    def getMapState(self, *_):
        return Mapped()

    def getListState(self, *_):
        return Listed()

    def registerTimer(self, at):
        self.timers.add(at)


class Now:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_one_timer_settles_all_closed_changes_of_a_bucket(spark):
    rng = random.Random(5)
    actions = ["Add", "Add Copy", "Delete", "Edit", "Replace Copy", "Other"]
    rows = [(c, p, f"p{rng.randint(0, 6)}", rng.choice(actions)) for c in range(1, 201) for p in (1, 2)]
    want = {tuple(r) for r in replay(spark.createDataFrame(rows, keyed.ROWS)).select(*COLUMNS, "allowed").collect()}
    handle, processor = Handle(), keyed.ReplayProcessor()
    processor.init(handle)
    got, calls = set(), 0
    for low, high in ((0, 120), (120, 200)):
        arrived = [r for r in rows if low < r[0] <= high]
        rng.shuffle(arrived)
        # More than one frame per call, as Spark cuts large groups.
        frames = [pd.DataFrame(arrived[i::2], columns=COLUMNS) for i in (0, 1)]
        list(processor.handleInputRows((0,), iter(frames), Now(low * keyed.SECOND)))
        now = Now((high - 1) * keyed.SECOND if high < 200 else 300 * keyed.SECOND)
        for timer in sorted(t for t in handle.timers if t <= now.watermark):
            calls += 1
            for frame in processor.handleExpiredTimer((0,), now, None):
                got |= set(frame.itertuples(index=False, name=None))
            handle.timers.discard(timer)
        if high == 120:
            assert {r[0] for r in got} == set(range(1, 120))
    assert got == want and len(want) == 400
    assert calls <= 3 and not handle.timers
