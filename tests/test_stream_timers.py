"""Timers of the ordered change log, without a stream."""

import datetime as dt

import pandas as pd

from regwatch.streaming import twins


class Value:
    def __init__(self):
        self.x = None

    exists = lambda self: self.x is not None
    get = lambda self: self.x

    def update(self, x):
        self.x = x


class Rows(Value):
    def put(self, x):
        self.x = list(x)

    def appendList(self, x):
        self.x = [*(self.x or []), *x]

    def clear(self):
        self.x = None


class Handle:
    def __init__(self):
        self.timers = []

    getValueState = lambda self, *a: Value()
    getListState = lambda self, *a: Rows()

    def registerTimer(self, at):
        self.timers.append(at)


class Time:
    def __init__(self, at):
        self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at


def test_a_key_of_many_days_takes_one_timer():
    handle, held = Handle(), twins._InOrder()
    held.init(handle)
    days = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(20)]
    frame = pd.DataFrame({"day": days[::-1], "fingerprint": [str(k // 2) for k in range(20)][::-1], "kept": [str(k) for k in range(20)][::-1]})
    assert list(held.handleInputRows(("k",), iter([frame]), None)) == []
    assert handle.timers == [twins._millis(days[0])]
    first, mark = Time(handle.timers[0]), Time(twins._millis(days[9]))
    (out,) = held.handleExpiredTimer(("k",), mark, first)
    assert list(out["kept"]) == ["0", "2", "4", "6", "8"]
    assert handle.timers[1:] == [twins._millis(days[10])]
    (out,) = held.handleExpiredTimer(("k",), Time(twins._millis(days[19])), Time(handle.timers[1]))
    assert list(out["kept"]) == ["10", "12", "14", "16", "18"] and len(handle.timers) == 2
