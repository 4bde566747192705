"""The stateful processor's cost a call, and how a streamed run is cut into micro-batches."""

from pyspark.sql import Row

from tsquality.config import QualityConfig
from tsquality.plans import catalog
from tsquality.streaming.processor import CHUNK, OUTPUT_COLUMNS, MeterProcessor

HOUR = 3_600_000_000


class Store:
    """A meter's state and timers; what is asked of them is noted."""

    def __init__(self):
        self.asked, self.value = [], None

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.asked.append("get")
        return self.value

    def update(self, value):
        self.asked.append("update")
        self.value = value

    def registerTimer(self, at):
        self.asked.append("register")

    def deleteTimer(self, at):
        self.asked.append("delete")


class Watermark:
    def getCurrentWatermarkInMs(self):
        return 0


def test_a_call_asks_the_store_four_times_and_gives_a_row_a_route():
    store, p = Store(), MeterProcessor(QualityConfig(interval_minutes=60))
    p.init(store)
    n = CHUNK + 500
    reading = Row("_key", "seq", "ts_us", "arrival_us", "consumption_kwh", "bucket", "wm_us", "pred_wm_us")
    for start in (0, n):
        rows = [reading("m", k if k % 7 else None, 3 * k * HOUR, 3 * k * HOUR, 1.5, k, 3 * (k - 1) * HOUR, 3 * (k - 2) * HOUR)
                for k in range(start, start + n)]
        store.asked.clear()
        out = list(p.handleInputRows(("m",), iter(rows), Watermark()))
        assert len(store.asked) <= 4 and len(out) <= 4
        got = next(dict(zip(OUTPUT_COLUMNS, r)) for r in out if r.route == "validated")
        assert list(got["ts_us"]) == [r.ts_us for r in rows] and list(got["seq"]) == [r.seq for r in rows]
        assert got["missing_to_us"] == [] and got["error"] == []
    assert store.value[0] == 3 * (2 * n - 1) * HOUR


def test_more_messages_make_larger_micro_batches_not_more():
    for n in (0, 9_000, 100_000, 600_000, 6_000_000, 20_000_000):
        assert -(-n // catalog.stream_rows(n)) <= 4
    assert catalog.stream_rows(10 ** 9) <= 5_000_000 and catalog.stream_rows(9_000) == 5_000
