import datetime as dt

import numpy as np
import pandas as pd
import pytest

from opinlake.operators import timestamps as X

FETCHED = "2025-03-10 12:00:00"
CASES = [
    ("2025-01-02 03:04:05", "Asia/Seoul", "ymd", "2025-01-01T18:04:05Z"),
    ("2025-01-02T03:04:05.678+09:00[Asia/Seoul]", "UTC", "ymd", "2025-01-01T18:04:05Z"),
    ("2025-01-02 03:04 (GMT-5)", "UTC", "ymd", "2025-01-02T08:04:00Z"),
    ("1736173374", "Asia/Tokyo", "ymd", "2025-01-06T14:22:54Z"),
    ("1736173374123", "Asia/Tokyo", "ymd", "2025-01-06T14:22:54Z"),
    ("03/09/2025 2:34 AM", "America/New_York", "mdy", ""),
    ("26.10.2025 02:30", "Europe/Berlin", "dmy", ""),
    ("26.10.2025 03:30", "Europe/Berlin", "dmy", "2025-10-26T02:30:00Z"),
    ("2025년 1월 2일 오전 12시 5분", "Asia/Seoul", "ymd", "2025-01-01T15:05:00Z"),
    ("Apr 1, 2024 1:21 pm", "Europe/London", "dmy", "2024-04-01T12:21:00Z"),
    ("Thu, 24 Oct 2024 23:31:31 +0100", "UTC", "ymd", "2024-10-24T22:31:31Z"),
    ("25.03.09 18:19", "Asia/Seoul", "ymd", "2025-03-09T09:19:00Z"),
    ("2025-02-30 10:00:00", "UTC", "ymd", ""),
    ("20251217", "UTC", "ymd", "2025-12-17T00:00:00Z"),
    ("tbd", "UTC", "ymd", ""), ("25:71", "UTC", "ymd", ""), ("[object Object]", "UTC", "ymd", ""), ("x" * 5000, "UTC", "ymd", ""),
]
PARTIAL = [
    ("3시간 전", "Asia/Seoul", "ymd", "2025-03-10T09:00:00Z"), ("2 days ago", "UTC", "ymd", "2025-03-08T12:00:00Z"), ("16分前", "UTC", "ymd", "2025-03-10T11:44:00Z"),
    ("21:42", "Asia/Seoul", "ymd", "2025-03-09T12:42:00Z"), ("20:42", "Asia/Seoul", "ymd", "2025-03-10T11:42:00Z"), ("08.02 22:22:19", "Asia/Seoul", "ymd", "2024-08-02T13:22:19Z"), ("2/12 15:11", "Europe/Madrid", "dmy", "2024-12-02T14:11:00Z"),
]


@pytest.mark.parametrize(("rows", "partial"), [(CASES, False), (PARTIAL, True)])
def test_vectors(rows, partial):
    v, z, o, want = map(list, zip(*rows))
    got = X.normalise_batch(pd.Series(v), pd.Series(z), pd.Series(o), pd.Series(pd.to_datetime([FETCHED] * len(v))), partial)
    assert list(got) == want


def test_against_zoneinfo():
    """Local times of several zones against the standard library."""
    from zoneinfo import ZoneInfo

    r = np.random.default_rng(0)
    for zone in ("America/New_York", "Europe/Madrid", "Asia/Seoul"):
        local = r.integers(1_700_000_000, 1_780_000_000, 3000)
        utc, n = X.local_to_utc(local, zone)
        z = ZoneInfo(zone)
        for s, u, k in zip(local.tolist(), utc.tolist(), n.tolist()):
            naive = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
            both = {int(naive.replace(tzinfo=z, fold=f).timestamp()) for f in (0, 1)}
            real = {x for x in both if dt.datetime.fromtimestamp(x, dt.timezone.utc).astimezone(z).replace(tzinfo=None) == naive}
            assert k == len(real)
            assert k != 1 or u in real


def test_frame(spark):
    src = spark.createDataFrame([("a", "Asia/Seoul", "ymd")], "source string, home_zone string, date_order string")
    schema = "tbl string, row_key long, field string, source string, value string, fetched_at timestamp_ntz, partial boolean, home_zone string"
    rows = [("t", 1, "f", "a", "2025-01-02 03:04:05", None, False, "clash"), ("t", 2, "f", "a", None, None, False, None), ("t", 3, "f", "a", "  ", None, False, None), ("t", 4, "f", "a", "2025-01-02T03:04:05Z", None, False, None), ("t", 5, "f", "nowhere", "2025-01-02 03:04:05", None, False, None), ("t", 6, "f", "a", "5분 전", None, True, None), ("t", 7, "f", None, "2025-13-02T03:04:05Z", None, False, None)]
    got = {r["row_key"]: r["instant_utc"] for r in X.normalise(spark.createDataFrame(rows, schema).drop("home_zone"), src).collect()}
    assert got == {1: "2025-01-01T18:04:05Z", 5: "", 6: "", 7: ""}
    assert X.normalise(spark.createDataFrame([], schema), src).count() == 0


def test_zone_tables_before_1970():
    """Old offsets are those of their time, not of 1970; the tables say where they come from."""
    from zoneinfo import ZoneInfo

    for zone, when in (("America/New_York", dt.datetime(1944, 6, 6, 12)), ("Asia/Seoul", dt.datetime(1957, 1, 15, 12)), ("Europe/Berlin", dt.datetime(1916, 7, 1, 12))):
        local = int(when.replace(tzinfo=dt.timezone.utc).timestamp())
        got, n = X.local_to_utc(np.array([local]), zone)
        assert got[0] == int(when.replace(tzinfo=ZoneInfo(zone)).timestamp()) and n[0] == 1
    assert len(X.zone_database_version()) > 4
