from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest

from ledgerloom.operators import instants

SITES = [("S01", "America/Chicago", "MDY"), ("S03", "Europe/London", "DMY"), ("S04", "Europe/Berlin", "DMY"), ("S05", "Europe/Madrid", "DMY"), ("S07", "Asia/Tokyo", "YMD")]
CASES = [
    ("2026-08-18 14:14", "S01", "2026-08-18T19:14:00Z"),
    ("Tuesday, August 18, 2026 2:14 PM", "S01", "2026-08-18T19:14:00Z"),
    ("Tuesday, August 18, 2026 2:14 PM (CDT)", "S01", "2026-08-18T19:14:00Z"),
    ("Mon, 17 Aug 2026 09:02:11 -0500", "S03", "2026-08-17T14:02:11Z"),
    ("8/18/2026 2:14 PM", "S01", "2026-08-18T19:14:00Z"),
    ("18/08/26 14:14", "S03", "2026-08-18T13:14:00Z"),
    ("2021/05/03 13:23", "S07", "2021-05-03T04:23:00Z"),
    ("19 Nov 2019 12:19:14 GMT", "S01", "2019-11-19T12:19:14Z"),
    ("11 de diciembre de 2020, 17:28", "S05", "2020-12-11T16:28:00Z"),
    ("28. März 2021, 1:41 Uhr", "S04", "2021-03-28T00:41:00Z"),
    ("18. September 2024, 23:18 MESZ", "S04", "2024-09-18T21:18:00Z"),
    ("21-Jul-2023 02:39 GMT-05:00", "S03", "2023-07-21T07:39:00Z"),
    ("2019-05-10t10:54:53-05", "S01", "2019-05-10T15:54:53Z"),
    ("  2025-03-25T22:46+0000 ", "S03", "2025-03-25T22:46:00Z"),
    ("2020-09-21 18:51:44,558", "S07", "2020-09-21T09:51:44Z"),
    ("20251118T131425Z", "S04", "2025-11-18T13:14:25Z"),
    ("20240502103441", "S01", "2024-05-02T15:34:41Z"),
    ("1670552537", "S01", "2022-12-09T02:22:17Z"),
    ("1705095858959", "S01", "2024-01-12T21:44:18Z"),
    ("Sent: TUESDAY 16 MAY 2023 02:15:32", "S03", "2023-05-16T01:15:32Z"),
    ("August 18, 2026", "S01", "2026-08-18T05:00:00Z"),
    ("Nov 1, 2020, 1:28:02 am CST", "S01", "2020-11-01T07:28:02Z"),
    # an hour that occurs twice, and one that never does
    ("2020-11-01 01:30", "S01", "2020-11-01T06:30:00Z"),
    ("2021-03-14 02:30", "S01", "2021-03-14T08:30:00Z"),
    *[(v, "S01", None) for v in ("", "n/a", None, "sometime last week", "0000-00-00 00:00:00", "2026-02-30 10:00", "Q3", "2026-01-01 25:00", "13/13/2026 1:00 PM", "2026-01-01 10:00 XYZT")],
    ("2026-08-18 14:14", "S99", None),
]


@pytest.fixture(scope="module")
def sites(spark):
    return spark.createDataFrame(SITES, "site_id string, time_zone string, date_order string")


def test_values(spark, sites):
    rows = [(f"r{k}", v, s) for k, (v, s, _) in enumerate(CASES)]
    values = spark.createDataFrame(rows * 2, "record_id string, value string, site_id string")
    found = {r["record_id"]: r["instant"] for r in instants.to_instants(values, sites).collect()}
    assert found == {f"r{k}": want for k, (_, _, want) in enumerate(CASES) if want}


def test_transitions_against_zoneinfo(spark, sites):
    rows = []
    for site, zone, _ in SITES:
        for days in range(0, 3000, 13):
            local = datetime(2018, 1, 1) + timedelta(days=days, minutes=days * 37 % 1440)
            want = local.replace(tzinfo=ZoneInfo(zone), fold=0).astimezone(ZoneInfo("UTC"))
            rows.append((f"{site}-{days}", local.strftime("%Y-%m-%d %H:%M:%S"), site, want.strftime("%Y-%m-%dT%H:%M:%SZ")))
    values = spark.createDataFrame([r[:3] for r in rows], "record_id string, value string, site_id string")
    found = {r["record_id"]: r["instant"] for r in instants.to_instants(values, sites).collect()}
    assert found == {r[0]: r[3] for r in rows}


def test_empty(spark, sites):
    assert instants.to_instants(spark.createDataFrame([], "record_id string, value string, site_id string"), sites).count() == 0
