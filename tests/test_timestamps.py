from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from veredas.operators.timestamps import interpretations, normalise_timestamps, viterbi


def utc(*args):
    return int((datetime(*args) - datetime(1970, 1, 1)) / timedelta(microseconds=1))


@pytest.mark.parametrize(
    ("text", "zone", "order", "want"),
    [
        ("2025-10-03T16:39:44", "America/Bogota", "dmy", utc(2025, 10, 3, 21, 39, 44)),
        ("2025-10-06T23:34:03Z", "America/Bogota", "dmy", utc(2025, 10, 6, 23, 34, 3)),
        ("29/09/2025 06:50", "UTC", "dmy", utc(2025, 9, 29, 6, 50)),
        ("09/05/2025 5:00 PM", "UTC", "mdy", utc(2025, 9, 5, 17)),
        ("10/04/2025 12:38 AM", "UTC", "mdy", utc(2025, 10, 4, 0, 38)),
        ("05.10.2025 19:18", "UTC", "mdy", utc(2025, 10, 5, 19, 18)),
        ("1759533824", "America/Bogota", "dmy", 1759533824 * 10**6),
        ("1759669262776", None, None, 1759669262776 * 1000),
        ("2025-09-25T16:43:15.923091352Z", None, None, utc(2025, 9, 25, 16, 43, 15, 923091)),
        ("2025-10-03 21:32:41,584-05", "UTC", "dmy", utc(2025, 10, 4, 2, 32, 41, 584000)),
        ("Tue, 23 Sep 2025 03:45:49 -0500", "UTC", "dmy", utc(2025, 9, 23, 8, 45, 49)),
        ("Setiembre 30 de 2025 - 05:03", "America/Bogota", "dmy", utc(2025, 9, 30, 10, 3)),
        ("24 de septiembre de 2025, 8:02 p. m.", "UTC", "dmy", utc(2025, 9, 24, 20, 2)),
        ("20250930T063923Z", None, None, utc(2025, 9, 30, 6, 39, 23)),
        ("26 Sep 2025 20:16:38 COT", "UTC", "dmy", utc(2025, 9, 27, 1, 16, 38)),
        ("2025-10-13T06:44:31[Europe/Madrid]", "UTC", "dmy", utc(2025, 10, 13, 4, 44, 31)),
        (" 2025-11-16 ", "America/Bogota", "dmy", utc(2025, 11, 16, 5)),
        ("30/9/25 02:46:40", "UTC", "dmy", utc(2025, 9, 30, 2, 46, 40)),
        ("2026-03-08T02:30:00", "America/New_York", "mdy", utc(2026, 3, 8, 7, 30)),
        ("2025-11-02T01:30:00", "America/New_York", "mdy", utc(2025, 11, 2, 5, 30)),
    ],
)
def test_first_reading(text, zone, order, want):
    assert interpretations(text, zone, order)[0][1] == want


@pytest.mark.parametrize("text", [None, "", "-", "pendiente", "31/02/2026 10:00", "2026-13-05T10:00:00Z", "0000-00-00 00:00:00", "13/25/2025", "2025-10-01T25:00:00", "25/12/2025 13:00 PM", "9" * 40, "x" * 100_000])
def test_unreadable_values_have_no_reading(text):
    assert interpretations(text, "UTC", "dmy") == []


def test_unknown_order_gives_both_readings():
    assert [r[1] for r in interpretations("03/04/2025", "UTC", None)] == [utc(2025, 4, 3), utc(2025, 3, 4)]
    assert len(interpretations("03/03/2025", "UTC", None)) == 1


def test_viterbi_keeps_the_format_and_the_order():
    day = 86_400 * 10**6
    rows = [[(1, 30 * day, 0.0), (2, 200 * day, 0.0)], [(1, 31 * day, 0.0), (2, 90 * day, 0.0)]]
    assert viterbi(rows, (1, 29 * day), (1, 32 * day)) == [0, 0]
    assert viterbi(rows, (2, 0), None) == [0, 0] or viterbi(rows, (2, 0), None) == [1, 1]


def test_operator_decides_by_the_sources_order(spark):
    raw = [(1, "s", "13/01/2025 00:00", None), (2, "s", "02/03/2025 00:00", "nope"), (3, "s", "25/03/2025 00:00", "1759533824"), (4, None, "2025-01-01", None), (None, "s", "2025-01-01", None), (5, "t", None, ""), (1, "s", "13/01/2025 00:00", None)]
    rows = spark.createDataFrame([(*r, 7) for r in raw], "pos long, source_id string, published_at string, fetched_at string, kind int")
    clock = spark.createDataFrame([("s", "UTC", None), ("s", "UTC", None)], "source_id string, zone_name string, date_order string")
    got = sorted(tuple(r) for r in normalise_timestamps(rows, clock).collect())
    assert got == sorted([(1, "published_at", utc(2025, 1, 13))] * 2 + [(2, "published_at", utc(2025, 3, 2)), (3, "fetched_at", 1759533824 * 10**6), (3, "published_at", utc(2025, 3, 25)), (4, "published_at", utc(2025, 1, 1))])
    assert normalise_timestamps(rows.limit(0), clock).count() == 0


def test_blocks_do_not_change_settled_values(spark, sf):
    rows, clock = spark.read.parquet(f"{sf}/raw_items.parquet"), spark.read.parquet(f"{sf}/source_clock.parquet")
    one = {tuple(r) for r in normalise_timestamps(rows, clock).collect()}
    assert one == {tuple(r) for r in normalise_timestamps(rows, clock, block=16).collect()}
    zones = {r.source_id: (r.zone_name, r.date_order) for r in clock.collect()}
    want = set()
    for r in rows.collect():
        for f in ("published_at", "fetched_at"):
            found = interpretations(r[f], *zones[r.source_id])
            if found:
                want.add((r.pos, f, found[0][1]))
    assert one == want


def test_blocks_do_not_change_ambiguous_values(spark):
    texts = ["01/13/2025", "02/03/2025", "02/04/2025", "02/05/2025", "02/25/2025", "03/04/2025", "03/05/2025"]
    rows = [(i, s, t, None) for s, shift in (("s", 0), (None, 100)) for i, t in enumerate(texts, shift)]
    rows = spark.createDataFrame(rows, "pos long, source_id string, published_at string, fetched_at string")
    clock = spark.createDataFrame([("s", "UTC", None)], "source_id string, zone_name string, date_order string")
    want = sorted((i + shift, "published_at", utc(2025, int(t[:2]), int(t[3:5]))) for shift in (0, 100) for i, t in enumerate(texts))
    for block in (1, 2, 3, 1 << 17):
        assert sorted(tuple(r) for r in normalise_timestamps(rows, clock, block=block).collect()) == want
