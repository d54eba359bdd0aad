from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.operators.timestamps import _date_of, _day_number, normalise, p6_found


@given(st.dates(date(1, 1, 1), date(9999, 12, 31)))
def test_day_arithmetic_agrees_with_the_calendar(day):
    n = _day_number(day.year, day.month, day.day)
    assert n == (day - date(1970, 1, 1)).days
    assert _date_of(n) == (day.year, day.month, day.day)


@pytest.mark.parametrize(
    ("value", "norm"),
    [
        ("2016-132", "2016-05-11"), ("2021-W18-7", "2021-05-09"), ("2020-W54-1", None), ("2019-366", None), ("Dublin, 07.03.2024", "2024-03-07"),
        ("Sun, 11 Mar 2018", "2018-03-11"), ("  20-Aug-2017 ", "2017-08-20"), ("15 novembre 2017", "2017-11-15"), ("22nd March 2013", "2013-03-22"),
        ("27.5.10", "2010-05-27"), ("9.2.99", "1999-02-09"), ("2009/4/13", "2009-04-13"), ("28 DE MARZO DE 2021", "2021-03-28"), ("9. JULI 2009", "2009-07-09"),
        ("April 2009", "2009-04"), ("20051030T0130Z", "2005-10-30T01:30:00Z"), ("20201220084923", "2020-12-20T08:49:23Z"), ("1701106678", "2023-11-27T17:37:58Z"),
        ("1224400759350", "2008-10-19T07:19:19Z"), ("820965276023", "1996-01-06T21:54:36Z"), ("2007-03-25T03:35:00+02:00", "2007-03-25T01:35:00Z"),
        ("21.5.1998 19:29 MEZ", "1998-05-21T18:29:00Z"), ("Mar 26, 2017 12:40 AM ET", "2017-03-26T04:40:00Z"), ("Jan 5, 2004 5:41 PM PT", "2004-01-06T01:41:00Z"),
        ("31.02.2004", None), ("TBA", None), ("", None), ("0000-00-00", None), ("25:00", None), ("11/31/2004", None), (None, None), ("2004", "2004"), ("2004-13", None),
    ],
)
def test_spellings(value, norm):
    assert normalise(value, "Europe/Berlin", True) == norm


def test_slashes_follow_the_source():
    assert normalise("03/04/2005", "UTC", True) == "2005-04-03"
    assert normalise("03/04/2005", "UTC", False) == "2005-03-04"
    assert normalise("03/04/2005", None, None) == "2005-04-03"


def test_daylight_saving():
    assert normalise("2025-03-30 02:30:00", "Europe/Berlin") == "2025-03-30T01:30:00Z"  # missing: the offset before
    assert normalise("2010-10-31 02:30:00", "Europe/Berlin") == "2010-10-31T00:30:00Z"  # ambiguous: the earlier


@given(st.datetimes(datetime(1996, 1, 1), datetime(2037, 1, 1)), st.sampled_from(["Europe/Berlin", "America/New_York", "America/Los_Angeles"]))
def test_local_times_agree_with_the_zone_tables(moment, zone):
    moment = moment.replace(microsecond=0)
    expected = moment.replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc)
    assert normalise(moment.strftime("%Y-%m-%d %H:%M:%S"), zone) == expected.strftime("%Y-%m-%dT%H:%M:%SZ")
    assert normalise((moment + timedelta(0)).strftime("%d.%m.%Y %H:%M:%S"), zone) == expected.strftime("%Y-%m-%dT%H:%M:%SZ")


def test_found(spark, tables):
    d = tables(
        clash=True,
        releases=[{"id": 1, "source": "a", "date": "03/04/2005"}, {"id": 2, "source": "none", "date": "03/04/2005"}, {"id": 3, "date": "2004-05-06"}, {"id": 4, "date": None}, {"id": 5, "date": "  "}, {"id": 6, "date": "31.02.2004"}],
        terratec_early__listing_1=[{"url": "u", "date_str": "1.2.99"}] * 3 + [{"url": "v"}],
        source_tags=[{"source": "a", "tz": "America/New_York", "dayfirst": False}],
    )
    assert sorted(map(tuple, p6_found(spark, d).collect())) == [("releases", "1", "2005-03-04"), ("releases", "2", "2005-04-03"), ("terratec_early__listing_1", "u", "1999-02-01")]
    assert p6_found(spark, tables()).count() == 0
