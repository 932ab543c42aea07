from __future__ import annotations

import json

import pytest

from trailmill.params import DateRange, JobParams, PageFlow, ParameterError
from trailmill.sources import jdbc


def test_task_parameters():
    task = {
        "startDate": ["2024-01-01", "ignored"],
        "startAge": ["20"],
        "endAge": [50],
        "cities": ["rome,oslo"],
        "categoryIds": ["1,2"],
        "keywords": [],
        "targetPageFlow": ["1,2,3"],
    }
    got = JobParams.from_task(4, json.dumps(task))
    assert got.task_id == 4
    assert got.dates == DateRange("2024-01-01", None)
    assert (got.sessions.start_age, got.sessions.end_age) == (20, 50)
    assert got.sessions.cities == ("rome", "oslo")
    assert got.sessions.category_ids == (1, 2)
    assert got.sessions.keywords is None and got.sessions.sex is None
    assert got.flow == PageFlow((1, 2, 3)) and got.flow.steps == [(1, 2), (2, 3)]


@pytest.mark.parametrize(
    "task_id, text",
    [
        (None, "{}"),
        (1, None),
        (1, ""),
        (1, "no json"),
        (1, "[]"),
        (1, '{"startAge": ["old"]}'),
        (1, '{"targetPageFlow": ["7"]}'),
        (1, '{"startDate": ["2024-02-01"], "endDate": ["2024-01-01"]}'),
    ],
)
def test_missing_or_wrong_parameters_are_refused(task_id, text):
    with pytest.raises(ParameterError):
        JobParams.from_task(task_id, text)


def test_jdbc_options():
    plain = jdbc.reader_options("jdbc:x", "city_info", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "city_info", "fetchsize": "10000", "user": "u"}
    split = jdbc.reader_options("jdbc:x", "t", "id", 0, 99, 8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.reader_options("jdbc:x", "t", "id")
    assert jdbc.writer_options("jdbc:x", "t", 500, 4)["batchsize"] == "500"


@pytest.mark.parametrize("bound", ["2024-1-5", "20240131", "2024-02-30", "", "2024-01-05 "])
def test_dates_are_strict(bound):
    with pytest.raises(ParameterError):
        DateRange(bound)
    with pytest.raises(ParameterError):
        DateRange("2024-01-01", bound)
