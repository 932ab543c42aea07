"""Job parameters: plain dataclasses, optionally read from a task's JSON text."""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field


class ParameterError(ValueError):
    """A job was asked for with parameters it cannot run on."""


def _first(task: dict, key: str) -> str | None:
    """Task parameters are one-element arrays; an absent or empty array means 'not given'."""
    values = task.get(key)
    if values is None:
        return None
    if not isinstance(values, list):
        values = [values]
    if not values or values[0] is None:
        return None
    text = str(values[0])
    return text or None


def _csv(text: str | None) -> tuple[str, ...] | None:
    return None if text is None else tuple(part for part in text.split(",") if part)


def _number(text: str | None, key: str) -> int | None:
    if text is None:
        return None
    try:
        return int(text)
    except ValueError as error:
        raise ParameterError(f"{key} must be a whole number, not {text!r}") from error


def _ids(text: str | None, key: str) -> tuple[int, ...] | None:
    parts = _csv(text)
    return None if parts is None else tuple(_number(part, key) for part in parts)


def _is_date(text: str) -> bool:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        return False
    try:
        datetime.date.fromisoformat(text)
    except ValueError:
        return False
    return True


@dataclass(frozen=True)
class DateRange:
    """Inclusive ``yyyy-MM-dd`` bounds; a missing bound does not filter."""

    start: str | None = None
    end: str | None = None

    def __post_init__(self) -> None:
        for bound in (self.start, self.end):
            if bound is not None and not _is_date(bound):
                raise ParameterError(f"a date must be written yyyy-MM-dd, not {bound!r}")
        if self.start is not None and self.end is not None and self.start > self.end:
            raise ParameterError(f"start date {self.start} is after end date {self.end}")


@dataclass(frozen=True)
class SessionFilter:
    """Optional session predicates. ``None`` means the predicate is not applied."""

    start_age: int | None = None
    end_age: int | None = None
    professionals: Iterable[str] | None = None
    cities: Iterable[str] | None = None
    sex: Iterable[str] | None = None
    keywords: Iterable[str] | None = None
    category_ids: Iterable[int] | None = None


@dataclass(frozen=True)
class PageFlow:
    """A target page flow: the pages a visitor should pass through, in order."""

    pages: tuple[int, ...]

    def __post_init__(self) -> None:
        if len(self.pages) < 2:
            raise ParameterError("a page flow needs at least two pages")

    @property
    def start(self) -> int:
        return self.pages[0]

    @property
    def steps(self) -> list[tuple[int, int]]:
        return list(zip(self.pages, self.pages[1:]))

    @classmethod
    def parse(cls, text: str) -> PageFlow:
        return cls(_ids(text, "targetPageFlow") or ())


@dataclass(frozen=True)
class JobParams:
    """Everything the batch jobs take."""

    task_id: int = 0
    dates: DateRange = field(default_factory=DateRange)
    sessions: SessionFilter = field(default_factory=SessionFilter)
    flow: PageFlow | None = None

    @classmethod
    def from_task(cls, task_id: int | None, text: str | None) -> JobParams:
        """Read a task's parameters, ``{"startDate": ["2024-01-01"], "cities": ["a,b"], ...}``."""
        if task_id is None or not text:
            raise ParameterError(f"no parameters found for task {task_id}")
        try:
            task = json.loads(text)
        except json.JSONDecodeError as error:
            raise ParameterError(f"parameters of task {task_id} are not JSON: {error}") from error
        if not isinstance(task, dict):
            raise ParameterError(f"parameters of task {task_id} are not a JSON object")
        flow = _first(task, "targetPageFlow")
        return cls(
            task_id=task_id,
            dates=DateRange(_first(task, "startDate"), _first(task, "endDate")),
            sessions=SessionFilter(
                start_age=_number(_first(task, "startAge"), "startAge"),
                end_age=_number(_first(task, "endAge"), "endAge"),
                professionals=_csv(_first(task, "professionals")),
                cities=_csv(_first(task, "cities")),
                sex=_csv(_first(task, "sex")),
                keywords=_csv(_first(task, "keywords")),
                category_ids=_ids(_first(task, "categoryIds"), "categoryIds"),
            ),
            flow=None if flow is None else PageFlow.parse(flow),
        )
