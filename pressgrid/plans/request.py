"""What a caller asks for: filters, time range and options. Plain driver-side values, no data."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from datetime import UTC, datetime
from enum import StrEnum
from pathlib import Path
from typing import Any

from pressgrid.functions.times import BUCKET_SIZES

MATCH_MODES = ("any", "all")


class Sort(StrEnum):
    """Result orders. The spellings used in request files."""

    RELEVANCE = "HybridRel"
    NEWEST = "DateDesc"
    OLDEST = "DateAsc"
    TONE_HIGH = "ToneDesc"
    TONE_LOW = "ToneAsc"


def _terms(values: Any) -> tuple[str, ...]:
    stripped = (str(value).strip() for value in values or ())
    return tuple(value for value in stripped if value)


def utc(value: str | datetime | None) -> datetime | None:
    """An aware UTC datetime; values without a zone are taken as UTC."""
    if isinstance(value, str):
        text = value.strip()
        value = datetime.fromisoformat(text) if text else None
    if value is None:
        return None
    return value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC)


@dataclass(frozen=True)
class Near:
    """All ``terms`` within ``distance`` words of each other."""

    distance: int
    terms: tuple[str, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "terms", _terms(self.terms))
        if self.distance < 1:
            raise ValueError("a proximity distance must be at least 1")
        if len(self.terms) < 2:
            raise ValueError("a proximity filter needs two or more terms")


# The field names of the three classes below are those of request files.
@dataclass(frozen=True)
class Filters:
    """Which articles to select. Content filters combine by ``match_mode``, all others by AND."""

    keywords: tuple[str, ...] = ()
    exact_phrases: tuple[str, ...] = ()
    entities: tuple[str, ...] = ()
    themes: tuple[str, ...] = ()
    source_countries: tuple[str, ...] = ()
    source_languages: tuple[str, ...] = ()
    domains: tuple[str, ...] = ()
    exact_domains: tuple[str, ...] = ()
    exclude_terms: tuple[str, ...] = ()
    tone_min: float | None = None
    tone_max: float | None = None
    tone_abs_min: float | None = None
    tone_abs_max: float | None = None
    proximity: tuple[Near, ...] = ()
    repeated_terms: dict[str, int] = field(default_factory=dict)
    match_mode: str = "any"

    def __post_init__(self) -> None:
        for item in fields(self):
            if item.type == "tuple[str, ...]":
                object.__setattr__(self, item.name, _terms(getattr(self, item.name)))

    @classmethod
    def from_dict(cls, values: dict[str, Any] | None) -> Filters:
        values = dict(values or {})
        if _terms(values.pop("raw_fragments", None)):
            raise ValueError("raw_fragments cannot be evaluated on tables; add a DataFrame filter instead")
        near = tuple(Near(int(n["distance"]), tuple(n["terms"])) for n in values.pop("proximity", None) or ())
        repeated = {
            str(term).strip(): int(count)
            for term, count in (values.pop("repeated_terms", None) or {}).items()
        }
        mode = str(values.pop("match_mode", "any")).strip().lower() or "any"
        known = {item.name for item in fields(cls)}
        rest = {name: value for name, value in values.items() if name in known}
        return cls(proximity=near, repeated_terms=repeated, match_mode=mode, **rest)


@dataclass(frozen=True)
class TimeRange:
    """``[start, end]`` in UTC, either end open, or a span such as ``24h`` back from ``as_of``."""

    start: datetime | None = None
    end: datetime | None = None
    timespan: str | None = None
    as_of: datetime | None = None

    def __post_init__(self) -> None:
        for name in ("start", "end", "as_of"):
            object.__setattr__(self, name, utc(getattr(self, name)))
        object.__setattr__(self, "timespan", self.timespan or None)
        if self.start and self.end and self.start > self.end:
            raise ValueError("the time range starts after its end")
        if self.timespan and (self.start or self.end):
            raise ValueError("give a timespan or explicit bounds, not both")

    @classmethod
    def from_dict(cls, values: dict[str, Any] | None) -> TimeRange:
        values = values or {}
        return cls(**{item.name: values.get(item.name) for item in fields(cls)})


@dataclass(frozen=True)
class Request:
    """One analysis request. ``max_records`` is the most rows taken from one time window; without it all are taken."""

    filters: Filters
    date_range: TimeRange = TimeRange()
    max_records: int | None = None
    sort: Sort = Sort.RELEVANCE
    include_timeline: bool = True
    include_tone_timeline: bool = True
    bucket_size: str = "day"
    request_label: str | None = None
    batch_window_hours: int | None = 24
    deduplicate: bool = True
    validate_schema: bool = True
    scrape_articles: bool = False
    scrape_limit: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "sort", Sort(self.sort))
        if self.bucket_size not in BUCKET_SIZES:
            raise ValueError(f"bucket_size must be one of {', '.join(BUCKET_SIZES)}")
        for name in ("max_records", "batch_window_hours", "scrape_limit"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1")

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> Request:
        """A request as written in request files. Absent options take their defaults, as do null ones other than
        switches, for which null means off."""
        known = {item.name for item in fields(cls)}
        given = {name: value for name, value in values.items() if name in known and value is not None}
        given |= {item.name: bool(values[item.name]) for item in fields(cls) if item.type == "bool" and item.name in values}
        given["filters"] = Filters.from_dict(values.get("filters"))
        given["date_range"] = TimeRange.from_dict(values.get("date_range"))
        for name in ("max_records", "batch_window_hours", "scrape_limit"):
            if name in given:
                given[name] = int(given[name])
        if "bucket_size" in given:
            given["bucket_size"] = str(given["bucket_size"]).strip().lower() or "day"
        return cls(**given)

    @classmethod
    def from_file(cls, path: str | Path) -> Request:
        return cls.from_dict(json.loads(Path(path).read_text(encoding="utf-8")))
