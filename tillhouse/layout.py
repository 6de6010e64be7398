"""Storage locations, day partitions and run dates."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

DAY_KEYS = ["year", "month", "day"]
# Above the days, the run that wrote them.
RUN_KEY = "run"


def _location(value: str) -> str:
    """A bare bucket name means object storage; anything with a slash is a path already."""
    value = value.rstrip("/")
    return value if "/" in value else f"s3a://{value}"


@dataclass(frozen=True)
class Layout:
    """Base paths of the four layers."""

    bronze: str
    silver: str
    quarantine: str
    gold: str

    @classmethod
    def under(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", f"{root}/gold")

    @classmethod
    def from_settings(
        cls,
        arguments: Mapping[str, str] | None = None,
        environment: Mapping[str, str] | None = None,
        storage: Mapping[str, str] | None = None,
    ) -> Layout:
        """Job arguments win over environment variables, those over the storage section of a config file."""
        found = {}
        for layer in ("bronze", "silver", "quarantine", "gold"):
            value = (
                (arguments or {}).get(layer)
                or (environment or {}).get(f"{layer.upper()}_BUCKET")
                or (storage or {}).get(layer)
            )
            if not value:
                raise ValueError(f"no location given for the {layer} layer")
            found[layer] = _location(value)
        return cls(**found)


def storage_section(path: str) -> dict[str, str]:
    """The storage section of a YAML or JSON config file: layer name -> bucket or folder."""
    with open(path, encoding="utf-8") as file:
        if path.endswith(".json"):
            config = json.load(file)
        else:
            import yaml  # only needed for YAML files

            config = yaml.safe_load(file)
    return config["storage"]


def parse_day(text: str) -> date:
    """Strict YYYY-MM-DD."""
    parsed = datetime.strptime(text, "%Y-%m-%d").date()
    if parsed.isoformat() != text:
        raise ValueError(f"day must be written YYYY-MM-DD, got {text!r}")
    return parsed


def days_between(start: date, end: date) -> list[date]:
    """All days from start to end, both included; empty when end is before start."""
    return [start + timedelta(days=n) for n in range((end - start).days + 1)]


def resolve_days(
    day: str = "", start: str = "", end: str = "", today: date | None = None
) -> list[date]:
    """Days of a run: one day, else a range, else the start day alone, else today in UTC."""
    if day:
        only = parse_day(day)
        return [only]
    if start:
        first = parse_day(start)
        return days_between(first, parse_day(end) if end else first)
    return [today or datetime.now(timezone.utc).date()]


def lookback_days(day: date, lag: int = 2) -> list[date]:
    """The day and the earlier days its late rows may belong to."""
    return days_between(day - timedelta(days=lag), day)


def stretches(days: list[date]) -> list[tuple[date, date]]:
    """First and last day of each run of days without a gap."""
    out: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if out and out[-1][1] + timedelta(days=1) == day:
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def day_values(day: date) -> tuple[str, str, str]:
    """Partition keys of a day."""
    return f"{day.year}", f"{day.month:02d}", f"{day.day:02d}"


def partition_text(day: date) -> str:
    return f"year={day.year}/month={day.month:02d}/day={day.day:02d}"


def day_path(table_path: str, day: date) -> str:
    return f"{table_path}/{partition_text(day)}"


def projected_partitions(first_year: int, last_year: int) -> list[tuple[str, str, str]]:
    """Every year/month/day key the projection rules allow: months 01-12, days 01-31, no calendar check."""
    return [
        (str(year), f"{month:02d}", f"{dom:02d}")
        for year in range(first_year, last_year + 1)
        for month in range(1, 13)
        for dom in range(1, 32)
    ]
