"""Settings and rule tables.  Bad numbers warn and fall back; tables are data that sites extend."""

from __future__ import annotations

import hashlib
import json
import os
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path


def flag(value: str | None, default: bool = False) -> bool:
    """on, 1, true and yes switch on."""
    return default if value is None or not value.strip() else value.strip().lower() in ("on", "1", "true", "yes")


@dataclass(frozen=True)
class Config:
    """0 means: no page at all for max_items; all for rss_max_feeds and backfill_limit; no limit for budgets."""

    data_dir: str = "data"
    archive_days: int = 60
    rss_max_feeds: int = 400
    max_items: int = 200
    time_budget: int = 0
    max_media: int = 400
    max_asr_total: float = 8 * 3600.0
    max_asr_jobs: int = 40
    max_asr_duration: float = 3 * 3600.0
    backfill_limit: int = 0
    translate: bool = True
    scraped_sources: bool = False

    #: Environment names of the fields.
    NAMES = {"archive_days": "ARCHIVE_DAYS", "rss_max_feeds": "RSS_MAX_FEEDS", "max_items": "MAX_ITEMS", "time_budget": "TIME_BUDGET_SECONDS"}

    @property
    def archive(self) -> str:
        return f"{self.data_dir}/archive.json"

    @property
    def subtitles(self) -> str:
        return f"{self.data_dir}/subtitles"

    @property
    def status_file(self) -> str:
        return f"{self.data_dir}/status.json"

    @property
    def inbox(self) -> str:
        return f"{self.data_dir}/inbox.json"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Config:
        given = {}
        for f in fields(cls):
            raw = env.get(cls.NAMES.get(f.name, f.name.upper()))
            if raw is None or not raw.strip():
                continue
            if isinstance(f.default, bool):
                given[f.name] = flag(raw, f.default)
            elif isinstance(f.default, str):
                given[f.name] = raw.strip()
            else:
                try:
                    given[f.name] = type(f.default)(raw)
                except ValueError:
                    warnings.warn(f"{f.name}: {raw!r} is no number; {f.default} is used", stacklevel=2)
        return cls(**given)


@dataclass(frozen=True)
class Rules:
    """Rule tables; the defaults are small and our own."""

    boilerplate: tuple[str, ...] = ()
    chrome: tuple[str, ...] = ()
    sites: Mapping[str, object] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | os.PathLike) -> Rules:
        """Tables of a JSON file; one that can't be read gives empty tables and a warning."""
        try:
            data = json.loads(Path(path).read_text(encoding="utf-8"))
        except (OSError, ValueError) as e:
            warnings.warn(f"{path}: {e}; no rules", stacklevel=2)
            return cls()
        get = lambda k: tuple(x for x in data.get(k) or () if isinstance(x, str))
        sites = data.get("sites")
        return cls(get("boilerplate"), get("qc_chrome"), sites if isinstance(sites, dict) else {})

    def hosts(self, name: str) -> tuple[str, ...]:
        value = self.sites.get(name)
        return tuple(value) if isinstance(value, list) else ()

    def mapping(self, name: str) -> dict[str, str]:
        value = self.sites.get(name)
        return dict(value) if isinstance(value, dict) else {}


def rules_hash(sources: Mapping[str, bytes | None]) -> str:
    """16 hex digits of what decides stored texts: names and contents in order, missing ones marked."""
    h = hashlib.sha1()
    for name, content in sources.items():
        h.update(name.encode() + b"\0")
        h.update(b"missing" if content is None else content)
    return h.hexdigest()[:16]
