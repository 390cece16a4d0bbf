"""Which column of a DataFrame plays which part in an analysis."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame

# Accepted column names per role, first match wins.
CANDIDATES = {
    "src": ("srcip", "src_ip"),
    "dst": ("dstip", "dst_ip"),
    "src_port": ("sport", "src_port"),
    "dst_port": ("dsport", "dst_port"),
    "proto": ("protocol_type", "proto", "protocol"),
    "service": ("service",),
    "state": ("state", "flag"),
    "src_bytes": ("sbytes", "src_bytes"),
    "dst_bytes": ("dbytes", "dst_bytes"),
    "total_bytes": ("total_bytes",),
    "duration": ("dur", "duration"),
    "ts": ("timestamp",),
    "epoch": ("stime",),
    "hour": ("hour",),
    "day_of_week": ("day_of_week",),
    "label": ("label",),
    "category": ("attack_category", "attack_cat"),
    "attack": ("attack_type",),
    "count": ("count",),
    "srv_count": ("srv_count",),
    "dst_host_count": ("dst_host_count",),
    "serror_rate": ("serror_rate",),
    "rerror_rate": ("rerror_rate",),
}


@dataclass(frozen=True)
class Roles:
    """Column names by role; ``None`` where the table has no such column."""

    src: str | None = None
    dst: str | None = None
    src_port: str | None = None
    dst_port: str | None = None
    proto: str | None = None
    service: str | None = None
    state: str | None = None
    src_bytes: str | None = None
    dst_bytes: str | None = None
    total_bytes: str | None = None
    duration: str | None = None
    ts: str | None = None
    epoch: str | None = None
    hour: str | None = None
    day_of_week: str | None = None
    label: str | None = None
    category: str | None = None
    attack: str | None = None
    count: str | None = None
    srv_count: str | None = None
    dst_host_count: str | None = None
    serror_rate: str | None = None
    rerror_rate: str | None = None

    @classmethod
    def resolve(cls, df: DataFrame, **overrides: str) -> Roles:
        """Match the columns of ``df`` against the known names of every role."""
        present = set(df.columns)
        found = {
            role: next((name for name in names if name in present), None)
            for role, names in CANDIDATES.items()
        }
        roles = replace(cls(**found), **overrides)
        absent = [n for n in overrides.values() if n is not None and n not in present]
        if absent:
            raise ValueError(f"no such columns: {absent}")
        return roles

    def need(self, *roles: str) -> tuple[str, ...]:
        """Names of the given roles; raises when the table lacks one of them."""
        missing = [role for role in roles if getattr(self, role) is None]
        if missing:
            raise ValueError(f"the table has no column for: {', '.join(missing)}")
        return tuple(getattr(self, role) for role in roles)

    def has(self, *roles: str) -> bool:
        return all(getattr(self, role) is not None for role in roles)

    def columns(self) -> list[str]:
        """Every resolved column once, for projecting a table to what is needed."""
        names = (getattr(self, f.name) for f in fields(self))
        return list(dict.fromkeys(n for n in names if n is not None))
