"""Censoring of personal columns before anything leaves the platform."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.scalars import true_only


@dataclass(frozen=True)
class PrivacyRules:
    """Which columns are hidden, hashed or shown only with consent."""

    restricted_regions: frozenset[str] = frozenset()
    region_column: str = "country"
    hidden_in_restricted: tuple[str, ...] = ()
    hashed: tuple[str, ...] = ()
    consent_column: str = "has_consent"
    needs_consent: tuple[str, ...] = field(default=())


def censor(df: DataFrame, rules: PrivacyRules) -> DataFrame:
    """Null geo-restricted columns, hash device ids with SHA-256, keep IPs only with consent."""
    changes: dict[str, Column] = {}

    def current(name: str) -> Column:
        return changes.get(name, F.col(name))

    for name in _present(df, rules.hashed):
        changes[name] = F.sha2(F.col(name).cast("string"), 256)
    for name in _present(df, rules.needs_consent):
        changes[name] = F.when(true_only(rules.consent_column), current(name))
    if rules.restricted_regions:
        restricted = F.col(rules.region_column).isin(sorted(rules.restricted_regions))
        for name in _present(df, rules.hidden_in_restricted):
            changes[name] = F.when(~true_only(restricted), current(name))
    return df.withColumns(changes) if changes else df


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]
