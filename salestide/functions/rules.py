"""Data-quality rules as boolean columns.

NULL follows SQL: a NULL domain value makes that rule NULL (not counted) unless another domain column is
wrong, and a NULL ingest time makes the latency rule NULL. ``Rules.invalid`` is never NULL, because a NULL
in any of its inputs already breaks the required-field rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from salestide import contract as c


@dataclass(frozen=True)
class Rule:
    """One rule: its code in violation reasons, its counter, its flag column, and when a row breaks it."""

    code: str
    counter: str
    flag: str
    broken: Column
    blocking: bool = True
    """Whether a row that breaks it is invalid; other rules only observe."""


@dataclass(frozen=True)
class Rules:
    """The parameters of the rules; the defaults are the contract's."""

    required: tuple[str, ...] = tuple(c.REQUIRED_FIELDS)
    domains: dict[str, list[str]] = field(default_factory=lambda: dict(c.DOMAINS))
    latency_sla_seconds: int = c.LATENCY_SLA_SECONDS

    def listed(self) -> list[Rule]:
        """All rules, in the order in which reasons name them."""
        amount = F.col("amount")
        missing = [F.col(name).isNull() for name in self.required]
        foreign = [~F.col(name).isin(values) for name, values in self.domains.items()]
        return [
            Rule("NULL_REQUIRED", "null_required_fields", "f_null_required", reduce(or_, missing)),
            Rule("INVALID_DOMAIN", "invalid_domain_values", "f_invalid_domain", reduce(or_, foreign)),
            # Missing, zero or NaN; negative amounts are refunds and pass.
            Rule("BAD_AMOUNT", "bad_amounts", "f_bad_amount", amount.isNull() | (amount == 0) | F.isnan(amount)),
            Rule(
                "LATENCY_SLA_BREACH", "latency_sla_breaches", "f_latency_breach",
                latency_seconds() > self.latency_sla_seconds, blocking=False,
            ),
        ]

    def invalid(self) -> Column:
        return reduce(or_, [rule.broken for rule in self.listed() if rule.blocking])

    def flags(self) -> dict[str, Column]:
        return {rule.flag: rule.broken for rule in self.listed()} | {"f_invalid_any": self.invalid()}

    def reason(self) -> Column:
        """The codes of the broken rules joined by ``|``; empty if none."""
        return F.concat_ws("|", *[F.when(rule.broken, F.lit(rule.code)) for rule in self.listed()])


def latency_seconds() -> Column:
    """Ingest minus event time; each side drops its fraction first."""
    return F.col("ingest_ts").cast("long") - F.col("event_ts").cast("long")


def net_amount(event_type: Column, gross: Column, refund_types: list[str] = c.REFUND_TYPES) -> Column:
    """A gross amount with the sign of its event type: money paid back counts against revenue."""
    return F.when(event_type.isin(refund_types), -gross).otherwise(gross)
