"""Record-by-record simulation of the rules, used only to check the window plans."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.functions.envelope import DB_GUARDRAIL, RULE_1, RULE_2


@dataclass
class Row:
    version: int
    maturity: object
    expired: bool = False
    tag: object = None


@dataclass
class Trade:
    """State of one trade: the stream's mark and the stored versions."""

    seen: int | None = None
    rows: dict[int, Row] = field(default_factory=dict)

    def active(self):
        return [r.version for r in self.rows.values() if not r.expired]


def stream_rule(trade: Trade, version, maturity, today):
    if trade.seen is not None and version < trade.seen:
        return RULE_1
    if trade.seen is not None and version == trade.seen and maturity is not None and maturity < today:
        return RULE_2
    trade.seen = version
    return None


def store_rule(trade: Trade, version, maturity, today, tag=None):
    active = trade.active()
    if any(v > version for v in active):
        return DB_GUARDRAIL
    if maturity is not None and maturity < today and version in active:
        return DB_GUARDRAIL
    trade.rows[version] = Row(version, maturity, False, tag)
    return None


def two_tier(trade: Trade, version, maturity, today, tag=None):
    return stream_rule(trade, version, maturity, today) or store_rule(trade, version, maturity, today, tag)


def status_rule(trade: Trade, version, maturity, today, tag=None):
    active = trade.active()
    top = max(active) if active else None
    if top is not None and version < top:
        return "REJECTED: lower_version"
    if top is not None and version == top and maturity is not None and maturity < today:
        return "REJECTED: same_version_maturity_before_today"
    if version in trade.rows and trade.rows[version].expired:
        return "REJECTED: db_guardrail_prevented_update"
    trade.rows[version] = Row(version, maturity, False, tag)
    return "OK"
