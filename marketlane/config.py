"""Tunable parameters, typed; ``from_rows`` reads them from a (param_key, value) table."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class DemandParams:
    """Fixed values of the demand model."""

    kappa: float = 0.3663
    shrink_k: int = 50
    global_density: float = 0.0565
    window_days: int = 90
    strong_len: int = 6
    adj_low: float = 0.5
    adj_high: float = 3.0


@dataclass(frozen=True)
class MoneyParams:
    """Fixed values of the price rules: exchange rate, market fee, default shipping, minimum margin rate."""

    rate: float = 9.2
    fee: float = 0.055
    shipping: int = 15000
    margin_rate: float = 0.30
    krw_to_reference: float = 0.11


@dataclass(frozen=True)
class ScoreParams:
    """Documented defaults of the published and waiting scores."""

    cohort_k: float = 20.0
    min_bc: int = 5
    min_b: int = 10
    min_c: int = 10
    fallback_prior: float = 0.001
    anchor_days: int = 30
    signal_bands: tuple[tuple[float, float], ...] = ((0, 0.5), (5, 1.0), (10, 1.5), (15, 2.0), (float("inf"), 3.0))
    price_bands: tuple[tuple[float, float], ...] = ((10000, 1.3), (30000, 1.1), (80000, 1.0), (float("inf"), 0.8))


def from_rows(kind: type, rows: DataFrame):
    """``kind`` with the numeric fields that ``rows`` (param_key, value) overrides; a table of settings is small by nature."""
    known = {f.name: f.type for f in fields(kind) if f.type in ("int", "float")}
    found = {r.param_key: r.value for r in rows.filter(rows.param_key.isin(list(known))).limit(len(known)).collect()}
    return kind(**{k: (int if known[k] == "int" else float)(v) for k, v in found.items()})
