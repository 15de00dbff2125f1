"""Every threshold of the engine in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


@dataclass(frozen=True)
class Settings:
    # fixed values: cleaning limits
    min_price: float = 0.01
    max_price: float = 5000.0
    min_quantity: int = 1
    max_quantity: int = 10000
    min_description: int = 3
    bulk_quantity: int = 12

    # fixed values: feature windows
    demand_days: tuple = (7, 14, 30)
    lag_rows: tuple = (1, 7, 14, 30)
    trend_days: int = 30
    forward_days: int = 7
    home_country: str = "United Kingdom"
    wholesale_basket: float = 20.0
    default_elasticity: float = -1.5

    # fixed values: pricing rules
    competitor_share: float = 0.30
    floor_margin: float = 1.05
    ceiling_factor: float = 1.50
    flash_factor: float = 1.25
    excess_factor: float = 0.85
    price_grid: int = 20  # steps per currency unit: 0.05
    batch_limit: int = 500

    # fixed values: spike detectors
    spike_seconds: int = 300
    spike_ratio: float = 1.5
    ema_keep: float = 0.8
    ema_spike: float = 3.0
    ema_life_days: int = 90
    velocity_seconds: int = 120
    velocity_baseline: float = 0.5
    velocity_flag_seconds: int = 600
    watermark: str = "10 minutes"

    # fixed values: seconds a live feature stays valid
    ttl_demand: int = 30
    ttl_inventory: int = 60
    ttl_competitor: int = 300
    ttl_decision: int = 30

    # fixed values: model gates and drift limit
    gate_mae: float = 0.5
    gate_mape: float = 5.0
    gate_r2: float = 0.90
    gate_within10: float = 85.0
    retrain_mae: float = 8.0
    psi_limit: float = 0.2

    # rows of one key from which on its windows are cut into hours
    heavy_rows: int = 5_000_000


SETTINGS = Settings()
