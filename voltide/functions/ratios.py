"""Ratios, products and signed amounts. A zero denominator gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def product(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)


def volume_ratios() -> dict[str, Column]:
    return {
        "volume_amount_ratio": ratio("daily_volume", "amount"),
        "volume_mean_ratio": ratio("daily_volume", "client_mean_amount"),
        "spread_volume_ratio": ratio("spread", "daily_volume"),
    }


def trend_ratios() -> dict[str, Column]:
    return {
        "daily_to_mean_ratio": ratio("daily_volume", "client_mean_amount"),
        "ma5_to_mean_ratio": ratio("amount_ma_5", "client_mean_amount"),
        "spread_times_amount": product("spread", "amount"),
        "trend_to_mean_ratio": ratio("volume_trend", "client_mean_amount"),
    }


def interactions() -> dict[str, Column]:
    return {
        "amount_x_mean": product("amount", "client_mean_amount"),
        "amount_x_spread": product("amount", "spread"),
        "ma5_x_spread": product("amount_ma_5", "spread"),
        "volume_amount_ratio": ratio("daily_volume", "amount"),
        "spread_volume_ratio": ratio("spread", "daily_volume"),
    }


def rate_interactions() -> dict[str, Column]:
    return {
        "amount_x_rate": product("amount", "closed_rate"),
        "spread_x_amount": product("spread", "amount"),
        "signed_amount": signed_amount(),
    }


def signed_amount(op: str = "op_type", amount: str = "amount") -> Column:
    """Bought amounts count up, sold amounts down, others are missing."""
    sign = F.when(F.col(op) == "buy", 1).when(F.col(op) == "sell", -1)
    return sign * F.col(amount)


def finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
