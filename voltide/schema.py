"""Column names, key columns and schema-driven column selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEYS = ("op_id", "client_id")
ORDER = ("close_ts", "op_id")

# Raw header -> column name used by this library.
RAW_COLUMN_NAMES = {
    "Fecha de cierre": "close_ts",
    "Codigo del Cliente (IBS)": "client_id",
    "Importe FX": "amount",
    "Volumen_diario": "daily_volume",
    "Volumen_promedio_diario": "client_mean_amount",
    "Volumen_Ponderado_5": "amount_ma_5",
    "Spread\n": "spread",
    "Spread_TC": "spread",
    "Spread": "spread",
    "T/C Cerrado": "closed_rate",
    "Tipo de Cliente": "category",
    "Categoria_Cliente": "category",
    "RUC / DNI termina en": "id_digit",
    "Frecuencia_Cliente": "id_digit",
    "Tipo de Operación": "op_type",
    "Producto": "product",
    "Rubro de Negocio": "business_line",
    "PN/PJ": "person_type",
    "Ambito de Negocio": "business_scope",
    "Moneda FX": "currency",
    "TC CONTRAPARTE": "counterparty_rate",
    "PX_MID": "px_mid",
    "PX_HIGH": "px_high",
    "PX_LAST": "px_last",
    "Monto Cliente": "client_amount",
    "Equivalente en USD (T/C Cerrado)": "usd_at_closed_rate",
    "Equivalente en USD (T/C Pool)": "usd_at_pool_rate",
    "Monto Contraparte": "counterparty_amount",
}

# Raw columns that carry no trade information.
UNUSED_RAW_COLUMNS = (
    "Unnamed: 49", "Unnamed: 50", "Unnamed: 51",
    "bbva", "pn", "FACTURA/BOLETA", "Número", "Bancos",
    "I BCP", "I BBVA", "I IBK", "I BIF", "I SCOTI", "I PICHI",
    "S BCP", "S BBVA", "S IBK", "S BIF", "S SCOTI", "S PICHI",
)

# Columns cast leniently and filled with their median by the class-based clean.
RATE_COLUMNS = (
    "closed_rate", "counterparty_rate", "px_mid", "px_high", "px_last",
    "client_amount", "usd_at_closed_rate", "usd_at_pool_rate",
    "counterparty_amount", "spread",
)

CATEGORICAL_COLUMNS = (
    "business_line", "person_type", "business_scope", "product",
    "op_type", "currency", "category",
)

# Legal ranges; None is unbounded.
LEGAL_RANGES = {
    "amount": (0.0, None),
    "client_mean_amount": (0.0, None),
    "spread": (0.0, None),
    "amount_ma_5": (0.0, None),
    "daily_volume": (0.0, None),
    "month": (1.0, 12.0),
    "id_digit": (1.0, None),
}

# Declared types of a cleaned trade table.
DECLARED_TYPES = {
    "client_id": "string",
    "amount": "double",
    "client_mean_amount": "double",
    "spread": "double",
    "amount_ma_5": "double",
    "daily_volume": "double",
    "month": "int",
    "day_name": "string",
    "category": "string",
    "id_digit": "int",
}


class MissingColumns(ValueError):
    """A DataFrame lacks columns an operator requires."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = missing_columns(df, columns)
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in columns if c not in present]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = KEYS) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def drop_unused(df: DataFrame, marker: str = "Unnamed") -> DataFrame:
    """Drop the known filler columns and every column whose name has ``marker``."""
    marked = [c for c in df.columns if marker in c]
    return df.drop(*UNUSED_RAW_COLUMNS, *marked)


def rename_raw(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(
        {raw: name for raw, name in RAW_COLUMN_NAMES.items() if raw in df.columns}
    )
