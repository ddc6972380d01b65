"""Column names, the declared fact schema and the names used in the CSV feed.

The fact has daily grain: after cleaning there is one row per sale date, store
and product. A *series* is one (store, product) pair, so it never holds more
rows than there are calendar days. That bound is what makes the per-series
windows of this package safe at any data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import types as T

SERIES_KEYS = ["store", "product"]
ROW_KEYS = ["sale_date", "store", "product"]


def series_window() -> WindowSpec:
    """All rows of a series."""
    return Window.partitionBy(*SERIES_KEYS)


def day_window() -> WindowSpec:
    """The rows of a series in date order."""
    return series_window().orderBy("sale_date")


FACT_SCHEMA = T.StructType(
    [
        T.StructField("sale_date", T.DateType()),
        T.StructField("store", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("units", T.DoubleType()),
        T.StructField("stock", T.IntegerType()),
        T.StructField("is_holiday", T.IntegerType()),
        T.StructField("dow", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("iso_week", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
    ]
)

# Headers of the CSV feed, in file order, and the fact column each one fills.
FEED_COLUMNS = {
    "fecha": "sale_date",
    "tienda": "store",
    "producto": "product",
    "categoria": "category",
    "ventas": "units",
    "stock": "stock",
    "es_festivo": "is_holiday",
    "dia_semana": "dow",
    "mes": "month",
    "semana_anio": "iso_week",
    "trimestre": "quarter",
}

# Headers that consumers of the batch outputs expect, per output.
REPORT_COLUMNS = {
    "daily_store_aggregates": {
        "sale_date": "fecha",
        "store": "tienda",
        "units_total": "ventas_total",
        "distinct_products": "productos_distintos",
        "units_mean": "venta_media_producto",
        "stock_total": "stock_total",
        "is_holiday": "es_festivo",
    },
    "weekly_category_stats": {
        "year": "anio",
        "week": "semana",
        "category": "categoria",
        "units_week": "ventas_semana",
        "units_mean": "venta_media",
        "units_std": "desviacion",
        "row_count": "num_registros",
    },
    "top_products_by_store": {
        "store": "tienda",
        "product": "producto",
        "category": "categoria",
        "total_units": "total_ventas",
        "rank": "ranking",
    },
    "stock_alerts": {
        "sale_date": "fecha",
        "store": "tienda",
        "product": "producto",
        "stock": "stock",
        "units_mean_prev7": "avg_ventas_7d",
        "state": "alerta_stock",
    },
}


def with_report_names(df: DataFrame, report: str) -> DataFrame:
    """Rename an output to the headers its consumers expect."""
    return df.withColumnsRenamed(REPORT_COLUMNS[report])
