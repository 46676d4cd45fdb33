"""Status labels, tones and job names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.numbers import as_column
from tradeloom.functions.text import contains_any, lookup_label

# Status codes of the two marketplaces and their labels.
OZON_STATUS_LABELS = {
    "awaiting_registration": "Ожидает регистрации",
    "acceptance_in_progress": "Идёт приёмка",
    "awaiting_approve": "Ожидает подтверждения",
    "awaiting_packaging": "Ожидает сборки",
    "awaiting_deliver": "Ожидает отгрузки",
    "arbitration": "Арбитраж",
    "client_arbitration": "Клиентский арбитраж",
    "delivering": "Доставляется",
    "driver_pickup": "Ожидает курьера",
    "delivered": "Доставлен",
    "cancelled": "Отменён",
    "not_accepted": "Не принят",
    "sent_by_seller": "Передан продавцом",
}
WB_STATUS_LABELS = {"active": "Активный", "cancelled": "Отменён"}

# Job names and the action each belongs to.
JOB_ACTIONS = {
    "wb_orders": "wb_orders",
    "wb_order_feed": "wb_order_feed",
    "wb_product_cards": "wb_product_cards",
    "wb_stocks": "wb_stocks",
    "ozon_orders": "ozon_orders",
    "ozon_product_cards": "ozon_product_cards",
    "ozon_stocks": "ozon_stocks",
    "ozon_placement": "ozon_placement",
    "source_statistics": "source_files",
    "source_files": "source_files",
    "source_costs": "source_costs",
    "api_erp_tru_product_stats": "erp_tru_sales",
    "sheets_api_erp_tru_sales_export": "erp_tru_sales",
    "sheets_orders_export": "sheets_orders",
}

# Words that decide the tone of a status.
GOOD_STATUSES = ("ok", "success", "active", "delivered", "задан", "доставлен", "активный")
BAD_STATUSES = ("error", "failed", "fail", "cancelled", "не задан", "отменён", "отменен")
WARN_MARKERS = ("awaiting", "ожидает", "process", "running", "идёт")


def status_label(status: Column | str, marketplace: str) -> Column:
    labels = {"ozon": OZON_STATUS_LABELS, "wb": WB_STATUS_LABELS}[marketplace]
    return lookup_label(status, labels)


def status_tone(status: Column | str) -> Column:
    text = F.lower(F.coalesce(as_column(status).cast("string"), F.lit("")))
    return (
        F.when(text.isin(*GOOD_STATUSES), F.lit("good"))
        .when(text.isin(*BAD_STATUSES), F.lit("bad"))
        .when(contains_any(text, WARN_MARKERS), F.lit("warn"))
        .otherwise(F.lit("info"))
    )
