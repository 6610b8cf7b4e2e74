"""The two governed metric views."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.operators.metricview import Dimension, Lookup, MetricView

# Business names under which dimensions and measures may also be asked for.
DEMAND_LABELS = {
    "month": "年月", "category": "品目カテゴリ", "channel": "チャネル", "domestic_only": "国内専用品目",
    "qty": "出荷数量", "amount": "出荷金額", "months": "対象月数", "avg_monthly_qty": "月平均出荷数量",
}
ACCURACY_LABELS = {
    "month": "対象年月", "category": "品目カテゴリ", "demand_class": "需要分類", "method": "予測手法",
    "avg_ape": "平均誤差率", "avg_abs_error": "平均誤差個数", "hit_rate": "予測区間的中率", "n": "予測件数",
}


def mv_demand(gold) -> MetricView:
    """Quantity and value shipped."""
    return MetricView(
        fact=gold.fct_shipments,
        lookups={"item": Lookup(gold.dim_item, "item_code", "item_code"),
                 "channel": Lookup(gold.dim_channel, "channel", "channel_code")},
        dimensions={"month": Dimension("ym"), "category": Dimension("item_category", "item"),
                    "channel": Dimension("channel_name", "channel"),
                    "domestic_only": Dimension("is_domestic_only", "item")},
        measures={"qty": F.sum("qty"), "amount": F.sum("amount"), "months": F.count_distinct("ym")},
        ratios={"avg_monthly_qty": ("qty", "months")},
        labels=DEMAND_LABELS,
    )


def mv_forecast_accuracy(gold) -> MetricView:
    """How well the forecasts hit."""
    return MetricView(
        fact=gold.fct_forecast_accuracy,
        lookups={"item": Lookup(gold.dim_item, "item_code", "item_code")},
        dimensions={"month": Dimension("target_ym"), "category": Dimension("item_category", "item"),
                    "demand_class": Dimension("demand_class", "item"), "method": Dimension("model_name")},
        measures={"avg_ape": F.avg("ape"), "avg_abs_error": F.avg("abs_error"),
                  "hit_rate": F.avg("within_interval"), "n": F.count(F.lit(1))},
        labels=ACCURACY_LABELS,
    )
