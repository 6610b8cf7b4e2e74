"""Schemas, key lists and decision constants shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: domain vocabulary, thresholds and rule parameters ----------
CHANNELS = ("DOM", "EXP")
DEMAND_CLASSES = ("smooth", "erratic", "intermittent", "lumpy", "lumpy_severe")
HARD_CLASSES = ("intermittent", "lumpy", "lumpy_severe")
ADI_CUT = 1.32
CV2_CUT = 0.49
SEVERE_CV2_CUT = 1.1
TOLERANCE = {"adi": 0.25, "cv2": 0.35, "mean_qty": 0.20}
BASELINE_MODEL = "baseline_seasonal_naive"
BASELINE_RATIO = (0.6, 1.5)
MODEL_RATIO = (0.7, 1.3)
MODEL_PREFIX = "demand_forecast_v"
GROUPED_MODEL = "ai_forecast"
MAIN_ROUTE = "main_pipeline"
SEPARATE_ROUTE = "separate_pipeline"
HORIZON_MONTHS = 18
HOLDOUT_MONTHS = 12
BACKTEST_MONTHS = 24
BACKTEST_STRIDE = 6
MIN_HISTORY_MONTHS = 24
SAFETY_MONTHS = 1.5
SITES_OF_CHANNEL = {"DOM": {"TOKYO_DC": 0.6, "OSAKA_DC": 0.4}, "EXP": {"OVERSEAS_HUB": 1.0}}
VALID_MONTHS = 12
RECENT_MONTHS = 3
BUILT_MONTHS_AGO = 6
FEATURES = (
    "month", "month_index", "lag_1", "lag_2", "lag_3", "lag_12",
    "roll_mean_3", "roll_mean_6", "roll_mean_12", "roll_std_6", "nonzero_ratio_12",
)
TRIAL_GRID = (
    {"name": "shallow", "max_depth": 3, "learning_rate": 0.10, "max_iter": 150},
    {"name": "standard", "max_depth": 6, "learning_rate": 0.05, "max_iter": 400},
    {"name": "deep", "max_depth": 12, "learning_rate": 0.05, "max_iter": 400},
)
DEFAULT_PARAMS = {"max_depth": 6, "learning_rate": 0.05, "max_iter": 400}
SEED = 42
# --- end of fixed values ------------------------------------------------------

SERIES = ["item_code", "channel"]
SHIPMENT_KEY = ["item_code", "channel", "ym"]
FORECAST_KEY = ["item_code", "channel", "target_ym"]
FORECAST_COLUMNS = FORECAST_KEY + ["model_name", "p50", "lower_bound", "upper_bound"]

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class SourceSpec:
    """One landing feed: typed columns, natural key and the month columns to normalise."""

    name: str
    ddl: str
    key: tuple[str, ...]
    months: tuple[str, ...] = ()
    file_time: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# --- Fixed values: column names and types of the six landing feeds ------------
SOURCES = {
    s.name: s
    for s in (
        SourceSpec(
            "shipments",
            "item_code STRING, channel STRING, ym DATE, qty INT",
            ("item_code", "channel", "ym"), ("ym",), file_time=True,
        ),
        SourceSpec(
            "items",
            "item_code STRING, item_name STRING, item_category STRING, item_type STRING, "
            "unit_price INT, demand_class STRING, adi DOUBLE, cv2 DOUBLE, "
            "is_domestic_only BOOLEAN, launch_ym DATE",
            ("item_code",), ("launch_ym",),
        ),
        SourceSpec(
            "channels",
            "channel_code STRING, channel_name STRING, description STRING",
            ("channel_code",),
        ),
        SourceSpec(
            "inventory",
            "item_code STRING, site_code STRING, ym DATE, closing_qty INT, "
            "safety_stock_qty INT, stockout_flag INT",
            ("item_code", "site_code", "ym"), ("ym",),
        ),
        SourceSpec(
            "lead_time",
            "item_code STRING, site_code STRING, standard_lead_time_days INT",
            ("item_code", "site_code"),
        ),
        SourceSpec(
            "forecast_baseline",
            "item_code STRING, channel STRING, target_ym DATE, forecast_run_ym DATE, "
            "model_name STRING, p50 DOUBLE, lower_bound DOUBLE, upper_bound DOUBLE",
            ("item_code", "channel", "target_ym", "forecast_run_ym", "model_name"),
            ("target_ym", "forecast_run_ym"),
        ),
    )
}
# --- end of fixed values ------------------------------------------------------
