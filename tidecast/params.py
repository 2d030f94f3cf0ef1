"""Parameters of the pipeline as plain dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference for equal results.
LOOKBACK_DAYS = 30
FORECAST_DAYS = 7
TRAIN_FRACTION = 0.8
PROMO_SENTINEL = 9999          # promo counters before the first / after the last promo
FUTURE_PROMO_CAP = 10          # promo counters are capped at 10 in the forecast horizon
DEMAND_HIGH = 4500             # demand level thresholds of the service
DEMAND_MEDIUM = 3500

# Feature lists (fixed values). Past stream, then the known-future stream.
PAST_FEATURES = [
    "Sales", "Promo", "SchoolHoliday", "DayOfWeek", "Month", "Day", "IsWeekend",
    "lag_7_sales", "rolling_7_sales", "rolling_14_sales", "rolling_7_std_sales",
    "is_month_start", "is_month_end", "is_april",
    "promo_schoolholiday", "weekend_schoolholiday", "promo_weekend",
    "days_since_last_promo", "days_until_next_promo",
    "sales_vs_lag7",
]
FUTURE_FEATURES = [
    "Promo", "SchoolHoliday", "DayOfWeek", "Month", "Day", "IsWeekend",
    "lag_7_sales", "rolling_7_sales", "rolling_14_sales", "rolling_7_std_sales",
    "is_month_start", "is_month_end", "is_april",
    "promo_schoolholiday", "weekend_schoolholiday", "promo_weekend",
    "days_since_last_promo", "days_until_next_promo",
]
# The other feature sets (fixed values): first real set, synthetic sets.
PAST_FEATURES_V1 = ["Sales", "Promo", "SchoolHoliday", "DayOfWeek", "Month", "Day", "IsWeekend",
                    "lag_7_sales", "rolling_7_sales"]
FUTURE_FEATURES_V1 = ["Promo", "SchoolHoliday", "DayOfWeek", "Month", "Day", "IsWeekend",
                      "lag_7_sales", "rolling_7_sales"]
SYNTHETIC_PAST = ["units_sold", "price", "stock", "promotion", "day_of_week", "month"]
SYNTHETIC_FUTURE = ["price", "promotion", "day_of_week", "month"]
SYNTHETIC_PAST_V3 = ["units_sold", "price", "stock", "promotion", "day_of_week", "month", "is_weekend",
                     "rolling_7_day_average"]
SYNTHETIC_FUTURE_V3 = ["price", "promotion", "day_of_week", "month", "is_weekend",
                       "same_day_last_week_sales", "rolling_7_day_average"]
LAG_COLUMNS = ["lag_7_sales", "rolling_7_sales", "rolling_14_sales",
               "rolling_7_std_sales", "sales_vs_lag7"]

# Categories of the one-hot columns (fixed values).
CATEGORIES = {
    "StateHoliday": ["0", "a", "b", "c"],
    "StoreType": ["a", "b", "c", "d"],
    "Assortment": ["a", "b", "c"],
}
WEEKDAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Columns kept from the merged table, in this order (fixed values).
KEEP_COLUMNS = [
    "Date", "Store", "DayOfWeek", "Sales", "Open", "Promo", "StateHoliday",
    "SchoolHoliday", "StoreType", "Assortment", "CompetitionDistance",
    "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2",
    "Promo2SinceWeek", "Promo2SinceYear",
]
ZERO_FILL_COLUMNS = ["CompetitionOpenSinceMonth", "CompetitionOpenSinceYear",
                     "Promo2SinceWeek", "Promo2SinceYear"]

# Service texts (fixed values).
TEXT_NO_STOCK = ("Forecast generated successfully. Add current_stock to receive "
                 "stock-out and reorder recommendations.")
TEXT_HIGH = "High stock-out risk. Reorder immediately."
TEXT_MEDIUM = "Stock level is close to the reorder point. Reorder soon."
TEXT_LOW = "Stock level looks sufficient for the next 7 open days."
TEXT_REPORT_REORDER = "Reorder immediately. Recommended quantity: {qty} units."
TEXT_REPORT_SUFFICIENT = "Stock levels are sufficient for this period."
REASON_STOCK = "Lowest stock-out risk, higher projected stock, or lower reorder need."
REASON_SALES = ("Highest predicted sales. Inventory risk cannot be compared "
                "without current_stock.")
RISK_SCORE = {"low": 100, "medium": 50, "high": 0}


@dataclass(frozen=True)
class WindowParams:
    lookback: int = LOOKBACK_DAYS
    horizon: int = FORECAST_DAYS
    train_fraction: float = TRAIN_FRACTION
    validation_fraction: float = 0.2


@dataclass(frozen=True)
class DemandThresholds:
    high: int = DEMAND_HIGH
    medium: int = DEMAND_MEDIUM


@dataclass(frozen=True)
class LinearPlan:
    """A linear forecast of a future day from its lag, the frozen rolling mean and
    the planned events (our own coefficients: the published models' weights are
    not available). Event effects are shares of the rolling mean."""
    lag: float = 0.6
    rolling: float = 0.4
    promo: float = 0.25
    school_holiday: float = -0.1
    promo_weekend: float = 0.05
    name: str = "LinearPlan"
    version: str = "v1"


@dataclass(frozen=True)
class Request:
    """One forecast request (defaults of the service)."""
    forecast_days: int | None = 7
    forecast_open_days_only: bool = True
    promo_dates: list = field(default_factory=list)
    school_holiday_dates: list = field(default_factory=list)
    current_stock: int | None = None
    unit_price: float | None = None
    reorder_lead_time_days: int = 3
    safety_stock_percentage: float = 0.15
