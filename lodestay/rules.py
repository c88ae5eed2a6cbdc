"""Declarative rules. Every operator takes a rule object; nothing below it hard-codes a column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from .errors import RuleError


@dataclass(frozen=True)
class CurrencyRule:
    columns: tuple[str, ...]
    base_currency: str
    exchange_rates: Mapping[str, float]


@dataclass(frozen=True)
class City:
    latitude: float
    longitude: float
    currency: str


@dataclass(frozen=True)
class MissingRule:
    column: str
    action: str


@dataclass(frozen=True)
class PlausibilityRule:
    """Keep a row only if ``column <= factor * max_of + offset``."""

    column: str
    max_of: str
    factor: float
    offset: float


@dataclass(frozen=True)
class CapRule:
    columns: tuple[str, ...]
    group_by: str
    quantile: float


@dataclass(frozen=True)
class OutlierRule:
    columns: tuple[str, ...]
    iqr_multiplier: float = 1.5
    scale: str = "log"
    method: str = "iqr"
    action: str = "drop_row"


@dataclass(frozen=True)
class DummyRule:
    source: str
    target: str
    keywords: tuple[str, ...]
    delete: bool = False


@dataclass(frozen=True)
class RatioRule:
    target: str
    numerator: str
    denominator: str | float
    delete: bool = False


@dataclass(frozen=True)
class DistanceRule:
    target: str = "proximity_city_center"
    latitude: str = "latitude"
    longitude: str = "longitude"
    delete: bool = False


@dataclass(frozen=True)
class CategoryRule:
    column: str
    min_count: int
    other_label: str = "_other"


@dataclass(frozen=True)
class SquareRule:
    source: str
    target: str
    center: bool = True


@dataclass(frozen=True)
class ModelSpec:
    name: str
    target: str
    predictors: tuple[str, ...]
    log_scale: bool = True
    log1p_predictors: tuple[str, ...] = ()

    @property
    def response(self) -> str:
        return f"log_{self.target}" if self.log_scale else self.target

    def without(self, columns) -> "ModelSpec":
        gone = set(columns)
        return replace(
            self,
            predictors=tuple(p for p in self.predictors if p not in gone),
            log1p_predictors=tuple(p for p in self.log1p_predictors if p not in gone),
        )


@dataclass(frozen=True)
class OccupancyRule:
    group_by: tuple[str, ...]
    min_count: int
    fallback: str
    high_quantile: float


@dataclass(frozen=True)
class InputRule:
    column: str
    whole: bool
    min: float | None = None
    max: float | None = None
    groups: tuple[str, ...] = ("new", "listed")


@dataclass(frozen=True)
class LocationRule:
    coordinate_margin_deg: float = 0.005
    distance_margin_km: float = 0.5


@dataclass(frozen=True)
class RatingTips:
    columns: tuple[str, ...]
    step: float = 0.1


# ---------------------------------------------------------------------------------------------
# Column lists, labels, keywords and constants that decide the results.
# ---------------------------------------------------------------------------------------------

EARTH_RADIUS_KM = 6371.0
DAYS_PER_YEAR = 365
ENTIRE_HOME = "Entire home/apt"

AMENITIES = (
    "has_balcony", "has_AC", "allows_pets", "has_kitchen", "has_pool", "has_tv", "has_kettle",
    "has_washer", "has_dishwasher", "has_elevator", "has_self_checkin",
)
SIZE_LOCATION = (
    "room_type", "district", "accommodates", "accommodates_sq", "bedrooms", "beds", "bathrooms",
    "proximity_city_center", "minimum_nights", "is_superhost",
)
SUBSCORES = (
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location", "review_scores_value",
)
RATING = ("review_scores_rating", "rating_sq")

RELEVANT_COLUMNS = (
    "id", "room_type", "accommodates", "beds", "bedrooms", "bathrooms", "bathrooms_text", "latitude",
    "longitude", "neighbourhood_cleansed", "amenities", "minimum_nights", "estimated_occupancy_l365d",
    "availability_365", "host_is_superhost", "review_scores_rating", "number_of_reviews",
    "reviews_per_month", *SUBSCORES, "price", "estimated_revenue_l365d",
)
LABEL_MAPPING = {
    "host_is_superhost": "is_superhost",
    "number_of_reviews": "number_ratings",
    "estimated_revenue_l365d": "estimated_revenue",
    "neighbourhood_cleansed": "district",
}
COLUMN_TYPES = {
    c: "double"
    for c in ("price", "estimated_revenue", "beds", "bedrooms", "bathrooms", "minimum_nights", *SUBSCORES)
}

DROP_ROW = "drop_row"
FILL_ZERO = "fill_zero"
IMPUTE_MEDIAN = "impute_median_by_room_type"
IMPUTE_OR_DROP = "impute_median_or_drop_entire_home"
FILL_FROM_TEXT = "fill_from_bathrooms_text"

MISSING_RULES = (
    MissingRule("price", DROP_ROW),
    MissingRule("estimated_revenue", DROP_ROW),
    MissingRule("is_superhost", DROP_ROW),
    MissingRule("review_scores_rating", DROP_ROW),
    MissingRule("reviews_per_month", FILL_ZERO),
    MissingRule("bedrooms", IMPUTE_OR_DROP),
    MissingRule("beds", IMPUTE_OR_DROP),
    MissingRule("bathrooms", FILL_FROM_TEXT),
    MissingRule("minimum_nights", DROP_ROW),
    *(MissingRule(c, DROP_ROW) for c in SUBSCORES),
)

DUMMY_RULES = (
    DummyRule("amenities", "has_balcony", ("balcony",)),
    DummyRule("amenities", "has_AC", ("air conditioning", "ac -")),
    DummyRule("amenities", "allows_pets", ("pets allowed",)),
    DummyRule("amenities", "has_kitchen", ('"kitchen"', "kitchenette")),
    DummyRule("amenities", "has_pool",
              ('"pool"', '"pool -', "shared pool", "private pool", "outdoor pool", "indoor pool")),
    DummyRule("amenities", "has_tv", ("tv",)),
    DummyRule("amenities", "has_kettle", ("hot water kettle",)),
    DummyRule("amenities", "has_washer", ('"washer', "free washer", "paid washer")),
    DummyRule("amenities", "has_dishwasher", ('"dishwasher"',)),
    DummyRule("amenities", "has_elevator", ('"elevator"',)),
    DummyRule("amenities", "has_self_checkin", ("self check-in",)),
    DummyRule("is_superhost", "is_superhost", ("t",)),
)

AMENITY_LABELS = {
    "has_balcony": "Balcony", "has_AC": "Air conditioning", "allows_pets": "Pets allowed",
    "has_kitchen": "Kitchen or kitchenette", "has_pool": "Pool", "has_tv": "TV", "has_kettle": "Kettle",
    "has_washer": "Washing machine", "has_dishwasher": "Dishwasher", "has_elevator": "Elevator",
    "has_self_checkin": "Self check-in",
}
TERM_LABELS = {
    "accommodates": "each extra guest",
    "proximity_city_center": "each km from the centre",
    "minimum_nights": "longer minimum stay (log)",
    "room_type: Private room": "private room instead of entire home",
    "is_superhost": "Superhost",
    "review_scores_cleanliness": "cleanliness rating",
    "review_scores_accuracy": "accuracy rating",
}
STATUS_MESSAGES = {
    "underpriced": "probably underpriced; demand is strong at your price",
    "in_line": "in line with comparable listings",
    "not_price_problem": "cheap but few bookings; check photos, description, visibility",
    "overpriced": "possibly overpriced",
    "unexplained_premium": "guests pay more than the model expects; no action",
}
CITIES = {
    "Athens": City(37.9838, 23.7275, "EUR"),
    "Barcelona": City(41.3851, 2.1734, "EUR"),
    "Madrid": City(40.4168, -3.7038, "EUR"),
}
IMPORTANCE_GROUPS = {
    "Size": ("accommodates", "accommodates_sq", "bedrooms", "beds", "bathrooms"),
    "Location": ("district", "proximity_city_center"),
    "Minimum nights": ("minimum_nights",),
    "Room type": ("room_type",),
    "Amenities": AMENITIES,
    "Rating": RATING,
    "Superhost": ("is_superhost",),
}
INPUT_RULES = (
    InputRule("accommodates", True, 1),
    InputRule("bedrooms", True),
    InputRule("beds", True, 1),
    InputRule("bathrooms", False, 0.5),
    InputRule("minimum_nights", True, 1),
    InputRule("price", False, groups=("listed",)),
    InputRule("review_scores_rating", False, 1.0, 5.0, groups=("listed",)),
    InputRule("estimated_occupancy_l365d", True, 1, 255, groups=("listed",)),
)
MOST_COMMON = "most_common"


@dataclass(frozen=True)
class Rules:
    """All rules of a run. ``dataclasses.replace`` gives a variant."""

    relevant_columns: tuple[str, ...] = RELEVANT_COLUMNS
    label_mapping: Mapping[str, str] = field(default_factory=lambda: dict(LABEL_MAPPING))
    column_types: Mapping[str, str] = field(default_factory=lambda: dict(COLUMN_TYPES))
    currency: CurrencyRule = CurrencyRule(("price", "estimated_revenue"), "EUR", {"USD": 0.89, "EUR": 1.0})
    cities: Mapping[str, City] = field(default_factory=lambda: dict(CITIES))
    deduplicate_columns: tuple[str, ...] = ("id",)
    no_booking_columns: tuple[str, ...] = ("estimated_revenue",)
    missing: tuple[MissingRule, ...] = MISSING_RULES
    room_type_column: str = "room_type"
    bathrooms_text_column: str = "bathrooms_text"
    entire_home_label: str = ENTIRE_HOME
    plausibility: tuple[PlausibilityRule, ...] = (
        PlausibilityRule("bedrooms", "accommodates", 1.0, 0.0),
        PlausibilityRule("bathrooms", "bedrooms", 1.0, 2.0),
        PlausibilityRule("beds", "accommodates", 2.0, 0.0),
    )
    caps: CapRule = CapRule(("accommodates", "bedrooms", "beds", "bathrooms"), "room_type", 0.995)
    outliers: OutlierRule = OutlierRule(("price", "estimated_revenue"))
    dummies: tuple[DummyRule, ...] = DUMMY_RULES
    ratios: tuple[RatioRule, ...] = (
        RatioRule("occupancy_rate", "estimated_occupancy_l365d", DAYS_PER_YEAR),
        RatioRule("ratio_occupancy_availability", "estimated_occupancy_l365d", "availability_365"),
    )
    distance: DistanceRule = DistanceRule()
    category: CategoryRule = CategoryRule("district", 20)
    squares: tuple[SquareRule, ...] = (
        SquareRule("accommodates", "accommodates_sq"),
        SquareRule("review_scores_rating", "rating_sq"),
    )
    test_size: float = 0.2
    split_seed: int = 42
    models: tuple[ModelSpec, ...] = (
        ModelSpec("price", "price", (*SIZE_LOCATION, *RATING, *AMENITIES), log1p_predictors=("minimum_nights",)),
        ModelSpec("price_explain", "price", (*SIZE_LOCATION, *SUBSCORES, *AMENITIES),
                  log1p_predictors=("minimum_nights",)),
        ModelSpec("revenue_baseline", "estimated_revenue", (*SIZE_LOCATION, *RATING, *AMENITIES),
                  log1p_predictors=("minimum_nights",)),
    )
    reference_levels: Mapping[str, str] = field(
        default_factory=lambda: {"room_type": MOST_COMMON, "district": MOST_COMMON})
    interval_level: float = 0.8
    significance_level: float = 0.05
    min_effect_pct: float = 1.0
    min_room_type_count: int = 30
    occupancy: OccupancyRule = OccupancyRule(("district", "room_type"), 20, "room_type", 0.5)
    actionable_amenities: tuple[str, ...] = (
        "has_AC", "has_tv", "has_kettle", "has_washer", "has_dishwasher", "has_self_checkin", "allows_pets")
    rating_tips: RatingTips = RatingTips(("review_scores_cleanliness", "review_scores_accuracy"))
    importance_groups: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(IMPORTANCE_GROUPS))
    inputs: tuple[InputRule, ...] = INPUT_RULES
    location: LocationRule = LocationRule()
    comparables: int = 5
    tips_shown: int = 3

    def model(self, name: str) -> ModelSpec:
        for spec in self.models:
            if spec.name == name:
                return spec
        raise RuleError(f"no model named {name}; there are {', '.join(s.name for s in self.models)}")

    @property
    def ratio_denominators(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(r.denominator for r in self.ratios if isinstance(r.denominator, str)))

