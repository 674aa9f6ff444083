"""Band edges, code legends and the wording of labels.

A ``Bands`` value cuts a number line: label ``i`` covers values below ``edges[i]``
and the last label covers the rest. ``Wording`` holds one language's texts for the
labels that end up in results, so a caller can pick the language once.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Bands:
    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("bands need exactly one label more than edges")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("band edges must rise")


@dataclass(frozen=True)
class Wording:
    days: tuple[str, ...]  # from Sunday to Saturday
    night: str
    morning: str
    afternoon: str
    evening: str
    categories: tuple[str, ...]
    payments: tuple[str, ...]  # codes 1 to 5, then any other code
    anomaly_types: tuple[str, ...]  # distance, fare, speed, other
    profiles: tuple[str, ...]  # short fast, short slow, long fluid, long congested, other
    revenue: tuple[str, ...]
    tips: tuple[str, ...]
    scenario: str

    @property
    def period_bands(self) -> Bands:
        return Bands(
            PERIOD_HOURS,
            (self.night, self.morning, self.afternoon, self.evening, self.night),
        )

    @property
    def category_bands(self) -> Bands:
        return Bands(CATEGORY_KM, self.categories)

    @property
    def revenue_bands(self) -> Bands:
        return Bands(REVENUE_FARE, self.revenue)

    @property
    def tip_bands(self) -> Bands:
        return Bands(TIP_CATEGORY_PCT, self.tips)


# Thresholds, edges, codes and texts that results depend on.
KM_PER_MILE = 1.60934
SHORT_TRIP_KM = 10
MAX_DISTANCE_MILES = 200
MAX_FARE = 500
MAX_TOTAL = 600
MAX_PASSENGERS = 6
MAX_SPEED_KMH = 200
MAX_MINUTES = 300
BUCKET_MINUTES = 5
MIN_GROUP = 2
DETOUR_FACTOR = 1.1
RIDERS_PER_CAR = (2, 3)
Z_LIMIT = 3
RUSH_HOURS = (7, 8, 9, 17, 18, 19)
CARD = 1
CASH = 2
PROFILE_KM = 5
PROFILE_MINUTES = 15
PROFILE_KMH = 30
EFFICIENCY_MINUTES = 10

PERIOD_HOURS = (6, 12, 18, 23)
CATEGORY_KM = (3, 10, 20, 50)
REVENUE_FARE = (10, 25, 50)
TIP_CATEGORY_PCT = (10, 20)

AMOUNT_BANDS = Bands(
    (10, 20, 30, 50, 100),
    ("< 10$", "10-20$", "20-30$", "30-50$", "50-100$", "> 100$"),
)
FARE_BANDS = Bands(
    (10, 20, 30, 50),
    ("< 10$", "10-20$", "20-30$", "30-50$", "> 50$"),
)
TIP_BANDS = Bands(
    (10, 15, 20, 25),
    ("< 10%", "10-15%", "15-20%", "20-25%", "> 25%"),
)

RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

ENGLISH = Wording(
    days=("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"),
    night="Night (23h-5h)",
    morning="Morning (6h-11h)",
    afternoon="Afternoon (12h-17h)",
    evening="Evening (18h-22h)",
    categories=(
        "Very short (< 3 km)",
        "Short (3-10 km)",
        "Medium (10-20 km)",
        "Long (20-50 km)",
        "Very long (> 50 km)",
    ),
    payments=("Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided"),
    anomaly_types=("Excessive distance", "Abnormal fare", "Abnormal speed", "Other"),
    profiles=("Short and fast", "Short but slow", "Long and fluid", "Long and congested", "Other"),
    revenue=("Low revenue", "Medium revenue", "Good revenue", "Excellent revenue"),
    tips=("Low tip", "Standard tip", "Generous tip"),
    scenario="{} passengers/taxi",
)

FRENCH = Wording(
    days=("Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"),
    night="Nuit (23h-5h)",
    morning="Matin (6h-11h)",
    afternoon="Après-midi (12h-17h)",
    evening="Soirée (18h-22h)",
    categories=(
        "Très court (< 3 km)",
        "Court (3-10 km)",
        "Moyen (10-20 km)",
        "Long (20-50 km)",
        "Très long (> 50 km)",
    ),
    payments=("Carte de crédit", "Espèces", "Sans frais", "Litige", "Inconnu", "Annulé"),
    anomaly_types=("Distance excessive", "Tarif anormal", "Vitesse anormale", "Autre"),
    profiles=(
        "Court et rapide",
        "Court mais lent",
        "Long et fluide",
        "Long et congestionné",
        "Autre",
    ),
    revenue=("Faible revenu", "Revenu moyen", "Bon revenu", "Excellent revenu"),
    tips=("Faible pourboire", "Pourboire standard", "Généreux pourboire"),
    scenario="{} passagers/taxi",
)
