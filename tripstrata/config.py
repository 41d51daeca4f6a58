"""Thresholds, column lists and table names shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: raw column names and their types -------------------------
RAW_COLUMNS = (
    "id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "store_and_fwd_flag", "trip_duration",
)
SCORING_ABSENT = ("dropoff_datetime", "trip_duration")
RAW_TYPES = {
    "id": "string",
    "vendor_id": "string",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "passenger_count": "int",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
    "trip_duration": "int",
}
FLAG_COLUMN = "store_and_fwd_flag"
RULE_NAMES = ("v_duracion", "v_pasajeros", "v_coords_pickup", "v_coords_dropoff", "v_completitud")
VALID_COLUMN = "es_valido"

PICKUP = ("pickup_latitude", "pickup_longitude")
DROPOFF = ("dropoff_latitude", "dropoff_longitude")
TRAIN, TEST = "train", "test"

EARTH_RADIUS_KM = 6371.0088
# Upper ends of the right-closed distance bands in km; the last band is open.
DISTANCE_CUTS = (0.0, 1.0, 2.0, 3.0, 5.0, 8.0, 12.0, 20.0)
# The closed list of bands used when describing dispersion, and for residuals.
DISPERSION_CUTS = (0.0, 1.0, 2.0, 3.0, 5.0, 8.0, 12.0, 20.0, 100.0)
RESIDUAL_CUTS = (0.0, 2.0, 5.0, 10.0, 20.0, 100.0)
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
INTENSITIES = (0.0, 0.25, 0.5, 1.0, 1.5, 2.0)


@dataclass(frozen=True)
class Thresholds:
    """Limits that decide what is valid, near, drifting or alarming."""

    duration_min_s: int = 1
    duration_max_s: int = 21600
    passengers_min: int = 1
    passengers_max: int = 6
    lat_min: float = 40.50
    lat_max: float = 41.00
    lon_min: float = -74.30
    lon_max: float = -73.70
    split_cutoff: str = "2016-06-17"
    sites: dict = field(default_factory=lambda: {"JFK": (40.6413, -73.7781), "LGA": (40.7769, -73.8740)})
    site_radius_km: float = 2.0
    km_per_deg_lat: float = 111.0
    km_per_deg_lon: float = 84.0
    zones: int = 20
    seed: int = 42
    psi_stable: float = 0.10
    psi_alert: float = 0.25
    psi_floor: float = 1e-6
    psi_bins: int = 10
    proposed_psi_alert: float = 0.15
    usual_quarantine_pct: float = 0.21
    quarantine_factor: float = 3.0
    coverage_weight: float = 0.05
    mae_attention: float = 1.15
    mae_critical: float = 1.30
    tail_minutes: float = 15.0
    scenario_ceiling: float = 0.95


@dataclass(frozen=True)
class ModelColumns:
    """Inputs of the duration models; anything not listed stays out."""

    whitelist: tuple = (
        "vendor_id", "passenger_count", "store_and_fwd_flag", "pickup_hour", "pickup_dayofweek",
        "pickup_month", "is_weekend", "distancia_haversine_km", "distancia_manhattan_km",
        "bearing_deg", "pickup_cluster", "dropoff_cluster", "es_aeropuerto",
    )
    categorical: tuple = (
        "pickup_hour", "pickup_dayofweek", "pickup_month", "pickup_cluster", "dropoff_cluster", "vendor_id",
    )
    numeric: tuple = (
        "distancia_haversine_km", "distancia_manhattan_km", "bearing_deg", "passenger_count",
        "store_and_fwd_flag", "is_weekend", "es_aeropuerto",
    )
    forbidden: tuple = (
        "dropoff_datetime", "trip_duration", "log_trip_duration", "velocidad_kmh", "duracion_min",
    )
    effect_factors: tuple = (
        "pickup_hour", "pickup_dayofweek", "pickup_cluster", "dropoff_cluster", "es_aeropuerto",
        "vendor_id", "passenger_count", "pickup_month",
    )
    monitored: tuple = (
        "distancia_haversine_km", "distancia_manhattan_km", "bearing_deg", "pickup_hour",
        "pickup_dayofweek", "pickup_cluster", "dropoff_cluster", "passenger_count", "es_aeropuerto",
    )
    split_checked: tuple = (
        "distancia_haversine_km", "distancia_manhattan_km", "bearing_deg", "pickup_hour", "trip_duration",
    )
    target: str = "trip_duration"
    target_log: str = "log_trip_duration"

    @property
    def ordered(self) -> tuple:
        """Canonical order: magnitudes first, then labels."""
        return self.numeric + self.categorical

    def categorical_indices(self, columns=None) -> list[int]:
        """Positions of the label columns inside ``columns`` (canonical order by default)."""
        columns = list(columns or self.ordered)
        return [columns.index(c) for c in self.categorical]


@dataclass(frozen=True)
class TableNames:
    """Table names per layer. ``catalog`` is optional."""

    catalog: str = ""
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def _name(self, schema: str, table: str) -> str:
        return ".".join(p for p in (self.catalog, schema, table) if p)

    @property
    def schemas(self) -> list[str]:
        return [".".join(p for p in (self.catalog, s) if p) for s in (self.bronze, self.silver, self.gold)]

    @property
    def raw_trips(self):
        return self._name(self.bronze, "raw_trips")

    @property
    def raw_scoring(self):
        return self._name(self.bronze, "raw_scoring")

    @property
    def clean(self):
        return self._name(self.silver, "clean_trips")

    @property
    def quarantine(self):
        return self._name(self.silver, "quarantine_trips")

    @property
    def dq_metrics(self):
        return self._name(self.silver, "dq_metrics")

    @property
    def analytics(self):
        return self._name(self.gold, "trips_analytics")

    @property
    def demand(self):
        return self._name(self.gold, "agg_demanda_zona_hora")

    @property
    def features(self):
        return self._name(self.gold, "trips_features")

    @property
    def drift(self):
        return self._name(self.gold, "monitoring_drift")

    @property
    def zones(self):
        return self._name(self.gold, "zones")

    @property
    def alerts(self):
        return self._name(self.gold, "alerts")

    @property
    def model_runs(self):
        return self._name(self.gold, "model_runs")


THRESHOLDS = Thresholds()
MODEL = ModelColumns()
TABLES = TableNames()
