"""Table schemas and the fixed values the operators use by default."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_int, _long, _dbl, _str = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_ts, _date = T.TimestampNTZType(), T.DateType()

RAW_SERIES = _schema(Domain=_str, Area=_str, Element=_str, Item=_str, Year=_str, Unit=_str, Value=_str)
SERIES = _schema(area=_str, year=_int, value_tonnes=_dbl)
SERIES_FEATURES = _schema(
    area=_str, year=_int, value_tonnes=_dbl, yoy_growth_pct=_dbl, ma5_tonnes=_dbl,
    cagr_5y_pct=_dbl, value_normalized=_dbl, pct_vs_global_avg=_dbl,
)
PARCELS = _schema(
    id=_long, name=_str, crop_type=_str, area_ha=_dbl, latitude=_dbl, longitude=_dbl,
    soil_type=_str, country=_str, created_at=_ts,
)
READINGS = _schema(
    id=_long, parcel_id=_long, recorded_at=_ts, soil_moisture=_dbl, soil_temp_c=_dbl, soil_ph=_dbl,
    nitrogen_ppm=_dbl, air_temp_c=_dbl, humidity_pct=_dbl, rainfall_mm=_dbl, solar_rad_wm2=_dbl,
)
OBSERVATIONS = _schema(id=_long, parcel_id=_long, observed_at=_date, ndvi_value=_dbl)
OUTCOMES = _schema(id=_long, parcel_id=_long, harvest_year=_int, yield_t_per_ha=_dbl, notes=_str)
PREDICTION_LOG = _schema(
    parcel_id=_long, predicted_at=T.TimestampType(), model_name=_str, model_version=_str,
    predicted_yield=_dbl, irrigation_rec_mm=_dbl, confidence=_dbl,
)
REQUEST = _schema(
    parcel_id=_long, crop_type=_str, year=_int, soil_moisture=_dbl, soil_ph=_dbl, nitrogen_ppm=_dbl,
    air_temp_c=_dbl, humidity_pct=_dbl, rainfall_mm=_dbl, solar_rad_wm2=_dbl, country=_str,
)
FORECAST = _schema(area=_str, ds=_str, yhat=_dbl, yhat_lower=_dbl, yhat_upper=_dbl)

# Class list (alphabetical, position = code) and water need in mm.
CROP_CLASSES = ["corn", "rice", "soybean", "sunflower", "wheat"]
WATER_NEED_MM = {"corn": 650.0, "rice": 1200.0, "soybean": 700.0, "sunflower": 450.0, "wheat": 500.0}
DEFAULT_WATER_NEED_MM = 600.0

# Response formula, per class (base, optimal temperature, optimal rain).
RESPONSE_CONFIG = {
    "wheat": (3.5, 15.0, 500.0),
    "corn": (5.5, 22.0, 650.0),
    "rice": (4.2, 28.0, 1200.0),
    "soybean": (2.8, 24.0, 700.0),
    "sunflower": (2.0, 20.0, 450.0),
}

# Coefficients of the response formula, as shares of the class base.
RESPONSE_COEFFICIENTS = {
    "intensity_gain": 0.20, "intensity_rate": 4.0, "best_ph": 6.5, "ph": -0.06, "moisture": 0.04, "nitrogen": 0.0008,
    "temperature": -0.008, "rain": -0.000008, "climate": 0.05, "least": 0.1, "noise": 0.12,
}

# Country climate (latitude, longitude, mean temperature, mean rain).
COUNTRY_CLIMATE = {
    "China, mainland": (35.9, 104.2, 12.0, 600.0),
    "United States of America": (37.1, -95.7, 13.0, 750.0),
    "Brazil": (-14.2, -51.9, 25.0, 1500.0),
    "Argentina": (-38.4, -63.6, 14.0, 600.0),
    "France": (46.2, 2.2, 11.0, 650.0),
    "Italy": (41.9, 12.6, 13.0, 750.0),
    "Japan": (36.2, 138.3, 13.0, 1700.0),
    "Colombia": (4.6, -74.1, 24.0, 3000.0),
    "India": (20.6, 78.9, 25.0, 1100.0),
    "Canada": (56.1, -106.3, 3.0, 550.0),
    "Ukraine": (48.4, 31.2, 8.0, 550.0),
    "Mexico": (23.6, -102.6, 21.0, 750.0),
    "Malaysia": (4.2, 109.5, 27.0, 2500.0),
    "Spain": (40.5, -3.7, 14.0, 650.0),
    "Thailand": (15.9, 100.9, 28.0, 1400.0),
    "Germany": (51.2, 10.5, 9.0, 620.0),
    "Australia": (-25.3, 133.8, 22.0, 450.0),
    "Turkey": (38.9, 35.2, 12.0, 600.0),
    "United Kingdom": (55.4, -3.4, 10.0, 900.0),
    "Russian Federation": (61.5, 105.3, 1.0, 500.0),
}

# Model input columns in order, and the target.
MEASURES = ["soil_moisture", "soil_ph", "nitrogen_ppm", "air_temp_c", "humidity_pct", "rainfall_mm", "solar_rad_wm2"]
SERIES_INPUTS = ["value_tonnes", "yoy_growth_pct", "ma5_tonnes", "value_normalized"]
FEATURES = ["crop_encoded", "year", *MEASURES, *SERIES_INPUTS]
TARGET = "yield_t_per_ha"

# Regression and forecast parameters, histogram bounds, log defaults.
BOOST_PARAMS = {
    "trees": 300, "depth": 6, "step": 0.05, "row_sample": 0.8, "column_sample": 0.8,
    "min_rows": 3, "l1": 0.1, "l2": 1.0, "seed": 42,
}
CUTOFF_YEAR, TOP_ENTITIES, HORIZON, INTERVAL = 2013, 10, 5, 0.95
CHANGEPOINTS, CHANGEPOINT_RANGE, CHANGEPOINT_SCALE = 25, 0.8, 0.3
LATENCY_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
MODEL_NAME, CONFIDENCE = "yield-xgboost", 0.8643
GATES = {"r2": 0.85, "rmse": 0.7, "bias": 0.05, "r2_std": 0.01}

# Default for a feature row that does not exist, by use.
MISSING_IN_SIMULATION, MISSING_IN_TRAINING, MISSING_IN_SERVING = 0.3, 0.0, 0.0

# Display colour per class and label per feature.
CROP_COLORS = {
    "corn": "#f4a261", "rice": "#2a9d8f", "soybean": "#e9c46a", "sunflower": "#e76f51", "wheat": "#264653",
}
DEFAULT_COLOR = "#888888"
FEATURE_LABELS = {
    "crop_encoded": "Crop class", "year": "Year", "soil_moisture": "Soil moisture", "soil_ph": "Soil pH",
    "nitrogen_ppm": "Nitrogen (ppm)", "air_temp_c": "Air temperature (°C)", "humidity_pct": "Air humidity (%)",
    "rainfall_mm": "Rainfall (mm)", "solar_rad_wm2": "Solar radiation (W/m²)", "value_tonnes": "Series value (t)",
    "yoy_growth_pct": "Yearly growth (%)", "ma5_tonnes": "Five-year mean (t)", "value_normalized": "Normalised value",
}
