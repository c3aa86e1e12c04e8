"""Fixed vocabularies: metric names, source schemas, renames and thresholds.

Everything here is a fixed value that results depend on; no logic.
"""

# Weather-station metrics of the long fact.
WU_METRICS = [
    "temperature", "temperature_high", "temperature_low",
    "humidity", "humidity_high", "humidity_low",
    "precip_rate", "precip_total",
    "pressure_max", "pressure_min", "pressure_trend",
    "wind_speed_avg", "wind_speed_high", "wind_speed_low",
    "wind_gust_avg", "wind_gust_high", "wind_gust_low",
    "wind_direction_avg",
    "dew_point_avg", "dew_point_high", "dew_point_low",
    "heat_index_avg", "heat_index_high", "heat_index_low",
    "wind_chill_avg", "wind_chill_high", "wind_chill_low",
    "solar_radiation", "uv_high",
]

# Air-quality metrics of the long fact.
TSI_METRICS = [
    "pm1_0", "pm2_5", "pm4_0", "pm10", "pm2_5_aqi", "pm10_aqi",
    "ncpm0_5", "ncpm1_0", "ncpm2_5", "ncpm4_0", "ncpm10",
    "temperature", "humidity", "tpsize",
    "co2_ppm", "co_ppm", "o3_ppb", "no2_ppb", "so2_ppb", "ch2o_ppb", "voc_mgm3",
    "baro_inhg",
]

# Metric manifest (identifier field, time field, expected metrics per source).
MANIFEST = {
    "WU": {"native_id_field": "stationID", "timestamp_field": "obsTimeUtc",
           "metrics": WU_METRICS + ["qc_status"]},
    "TSI": {"native_id_field": "device_id", "timestamp_field": "cloud_timestamp",
            "metrics": ["latitude", "longitude"] + TSI_METRICS},
}

# Weather-station field -> canonical column.
WU_RENAMES = {
    "stationID": "native_sensor_id",
    "obsTimeUtc": "timestamp",
    "tempAvg": "temperature", "tempHigh": "temperature_high", "tempLow": "temperature_low",
    "humidityAvg": "humidity", "humidityHigh": "humidity_high", "humidityLow": "humidity_low",
    "precipRate": "precip_rate", "precipTotal": "precip_total",
    "windspeedAvg": "wind_speed_avg", "windspeedHigh": "wind_speed_high", "windspeedLow": "wind_speed_low",
    "windgustAvg": "wind_gust_avg", "windgustHigh": "wind_gust_high", "windgustLow": "wind_gust_low",
    "winddirAvg": "wind_direction_avg",
    "pressureMax": "pressure_max", "pressureMin": "pressure_min", "pressureTrend": "pressure_trend",
    "solarRadiationHigh": "solar_radiation",
    "uvHigh": "uv_high",
    "windchillAvg": "wind_chill_avg", "windchillHigh": "wind_chill_high", "windchillLow": "wind_chill_low",
    "heatindexAvg": "heat_index_avg", "heatindexHigh": "heat_index_high", "heatindexLow": "heat_index_low",
    "dewptAvg": "dew_point_avg", "dewptHigh": "dew_point_high", "dewptLow": "dew_point_low",
    "qcStatus": "qc_status",
}

# Air-quality field -> canonical column (all other fields keep their name).
TSI_RENAMES = {
    "cloud_device_id": "native_sensor_id",
    "device_id": "native_sensor_id",
    "cloud_timestamp": "timestamp",
    "rh": "humidity",
}

RENAMES = {"WU": WU_RENAMES, "TSI": TSI_RENAMES}

# Measurement name in device telemetry -> wide column.
TSI_MEASUREMENTS = {
    "PM 1.0": "pm1_0", "PM 2.5": "pm2_5", "PM 4.0": "pm4_0", "PM 10": "pm10",
    "PM 2.5 AQI": "pm2_5_aqi", "PM 10 AQI": "pm10_aqi",
    "NC 0.5": "ncpm0_5", "NC 1.0": "ncpm1_0", "NC 2.5": "ncpm2_5", "NC 4.0": "ncpm4_0", "NC 10": "ncpm10",
    "Temperature": "temperature", "Relative Humidity": "rh", "Typical Particle Size": "tpsize",
    "CO2": "co2_ppm", "CO": "co_ppm", "Barometric Pressure": "baro_inhg",
    "O3": "o3_ppb", "NO2": "no2_ppb", "SO2": "so2_ppb", "CH2O": "ch2o_ppb", "VOC": "voc_mgm3",
}

# Weather-station observation fields and their types.
WU_FIELD_TYPES = {
    "stationID": "string", "tz": "string", "obsTimeUtc": "timestamp", "obsTimeLocal": "string",
    "epoch": "bigint", "lat": "double", "lon": "double", "qcStatus": "bigint",
    "solarRadiationHigh": "double", "uvHigh": "double", "winddirAvg": "double",
    "humidityHigh": "double", "humidityLow": "double", "humidityAvg": "double",
    "dewptAvg": "double", "dewptHigh": "double", "dewptLow": "double",
    "heatindexAvg": "double", "heatindexHigh": "double", "heatindexLow": "double",
    "precipRate": "double", "precipTotal": "double",
    "pressureMax": "double", "pressureMin": "double", "pressureTrend": "double",
    "tempAvg": "double", "tempHigh": "double", "tempLow": "double",
    "windchillAvg": "double", "windchillHigh": "double", "windchillLow": "double",
    "windgustAvg": "double", "windgustHigh": "double", "windgustLow": "double",
    "windspeedAvg": "double", "windspeedHigh": "double", "windspeedLow": "double",
}

# Device telemetry record.
TSI_TELEMETRY_SCHEMA = """
    cloud_timestamp string, cloud_account_id string, device_id string, model string,
    metadata struct<location: struct<latitude: double, longitude: double>, is_indoor: boolean, is_public: boolean>,
    sensors array<struct<serial: string, measurements: array<struct<name: string, data: struct<value: double>>>>>
"""

# Canonical wide schema of the air-quality feed.
TSI_WIDE_SCHEMA = """
    cloud_account_id string, native_sensor_id string, timestamp timestamp,
    is_indoor boolean, is_public boolean, latitude double, longitude double,
    pm10 double, pm10_aqi double, pm1_0 double, pm2_5 double, pm2_5_aqi double, pm4_0 double, ncpm4_0 double,
    model string, ncpm0_5 double, ncpm10 double, ncpm1_0 double, ncpm2_5 double, humidity double,
    serial string, temperature double, tpsize double, co2_ppm double, co_ppm double, baro_inhg double,
    o3_ppb double, no2_ppb double, so2_ppb double, ch2o_ppb double, voc_mgm3 double,
    ts timestamp, latitude_f double, longitude_f double
"""

# Canonical wide schema of the weather feed, from the cleaned column names.
WU_WIDE_SCHEMA = (
    "native_sensor_id string, timestamp timestamp, ts timestamp, epoch bigint, qc_status bigint, "
    "lat double, lon double, lat_f double, lon_f double, "
    + ", ".join(f"{m} double" for m in WU_METRICS)
)

WIDE_SCHEMAS = {"WU": WU_WIDE_SCHEMA, "TSI": TSI_WIDE_SCHEMA}
METRICS = {"WU": WU_METRICS, "TSI": TSI_METRICS}
# Coordinate columns per source: (float copy, original).
COORDS = {"WU": (("lat_f", "lat"), ("lon_f", "lon")),
          "TSI": (("latitude_f", "latitude"), ("longitude_f", "longitude"))}

# Names that are never metrics.
RESERVED = {"timestamp", "native_sensor_id", "device_id", "stationID", "obsTimeUtc", "qc_status",
            "latitude", "longitude"}
# Keys, coordinates and times that a numeric parse would otherwise turn into metrics.
RESERVED_MELT = RESERVED | {"ts", "epoch", "lat", "lon", "lat_f", "lon_f", "latitude_f", "longitude_f",
                            "deployment_fk", "sensor_type", "obsTimeLocal", "tz", "dt", "source", "agg"}

# Columns left out of a weather-station resample.
WU_RESAMPLE_EXCLUDE = ("epoch", "lat", "lon", "qcStatus")

# Logical history columns and their candidates, first usable wins.
LOGICAL_CANDIDATES = {
    "timestamp": ["timestamp", "obsTimeUtc", "iso_timestamp", "cloud_timestamp"],
    "pm25": ["PM 2.5", "mcpm2x5", "pm25", "PM2.5", "pm2.5"],
    "temperature": ["T (C)", "tempAvg", "temp_c", "temperature"],
    "humidity": ["RH (%)", "humidityAvg", "rh_percent", "humidity"],
}
HISTORY_FILES = ["tsi_master_historical_data.csv", "wu_master_historical_data.csv",
                 "combined_master_historical_data.csv"]
TIME_CANDIDATES = ["timestamp", "epoch", "ts", "time", "event_time"]

# Plausible ranges.
PLAUSIBLE = {"pm25": (0.0, 1000.0), "temperature": (-50.0, 60.0), "humidity": (0.0, 100.0)}

# Sensor id prefixes.
TEST_PREFIXES = ["AA-", "TEST-", "DEBUG-"]
PRODUCTION_PREFIXES = ["BS-", "PROD-"]
WU_ID_PREFIXES = ["KNCDURHA", "KNCDURHM"]
TSI_MARKER_METRICS = ["pm2_5", "pm1_0", "pm10"]
WU_MARKER_METRICS = ["solar_radiation", "wind_speed_avg", "precip_total"]

# PM2.5 health categories (inclusive upper bound, name).
HEALTH_CATEGORIES = [
    (12.0, "Good"),
    (35.5, "Moderate"),
    (55.5, "Unhealthy for Sensitive Groups"),
    (150.5, "Unhealthy"),
    (250.5, "Very Unhealthy"),
    (None, "Hazardous"),
]
# AQI breakpoints (low concentration, high concentration, low index, high index).
AQI_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 500.4, 301, 500),
]
# Coarse AQI buckets of the reports.
AQI_BUCKETS = [(12, "Good"), (35, "Moderate"), (55, "Unhealthy for Sensitive"), (None, "Unhealthy")]

# Population figures of the health report.
POPULATION = 330000
SENSITIVE_SHARE = 0.25

# Alert configuration.
ALERT_CONFIG = {
    "alert_thresholds": {
        "pm25": {"critical": 150.0, "high": 55.5, "moderate": 35.5, "consecutive_readings": 3},
        "temperature": {"extreme_high": 40.0, "extreme_low": -20.0, "consecutive_readings": 2},
        "humidity": {"extreme_high": 95.0, "extreme_low": 5.0, "consecutive_readings": 3},
        "data_quality": {"missing_data_hours": 6, "stuck_values_percentage": 20.0, "outlier_count_threshold": 10},
    },
    "alert_rules": {"cooldown_minutes": 60, "escalation_hours": 24, "auto_resolve_hours": 2,
                    "priority_levels": ["low", "medium", "high", "critical", "emergency"]},
}
CRITICAL_METRICS = ["pm25", "temperature", "humidity"]
# Z-score limits and trend window of the anomaly configuration.
ZSCORE_LIMITS = {"temperature": 3.0, "humidity": 3.0, "pm25": 2.5}
TREND_WINDOW_DAYS = 7

# Recommendation texts by alert metric: (direction, bound, texts); first match wins.
ALERT_RECOMMENDATIONS = {
    "pm25": [
        (">=", 150.0, ["🚨 Avoid all outdoor activities", "Keep windows and doors closed",
                       "Use air purifiers if available", "Seek medical attention if experiencing symptoms"]),
        (">=", 55.0, ["⚠️ Limit outdoor activities, especially for sensitive groups", "Wear N95 masks when outdoors",
                      "Keep windows closed", "Monitor health symptoms closely"]),
        (">=", 35.0, ["ℹ️ Sensitive groups should limit prolonged outdoor activities",
                      "Consider indoor exercise alternatives", "Monitor air quality regularly"]),
        (None, None, ["Monitor daily air quality forecasts"]),
    ],
    "temperature": [
        (">=", 40.0, ["🌡️ Extreme heat warning - avoid outdoor activities",
                      "Stay hydrated and in air-conditioned spaces", "Check on vulnerable community members",
                      "Limit physical exertion"]),
        ("<=", -20.0, ["🥶 Extreme cold warning - limit outdoor exposure", "Dress in layers and cover exposed skin",
                       "Check heating systems", "Watch for signs of hypothermia"]),
        (None, None, ["Monitor weather conditions"]),
    ],
    "humidity": [
        (">=", 95.0, ["💧 Very high humidity - use dehumidifiers if available", "Increase ventilation",
                      "Monitor for mold growth"]),
        ("<=", 5.0, ["💨 Very low humidity - use humidifiers if available", "Stay hydrated",
                     "Monitor for respiratory irritation"]),
        (None, None, ["Monitor humidity levels"]),
    ],
    "data_completeness": [
        (None, None, ["Check sensor connectivity", "Verify data collection processes",
                      "Investigate sensor malfunction"]),
    ],
}
# Health-report recommendations by average PM2.5 (exclusive lower bound, level, texts).
HEALTH_RECOMMENDATIONS = [
    (150.0, "emergency", ["🚨 EMERGENCY: Avoid all outdoor activities", "Keep windows and doors closed",
                          "Use air purifiers indoors if available",
                          "Seek medical attention if experiencing respiratory symptoms"]),
    (55.0, "warning", ["⚠️ WARNING: Limit outdoor activities, especially for sensitive groups",
                       "Wear N95 masks when outdoors", "Keep windows closed during high pollution periods",
                       "Consider relocating sensitive individuals temporarily"]),
    (35.0, "advisory", ["⚠️ ADVISORY: Sensitive groups should limit prolonged outdoor activities",
                        "Monitor air quality regularly", "Consider indoor exercise alternatives",
                        "Keep rescue medications available for those with respiratory conditions"]),
    (12.0, "moderate", ["ℹ️ MODERATE: Air quality is acceptable for most people",
                        "Sensitive individuals may experience minor symptoms",
                        "Monitor daily air quality forecasts"]),
    (None, "good", ["✅ GOOD: Air quality is satisfactory for all groups"]),
]
GENERAL_RECOMMENDATIONS = ["Stay informed about daily air quality forecasts",
                           "Support policies that reduce air pollution",
                           "Consider using HEPA air filters indoors"]

# Forecast features in model order.
FORECAST_FEATURES = [
    "hour", "day_of_week", "month", "temperature", "humidity",
    "pm25_lag_1h", "pm25_lag_6h", "pm25_lag_12h", "pm25_lag_24h",
    "pm25_ma_3h", "pm25_ma_6h", "pm25_ma_24h",
]
LAGS = (1, 6, 12, 24)
MOVING_AVERAGES = (3, 6, 24)
# Baseline when a sensor has no reading.
FORECAST_DEFAULTS = {"pm25": 15.0, "temperature": 20.0, "humidity": 50.0}

# Quality thresholds.
ROW_THRESHOLDS = {"sensor_readings_wu_raw": 100, "sensor_readings_tsi_raw": 100, "sensor_readings_long": 100}
MIN_METRIC_FRACTION = 0.9
COVERAGE_THRESHOLDS = {"TSI": 0.90, "WU": 0.95}
MAX_NULL_PCT = 2.0
HOURLY_RATIO = (0.5, 1.5)

# Columns that must be populated, by source.
CRITICAL_COLUMNS = {"TSI": ["timestamp", "native_sensor_id", "pm2_5", "temperature"],
                    "WU": ["timestamp", "native_sensor_id", "temperature", "humidity", "pressure_max"]}

# Field categories of the model coverage report.
FIELD_CATEGORIES = {
    "PM Metrics": ["pm1_0", "pm2_5", "pm4_0", "pm10", "pm2_5_aqi", "pm10_aqi"],
    "Number Concentration": ["ncpm0_5", "ncpm1_0", "ncpm2_5", "ncpm4_0", "ncpm10"],
    "Environmental": ["temperature", "humidity", "baro_inhg", "tpsize"],
    "Gas Sensors": ["co2_ppm", "co_ppm", "o3_ppb", "no2_ppb", "so2_ppb", "ch2o_ppb", "voc_mgm3"],
    "Location": ["latitude", "longitude", "is_indoor", "is_public"],
}
