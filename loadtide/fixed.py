"""Fixed values that results depend on: labels, word lists, limits and column lists."""

from __future__ import annotations

# Column heading in the measures files -> canonical column name.
HEADER_LABELS = {
    "Périmètre": "perimeter",
    "Nature": "nature",
    "Date": "date",
    "Heures": "time",
    "Consommation": "consumption_mw",
    "Prévision J-1": "forecast_j1_mw",
    "Prévision J": "forecast_j_mw",
    "Fioul": "fuel_mw",
    "Charbon": "coal_mw",
    "Gaz": "gas_mw",
    "Nucléaire": "nuclear_mw",
    "Eolien": "wind_mw",
    "Solaire": "solar_mw",
    "Hydraulique": "hydro_mw",
    "Pompage": "pumping_mw",
    "Bioénergies": "bioenergy_mw",
    "Ech. physiques": "physical_exchanges_mw",
    "Taux de Co2": "co2_rate",
    "Ech. comm. Angleterre": "exchange_uk_mw",
    "Ech. comm. Espagne": "exchange_spain_mw",
    "Ech. comm. Italie": "exchange_italy_mw",
    "Ech. comm. Suisse": "exchange_switzerland_mw",
    "Ech. comm. Allemagne-Belgique": "exchange_germany_belgium_mw",
    "Fioul - TAC": "fuel_tac_mw",
    "Fioul - Cogén.": "fuel_cogen_mw",
    "Fioul - Autres": "fuel_other_mw",
    "Gaz - TAC": "gas_tac_mw",
    "Gaz - Cogén.": "gas_cogen_mw",
    "Gaz - CCG": "gas_ccg_mw",
    "Gaz - Autres": "gas_other_mw",
    "Hydraulique - Fil de l?eau + éclusée": "hydro_river_mw",
    "Hydraulique - Lacs": "hydro_lake_mw",
    "Hydraulique - STEP turbinage": "hydro_step_mw",
    "Bioénergies - Déchets": "bioenergy_waste_mw",
    "Bioénergies - Biomasse": "bioenergy_biomass_mw",
    "Bioénergies - Biogaz": "bioenergy_biogas_mw",
    "Stockage batterie": "battery_storage_mw",
    "Déstockage batterie": "battery_release_mw",
    "Eolien terrestre": "wind_onshore_mw",
    "Eolien offshore": "wind_offshore_mw",
}

TEXT_COLUMNS = ("perimeter", "nature", "date", "time")
MEASURE_COLUMNS = tuple(c for c in HEADER_LABELS.values() if c not in TEXT_COLUMNS)

# Cells that mean "no value", the footer text, the shortest usable row.
NULL_CELLS = ("", "ND", "n/a", "-")
FOOTER_TEXT = "ne pourra"
MIN_CELLS = 5
DATE_LENGTH = 10

# Day colours of the tariff calendar.
CALENDAR_COLOURS = ("BLEU", "BLANC", "ROUGE")

# Plausible range of the national load, MW.
LOAD_MIN = 10_000.0
LOAD_MAX = 120_000.0

# Public holidays that fall on the same (month, day) every year.
FIXED_HOLIDAYS = ((1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25))

# Columns whose presence makes up the completeness score.
SCORE_COLUMNS = ("consumption_mw", "nuclear_mw", "wind_mw", "solar_mw", "co2_rate")

# Columns that are filled from their neighbours.
FILLED_COLUMNS = ("consumption_mw", "nuclear_mw", "wind_mw", "solar_mw")

# Columns of the clean (Silver) table.
SILVER_COLUMNS = (
    "datetime",
    "consumption_mw", "forecast_j1_mw", "forecast_error_mw", "forecast_error_pct",
    "nuclear_mw", "wind_mw", "solar_mw", "hydro_mw",
    "gas_mw", "fuel_mw", "coal_mw", "bioenergy_mw",
    "co2_rate", "wind_onshore_mw", "wind_offshore_mw",
    "hydro_river_mw", "hydro_lake_mw", "hydro_step_mw",
    "hour", "day_of_week", "day_of_year", "week_of_year",
    "month", "year", "quarter", "season", "is_weekend", "is_peak_hour",
    "hour_sin", "hour_cos",
    "lag_1h_mw", "lag_24h_mw", "lag_168h_mw",
    "rolling_24h_mean", "rolling_24h_std",
    "renewable_share_pct", "nuclear_share_pct",
    "is_interpolated", "quality_score",
    "completeness_before", "physical_exchanges_mw",
)

# Warehouse types, column -> (precision, scale) or a type name.
WAREHOUSE_FACT_TYPES = {
    "consumption_mw": (10, 2), "forecast_j1_mw": (10, 2),
    "forecast_error_mw": (10, 2), "forecast_error_pct": (6, 3),
    "nuclear_mw": (10, 2), "wind_mw": (10, 2), "solar_mw": (10, 2), "hydro_mw": (10, 2),
    "gas_mw": (10, 2), "bioenergy_mw": (10, 2), "fuel_mw": (10, 2), "coal_mw": (10, 2),
    "wind_onshore_mw": (10, 2), "wind_offshore_mw": (10, 2),
    "physical_exchanges_mw": (10, 2), "co2_rate": (8, 2),
    "hour": "smallint", "day_of_week": "smallint", "day_of_year": "smallint",
    "week_of_year": "smallint", "month": "smallint", "year": "smallint",
    "quarter": "smallint", "season": "smallint",
    "is_weekend": "boolean", "is_peak_hour": "boolean",
    "lag_1h_mw": (10, 2), "lag_24h_mw": (10, 2), "lag_168h_mw": (10, 2),
    "rolling_24h_mean": (10, 2), "rolling_24h_std": (10, 2),
    "renewable_share_pct": (6, 3), "nuclear_share_pct": (6, 3),
    "is_interpolated": "boolean", "quality_score": (4, 3),
}
WAREHOUSE_DAILY_TYPES = {
    "consumption_mean_mw": (10, 2), "consumption_min_mw": (10, 2),
    "consumption_max_mw": (10, 2), "consumption_std_mw": (10, 2),
    "consumption_total_gwh": (12, 3), "peak_consumption_mw": (10, 2),
    "peak_hour": "smallint", "off_peak_mean_mw": (10, 2),
    "forecast_mae_mw": (10, 2), "forecast_mape_pct": (6, 3),
    "nuclear_mean_mw": (10, 2), "nuclear_share_pct": (6, 3),
    "wind_mean_mw": (10, 2), "solar_mean_mw": (10, 2), "hydro_mean_mw": (10, 2),
    "renewable_share_pct": (6, 3), "co2_mean_gkwh": (8, 2), "co2_min_gkwh": (8, 2),
    "co2_max_gkwh": (8, 2), "net_export_gwh": (12, 3),
    "records_count": "int", "interpolated_count": "int", "quality_score_mean": (4, 3),
}
WAREHOUSE_MONTHLY_TYPES = {
    "consumption_mean_mw": (10, 2), "consumption_total_twh": (12, 4),
    "consumption_yoy_pct": (6, 3), "nuclear_total_gwh": (12, 3),
    "wind_total_gwh": (12, 3), "solar_total_gwh": (12, 3), "hydro_total_gwh": (12, 3),
    "renewable_pct": (6, 3), "co2_mean_gkwh": (8, 2), "trading_days": "smallint",
}

# Candidate model inputs.
FEATURE_COLUMNS = (
    "hour", "day_of_week", "day_of_year", "week_of_year", "month", "quarter", "season",
    "hour_sin", "hour_cos", "is_weekend", "is_peak_hour",
    "nuclear_mw", "wind_mw", "solar_mw", "hydro_mw", "gas_mw", "coal_mw", "bioenergy_mw",
    "wind_onshore_mw", "wind_offshore_mw", "co2_rate",
    "lag_1h_mw", "lag_24h_mw", "lag_168h_mw", "rolling_24h_mean", "rolling_24h_std",
    "forecast_j1_mw",
)

# Display names of the model kinds.
MODEL_LABELS = {
    "LinearRegression": "Régression linéaire",
    "DecisionTree": "Arbre de décision",
    "RandomForest": "Forêt aléatoire",
    "GradientBoosting": "Gradient Boosting",
}

# Message topics (defaults; every streaming function takes its own).
TOPIC_RAW, TOPIC_CALENDAR, TOPIC_REALTIME = "raw", "calendar", "realtime"
