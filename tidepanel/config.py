"""Fixed values that must equal the source data's conventions.

Column names, file naming, sentinel ids, hub definitions, thresholds and
tuned parameters are facts about the data, so they are stated plainly here.
"""

# Raw file formats, tried in this order.
ENCODINGS = ["utf-8-sig", "utf-16", "cp1252"]
SEPARATORS = ["\t", ";"]
FILE_KIND = "validations"

# Fixed values: (year, period, extension) of every raw file.
FILE_MANIFEST = [
    (2015, "S1", "csv"), (2015, "S2", "csv"),
    (2016, "S1", "txt"), (2016, "S2", "txt"),
    (2017, "S1", "txt"), (2017, "S2", "txt"),
    (2018, "S1", "txt"), (2018, "S2", "txt"),
    (2019, "S1", "txt"), (2019, "S2", "txt"),
    (2020, "S1", "txt"), (2020, "S2", "txt"),
    (2021, "S1", "txt"), (2021, "S2", "txt"),
    (2022, "S1", "txt"), (2022, "S2", "txt"),
    (2023, "S1", "txt"), (2023, "S2", "txt"),
    (2024, "S1", "txt"), (2024, "T3", "txt"), (2024, "T4", "txt"),
    (2025, "T1", "csv"), (2025, "T2", "csv"), (2025, "T3", "csv"), (2025, "T4", "csv"),
]

# Raw columns.
REQUIRED_COLUMNS = [
    "JOUR", "CODE_STIF_TRNS", "CODE_STIF_RES", "CODE_STIF_ARRET",
    "LIBELLE_ARRET", "CATEGORIE_TITRE", "NB_VALD",
]
ID_COLUMN_NAMES = {"ID_REFA_LDA": "ID_LIEU", "lda": "ID_LIEU", "ID_ZDC": "ID_LIEU"}
KEPT_COLUMNS = ["JOUR", "ID_LIEU", "LIBELLE_ARRET", "CATEGORIE_TITRE", "NB_VALD"]

# Text of a censored count (after whitespace removal) and its value.
CENSORED_TEXT = "Moinsde5"
CENSORED_VALUE = 3.0

# Ids that are no places, and places left out on purpose.
SENTINEL_IDS = [-1, 0, 999999]
EXCLUDED_IDS = [
    65227, 72641, 72787, 62667, 62939, 63244, 60856, 486998, 60776, 60387,
    486996, 486999, 486959, 60892, 62977, 486992, 60985, 60450, 60915, 64566,
    73602, 480927, 480950, 480952, 64246, 64382, 73731, 64622, 64049, 64589,
    480951, 68293, 68311, 68505, 68582, 72028, 72033, 73312, 73334, 73360,
    73411, 73709, 411281, 411284, 63284, 61327, 63278,
]

# Entity resolution.
OVERLAP_DAYS = 7
DUPLICATE_RATIO = 0.65
ACTION_OVERRIDES = {"juvisy": "merge_max"}
HUBS = {
    "POLE_CHATELET": ["chatelet", "chatelet les halles", "les halles"],
    "POLE_LA_DEFENSE": ["defense", "la defense", "la defense grande arche"],
    "POLE_SAINT_LAZARE": [
        "auber", "haussmann saint lazare", "havr caumartin",
        "havre caumartin", "saint lazare", "opera", "augustin",
    ],
    "POLE_MONTPARNASSE": ["montparnasse"],
    "POLE_GARE_DE_LYON": ["gare de lyon"],
    "POLE_GARE_DU_NORD": ["gare du nord", "magenta"],
    "POLE_GARE_DE_LEST": ["gare de l est", "landon"],
}
HUB_ID_BASE = -1000

# Time bounds.
TRAIN_FROM = "2015-01-01"
EXCLUDE_WINDOW = ("2020-01-01", "2023-01-01")
DEPLOY_CUTOFF = "2025-05-26"
CALENDAR_YEARS = (2015, 2026)

# Weather files.
WEATHER_STATION = 75114001
WEATHER_COLUMNS = ["RR", "TN", "TX", "TM", "FFM"]
WEATHER_FILES = [
    "meteo/data-1950-2024-meteo/1950-2024_RR-T-Vent.csv",
    "meteo/data-2025-2026-meteo/2025-2026_RR-T-Vent.csv",
]
WEATHER_FROM_YEAR = 2015

# Weather thresholds (mm, m/s, degrees C, degrees C).
RAIN_MM = 1.0
WIND_MS = 12.0
COLD_C = 5.0
HOT_C = 28.0

# Feature columns, in model order.
CALENDAR_COLUMNS = ["IS_WEEKEND", "IS_FERIE", "IS_VACANCES", "IS_PONT"]
TIME_COLUMNS = [
    "jour_semaine", "jour_mois", "jour_annee", "semaine_annee", "mois",
    "trimestre", "annee", "is_debut_mois", "is_fin_mois", "mois_sin", "mois_cos",
]
DERIVED_WEATHER_COLUMNS = ["amplitude", "log_RR", "is_rain", "is_wind", "is_cold", "is_hot"]
PROFILE_COLUMNS = ["log_vald", "cv", "ratio_we_sem", "ratio_vac_horsvac", "creux_estival"]
SCALED_COLUMNS = [
    "RR", "TN", "TX", "TM", "FFM", "amplitude", "log_RR", "lag_1", "lag_7", "lag_30",
]

# Model settings.
HORIZON = 7
EVAL_LAGS = (1, 7, 30)
LAGS = (1, 2, 3, 4, 5, 6, 7)
ROLLS = (7, 14, 30)
TEST_SIZE = 0.2
N_CLUSTERS = 4
MODEL_SEED = 67
SAMPLE_SEED = 42
MIN_GROUP_ROWS = 50

# Sequence model settings.
PAST_LENGTH = 140
FOLD_LENGTH = 3 * 365
FOLD_STRIDE = 91
TRAIN_RATIO = 0.66

# Search grid of the pooled model, and whole-number parameters.
POOLED_GRID = {
    "n_estimators": [300, 500, 800, 1200],
    "max_depth": [6, 8, 10, 12],
    "learning_rate": [0.02, 0.03, 0.05, 0.08, 0.1],
    "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
    "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0],
    "min_child_weight": [1, 3, 5, 7, 10],
    "gamma": [0, 0.1, 0.3, 0.5],
    "reg_alpha": [0, 0.1, 0.5, 1.0],
    "reg_lambda": [0.5, 1.0, 1.5, 2.0, 3.0],
}
WHOLE_NUMBER_PARAMS = ["n_estimators", "max_depth", "min_child_weight"]

# Frozen parameters of the pooled model.
POOLED_PARAMS = {
    "n_estimators": 1200, "max_depth": 12, "learning_rate": 0.02,
    "subsample": 0.7, "colsample_bytree": 1.0, "min_child_weight": 1,
    "gamma": 0.5, "reg_alpha": 0.1, "reg_lambda": 3.0,
}
