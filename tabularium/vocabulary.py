"""Names, word lists, lookup tables and thresholds that results depend on."""

from __future__ import annotations

# The housing-sales column contract, in file order.
HOUSING_COLUMNS = [
    "Order", "PID", "MS SubClass", "MS Zoning", "Lot Frontage", "Lot Area", "Street", "Alley",
    "Lot Shape", "Land Contour", "Utilities", "Lot Config", "Land Slope", "Neighborhood",
    "Condition 1", "Condition 2", "Bldg Type", "House Style", "Overall Qual", "Overall Cond",
    "Year Built", "Year Remod/Add", "Roof Style", "Roof Matl", "Exterior 1st", "Exterior 2nd",
    "Mas Vnr Type", "Mas Vnr Area", "Exter Qual", "Exter Cond", "Foundation", "Bsmt Qual",
    "Bsmt Cond", "Bsmt Exposure", "BsmtFin Type 1", "BsmtFin SF 1", "BsmtFin Type 2",
    "BsmtFin SF 2", "Bsmt Unf SF", "Total Bsmt SF", "Heating", "Heating QC", "Central Air",
    "Electrical", "1st Flr SF", "2nd Flr SF", "Low Qual Fin SF", "Gr Liv Area",
    "Bsmt Full Bath", "Bsmt Half Bath", "Full Bath", "Half Bath", "Bedroom AbvGr",
    "Kitchen AbvGr", "Kitchen Qual", "TotRms AbvGrd", "Functional", "Fireplaces",
    "Fireplace Qu", "Garage Type", "Garage Yr Blt", "Garage Finish", "Garage Cars",
    "Garage Area", "Garage Qual", "Garage Cond", "Paved Drive", "Wood Deck SF",
    "Open Porch SF", "Enclosed Porch", "3Ssn Porch", "Screen Porch", "Pool Area", "Pool QC",
    "Fence", "Misc Feature", "Misc Val", "Mo Sold", "Yr Sold", "Sale Type", "Sale Condition",
    "SalePrice",
]

# Semantic kinds of the contract columns; every other column is nominal.
CONTINUOUS_COLUMNS = [
    "Lot Frontage", "Lot Area", "Mas Vnr Area", "BsmtFin SF 1", "BsmtFin SF 2", "Bsmt Unf SF",
    "Total Bsmt SF", "1st Flr SF", "2nd Flr SF", "Low Qual Fin SF", "Gr Liv Area",
    "Garage Area", "Wood Deck SF", "Open Porch SF", "Enclosed Porch", "3Ssn Porch",
    "Screen Porch", "Pool Area", "Misc Val", "SalePrice",
]
DISCRETE_COLUMNS = [
    "Order", "MS SubClass", "Overall Qual", "Overall Cond", "Year Built", "Year Remod/Add",
    "Bsmt Full Bath", "Bsmt Half Bath", "Full Bath", "Half Bath", "Bedroom AbvGr",
    "Kitchen AbvGr", "TotRms AbvGrd", "Fireplaces", "Garage Yr Blt", "Garage Cars", "Mo Sold",
    "Yr Sold",
]
ORDINAL_COLUMNS = [
    "Exter Qual", "Exter Cond", "Bsmt Qual", "Bsmt Cond", "Bsmt Exposure", "BsmtFin Type 1",
    "BsmtFin Type 2", "Heating QC", "Kitchen Qual", "Fireplace Qu", "Garage Finish",
    "Garage Qual", "Garage Cond", "Pool QC", "Land Slope", "Functional", "Paved Drive",
]
STRUCTURAL_NULL_SHARE = 0.40

# String columns in which a null means "the house has none of this".
STRUCTURAL_NULL_COLUMNS = [
    "Alley", "Pool QC", "Misc Feature", "Fence", "Fireplace Qu", "Garage Type",
    "Garage Finish", "Garage Qual", "Garage Cond", "Bsmt Qual", "Bsmt Cond", "Bsmt Exposure",
    "BsmtFin Type 1", "BsmtFin Type 2",
]

# Ordinal scales and the columns that use them.
ORDINAL_SCALES = {
    "quality": {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1, "None": 0, "NA": 0},
    "finish": {
        "GLQ": 6, "ALQ": 5, "BLQ": 4, "Rec": 3, "LwQ": 2, "Unf": 1, "None": 0, "NA": 0,
        "Fin": 3, "RFn": 2,
    },
    "exposure": {"Gd": 4, "Av": 3, "Mn": 2, "No": 1, "None": 0, "NA": 0},
    "slope": {"Gtl": 1, "Mod": 2, "Sev": 3},
    "functional": {
        "Typ": 8, "Min1": 7, "Min2": 6, "Mod": 5, "Maj1": 4, "Maj2": 3, "Sev": 2, "Sal": 1,
        "None": 0,
    },
    "paved": {"Y": 3, "P": 2, "N": 1, "None": 0},
}
ORDINAL_SCALE_OF = {
    "Exter Qual": "quality", "Exter Cond": "quality", "Bsmt Qual": "quality",
    "Bsmt Cond": "quality", "Heating QC": "quality", "Kitchen Qual": "quality",
    "Fireplace Qu": "quality", "Garage Qual": "quality", "Garage Cond": "quality",
    "Pool QC": "quality", "Bsmt Exposure": "exposure", "BsmtFin Type 1": "finish",
    "BsmtFin Type 2": "finish", "Garage Finish": "finish", "Land Slope": "slope",
    "Functional": "functional", "Paved Drive": "paved",
}

# Encoding groups of the housing table.
ONE_HOT_COLUMNS = [
    "MS Zoning", "Lot Shape", "Land Contour", "Lot Config", "Bldg Type", "House Style",
    "Roof Style", "Foundation", "Heating", "Central Air", "Sale Type", "Sale Condition",
]
TARGET_ENCODED_COLUMNS = ["Neighborhood", "Exterior 1st", "Exterior 2nd"]
LOG_COLUMNS = ["SalePrice", "Gr Liv Area", "Lot Area", "TotalSF", "1st Flr SF"]
TARGET_SMOOTHING = 10.0
TARGET_MIN_ROWS = 5

# Years of the train / validation / test split.
TRAIN_YEARS = (2006, 2008)
VALIDATION_YEAR = 2009
TEST_YEAR = 2010

# Artefact rule, anomaly features and thresholds.
ARTIFACT_AREA = 4000
ARTIFACT_PRICE = 200000
ANOMALY_FEATURES = [
    "log_Gr Liv Area", "Total Bsmt SF", "log_Lot Area", "log_SalePrice", "log_TotalSF",
    "Overall Qual",
]
Z_LIMIT = 3.5
ISO_HIGH = -0.3
ISO_MEDIUM = -0.1
CONTAMINATION = 0.02
FOREST_TREES = 200
FOREST_SAMPLE = 256

# Engineered features as (name, formula, rationale).
FEATURE_NOTES = [
    ("TotalSF", "TotalBsmtSF + 1stFlrSF + 2ndFlrSF", "Combined livable space is primary value driver"),
    ("PorchSF", "WoodDeckSF + OpenPorchSF + EnclosedPorch + 3SsnPorch + ScreenPorch",
     "Outdoor usable space adds marginal value"),
    ("HouseAge", "YrSold - YearBuilt", "Relative age prevents temporal leakage"),
    ("RemodAge", "YrSold - YearRemod/Add", "Recency of remodel affects value"),
    ("GarageAge", "YrSold - GarageYrBlt", "Garage condition proxy"),
    ("TotalBathrooms", "FullBath + 0.5*HalfBath + BsmtFullBath + 0.5*BsmtHalfBath",
     "Half-bath = 0.5 full-bath equivalent"),
    ("HasPool", "PoolArea > 0", "Presence more predictive than raw area"),
    ("HasGarage", "GarageArea > 0", "Binary garage presence"),
    ("HasBasement", "TotalBsmtSF > 0", "Binary basement presence"),
    ("HasFireplace", "Fireplaces > 0", "Binary fireplace presence"),
    ("IsNew", "YearBuilt == YrSold", "New construction premium"),
    ("OverallScore", "OverallQual * OverallCond", "Quality × condition interaction"),
]

# Market reports.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
STABLE_VARIATION_PCT = 35
R2_BANDS = (0.70, 0.85)

# Model settings.
RIDGE_ALPHAS = (0.1, 1.0, 10.0, 100.0)
RIDGE_FOLDS = 5
BOOST_ROUNDS = 1000
BOOST_RATE = 0.05
BOOST_DEPTH = 4
BOOST_PATIENCE = 50
BOOST_LEAVES = 31
BOOST_LEAF_ROWS = 20

# Pipeline stages and histogram bounds of the monitoring stream.
STAGES = [
    "ingestion_agent", "schema_agent", "cleaning_agent", "feature_agent", "encoding_agent",
    "anomaly_agent", "ml_agent", "orchestration_agent",
]
FINAL_STAGE = "orchestration_agent"
DURATION_BOUNDS = [0.5, 1, 2, 5, 10, 30, 60, 120, 300]
EVENTS_PER_RUN = 500

# Retrieval and grounding parameters.
CHUNK_WORDS = 180
CHUNK_OVERLAP = 20
WINDOW_WORDS = 512
WINDOW_STEP = 462
BM25_K1 = 1.5
BM25_B = 0.75
RRF_K = 60
MMR_LAMBDA = 0.7
CONTEXT_WORDS = 350
ROUTE_CONFIDENCE = 0.3
BYPASS_CONFIDENCE = 0.7
GROUNDING_REJECT = 0.30
GROUNDING_REVIEW = 0.50
EXTRACT_MIN_COSINE = 0.35
EXTRACT_MIN_OVERLAP = 2
LIVE_MARKER = "[Live System State]\n"  # stripped from facts again, so it must stay as it is
NO_CONTEXT = "I don't have enough context to answer that question. Please run the pipeline first."
CONTEXT_MIN_WORDS = 20
NO_ANSWER = "I don't have enough information to answer that question."

# Stop words of the grounding score.
STOPWORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "is", "was",
    "are", "be", "been", "being", "have", "has", "had", "do", "does", "did", "will", "would",
    "should", "could", "may", "might", "can", "this", "that", "these", "those", "i", "you",
    "he", "she", "it",
]

# Phrases that mark an answer as uncertain.
HEDGES = [
    "i assume", "probably", "might be", "could be", "seems like", "likely", "perhaps",
    "apparently", "supposedly", "allegedly", "according to my knowledge",
    "based on general knowledge",
]

# Intent rules as (weight, keywords, patterns), in tie-break order.
INTENT_RULES = {
    "neighborhood": (
        1.0,
        ["neighborhood", "area", "location", "where", "region", "nridgheights", "nridgehts",
         "stonebrook", "stonebr", "northridge", "noridge", "names", "meadowv", "brddale",
         "idotrr", "price", "sale", "market"],
        [r"which.*neighborhood.*(?:best|most|popular|expensive|affordable|highest|top)",
         r"neighborhood.*(?:comparison|stats|analysis|price|sale)",
         r"(?:best|worst|highest|top).*neighborhood",
         r"area.*(?:analysis|comparison|price)"],
    ),
    "model_performance": (
        1.0,
        ["r2", "r²", "rmse", "mae", "mape", "model", "accuracy", "score", "predict", "xgboost",
         "ridge", "lightgbm", "performance", "evaluation", "train", "test", "validation",
         "metric", "error", "regression"],
        [r"model.*(?:performance|accuracy|evaluation|score)",
         r"how.*(?:accurate|good|well).*model",
         r"(?:xgboost|ridge|lightgbm).*(?:performs|score|metric)",
         r"rmse|r2|mae.*(?:test|validation|score)"],
    ),
    "data_quality": (
        1.0,
        ["null", "missing", "clean", "quality", "impute", "data issue", "incomplete", "valid",
         "validation", "integrity", "schema", "na", "nan", "null rate", "data cleaning"],
        [r"(?:data|column).*(?:quality|integrity|validation)",
         r"(?:null|missing|na).*(?:rate|count|handling)",
         r"(?:clean|impute|fix).*(?:data|values|nulls)"],
    ),
    "anomaly": (
        1.0,
        ["anomal", "outlier", "unusual", "flag", "isolation", "zscore", "anomalous",
         "detection", "outliers", "anomalies", "suspicious", "rare", "unexpected", "abnormal"],
        [r"(?:detect|find|identify).*(?:anomal|outlier|unusual)",
         r"anomaly.*(?:report|detection|count)",
         r"(?:isolation|zscore).*(?:forest|analysis|method)"],
    ),
    "feature": (
        1.0,
        ["feature", "importance", "shap", "correlation", "variable", "column", "engineered",
         "engineering", "top", "most important", "relevance", "influential", "contribution",
         "impact"],
        [r"(?:top|most|least).*(?:important|relevant).*(?:feature|variable)",
         r"feature.*(?:importance|ranking|correlation)",
         r"which.*(?:features|variables).*(?:matter|important|influence)",
         r"shap|feature.*importance.*report"],
    ),
    "temporal": (
        1.5,
        ["year", "month", "time", "trend", "season", "seasonal", "2006", "2007", "2008", "2009",
         "2010", "historical", "time series", "temporal", "over time", "forecast", "sales",
         "most", "highest", "lowest", "transactions", "volume", "market", "home sales",
         "housing crisis", "peak", "worst year", "best year", "when", "period", "annual",
         "quarterly"],
        [r"(?:trend|temporal|over time).*(?:analysis|change|pattern)",
         r"(?:2006|2007|2008|2009|2010).*(?:price|trend|sales)",
         r"(?:seasonal|monthly|yearly).*(?:pattern|trend|variation)",
         r"which year.*(?:most|highest|lowest|worst|best|peak)",
         r"(?:most|highest|lowest|worst|best).*(?:sales|transactions|volume|homes|home sales)",
         r"(?:when|what year).*(?:most|peak|highest|lowest|worst|best).*(?:sale|home|house|market)",
         r"year.*(?:most|highest|lowest|best|worst).*(?:home|sale|transaction)",
         r"(?:home sales|housing sales).*(?:year|when|peak|most|highest)"],
    ),
}
KEYWORD_SHARE = 0.4
PATTERN_SHARE = 0.6
