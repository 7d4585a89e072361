"""These must equal the published data contract, so they are stated as they are."""

# The ten sound classes, in contract order.
CLASS_NAMES = (
    "air_conditioner",
    "car_horn",
    "children_playing",
    "dog_bark",
    "drilling",
    "engine_idling",
    "gun_shot",
    "jackhammer",
    "siren",
    "street_music",
)

# Clips per class in the evaluation fold of the published data set (837 in all).
EVAL_FOLD_CLASS_COUNTS = {
    "air_conditioner": 100,
    "car_horn": 33,
    "children_playing": 100,
    "dog_bark": 100,
    "drilling": 100,
    "engine_idling": 93,
    "gun_shot": 32,
    "jackhammer": 96,
    "siren": 83,
    "street_music": 100,
}

# Dataset contract.
EXPECTED_ROWS = 8732
EXPECTED_CLASSES = 10
FOLD_MIN, FOLD_MAX = 1, 10
TRAIN_FOLDS = (1, 2, 3, 4, 5, 6, 7, 8)
VAL_FOLD = 9
EVAL_FOLD = 10

# Clip processing parameters.
SAMPLE_RATE = 16000
CLIP_SECONDS = 4.0
BASE_SEED = 42
AUGMENT_COPIES = 1
N_MFCC = 13
N_CHROMA = 12
N_MELS = 128
MEL_FFT = 1024
TABULAR_FFT = 2048
HOP = 512
MEL_FRAMES = 126

# Drift parameters.
PSI_FLOOR = 1e-6
N_QUANTILES = 101
HISTOGRAM_BINS = 10
MIN_REFERENCE_POINTS = 32
MONITOR_WINDOW = 100
PSI_WARN, PSI_ALERT = 0.1, 0.25
KS_WARN, KS_ALERT = 0.2, 0.4

# Upload rules.
MAX_UPLOAD_BYTES = 8 * 1024 * 1024
WAV_SUFFIX = ".wav"
WAV_MIME_TYPES = ("audio/wav", "audio/x-wav", "audio/wave")

# Histogram bucket bounds of the service metrics (the last bucket is +Inf).
LATENCY_BUCKETS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
CONFIDENCE_BUCKETS = (0.5, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0)
RATE_FLOOR = 1e-9

# Metrics averaged over cross-validation folds.
FOLD_METRICS = (
    "accuracy",
    "precision_macro",
    "recall_macro",
    "f1_macro",
    "precision_weighted",
    "recall_weighted",
    "f1_weighted",
    "roc_auc_ovr",
)

# Search ranges per model, how to draw and (low, high) or the choices.
SEARCH_SPACE: dict[str, dict[str, tuple]] = {
    "forest": {
        "trees": ("step", 100, 400, 50),
        "depth": ("int", 4, 24),
        "leaf_rows": ("int", 1, 8),
        "feature_subset": ("choice", "sqrt", "log2", "0.5"),
    },
    "boosted_depth": {
        "trees": ("step", 100, 400, 50),
        "depth": ("int", 3, 12),
        "rate": ("log", 0.01, 0.3),
        "row_share": ("real", 0.6, 1.0),
        "column_share": ("real", 0.6, 1.0),
        "child_weight": ("int", 1, 10),
        "l2": ("log", 1e-3, 10.0),
    },
    "boosted_leaf": {
        "trees": ("step", 100, 400, 50),
        "depth": ("int", 3, 12),
        "rate": ("log", 0.01, 0.3),
        "leaves": ("int", 16, 128),
        "row_share": ("real", 0.6, 1.0),
        "column_share": ("real", 0.6, 1.0),
        "leaf_rows": ("int", 5, 50),
        "l2": ("log", 1e-3, 10.0),
    },
    "network": {"hidden": ("step", 16, 64, 16), "step": ("log", 1e-3, 0.3)},
    "gaussian": {"shrink": ("real", 0.0, 1.0), "smoothing": ("log", 1e-6, 1.0)},
}
