"""Table shapes shared by readers, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

from clipward import constants as K

AUDIO = T.StructType(
    [T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())]
)

RAW_CLIP = T.StructType(
    [
        T.StructField("audio", AUDIO),
        T.StructField("slice_file_name", T.StringType()),
        T.StructField("fsID", T.LongType()),
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("salience", T.LongType()),
        T.StructField("fold", T.LongType()),
        T.StructField("classID", T.LongType()),
        T.StructField("class", T.StringType()),
    ]
)

RAW_META_COLUMNS = [f.name for f in RAW_CLIP if f.name != "audio"]

# One row per cleaned waveform. The encoded clip stays a column, so a table of
# a billion clips is still a table and not a billion files.
INTERIM_CLIP = T.StructType(
    [f for f in RAW_CLIP if f.name != "audio"]
    + [
        T.StructField("path", T.StringType()),
        T.StructField("sample_rate", T.IntegerType()),
        T.StructField("is_augmented", T.BooleanType()),
        T.StructField("aug_index", T.IntegerType()),
        T.StructField("wav", T.BinaryType()),
    ]
)

META = [
    T.StructField("path", T.StringType(), False),
    T.StructField("slice_file_name", T.StringType(), False),
    T.StructField("fold", T.LongType(), False),
    T.StructField("class", T.StringType(), False),
    T.StructField("classID", T.LongType(), False),
    T.StructField("is_augmented", T.BooleanType(), False),
    T.StructField("aug_index", T.LongType(), False),
]
META_COLUMNS = [f.name for f in META]


def feature_names(n_mfcc: int = K.N_MFCC) -> list[str]:
    """Names of the tabular features in table order; 84 of them for 13 coefficients."""
    stats = ("mean", "std")
    mfcc = [
        f"{kind}_{i}_{stat}"
        for i in range(n_mfcc)
        for kind in ("mfcc", "mfcc_delta")
        for stat in stats
    ]
    chroma = [f"chroma_{i}_{stat}" for i in range(K.N_CHROMA) for stat in stats]
    shape = ("spectral_centroid", "spectral_bandwidth", "spectral_rolloff", "zcr")
    return mfcc + chroma + [f"{name}_{stat}" for name in shape for stat in stats]


def tabular_schema(n_mfcc: int = K.N_MFCC) -> T.StructType:
    doubles = [T.StructField(n, T.DoubleType(), False) for n in feature_names(n_mfcc)]
    return T.StructType(META + doubles)


MEL_FIELDS = [
    T.StructField("mel", T.ArrayType(T.FloatType(), False), False),
    T.StructField("mel_height", T.IntegerType(), False),
    T.StructField("mel_width", T.IntegerType(), False),
]
MEL_TABLE = T.StructType(META + MEL_FIELDS)

PREDICTION = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("filename", T.StringType()),
    ]
)

HISTOGRAM = T.StructType(
    [
        T.StructField("edges", T.ArrayType(T.DoubleType())),
        T.StructField("density", T.ArrayType(T.DoubleType())),
    ]
)

DRIFT_REFERENCE = T.StructType(
    [
        T.StructField("class_prior", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("class_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("confidence_quantiles", T.ArrayType(T.DoubleType())),
        T.StructField("feature_histograms", T.MapType(T.StringType(), HISTOGRAM)),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        T.StructField("class_names", T.ArrayType(T.StringType())),
    ]
)
