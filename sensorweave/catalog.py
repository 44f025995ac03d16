"""The variable catalog: names, groups, category domains, jump limits, code labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIBRATION, PHYSICAL = "vibration", "physical"
CATEGORICAL, ACCUMULATIVE = "categorical", "accumulative"
UNKNOWN = "unknown"

# Source name, canonical name, group, largest accepted jump between two
# consecutive readings (None = not checked), valid categories (None = not a category).
CATALOG = [
    ("Speed", "speed", PHYSICAL, 1800.0, None),
    ("Skin Temperature", "skin_temp", PHYSICAL, 10.0, None),
    ("Overall Vibration", "overall_vibration", VIBRATION, 2.0, None),
    ("Acceleration RMS (Axial)", "acc_rms_axial", VIBRATION, 2.0, None),
    ("Acceleration RMS (Radial)", "acc_rms_radial", VIBRATION, 2.0, None),
    ("Acceleration RMS (Tangential)", "acc_rms_tangential", VIBRATION, 2.0, None),
    ("Bearing Condition", "bearing_condition", CATEGORICAL, None, [0, 1, 2, 3, 4]),
    ("Peak to Peak (Axial)", "peak_to_peak_axial", VIBRATION, 5.0, None),
    ("Peak to Peak (Radial)", "peak_to_peak_radial", VIBRATION, 5.0, None),
    ("Peak to Peak (Tangential)", "peak_to_peak_tangential", VIBRATION, 5.0, None),
    ("Peak to Peak", "peak_to_peak", VIBRATION, 5.0, None),
    ("Vibration (Axial)", "vibration_axial", VIBRATION, 2.0, None),
    ("Vibration (Radial)", "vibration_radial", VIBRATION, 2.0, None),
    ("Vibration (Tangential)", "vibration_tangential", VIBRATION, 2.0, None),
    ("Misalignment (BETA)", "misalignment_beta", CATEGORICAL, None, [0, 1]),
    ("Total Running Time", "total_run_time", ACCUMULATIVE, None, None),
    ("Total Number of Starts", "total_num_starts", ACCUMULATIVE, None, None),
    ("Unbalance (BETA)", "unbalance_beta", CATEGORICAL, None, [0, 1]),
    ("Motor Supply Frequency", "motor_supply_freq", PHYSICAL, 10.0, None),
    ("Output Power", "output_power", PHYSICAL, 260.0, None),
    ("Looseness (BETA)", "looseness_beta", CATEGORICAL, None, [0, 1]),
    ("Number of Starts Between Measurements", "num_starts_betw_meas", CATEGORICAL, None, [0, 1, 2]),
]

# Label of each quality code.
QUALITY_LABELS = {
    0: "OK",
    1: "Valor faltante",
    2: "Gap temporal",
    3: "Valor extremo",
    4: "Categoría inválida",
    5: "Valor imposible",
    6: "Error de integridad en contador",
    9: "Error desconocido",
}

# Label of each processing code.
PROCESSING_LABELS = {
    0: "original",
    1: "imputed_linear",
    2: "imputed_ffill",
    3: "missing_not_imputed",
}

UNKNOWN_LABEL = "Desconocido"

# Defaults of the quality flow.
MAIN_SIGNAL = "acc_rms_radial"
EXPECTED_S = 900
GAP_FACTOR = 1.5
SMALL_DELTA_FACTOR = 0.5
FEATURE_WINDOW_S = 7200
MIN_SAMPLES = 4
SLOT_S = 900
JITTER_S = 60
IMPUTE_LIMIT = 2
STUCK_ROWS = 8
STUCK_STD = 1e-6
NOISE_ROWS = 4
NOISE_STD = 0.5
NOISE_FACTOR = 3.0
COUNTER_TOLERANCE = 1e-6

# Defaults of the resampling flow.
RESAMPLE_S = 300
IQR_FACTOR = 3.0
ROLLING_ROWS = 12
SMOOTH_ROWS = {"acc_rms_axial": 3, "acc_rms_radial": 3, "acc_rms_tangential": 3, "skin_temp": 5}

FLAG_COLUMNS = [
    "is_missing",
    "is_invalid_physical",
    "is_high",
    "is_outlier",
    "is_invalid_category",
    "is_invalid_monotonic",
    "is_gap",
    "is_small_delta",
]

TO_CANONICAL = {raw: name for raw, name, *_ in CATALOG}
TO_SOURCE = {name: raw for raw, name, *_ in CATALOG}
CANONICAL_NAMES = [name for _, name, *_ in CATALOG]
CATEGORY_DOMAINS = {name: domain for _, name, _, _, domain in CATALOG if domain is not None}
JUMP_LIMITS = {name: jump for _, name, _, jump, _ in CATALOG if jump is not None}


def canonical_names(*groups: str) -> list[str]:
    return [name for _, name, group, *_ in CATALOG if group in groups]


def spellings(names: list[str]) -> list[str]:
    """Both accepted spellings (canonical and source) of each canonical name."""
    return [s for name in names for s in (name, TO_SOURCE[name])]


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "\\'") + "'" for v in values)


def _cases(column: str, mapping: dict, otherwise: str) -> str:
    def literal(v):
        return quoted([v]) if isinstance(v, str) else repr(v)

    whens = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


# The expressions below are written as SQL text: long name lists cost one call, not one per name.

def in_group(*groups: str, column: str = "variable") -> Column:
    return F.expr(f"{column} IN ({quoted(spellings(canonical_names(*groups)))})")


def named(name: str, column: str = "variable") -> Column:
    """Is it this variable, in either spelling?"""
    return F.expr(f"{column} IN ({quoted(spellings([name]))})")


def group_of(column: str = "variable") -> Column:
    """Group of a variable; 'unknown' when it is not in the catalog."""
    groups = {s: group for _, name, group, *_ in CATALOG for s in spellings([name])}
    return F.expr(_cases(column, groups, quoted([UNKNOWN])))


def strategy_of(column: str = "variable") -> Column:
    """Fill strategy: 'ffill' for categories and counters, 'linear' for anything else."""
    return F.when(in_group(CATEGORICAL, ACCUMULATIVE, column=column), "ffill").otherwise("linear")


def canonical_of(column: str = "variable") -> Column:
    """Canonical name; a name that is not in the catalog is kept."""
    return F.expr(_cases(column, TO_CANONICAL, column))


def source_of(column: str = "variable") -> Column:
    return F.expr(_cases(column, TO_SOURCE, column))


def jump_limit_of(column: str = "variable") -> Column:
    limits = {s: v for n, v in JUMP_LIMITS.items() for s in spellings([n])}
    return F.expr(_cases(column, limits, "NULL")).cast("double")


def label_of(code: str, labels: dict[int, str]) -> Column:
    return F.expr(_cases(code, labels, quoted([UNKNOWN_LABEL])))


def catalog_frame(spark: SparkSession) -> DataFrame:
    """The catalog as a 22-row dimension table."""
    rows = [(raw, name, group, jump, domain) for raw, name, group, jump, domain in CATALOG]
    frame = spark.createDataFrame(
        rows, "source_name string, variable string, group string, jump_limit double, domain array<int>"
    )
    return frame.withColumn("strategy", strategy_of("variable"))
