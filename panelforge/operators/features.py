"""Feature-set builders (F1-F8): one DataFrame per model with a ``label``.

A ``FeatureSet`` is the DataFrame plus the frozen lists of numeric and
categorical feature columns; the optional date rides in the row (no index
alignment). All builders are lazy.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import windows as W
from .joins import attach_row, keep_top_k, many_to_one_join
from .splits import hash_value

# ---------------------------------------------------------------------------
# Feature lists and forbidden columns of the original pipeline.
# ---------------------------------------------------------------------------
STOCK_LEAKAGE_FEATURES = ["stock_fin", "consumo_estimado_7d", "consumo_estimado_14d", "dias_cobertura"]

CLINICAL_BASE_NUM = [
    "edad", "num_controles_mes", "num_quimios_mes", "hemoglobina_g_dl",
    "neutrofilos", "plaquetas", "temperatura_c", "peso_kg", "imc",
    "distancia_origen_km", "ingreso_familiar_mensual",
    "acompanante_presente", "requiere_apoyo_psicosocial",
]
CLINICAL_ENGINEERED = [
    "neutropenia", "neutropenia_severa", "fiebre", "neutropenia_febril",
    "anemia_severa", "plaquetopenia", "carga_clinica", "vulnerabilidad_social",
]
CLINICAL_CAT = [
    "sexo", "region_origen", "diagnostico_general", "estado_tratamiento",
    "seguro_salud", "alfabetizacion_digital",
]
PRIORITY_NUM = CLINICAL_BASE_NUM + ["dias_hospedaje"] + CLINICAL_ENGINEERED
STAY_NUM = CLINICAL_BASE_NUM + CLINICAL_ENGINEERED

STOCK_NUM = [
    "ocupacion_familias", "stock_inicio", "ingreso_stock", "consumo_real",
    "consumo_roll7", "consumo_roll14", "consumo_std7", "ingreso_roll7",
    "cobertura_bruta", "ratio_stock_seguridad", "consumo_base_por_familia",
    "stock_seguridad_7d", "es_critico", "dia_semana", "mes", "dias_sin_ingreso",
]
STOCK_CAT = ["categoria", "unidad_medida", "item_id"]

DEMAND_LAGS = [1, 2, 3, 7, 14]
DEMAND_NUM = [f"consumo_lag_{k}" for k in DEMAND_LAGS] + [
    "consumo_roll7", "consumo_roll14", "consumo_std7",
    "ocupacion_familias", "consumo_base_por_familia",
    "base_x_ocupacion", "dia_semana", "mes",
]
DEMAND_CAT = ["categoria", "item_id"]

DONATION_LAGS = [1, 2, 3]
DONATION_NUM = [f"valor_lag_{k}" for k in DONATION_LAGS] + [
    "valor_roll3", "valor_roll6", "donaciones_lag_1", "tendencia",
    "mes", "mes_sin", "mes_cos", "mes_campania",
]

TRIAGE_RENAMES = {
    "age": "edad", "gender": "sexo", "admission_month": "mes_admision",
    "admission_weekday": "dia_semana_admision", "admission_hour": "hora_admision",
    "PainGrade": "grado_dolor", "CriticalStatus": "estado_critico",
    "StuporStatus": "estado_estupor", "MentalDistress": "distres_mental",
    "MaterialDistress": "distres_material", "AVPU": "avpu",
    "BlooddpressurSystol": "presion_sistolica",
    "BlooddpressurDiastol": "presion_diastolica",
    "PulseRate": "pulso", "RespiratoryRate": "frecuencia_respiratoria",
    "O2Saturation": "saturacion_o2",
}
TRIAGE_NUM = [
    "edad", "mes_admision", "dia_semana_admision", "hora_admision",
    "grado_dolor", "estado_critico", "estado_estupor",
    "distres_mental", "distres_material",
    "presion_sistolica", "presion_diastolica", "pulso",
    "frecuencia_respiratoria", "saturacion_o2",
]
TRIAGE_CAT = ["sexo", "motivo_consulta", "avpu"]
TRIAGE_TOP_COMPLAINTS = 40
TRIAGE_POST_DECISION = ["NeedFastExecute", "operational_patient", "ref_specialist"]

SPARCS_NUM = ["anio_alta"]
SPARCS_CAT = [
    "gender", "race", "ethnicity", "hospital_service_area", "type_of_admission",
    "ccsr_diagnosis_code", "apr_drg_code", "apr_medical_surgical",
    "payment_typology_1", "emergency_department_indicator",
]
SPARCS_POST_DISCHARGE = [
    "length_of_stay", "apr_severity_of_illness", "apr_severity_of_illness_code", "apr_risk_of_mortality",
    "total_charges", "total_costs", "patient_disposition",
]
STOCK_TARGETS = {7: "stock_critico_7d", 14: "stock_critico_14d"}
# ---------------------------------------------------------------------------


class FeatureError(ValueError):
    """A table of features is not what was declared.

    ``problems`` maps a kind (``absent``, ``undeclared``, ``repeated``,
    ``forbidden``) to the columns concerned.
    """

    def __init__(self, problems: dict[str, list[str]]):
        self.problems = problems
        super().__init__("; ".join(f"{kind}: {', '.join(cols)}" for kind, cols in problems.items()))


def feature_problems(columns, declared, forbidden=()) -> dict[str, list[str]]:
    """What is wrong with the columns a builder produced."""
    seen, wanted, banned = Counter(columns), Counter(declared), set(forbidden)
    found = {
        "absent": [c for c in wanted if c not in seen],
        "undeclared": [c for c in seen if c not in wanted],
        "repeated": [c for c in seen | wanted if seen[c] > 1 or wanted[c] > 1],
        "forbidden": [c for c in seen if c in banned],
    }
    return {kind: cols for kind, cols in found.items() if cols}


@dataclass(frozen=True)
class FeatureSet:
    """Features, label and (optional) split date of one model. The columns of
    ``df`` besides label, date and ``keys`` must be the declared features and
    none of ``forbidden``."""

    df: DataFrame
    numeric: list[str]
    categorical: list[str]
    label: str = "label"
    date: str | None = None
    class_labels: list[str] | None = None
    keys: list[str] = field(default_factory=list)
    forbidden: list[str] = field(default_factory=list)

    def __post_init__(self):
        others = {self.label, self.date, *self.keys}
        problems = feature_problems([c for c in self.df.columns if c not in others], self.features, self.forbidden)
        if problems:
            raise FeatureError(problems)

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical


def _finish(df: DataFrame, numeric, categorical, label_expr, date=None, class_labels=None, forbidden=(),
            keys=()) -> FeatureSet:
    """Fill categorical NULLs, project; ``keys`` (a row id) ride along."""
    problems = feature_problems([c for c in df.columns if c in {*numeric, *categorical}], [*numeric, *categorical])
    if problems:
        raise FeatureError(problems)
    cols = [F.col(c) for c in numeric] + [X.categorical_fill(c).alias(c) for c in categorical]
    cols.append(label_expr.alias("label"))
    if date:
        cols.append(F.col(date).alias("split_date"))
    cols += [F.col(k) for k in keys]
    return FeatureSet(df.select(*cols), list(numeric), list(categorical), "label", "split_date" if date else None,
                      class_labels, keys=list(keys), forbidden=list(forbidden))


# F1 / F2 -----------------------------------------------------------------------
def priority_features(pacientes: DataFrame, target: str = "nivel_prioridad_atencion", keys=()) -> FeatureSet:
    df = pacientes.dropna(subset=[target]).withColumns(X.clinical_block())
    return _finish(df, PRIORITY_NUM, CLINICAL_CAT, X.ordinal_encode(target), class_labels=X.PRIORITY_CLASSES, keys=keys)


def stay_features(pacientes: DataFrame, target: str = "dias_hospedaje", keys=()) -> FeatureSet:
    df = pacientes.dropna(subset=[target]).withColumns(X.clinical_block())
    return _finish(df, STAY_NUM, CLINICAL_CAT, F.col(target).cast("double"), keys=keys)


# F3 ------------------------------------------------------------------------------
def inventory_history(consumo: DataFrame, items: DataFrame, restock_cap: int = 60, check_unique: bool = True,
                      items_unique: bool = False) -> DataFrame:
    """Shared history: lag, trailing stats of previous days, date parts, days
    since restock, catalogue attributes (validated many-to-one join)."""
    w = W.series_window("item_id", "fecha")
    df = consumo
    if check_unique:
        df = W.assert_unique_order(df, w, "fecha")
    df = df.withColumns(
        {
            "consumo_roll7": W.trailing_mean("consumo_real", w, 7, 3),
            "consumo_roll14": W.trailing_mean("consumo_real", w, 14, 5),
            "consumo_std7": W.trailing_std("consumo_real", w, 7, 3),
            "ingreso_roll7": W.trailing_sum("ingreso_stock", w, 7, 3),
            "consumo_lag_1": F.lag("consumo_real", 1).over(w),
            "dia_semana": X.weekday_monday0("fecha"),
            "mes": F.month("fecha"),
            "dias_sin_ingreso": W.days_since_last(F.col("ingreso_stock") > 0, "fecha", w, restock_cap),
        }
    )
    attrs = items.select("item_id", "consumo_base_por_familia", "stock_seguridad_7d", "es_critico")
    return many_to_one_join(df, attrs, "item_id", right_unique=items_unique)


# F4 ------------------------------------------------------------------------------
def stock_features(consumo: DataFrame, items: DataFrame, horizon_days: int, restock_cap: int = 60,
                   items_unique: bool = False) -> FeatureSet:
    if horizon_days not in STOCK_TARGETS:
        raise ValueError(f"no target for {horizon_days} days; known: {sorted(STOCK_TARGETS)}")
    target = STOCK_TARGETS[horizon_days]
    df = inventory_history(consumo, items, restock_cap, items_unique=items_unique).withColumns(
        {
            "cobertura_bruta": X.clip_upper(X.safe_ratio("stock_inicio", "consumo_roll7"), 120.0),
            "ratio_stock_seguridad": X.clip_upper(X.safe_ratio("stock_inicio", "stock_seguridad_7d"), 60.0),
        }
    )
    df = df.dropna(subset=[target, "consumo_roll7"])
    return _finish(df, STOCK_NUM, STOCK_CAT, F.col(target).cast("int"), date="fecha", class_labels=["normal", "critico"],
                   forbidden=[*STOCK_LEAKAGE_FEATURES, *STOCK_TARGETS.values()])


# F5 ------------------------------------------------------------------------------
def demand_features(consumo: DataFrame, items: DataFrame, restock_cap: int = 60, items_unique: bool = False) -> FeatureSet:
    w = W.series_window("item_id", "fecha")
    df = inventory_history(consumo, items, restock_cap, items_unique=items_unique)
    df = df.withColumns(W.lags("consumo_real", w, DEMAND_LAGS, "consumo_lag_")).withColumn(
        "base_x_ocupacion", F.col("consumo_base_por_familia") * F.col("ocupacion_familias")
    )
    df = df.dropna(subset=DEMAND_NUM + ["consumo_real"])
    return _finish(df, DEMAND_NUM, DEMAND_CAT, F.col("consumo_real").cast("double"), date="fecha")


# F6 ------------------------------------------------------------------------------
def monthly_series(donaciones: DataFrame, date="fecha", cat="categoria", value="valor_estimado_soles", ident="donacion_id") -> DataFrame:
    """Monthly total value and count per category (all-NULL sum -> 0)."""
    return donaciones.groupBy(F.trunc(date, "MM").alias("mes_periodo"), F.col(cat).alias("categoria")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("valor_total_soles"),
        F.count(ident).alias("num_donaciones"),
    ).where(F.col("categoria").isNotNull())


def donation_features(donaciones: DataFrame) -> FeatureSet:
    m = monthly_series(donaciones)
    w = W.series_window("categoria", "mes_periodo")
    # First month overall (1-row aggregate, broadcast by construction)
    first = m.agg(F.min("mes_periodo").alias("_first"))
    m = attach_row(m, first)
    m = m.withColumns(W.lags("valor_total_soles", w, DONATION_LAGS, "valor_lag_")).withColumns(
        {
            "valor_roll3": W.rolling(F.avg, "valor_total_soles", w, -3, -1, 3),
            "valor_roll6": W.rolling(F.avg, "valor_total_soles", w, -6, -1, 3),
            "donaciones_lag_1": F.lag("num_donaciones", 1).over(w).cast("double"),
            "mes": F.month("mes_periodo"),
            "tendencia": F.months_between("mes_periodo", "_first").cast("int"),
        }
    ).withColumns(
        {
            "mes_sin": X.month_sin("mes"),
            "mes_cos": X.month_cos("mes"),
            "mes_campania": X.campaign_month_flag("mes"),
        }
    )
    m = m.dropna(subset=DONATION_NUM)
    return _finish(m, DONATION_NUM, ["categoria"], F.col("valor_total_soles").cast("double"), date="mes_periodo")


def assert_not_empty(fs: FeatureSet, what: str) -> FeatureSet:
    """a model without a single row of history is an error (an action, for the training flow)."""
    if fs.df.isEmpty():
        raise ValueError(f"not enough history to build {what}")
    return fs


# F7 ------------------------------------------------------------------------------
def triage_features(triage: DataFrame, sample_rows: int | None = None, seed: int = 42) -> FeatureSet:
    """``sample_rows`` bounds the rows a model is fitted on: those with the
    smallest seeded hashes, the same for the same input."""
    df = triage.dropna(subset=["TriageGrade"]).withColumn("prioridad", X.triage_priority("TriageGrade"))
    df = df.dropna(subset=["prioridad"])
    df = keep_top_k(df, "ChiefComplaint", TRIAGE_TOP_COMPLAINTS, out="motivo_consulta")
    df = df.withColumnsRenamed({k: v for k, v in TRIAGE_RENAMES.items() if k in df.columns})
    if sample_rows is not None:
        df = exact_sample(df, sample_rows, seed)
    return _finish(df, TRIAGE_NUM, TRIAGE_CAT, X.ordinal_encode("prioridad"), class_labels=X.PRIORITY_CLASSES,
                   forbidden=TRIAGE_POST_DECISION)


def exact_sample(df: DataFrame, n: int, seed: int = 42, key: str | None = None, method: str = "xxhash") -> DataFrame:
    """Reproducible exact-n sample: the ``n`` smallest seeded hashes
    (``lehmer``: of one integer key, which other engines can reproduce).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject (per-partition
    top-n, then a merge of n rows per partition), never a global sort.
    """
    keys = [key] if key else df.columns
    h = hash_value(keys, seed, method)
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


# F8 ------------------------------------------------------------------------------
def sparcs_features(sparcs: DataFrame) -> FeatureSet:
    df = sparcs.withColumn("dias_estadia", X.censored_number("length_of_stay")).dropna(subset=["dias_estadia"])
    return _finish(df, SPARCS_NUM, SPARCS_CAT, F.col("dias_estadia"), forbidden=SPARCS_POST_DISCHARGE)
