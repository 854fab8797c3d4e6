"""Display lookups (P30, P31): fixed text tables joined by broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exprs import display_label

# ---------------------------------------------------------------------------
# Card texts and display names of the original interface.
# ---------------------------------------------------------------------------
CLASS_CARDS = [
    # model, label, color, eyebrow, headline, message
    ("prioridad_atencion", "Bajo", "green", "Prioridad", "Prioridad BAJA",
     "Este paciente puede continuar con el seguimiento habitual."),
    ("prioridad_atencion", "Medio", "amber", "Prioridad", "Prioridad MEDIA",
     "Este paciente requiere seguimiento cercano en los próximos días."),
    ("prioridad_atencion", "Alto", "red", "Prioridad", "Prioridad ALTA — este paciente necesita atención inmediata",
     "Coordina cuanto antes con el personal médico del albergue."),
    ("stock_critico_7d", "normal", "green", "Stock", "Stock normal",
     "No se espera desabastecimiento de este ítem en los próximos 7 días."),
    ("stock_critico_7d", "critico", "red", "Stock", "Stock crítico",
     "Este ítem podría agotarse en los próximos 7 días. Considera reponerlo pronto."),
    ("stock_critico_14d", "normal", "green", "Stock", "Stock normal",
     "No se espera desabastecimiento de este ítem en los próximos 14 días."),
    ("stock_critico_14d", "critico", "red", "Stock", "Stock crítico",
     "Este ítem podría agotarse en los próximos 14 días. Considera reponerlo pronto."),
]
REGRESSION_CARDS = {
    # model: (eyebrow, decimals, headline prefix, headline suffix)
    "duracion_estadia": ("Estimado", 0, "", " días de hospedaje"),
    "demanda_consumo": ("Estimado", 1, "", " unidades"),
    "proyeccion_donaciones": ("Proyección", 2, "S/ ", ""),
}
REGRESSION_MESSAGES = {
    # model: (before the value, after it); the value as in the headline
    "duracion_estadia": ("Se estima que este paciente necesitará aproximadamente ", " días de hospedaje."),
    "demanda_consumo": ("Se estima un consumo de aproximadamente ", " unidades para este ítem."),
    "proyeccion_donaciones": ("Se proyecta un valor de donaciones de aproximadamente S/ ", " para esta categoría el próximo mes."),
}
MODEL_DISPLAY_NAMES = {
    "prioridad_atencion": "Prioridad de atención del paciente",
    "duracion_estadia": "Días de hospedaje estimados",
    "stock_critico_7d": "Riesgo de quiebre de stock (7 días)",
    "stock_critico_14d": "Riesgo de quiebre de stock (14 días)",
    "demanda_consumo": "Consumo esperado por ítem",
    "proyeccion_donaciones": "Proyección de donaciones por categoría",
}
CATEGORY_VALUE_LABELS = {
    "sexo": {"F": "Femenino", "M": "Masculino"},
    "categoria": {
        "alimentos": "Alimentos",
        "higiene": "Higiene",
        "insumos_medicos": "Insumos médicos",
        "medicamentos_soporte": "Medicamentos de soporte",
    },
}
# ---------------------------------------------------------------------------


def result_cards(scored: DataFrame, model: str, prediction: str, prob: str | None = None) -> DataFrame:
    """P30 (classification): color / eyebrow / headline / message per scored row
    and the confidence round(p * 100); unknown labels fall back to a neutral card.

    The card table has a fixed handful of rows, so it is broadcast.
    """
    spark = scored.sparkSession
    cards = spark.createDataFrame(CLASS_CARDS, "_model string, _label string, _color string, _eyebrow string, _headline string, _message string")
    j = scored.join(F.broadcast(cards), (F.col(model) == F.col("_model")) & (F.col(prediction) == F.col("_label")), "left")
    conf = F.floor(F.col(prob) * F.lit(100.0) + F.lit(0.5)).cast("long") if prob else F.lit(None).cast("long")
    return j.withColumns({
        "color": F.coalesce("_color", F.lit("teal")),
        "eyebrow": F.coalesce("_eyebrow", F.lit("Resultado")),
        "headline": F.coalesce("_headline", F.col(prediction).cast("string")),
        "message": F.coalesce("_message", F.lit("Resultado de la evaluación.")),
        "confianza": conf,
    }).drop("_model", "_label", "_color", "_eyebrow", "_headline", "_message")


def regression_headline(model: Column | str, value: Column | str) -> Column:
    """P30 (regression): value with 0/1/2 decimals depending on the model."""
    m = F.col(model) if isinstance(model, str) else model
    v = F.col(value) if isinstance(value, str) else value
    expr = F.format_number(v, 2)
    for name, (_, dec, pre, suf) in REGRESSION_CARDS.items():
        expr = F.when(m == name, F.concat(F.lit(pre), F.format_string(f"%.{dec}f", v), F.lit(suf))).otherwise(expr)
    return expr


def regression_cards(scored: DataFrame, model: str, value: str) -> DataFrame:
    """P30 (regression): color / eyebrow / headline / message per scored row.
    A model without a card gets the neutral one; a row without a value has no headline and message."""
    v, m = F.col(value), F.col(model)
    eyebrow, message = F.lit("Resultado"), F.when(v.isNotNull(), F.lit("Resultado de la evaluación."))
    for name, (brow, decimals, _, _) in REGRESSION_CARDS.items():
        before, after = REGRESSION_MESSAGES[name]
        eyebrow = F.when(m == name, F.lit(brow)).otherwise(eyebrow)
        text = F.when(v.isNotNull(), F.concat(F.lit(before), F.format_string(f"%.{decimals}f", v), F.lit(after)))
        message = F.when(m == name, text).otherwise(message)
    headline = F.when(v.isNotNull(), regression_headline(m, v))
    return scored.select("*", F.lit("teal").alias("color"), eyebrow.alias("eyebrow"), headline.alias("headline"), message.alias("message"))


def category_label(field: str, col: str) -> Column:
    """Display label of a category value, raw value as fallback."""
    return display_label(col, CATEGORY_VALUE_LABELS.get(field, {}))


def model_label(col: str, description: str | None = None) -> Column:
    """Display name of a model, else its description, else the raw name."""
    from .exprs import map_values

    fallback = [F.col(description)] if description else []
    return F.coalesce(map_values(col, MODEL_DISPLAY_NAMES), *fallback, F.col(col))
