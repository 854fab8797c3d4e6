"""Batch request validation (V1-V8) on VARIANT, per row, without UDFs.

A request body is a JSON object or a list of objects. Bodies are parsed
once (``try_parse_json``), lists are exploded to one item per row, and every
declared feature is checked by its VARIANT type. Nothing fails the whole
batch: each item carries an ``errors`` array and a ``status`` code, and
accepted items get typed feature columns (numbers passed through FLOAT, as
the scoring tensors were).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

NUMERIC_VARIANT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL", "BOOLEAN")


def _path(name: str) -> str:
    return f"$['{name}']"


def explode_bodies(raw: DataFrame, body: str = "body", request_id: str = "request_id") -> DataFrame:
    """V1: (request_id, item_index, item VARIANT, body_error)."""
    v = F.try_parse_json(F.col(body))
    kind = F.schema_of_variant(v)
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(
        kind.startswith("OBJECT"), F.array(v)
    )
    body_error = (
        F.when(v.isNull(), F.lit("body is not valid JSON"))
        .when(~(kind.startswith("ARRAY") | kind.startswith("OBJECT")), F.lit("body must be an object or a list of objects"))
        .when(F.size(items) == 0, F.lit("empty list"))
    )
    staged = raw.select(F.col(request_id).alias("request_id"), items.alias("_items"), body_error.alias("body_error"))
    exploded = staged.select("request_id", "body_error", F.posexplode_outer("_items").alias("item_index", "item"))
    item_error = F.when(
        F.col("item").isNotNull() & ~F.schema_of_variant("item").startswith("OBJECT"), F.lit("list items must be objects")
    )
    return exploded.withColumn("body_error", F.coalesce("body_error", item_error))


def _is_numeric_type(t: Column) -> Column:
    cond = F.lit(False)
    for name in NUMERIC_VARIANT_TYPES:
        cond = cond | t.startswith(name)
    return cond


def validate_items(items: DataFrame, numeric: Sequence[str], categorical: Sequence[str], strict: bool = True) -> DataFrame:
    """V2-V5: per item ``errors`` (all problems listed), typed features.

    strict: numbers must be JSON numbers (booleans count as 1/0),
    categoricals JSON strings. Lenient (the CLI rules): anything that casts to
    a number, and ``str(x)`` for categoricals.
    """
    checks, values = [], {}
    for name in numeric:
        x = F.try_variant_get("item", _path(name), "variant")
        t = F.schema_of_variant(x)
        missing = x.isNull()
        if strict:
            val = F.try_variant_get("item", _path(name), "double")
            bad = ~missing & (~_is_numeric_type(t) | val.isNull())
        else:
            val = F.coalesce(F.try_variant_get("item", _path(name), "double"),
                             F.try_variant_get("item", _path(name), "string").try_cast("double"))
            bad = ~missing & val.isNull()
        checks += [F.when(missing, F.lit(f"missing feature: {name}")), F.when(bad, F.lit(f"'{name}' must be numeric"))]
        values[name] = val.cast("float").cast("double")
    for name in categorical:
        x = F.try_variant_get("item", _path(name), "variant")
        t = F.schema_of_variant(x)
        missing = x.isNull()
        if strict:
            val = F.try_variant_get("item", _path(name), "string")
            bad = ~missing & ~t.startswith("STRING")
        else:
            val = F.try_variant_get("item", _path(name), "string")
            bad = F.lit(False)
        checks += [F.when(missing, F.lit(f"missing feature: {name}")), F.when(bad, F.lit(f"'{name}' must be a string"))]
        values[name] = val
    errors = F.when(F.col("body_error").isNotNull(), F.array(F.col("body_error"))).otherwise(F.array_compact(F.array(*checks)))
    out = items.withColumn("errors", errors)
    out = out.withColumns({k: F.when(F.size("errors") == 0, v) for k, v in values.items()})
    return out.withColumn("status", F.when(F.size("errors") == 0, F.lit(200)).otherwise(F.lit(422))).drop("item")


def derive_clinical(items: DataFrame) -> DataFrame:
    """V6: derive the engineered clinical features from raw fields."""
    return items.withColumns(X.clinical_block())


def validate_for_model(items: DataFrame, numeric: Sequence[str], categorical: Sequence[str], strict: bool = True) -> DataFrame:
    """V6 before V2-V5: a request gives raw fields only. Engineered clinical
    features of the model are not asked for; the raw fields they need are
    checked with the other ones, and they are derived for accepted items."""
    engineered = [c for c in X.clinical_block() if c in numeric]
    if not engineered:
        return validate_items(items, numeric, categorical, strict)
    asked_num = [c for c in dict.fromkeys([*numeric, *X.CLINICAL_RAW_NUMERIC]) if c not in engineered]
    asked_cat = list(dict.fromkeys([*categorical, *X.CLINICAL_RAW_TEXT]))
    checked = validate_items(items, asked_num, asked_cat, strict)
    derived = derive_clinical(checked)
    ok = F.col("status") == 200
    return derived.withColumns({c: F.when(ok, F.col(c)) for c in X.clinical_block()})


def class_from_index(idx: Column, labels: Sequence[str]) -> tuple[Column, Column]:
    """V7: label for a predicted class index; out-of-range -> NULL label + error."""
    arr = F.array(*[F.lit(x) for x in labels])
    label = F.try_element_at(arr, idx.cast("int") + 1)
    err = F.when(label.isNull(), F.concat(F.lit("class index out of range: "), idx.cast("string")))
    return label, err


def reject_unknown_model(requests: DataFrame, registry: DataFrame, model_col: str = "model") -> DataFrame:
    """Requests naming a model absent from the registry -> 404 rows."""
    unknown = requests.join(registry.select(F.col("name").alias(model_col)), model_col, "left_anti")
    return unknown.withColumns({
        "status": F.lit(404),
        "errors": F.array(F.concat(F.lit("unknown model '"), F.col(model_col), F.lit("'"))),
    })
