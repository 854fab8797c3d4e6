"""Loaders and sinks (S1-S5, S10-S13): the original loading tests on temp files."""

import os

import pytest

from panelforge.schema import DOMAIN_SCHEMAS, FILE_NAMES
from panelforge.sources import files as S
from panelforge.sources import registry as REG


def _write(path, text, bom=True):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as fh:
        fh.write(text)


ITEMS_CSV = """item_id,nombre_item,categoria,unidad_medida,consumo_base_por_familia,stock_seguridad_7d,stock_maximo_referencial,es_critico,extra
IT01,arroz,alimentos,kg,0.5,20,200,1,x
IT02,jabon,higiene,unidad,NaN,10,100,0,y
"""


def test_bom_csv_with_extra_column(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, FILE_NAMES["items"]), ITEMS_CSV)
    df = S.load_table(spark, "items", tmpdir_path)
    rows = df.orderBy("item_id").collect()
    assert rows[0].item_id == "IT01" and "extra" in df.columns
    assert rows[1].consumo_base_por_familia is None  # text NaN -> NULL, not NaN
    assert dict(df.dtypes)["stock_seguridad_7d"] == "int"


def test_missing_file(spark, tmpdir_path):
    with pytest.raises(S.MissingDataError):
        S.load_table(spark, "items", tmpdir_path)


def test_wrong_schema(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, FILE_NAMES["items"]), "a,b\n1,2\n")
    with pytest.raises(S.InvalidTableError, match="missing expected columns"):
        S.load_table(spark, "items", tmpdir_path)


def test_header_only(spark, tmpdir_path):
    header = ",".join(f.name for f in DOMAIN_SCHEMAS["items"].fields)
    _write(os.path.join(tmpdir_path, FILE_NAMES["items"]), header + "\n")
    with pytest.raises(S.InvalidTableError, match="no rows"):
        S.load_table(spark, "items", tmpdir_path)


def test_bad_date_becomes_null(spark, tmpdir_path):
    cols = [f.name for f in DOMAIN_SCHEMAS["donaciones"].fields]
    body = "D1,2025-01-05,Empresa,IT01,arroz,alimentos,kg,3,12.5,Regular\nD2,not-a-date,Persona,IT01,arroz,alimentos,kg,1,5.0,Navidad\n"
    _write(os.path.join(tmpdir_path, FILE_NAMES["donaciones"]), ",".join(cols) + "\n" + body)
    rows = S.load_table(spark, "donaciones", tmpdir_path).orderBy("donacion_id").collect()
    assert rows[0].fecha.isoformat() == "2025-01-05" and rows[1].fecha is None


def test_union_with_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, "z")], "k int, y string")
    out = S.union_extracts([a, b]).orderBy("k").collect()
    assert (out[0].y, out[1].x) == (None, None)


def test_sinks_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    for fmt in ("parquet", "csv", "json"):
        p = os.path.join(tmpdir_path, fmt)
        S.save_table(df, p, fmt)
        assert os.path.isdir(p)
    back = S.load_json(spark, os.path.join(tmpdir_path, "json"), multiline=False)
    assert back.count() == 1
    with pytest.raises(S.MissingDataError):
        S.load_json(spark, os.path.join(tmpdir_path, "nope.json"))


def _entry(name, task="classification", f1=0.8):
    return {"name": name, "task": task, "description": "d", "split": "temporal", "selection_metric": "f1_macro",
            "selected_algorithm": "boosted", "best_hyperparameters": "{}", "metrics": {"f1_macro": f1, "accuracy": 0.9},
            "numeric_features": ["a"], "categorical_features": ["b"], "categorical_values": {"b": ["x", "y"]},
            "class_labels": ["normal", "critico"], "n_train": 10, "n_test": 2, "trained_at": "now"}


def test_registry_upsert_read_overview(spark, tmpdir_path):
    old = REG.entries_frame(spark, [_entry("m1"), _entry("m2")])
    new = REG.entries_frame(spark, [_entry("m2", f1=0.95)])
    merged = REG.upsert(old, new)
    p = os.path.join(tmpdir_path, "registry")
    REG.write_registry(merged, p)
    back = REG.read_registry(spark, p)
    got = {r.name: r.metrics["f1_macro"] for r in back.collect()}
    assert got == {"m1": 0.8, "m2": 0.95}
    ov = {r.name: r.value_text for r in REG.overview(back).collect()}
    assert ov["m2"] == "0.950"
    with pytest.raises(KeyError):
        REG.lookup(back, "nope")
    with pytest.raises(REG.RegistryError):
        REG.read_registry(spark, os.path.join(tmpdir_path, "missing"))


def test_request_files_object_or_list(spark, tmpdir_path):
    from panelforge.operators import validation as V

    d = os.path.join(tmpdir_path, "req")
    os.makedirs(d)
    _write(os.path.join(d, "a.json"), '{"edad": 10, "sexo": "F"}', bom=False)
    _write(os.path.join(d, "b.json"), '[{"edad": 1, "sexo": "M"},\n {"edad": 2}]', bom=False)
    items = V.validate_items(V.explode_bodies(S.load_requests(spark, d)), ["edad"], ["sexo"]).collect()
    assert sorted(r.status for r in items) == [200, 200, 422]
    with pytest.raises(S.MissingDataError):
        S.load_requests(spark, os.path.join(tmpdir_path, "none"))


def test_contract_violations(spark):
    from panelforge.schema import CAPTURES_CONTRACT

    df = spark.createDataFrame([("c1", "2025-01-01 10:00:00", None, "DNI", "Alta", 0.9, "a|b", "1", "web"),
                                ("c2", "not a time", "p1", "DNI", None, None, None, "maybe", None)],
                               "captura_id string, fecha_captura string, paciente_id string, tipo_documento string, "
                               "calidad_imagen string, confianza_ocr double, campos_extraidos string, "
                               "requiere_revision_manual string, origen_captura string")
    got = {r.columna: r.violaciones for r in S.contract_violations(df, CAPTURES_CONTRACT).collect()}
    assert got["paciente_id"] == 1 and got["fecha_captura"] == 1 and got["confianza_ocr"] == 1
    assert got["requiere_revision_manual"] == 1 and got["calidad_imagen"] == 0


def test_optional_extracts(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "triage.csv")
    _write(p, "age,gender,ChiefComplaint,PainGrade,TriageGrade,x\n3,F,fever,2,1,z\n", bom=False)
    assert S.load_optional(spark, "triage", p).count() == 1
    q = os.path.join(tmpdir_path, "sparcs.csv")
    _write(q, "length_of_stay,gender\n3,F\n", bom=False)
    with pytest.raises(S.InvalidTableError):
        S.load_optional(spark, "sparcs", q)


def test_folder_of_files_with_their_own_headers(spark, tmpdir_path):
    """Another column order and a BOM in the second file, a line break, doubled quotes and a comma in fields."""
    d = os.path.join(tmpdir_path, "folder")
    os.makedirs(d)
    names = [f.name for f in DOMAIN_SCHEMAS["items"].fields]
    one = ["IT01", '"arroz\n""extra"", largo"', "alimentos", "kg", "0.5", "20", "200", "1"]
    two = ["IT02", "jabon", "higiene", "unidad", "NaN", "10", "100", "0"]
    _write(os.path.join(d, "a.csv"), ",".join(names) + "\n" + ",".join(one) + "\n", bom=False)
    _write(os.path.join(d, "b.csv"), ",".join(names[::-1]) + ",nota\n" + ",".join(two[::-1]) + ",n\n", bom=True)
    _write(os.path.join(d, "c.csv"), "", bom=False)
    df = S.read_validated_csv(spark, d, DOMAIN_SCHEMAS["items"], names)
    a, b = df.orderBy("item_id").collect()
    assert (a.item_id, a.nombre_item, a.stock_seguridad_7d, a.es_critico, a.nota) == ("IT01", 'arroz\n"extra", largo', 20, 1, None)
    assert (b.item_id, b.nombre_item, b.consumo_base_por_familia, b.stock_maximo_referencial, b.nota) == ("IT02", "jabon", None, 100, "n")
    _write(os.path.join(d, "d.csv"), "item_id,categoria\nIT03,x\n")
    with pytest.raises(S.InvalidTableError, match="d.csv: missing expected columns"):
        S.read_validated_csv(spark, d, DOMAIN_SCHEMAS["items"], names)
    twice = os.path.join(tmpdir_path, "twice.csv")
    _write(twice, ",".join([*names, names[0]]) + "\n")
    with pytest.raises(S.InvalidTableError, match="twice"):
        S.read_validated_csv(spark, twice, DOMAIN_SCHEMAS["items"], names)


def test_registry_write_that_stops_half_way(spark, tmpdir_path, monkeypatch):
    p = os.path.join(tmpdir_path, "registry")
    with pytest.raises(RuntimeError):
        with monkeypatch.context() as m:
            m.setattr(REG, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            REG.commit_entries(REG.entries_frame(spark, [_entry("m0")]), p)
    with pytest.raises(REG.RegistryMissing):
        REG.read_registry(spark, p)  # nothing was ever committed
    REG.commit_entries(REG.entries_frame(spark, [_entry("m1")]), p)
    with pytest.raises(RuntimeError):
        with monkeypatch.context() as m:
            m.setattr(REG, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            REG.commit_entries(REG.entries_frame(spark, [_entry("m1", f1=0.1), _entry("m2")]), p)
    assert [(r.name, r.metrics["f1_macro"]) for r in REG.read_registry(spark, p).collect()] == [("m1", 0.8)]
    out = REG.commit_entries(REG.entries_frame(spark, [_entry("m2")]), p)
    assert sorted(r.name for r in out.collect()) == ["m1", "m2"] and REG.committed(spark, p)[0] == 2


def test_registry_with_two_writers(spark, tmpdir_path, monkeypatch):
    """The other writer commits between this one's read and its commit."""
    p = os.path.join(tmpdir_path, "registry")
    REG.commit_entries(REG.entries_frame(spark, [_entry("m0")]), p)
    real, tries = REG._commit, []

    def late(spark_, path, number, folder):
        tries.append(number)
        if len(tries) == 1:
            monkeypatch.setattr(REG, "_commit", real)
            REG.commit_entries(REG.entries_frame(spark, [_entry("other"), _entry("m0", f1=0.5)]), p)
            monkeypatch.setattr(REG, "_commit", late)
        return real(spark_, path, number, folder)

    monkeypatch.setattr(REG, "_commit", late)
    REG.commit_entries(REG.entries_frame(spark, [_entry("mine")]), p)
    got = {r.name: r.metrics["f1_macro"] for r in REG.read_registry(spark, p).collect()}
    assert got == {"m0": 0.5, "other": 0.8, "mine": 0.8} and tries == [2, 3]
    assert [n for n in os.listdir(os.path.join(p, "commits")) if n.isdigit()] and not [n for n in os.listdir(os.path.join(p, "commits")) if n.startswith(".") and not n.endswith(".crc")]


def test_registry_of_an_earlier_release(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "registry")
    REG.entries_frame(spark, [_entry("old")]).coalesce(1).write.json(p)
    assert [r.name for r in REG.read_registry(spark, p).collect()] == ["old"]
    REG.commit_entries(REG.entries_frame(spark, [_entry("new")]), p)
    assert sorted(r.name for r in REG.read_registry(spark, p).collect()) == ["new", "old"]
