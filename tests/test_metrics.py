"""Metrics against the original metric tests (FIXTURES.md §5)."""

import pytest

from panelforge.operators import metrics as M


def _pairs(spark, t, p, typ="int"):
    return spark.createDataFrame(list(zip(t, p)), f"y_true {typ}, y_pred {typ}")


def test_classification_fixture(spark):
    df = _pairs(spark, [0, 1, 2, 1, 0, 2, 1, 0], [0, 1, 1, 1, 0, 2, 0, 0])
    m = M.classification_metrics(df).first()
    assert m.accuracy == pytest.approx(0.75)
    assert m.precision_macro == pytest.approx(0.805556, abs=1e-6)
    assert m.recall_macro == pytest.approx(0.722222, abs=1e-6)
    assert m.f1_macro == pytest.approx(0.730159, abs=1e-6)
    assert m.precision_weighted == pytest.approx(0.78125)
    assert m.recall_weighted == pytest.approx(0.75)
    assert m.f1_weighted == pytest.approx(0.738095, abs=1e-6)


def test_perfect_f1(spark):
    m = M.classification_metrics(_pairs(spark, [0, 1, 2, 1], [0, 1, 2, 1])).first()
    assert m.f1_macro == 1.0 and 0 <= m.accuracy <= 1


def test_regression_fixture(spark):
    df = _pairs(spark, [1.0, 2.0, 3.0, 4.0], [1.5, 2.0, 2.5, 4.0], "double")
    m = M.regression_metrics(df).first()
    assert m.mae == pytest.approx(0.25)
    assert m.rmse == pytest.approx(0.353553, abs=1e-6)
    assert m.r2 == pytest.approx(0.9)


def test_confusion_matrix(spark):
    cm = M.confusion_matrix(_pairs(spark, [0, 1, 1, 0], [0, 1, 0, 0]), [0, 1]).orderBy("pos").collect()
    assert [r.real for r in cm] == ["Real_0", "Real_1"]
    assert [[r.Pred_0, r.Pred_1] for r in cm] == [[2, 0], [1, 1]]
    assert sum(r.Pred_0 + r.Pred_1 for r in cm) == 4


def test_class_report_rows(spark):
    rep = M.class_report(_pairs(spark, [0, 1, 2, 1, 0, 2, 1, 0], [0, 1, 1, 1, 0, 2, 0, 0]))
    names = {r.clase for r in rep.collect()}
    assert {"0", "1", "2", "accuracy", "macro avg", "weighted avg"} == names


def test_label_only_in_predictions_counts(spark):
    m = M.classification_metrics(_pairs(spark, [0, 0], [0, 1])).first()
    # labels {0,1}: class 1 has precision 0, recall 0 -> macro F1 = (2/3 + 0) / 2
    assert m.f1_macro == pytest.approx(1 / 3)
