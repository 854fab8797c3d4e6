"""Request validation (V1-V5): the service's own cases and a brute force."""

import json

from panelforge.operators import validation as V

NUM, CAT = ["edad"], ["sexo"]


def _run(spark, bodies, strict=True):
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id int, body string")
    out = V.validate_items(V.explode_bodies(raw), NUM, CAT, strict)
    return out.orderBy("request_id", "item_index").collect()


def test_service_cases(spark):
    rows = _run(spark, ['{"edad":10,"sexo":"F"}', '[{"edad":1,"sexo":"F"},{"edad":2,"sexo":"M"}]',
                        '{"edad":10}', '{"edad":"diez","sexo":"F"}', "[]", '{"edad":true,"sexo":"M"}'])
    by = {}
    for r in rows:
        by.setdefault(r.request_id, []).append(r)
    assert by[0][0].status == 200 and by[0][0].edad == 10.0
    assert [r.status for r in by[1]] == [200, 200]
    assert by[2][0].errors == ["missing feature: sexo"]
    assert by[3][0].errors == ["'edad' must be numeric"]
    assert by[4][0].status == 422 and by[4][0].errors == ["empty list"]
    assert by[5][0].status == 200 and by[5][0].edad == 1.0


def test_lenient_numbers(spark):
    rows = _run(spark, ['{"edad":"12","sexo":3}'], strict=False)
    assert rows[0].status == 200 and rows[0].edad == 12.0


def _brute(body):
    try:
        v = json.loads(body)
    except ValueError:
        return [(0, ["body is not valid JSON"])]
    if isinstance(v, dict):
        items = [v]
    elif isinstance(v, list):
        if not v:
            return [(0, ["empty list"])]
        items = v
    else:
        return [(0, ["body must be an object or a list of objects"])]
    out = []
    for i, it in enumerate(items):
        errs = []
        for n in NUM:
            if n not in it:
                errs.append(f"missing feature: {n}")
            elif not isinstance(it[n], (int, float)) or it[n] is None:
                errs.append(f"'{n}' must be numeric")
        for n in CAT:
            if n not in it:
                errs.append(f"missing feature: {n}")
            elif not isinstance(it[n], str):
                errs.append(f"'{n}' must be a string")
        out.append((i, errs))
    return out


def test_brute_force(spark):
    import random

    rnd = random.Random(7)
    vals = [1, 2.5, True, "x", None]
    bodies = []
    for _ in range(150):
        def obj():
            o = {}
            for k in ("edad", "sexo"):
                if rnd.random() < 0.85:
                    o[k] = rnd.choice(vals)
            return o
        kind = rnd.random()
        body = json.dumps(obj()) if kind < 0.6 else json.dumps([obj() for _ in range(rnd.randint(0, 3))]) if kind < 0.9 else "7"
        bodies.append(body)
    rows = _run(spark, bodies)
    got = {}
    for r in rows:
        got.setdefault(r.request_id, []).append((r.item_index or 0, list(r.errors)))
    for i, b in enumerate(bodies):
        assert got[i] == _brute(b), b


def test_v1_query_matches_brute_force(spark, sf):
    from panelforge.plans import load_all
    from panelforge.plans.q_misc import request_bodies

    q = load_all()["v1_request_validation"].build(spark, sf)
    got = {}
    for r in q.collect():
        got.setdefault(r.request_id, []).append((r.item_index or 0, r.errors))
    bodies = {r.request_id: r.body for r in request_bodies(spark, sf).collect()}
    global NUM, CAT
    saved = NUM, CAT
    from panelforge.plans.q_misc import REQUEST_CAT, REQUEST_NUM

    NUM, CAT = REQUEST_NUM, REQUEST_CAT
    try:
        for rid, body in bodies.items():
            want = [(i, "; ".join(e)) for i, e in _brute(body)]
            assert sorted(got[rid]) == want, body
    finally:
        NUM, CAT = saved


def test_class_index_out_of_range_and_unknown_model(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0,), (2,), (5,)], "i int")
    label, err = V.class_from_index(F.col("i"), ["a", "b", "c"])
    out = df.select(label.alias("l"), err.alias("e")).collect()
    assert [r.l for r in out] == ["a", "c", None] and out[2].e == "class index out of range: 5"
    reqs = spark.createDataFrame([("m1", 1), ("zz", 2)], "model string, request_id int")
    reg = spark.createDataFrame([("m1",)], "name string")
    bad = V.reject_unknown_model(reqs, reg).collect()
    assert len(bad) == 1 and bad[0].status == 404 and bad[0].errors == ["unknown model 'zz'"]
