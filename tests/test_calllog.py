"""C3-C7, C15, F2-F4, P3, P8 on FIXTURES.md D and E."""

import datetime as dt

from tallyflow.operators import calllog as cl

from conftest import BASE_MS


def test_parse_call_log(call_log):
    rows = {r.msg_id: r for r in cl.parse_call_log(call_log).collect()}
    assert set(rows) == {"L1", "L2", "L3", "L4", "L5", "L6"}
    assert rows["L4"].class_name == "c.D" and rows["L5"].class_name == "a.B"
    assert rows["L5"].ts_ms == BASE_MS + 9999
    assert rows["L6"].event_time == dt.datetime(2024, 1, 1, 0, 0, 10)
    assert rows["L1"].project_name == "p1" and rows["L3"].method_name == "m2"


def test_missing_fields_and_rejects(spark):
    msgs = ['{"projectName":"p","clazz":"class a.B","method":"m"}',   # no id, no date
            '{"id":"x","date":5,"projectName":"p","method":"m"}',      # no clazz
            'bad', '', '[1]', '{"id":"y","date":"soon"}']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    rows = cl.parse_call_log(df).collect()
    assert len(rows) == 2
    a = [r for r in rows if r.msg_id is None][0]
    assert a.ts_ms == 0 and a.class_name == "a.B"
    b = [r for r in rows if r.msg_id == "x"][0]
    assert b.class_name is None
    rej = sorted(r.value for r in cl.call_log_rejects(df).collect())
    assert rej == sorted(['bad', '', '[1]', '{"id":"y","date":"soon"}'])


def test_status_route(call_log):
    rows = cl.status_route(cl.parse_call_log(call_log)).collect()
    assert sorted(r.msg_id for r in rows) == ["L1", "L2", "L6"]
    assert {r.msg_id: r.return_code for r in rows} == {"L1": "10000", "L2": "10002", "L6": "99999"}


def test_general_stream_drops_msg_id(call_log):
    g = cl.general_stream(cl.parse_call_log(call_log))
    assert "msg_id" not in g.columns and g.count() == 6
    assert set(cl.route(cl.parse_call_log(call_log))) == {"general", "status", "result_code"}


E_ROWS = ['{"projectName":"p"}', '{"projectName":null}', '{"projectName":5}',
          '{"projectName":{"x":1}}', '{"a":1}', '{}', '[1]', 'bad', '']


def test_json_key_filter_strict_and_coerce(spark):
    df = spark.createDataFrame([(v,) for v in E_ROWS], "value string")
    strict = {r.value: r.projectName for r in cl.json_key_filter(df, "projectName").collect()}
    assert strict == {'{"projectName":"p"}': "p", '{"projectName":null}': None}
    co = {r.value: r.projectName for r in
          cl.json_key_filter(df, "projectName", mode=cl.COERCE).collect()}
    assert co == {'{"projectName":"p"}': "p", '{"projectName":null}': None,
                  '{"projectName":5}': "5", '{"projectName":{"x":1}}': '{"x":1}'}


def test_json_key_rejects(spark):
    df = spark.createDataFrame([(v,) for v in E_ROWS], "value string")
    strict = sorted(r.value for r in cl.json_key_rejects(df, "projectName").collect())
    assert strict == sorted(['{"projectName":5}', '{"projectName":{"x":1}}', '[1]', 'bad', ''])
    co = sorted(r.value for r in cl.json_key_rejects(df, "projectName", mode=cl.COERCE).collect())
    assert co == sorted(['[1]', 'bad', ''])


def test_json_key_with_extra_fields(spark):
    df = spark.createDataFrame([('{"projectName":"p","date":7}',), ('{"projectName":"q"}',)],
                               "value string")
    got = {r.projectName: r.ts for r in
           cl.json_key_filter(df, "projectName", fields={"ts": ("date", "bigint")}).collect()}
    assert got == {"p": 7, "q": None}


def test_odd_key_names(spark):
    df = spark.createDataFrame([('{"it\'s":"v"}',)], "value string")
    assert cl.json_key_filter(df, "it's").first()["it's"] == "v"


def test_strict_call_log_types(spark):
    msgs = ['{"id":7,"date":5,"projectName":5,"clazz":"class a.B","method":null}',
            '{"id":"x","date":1.5,"projectName":"p"}',
            '{"id":"y","date":null,"projectName":"p"}',
            '{"id":"z","projectName":"p","clazz":{"k":1}}', '[1]', 'bad']
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    rows = {r.msg_id: r for r in cl.parse_call_log(df, mode=cl.STRICT).collect()}
    # non-text values read as null (the reference's caught getString error)
    assert set(rows) == {None, "z"}
    a = rows[None]
    assert (a.project_name, a.class_name, a.method_name, a.ts_ms) == (None, "a.B", None, 5)
    assert rows["z"].class_name is None and rows["z"].ts_ms == 0
    rej = sorted(r.value for r in cl.call_log_rejects(df, mode=cl.STRICT).collect())
    assert rej == sorted(['{"id":"x","date":1.5,"projectName":"p"}',
                          '{"id":"y","date":null,"projectName":"p"}', '[1]', 'bad'])
    # strict is the default; coerce reads the same numbers as text
    assert {r.msg_id for r in cl.parse_call_log(df).collect()} == set(rows)
    co = {r.msg_id for r in cl.parse_call_log(df, mode=cl.COERCE).collect()}
    assert "7" in co


def test_strict_equals_coerce_on_text_fields(spark, call_log):
    a = sorted(map(tuple, cl.parse_call_log(call_log).collect()))
    b = sorted(map(tuple, cl.parse_call_log(call_log, mode=cl.STRICT).collect()))
    assert a == b
