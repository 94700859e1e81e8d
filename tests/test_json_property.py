"""F2 / F3 / C5 (strict) against a Python json model on generated messages."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.operators import calllog as cl

SCALARS = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6),
                    st.text(alphabet="abc é\"\\", max_size=5))
VALUES = st.recursive(SCALARS, lambda inner: st.one_of(
    st.lists(inner, max_size=3), st.dictionaries(st.sampled_from("xyz"), inner, max_size=3)),
    max_leaves=5)
OBJECTS = st.dictionaries(st.sampled_from(["k", "a", "b"]), VALUES, max_size=3)
MESSAGES = st.one_of(OBJECTS.map(json.dumps), VALUES.map(json.dumps),
                     st.sampled_from(["", "bad", "{", "[1,", "{\"k\": }"]))


def model(msg: str):
    """(kept, value) for the strict filter; kept=None means a reject."""
    try:
        obj = json.loads(msg)
    except ValueError:
        return None, None
    if not isinstance(obj, dict):
        return None, None
    if "k" not in obj:
        return False, None                       # dropped, not a reject
    v = obj["k"]
    if v is None or isinstance(v, str):
        return True, v
    return None, None                            # strict: other JSON types are rejects


@settings(max_examples=8, deadline=None)
@given(st.lists(MESSAGES, min_size=1, max_size=40))
def test_strict_key_filter_matches_model(spark, msgs):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "i long, value string")
    kept = {r.i: r.k for r in cl.json_key_filter(df, "k", keep=("i",)).collect()}
    rejected = {r.i for r in cl.json_key_rejects(df, "k", keep=("i",)).collect()}
    for i, m in enumerate(msgs):
        ok, v = model(m)
        if ok is True:
            assert i in kept and kept[i] == v and i not in rejected, m
        elif ok is False:
            assert i not in kept and i not in rejected, m
        else:
            assert i not in kept and i in rejected, m
