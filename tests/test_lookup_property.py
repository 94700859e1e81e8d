"""J1 / J2 / J3 with hot-key salting, against a Python model."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.operators import lookup as lk
from tallyflow.sources.literal import request_strings

WORDS = ["the", "a", "of", "zz", "q"]
REQUESTS = st.lists(st.lists(st.sampled_from(WORDS + [""]), max_size=12).map(" ".join),
                    min_size=1, max_size=8)
STATE = st.dictionaries(st.sampled_from(WORDS[:4]), st.integers(1, 50), max_size=4)


def model(requests, state, mode):
    out = []
    for rid, args in enumerate(requests):
        for pos, tok in enumerate(args.split(" ")):
            if tok == "":
                continue
            v = state.get(tok)
            if mode == lk.DROP and v is None:
                continue
            if mode == lk.ZERO:
                v = 0 if v is None else v
            if mode == lk.NULL:
                v = None if v is None else str(v)
            out.append((rid, pos, tok, v))
    return sorted(out, key=repr)


@settings(max_examples=6, deadline=None)
@given(REQUESTS, STATE)
def test_salted_lookup_matches_model(spark, requests, state):
    req = lk.request_tokens(request_strings(spark, requests), key_col="word")
    st_df = spark.createDataFrame(list(state.items()) or [("none", 0)], "word string, count long")
    if not state:
        st_df = st_df.where("false")
    for mode in (lk.DROP, lk.ZERO, lk.NULL):
        got = lk.lookup(req, st_df, key_col="word", on_miss=mode).collect()
        rows = sorted(((r.request_id, r.pos, r.word, r["count"]) for r in got), key=repr)
        assert rows == model(requests, state, mode), mode
