"""Plan shape: the physical plans we want at scale.

* word count: one shuffle on ``word`` with a partial aggregate before it
* hierarchical roll-up: the groups' exchange, reused for the first time; no window
* scans read only the referenced columns
* top-N: WindowGroupLimit before the exchange (map-side top-N)
* ranking: no rows, only the top values, meet in one task
* no Python UDF in any batch query
* each JSON parse appears once per plan
"""

import re

import pytest

import __spark_entry__ as E
from tallyflow.plans import catalog
from tallyflow.plans import queries as Q

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    # shuffles, not broadcasts
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(", plan)) + \
        len(re.findall(r"Exchange SinglePartition", plan))


def test_word_count_one_shuffle_with_partial_agg(spark):
    p = _plan(Q.word_count_space(spark, SF))
    assert _exchanges(p) == 1
    assert "partial_count" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p or \
           "ReadSchema: struct<text:string>" in p


def _final(df):
    """The plan as run: adaptive, with reused exchanges."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


def test_hierarchical_reuses_the_groups(spark):
    """No analytic window over the groups; the groups are aggregated once and
    read again for the window's first time."""
    for q in (Q.hierarchical_count, Q.hierarchical_new):
        p = _final(q(spark, SF))
        assert not re.search(r"^\W*(Window|WindowGroupLimit) ", p, re.M)
        assert "ReusedExchange" in p or p.count("parseJson") <= 1, p
        assert "collect_list" not in p
    p = _plan(Q.hierarchical_count(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p


def test_counts_by_name_single_aggregate(spark):
    p = _plan(Q.window_count_by_name(spark, SF))
    assert _exchanges(p) == 1 and "Expand" in p


def test_top_n_partial_limit(spark):
    p = _plan(Q.rolling_top_n(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_ranking_has_no_single_partition_of_rows(spark):
    """Only the top values (TakeOrderedAndProject) reach one task, never the
    ranked rows."""
    for q in (Q.top_words, Q.rank_latest):
        p = _plan(q(spark, SF))
        assert "TakeOrderedAndProject" in p and "rank(" not in p
        single = p.count("Exchange SinglePartition")
        assert single == 0, p


def test_no_repartition_by_default(spark):
    for name in sorted(catalog.QUERIES):
        if not name.startswith("stream_"):
            assert "REPARTITION_BY_NUM" not in _plan(catalog.QUERIES[name](spark, SF)), name


def test_json_parsed_once(spark):
    p = _plan(Q.parse_call_log(spark, SF))
    assert p.count("from_json(") == 1
    p2 = _plan(Q.window_count_project(spark, SF))
    assert p2.count("parseJson") == 1


def test_split_runs_once(spark):
    p = _plan(Q.word_count_ws(spark, SF))
    assert "size(CASE" not in p  # no inferred filter re-running the split


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_")))
def test_no_python_udf(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_lookup_final_plan_broadcasts_measured_side(spark):
    """SURVEY 4: look-ups end as broadcast hash joins. Static broadcast is
    off, so the broadcasts are AQE's, on measured sizes, plus the hot-key set,
    which is bounded by count. Where misses are kept the join is a left join
    from the tokens, so the tokens are never the build side; where they are
    dropped it is an inner join, and AQE may build either measured side."""
    for q, how in ((Q.lookup_zero, "LeftOuter"), (Q.lookup_null, "LeftOuter"), (Q.lookup_drop, "Inner")):
        last = next(line for line in _final(q(spark, SF)).split("\n") if "_salt#" in line and "Join" in line)
        assert how in last, last
        if how == "LeftOuter" and "Broadcast" in last:
            assert "BuildRight" in last
