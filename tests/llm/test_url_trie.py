"""op11: the trie against trying every rule on every url."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyflow.llm import url_trie as ut

RULE = "host string, path string, verdict string"


def split(url):
    """Host and path by hand."""
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, tail[:end]


def plain(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len(h.split(".")) if h else 0, len(p), v == "block", h + p, v) for h, p, v in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[3] if best else None, best[4] if best else default)


def run(spark, urls, rules, **more):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = ut.judge(df, spark.createDataFrame(rules, RULE), **more)
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(out.collect(), key=lambda r: r.page_id)]


label = st.sampled_from(["a", "b", "www", "com", "A", ""])
paths = st.lists(st.sampled_from(["", "en", "e", "fr", "x.y"]), max_size=3).map(lambda s: "".join("/" + x for x in s))
hosts = st.lists(label, max_size=3).map(".".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(hosts.map(str.lower), paths, st.sampled_from(["allow", "block"])), max_size=8,
                unique_by=lambda r: r[:2]),
       st.lists(st.tuples(hosts, paths), min_size=1, max_size=6))
def test_trie_against_every_rule(rules, urls):
    trie = ut.Trie(iter(rules))
    for h, p in urls:
        url = f"http://{h}{p}?q=/x"
        got = trie.best(*split(url))
        assert (got[2:] if got else (None, "allow")) == plain(url, rules)[2:]


URLS = ["http://www.example.com/en/1", "https://Example.COM/en/", "http://example.com/en", "http://example.com",
        "ftp://a.b.net/fr/x?y#z", "http://net/es/", "http://xnet/es/", "http://a.org/", "no scheme", "", None,
        "://com/x", "http://com?/en/", "a://b://c.com/", "http://com/\nline", "http://example.com:80/en/",
        "http://example.com./en/", "http://u@example.com/en/x", "x" * 50_000 + "://net/fr/" + "y" * 50_000,
        "http://" + "s." * 3000 + "example.com/en/" + "/" * 3000, "http://ÄB.com/É?", "http://com//", "://", "://?"]


def test_contract_rules_and_odd_urls(spark):
    assert run(spark, URLS, ut.RULE_ROWS) == [plain(u, ut.RULE_ROWS) for u in URLS]
    assert run(spark, URLS, ut.RULE_ROWS, default="block") == [plain(u, ut.RULE_ROWS, "block") for u in URLS]


def test_result_does_not_depend_on_the_pieces(spark, monkeypatch):
    rnd = random.Random(5)
    rules = {(".".join(rnd.choices(["a", "b", "com", "net"], k=rnd.randint(0, 3))),
              "".join(rnd.choices(["/", "/en", "/f"], k=rnd.randint(0, 3)))): rnd.choice(["allow", "block"]) for _ in range(60)}
    rules = [(*k, v) for k, v in rules.items()]
    urls = ["http://" + ".".join(rnd.choices(["a", "b", "com", "net", "x"], k=rnd.randint(1, 4)))
            + "".join(rnd.choices(["/", "/en", "/fr"], k=rnd.randint(0, 4))) for _ in range(200)]
    whole = run(spark, urls, rules)
    assert whole == [plain(u, rules) for u in urls]
    monkeypatch.setattr(ut, "PIECE_RULES", 20)
    assert run(spark, urls, rules) == whole
    monkeypatch.setattr(ut, "PIECE_RULES", 100_000)
    monkeypatch.setattr(ut, "PIECE_CHARS", 150)
    assert run(spark, urls, rules) == whole


def test_rules_repeat_clash_and_fail(spark):
    both = [("a.com", "/", "allow"), ("A.com", "/", "block"), ("a.com", "/", "allow"), (None, None, "allow")]
    assert run(spark, ["http://a.com/x", "http://b.org"], both) == [
        ("a.com", "/x", "a.com/", "block"), ("b.org", "", "", "allow")]
    assert run(spark, ["http://a.com/x"], []) == [("a.com", "/x", None, "allow")]
    with pytest.raises(ValueError):
        run(spark, ["http://a.com/x"], [("a.com", "/", "drop")])


def test_tables_with_clashing_columns_nulls_and_repeats(spark):
    rows = [(1, "http://net/fr/", "r", "v", 2, "w")] * 2 + [(None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string, best int, _row string")
    rules = spark.createDataFrame(ut.RULE_ROWS, RULE)
    out = ut.judge(df, rules)
    assert out.columns == ["page_id", "url", "best", "_row", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, "http://net/fr/", 2, "w", "net", "/fr/", "net/fr/", "block")] * 2
        + [(None, None, None, None, "", "", None, "allow")], key=repr)
    kept = ut.keep(df, rules)
    assert kept.columns == df.columns and kept.count() == 1
    assert ut.judge(df.where("false"), rules).count() == 0
