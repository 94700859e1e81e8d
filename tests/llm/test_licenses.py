"""op4: against comparing every line with every template, and the anchors'
promise; runs of lines against every run. The query's SQL is compared in
test_tables."""

import random
import re

from tallyflow.llm import licenses as li
from odd_rows import no_docs, odd_docs  # noqa: F401


def _grams(text):
    w = re.sub("[^a-z0-9]+", " ", text.translate(str.maketrans(li.UPPER, li.LOWER))).split()
    return set(zip(w, w[1:]))


def brute(rows, least):
    out = {}
    for i, text in rows:
        for unit in [] if text is None else [*text.split("\n"), text]:
            a = _grams(unit)
            for lic, ts in li.TEMPLATES.items():
                for b in map(_grams, ts):
                    d = 2 * len(a & b) / (len(a) + len(b)) if a else 0
                    if d >= least:
                        best, units = out.setdefault((i, lic), [0.0, set()])
                        units.add(" ".join(re.sub("[^a-z0-9]+", " ", unit.translate(
                            str.maketrans(li.UPPER, li.LOWER))).split()))
                        out[i, lic] = [max(best, d), units]
    return sorted(((i, lic, round(d, 9), len(u)) for (i, lic), (d, u) in out.items()), key=repr)


def corpus():
    rnd = random.Random(1)
    rows = []
    for k in range(120):
        t = rnd.choice([x for ts in li.TEMPLATES.values() for x in ts]).split()
        for _ in range(rnd.randint(0, 4)):
            j = rnd.randrange(len(t))
            t[j:j + 1] = rnd.choice([[], ["word"], [t[j].upper(), "extra"], [t[j]]])
        rows.append((k, rnd.choice(["{}", "Some text.\n{}\nMore text.", "{}\n{}"]).replace("{}", " ".join(t))))
    return rows + [(500, None), (501, ""), (502, "license"), (None, "MIT License."), (None, "All rights reserved.")]


def _scan(df, least=li.LEAST):
    return sorted(((r.doc_id, r.license, round(r.dice, 9), r.units) for r in li.scan(df, least).collect()), key=repr)


def test_scan_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (0.8, 0.6):
        assert _scan(df, least) == brute(rows, least)


def test_repeats_clashes_and_no_rows(spark, odd_docs, no_docs):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License.")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, license string, a int, unit string")
    assert _scan(df) == [(1, "MIT", 1.0, 1)]
    assert _scan(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()], li.LEAST)
    assert li.scan(no_docs).count() == 0


def test_anchors_touch_all_that_can_reach():
    for least in (0.6, 0.8, 0.95):
        words = li.anchors(li.TEMPLATES, least)
        for ts in li.TEMPLATES.values():
            for b in map(_grams, ts):
                left = {g for g in b if not set(g) & set(words)}
                assert 2 * len(left) / (len(left) + len(b)) < least


def brute_runs(rows, least, templates):
    out = {}
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        for s in range(len(lines)):
            for e in range(s, len(lines)):
                a = _grams("\n".join(lines[s:e + 1]))
                for lic, ts in templates.items():
                    for b in map(_grams, ts):
                        d = 2 * len(a & b) / (len(a) + len(b)) if a else 0
                        if d >= least:
                            run = (round(d, 9), s - e, -s)
                            out[i, lic] = max(out.get((i, lic), run), run)
    return sorted(((i, lic, d, 1 - s, 1 - s - n) for (i, lic), (d, n, s) in out.items()), key=repr)


def _runs(df, least=li.LEAST, templates=None):
    return sorted(((r.doc_id, r.license, round(r.dice, 9), r.first_line, r.last_line)
                   for r in li.scan_runs(df, least, templates).collect()), key=repr)


def test_runs_against_brute_force(spark):
    rnd = random.Random(2)
    rows = corpus()
    for k in range(60):     # the words over several lines with comment marks, amid other and repeated lines
        w = rows[k][1].split()
        cut = sorted(rnd.sample(range(len(w)), min(len(w) - 1, 4)))
        lines = [" ".join(w[a:b]) for a, b in zip([0, *cut], [*cut, len(w)])]
        lines = rnd.choice([["x = 1"], []]) + lines + rnd.choice([["", "the end of the"], lines, []])
        rows.append((1000 + k, "\n".join("# " + x for x in lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (0.8, 0.6):
        assert _runs(df, least, li.TEMPLATES) == brute_runs(rows, least, li.TEMPLATES)


def test_runs_across_gaps_long_lines_and_repeats(spark):
    """Lines that a run may or may not reach across: few or many other bigrams,
    long lines, repeated lines, bigrams that go from one line to the next."""
    rnd = random.Random(5)
    templates = {"A": ("one two three four five six seven eight nine ten",), "B": ("red green blue red black", "two three red green")}
    vocabulary = sorted({w for ts in templates.values() for t in ts for w in t.split()})
    rows = []
    for k in range(300):
        lines = []
        for _ in range(rnd.randint(1, 7)):
            t = rnd.choice([t for ts in templates.values() for t in ts]).split()
            a = rnd.randrange(len(t))
            lines.append(" ".join(t[a:a + rnd.randint(1, 6)]))
            kind = rnd.random()
            if kind < 0.3:
                lines.append(" ".join(rnd.choice(["x", "y", "z", *vocabulary]) for _ in range(rnd.choice([1, 2, 3, 9, 30]))))
            elif kind < 0.5:
                lines += [lines[-1]] * rnd.randint(1, 3)
            elif kind < 0.6:
                lines += ["", "--"]
        rows.append((k, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (0.8, 0.5):
        want = brute_runs(rows, least, templates)
        assert len(want) > 20
        assert _runs(df, least, templates) == want


def test_a_long_text_is_cut_where_no_run_goes_across(spark):
    notice = "Released under the MIT License."
    words = " ".join(f"w{k}" for k in range(40))
    text = "\n".join([notice, words] * 2000 + [notice] * 2000 + [" ".join(f"v{k}" for k in range(100_000))])
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert _runs(df, templates=li.TEMPLATES) == [(1, "MIT", 1.0, 1, 1)]


def test_wrapped_licences_are_found(spark):
    full = li.full_templates()
    mit = full["MIT"][-1]
    header = next(t for t in full["Apache-2.0"] if "limitations under" in t and len(t) < 1000)
    source = "".join(f" * {x}\n" for x in header.strip().split("\n"))
    rows = [(1, "MIT License\n\nCopyright (c) 2024 Some One\n\n" + mit),
            (2, "/*\n" + source + " */\npackage a.b;\n" + "int x = 1;\nvoid run() { go(x); }\n" * 50),
            (3, "Notices of others\n" + "one more line of text\n" * 30 + full["GPL-3.0"][-1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license): r for r in li.scan_runs(df).collect()}
    assert {(1, "MIT"), (2, "Apache-2.0"), (3, "GPL-3.0")} <= set(got)
    assert got[1, "MIT"].dice == got[2, "Apache-2.0"].dice == got[3, "GPL-3.0"].dice == 1.0
    assert got[2, "Apache-2.0"].first_line == 2 and got[3, "GPL-3.0"].first_line >= 31
    assert (1, "MIT") not in {(r.doc_id, r.license) for r in li.scan(df).collect()}


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    assert _runs(odd_docs, templates=li.TEMPLATES) == brute_runs(
        [(r.doc_id, r.text) for r in odd_docs.collect()], li.LEAST, li.TEMPLATES)
    assert li.scan_runs(no_docs).count() == 0
