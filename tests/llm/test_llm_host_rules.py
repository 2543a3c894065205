import re
import sys
from collections import Counter
from pathlib import Path

import comparing

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCS, PROSE, awkward, rows_of  # noqa: E402

from tillhouse.llm import host_rules, queries  # noqa: E402
from tillhouse.llm.oracles import ORACLES  # noqa: E402


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_figures_against_brute_force(spark):
    texts = [
        "a a a a", "a b c a b c", "a b c", "a b", "", None, "x\nx\n\n \nx\ny", "a b a b a b a c",
        "a\tb\rc\x0bd\x0ce", "# ** <tag> 50% a|b & c$", "é😀 ü", "a b c d a b c d e a b c",
        "\n\n a \n a\n", PROSE * 4, "one\x00two three\x00 four", "z " * 5000,
    ]
    docs = spark.createDataFrame(
        [(i, t, "h") for i, t in enumerate(texts)], "doc_id bigint, text string, source string"
    )
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    expected = sorted([(i, *brute(t)) for i, t in enumerate(texts)], key=repr)
    assert rows_of(host_rules.measured(docs), *columns) == expected


def test_query_equals_sql(spark):
    tables = comparing.open_tables("/root/testdata/sf0.001")
    found = queries.op3_host_rules(spark, "/root/testdata/sf0.001")
    assert comparing.differences(found, tables, ORACLES["op3_host_rules"]) == []


def test_bad_host_goes_and_small_host_is_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(80))
    junk = good + " ### *** &&& $$$"
    rows = [(i, junk, "junk") for i in range(60)] + [(100 + i, good, "good") for i in range(300)]
    rows += [(500, junk, "small"), (501, good, "junk"), (502, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.judged(docs).collect()}
    assert not any(kept[i] for i in range(60)) and all(kept[100 + i] for i in range(300))
    assert not kept[501] and kept[502]


def test_bound_follows_the_spread_of_hosts(spark):
    good = " ".join(f"word{i}" for i in range(80))
    junk = good + " ### *** &&& $$$"
    rows = [(i, junk if i % 50 == 0 else good, f"h{i % 20}") for i in range(4000)]
    rows += [(5000 + i, junk if i % 3 == 0 else good, "bad") for i in range(200)]
    rows += [(6000 + i, junk if i < 1 else good, "few") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.judged(docs).collect()}
    assert not any(kept[5000 + i] for i in range(200))
    assert all(kept[i] for i in range(4000)) and kept[6000] and kept[6001]


def test_prior_is_between_the_extremes():
    mean, strength = host_rules.prior(3, 300, 30_000.0, 90, 90.0**2 / 100)
    assert abs(mean - 0.3) < 1e-9 and strength >= 1
    assert host_rules.prior(0, 0, 0.0, 0, 0.0) == (0.0, 1.0)
    assert host_rules.prior(1, 10, 100.0, 5, 2.5)[1] > 100


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = host_rules.judged(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (2, 3, 5, 6, 7))
    assert host_rules.judged(spark.createDataFrame([], DOCS)).count() == 0


def test_plan_has_no_python(spark):
    docs = awkward(spark)
    plan = host_rules.measured(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
