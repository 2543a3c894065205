import re
import sys
from pathlib import Path

import comparing
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCS, PROSE, awkward, documents, rows_of  # noqa: E402

from tillhouse.llm import phrase_index, queries  # noqa: E402
from tillhouse.llm.oracles import ORACLES  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window, span=None):
    out = []
    for text in texts:
        own, hit, named = words(text), set(), set()
        for item, content in items:
            terms = words(content)
            for at in range(max(len(terms) - window + 1, min(len(terms), 1))):
                phrase = terms[at : at + window]
                for i in range(len(own)):
                    if span is None:
                        if own[i : i + len(phrase)] == phrase:
                            hit |= set(range(i, i + len(phrase)))
                            named.add(item)
                    elif own[i] in phrase and set(phrase) <= set(own[i : i + span]):
                        hit |= set(range(i, min(i + span, len(own))))
                        named.add(item)
        out.append((len(own), sorted(hit), sorted(named)))
    return out


def flat(df):
    out = {}
    for r in df.collect():
        hit = sorted({i for run in r.runs for i in range(run.first, run.last + 1)})
        out[r.doc_id] = (r.n_words, hit, list(r.items))
    return out


ITEMS = [
    ("1", "alpha beta gamma"), ("2", "beta gamma delta alpha beta"), ("3", "Alpha"), ("4", "..."),
    ("5", "gamma gamma gamma"), ("10", "delta ALPHA beta gamma"),
]
TEXTS = [
    "alpha beta gamma delta alpha beta gamma", "gamma gamma gamma gamma", "", None, "Alpha-beta",
    "x alpha y beta z gamma", "beta\ngamma", "beta gamma delta delta alpha beta",
]


@pytest.mark.parametrize(
    "span, segment_bytes, block_bytes", [(None, 30, 250), (None, 10**6, 10**6), (5, 30, 250)]
)
def test_against_brute_force(spark, span, segment_bytes, block_bytes):
    docs = documents(spark, list(enumerate(TEXTS)))
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    index = phrase_index.build_index(docs, segment_bytes=segment_bytes)
    found = phrase_index.find_items(index, items, window=3, span=span, block_bytes=block_bytes)
    assert flat(found) == dict((str(i), x) for i, x in enumerate(brute(TEXTS, ITEMS, 3, span)))


def test_query_equals_sql(spark):
    tables = comparing.open_tables("/root/testdata/sf0.001")
    found = queries.op2_decontamination(spark, "/root/testdata/sf0.001")
    assert comparing.differences(found, tables, ORACLES["op2_decontamination"]) == []
    assert found.where("contaminated").count() > 0


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    items = spark.createDataFrame(
        [(1, PROSE), (1, PROSE), (2, None), (None, PROSE), (3, ""), (4, "word")],
        "item_id bigint, text string",
    )
    found = phrase_index.find_items(phrase_index.build_index(docs), items)
    assert found.count() == docs.count()
    named = rows_of(found.where("size(items) > 0"), "doc_id", "items")
    assert named == sorted([("1", ["1"]), ("1", ["1"]), (None, ["1"]), ("7", ["4"])], key=repr)
    kept = phrase_index.decontaminated(docs, items)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [2, 3, 4, 5, 6, 6, 8]
    empty = phrase_index.build_index(spark.createDataFrame([], DOCS))
    assert phrase_index.find_items(empty, items).count() == 0
    none = phrase_index.find_items(phrase_index.build_index(docs), items.limit(0))
    assert none.where("size(items) > 0").count() == 0 and none.count() == docs.count()


def test_large_ids_beside_null_ones_stay_exact(spark):
    big = 2**53 + 1
    docs = documents(spark, [(big, PROSE), (None, "some other words"), (7, "and these")]).coalesce(1)
    items = spark.createDataFrame([("a", PROSE)], "item_id string, text string")
    found = phrase_index.find_items(phrase_index.build_index(docs), items)
    assert rows_of(found.where("size(items) > 0"), "doc_id") == [(str(big),)]
    assert sorted(str(r.doc_id) for r in phrase_index.decontaminated(docs, items).collect()) == ["7", "None"]
    named = docs.selectExpr("concat('doc-', doc_id) as doc_id", "text")
    assert rows_of(phrase_index.decontaminated(named, items), "doc_id") == [("doc-7",), (None,)]
