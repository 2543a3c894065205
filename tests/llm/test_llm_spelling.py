"""Spelling variants against brute force, and awkward rows."""

import re
import zlib
from collections import Counter

import pytest
from llm_cases import DOCS, awkward, documents, rows_of

from tillhouse.llm import queries, spelling


def apart(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, least_length=6, least_count=5, times=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            at = digest % len(low)
            counts[low if digest % 199 else low[:at] + low[at + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [x for x in words if apart(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= times * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def found(docs, **options):
    result = spelling.grouped(docs, **options)
    return {tuple(r) for r in result.select("word", "n", "n_near", "form", "form_n", "root").collect()}


CHAINS = (
    ["letter"] * 700 + ["lettter"] * 130 + ["leter"] * 9 + ["lettttter"] * 5 + ["letttter"] * 25
    + ["aaaaaa"] * 6 + ["aaaaaaa"] * 40 + ["aaaaab"] * 5 + ["baaaaa"] * 5 + ["étérés"] * 7
    + ["Étérés"] * 5 + ["ÀLetter"] * 5 + ["fourletters"] * 5 + ["short"] * 99 + ["abcabc"] * 5
    + ["bcabca"] * 5 + ["abcabca"] * 5 + ["xletter"] * 5 + ["letterx"] * 5 + ["lattar"] * 5
)


def test_words_against_brute_force(spark):
    rows = [(i, f"{word}. {word[:2]}") for i, word in enumerate(CHAINS)]
    rows += [(None, "letter LETTER"), (7, None), (8, "")]
    assert found(documents(spark, rows).select("doc_id", "text")) == brute(rows)


@pytest.mark.parametrize("least_length", [1, 2])
def test_short_alphabet_against_brute_force(spark, least_length, monkeypatch):
    monkeypatch.setattr(spelling, "LEAST_LENGTH", 1)
    words = ["".join("abé"[(n // 3**k) % 3] for k in range(size)) for size in range(1, 6) for n in range(3**size)]
    rows = [(1, " ".join(words)), (2, " ".join(words[::7] * 6))]
    options = {"least_length": least_length, "least_count": 1}
    assert found(documents(spark, rows).select("doc_id", "text"), **options) == brute(rows, **options)


def test_long_words_take_few_rounds(spark, monkeypatch):
    long = "ab" * 900
    rows = [(1, " ".join([long] * 40 + [long[:700] + "x" + long[700:]] * 6 + [long[1:]] * 5 + ["a" * 3000] * 5))]
    rounds = []
    advance = spelling.advanced
    monkeypatch.setattr(spelling, "advanced", lambda *a: rounds.append(1) or advance(*a))
    assert found(documents(spark, rows).select("doc_id", "text")) == brute(rows)
    assert len(rounds) < 8


def test_awkward_rows_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert found(awkward(spark)) == brute(rows)
    assert found(spark.createDataFrame([], DOCS)) == set()


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = queries.documents(spark, folder)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    query = queries.op13_spelling(spark, folder)
    assert set(rows_of(query, "word", "n", "n_near", "form", "form_n", "root")) == brute(rows)
