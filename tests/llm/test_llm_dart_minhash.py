import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCS, PROSE, awkward, documents  # noqa: E402

from tillhouse.llm import dart_minhash, queries  # noqa: E402
from tillhouse.llm.batches import words_of  # noqa: E402


def weights(text):
    words = words_of(pa.array([text]))
    terms = [words.terms[c].as_py() for c in words.codes.tolist()]
    if len(terms) < 5:
        return Counter([tuple(terms)] if terms else [])
    return Counter(tuple(terms[i : i + 5]) for i in range(len(terms) - 4))


def similarity(a, b):
    both = sum((a & b).values())
    either = sum((a | b).values())
    return both / either if either else 0.0


def classes(texts, least=0.8):
    """Connected components of all pairs, by brute force."""
    sets = [weights(t or "") for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            alike = similarity(sets[i], sets[j]) >= least if sets[i] else texts[i] == texts[j]
            if alike:
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def changed(words, share, dice):
    return [dice.choice("abcdefghij") * 5 if dice.random() < share else w for w in words]


def test_shared_coordinates_estimate_the_weighted_similarity():
    dice = random.Random(4)
    base = [f"w{dice.randrange(400)}" for _ in range(500)]
    texts = [" ".join(base)] + [" ".join(changed(base, p, dice)) for p in (0.01, 0.03, 0.1)]
    texts += [" ".join(["x"] * 300), " ".join(["x"] * 400 + base[:50])]
    owner, element, times, _ = dart_minhash.shingles_of(pa.array(texts))
    kept = dart_minhash.signatures(owner, element, times, len(texts), 3000)
    assert np.all(kept != 0)
    for i in range(len(texts)):
        for j in range(i):
            exact = similarity(weights(texts[i]), weights(texts[j]))
            assert abs((kept[i] == kept[j]).mean() - exact) < 0.05


def test_signature_does_not_depend_on_neighbours_in_the_batch():
    texts = [PROSE * k for k in (1, 2, 7)] + ["one", "", "two words"]
    together = dart_minhash.shingles_of(pa.array(texts))
    all_kept = dart_minhash.signatures(*together[:3], len(texts))
    for i, text in enumerate(texts):
        alone = dart_minhash.shingles_of(pa.array([text]))
        assert (dart_minhash.signatures(*alone[:3], 1)[0] == all_kept[i]).all()


@pytest.mark.parametrize("bucket_rows", [3, 1000])
def test_classes_against_all_pairs(spark, bucket_rows):
    dice = random.Random(7)
    texts = []
    for group in range(12):
        base = [f"g{group}w{dice.randrange(300)}" for _ in range(dice.choice([6, 40, 300]))]
        texts.append(" ".join(base))
        for _ in range(dice.randrange(6)):
            texts.append(" ".join(changed(base, dice.choice([0, 0.004, 0.01, 0.2]), dice)))
    boiler = " ".join(f"terms{i}" for i in range(150))
    texts += [boiler + " " + " ".join(f"own{k}n{i}" for i in range(100)) for k in range(40)]
    texts += ["", "", None, "!!", "!!", "?!", "Same Words", "same, words!", "a b", "b a"]
    docs = documents(spark, list(enumerate(texts)))
    rows = dart_minhash.near_duplicates(docs, bucket_rows=bucket_rows).collect()
    found = {r.doc_id: r.class_id for r in rows}
    expected = classes([t or "" for t in texts])
    assert [found[i] for i in range(len(texts))] == expected


def copies_of_one(number, seed=11):
    """A text of 150 words and copies with three words replaced, each about 0.8 like the
    text and 0.66 like each other, and the same of a text that is not there itself."""
    dice = random.Random(seed)
    texts = []
    for name in "ab":
        base = [f"{name}{i}" for i in range(150)]
        for k in range(number):
            copy = list(base)
            for place in dice.sample(range(150), 3):
                copy[place] = f"new{name}{k}n{place}"
            texts.append(" ".join(copy))
        if name == "a":
            texts.append(" ".join(base))
    dice.shuffle(texts)
    return texts


def test_copies_like_their_original_only_stay_together(spark):
    texts = copies_of_one(200)
    rows = dart_minhash.near_duplicates(documents(spark, list(enumerate(texts)))).collect()
    found = {r.doc_id: r.class_id for r in rows}
    expected = classes(texts)
    assert max(Counter(expected).values()) > 150
    assert [found[i] for i in range(len(texts))] == expected


def test_chains_become_one_class(spark):
    links = spark.createDataFrame(
        [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(bytes([90]), bytes([80]))],
        "center binary, node binary",
    )
    found = {bytes(r.node): bytes(r.label) for r in dart_minhash.classes_of(links).collect()}
    assert {found[bytes([i])] for i in range(1, 41)} == {bytes([0])}
    assert found[bytes([90])] == bytes([80])


def test_large_buckets_lose_no_copies(spark):
    texts = copies_of_one(60)
    docs = documents(spark, list(enumerate(texts)))
    rows = dart_minhash.near_duplicates(docs, bucket_rows=20).collect()
    found = {r.doc_id: r.class_id for r in rows}
    assert [found[i] for i in range(len(texts))] == classes(texts)


def test_one_document_of_each_class_whatever_the_ids(spark):
    words = [f"w{i}" for i in range(300)]
    near = [" ".join(words), " ".join(["new", *words[1:]])]
    rows = [(7, "one text of its own"), (7, "another text not like it"), (None, near[0]),
            (None, near[1])]
    kept = dart_minhash.deduplicated(documents(spark, rows)).collect()
    assert sorted(r.text for r in kept if r.doc_id == 7) == [rows[1][1], rows[0][1]]
    assert len([r for r in kept if r.doc_id is None]) == 1


def test_query_finds_copies_and_leaves_others(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.op4_near_duplicates(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(texts)
    expected = classes([texts[i] for i in ids])
    assert {r.doc_id: r.class_id for r in rows} == {
        i: ids[c] for i, c in zip(ids, expected, strict=True)
    }


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = dart_minhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: (r.class_id, r.class_size) for r in rows}
    assert by_id[1] == by_id[None] == (1, 3)
    assert by_id[2] == by_id[3] == (2, 2) and by_id[6] == (6, 2) and by_id[5] == (5, 1)
    kept = dart_minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 6, 7, 8]
    assert dart_minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
