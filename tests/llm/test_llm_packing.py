import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from llm_cases import DOCS, awkward, documents  # noqa: E402

from tillhouse.llm import packing, queries  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(PATH)


TEXTS = [
    "", "don't 'tis they're we've I'LL x'd '' 's a''s *'s ", "a'", "strange", "B'Re 'RESULT",
    "Straße İstanbul ñandú Ⱥx ɐɿ ǅ", "日本語 text’s end", "12³ ½ x²y", "a\x00b \x1c c\x1fd",
    "x\u0085y z", "<|endoftext|> plain", "\U0001f600 ok", "é é",
]


def test_tokens_are_those_of_the_tokenizer(tokens):
    random = np.random.default_rng(3)
    noise = ["".join(random.choice(list("ab'strevlm12 .*é\nÀ"), 30)) for _ in range(1500)]
    texts = TEXTS + noise
    ids, counts = tokens.of(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == tokens.plain(text).tolist(), repr(text)


def test_forgotten_words_are_learned_again(tokens, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    small = packing.Tokens(PATH)
    texts = pa.array(["one two three four", "five six seven one", "two eight nine ten one"])
    for _ in range(2):
        assert small.of(texts)[0].tolist() == tokens.of(texts)[0].tolist()


def test_combinations_fill_the_window():
    found = packing.combinations(12, 3)
    assert (found.sum(axis=1) == 12).all()
    expected = {(a, b, 12 - a - b) for a in range(1, 13) for b in range(a, 13) if 12 - a - b >= b}
    expected |= {(a, 12 - a, 0) for a in range(1, 7)} | {(12, 0, 0)}
    assert set(map(tuple, found.tolist())) == expected


def test_least_squares_is_nonnegative_and_meets_what_can_be_met():
    found = packing.combinations(8, 3)
    exact = np.zeros(len(found))
    exact[[0, 3, 5]] = (40, 7, 19)
    target = np.zeros(9)
    for row, times in zip(found, exact, strict=True):
        for size in row[row > 0]:
            target[size] += times
    solved = packing.nonnegative_least_squares(found, target, 8, rounds=3000)
    uses = np.zeros(9)
    for row, times in zip(found, solved, strict=True):
        for size in row[row > 0]:
            uses[size] += times
    assert (solved >= 0).all() and np.allclose(uses, target, atol=0.05)


def test_plan_uses_every_piece_once():
    random = np.random.default_rng(1)
    for _ in range(20):
        histogram = random.integers(0, 50, 33) * (random.random(33) < 0.5)
        histogram[0] = 0
        chosen = packing.plan(histogram)
        used = np.zeros(33, int)
        for sizes, count in zip(chosen.lengths, chosen.repeats, strict=True):
            assert sizes.sum() <= 32
            for size in sizes[sizes > 0]:
                used[size] += count
        assert used.tolist() == histogram.tolist()


def check(rows, texts, tokens):
    """Pieces cover each document once; sequences are gapless and within the window."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    for doc_id, text in texts.items():
        ids = np.append(tokens.plain(text or ""), packing.END_ID).astype("<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(sequences)


def test_query_packs_the_whole_table(spark, tokens):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op1_packing(spark, folder).collect()
    number = check(rows, texts, tokens)
    total = sum(r.length for r in rows)
    assert number * packing.WINDOW < 1.05 * total + 2 * packing.WINDOW


def test_round_trip_of_sequences(spark, tokens):
    texts = {i: " ".join(f"w{i} and {j}" for j in range(i * 90)) for i in range(25)}
    cut = packing.pieces(documents(spark, list(texts.items())), PATH)
    layout = packing.packed(cut)
    check(layout.collect(), texts, tokens)
    rebuilt = defaultdict(dict)
    starts = {(r.sequence_id, r.offset): (r.doc_id, r.start, r.length) for r in layout.collect()}
    for r in packing.sequences(cut, layout).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) <= packing.WINDOW
        for offset in r.offsets:
            doc_id, start, length = starts[r.sequence_id, offset]
            rebuilt[doc_id][start] = ids[offset : offset + length]
    for doc_id, text in texts.items():
        whole = np.concatenate([rebuilt[doc_id][s] for s in sorted(rebuilt[doc_id])])
        assert whole.tolist() == [*tokens.plain(text).tolist(), packing.END_ID]


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = packing.packed(packing.pieces(docs, PATH)).collect()
    firsts = [r for r in rows if r.start == 0]
    assert len(firsts) == docs.count()
    assert sum(r.doc_id is None for r in firsts) == 1
    assert {r.doc_tokens for r in firsts if r.doc_id in (2, 3, 5)} == {1}
    assert packing.packed(packing.pieces(spark.createDataFrame([], DOCS), PATH)).count() == 0


def test_ranks_hold_when_pieces_are_dealt(spark, tokens, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", 7)
    texts = {i: "same text" if i % 3 else f"text {i} " * (i % 11) for i in range(120)}
    rows = packing.packed(packing.pieces(documents(spark, list(texts.items())), PATH)).collect()
    check(rows, texts, tokens)
