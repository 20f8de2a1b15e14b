from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import LONG, odd_documents

from gradewell.llm import token_counts as tc

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(str(public_tokenizers.path(NAME)))


def counted(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


PIECES = [*"aeinrstlmdvre'' ''  \t\n!!..01 9éüñ中文字😀 \xa0ABthe<|>", "<|endoftext|>", "'ll", "'re", "'s", "'LL", " 'd", "   ",
          "\U0001e5d0", "\u1c89", "the", "ing", " of", "\r\n", "aaaa", "====", "'rx", "'l", "'r", "\x1c", "\u2028"]


def test_same_counts_as_the_library(library):
    draw = random.Random(5)
    texts = ["", " ", "'", "'r", "<|endoftext|>", " " * 1000, "a" * 5001, "=" * 777, "ab" * 4000, LONG]
    texts += ["".join(draw.choices(PIECES, k=draw.randint(1, 60))) for _ in range(4000)]
    assert tc.counter(NAME).count(texts).tolist() == counted(library, texts)


def test_tables_are_dropped_and_made_again(library, monkeypatch):
    monkeypatch.setattr(tc, "MAX_STATES", 50)
    monkeypatch.setattr(tc, "BATCH_CHARS", 200)
    monkeypatch.setattr(tc, "LONG_PIECE", 4)
    draw = random.Random(6)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(1, 40))) for _ in range(300)]
    assert tc.Counter(str(public_tokenizers.path(NAME))).count(texts).tolist() == counted(library, texts)


def test_scan_composes_state_maps():
    draw = np.random.default_rng(2)
    maps = draw.integers(0, tc.STATES, (37, tc.STATES)).astype(np.uint8)
    state, expected = np.arange(tc.STATES), []
    for one in maps:
        state = one[state]
        expected.append(state)
    assert (tc.prefix_scan(maps) == np.array(expected)).all()


def test_odd_documents(spark, library):
    found = tc.count_tokens(odd_documents(spark), NAME, 512).collect()
    for row in found:
        text = row.text or ""
        assert row.n_bytes == len(text.encode())
        assert row.n_tokens == counted(library, [text])[0]
        assert row.over_limit == (row.n_tokens > 512)
        assert row["a.b"] == 14
    assert len(found) == 10
    assert tc.count_tokens(odd_documents(spark).limit(0), NAME, 512).count() == 0


def test_whole_small_table(spark, small_folder, library):
    from gradewell.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_folder}/documents.parquet").collect()}
    found = {r.doc_id: r.n_tokens for r in QUERIES["op2_token_counts"](spark, small_folder).collect()}
    assert found == dict(zip(texts, counted(library, [t or "" for t in texts.values()])))
