from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import LONG, odd_documents

from gradewell.llm import packing as p

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(str(public_tokenizers.path(NAME)))


PIECES = [*"aeinrstlÀß÷×µªº²'sdmv ''  \t\n!!..01 9éüñ中文字😀 \xa0ABthe<|>Σς", "<|endoftext|>", "<|startoftext|>", "'ll", "'re", " 'd", "́", "̸", "=", "　",
          "\r\n", "\x1c", "\x85", " ", "İ", "ﬁ", "가", "word", " the ", "\x7f", "\x1d ", "\x1f", "\xad", "\u2028", "\u180e"]


def test_words_are_encoded_as_the_library_does(library):
    draw = random.Random(8)
    texts = ["", " ", "\n\n", "̸ ́a", LONG, "x" * 5000, "ΑΣ ΑΣ.", "<|endoftext|> x<|endoftext|>y"]
    texts += ["".join(draw.choices(PIECES, k=draw.randint(1, 60))) for _ in range(4000)]
    encode = p.Encoder(NAME, None)
    for text, ids in zip(texts, encode.ids(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def checked(rows, documents, largest=p.LARGEST):
    """Pieces cover every document once and windows without a gap; returns the lengths of the windows."""
    for key, ids in documents.items():
        mine = sorted((r for r in rows if r["key"] == key), key=lambda r: r["start"])
        at = 0
        for r in mine:
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    windows = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == windows.get(r["sequence_id"], 0)
        windows[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(windows.values(), default=0) <= largest
    return windows


def packed_rows(documents, **sizes):
    packer = p.Packer(3, **sizes)
    rows = [r for key, ids in documents.items() for r in packer.add(key, np.array(ids, np.uint32))]
    rows += packer.finish()
    return packer, [dict(zip(p.COLUMNS, r)) for r in rows]


def test_windows_are_full():
    draw = random.Random(4)
    for case in range(60):
        most = draw.choice([3, 20, 70, 400])
        documents = {k: [draw.randrange(49_408) for _ in range(draw.randint(1, most))] for k in range(draw.randint(0, 300))}
        packer, rows = packed_rows(documents, smallest=4, largest=64, stock=draw.choice([1, 3, 8]))
        remains = [r for r in rows if r["sequence_id"] is None]
        assert sum(r["length"] for r in remains) < 4
        for r in remains:
            r["sequence_id"] = -1
            r["offset"] = sum(q["length"] for q in remains[: remains.index(r)])
        windows = checked(rows, documents, 64)
        windows.pop(-1, None)
        tiers = {r["sequence_id"]: r["tier"] for r in rows}
        assert all(size == tiers[s] and size & size - 1 == 0 for s, size in windows.items())


def test_stocks_are_bounded():
    packer = p.Packer(0)
    draw = random.Random(1)
    for k in range(5000):
        list(packer.add(k, np.zeros(draw.choice([1, 30, 300, 3000, 9000]), np.uint32)))
        assert all(t.tokens < p.STOCK * t.size and t.tokens == sum(map(len, t.pieces)) for t in packer.tiers)
        assert len(packer.steps.groups) <= 2 * p.OPEN


def test_short_documents_stay_whole_and_in_short_windows():
    documents = {k: [1] * 100 for k in range(2000)} | {-k: [1] * 3000 for k in range(1, 20)}
    _, rows = packed_rows(documents)
    cut = {r["key"] for r in rows if r["key"] >= 0 and r["length"] < 100}
    assert len(cut) < 500  # 100 and 128 do not divide one another
    assert {r["tier"] for r in rows} >= {128, 4096}
    long = [r for r in rows if r["key"] < 0 and r["length"] == 3000]
    assert len(long) >= 12 and {r["tier"] for r in long} == {4096}


def test_step_groups_are_balanced():
    draw = random.Random(2)
    documents = {k: np.ones(int(draw.lognormvariate(5.5, 1.2) + 1), np.uint32) for k in range(20_000)}
    _, rows = packed_rows(documents)
    size, alone = {}, p.Packer(0)
    alone.steps.most = 1
    in_a_row = {}
    for s, t, g in sorted({(r["sequence_id"], r["tier"], r["step_group"]) for r in rows if r["sequence_id"] is not None}):
        size.setdefault(g, []).append(t)
        in_a_row.setdefault(alone.steps.place(t), []).append(t)
    full = [t for t in size.values() if sum(t) == p.STEP]
    assert max(map(sum, size.values())) == p.STEP and len(full) >= 0.9 * len(size)
    assert len(full) > 1.3 * sum(sum(t) == p.STEP for t in in_a_row.values())
    work = [sum(t * t for t in g) for g in full]
    assert np.std(work) < 0.15 * np.mean(work)


def test_odd_documents(spark, library):
    docs = odd_documents(spark)
    whole = {}
    for key, text in docs.select("doc_id", "text").collect():
        whole.setdefault(key, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    rows = [r.asDict() | {"key": r.doc_id} for r in p.pack(docs, NAME, 2).collect()]
    checked(rows, {k: v[0] for k, v in whole.items() if len(v) == 1})
    for key, several in whole.items():  # repeated keys: the same pieces in all
        assert sum(r["length"] for r in rows if r["key"] == key) == sum(map(len, several))
    assert p.pack(docs.limit(0), NAME, 2).count() == 0


def test_whole_small_table(spark, small_folder, library):
    from gradewell.llm.queries import QUERIES

    texts = spark.read.parquet(f"{small_folder}/documents.parquet").select("doc_id", "text").collect()
    rows = [r.asDict() | {"key": r.doc_id} for r in QUERIES["op13_packing"](spark, small_folder).collect()]
    windows = checked(rows, {k: [*library.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts})
    padding = sum(p.LARGEST - s for s in windows.values() if s & s - 1)
    assert padding <= p.LARGEST


def test_remains_of_many_tasks_share_a_window(spark):
    docs = spark.createDataFrame([(k, "a few words of text") for k in range(300)], "doc_id bigint, text string").repartition(150)
    rows = [r.asDict() | {"key": r.doc_id} for r in p.pack(docs, NAME, 2).collect()]
    windows = checked(rows, {})
    padded = [s for s in windows.values() if s & s - 1]
    assert len(padded) <= -(-150 // p.JOINED) and sum(windows.values()) == 300 * 6
