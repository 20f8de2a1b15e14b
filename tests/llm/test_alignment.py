from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import pytest
from helpers import LONG, odd_documents

from gradewell.llm import alignment as al
from gradewell.llm import vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(str(public_tokenizers.path(A)))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(B)))


def ends(sizes):
    at, found = 0, []
    for s in sizes:
        at += s
        found.append(at)
    return found


def plain(libraries, text):
    """Ids, byte ends, groups and links of a whole text, from the libraries alone."""
    a, b = libraries
    if not text:
        return None
    coded = a.encode(" " + text, add_special_tokens=False)
    alphabet = vocabulary.byte_alphabet()
    a_bytes = [bytes(alphabet[c] for c in t) for t in coded.tokens]
    pieces = b.encode(text, out_type=str)
    b_bytes = [bytes([int(p[3:-1], 16)]) if p.startswith("<0x") and len(p) == 6 and b.is_byte(b.piece_to_id(p)) else p.replace("▁", " ").encode() for p in pieces]
    data = (" " + text).encode()
    if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return None
    ids_a, ids_b = coded.ids, b.encode(text)
    ends_a, ends_b = ends(map(len, a_bytes)), ends(map(len, b_bytes))
    at_a, at_b = dict(zip(ends_a, ids_a)), dict(zip(ends_b, ids_b))
    both = sorted(at_a.keys() & at_b.keys())
    of_a, of_b = [[] for _ in both], [[] for _ in both]
    for of, at in ((of_a, at_a), (of_b, at_b)):
        for end, token in at.items():
            of[bisect_left(both, end)].append(str(token))
    groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(of_a, of_b)]
    links = [(at_a[e], at_b[e]) for e in both]
    return len(ids_a), len(ids_b), groups, links


PIECES = [*"aeinrstÀß÷×µªº²'sdmv ''  \t\n!!..01 9éüñ中文字😀 \xa0ABthe<|>ﬁ", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "'ll", "    ", "\r\n", "\x1c", "\x00",
          " ", "　", " the", "ing", "==", "▁", "word ", "\x85", "é", "é"]


def test_parts_are_aligned_as_whole_texts(libraries):
    draw = random.Random(12)
    texts = [" ", "  ", "a ", "a  ", " a", "  a  b ", "\n", "a\n b", "a \n", "x" * 4000, LONG[:50_000], "▁", "a▁b", "a <s> b"]
    texts += ["".join(draw.choices(PIECES, k=draw.randint(1, 40))) for _ in range(4000)]
    aligner, lost = al.Aligner(A, B), 0
    assert aligner.cuts
    for text, found in zip(texts, aligner.align(texts), strict=True):
        expected = plain(libraries, text)
        if expected is None:
            lost += 1
            assert found is None, text
            continue
        n_a, n_b, groups, links = expected
        assert found[:4] == (n_a, n_b, len(groups), ";".join(groups)), text
        assert Counter(dict(zip(found[4].tolist(), found[5].tolist()))) == Counter(a << 32 | b for a, b in links)
    assert 0 < lost < len(texts) / 2


def test_alphabet_writes_every_byte():
    assert sorted(vocabulary.byte_alphabet().values()) == list(range(256))


def corpus(libraries, rows):
    """Measures by key and text, counted over all rows one by one."""
    found = {t: plain(libraries, t) for _, t in rows}
    counts = Counter(link for _, t in rows if found[t] for link in found[t][3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    result = []
    for key, text in rows:
        if not found[text]:
            result.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found[text]
        result.append((
            key, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return Counter(result)


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_measures_of_a_corpus(spark, libraries, broadcast):
    draw = random.Random(3)
    rows = [(k, "".join(draw.choices(PIECES, k=draw.randint(0, 30)))) for k in range(200)]
    rows += [(1000 + k, "the same text again") for k in range(300)] + rows[:40] + [(None, "the same text again"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = al.align(docs, A, B, digest_groups=True, broadcast_pairs=broadcast, rows_per_task=50).collect()
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in found) == corpus(libraries, rows)


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_odd_documents(spark, libraries, broadcast):
    docs = odd_documents(spark)
    found = al.align(docs, A, B, broadcast_pairs=broadcast).collect()
    assert len(found) == 10 and {r["a.b"] for r in found} == {14}
    expected = {r.text: plain(libraries, r.text) for r in docs.select("text").collect()}
    for r in found:
        assert r.groups == (";".join(expected[r.text][2]) if expected[r.text] else "")
    assert al.align(docs.limit(0), A, B, broadcast_pairs=broadcast).count() == 0


def test_whole_small_table(spark, small_folder, libraries):
    from gradewell.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_folder}/documents.parquet").collect()]
    found = QUERIES["op12_token_alignment"](spark, small_folder).collect()
    names = (*NAMES[:-1], "groups_sha256")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == corpus(libraries, rows)
