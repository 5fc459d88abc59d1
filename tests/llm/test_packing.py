import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recsql.llm.packing import GRAIN, balance, crc_between, pack_documents
from recsql.llm.wordpiece_ids import WordIds

CAP = 4096


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return WordIds(vocabulary)


def library_ids(encoder, texts):
    return [np.asarray(e.ids, "<u4").tobytes() for e in encoder.lib.encode_batch(texts, add_special_tokens=False)]


def check(rows, docs, encoder, capacity=CAP):
    want = defaultdict(int)
    for (_, t), raw in zip(docs, library_ids(encoder, [t or "" for _, t in docs]), strict=True):
        want[raw + (2).to_bytes(4, "little")] += 1
    covered = sorted((str(r.doc_id), r.doc_tokens, r.start, r.length) for r in rows)
    assert sum(r.length for r in rows) == sum(len(raw) // 4 * n for raw, n in want.items())
    assert all(r.length > 0 for r in rows) and len(covered) >= len(docs)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@given(st.lists(st.text(alphabet="abcdefghi ABC.,'!?-019éßÀöÿ÷×µª²<|> \x1cİΣ漢és\t\n", max_size=60), max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_library(encoder, texts):
    assert encoder(texts) == library_ids(encoder, texts)


def test_ids_equal_the_library_on_documents(encoder, documents):
    texts = [r.text for r in documents.select("text").collect()]
    assert encoder(texts) == library_ids(encoder, texts)
    assert encoder(["don't I'll we've 'tis", "<|endoftext|> a", "a" * 300]) == library_ids(
        encoder, ["don't I'll we've 'tis", "<|endoftext|> a", "a" * 300])


@given(st.binary(max_size=300), st.integers(0, 300))
@settings(max_examples=100, deadline=None)
def test_checksum_of_a_part(data, cut):
    cut = min(cut, len(data))
    assert crc_between(zlib.crc32(data[:cut]), zlib.crc32(data), len(data) - cut) == zlib.crc32(data[cut:])


@given(st.lists(st.integers(1, 900), max_size=60))
@settings(max_examples=100, deadline=None)
def test_balance_covers_each_document_once(lengths):
    pieces = balance(np.asarray(lengths, dtype=np.int64), 256, 1.0, 0.01)
    spans = defaultdict(list)
    used = defaultdict(int)
    for d, start, length, s in pieces:
        assert start % GRAIN == 0
        spans[d].append((start, length))
        used[s] += length
    assert all(v <= 256 for v in used.values())
    for d, n in enumerate(lengths):
        at = 0
        for start, length in sorted(spans[d]):
            assert start == at
            at += length
        assert at == n
    waste = sum(256 - v for v in used.values())
    assert waste < 256 + GRAIN * (len(used) + 1)


def test_lowest_cost_sequence_first():
    pieces = balance(np.asarray([100, 100, 50, 50], dtype=np.int64), 160, 1.0, 1.0)
    assert {s for d, _, _, s in pieces if d in (0, 1)} == {0, 1}
    assert {s for d, _, _, s in pieces if d in (2, 3)} == {0, 1}


def test_documents(documents, encoder):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows = pack_documents(documents).collect()
    check(rows, docs, encoder)
    ids = {i: raw + (2).to_bytes(4, "little") for (i, _), raw in zip(docs, library_ids(encoder, [t for _, t in docs]), strict=True)}
    for r in rows:
        raw = ids[r.doc_id]
        assert r.doc_tokens == len(raw) // 4
        assert r.ids_crc32 == zlib.crc32(raw[4 * r.start:4 * (r.start + r.length)])
    starts = defaultdict(list)
    for r in rows:
        starts[r.doc_id].append((r.start, r.length))
    assert all(sum(n for _, n in v) == len(ids[i]) // 4 for i, v in starts.items()) and len(starts) == len(ids)
    total, sequences = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert sequences * CAP - total < 0.03 * total + CAP


def test_groups_split_the_work(documents, encoder):
    rows = pack_documents(documents, group_tokens=20_000).collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 3
    check(rows, [(r.doc_id, r.text) for r in documents.collect()], encoder)


def test_edges(edge_docs, empty_docs, encoder):
    rows = pack_documents(edge_docs).collect()
    check(rows, [(r.doc_id, r.text) for r in edge_docs.collect()], encoder)
    for i in (1, 2, 3):
        assert [(r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == i] == [(0, 1, 1)]
    assert len([r for r in rows if r.doc_id == 8]) == 2
    assert pack_documents(empty_docs).collect() == []
    with pytest.raises(ValueError):
        pack_documents(edge_docs, capacity=100)
