from __future__ import annotations

import os
import sys
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import fs

sys.path.insert(0, os.path.dirname(__file__))

from helpers import ODD, no_docs, odd_docs, rows_of  # noqa: E402

from rankforge.llm import bin_packing, queries, token_blocks  # noqa: E402
from rankforge.llm.subwords import SubwordEncoder  # noqa: E402


@pytest.fixture(scope="module")
def encoder():
    return SubwordEncoder(queries.VOCABULARY, most_words=3000)


def plain_ids(encoder, text):
    return encoder.full.encode(text or "", add_special_tokens=False).ids


def test_cached_words_give_the_tokenizer_s_ids(encoder, small_dir):
    texts = [t for _, t in rows_of(small_dir)] + [t for _, t, _ in ODD] + ["É́ ΣΑΣ Σ", "'S 'LL we'Re 's", "a - ... (b) ß÷ ÷ß", "½ ²³ x1y2", "ŉ ǅ"]
    for run in (texts, texts[:7], [t for t in texts if "<|" not in (t or "")]):
        ids, ends = encoder.encode(pa.array(run, pa.string()))
        begin = 0
        for t, end in zip(run, ends.tolist()):
            assert ids[begin:end].tolist() == plain_ids(encoder, t), t
            begin = end
    assert [x.tolist() for x in encoder.encode(pa.array([], pa.string()))] == [[], []]


def test_a_vocabulary_that_needs_whole_texts():
    import public_tokenizers

    other = SubwordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    ids, ends = other.encode(pa.array(["a  b", None, "c"]))
    assert ids[:ends[0]].tolist() == other.full.encode("a  b", add_special_tokens=False).ids and ends[0] == ends[1]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [1, 2, 300, 49408, 2**32 - 1])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n + top)
    ids = rng.integers(0, top, n).astype(np.uint32)
    ids[::17] = rng.integers(0, 2**32 - 1, len(ids[::17]))
    blocks = token_blocks.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert len(blocks) == -(-n // token_blocks.BLOCK)
    if n:
        assert (token_blocks.decode_blocks(b"".join(blocks), starts) == ids).all()
        k = len(blocks) - 1  # any block alone
        assert (token_blocks.decode_blocks(blocks[k], np.array([0])) == ids[k * token_blocks.BLOCK:]).all()


def test_outliers_are_exceptions_and_the_width_is_the_percentile_s():
    ids = np.full(512, 7, np.uint32)
    ids[:20] = 40000
    head = np.frombuffer(token_blocks.encode_blocks(ids)[0], token_blocks.HEAD, 1)[0]
    assert (head["least"], head["width"], head["exceptions"]) == (7, 0, 20)


def test_file_gives_ranges_and_documents(tmp_path):
    ids = np.arange(100_000, dtype=np.uint32) % 50_000
    store = fs.LocalFileSystem()
    writer = token_blocks.BlockWriter(store.open_output_stream(str(tmp_path / "a")))
    writer.docs = [(None, 10), (4, 99_990)]
    for at in range(0, len(ids), 777):
        writer.add(ids[at:at + 777])
    writer.close()
    with store.open_input_file(str(tmp_path / "a")) as source:
        reader = token_blocks.BlockReader(source)
        assert reader.doc_ids == [None, 4] and reader.n_tokens.tolist() == [10, 99_990]
        assert (np.concatenate([*reader.runs()]) == ids).all()
        assert (reader.blocks(3, 5) == ids[3 * 512:5 * 512]).all()
    (tmp_path / "b").write_bytes(b"something else altogether")
    with store.open_input_file(str(tmp_path / "b")) as source, pytest.raises(ValueError):
        token_blocks.BlockReader(source)


def test_token_files_hold_the_ids_in_order(spark, small_dir, encoder):
    found = {r.doc_id: r for r in queries.op1_token_blocks(spark, small_dir).collect()}
    start = 0
    for doc, text in rows_of(small_dir):
        ids = [*plain_ids(encoder, text), 2]
        r = found.pop(doc)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not found


def test_token_files_of_odd_rows(spark, encoder):
    rows = token_blocks.encode_and_read(odd_docs(spark), queries.VOCABULARY, 2, file_ids=3000).orderBy("start").collect()
    wanted = sorted(((d, t) for d, t, _ in ODD), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in rows] == [d for d, _ in wanted]
    assert [r.n_tokens for r in rows] == [len(plain_ids(encoder, t)) + 1 for _, t in wanted]
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    assert token_blocks.encode_and_read(no_docs(spark), queries.VOCABULARY, 2).count() == 0


def fewest(lengths, capacity):
    """Fewest sequences, by trying all."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in sorted(set(range(len(rooms))), key=lambda i: rooms[i]):
            if rooms[i] >= lengths[k]:
                place(k + 1, rooms[:i] + [rooms[i] - lengths[k]] + rooms[i + 1:])
        place(k + 1, [*rooms, capacity - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_few_pieces_are_packed_into_the_fewest_sequences(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 60, rng.integers(1, 10))
    sequence, offset = bin_packing.pack_lengths(lengths, 64)
    assert sequence.max() + 1 == fewest(lengths.tolist(), 64)
    check_places(lengths, sequence, offset, 64)


def check_places(length, sequence, offset, capacity):
    order = np.lexsort((offset, sequence))
    at = {}
    for s, o, n in zip(sequence[order].tolist(), offset[order].tolist(), np.asarray(length)[order].tolist()):
        assert o == at.get(s, 0)
        at[s] = o + n
    assert max(at.values()) <= capacity


def test_completion_beats_best_fit_where_that_is_not_optimal():
    lengths = np.array([6, 5, 5, 4, 3, 3, 2, 2])  # best fit decreasing: 4 of 10
    for items in (lengths, np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 60, 60])):
        sequence, _ = bin_packing.pack_lengths(items, 10 if items.max() < 10 else 60)
        assert sequence.max() + 1 == fewest(items.tolist(), 10 if items.max() < 10 else 60)


def test_fillings_hold_no_dominated_one():
    counts = np.zeros(65, int)
    counts[[30, 20, 10, 11]] = 1
    found = bin_packing.fillings(counts, 41)
    assert found[0] == (30, 11)
    for f in bin_packing.fillings(counts, 40):
        rest = [x for x in (30, 20, 10, 11) if x not in f]
        assert not any(sum(f) - y + x <= 40 and x > y for y in f for x in rest)
    assert all(sum(c) <= 41 for r in (1, 2) for c in combinations(found[0], r))


def test_packing_is_close_to_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(6.3, 1.1, 20_000).astype(int) + 1, 4096)
    sequence, offset = bin_packing.pack_lengths(lengths, 4096, steps=500)
    check_places(lengths, sequence, offset, 4096)
    assert sequence.max() + 1 <= bin_packing.lower_bound(np.bincount(lengths, minlength=4097), 4096) + 1


@pytest.mark.parametrize("seed", range(3))
def test_completion_beats_best_fit_with_many_pieces_a_sequence(seed):
    lengths = np.random.default_rng(seed).integers(300, 500, 400)  # about ten of 4096
    counts = np.bincount(lengths, minlength=4097)
    sequence, offset = bin_packing.pack_lengths(lengths, 4096)
    check_places(lengths, sequence, offset, 4096)
    assert len(lengths) / (sequence.max() + 1) >= 8
    assert sequence.max() + 1 == bin_packing.lower_bound(counts, 4096) < len(bin_packing.best_fit(counts, 4096))


def test_all_fillings_are_enumerated_by_waste():
    pieces = [2, 2, 2, 3, 5, 5, 7, 9]
    counts = np.bincount(pieces, minlength=21)
    wanted = {tuple(sorted(c, reverse=True)) for k in range(9) for c in combinations(pieces, k) if sum(c) <= 20}
    found = list(bin_packing.all_fillings(counts, 20))
    assert len(found) == len(set(found)) and set(found) == wanted
    assert [sum(x) for x in found] == sorted((sum(x) for x in found), reverse=True)


def test_packed_documents(spark, small_dir, encoder):
    rows = queries.op2_bin_completion(spark, small_dir).collect()
    own = {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
    for doc, text in rows_of(small_dir):
        ids = [*plain_ids(encoder, text), 1]
        parts = sorted(own.pop(doc), key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in parts] == [(k, a, min(4096, len(ids) - a)) for k, a in enumerate(range(0, len(ids), 4096))]
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) for r in parts]
    assert not own
    check_places([r.length for r in rows], np.array([r.sequence_id for r in rows]), np.array([r.offset for r in rows]), 4096)
    assert len({r.sequence_id for r in rows}) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_packing_of_odd_rows(spark, encoder):
    rows = bin_packing.pack_documents(odd_docs(spark), queries.VOCABULARY, 1, 128, shard=20).collect()
    assert sum(r.length for r in rows) == sum(len(plain_ids(encoder, t)) + 1 for _, t, _ in ODD)
    check_places([r.length for r in rows], np.array([r.sequence_id for r in rows]), np.array([r.offset for r in rows]), 128)
    assert bin_packing.pack_documents(no_docs(spark), queries.VOCABULARY, 1).count() == 0
