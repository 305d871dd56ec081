import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textfeat.llm import packing, queries, rans, token_files
from textfeat.llm.tokens import TextEncoder

SF = "/root/testdata/sf0.001"
WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def ids_of(path, text, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_give_the_ids_of_the_whole_text(path):
    encoder, rnd = TextEncoder(path), random.Random(1)
    parts = [*"ab cdéÉß \n\t  'srtvm!?.,12²Ⅷ́　 \x1c中文🙂İΣςσჿ\x00\"-_", "'s", "'ll", " 're", "  ", "\r\n", "<|endoftext|>", "\U0010ffff"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert encoder.encode(text) == encoder.whole(text), repr(text)
    assert encoder.encode(None) == encoder.encode("") == b""


@pytest.mark.parametrize("n", [0, 1, 31, 33, rans.SEGMENT - 1, rans.SEGMENT, 3 * rans.SEGMENT + 5])
def test_rans_round_trip_and_decoding_from_a_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(1, n) * 3).astype(np.int64).clip(0, 40_000).astype(np.uint32)
    table = rans.Frequencies.fit(np.bincount(ids, minlength=5))
    assert table.freq.sum() == 1 << table.bits and (table.freq[np.unique(ids)] > 0).all()
    payload, checkpoints, crc = rans.encode(ids, table)
    symbols = table.symbols()
    assert (rans.decode(payload, checkpoints, n, table, symbols) == ids).all() and crc == zlib.crc32(ids.tobytes())
    last = max(0, n - 1) // rans.SEGMENT
    found = rans.decode(payload, checkpoints, n, table, symbols, only=slice(last, last + 1))
    assert (found == ids[last * rans.SEGMENT :]).all()


def test_rans_is_near_the_entropy_and_notices_damage():
    ids = np.random.default_rng(0).geometric(0.1, 200_000).astype(np.uint32)
    table = rans.Frequencies.fit(np.bincount(ids))
    payload, checkpoints, _ = rans.encode(ids, table)
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert len(payload) < 1.01 * entropy + len(checkpoints)
    with pytest.raises(ValueError):
        rans.decode(payload[:400] + b"\1\2\3\4" + payload[404:], checkpoints, len(ids), table, table.symbols())


ROWS = [(3, "b b"), (1, None), (None, "nul\nid"), (2, ""), (2, "same id"), (5, "x " * 3000), (4, "b b"), (4, "b b")]


def test_token_files_hold_all_documents_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in ROWS], "doc_id long, text string, ids int, part int")
    token_files.write(docs, str(tmp_path / "a"), WORDS, end_id=2, block_tokens=4)
    found = sorted(token_files.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 2, 3, 4, 4, 5]
    expected = sorted((str(i), ids_of(WORDS, t, 2).tobytes()) for i, t in ROWS)
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in found) == expected
    assert [r.start for r in found] == list(np.cumsum([0] + [len(r.ids) // 4 for r in found])[:-1])


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "a"), WORDS, end_id=2)
    assert token_files.read(spark, str(tmp_path / "a")).count() == 0


def test_op1_equals_the_library(spark):
    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    found = sorted(queries.op1_token_files(spark, SF).collect())
    start = 0
    for doc, row in zip(docs, found, strict=True):
        ids = ids_of(WORDS, doc.text, 2)
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def check_packing(rows, texts, capacity, end=0):
    """rows: doc_id, piece, start, length, crc, sequence_id, offset; texts by unique id. Number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r[0], []).append(r)
        by_sequence.setdefault(r[5], []).append((r[6], r[3]))
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids, at = ids_of(BYTES, text, end), 0
        for piece, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r[1])):
            assert (r[1], r[2], r[4]) == (piece, at, zlib.crc32(ids[at : at + r[3]].tobytes()))
            assert r[3] == capacity or piece == 0
            at += r[3]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_op2_packs_every_piece_tightly(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op2_pack(spark, SF).collect()
    n = check_packing([tuple(r) for r in rows], texts, queries.PACK_CAPACITY)
    assert n <= -(-sum(r.length for r in rows) // queries.PACK_CAPACITY) + 1


def test_packing_of_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, rank string")
    packed = packing.pack(docs, BYTES, 0, 16).collect()
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    expected = {}
    for i, t in ROWS:
        expected[i] = expected.get(i, 0) + len(ids_of(BYTES, t, 0))
    assert total == expected
    whole = packing.sequences(packing.pack(docs, BYTES, 0, 16)).collect()
    assert sum(len(r.ids) // 4 for r in whole) == sum(expected.values()) and max(len(r.ids) for r in whole) <= 64
    assert packing.pack(docs.limit(0), BYTES, 0, 16).count() == 0


def test_bins_are_the_fullest():
    rnd = random.Random(2)
    for _ in range(200):
        counts = {rnd.randint(1, 30): rnd.randint(1, 4) for _ in range(rnd.randint(0, 6))}
        room = rnd.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
        chosen = packing.fullest(counts, room)
        assert sum(chosen) == max(sums) and all(chosen.count(k) <= counts[k] for k in chosen)
