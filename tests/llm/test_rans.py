import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareloom.llm import rans

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_blocks_round_trip():
    drawn = np.random.default_rng(9)
    for size, kinds in ((0, 5), (1, 1), (1023, 3), (1024, 2), (400_000, 3000), (70_000, 40_000)):
        ids = np.minimum(drawn.geometric(0.01, size), kinds) - 1 if kinds < 4000 else drawn.integers(0, kinds, size)
        counts = np.bincount(ids, minlength=kinds + 3)
        if not size:
            counts[0] = 1
        table = rans.Table(rans.scaled(counts))
        assert table.frequencies.sum() == 1 << rans.TABLE_BITS
        parts = np.split(ids, [size // 3, size // 2])
        payload = rans.encode_block([3, None, -1], parts, table)
        doc_ids, lengths, back = rans.decode_block(payload, table)
        assert doc_ids == [3, None, -1] and lengths.tolist() == [len(p) for p in parts]
        assert (back == ids).all()
    assert len(payload) < 70_000 * 2.4


def test_a_part_is_decoded_alone():
    ids = np.random.default_rng(1).integers(0, 50, 3 * rans.LANES * rans.CHECKPOINT_STEPS + 77)
    table = rans.Table(rans.scaled(np.bincount(ids)))
    words, states, places = rans.encode_ids(ids, table)
    span = rans.LANES * rans.CHECKPOINT_STEPS
    assert (rans.decode_part(words, states[2], int(places[2]), span, table) == ids[2 * span : 3 * span]).all()


def test_damage_is_found():
    table = rans.Table(rans.scaled(np.array([5, 1, 1])))
    payload = bytearray(rans.encode_block([1], [np.array([0, 1, 2, 0])], table))
    payload[len(payload) // 2] ^= 4
    with pytest.raises(ValueError):
        rans.decode_block(bytes(payload), table)
    with pytest.raises(ValueError):
        rans.decode_block(rans.encode_block([1], [np.array([0])], table), rans.Table(rans.scaled(np.array([1, 9]))))


def test_scaling_keeps_rare_ids():
    counts = np.array([10**12, 1, 0, 1])
    scaled = rans.scaled(counts)
    assert scaled.sum() == 1 << rans.TABLE_BITS and scaled[1] == scaled[3] == 1 and scaled[2] == 0
    assert rans.scaled(np.zeros(4, np.int64)).sum() == 0


def expected(docs):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    encoded = []
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        encoded.append((r["doc_id"] is not None, r["doc_id"] or 0, ids.astype("<u2").tobytes(), len(ids), zlib.crc32(ids.tobytes())))
    out, start = [], 0
    for known, doc_id, _, n, crc in sorted(encoded):
        out.append((doc_id if known else None, start, n, crc))
        start += n
    return out


def test_dataset_equals_the_librarys_ids(spark, folder, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(rans, "IDS_PER_SHARD", 20_000)
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for k, docs in enumerate((odd_documents, small.repartition(5), no_documents)):
        rans.write_dataset(docs, folder(f"d{k}"), PATH, drops_spaces=True)
        found = rans.read_dataset(spark, folder(f"d{k}")).orderBy("start").collect()
        assert [tuple(r) for r in found] == expected(docs)
