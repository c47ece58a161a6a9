"""Coded token files against the library's ids, and damage to blocks."""

import tempfile
import zlib

import numpy as np
import pytest

from plugsites.llm import range_coder
from plugsites.llm.range_coder import BlockError, decode_blocks, encode_blocks
from plugsites.llm.token_files import read_token_files, write_token_files
from plugsites.llm.vocabularies import default_path, json_tokenizer

PATH = default_path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 640, 1000])
@pytest.mark.parametrize("top", [1, 2, 300, 65536, 70_000, 2**32])
def test_round_trip(n, top):
    draw = np.random.default_rng(n * 7 + top)
    for ids in (draw.integers(0, top, n), np.sort(draw.integers(0, top, n))):
        assert (decode_blocks(encode_blocks(ids, 64)) == ids).all()


def test_extreme_ids_and_long_runs():
    for ids in ([65535] * 5000, [0] * 5000, [0, 65535] * 4000, list(range(65536)),
                [2**32 - 1] * 3000, [0, 2**32 - 1, 65536] * 2000, [255, 256, 257] * 700):
        ids = np.array(ids)
        assert (decode_blocks(encode_blocks(ids)) == ids).all()
    for wrong in (np.array([2**32]), np.array([-1])):
        with pytest.raises(ValueError):
            encode_blocks(wrong)
    with pytest.raises(ValueError):
        encode_blocks(np.array([1]), range_coder.MOST_BLOCK_IDS + 1)


def test_largest_blocks():
    ids = np.random.default_rng(8).integers(0, 2**20, 40_000)
    ids[::3] = 7
    size = range_coder.MOST_BLOCK_IDS
    assert (decode_blocks(encode_blocks(ids, size)) == ids).all()


def test_real_ids_take_fewer_bits_than_a_general_compressor(folder):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{folder}/documents.parquet", columns=["text"]).column("text")
    encoded = json_tokenizer(PATH).encode_batch(
        [text or "" for text in texts.to_pylist()], add_special_tokens=False
    )
    ids = np.concatenate([[*one.ids, 0] for one in encoded])
    pieces = [ids[k : k + 2048].astype("<u2").tobytes() for k in range(0, len(ids), 2048)]
    assert len(encode_blocks(ids)) < 0.9 * sum(len(zlib.compress(one, 9)) for one in pieces)


def test_predictable_ids_become_small():
    draw = np.random.default_rng(2)
    cycle = np.tile(draw.integers(0, 50_000, 40), 2000)
    assert len(encode_blocks(cycle)) * 8 / len(cycle) < 2
    frequent = draw.integers(0, 200, 80_000)
    assert len(encode_blocks(frequent)) * 8 / len(frequent) < 9


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(3).integers(0, 50_000, 3 * 2048)
    data = encode_blocks(ids)
    sizes = []
    at = 0
    while at < len(data):
        size = range_coder.HEADER.size + 2 * range_coder.HEADER.unpack_from(data, at)[3]
        sizes.append((at, size))
        at += size
    for k, (at, size) in enumerate(sizes):
        assert (decode_blocks(data[at : at + size]) == ids[k * 2048 : (k + 1) * 2048]).all()
    for spot in (0, 9, range_coder.HEADER.size + 100, len(data) - 40):
        broken = bytearray(data)
        broken[spot] ^= 0x55
        with pytest.raises(BlockError):
            decode_blocks(bytes(broken))
    with pytest.raises(BlockError):
        decode_blocks(data[:-10])


def expected_rows(texts):
    tokenizer = json_tokenizer(PATH)
    rows, start = [], 0
    for doc_id, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return rows


def test_small_table(spark):
    texts = [(5, "five words in this one"), (1, None), (3, ""), (None, "no id"), (9, "x " * 700)]
    texts += [(5, "a second text"), (5, "five words in this one"), (-2, "<|endoftext|>\n\n ok")]
    docs = spark.createDataFrame(
        [(k, t, 0) for k, t in texts], "doc_id long, text string, shard int"
    ).repartition(3)
    path = tempfile.mkdtemp(prefix="tokens-") + "/files"
    write_token_files(docs, path, PATH, shards=3, segment_ids=8)
    got = [tuple(r) for r in read_token_files(spark, path, with_ids=True).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_rows(texts)
    empty = tempfile.mkdtemp(prefix="tokens-") + "/files"
    write_token_files(docs.limit(0), empty, PATH)
    assert read_token_files(spark, empty).count() == 0


def test_query_equals_the_library(spark, folder):
    from plugsites.llm.catalog import QUERIES

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = QUERIES["op9_token_files"](spark, folder).collect()
    wanted = [row[:4] for row in expected_rows([tuple(r) for r in docs.collect()])]
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == wanted


@pytest.mark.parametrize("n", [2 * 2048 - 1, 8 * 2048, 16 * 2048, 16 * 2048 + 1, 19 * 2048 + 77])
@pytest.mark.parametrize("top", [3, 500, 50_000, 2**32])
def test_blocks_of_several_streams(n, top):
    draw = np.random.default_rng(n + top % 1000)
    ids = draw.integers(0, top, n)
    ids[n // 2 :] = ids[: n - n // 2]
    for size in (4096, 12_000, range_coder.MOST_BLOCK_IDS):
        assert (decode_blocks(encode_blocks(ids, size)) == ids).all()


def test_files_remember_texts_within_a_block(spark):
    # Blocks of 2048 ids saw nothing of a text that came 3000 ids before.
    draw = np.random.default_rng(6)
    letters = np.array(list("bcdfghjklmnpqrstvwxz"))
    text = " ".join("".join(draw.choice(letters, 4)) for _ in range(1200))
    docs = spark.createDataFrame([(k, text) for k in range(12)], "doc_id long, text string")
    path = tempfile.mkdtemp(prefix="tokens-") + "/files"
    write_token_files(docs, path, PATH, shards=1)
    (row,) = spark.read.parquet(path).select("n_ids", "blocks").collect()
    assert row["n_ids"] > 12 * 3000
    assert len(row["blocks"]) * 8 / row["n_ids"] < 7


def test_coding_takes_a_few_times_the_time_of_a_general_compressor():
    # About 5 times; 18 times when both sides went through the block id by id.
    import time

    draw = np.random.default_rng(12)
    ids = np.minimum(draw.zipf(1.2, 1_200_000), 50_000).astype("<u2")
    pieces = [ids[k : k + 2048].tobytes() for k in range(0, len(ids), 2048)]
    begin = time.process_time()
    for one in pieces:
        zlib.decompress(zlib.compress(one, 6))
    middle = time.process_time()
    decode_blocks(encode_blocks(ids, range_coder.MOST_BLOCK_IDS))
    assert time.process_time() - middle < 10 * (middle - begin)
