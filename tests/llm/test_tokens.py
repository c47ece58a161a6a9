"""Chunked and tree encoding against the libraries' own results on whole texts."""

import random
from hashlib import sha256

import public_tokenizers
import pytest

from plugsites.llm.chunks import ChunkEncoder
from plugsites.llm.token_counts import count_tokens
from plugsites.llm.tree_bpe import TreeEncoder, encode_and_decode
from plugsites.llm.vocabularies import default_path, json_tokenizer, rank_encoder

RANKS = default_path("byte_bpe_multi_50k.tiktoken")
AWKWARD = [
    "",
    " ",
    "  two  spaces  ",
    "a\n b\n\nc \n d\t e",
    "I'll we're 'quoted' don't' x's",
    "<|endoftext|> in<|endoftext|>side <|startoftext|>",
    "ÉCOLE İstanbul ß Σας ﬁ é ́x",
    "no-break space thin space nel\x85x fs\x1cx",
    "日本語のテキスト 12 345 🙂🙂 👩‍👩‍👧",
    "x" * 5000 + " " + "y1" * 3000,
    "\x00\x01 control",
    "word " * 3000,
]


def random_texts(n, seed=5):
    draw = random.Random(seed)
    alphabet = ["a", "b", " ", " ", "\n", "'", "s", "ll", ".", "1", "é", " ", "日", "!", "the "]
    return ["".join(draw.choices(alphabet, k=draw.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize(
    "name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
)
def test_chunks_equal_whole_texts(name, spaced):
    texts = AWKWARD + random_texts(500)
    tokenizer = json_tokenizer(default_path(name))
    expected = [one.ids for one in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = ChunkEncoder(default_path(name), spaced)
    for _ in range(2):  # the second time from memory
        got = [memoryview(one).cast("I").tolist() for one in encoder.encode(texts)]
        assert got == expected
    assert encoder.lengths(texts) == [len(ids) for ids in expected]


@pytest.mark.parametrize(
    "name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
)
def test_plain_words_equal_the_whole_encoding(name, spaced):
    from plugsites.llm.chunks import PLAIN

    letters = [chr(k) for k in range(0x180) if PLAIN.fullmatch(chr(k))]
    assert len(letters) > 200 and all(map(str.isalpha, letters))
    draw = random.Random(3)
    words = letters + ["".join(draw.choices(letters, k=draw.randrange(2, 30))) for _ in range(2000)]
    words += ["".join(draw.choices("aAbeEr", k=draw.randrange(2, 9))) for _ in range(500)]
    encoder = ChunkEncoder(default_path(name), spaced)
    assert encoder.plain and encoder._words([]) == []
    assert encoder._words(words) == encoder._library([encoder.lead + word for word in words])


def test_chunk_memory_is_bounded(monkeypatch):
    from plugsites.llm import chunks

    monkeypatch.setattr(chunks, "REMEMBERED", 50)
    encoder = ChunkEncoder(default_path("byte_bpe_50k.json"), True)
    for k in range(20):
        encoder.lengths([" ".join(f"w{k}x{j}" for j in range(30))])
        assert len(encoder.young) <= 50 and len(encoder.old) <= 110


@pytest.mark.parametrize(
    "name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
)
def test_few_chunks_are_learned_and_they_take_little_room(name, spaced):
    """Words at a line end or before punctuation are not learned once for each neighbour."""
    words = ["".join(pair) for pair in zip("abcdefghijklmnopqrstuvwxyzäöüß" * 2, "ab" * 30)][:30]
    texts = [f"{a}, {a}.\n{b}! {a}\n{b}" for a in words for b in words]
    tokenizer = json_tokenizer(default_path(name))
    expected = [one.ids for one in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = ChunkEncoder(default_path(name), spaced)
    ids, counts = encoder.encode_flat(texts)
    assert counts.tolist() == list(map(len, expected))
    assert ids.tolist() == [one for of in expected for one in of]
    assert len(encoder.young) <= 3 * len(words)
    draw = random.Random(1)
    encoder.encode(["".join(draw.choices("abcdefgh", k=9)) for _ in range(20_000)])
    held = (encoder.young.chunks, encoder.young.ids, encoder.young.sizes, encoder.young.starts)
    assert sum(one.nbytes for one in held) < 80 * len(encoder.young)


@pytest.mark.parametrize("leaf_chars", [1, 7, 64])
def test_tree_equals_whole_texts(leaf_chars):
    ranks = rank_encoder(RANKS, public_tokenizers.PATTERN)
    tree = TreeEncoder(ranks.encode_ordinary, ranks.decode_bytes, leaf_chars)
    for text in [t for t in AWKWARD if leaf_chars > 1 or len(t) < 1000] + random_texts(300, 9):
        ids = tree.encode(text)
        assert ids == ranks.encode_ordinary(text)
        assert tree.decode(ids) == text.encode()


def test_tree_query_on_small_table(spark):
    rows = list(enumerate(AWKWARD)) + [(None, "null id"), (3, AWKWARD[3]), (99, None)]
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, n_tokens long"
    )
    ranks = rank_encoder(RANKS, public_tokenizers.PATTERN)
    got = encode_and_decode(docs, RANKS, public_tokenizers.PATTERN, leaf_chars=16, keep_ids=True)
    expected = {
        (i, tuple(ranks.encode_ordinary(t or "")), sha256((t or "").encode()).hexdigest())
        for i, t in rows
    }
    assert {(r.doc_id, tuple(r.ids), r.decoded_sha256) for r in got.collect()} == expected
    assert got.count() == len(rows)
    assert encode_and_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_counts_on_small_table(spark):
    path = default_path("byte_bpe_50k.json")
    rows = list(enumerate(AWKWARD)) + [(None, "null id"), (3, AWKWARD[3]), (99, None)]
    docs = spark.createDataFrame(
        [(i, t, 7) for i, t in rows], "doc_id long, text string, n_bytes int"
    )
    tokenizer = json_tokenizer(path)
    expected = sorted(
        (-1 if i is None else i, len((t or "").encode()), n, n > 512)
        for i, t in rows
        for n in [len(tokenizer.encode(t or "", add_special_tokens=False).ids)]
    )
    got = count_tokens(docs, path, 512).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == expected
    assert count_tokens(docs.limit(0), path, 512).count() == 0


def test_registered_queries_equal_the_libraries(spark, folder):
    from plugsites.llm.catalog import QUERIES

    texts = {
        r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()
    }
    counted = QUERIES["op7_token_counts"](spark, folder).collect()
    tokenizer = json_tokenizer(default_path("byte_bpe_50k.json"))
    assert len(counted) == len(texts)
    for row in counted:
        text = texts[row.doc_id]
        assert row.n_bytes == len(text.encode())
        assert row.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
    ranks = rank_encoder(RANKS, public_tokenizers.PATTERN)
    encoded = QUERIES["op6_byte_bpe"](spark, folder).collect()
    assert len(encoded) == len(texts)
    for row in encoded:
        ids = ranks.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(texts[row.doc_id].encode()).hexdigest()
