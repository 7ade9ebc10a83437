"""Encoding and decoding against the tokenizers library, and the merge loop against the plain definition."""

import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from stratum.llm import bpe  # noqa: E402

PATH = public.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(bpe.Vocabulary.read(PATH))


@pytest.fixture(scope="module")
def back():
    return bpe.Decoder(bpe.Vocabulary.read(PATH))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def plain_merge(tok, data):
    """Merge the leftmost pair of the lowest rank until none is left."""
    ids = [tok.first[b] for b in data]
    while True:
        ranks = [(tok.rank[a * tok.size + b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a * tok.size + b in tok.rank]
        if not ranks:
            return ids
        rank, i = min(ranks)
        ids[i:i + 2] = [tok.made[rank]]


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = [*"abcdeé ñ  \n\t'sll 123.,!?中文हि​́\x1c\x85\x00", SPECIAL, "<|endof", "'re", "'LL", " the", "\r\n", "\U0001f600"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_merge_by_definition(own):
    rng = random.Random(5)
    for _ in range(300):
        data = bytes(rng.choice(b"aeinrstth ") for _ in range(rng.randint(1, 40)))
        assert own.merge(data) == plain_merge(own, data)


def test_every_kind_of_character(own, library):
    for cp in [*range(1, 0x3100), *range(0xA000, 0xAC00), *range(0x10000, 0x11800, 3), *range(0x1F000, 0x20000, 5)]:
        c = chr(cp)
        text = f"ab{c}cd 12{c}34 {c}{c} !{c}?"
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(cp)


def test_texts_and_slices(own, back, library, monkeypatch):
    texts = random_texts(1500, 1)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for size in (bpe.SLICE, 3):
        monkeypatch.setattr(bpe, "SLICE", size)
        for t, ids in zip(texts, want):
            assert own.encode(t).tolist() == ids
            assert back.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False)


def test_any_ids_decode(back, library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 30))]
        assert back.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False)


def test_forgotten_pieces(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    tok = bpe.Tokenizer(bpe.Vocabulary.read(PATH))
    for t in random_texts(300, 4):
        assert tok.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(tok.young) <= 3 and len(tok.old) <= 3


def test_long_run_is_not_quadratic(own, library):
    text = "ab1" * 40_000 + "z" * 60_000
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_frames(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_IDS", 50)
    texts = [*random_texts(200, 7), "", None, "same", "same", "word " * 30_000]
    df = spark.createDataFrame([(i if i else None, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, IDS string, decoded int")
    voc = bpe.shared(spark, PATH)
    rows = bpe.encode(df, voc)
    assert rows.columns == ["doc_id", "text", "decoded", "ids"]          # a clashing name is replaced
    out = {r["doc_id"]: r for r in bpe.decode(rows, voc).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        r = out[i if i else None]
        assert r["ids"] == library.encode(t or "", add_special_tokens=False).ids and r["decoded"] == (t or "")
    assert bpe.decode(bpe.encode(df.limit(0), voc), voc).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [60000, 64])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(nulls, voc).orderBy("doc_id").collect()] == ["", library.decode([64])]


def test_digests(spark, library):
    from hashlib import sha256
    df = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string")
    ids = library.encode("Hello world").ids
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(df, PATH).collect()}
    empty = sha256(b"").hexdigest()
    assert got == {1: (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(b"Hello world").hexdigest()),
                   2: (0, empty, empty)}


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary.read(public.path("word_bpe_49k.json"))


def test_one_tokenizer_for_equal_vocabularies():
    """A worker that sees the same vocabulary again keeps one set of tables, not one per query."""
    a, b = bpe.Vocabulary.read(PATH), bpe.Vocabulary.read(PATH)
    assert a is not b and bpe.tokenizer(a) is bpe.tokenizer(b) and bpe.decoder(a) is bpe.decoder(b)
