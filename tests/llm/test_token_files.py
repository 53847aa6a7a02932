from __future__ import annotations

import random
import weakref
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from runlens.llm import chunks, token_files
from runlens.llm.elias_fano import EliasFano, encoded
from runlens.llm.queries import BYTE_VOCABULARY, QUERIES, VOCABULARY, read
from runlens.session import scratch_path
from tests.llm.helpers import ODD_ROWS, documents
from tests.llm.test_tokens_and_packing import strange_texts
from tests.test_queries import SF_DIR, needs_data


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_VOCABULARY)


def spaced_texts(n, seed):
    """Words between all kinds of white space, and special strings."""
    rng = random.Random(seed)
    pool = ["word", "Über", "a", "'s", "汉字", "🙂", "12", ".", ",", "<|endoftext|>", "<0x0A>", "▁x", "é", "\0"]
    gaps = [" ", " ", " ", " ", "\n", "\n", "  ", "\n\n", " \n", "\n ", "\t", "\r\n", "\x1c", "　", "\xa0", ""]
    return ["".join(rng.choice(gaps) + rng.choice(pool) for _ in range(rng.randint(0, 9))) + rng.choice(gaps) for _ in range(n)]


def test_tasks_give_back_what_they_kept(spark, monkeypatch):
    docs = documents(spark, [(1, "some words here"), (2, "words and more")])
    runs, plain = [], type(docs).mapInArrow

    def noted(df, run, schema):
        runs.append((run, df.schema))
        return plain(df, run, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    token_files.write(docs, BYTE_VOCABULARY, scratch_path(spark, "given-back"))
    (ids, _), (shards, _) = runs
    known = token_files.encoder(BYTE_VOCABULARY).pieces.known
    known.forget()
    batch = pa.record_batch({"doc_id": pa.array([1, 2]), "text": ["some words here", "words and more"]})
    known.old = {"seldom": b""}
    (made,) = ids(iter([batch]))
    assert known and not known.old
    monkeypatch.setattr(token_files.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    (image,) = shards(iter([made]))
    assert not known and not known.old and not known.size
    assert token_files.Shard(image.column("image")[0].as_py()).names() == [1, 2]


@given(st.lists(st.integers(0, 1 << 62), max_size=700), st.integers(0, 60))
@settings(max_examples=60, deadline=None)
def test_elias_fano_gives_back_its_numbers(numbers, shift):
    numbers = sorted(x >> shift for x in numbers)
    made = EliasFano(encoded(np.array(numbers, np.uint64)))
    assert made.all().tolist() == numbers == [made[i] for i in range(len(made))]
    with pytest.raises(IndexError):
        made[len(numbers)]


def test_elias_fano_is_small():
    rng = np.random.default_rng(0)
    ends = np.cumsum(rng.integers(1, 2000, 50_000)).astype(np.uint64)
    code = encoded(ends)
    bound = 2 + int(ends[-1] // len(ends)).bit_length()
    assert len(code) <= len(ends) * (bound + 32 / 256) / 8 + 64
    assert len(code) < len(ends) * 2  # where 64-bit numbers take 8 bytes
    assert EliasFano(code).n_bytes == len(code)
    top = np.array([0, 0, (1 << 64) - 1, (1 << 64) - 1], np.uint64)
    assert EliasFano(encoded(top)).all().tolist() == top.tolist()


@pytest.mark.parametrize("kept", [5, 10**6])
def test_ids_equal_the_library(library, monkeypatch, kept):
    monkeypatch.setattr(chunks, "KEPT", kept)
    monkeypatch.setattr(chunks, "TOGETHER", 50)
    made = token_files.Encoder(BYTE_VOCABULARY)
    assert made.pieces is not None and made.kind.itemsize == 2
    texts = [*strange_texts(1500), *spaced_texts(3000, 3), "", " ", "\n", "x" * 5000, "a  b", " \rfoo", "foo \rfoo", "foo"]
    for at in range(0, len(texts), 40):
        some = texts[at : at + 40]
        for text, ids in zip(some, made.of(some)):
            assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_vocabulary_that_cannot_be_cut_is_used_whole():
    from tokenizers import Tokenizer

    made, plain = token_files.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    assert made.pieces is None
    texts = strange_texts(200, 9)
    for text, ids in zip(texts, made.of(texts)):
        assert np.frombuffer(ids, made.kind).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_words_of_ascii_letters_go_to_the_model_without_a_pattern(library, monkeypatch):
    encode, asked = token_files.Encoder(BYTE_VOCABULARY), []

    def fullmatch(x, plain=token_files._WORD):
        asked.append(x)
        return plain.fullmatch(x)

    monkeypatch.setattr(token_files, "_WORD", SimpleNamespace(fullmatch=fullmatch))
    texts = ["some Words of asciiLetters alone", "x été x3 x. " + "unsplittable" * 40 + " end", "x " + "Zq" * 300 + " x"]
    found = [np.frombuffer(x, encode.kind).tolist() for x in encode.of(texts)]
    assert found == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert not [x for x in asked if x[1:].isascii() and x[1:].isalpha()]


def test_pieces_of_one_word_share_its_ids(library):
    encode = token_files.Encoder(BYTE_VOCABULARY)
    texts = ["x word word, word!! wörd. (word) word's", "x\nword\nword. \nwörd,\n\nword 12. ,, .", "x word<|endoftext|> word<|", ""]
    texts += [f"x a{c} {c}b.\n{c}c," for c in map(chr, range(0xC0, 0x2B0))]
    for text, ids in zip(texts, encode.of(texts), strict=True):
        assert np.frombuffer(ids, encode.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text
    known = encode.pieces.known
    assert {"word", "\nword", "wörd"} <= known.keys() and known.keys().isdisjoint(["word,", "word!!", "\nword.", "wörd."])


def test_joined_batches_are_not_kept_twice():
    made = (pa.record_batch({"text": [str(i) * 1000]}) for i in range(4))
    seen = []

    def watched():
        for batch in made:
            seen.append(weakref.ref(batch))
            yield batch

    found = []
    for whole in chunks.together(watched(), 2500):
        found += whole.column("text").to_pylist()
        assert sum(x() is not None for x in seen) <= 1
    assert found == [str(i) * 1000 for i in range(4)]


def test_images_hold_what_was_put_in():
    kind = np.dtype("<u4")
    parts = [np.arange(n, dtype=kind) + 7 * n for n in (3, 0, 1, 400, 0, 2)]
    names = [None, None, -(1 << 63), -5, -5, (1 << 63) - 1]
    shard = token_files.Shard(token_files.image_of(names, [x.tobytes() for x in parts], kind))
    assert shard.names() == names
    assert all(np.array_equal(shard.document(i), x) for i, x in enumerate(parts))
    nameless = token_files.Shard(token_files.image_of([None], [b"\1\0"], np.dtype("<u2")))
    assert nameless.names() == [None] and nameless.document(0).tolist() == [1]
    with pytest.raises(ValueError):
        token_files.Shard(b"X" + bytes(100))


def expected_rows(library, rows, end=2):
    """doc_id, n_tokens, crc and ids by doc_id; starts follow from the order."""
    out = []
    for name, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        out.append((name, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_files_give_back_every_document(spark, library, monkeypatch, small):
    if small:
        monkeypatch.setattr(token_files, "SHARD_IDS", 40)
        monkeypatch.setattr(token_files, "SHARD_DOCS", 3)
    texts = spaced_texts(120, 5) + ["one very long text, " * 3000]
    rows = [(7 * i % 127 - 20, x) for i, x in enumerate(texts)] + [(3, "same id " + "x" * i) for i in range(60)]
    rows += [(None, "no id either"), *ODD_ROWS]
    path = scratch_path(spark, "test-files")
    token_files.write(documents(spark, rows).repartition(5), BYTE_VOCABULARY, path)
    found = [tuple(r) for r in token_files.read(spark, path).collect()]
    plain = expected_rows(library, rows)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r[0], r[2], r[3], r[4]) for r in found), key=key) == sorted(plain, key=key)
    found.sort(key=lambda r: r[1])
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found)])[:-1].tolist()
    order = [(r[0] is not None, r[0] or 0) for r in found]
    assert order == sorted(order)
    if small:
        assert spark.read.parquet(path).count() > 40


def test_files_of_nothing(spark):
    path = scratch_path(spark, "test-files")
    token_files.write(documents(spark, [(1, "x")]).limit(0), BYTE_VOCABULARY, path)
    assert token_files.read(spark, path, ids=False).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert token_files.read(spark, path).count() == 0


@needs_data
def test_query_equals_brute_force(spark, library):
    rows = sorted(tuple(r) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect())
    expected, start = [], 0
    for name, n, crc, _ in expected_rows(library, rows):
        expected.append((name, start, n, crc))
        start += n
    assert sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, SF_DIR).collect()) == expected
