from __future__ import annotations

import os
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from runlens.llm import packing, tokens
from runlens.llm.queries import VOCABULARY
from tests.llm.helpers import ODD_ROWS, documents

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def strange_texts(n, seed=0):
    rng = random.Random(seed)
    pool = [chr(i) for i in range(0x500)]
    pool += "  　 ​ ́ Σ ẞ ﬁ \U0001f642 İ 's 'LL 're <| |> 가 ᄀ ᅡ ก ० Ⅷ ½ 힣 一 〇 ① .".split(" ")
    pool += ["<|endoftext|>", "<|startoftext|>", "\x85", "\x1c", "\n", " ", ".", ",", "a", "Bc"]
    return ["".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(n)]


def test_counts_and_ids_equal_the_library(library):
    count, ids = tokens.MergeCounter(VOCABULARY), packing.Ids(VOCABULARY)
    for text in [*strange_texts(3000), "word " * 5000, "antidisestablishmentarianism" * 50]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert count.count(text) == len(expected), text
        assert np.frombuffer(ids.of([text])[0], "<u4").tolist() == expected, text


def test_caches_start_anew(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 5)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 5)
    monkeypatch.setattr(packing, "KEPT", 5)
    count, ids = tokens.MergeCounter(VOCABULARY), packing.Ids(VOCABULARY)
    for text in strange_texts(200, 1):
        expected = library.encode(text, add_special_tokens=False).ids
        assert count.count(text) == len(expected)
        assert len(ids.of([text])[0]) == 4 * len(expected)


def test_token_counts(spark, library):
    rows = [(1, "One text, of some words."), (2, "é" * 3000), *ODD_ROWS]
    found = tokens.token_counts(documents(spark, rows), VOCABULARY, limit=5).collect()
    expected = []
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((i, len((text or "").encode()), n, n > 5))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    empty = tokens.token_counts(documents(spark, rows).limit(0), VOCABULARY)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


@pytest.mark.parametrize(
    "capacity,largest,n", [(10, 10, 50), (2048, 2048, 3000), (2048, 400, 5000), (100, 60, 2000), (7, 3, 100), (1, 1, 5)]
)
def test_plan_is_gapless_and_tight(capacity, largest, n):
    rng = random.Random(n)
    counts = Counter(rng.randint(1, largest) for _ in range(n))
    filled, ranks = {}, set()
    for length, first, some, each, sequence, at in packing.plan(dict(counts), capacity):
        for k in range(some):
            filled.setdefault(sequence + k // each, []).append((at + length * (k % each), length))
            ranks.add((length, first + k))
    assert ranks == {(length, k) for length, some in counts.items() for k in range(some)}
    for pieces in filled.values():
        end = 0
        for at, length in sorted(pieces):
            assert at == end
            end += length
        assert end <= capacity
    total = sum(length * some for length, some in counts.items())
    large = sum(some for length, some in counts.items() if 2 * length > capacity)
    assert len(filled) <= 1.02 * max(-(-total // capacity), large) + 3


def test_plan_of_nothing():
    assert packing.plan({}, 8) == []


def test_pack(spark, library):
    rows = [(i, "some words here " * (i % 7) + "end " * (i % 3)) for i in range(60)] + [(100, "long text " * 40)]
    rows += [(1, "another text with the id of one before"), *ODD_ROWS]
    found = packing.pack(documents(spark, rows).repartition(5), VOCABULARY, capacity=16).collect()
    expected = Counter()
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 16)):
            part = np.array(ids[start : start + 16], "<u4")
            expected[(i, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        pieces.sort()
        assert [at for at, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
        assert sum(n for _, n in pieces) <= 16
    total = sum(r.length for r in found)
    assert len(by_sequence) <= -(-total // 16) + 3
    assert packing.pack(documents(spark, rows).limit(0), VOCABULARY).count() == 0


def test_pieces_of_one_word_share_its_ids(library):
    encode = packing.Ids(VOCABULARY)
    texts = ["word Word, WORD!! wörd. WÖRD,;- (word) x\nWord\n\nword's", "İa Ⱥb ŉc ǅd ΑΣ. word<|endoftext|> word<| 12. ,, .", ""]
    for text, ids in zip(texts, encode.of(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert {"word", "wörd"} <= encode.known.keys() and encode.known.keys().isdisjoint(["Word,", "WORD!!", "wörd.", "\nWord"])
    letters = [chr(c) for c in range(0xC0, 0x2B0)]
    texts = [f"a{x} {x}b. {x}" for x in letters]
    for text, ids in zip(texts, encode.of(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_sparing_packing_is_the_same_and_leaves_no_table(spark, monkeypatch):
    made = documents(spark, [*ODD_ROWS, *((i, f"word{i % 40} and some more, " * (i % 90)) for i in range(400))])
    monkeypatch.setattr(packing, "SPARING", 1 << 12)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    plain, sparing = (packing.pack(made, VOCABULARY, 64, sparing=x).select(names).collect() for x in (False, True))
    assert sorted(map(str, plain)) == sorted(map(str, sparing))
    kept = []
    run = packing.pieces(SimpleNamespace(sparkSession=spark, select=lambda *_: SimpleNamespace(mapInArrow=lambda f, _: f)), VOCABULARY, 64, sparing=True)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    for batch in run(iter([pa.record_batch({"doc_id": [1], "text": ["some words"]})])):
        kept.append(len(packing.ids(VOCABULARY).known))
    assert kept[0] > 0 and not packing.ids(VOCABULARY).known and not packing.ids(VOCABULARY).known.old


def test_sparing_packing_keeps_no_words_from_batch_to_batch(monkeypatch):
    monkeypatch.setattr(packing, "text_batches", lambda spark: None)
    monkeypatch.setattr(packing, "SPARING", 1)
    docs = SimpleNamespace(sparkSession=None, select=lambda *_: SimpleNamespace(mapInArrow=lambda run, _: run))
    monkeypatch.setattr(packing, "pick", lambda docs, **_: docs.select())
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run, kept = packing.pieces(docs, VOCABULARY, 64, sparing=True), []
    batches = [pa.record_batch({"doc_id": [i], "text": [f"{word} words, and {word}"]}) for i, word in enumerate(["one", "two"])]
    for _ in run(iter(batches)):
        kept.append({"one", "two"} & packing.ids(VOCABULARY).known.keys())
    assert kept == [{"one"}, {"two"}]
