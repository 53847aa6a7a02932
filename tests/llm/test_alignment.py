from __future__ import annotations

import hashlib
from collections import defaultdict
from types import SimpleNamespace

import pytest

from runlens.llm import alignment, chunks
from runlens.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, QUERIES, read
from runlens.llm.tokens import byte_symbols
from tests.llm.helpers import ODD_ROWS, documents
from tests.llm.test_token_files import spaced_texts
from tests.llm.test_tokens_and_packing import strange_texts
from tests.test_queries import SF_DIR, needs_data

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Tokens as (id, bytes) of both libraries, without anything of the operator's."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_VOCABULARY)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    number = {c: i for i, c in enumerate(byte_symbols())}

    def tokens(text):
        if not text:
            return None
        left = [(i, bytes(number[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            return None
        return left, right

    return tokens


def places(tokens):
    out, at = [], 0
    for name, raw in tokens:
        out.append((name, at, at + len(raw)))
        at += len(raw)
    return out


def described(tokens):
    """Groups as text, number of groups, links."""
    left, right = map(places, tokens)
    links = [(i, j) for i, s, e in left for j, t, f in right if s < f and t < e]
    ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
    groups, last = [], 0
    for end in ends:
        ids = [",".join(str(i) for i, _, e in side if last < e <= end) for side in (left, right)]
        groups.append("|".join(ids))
        last = end
    return ";".join(groups), len(groups), links


def brute(plain, rows):
    made = [(name, plain(text)) for name, text in rows]
    made = [(name, tokens, described(tokens) if tokens else None) for name, tokens in made]
    count = defaultdict(int)
    for _, _, about in made:
        for pair in set(about[2]) if about else ():
            count[pair] += 1
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    out = []
    for name, tokens, about in made:
        if not tokens:
            out.append((name, 0, 0, 0, 0, 0, 0, ""))
            continue
        text, n_groups, links = about
        best = sum(count[x] == highest[x[0]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((name, len(tokens[0]), len(tokens[1]), n_groups, len(links), best, sum(count[x] for x in links), digest))
    return out


def test_groups_in_numbers(spark):
    """é is one token here and two bytes there; 𐍈 is bytes on both sides."""
    found = alignment.groups(documents(spark, [(1, "aé𐍈z"), (2, ""), (None, "a")]), BYTE_VOCABULARY, PIECE_VOCABULARY)
    rows = [tuple(r) for r in found.orderBy("doc_id", "group").collect()]
    assert rows[0][0] is None and rows[0][2:4] == (0, 2)
    ends = [r[3] for r in rows[1:]]
    assert [r[2] for r in rows[1:]] == [0, *ends[:-1]] and ends[-1] == len(" aé𐍈z".encode())
    assert 4 in ends and 8 in ends  # behind é and behind 𐍈


def test_refined_ends():
    made = alignment.aligner(BYTE_VOCABULARY, PIECE_VOCABULARY)
    text = " 🙂é汉字͸ \U000e0041"
    cuts = made.cuts(text)
    assert (cuts.a_ends[1:] > cuts.a_ends[:-1]).all() and (cuts.b_ends[1:] > cuts.b_ends[:-1]).all()
    assert cuts.a_ends[-1] == cuts.b_ends[-1] == len(text.encode())


@pytest.mark.parametrize("kept", [3, 10**6])
def test_pieces_together_are_like_whole_texts(plain, monkeypatch, kept):
    monkeypatch.setattr(alignment, "KEPT", kept)
    monkeypatch.setattr(chunks, "TOGETHER", 60)
    made = alignment.Aligner(BYTE_VOCABULARY, PIECE_VOCABULARY)
    assert made.pieces is not None
    texts = [*strange_texts(800, 4), *spaced_texts(2500, 8), "", " ", "\n", "  x", "x" * 4000, "<s> a</s>", "a▁b c"]
    for at in range(0, len(texts), 40):
        some = texts[at : at + 40]
        for text, parts in zip(some, made.of(some)):
            tokens = plain(text)
            assert (parts is None) == (tokens is None), repr(text)
            if tokens:
                groups, n_groups, links = described(tokens)
                assert ";".join(x.groups for x in parts) == groups, repr(text)
                assert sum(x.n_groups for x in parts) == n_groups
                assert (sum(x.n_a for x in parts), sum(x.n_b for x in parts)) == tuple(map(len, tokens))
                packed = [int(i) for x in parts for i in alignment.np.frombuffer(x.links, made.kind)]
                assert sorted(packed) == sorted(i << made.shift | j for i, j in links)


def test_tokens_are_asked_for_without_their_places(plain, monkeypatch):
    made, asked = alignment.Aligner(BYTE_VOCABULARY, PIECE_VOCABULARY), []
    a, b = made.a, made.b
    some = SimpleNamespace(encode_batch_fast=lambda *x, **y: asked.append("a") or a.encode_batch_fast(*x, **y))
    monkeypatch.setattr(made, "a", some)
    monkeypatch.setattr(made, "b", SimpleNamespace(encode=lambda x: asked.append("b") or b.encode(x)))
    texts = ["word, 🙂é汉字͸ \U000e0041 word's", "x\nword.\n\n<s> \0"]
    for text, parts in zip(texts, made.of(texts), strict=True):
        groups, n_groups, links = described(plain(text))
        assert ";".join(x.groups for x in parts) == groups, repr(text)
        assert sum(x.n_groups for x in parts) == n_groups
    assert set(asked) == {"a", "b"}


@pytest.mark.parametrize("small", [False, True])
def test_align_equals_brute_force(spark, plain, monkeypatch, small):
    if small:
        monkeypatch.setattr(alignment, "BLOCK", 30)
    rows = [(i, x) for i, x in enumerate(spaced_texts(150, 2))]
    rows += [(1000 + i, "a passage that many texts share, é 汉 🙂") for i in range(80)]
    rows += [(2000, "one very long text " * 60), *ODD_ROWS]
    made = alignment.align(documents(spark, rows).repartition(5), BYTE_VOCABULARY, PIECE_VOCABULARY)
    assert made.columns == COLUMNS
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(brute(plain, rows), key=repr)


def test_align_nothing(spark):
    none = documents(spark, [(1, "x")]).limit(0)
    assert alignment.align(none, BYTE_VOCABULARY, PIECE_VOCABULARY).count() == 0
    blank = documents(spark, [(1, None), (2, "")])
    made = alignment.align(blank, BYTE_VOCABULARY, PIECE_VOCABULARY).collect()
    assert sorted(map(tuple, made)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


@needs_data
def test_query_equals_brute_force(spark, plain):
    docs = [tuple(r) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    short = [x for x in docs if len(x[1] or "") < 1500]
    assert len(short) > 50
    made = alignment.align(documents(spark, short), BYTE_VOCABULARY, PIECE_VOCABULARY)
    assert sorted(map(tuple, made.collect())) == sorted(brute(plain, short))
    assert QUERIES["op13_tokenizer_alignment"](spark, SF_DIR).count() == len(docs)
