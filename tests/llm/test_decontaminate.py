from __future__ import annotations

import pytest

from runlens.llm import decontaminate
from tests.llm.helpers import ODD_ROWS, documents

ITEM = "A farmer named Alice has 12 apples and gives 3 apples to Bob before walking 5 km home with 9 apples."


@pytest.fixture()
def benchmark(spark):
    rows = [(1, ITEM, "x"), (2, "Six plain words stand right here", "x"), (3, "too short", "x"), (4, "", "x"), (5, None, "x"), (1, ITEM, "x")]
    return spark.createDataFrame(rows, "item_id long, text string, row string")


@pytest.mark.parametrize(
    "text,found",
    [
        (f"Words before. {ITEM} Words after.", [(1, False)]),
        (ITEM.lower().replace(",", " -- "), [(1, False)]),
        ("A farmer named Carol has 40 apples and gives 7 apples to Dave before walking 8 miles home with 33 apples.", [(1, True)]),
        # One value for several that differ is another question.
        ("A farmer named Alice has 12 apples and gives 12 apples to Bob before walking 12 km home with 12 apples.", []),
        ("here: six plain, words stand right HERE!", [(2, False)]),
        ("it was too short for all of us", []),
        ("First line\n - Too short -\nanother", [(3, False)]),
        ("Was it long? TOO, short! So they say.", [(3, False)]),
        ("too short", [(3, False)]),
        ("too short they say. It is too short", []),
        ("A farmer has apples and gives some apples to others before walking home", []),
        ("A farmer named Alice has 12 apples and", []),
        ("1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17", []),
    ],
)
def test_items_in_texts(spark, benchmark, text, found):
    rows = decontaminate.leaks(documents(spark, [(7, text)]), benchmark).collect()
    assert [(r.item_id, r.changed) for r in rows] == found


def test_items_of_one_word_are_lines(spark):
    benchmark = spark.createDataFrame([(1, "Photosynthesis"), (2, "42")], "item_id long, text string")
    rows = [(1, "a\nphotosynthesis.\nb"), (2, "It is. Photosynthesis. Yes."), (3, "42"), (4, "It is 42"), (5, "43")]
    found = decontaminate.leaks(documents(spark, rows), benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.covered) for r in found) == [(1, 1, 1), (3, 2, 1)]


def test_odd_rows(spark, benchmark):
    docs = documents(spark, [*ODD_ROWS, (None, ITEM), (1, ITEM), (1, ITEM), (1, "other text"), (2, f"{ITEM} {ITEM}")])
    found = decontaminate.leaks(docs, benchmark).collect()
    assert sorted(((r.doc_id, r.item_id, r.places) for r in found), key=repr) == [(1, 1, 1), (2, 1, 2), (None, 1, 1)]
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([*ODD_ROWS, (1, "other text")], key=repr)
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_every_planted_passage_is_found(spark):
    """Against a plain search for the words of each item, over generated texts."""
    import random

    rng = random.Random(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(8, 40)))) for i in range(30)]
    rows = []
    for i in range(120):
        text = rng.choices(words, k=rng.randint(0, 200))
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(items)[1].split()
        rows.append((i, " ".join(text)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = {(i, k) for i, t in rows for k, x in items if f" {x} " in f" {t} "}
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, rows), bench).collect()}
    assert found == expected and expected


def test_items_of_numbers_are_found_as_exact_copies(spark):
    items = [(1, "Compute 3 4 5 6 2 11 3 8 9 40 7"), (2, "Sort these four numbers here 8 1 9 4 7 2 5")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, f"Now: {items[0][1]}, at once."),
        (2, f"Now: {items[1][1]}, at once."),
        # Other values in a stretch of nothing else are no evidence.
        (3, "Now: compute 4 3 6 5 1 12 2 9 8 30 6, at once."),
    ]
    found = decontaminate.leaks(documents(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.changed) for r in found) == [(1, 1, False), (2, 2, False)]


NAMES = [
    (1, "Tom has 12 apples. Tom gives 3 to Ann."),
    (2, "New York is a city where every winter brings 30 days of snow. Then Mary walks 4 km over the bridge to New York again."),
]


@pytest.mark.parametrize(
    "text,found",
    [
        ("Jim has 15 apples. Jim gives 4 to Eve.", [(1, True, 9, 1)]),
        (NAMES[0][1], [(1, False, 9, 1)]),
        ("Jim has 15 apples. Bob gives 4 to Eve.", []),
        ("Paris is a city where every winter brings 20 days of snow. Then Anna Maria walks 6 km over the bridge to Paris again.", [(2, True, 25, 1)]),
        (f"{NAMES[1][1]} {NAMES[1][1]}", [(2, False, 25, 2)]),
    ],
)
def test_names_at_starts_and_of_several_words(spark, text, found):
    bench = spark.createDataFrame(NAMES, "item_id long, text string")
    rows = decontaminate.leaks(documents(spark, [(7, text)]), bench).collect()
    assert [(r.item_id, r.changed, r.covered, r.places) for r in rows] == found
