from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.helpers import near_components

LABELS = "doc_id long, quality int, toxic int"


def written(spark, folder):
    """A small folder of tables with planted junk, copies, lines and benchmark passages."""
    rng = random.Random(0)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(800)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, prose(20)) for i in range(5)]
    common = prose(30)
    rows, labels = [], []
    for i in range(400):
        kind, text = i % 8, "\n".join(prose(rng.randint(10, 40)) for _ in range(3))
        if kind == 1:
            text = " ".join(w + "###" for w in text.split())
        elif kind == 2:
            text += f"\n{common}"
        elif kind == 3 and i > 8:
            text = rows[i - 3][1].replace("\n", " ") + " end"
        elif kind == 4:
            text = f"{prose(12)} {rng.choice(items)[1]} {prose(12)}"
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, int(kind != 1), 0))
    rows += [(None, "a text without id " + prose(30), "en", None, 5), (900, None, None, "s", None), (901, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, dict((i, y) for i, y, _ in labels), items, common


def test_stages(spark, tmp_path):
    rows, good, items, common = written(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == names
        found = {r.doc_id: r.text for r in docs.collect()} if k < 4 else {}
        if name == "quality classifier":
            assert not [i for i in found if good.get(i) == 0] and all(i in found for i, y in good.items() if y)
        elif name == "line dedup":
            holders = [i for i, t in found.items() if t and common in t]
            assert holders == [2]
            assert all((r.n_chars == len(r.text)) for r in docs.collect() if r.doc_id is not None and r.text)
        elif name == "n-gram Jaccard join":
            parts = near_components([(r.doc_id, r.text) for r in before.collect() if r.doc_id is not None])
            assert {i for i in found if i is not None} == {i for i, (_, part) in parts.items() if i == part}
            assert None in found
        elif name == "benchmark decontamination":
            leaked = {r.doc_id for r in before.collect() if any(x in (r.text or "") for _, x in items)}
            assert leaked and {r.doc_id for r in before.collect()} - leaked == set(found)
    assert sorted(docs.columns) == sorted("doc_id piece start length ids_crc32 sequence_id offset".split())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == sorted(
        map(str, docs.drop("sequence_id", "offset").collect())
    )


def test_empty_tables(spark, tmp_path):
    rows, *_ = written(spark, tmp_path / "full")
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/full/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
