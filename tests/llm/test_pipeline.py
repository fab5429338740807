"""The pipeline's stages, each on its own input."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm.odd import ROWS, labels, no_documents, odd_documents
from tests.llm.test_operators import check_pieces, expected_ids, groups_by_brute_force

from prodseries.llm import decontamination, near_duplicates, quality_classifier
from prodseries.llm.line_chunks import removed_by_brute_force

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return dict(map(tuple, docs.select("doc_id", "text").collect()))


def kept(spark, name, docs):
    out = STAGES[name](spark, docs, SF)
    assert out.columns == docs.columns
    return {r["doc_id"]: r for r in out.collect()}


def test_quality_keeps_clean_documents(spark, docs):
    rows = kept(spark, "quality_classifier", docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r["doc_id"] in rows for r in labels if r["quality"] and not r["toxic"]]
    assert sum(good) >= 0.97 * len(good)


def test_line_dedup(spark, docs, texts):
    rows = kept(spark, "line_dedup", docs)
    expected = removed_by_brute_force(texts)
    # Documents that lose their last word go.
    gone = {d for d, t in expected.items() if t != texts[d] and not (t or "").strip(" \t\n\x0b\x0c\r")}
    assert gone and {d: r["text"] for d, r in rows.items()} == {d: t for d, t in expected.items() if d not in gone}
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())


def test_near_dedup(spark, docs, texts):
    groups = groups_by_brute_force(texts, 5, 80)
    assert set(kept(spark, "minhash_near_dedup", docs)) == {d for d, (_, root) in groups.items() if d == root}


def test_decontamination(spark, docs, texts):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    bad = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"])
        bad |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(b) for b in bad}
    clean = {d for d, t in texts.items() for w in [words(t)] if not any(tuple(w[i : i + n]) in bad for n in sizes for i in range(len(w) - n + 1))}
    assert set(kept(spark, "decontamination", docs)) == clean


def test_packing(spark, docs, texts):
    check_pieces(STAGES["packing"](spark, docs, SF).collect(), [(d, expected_ids(t)) for d, t in texts.items()], 2048)


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert 0 < pieces.count() and pieces.select("doc_id").distinct().count() < 200


def test_the_chain_leaves_no_copies_and_no_empty_texts(spark, docs, texts):
    """Stage after stage, each written and read again: copies of kept documents are gone."""
    groups = groups_by_brute_force(texts, 5, 80)
    solid = {d for d, t in texts.items() if (t or "").strip()}
    out, sizes = docs, []
    for name, stage in list(corpus_pipeline.STAGES)[:-1]:
        before = {r["doc_id"] for r in out.select("doc_id").collect()}
        out = corpus_pipeline.written(stage(spark, out, SF), name)
        sizes.append((len(before), out.count()))
    left = {r["doc_id"]: r["text"] for r in out.collect()}
    assert all((left[d] or "").strip() for d in left if d in solid)
    copies = {d for d, (_, root) in groups.items() if d != root and texts[root] == texts[d]}
    assert copies and len(copies & set(left)) <= 0.1 * len(copies)
    assert len(left) > len(texts) // 2


def test_stages_drop_what_earlier_ones_wrote(spark, docs, tmp_path):
    import glob

    first = STAGES["line_dedup"](spark, docs, SF)
    path = str(tmp_path / "docs")
    first.write.parquet(path)
    spent = list(corpus_pipeline._SPENT[spark.sparkContext.applicationId])
    assert spent and all(glob.glob(f"{p}/*.parquet") for p in spent)
    # Documents that still come from such tables keep them.
    STAGES["minhash_near_dedup"](spark, first, SF).count()
    assert all(glob.glob(f"{p}/*") for p in spent)
    STAGES["minhash_near_dedup"](spark, spark.read.parquet(path), SF).count()
    assert not any(glob.glob(f"{p}/*") for p in spent)


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_and_empty(spark, name):
    docs = odd_documents(spark)
    out = STAGES[name](spark, docs, SF)
    if name != "packing":
        assert out.columns == docs.columns and out.count() <= len(ROWS)
    assert out.count() > 0
    assert STAGES[name](spark, no_documents(spark), SF).count() == 0


def rows_of(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_near_dedup_keeps_one_row_without_ids(spark):
    words = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(reversed(words))
    rows = [(None, near), (7, text), (None, other), (None, other), (None, other + " more"), (None, "single one here"), (None, None), (8, other.replace("w", "v"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(near_duplicates.one_of_each(docs, 5, 80))
    assert [r for r in found if r[0] is not None] == [(7, text), (8, other.replace("w", "v"))]
    nameless = [t for d, t in found if d is None]
    assert len(nameless) == 3 and {None, "single one here"} < set(nameless) and set(nameless) & {other, other + " more"}
    got = near_duplicates.near_duplicates(docs, 5, 80).filter("doc_id is null and component_id = 7").collect()
    assert [r["kept"] for r in got] == [False]


def test_odd_rows_that_near_dedup_keeps(spark):
    kept = near_duplicates.one_of_each(odd_documents(spark), 5, 80)
    assert groups_by_brute_force(dict(ROWS[:2]), 5, 80)[1][1] == 0
    gone = [ROWS[1], *[(8, ROWS[8][1])] * 2, (10, ROWS[11][1]), (None, ROWS[12][1])]
    left = list(ROWS)
    for row in gone:
        left.remove(row)
    assert rows_of(kept) == sorted(left, key=str)


def test_rows_without_ids_are_decontaminated(spark):
    words = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, f"x {words} y"), (None, "clean"), (None, None), (1, words), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    assert rows_of(decontamination.decontaminated(docs, items)) == sorted([(None, "clean"), (None, None), (2, "clean")], key=str)


def test_rows_without_ids_are_judged_one_by_one(spark, monkeypatch):
    def evidence(rows, model):
        return rows.select("doc_id", "host", "path", *[c for c in rows.columns if c == "key"], F.when(F.col("text") == "bad", -9.0).otherwise(9.0).alias("evidence"))

    monkeypatch.setattr(quality_classifier, "with_evidence", evidence)
    rows = [(None, "good"), (None, "bad"), (None, None), (1, "good"), (2, "bad")]
    docs = spark.createDataFrame([(*r, "src", "en") for r in rows], "doc_id long, text string, source string, lang string")
    kept = quality_classifier.kept_documents(docs, labels(spark), F.col("source"), F.col("lang"))
    assert rows_of(kept) == sorted([(None, "good"), (None, None), (1, "good")], key=str)
