"""The pipeline's stages, each on a table of edge cases against plain Python, and all in turn."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from farebox.llm import catalog, quality, stages

SCHEMA = (
    "doc_id long, text string, lang string, n_chars long, n_tokens string, ids string, round_trip string, decoded string, "
    "n_lines long, n_dropped string, kept_text string, kept boolean, row string, n_words long, items string, features string"
)
EXTRA = (None, "ids", "rt", None, 5, "dropped", "mine", False, "row", 7, "items", "f")
ITEMS = [(1, " ".join(f"geheim{i}" for i in range(14))), (2, "one short item"), (3, None), (None, "...")]


def fixture_rows():
    draw = random.Random(21)
    word = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("a", "en", "ist", "oru", "ung", "ile")]

    def text(n):
        return " ".join(draw.choice(word) for _ in range(n))

    rows = []
    for i in range(60):
        body = "\n".join(text(draw.randrange(8, 30)) for _ in range(4))
        rows.append((i, f"{body}\nAll rights reserved by the owners of this site" if i % 2 else body))
    rows += [(100, rows[3][1]), (101, rows[3][1] + " mehr"), (3, rows[3][1]), (102, None), (103, ""), (None, text(60)), (None, text(70)), (None, None)]
    rows += [(104, f"{text(40)} {ITEMS[0][1]} {text(5)}"), (105, f"{text(30)} One, short item! {text(3)}"), (106, "geheim0 " * 50), (107, "漢字 é " * 30)]
    rows += [(108, rows[1][1]), (1, rows[1][1])]
    return rows


ROWS = fixture_rows()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(d, t, "xx", None if t is None else len(t), *EXTRA) for d, t in ROWS]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


def good(spark, rows, folder, docs):
    trees = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    out = []
    for d, t in rows:
        counts, features = quality.statistics([(t or "").encode()])
        assert tuple(counts[0]) == brute.statistics(t)
        failed = counts[0][0] < 20 or 100 * counts[0][4] > 30 * counts[0][0]
        if not failed and 1 / (1 + np.exp(-trees.score(features)[0])) <= 0.5:
            out.append((d, t))
    return out


def without_lines(rows):
    return [(d, t) for d, _, n, t in brute.line_dedup(rows) if not n or brute.WORD.search(t)]


def one_of_each(rows):
    kept, seen = [], set()
    classes = brute.near_duplicates(rows)
    for (d, t), (_, root, _) in sorted(zip(rows, classes, strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        same = (root, t if d is None else None)
        if not brute.words(t) or same not in seen:
            kept.append((d, t))
            seen.add(same)
    return kept


def clean(rows):
    return [r for r, found in zip(rows, brute.contamination(rows, ITEMS), strict=True) if not found[-1]]


def test_quality_rules(spark, folder, docs):
    out = stages.quality_rules(spark, docs, folder)
    assert out.schema == docs.schema and texts_of(out) == ordered(good(spark, ROWS, folder, docs))


def test_line_dedup(spark, folder, docs):
    out = stages.line_dedup(spark, docs, folder)
    assert out.schema.names == docs.schema.names and texts_of(out) == ordered(without_lines(ROWS))
    assert out.filter("n_chars <> length(text) OR (n_chars IS NULL) <> (text IS NULL)").count() == 0
    assert {tuple(r) for r in out.select("n_lines", "n_dropped", "kept_text", "row").collect()} == {(5, "dropped", "mine", "row")}
    assert without_lines(ROWS) != ROWS


def test_near_duplicates(spark, folder, docs):
    out = stages.near_duplicates(spark, docs, folder)
    assert out.schema == docs.schema and texts_of(out) == ordered(one_of_each(ROWS))


def test_decontamination(spark, folder, docs):
    out = stages.decontamination(spark, docs, folder)
    assert out.schema.names == docs.schema.names and texts_of(out) == ordered(clean(ROWS)) and len(clean(ROWS)) == len(ROWS) - 2


def encoded(rows):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(catalog.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return [(d, x, np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes()) for d, x in rows]


def test_bpe_encoding(spark, folder, docs):
    out = stages.bpe_encoding(spark, docs, folder)
    assert ordered((r.doc_id, r.text, bytes(r.ids)) for r in out.collect()) == ordered(encoded(ROWS))
    assert out.filter("NOT round_trip OR n_tokens <> octet_length(ids) / 4").count() == 0
    assert out.columns == [c for c in docs.columns if c not in ("ids", "n_tokens", "round_trip", "decoded")] + ["ids", "n_tokens", "round_trip"]


def test_all_in_turn(spark, folder, docs):
    rows = clean(one_of_each(without_lines(good(spark, ROWS, folder, docs))))
    out = corpus_pipeline.run(spark, folder)
    assert ordered((r.doc_id, r.text, bytes(r.ids)) for r in out.collect()) == ordered(encoded(rows))
    assert 20 < len(rows) < len(ROWS)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_nothing_in_nothing_out(spark, folder, docs, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs.filter(F.lit(False)), folder)
    assert out.count() == 0
