"""Each corpus operator on edge cases, empty tables and small fixtures, against plain Python."""

from __future__ import annotations

import gzip
import random
import tracemalloc
import unicodedata

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from farebox.llm import bpe, catalog, contamination, frames, jaccard, licenses, lines, quality, sql, substrings, suffixes, urls, warc

ROWS = brute.EDGES


def pairs(df, *columns):
    """Rows as tuples, in an order that does not mind nulls."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def edges(spark):
    return brute.edge_table(spark).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return brute.edge_table(spark, [])


def extra_kept(df, replaced=()):
    return [c for c in brute.EXTRA if c not in replaced] == [c for c in df.columns if c in brute.EXTRA and c not in replaced]


# ------------------------------------------------------------------ line dedup
def test_lines_drop_recurring_templates(spark):
    rows = [(i, f"Page {i} of 30 printed for reader\nbody{chr(97 + i)} with own words {i * 7}\nlast {chr(97 + i)}") for i in range(25)]
    rows += [(100, "Page one of these printed for nobody"), (101, None), (102, ""), (103, "\n\n")]
    out = {r.doc_id: r for r in lines.drop_recurring_lines(brute.edge_table(spark, rows)).collect()}
    assert out[0].n_dropped == 0 and out[0].kept_text == rows[0][1]  # the first stays
    assert all(out[i].n_dropped == 1 and out[i].kept_text == rows[i][1].split("\n", 1)[1] for i in range(1, 25))
    assert out[100].n_dropped == 0 and out[101].kept_text is None and out[101].n_lines == 0
    assert out[102].kept_text == "" and out[102].n_lines == 1 and out[103].n_lines == 3


def test_lines_of_copies_are_not_boilerplate(spark):
    copy = "\n".join(f"line {chr(97 + i)} of the copied text" for i in range(5))
    out = lines.drop_recurring_lines(brute.edge_table(spark, [(i, copy) for i in range(40)]))
    assert out.filter("n_dropped > 0").count() == 0


def dropped(spark, rows):
    out = lines.drop_recurring_lines(brute.edge_table(spark, rows))
    return {r.doc_id: r.n_dropped for r in out.collect()}


def letters(i):
    return chr(97 + i // 26) + chr(97 + i % 26)


@pytest.mark.parametrize("line", [
    "第{i}段は一つの別の文です", "x{i}=2;", "    y{i}=2;", "a{x}\t{i}\tb{x}", "{i} {i}.5", "{i} 7 8 9 1 {i}", "we went to {x}", "we went to {x} and{x} too{x}",
])
def test_different_lines_are_no_template(spark, line):
    rows = [(i, f"own {letters(i)}\n{line.format(i=i, x=letters(i))}\nend {letters(i)}") for i in range(60)]
    assert set(dropped(spark, rows).values()) == {0}


def test_lines_of_blocks_and_between_blank_lines_are_dropped(spark):
    block = ["We use cookies on this site", "Read our notice to learn more", "Accept all of them or none"]
    rows = [(i, "\n\n".join([f"own {letters(i)} text{letters(i)} of{letters(i)} some length{letters(i)}", *block])) for i in range(40)]
    rows += [(100 + i, "\n".join([*block, f"a{letters(i)} text{letters(i)} with{letters(i)} words of its own"])) for i in range(40)]
    got = dropped(spark, rows)
    assert got.pop(0) == 0 and set(got.values()) == {3}


def test_lines_of_near_copies_are_not_boilerplate(spark):
    rows = [(i, "\n".join(f"line {chr(97 + j)} of the copied text" for j in range(12)) + f"\nseen by {letters(i)}") for i in range(40)]
    assert set(dropped(spark, rows).values()) == {0}


def test_a_leaf_holds_many_templates(spark):
    """Three of like frequency, one with a word and a number that vary, among ordinary lines that start alike."""
    kinds = [
        "You can also find us in the yellow house by the river", "You can also write to our office for a printed price list",
        "You can also reach {x} on line {i} from nine until late today",
    ]
    rows = [(i, f"own {letters(i)} some text{letters(i)}\n{kinds[i % 3].format(x=letters(i), i=i)}") for i in range(90)]
    rows += [(100 + i, " ".join(["You can also", *(f"{w}{letters(i)}" for w in "pqrstuvwx")]) + f"\nown {letters(i)}") for i in range(90)]
    got = dropped(spark, rows)
    assert [sum(got[i] for i in range(k, 90, 3)) for k in range(3)] == [29, 29, 29] and sum(got.values()) == 87


def test_lines_that_recur_themselves_are_dropped(spark):
    rows = [(i, f"own {letters(i)}\n2024\nend {letters(i)}\n1  2 \t3 4\r\nlast {letters(i)}") for i in range(60)]
    assert [dropped(spark, rows)[i] for i in (0, 1, 59)] == [0, 2, 2]


def line_rows():
    """Boilerplate of several kinds among ordinary lines, copies, blank and odd lines."""
    draw = random.Random(12)
    word = [f"w{letters(i)}" for i in range(200)]
    block = ["We use cookies on this site", "Read our notice to learn more", "Accept all of them or none"]
    kinds = ["You can also find us in the yellow house by the river", "You can also write to our office for a printed price list", "You can also call {i} or {x} until late today my friend"]
    rows = []
    for i in range(150):
        own = [" ".join(draw.choice(word) for _ in range(draw.randrange(1, 12))) for _ in range(draw.randrange(1, 6))]
        extra = [*(block if i % 3 == 0 else []), kinds[i % 3].format(i=i, x=draw.choice(word)), f"Page {i} of 150", draw.choice(["2024", "* * *", " ", "x1", "a\tb  c"])]
        at = [*own, *extra]
        draw.shuffle(at)
        rows.append((i, draw.choice(["\n", "\n\n", "\r\n"]).join(at)))
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300, None), (301, ""), (302, "\n \n"), (303, rows[4][1])]
    return rows


def test_lines_against_brute_force_and_sql(spark, tmp_path):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = lines.drop_recurring_lines(df)
    got = pairs(out, "doc_id", "n_lines", "n_dropped", "kept_text")
    want = brute.line_dedup(rows)
    assert got == ordered(want) and sum(r[2] for r in want) > 300
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql_rows = con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({sql.LINES})").fetchall()
    assert ordered(sql_rows) == ordered((d, n, k, brute.sha(t or "")) for d, n, k, t in want)


def test_lines_edges(edges, nothing):
    out = lines.drop_recurring_lines(edges, min_docs=2, min_contexts=1)
    assert out.count() == len(ROWS) and extra_kept(out, ("kept_text",))
    assert lines.drop_recurring_lines(nothing).count() == 0


# ------------------------------------------------------------- near duplicates
@pytest.mark.parametrize("options", [{}, {"limit": 2, "block": 2, "last_level": 3}])
def test_near_duplicates(edges, options):
    got = pairs(jaccard.classes_of(edges, **options), "doc_id", "class_id", "n_links")
    assert got == ordered(brute.near_duplicates(ROWS))


def test_one_of_each_group_stays(edges, nothing):
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    classes = {c for _, c, _ in brute.near_duplicates(ROWS)}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(c for c in classes if c is not None)
    assert jaccard.classes_of(nothing).count() == 0 and jaccard.keep_one(nothing).count() == 0


def test_null_and_repeated_ids_do_not_join_classes(spark):
    a, b, c, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abce")
    rows = [(None, a), (None, b), (1, a), (2, b), (3, c), (3, e), (4, e)]
    df = brute.edge_table(spark, rows)
    kept = pairs(jaccard.keep_one(df), "doc_id", "text")
    assert kept == ordered([(None, a), (None, b), (3, c), (3, e)])
    assert pairs(jaccard.classes_of(df), "doc_id", "class_id", "n_links") == ordered(brute.near_duplicates(rows))


def test_rows_without_words_stay_whatever_else_is_repeated(spark):
    words_of = " ".join(f"w{i}" for i in range(30))
    rows = [(None, None), (None, None), (None, ""), (7, ""), (7, ""), (1, words_of)]
    for more in ([], [(1, words_of)], [(2, words_of)]):
        kept = pairs(jaccard.keep_one(spark.createDataFrame(rows + more, "doc_id long, text string")), "doc_id", "text")
        assert kept == ordered(rows)


def test_the_first_of_repeated_rows_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text, x) for x in "cabab"], "doc_id long, text string, extra string")
    assert [r.extra for r in jaccard.keep_one(df.repartition(4)).collect()] == ["a"]


# differs from its counterpart in every letter, and has the same polynomial hash modulo 2**64 for any odd base
THUE = "ab"
while len(THUE) < 2048:
    THUE += THUE.translate(str.maketrans("ab", "ba"))
MORSE = THUE.translate(str.maketrans("ab", "ba"))


def test_texts_that_collide_modulo_a_power_of_two_are_told_apart(spark):
    filler = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join([*filler[:25], THUE, *filler[25:]])), (2, " ".join([*filler[:25], MORSE, *filler[25:]])), (3, f"{THUE}\n{MORSE}\n{THUE}")]
    df = brute.edge_table(spark, rows)
    assert pairs(quality.with_statistics(df), "doc_id", *quality.COUNTS) == ordered((d, *brute.statistics(t)) for d, t in rows)
    out = substrings.remove_repeats(df).withColumn("s", substrings.digest(F.col("kept_text")))
    assert pairs(out, "doc_id", "n_words", "n_removed", "s") == ordered(brute.word_repeats(rows))
    near = [(1, f"{THUE} {THUE}"), (2, f"{MORSE} {MORSE}")]
    assert pairs(jaccard.classes_of(brute.edge_table(spark, near)), "doc_id", "class_id", "n_links") == [(1, 1, 0), (2, 2, 0)]


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold in a crowd of near copies."""
    draw = random.Random(5)
    base = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(w if draw.random() > 0.02 else f"n{draw.randrange(10**6)}" for w in base)) for i in range(120)]
    got = pairs(jaccard.classes_of(brute.edge_table(spark, rows)), "doc_id", "class_id", "n_links")
    want = ordered(brute.near_duplicates(rows))
    assert sum(r[2] for r in got) >= 0.99 * sum(r[2] for r in want)
    assert jaccard.runs_for(0.999, 0.8) == 5


def test_runs_hold_the_recall_at_the_last_level():
    draw = random.Random(9)
    pairs_at, runs = 400, jaccard.runs_to(0.9999, 0.8, 6)
    assert runs == 21 and jaccard.missed(0.8, 6, runs) <= 1e-4 < jaccard.missed(0.8, 6, jaccard.runs_for(0.9999, 0.8))
    agree = np.array([[draw.random() < 0.8 for _ in range(jaccard.TOKENS)] for _ in range(pairs_at)])
    a = np.arange(agree.size, dtype=np.uint64).reshape(agree.shape)
    b = np.where(agree, a, a + np.uint64(10**9))
    met = np.zeros(pairs_at, bool)
    for root in jaccard.mixed(np.arange(1, runs + 1, dtype=np.uint64)):
        nodes = []
        for tokens in (a, b):
            row, key = np.arange(pairs_at), np.full(pairs_at, root)
            for _ in range(6):
                at, key = jaccard.children(key, tokens[row], 0.8)
                row = row[at]
            nodes.append({*zip(row.tolist(), key.tolist(), strict=True)})
        met[[r for r, _ in nodes[0] & nodes[1]]] = True
    assert met.all()


def test_pairs_of_two_blocks_count_once():
    sets = [np.arange(10, dtype=np.uint64)] * 4
    keys = [np.array([1, 5], np.int64)] * 4
    block = np.array([0, 0, 1, 1])
    links, first = jaccard.links_within(1, 0, 1, block, np.ones(4), keys, sets, 0.8)
    assert links.tolist() == [2, 2, 2, 2] and set(first.tolist()) == {0}
    links, _ = jaccard.links_within(5, 0, 0, block * 0, np.ones(4), keys, sets, 0.8)
    assert links.tolist() == [0, 0, 0, 0]  # counted under the smaller key


def test_rows_meet_their_buckets_once_per_level(spark, monkeypatch):
    """Large buckets are split from the rows that have met them: no second join with all rows."""
    written = []

    def noted(df, label, *rest):
        written.append((label, df._jdf.queryExecution().optimizedPlan().toString().count("Join ")))
        return frames.stored(df, label, *rest)

    monkeypatch.setattr(jaccard, "stored", noted)
    rows = [(i, " ".join(f"t{j}" for j in range(40)) + f" e{i}") for i in range(12)]
    docs = brute.edge_table(spark, rows)
    assert pairs(jaccard.classes_of(docs, limit=3, last_level=4), "doc_id", "class_id", "n_links") == ordered(brute.near_duplicates(rows))
    assert {n for label, n in written if label == "split-nodes"} == {1}
    assert {n for label, n in written if label == "members"} == {1}


# ------------------------------------------------------ memory of Python workers
def test_statistics_hold_a_bounded_multiple_of_a_chunk():
    texts = pa.array([f"word{i} " * 300 for i in range(1500)])  # 4 MB
    tracemalloc.start()
    try:
        quality._batch(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < texts.nbytes + (50 << 20)


def test_functions_of_columns_get_large_batches_in_slices(spark):
    batch = pa.record_batch({"k": pa.array(range(1000)), "t": pa.array(["x" * 1000] * 1000)})
    parts = list(frames.slices(batch, 1, 100_000))
    assert max(p.num_rows for p in parts) < 110 and pa.Table.from_batches(parts).combine_chunks().to_batches()[0].equals(batch)
    assert [p.num_rows for p in frames.slices(batch, 1, 10)] == [1] * 1000
    assert list(frames.slices(batch.slice(0, 0), 1)) == []
    df = spark.range(3000).select("id", F.repeat(F.lit("ab"), 5000).alias("t")).coalesce(1)
    sizes = frames.with_columns(df, "t", {"n": "bigint"}, lambda: lambda c: [pa.array([len(c)] * len(c), pa.int64())])
    most, rows = sizes.agg(F.max("n"), F.count("*")).first()
    assert most * 10_000 <= frames.SLICE_BYTES and rows == 3000


def test_letters_newer_than_the_vocabulary_are_found_block_by_block():
    bpe._newer_characters.cache_clear()
    tracemalloc.start()
    try:
        found = bpe._newer_characters()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    every = (chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    assert found == "".join(c for c in every if unicodedata.category(c) == "Cn" and bpe.regex.match(r"[\p{L}\p{N}]", c))
    assert peak < 2 << 20


# ------------------------------------------------------------- substring dedup
@pytest.mark.parametrize("hot", [suffixes.HOT, 1])
def test_byte_substrings(edges, hot):
    out = suffixes.remove_repeated(edges, hot=hot).withColumn("s", F.sha2("kept_bytes", 256))
    want = [(r[0], *x) for r, x in zip(ROWS, brute.byte_repeats([t for _, t in ROWS]), strict=True)]
    assert pairs(out, "doc_id", "n_bytes", "n_removed", "n_spans", "s") == ordered(want)
    assert extra_kept(out)


def test_byte_substrings_of_short_length(spark):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choice("ab") for _ in range(draw.randrange(60)))) for i in range(60)]
    out = suffixes.remove_repeated(brute.edge_table(spark, rows), length=12).withColumn("s", F.sha2("kept_bytes", 256))
    want = [(r[0], *x) for r, x in zip(rows, brute.byte_repeats([t for _, t in rows], 12), strict=True)]
    assert pairs(out, "doc_id", "n_bytes", "n_removed", "n_spans", "s") == ordered(want)


def test_word_substrings(edges):
    out = substrings.remove_repeats(edges).withColumn("s", substrings.digest(F.col("kept_text")))
    assert pairs(out, "doc_id", "n_words", "n_removed", "s") == ordered(brute.word_repeats(ROWS))
    assert extra_kept(out, ("kept_text",))


def test_word_substrings_of_short_windows(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randrange(40)))) for i in range(60)]
    out = substrings.remove_repeats(brute.edge_table(spark, rows), window=6).withColumn("s", substrings.digest(F.col("kept_text")))
    assert pairs(out, "doc_id", "n_words", "n_removed", "s") == ordered(brute.word_repeats(rows, 6))


def test_substrings_of_nothing(nothing):
    assert suffixes.remove_repeated(nothing).count() == 0
    assert substrings.remove_repeats(nothing).count() == 0


# --------------------------------------------------------------------- licenses
def test_license_edges(edges, nothing):
    got = {r.doc_id: r for r in licenses.license_scan(edges, ["doc_id"]).collect()}
    assert licenses.license_scan(edges, ["doc_id"]).count() == len(ROWS)
    r = got[14]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (5, 1, 15, "apache,cc-by,gpl,mit")
    assert got[15].n_base == 0 and got[6].n_words == 0 and got[7].labels == "" and got[6].first_word is None
    assert licenses.license_scan(nothing, ["doc_id"]).count() == 0


def test_license_templates_bear_changes(spark):
    rows = [
        (1, "Permission is hereby granted, free of charge, to any other person obtaining a copy of this software"),
        (2, "Permission is granted"),
        (3, "Licensed under the Apache License, Version 2.0"),
    ]
    got = {r.doc_id: r for r in licenses.license_scan(brute.edge_table(spark, rows), ["doc_id"]).collect()}
    assert got[1].labels == "mit-text" and 0.7 <= got[1].score < 1 and got[1].n_base == 0
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == "apache,apache-2.0-notice" and got[3].base_labels == "apache"


def test_chance_pairs_do_not_stretch_a_place(spark):
    """Pairs of a notice that go on behind it, or stand about, neither hide it nor make one."""
    rows = [
        (1, "licensed under cc by nc 4 0 " + "4 0 " * 15), (2, "4 0 " * 15 + "licensed under cc by nc 4 0"), (3, "4 0 " * 40),
        (4, "licensed under cc by sa 4 0"), (5, " ".join(f"{w} pad pad" for w in "licensed under cc by nc 4 0".split())),
    ]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(brute.edge_table(spark, rows), ["doc_id"]).collect()}
    assert got == {1: ("cc-by,cc-by-nc-notice", 1.0), 2: ("cc-by,cc-by-nc-notice", 1.0), 3: ("", 0.0), 4: ("cc-by,cc-by-sa-notice", 1.0), 5: ("", 0.0)}


# ------------------------------------------------------------------------- WARC
def test_warc_round_trip(spark, tmp_path):
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 120
    rows = [
        (1, "http://a.example/", long), (2, "http://b.example/", long), (3, None, long), (4, "http://c.example/", "x"),
        (5, "http://d.example/\r\nX: 1", "x"), (6, "u", None), (None, "n", long), (None, "n", "short"), (7, "u", "y" * 2000), (7, "u", "y" * 2000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w", archive_bytes=4000)
    found = warc.read_archives(spark, f"{tmp_path}/w").cache()
    nested = warc.assemble(found)
    assert nested.filter("request IS NULL OR metadata IS NULL").count() == 0
    out = pairs(warc.page_table(nested), "page_id", "record_type", "refers_to")
    assert out == ordered([
        (1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (4, "response", None), (5, "response", None),
        (6, "response", None), (None, "revisit", 3), (None, "response", None), (7, "response", None), (7, "response", None),
    ])
    contents = {bytes(r.payload).decode() for r in nested.select("response.*").filter("record_type = 'response'").collect()}
    assert contents == {long, "x", "", "short", "y" * 2000}
    sizes = {r.payload_bytes for r in warc.page_table(nested).filter("record_type = 'revisit'").collect()}
    assert sizes == {len(long.encode())}


def test_archives_of_others(spark, tmp_path):
    """No space behind a colon, names in other cases, bytes that are no text, blank lines, a record of two captures."""
    def record(kind, record_id, body, *more):
        head = "\r\n".join(["WARC/1.1", f"WARC-Type:{kind}", f"warc-record-id: {record_id}", *more, f"Content-length:{len(body)}"])
        return head.encode() + b"\r\n\r\n" + body

    http = b"HTTP/1.1 200 OK\r\nContent-Length:4\r\n\r\n"
    data = b"\r\n\r\n".join([
        record("response", "<a>", http + b"\xff\x00\xfe!", "X:"), record("response", "<b>", http + b"body"),
        record("revisit", "<c>", http, "WARC-Refers-To: <a>"),
        record("metadata", "<m>", b"pageId: 5\r\n", "WARC-Concurrent-To: <a>", "WARC-Concurrent-To: <b>"),
        record("metadata", "<n>", b"", "WARC-Concurrent-To: <gone>"), record("warcinfo", "<i>", b"x"),
    ]) + b"\r\n\r\n\r\n\n"
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "part.gz").write_bytes(gzip.compress(data[:200]) + gzip.compress(data[200:]))
    found = warc.read_archives(spark, f"{tmp_path}/w")
    nested = {r.capture_id: r for r in warc.assemble(found).collect()}
    assert set(nested) == {"<a>", "<b>", "<c>"} and bytes(nested["<a>"].response.payload) == b"\xff\x00\xfe!"
    assert nested["<a>"].metadata.record_id == "<m>" == nested["<b>"].metadata.record_id and nested["<c>"].metadata is None
    assert nested["<a>"].metadata.fields["warc-concurrent-to"] == "<a>, <b>"
    assert nested["<c>"].response.payload_bytes == 4 and nested["<c>"].response.refers_to == "<a>"
    with pytest.raises(ValueError, match="no whole record"):
        list(warc.parse(data[:150]))


def test_warc_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w")
    assert warc.page_table(warc.assemble(warc.read_archives(spark, f"{tmp_path}/w"))).count() == 0


# ---------------------------------------------------------------------- quality
def test_statistics(edges):
    got = pairs(quality.with_statistics(edges), "doc_id", *quality.COUNTS)
    assert got == ordered((d, *brute.statistics(t)) for d, t in ROWS)


def test_scores_never_fall_on_rising_features():
    draw = np.random.default_rng(1)
    x = draw.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (draw.random(800) < 0.2)).astype(float)
    trees = quality.fit(x, y, np.array([True, False, True]), trees=25)
    grid = np.linspace(-1, 2, 200)
    for base in x[:40]:
        for j in (0, 2):
            row = np.tile(base, (200, 1))
            row[:, j] = grid
            assert (np.diff(trees.score(row)) >= -1e-12).all()


def test_trees_without_labels():
    assert (quality.fit(np.zeros((0, 2)), np.zeros(0), np.array([False, False])).score(np.zeros((3, 2))) < 0).all()


def test_held_out_accuracy(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.train(docs, labels.filter("doc_id % 2 = 0"))
    judged = quality.judge(docs.select("doc_id", "text"), trees).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    right = judged.filter((F.col("low_quality") > 0.5) == (F.col("quality") == 0)).count()
    assert right >= 0.97 * judged.count()


def test_trees_do_not_depend_on_the_order_of_rows(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.select((F.col("doc_id") % 300).alias("doc_id"), "text")
    given = labels.filter("doc_id < 300").select("doc_id", "quality")
    a = quality.train(some, given)
    b = quality.train(some.repartition(7).orderBy(F.desc("text")), given.orderBy(F.desc("quality")))
    assert len(a.value) > 2 and (a.value == b.value).all() and (a.threshold == b.threshold).all()


def test_quality_edges(edges, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None), (4, 1), (4, 0)], "doc_id long, quality int")
    trees = quality.train(edges, labels)
    out = quality.judge(edges, trees)
    assert out.count() == len(ROWS) and extra_kept(out)
    assert {r.doc_id for r in out.filter("base_failed").collect()} >= {6, 7, 8, 9, 10}
    assert quality.keep_good(edges, trees).columns == edges.columns
    empty = quality.train(nothing, labels.limit(0))
    assert quality.judge(nothing, empty).count() == 0


# -------------------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(catalog.tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_against_the_library(reference):
    draw = random.Random(0)
    letters = [*" \n\t\r'aAbBsStTrev.,!09éßÄ漢字😀 \u0558\u088f aaaa  ", "<|endoftext|>", "'re", "  ", "\x1c", "\x85", "aaaaaaa", "0000"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(4000)]
    v = bpe.Vocabulary(catalog.tokenizer_path())
    ids = bpe.Encoder(v).encode(texts)
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
    assert [*bpe.decode_ids(ids, v)] == [reference.decode(w, skip_special_tokens=False) for w in want]


def test_bpe_edges(edges, nothing):
    path = catalog.tokenizer_path()
    both = bpe.decode(bpe.encode(edges, path), path)
    assert both.filter("decoded <> coalesce(text, '')").count() == 0 and both.count() == len(ROWS)
    assert both.filter("coalesce(text, '') = '' AND octet_length(ids) > 0").count() == 0
    once = bpe.round_trip(edges, path)
    assert pairs(once, "doc_id", "ids", "decoded") == pairs(both, "doc_id", "ids", "decoded")
    assert bpe.encode(nothing, path).count() == 0 and bpe.round_trip(nothing, path).count() == 0
    broken = np.array([162], "<u4").tobytes()
    assert [*bpe.decode_ids([broken], bpe.Vocabulary(path))] == ["\ufffd"]


# --------------------------------------------------------------- contamination
def test_contamination(spark, edges, nothing):
    items = [
        (1, " ".join(f"GEMEINSAM{i}" for i in range(20, 45))), (2, "one two"), (3, None), (4, "..."), (None, "aaaa aaaa aaaa"),
        (5, " ".join(f"wort{i}é" for i in range(3, 13))), (5, "naïve text"), (6, "nowhere to be found"), (2, "one two"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = contamination.contamination(edges, bench).withColumn("n_items", F.size("items").cast("long")).withColumn(
        "s", F.sha2(F.array_join("items", ","), 256)
    )
    want = ordered(brute.contamination(ROWS, items))
    assert pairs(out, "doc_id", "n_words", "n_hit", "n_items", "s", "contaminated") == want
    assert contamination.contamination(nothing, bench).count() == 0
    assert contamination.contamination(edges, bench.limit(0)).filter("contaminated OR n_hit > 0").count() == 0


def test_proximity(spark):
    docs = brute.edge_table(spark, [(1, "red x green y y blue and more"), (2, "red " + "pad " * 90 + "green " + "pad " * 90 + "blue"), (3, "red green blue")])
    bench = spark.createDataFrame([(7, "red green blue")], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.near_items) for r in contamination.contamination(docs, bench).collect()}
    assert got == {1: (False, ["7"]), 2: (False, []), 3: (True, ["7"])}


def test_proximity_against_brute_force(spark, edges):
    draw = random.Random(6)
    vocabulary = [f"v{i}" for i in range(40)]
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(120)))) for i in range(40)] + [(None, "v1 v2 v3 v4"), (3, None), (7, "v1 v2"), (7, "v1 v2")]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 4, 9, 14, 25])))) for i in range(15)] + [(99, "v1 nowhere v2 v3")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = contamination.contamination(brute.edge_table(spark, rows), bench)
    assert pairs(out, "doc_id", "near_items") == ordered(brute.near_items(rows, items))
    got = out.withColumn("n_items", F.size("items").cast("long")).withColumn("s", F.sha2(F.array_join("items", ","), 256))
    assert pairs(got, "doc_id", "n_words", "n_hit", "n_items", "s", "contaminated") == ordered(brute.contamination(rows, items))


def test_short_items_do_not_read_the_text_again(spark):
    """One common word as an item: a match per place, and no text beside it."""
    rows = [(1, "the cat " * 3000), (2, "no such")]
    bench = spark.createDataFrame([(1, "the"), (2, "cat the")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in contamination.contamination(brute.edge_table(spark, rows), bench).collect()}
    assert got == {1: (5999, ["1", "2"]), 2: (0, [])}  # the last word is not followed by the other


# --------------------------------------------------------------------- URLs
def test_cascade_is_exact(spark):
    keys = spark.range(4000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 9 == 0).alias("listed"))
    found = urls.cascade(keys, "key", "listed", bits_per_key=3, hashes=1)
    assert len(found.levels) > 2
    assert keys.filter(found.contains(F.col("key")) != F.col("listed")).count() == 0
    none = urls.cascade(keys.filter("NOT listed"), "key", "listed")
    assert keys.filter(none.contains(F.col("key"))).count() == 0


def test_shards_of_a_long_list_are_exact(spark):
    """More keys than one filter may hold, a hot key, and null, empty and unknown ones beside them."""
    keys = spark.range(4000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 9 == 0).alias("listed"))
    sizes = {"max_bits": 300, "bits_per_key": 3, "hashes": 1}
    assert urls.shards_for(keys, "listed", **sizes) == 12
    hot = spark.range(3000).select(F.lit("host9").alias("key"), F.lit(True).alias("listed"))
    rows = keys.unionByName(hot).unionByName(spark.createDataFrame([("", False), (None, False)], "key string, listed boolean"))
    rows = rows.select(F.col("key").alias("h"), F.col("listed").alias("wanted"))
    out = urls.marked(rows, "h", keys, **sizes)
    assert out.count() == 7002 and out.filter("listed != wanted").count() == 0
    assert urls.marked(rows.limit(0), "h", keys, **sizes).count() == 0
    # a long universe with a short list: the second level is what is large
    assert urls.shards_for(keys.withColumn("listed", F.col("key") == "host1"), "listed", **sizes) == 12


def test_host_list_from_a_table(spark):
    pages = spark.createDataFrame([("http://A.org/x",), ("http://b.org",), ("http://b.org/2",), (None,), ("none",)], "url string")
    names = spark.createDataFrame([("a.org",), ("a.org",), ("absent.org",), (None,), ("",)], "name string")
    assert pairs(urls.host_list(pages, names=names), "key", "listed") == ordered([("a.org", True), ("b.org", False)])
    out = urls.judge_urls(pages, urls.host_list(pages, names=names))
    assert pairs(out, "host", "verdict") == ordered([("a.org", "block"), ("b.org", "allow"), ("b.org", "allow"), ("", "allow"), ("", "allow")])


@pytest.mark.parametrize("max_bits", [urls.MAX_BITS, 16])
def test_url_edges(spark, max_bits):
    rows = [
        (1, "http://WWW.Example.com/en/x?y#z"), (2, "https://a.example.com/en/"), (3, "x://example.com"), (4, None), (5, "no scheme/en/"),
        (6, "http://spam-farm.example.org/?a://b"), (7, "http://net/es/1"), (8, "http://a.b.net/fr/"), (9, "http://a.com/de/"),
        (10, ""), (10, ""), (11, "http:///en/"), (None, "http://my.pills.org#x"), (12, "http://notexample.com/en/"), (13, "http://xnet/es/"),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, key string, listed string")
    out = urls.judge_urls(pages, urls.host_list(pages), max_bits=max_bits)
    got = pairs(out, "page_id", "host", "path", "rule", "verdict")
    assert got == ordered([
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"), (2, "a.example.com", "/en/", "example.com/en/", "block"),
        (3, "example.com", "", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "spam-farm.example.org", "/", None, "block"), (7, "net", "/es/1", "net/es/", "block"), (8, "a.b.net", "/fr/", "net/fr/", "block"),
        (9, "a.com", "/de/", "com/", "allow"), (10, "", "", None, "allow"), (10, "", "", None, "allow"), (11, "", "/en/", None, "allow"),
        (None, "my.pills.org", "", None, "block"), (12, "notexample.com", "/en/", "com/", "allow"), (13, "xnet", "/es/", None, "allow"),
    ])
    assert urls.judge_urls(pages.limit(0), urls.host_list(pages.limit(0))).count() == 0
