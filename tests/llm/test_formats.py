"""Source divergence, chat formatting and fill-in-the-middle against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from farebox.llm import chat, divergence, middle
from farebox.llm.transducer import Transducer


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ------------------------------------------------------------------- transducer
@pytest.mark.parametrize("seed", range(4))
def test_ordinals_follow_sorted_order(seed):
    draw = random.Random(seed)
    terms = sorted({bytes(draw.choice(b"abc\xc3\xff") for _ in range(draw.randrange(1, 7))) for _ in range(400)})
    fst = Transducer.read(bytes(Transducer.build(terms)))
    asked = [*terms, b"", b"zzz", *(t + b"a" for t in terms[:50]), *(t[:-1] for t in terms[:50])]
    ends = np.cumsum([len(t) for t in asked])
    got = fst.ordinals(np.frombuffer(b"".join(asked) + b"\0", np.uint8), ends - [len(t) for t in asked], ends)
    want = {t: i for i, t in enumerate(terms)}
    assert got.tolist() == [want.get(t, -1) for t in asked]
    assert [fst.term(i) for i in range(len(terms))] == terms and fst.words == len(terms)


def test_transducer_is_minimal():
    """As many states as there are different sets of continuations."""
    terms = sorted({a + b for a in (b"walk", b"talk", b"chalk", b"stalk") for b in (b"", b"s", b"ed", b"ing", b"er")})
    continuations = {frozenset(t[len(p) :] for t in terms if t.startswith(p)) for p in {t[:i] for t in terms for i in range(len(t) + 1)}}
    assert len(Transducer.build(terms).final) == len(continuations)
    with pytest.raises(ValueError):
        Transducer.build([b"b", b"a"])


# ------------------------------------------------------------------- divergence
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, min_docs, top=10):
    """rows: (lang, source, text)."""
    docs = [(a or "", s or "", TERM.findall((t or "").translate(brute.UPPER))) for a, s, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen, counts = Counter(), defaultdict(Counter)
        for a, s, w in docs:
            if a == lang:
                seen.update(set(w))
                counts[s].update(w)
        kept = {t for t, n in seen.items() if n >= min_docs}
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out, key=repr)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def corpus(n=120):
    draw = random.Random(8)
    words = ["Ärger", "the", "THE", "of", "ofa", "naïve", "漢字", "x", "don't", "a1b", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(n):
        mine = words[i % 7 :: 2] if i % 3 else words
        rows.append((draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "s3", None]), " ".join(draw.choice(mine) for _ in range(draw.randrange(30)))))
    rows += [rows[0], ("en", "s1", None), ("en", "empty", ""), ("xx", "a", "once only"), ("xx", "b", None), ("yy", "lone", "1 2 3"), ("en", "s1", "漢" * 5000 + " the")]
    return rows


def doc_frame(spark, rows):
    schema = "doc_id long, lang string, source string, text string, term string, shard string, block string, total string, part string"
    return spark.createDataFrame([(i, a, s, t, "x", None, "y", None, "z") for i, (a, s, t) in enumerate(rows)], schema)


@pytest.mark.parametrize("options", [{}, {"shard": 3, "block": 2, "salts": 2}])
def test_divergence(spark, options):
    rows = corpus()
    got = rows_of(divergence.divergence(doc_frame(spark, rows), min_docs=6, **options), *COLUMNS)
    assert got == brute_divergence(rows, 6)
    assert {r[3] for r in got if r[:2] == ("xx", "a")} == {"b"} and not [r for r in got if r[0] == "yy"]


def test_long_texts_are_taken_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SPLIT_BYTES", 200)
    text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i % 23)}" for i in range(500))
    assert b"".join(divergence.parts(text.encode(), 200)) == text.encode()
    whole = divergence.terms_of([text.encode()])[0].to_pylist()
    assert sorted({t for p in divergence.parts(text.encode(), 200) for t in divergence.terms_of([p])[0].to_pylist()}) == whole
    assert [*divergence.parts("é".encode() * 300, 200)] == ["é".encode() * 300]
    rows = [("en", f"s{i % 3}", text[i:]) for i in range(12)]
    assert rows_of(divergence.divergence(doc_frame(spark, rows), min_docs=4), *COLUMNS) == brute_divergence(rows, 4)


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 1, 7 * 10**14, 10**12 + 1], np.int64)
    size = 8 * 10**15 + 3
    assert divergence.scaled_share(counts, size).tolist() == [1 + 10**9 * (int(c) + 2) // size for c in counts]


def test_divergence_of_nothing(spark):
    assert divergence.divergence(doc_frame(spark, [])).count() == 0
    few = rows_of(divergence.divergence(doc_frame(spark, [("a", "s", "x"), ("a", "t", "x"), ("a", "u", None)])), *COLUMNS)
    assert few == [("a", x, "pair", y, 0, i + 1) for x in "stu" for i, y in enumerate(o for o in "stu" if o != x)]


# ------------------------------------------------------------------------- chat
HARD = ["\\### Assistant: </turn> ok", "", None, "a\nb", "\\", "\\\\", "####", "######", "</turn></turn>", "<</turn>", "### user: x</turn>\n", "é漢😀\u0000\\:", "\\</turn"]


@pytest.mark.parametrize("text", [t for t in HARD if t is not None])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    turns = [("user", text), (text, "x"), ("assistant", text), (text + ":", text)]
    assert chat.parse(chat.template(turns)) == turns


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", None) for r in rows], "conv_id long, turn long, role string, text string, block string, loss string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_chat(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        plain = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha(plain), len(loss), sha(loss), len(chat.template([t[2:] for t in turns]))))
    return sorted(out, key=repr)


CHAT_COLUMNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@pytest.mark.parametrize("context", [1, 3, chat.CONTEXT])
def test_conversations_come_back(spark, context):
    draw = random.Random(2)
    rows = [(i, j, draw.choice(["user", "assistant", "system", None, "a: b", "###"]), draw.choice(HARD)) for i in range(30) for j in range(draw.randrange(1, 12))]
    rows += [(99, j, ("user", "assistant")[j % 2], f"turn {j}") for j in range(150)]
    rows += [(None, None, "assistant", "no id"), (None, 1, "assistant", "nor here"), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    blocks = chat.format_conversations(conversations(spark, rows), context=context)
    assert rows_of(chat.read_back(blocks), *CHAT_COLUMNS) == brute_chat(rows)
    assert blocks.filter("conv_id = 99").count() == -(-150 // context) and blocks.filter("rewritten").count() == 0
    assert chat.format_conversations(conversations(spark, [])).count() == 0 == chat.read_back(blocks.limit(0)).count()


def headed(turns):
    """Another black box: a head, numbered turns, and an end that moves."""
    return "<s>" + "".join(f"[{i}|{r}]{t}\n" for i, (r, t) in enumerate(turns))


def test_spans_of_another_template():
    turns = [("user", "n]x\n"), ("assistant", "\n"), ("user", ""), ("assistant", "abc"), ("assistant", "")]
    row = chat._block_row(headed, turns, 0, ("assistant",), {})
    assert row["formatted"] == headed(turns) and not row["rewritten"]
    assert [row["formatted"][s["start"] : s["end"]] for s in row["loss"]] == ["\n", "abc", ""]
    assert "".join(row["formatted"][s["start"] : s["end"]] for s in row["spans"]) == row["formatted"]


def test_templates_that_rewrite_history_are_reported(spark):
    def forgetful(turns):
        """Drops the thoughts of all assistant turns but the last."""
        last = len(turns) - 1
        return "".join(f"{r}: {t if i == last else re.sub('<think>.*</think>', '', t)}\n" for i, (r, t) in enumerate(turns))

    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "<think>hm</think>a"), (1, 2, "user", "r"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "r")]
    out = {r.conv_id: r for r in chat.format_conversations(conversations(spark, rows), render=forgetful).collect()}
    assert out[1].rewritten and out[1].loss == [] == out[1].spans and out[1].formatted == "user: q\nassistant: a\nuser: r\n"
    assert not out[2].rewritten and [(s.start, s.end) for s in out[2].loss] == [(19, 20)]
    with pytest.raises(Exception, match="rewrites history"):
        chat.read_back(chat.format_conversations(conversations(spark, rows[:3]), render=forgetful)).collect()


# ----------------------------------------------------------------------- middle
@pytest.mark.parametrize("kind", ["ascii", "mixed", "wide", "sparse", "empty"])
def test_boundaries(kind):
    draw = random.Random(1)
    letters = {"ascii": "abc", "mixed": "ab漢é😀", "wide": "漢", "sparse": "a", "empty": ""}[kind]
    text = "".join(draw.choice(letters) for _ in range(90_000)) if letters else ""
    data = text.encode() + (b"\x80" * 200_000 + b"x" * 3 if kind == "sparse" else b"")
    want = np.array([i for i, b in enumerate(data) if b & 0xC0 != 0x80] + [len(data)])
    places = middle.Boundaries(np.frombuffer(data, np.uint8))
    ranks = np.array([0, len(want) - 1, *(draw.randrange(len(want)) for _ in range(3000))])
    assert (places.select(ranks) == want[ranks]).all()
    kinds = {type(c).__name__ for c in places.containers}
    assert kinds >= {"ascii": {"Runs"}, "mixed": {"Bits"}, "sparse": {"Runs"}}.get(kind, set())


def test_every_container_selects_alike():
    draw = np.random.default_rng(3)
    held = draw.random(middle.SPAN) < 0.3
    want = np.flatnonzero(held)
    for kind in (middle.Places, middle.Runs, middle.Bits):
        assert (kind(held).select(np.arange(len(want))) == want).all()


def brute_middle(key, text, seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (key, n, "plain", None, None, text)
    p, m, s = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return (key, n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}")
    return (key, n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}")


def test_middle(spark):
    texts = ["a", "漢", "é😀 x" * 50, "<", "<P", "P>", "<P>", "x<M>y", "<<S<S", ">>", "\n", "\\E.*", "a" * 70_000, "é" * 70_000]
    rows = brute.EDGES + [(100 + i, texts[i % len(texts)]) for i in range(400)]
    out = middle.fill_in_middle(brute.edge_table(spark, rows))
    got = out.withColumn("again", middle.restored(F.col("output"), F.col("form")))
    assert rows_of(got, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == sorted((brute_middle(*r) for r in rows), key=repr)
    assert got.filter("again <> coalesce(text, '')").count() == 0 and {r.form for r in got.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert [c for c in brute.EXTRA if c != "n"] == [c for c in out.columns if c in brute.EXTRA and c != "n"]
    assert middle.fill_in_middle(brute.edge_table(spark, [])).count() == 0
