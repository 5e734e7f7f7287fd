"""Plain Python versions of the corpus operators, and a table of edge cases."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SHARED = " ".join(f"gemeinsam{i}" for i in range(70))
OTHER = " ".join(f"wort{i}é" for i in range(60))
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
EDGES = [
    (1, f"alpha {SHARED} omega"),
    (2, f"start\n{SHARED}\nend of this one"),
    (3, OTHER),
    (4, OTHER),
    (4, OTHER),  # a repeated row
    (5, OTHER.replace("wort7é", "anders")),
    (6, None),
    (7, ""),
    (8, " \t\r\n \x0b\f "),
    (9, "one two"),
    (10, "aaaa " * 120),
    (11, LONG),
    (12, LONG[: len(LONG) // 2] + " Ende"),
    (13, "naïve\u00a0text \u2003with 漢字 and 😀 \x1c\x85 marks"),
    (None, f"null id {SHARED}"),
    (14, "The MIT License and the Apache License, under the GNU General Public License; CC BY. MIT license"),
    (15, "MİT LİCENSE \u212a"),
]
EXTRA = ("d", "h", "t", "pos", "key", "row", "tp", "kept_text", "item", "label", "n")


def edge_table(spark, rows=EDGES):
    """The rows with extra columns whose names the operators use themselves; their values are null or text."""
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, t, *(["x", None] * 6)[: len(EXTRA)]) for i, t in rows], schema)


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return LOWER_WORD.findall((text or "").translate(UPPER))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def byte_repeats(texts, length=200):
    seen = Counter()
    data = [(t or "").encode() for t in texts]
    for b in data:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def word_repeats(rows, window=50):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1 if d is not None else 0):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def near_duplicates(rows, k=5, similarity=0.8):
    """(class, links) of each row; a null id stands before all others."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    pairs = Counter()
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    for at in inverted.values():
        pairs.update(itertools.combinations(at, 2))
    parent, links = list(range(len(rows))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), c in pairs.items():
        if c >= similarity * (len(sets[a]) + len(sets[b]) - c):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    low = {g: min(ids, key=lambda x: (x is not None, x or 0)) for g, ids in groups.items()}
    return [(rows[i][0], low[find(i)], links[i]) for i in range(len(rows))]


def contamination(rows, items, window=10):
    spans = defaultdict(set)
    for item, t in items:
        w = lower_words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            spans[tuple(w[i : i + n])].add("" if item is None else str(item))
    sizes = {len(s) for s in spans}
    out = []
    for d, t in rows:
        w = lower_words(t)
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := spans.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        out.append((d, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def near_items(rows, items, window=10, rare=3, share=0.5, slop=20, least=3):
    """Items of whose rarest places enough stand in one band of diagonals, per row."""
    texts = [lower_words(t) for _, t in rows]
    known = {("" if i is None else str(i), tuple(lower_words(t))) for i, t in items}
    count = Counter(w for t in texts for w in t)
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        names = set()
        for name, iw in known:
            length = min(window, len(iw))
            wanted = set()
            for s in range(len(iw) - length + 1 if iw else 0):
                wanted |= set(sorted(range(s, s + length), key=lambda p: (count[iw[p]], p))[:rare])
            bands = defaultdict(set)
            for pos, x in enumerate(w):
                for ipos in wanted:
                    if iw[ipos] == x:
                        for b in (0, 1):
                            bands[b, (pos - ipos + b * slop) // (2 * slop)].add(ipos)
            if any(len(v) >= least and len(v) >= share * len(wanted) for v in bands.values()):
                names.add(name)
        out.append((d, sorted(names)))
    return out


def line_dedup(rows, depth=3, min_docs=20, min_contexts=10, agree=0.8, constant=0.5, own_share=1 / 9):
    """(id, lines, dropped, kept text) of each row; rows of equal id and text are one document."""
    field, blank = "<*>", " \t\x0b\x0c\r"
    docs = {}
    for d, t in rows:
        docs[d, t] = None if t is None else t.split("\n")
    lines, times = [], Counter((d, t) for d, t in rows)
    for key, split in docs.items():
        for pos, raw in enumerate(split or []):
            line = re.sub(f"[{blank}]+", " ", raw.strip(blank))
            if line:
                tokens = tuple(field if re.search("[0-9]", x) else x for x in line.split(" "))
                lines.append((key, pos, line, tokens, (len(tokens), tokens[:depth])))

    def telling(template, tokens):
        rest = tokens[depth:]
        constants = sum(t != field for t in template)
        real = sum(t != field for t in tokens[:depth]) + constants
        words_ = sum(t == field != r for t, r in zip(template, rest, strict=True))
        return real > 0 and 2 * real >= len(tokens) and (words_ == 0 or constants > words_)

    docs_of = defaultdict(set)
    for key, _, _, _, leaf in lines:
        docs_of[leaf].add(key)
    by_leaf = defaultdict(list)
    for line in lines:
        if len(docs_of[line[4]]) >= min_docs:
            by_leaf[line[4]].append(line)
    members = []
    for leaf, held in by_leaf.items():
        n = sum(times[x[0]] for x in held)
        template = []
        for i in range(depth, leaf[0]):
            seen = Counter()
            for x in held:
                seen[x[3][i]] += times[x[0]]
            token, c = max(seen.items(), key=lambda s: (s[1], s[0].encode()))
            template.append(token if c >= constant * n else field)
        left = []
        for x in held:
            same = sum(a == t != field for a, t in zip(x[3][depth:], template, strict=True))
            if len(x[3]) > 1 and same >= agree * sum(t != field for t in template) and telling(template, x[3]):
                members.append((leaf, x))
            else:
                left.append(x)
        frequent = Counter()
        for x in left:
            frequent.update({(i, t): times[x[0]] for i, t in enumerate(x[3][depth:]) if t != field})
        for x in left:
            minor = tuple(t if frequent[i, t] >= min_docs and t != field else field for i, t in enumerate(x[3][depth:]))
            if any(t != field for t in minor) and telling(minor, x[3]):
                members.append(((leaf, minor), x))
            else:
                members.append(((leaf, x[2], "line"), x))
    units = defaultdict(list)
    for unit, x in members:
        units[unit].append(x)
    units = {u: xs for u, xs in units.items() if len({x[0] for x in xs}) >= min_docs}
    inside = {(x[0], x[1]) for xs in units.values() for x in xs}
    outside, sizes = defaultdict(list), Counter()
    for key, pos, line, _, _ in lines:
        sizes[key] += len(line.encode())
        if (key, pos) not in inside:
            outside[key].append(line)
    around = {k: tuple(sorted(outside[k])) for k in sizes if sum(len(x.encode()) for x in outside[k]) >= own_share * sizes[k]}
    gone = set()
    for xs in units.values():
        if len({around[x[0]] for x in xs if x[0] in around}) >= min_contexts:
            places = sorted(((x[0], x[1]) for x in xs), key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[0][1], p[1]))
            gone.update(places[1:])
    out = []
    for d, t in rows:
        split = docs[d, t] or []
        kept = [x for i, x in enumerate(split) if ((d, t), i) not in gone]
        out.append((d, len(split), len(split) - len(kept), None if t is None else "\n".join(kept)))
    return out


def statistics(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered, lines, dup = set(), set(), 0
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))
