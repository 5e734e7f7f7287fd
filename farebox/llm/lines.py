"""Line dedup on a fixed-depth tree of line templates, with DataFrame functions only.

A line's leaf in the tree is its number of tokens and its first ``DEPTH``
tokens; a token with a digit is a variable field. Within a leaf, a place is
constant if one token fills it in at least half of the leaf's lines, and a
variable field otherwise. A leaf's lines that agree with enough of its constants
follow its template. The other lines of the leaf are grouped once more, by those
of their tokens that recur at their place, so a leaf holds many templates.
A line with too few constants to tell it from any other
(all fields, a single token with a digit, three common leading words) is a
template of its own, which only the same line follows. A template that recurs across documents and in different
surroundings is boilerplate: its lines are dropped but for the first. The
surroundings of a line are what its document holds outside recurring lines,
wherever that stands, so blank lines and neighbours in a block do not matter.

Leaves are counted before any line is split into its tokens, so only lines of
recurring leaves are ever taken apart, and every count is made by grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farebox.llm.frames import stored

DEPTH, MIN_DOCS, MIN_CONTEXTS, AGREE, CONSTANT = 3, 20, 10, 0.8, 0.5
OWN_SHARE = 1 / 9  # two documents that share more than the other 8 / 9 have a Jaccard similarity over 0.8
FIELD = "<*>"
BLANK = " \t\x0b\f\r"  # a line of these only has no token


def normal(line: Column) -> Column:
    """The line with one space for each run of white space and none at its ends."""
    spaced = F.regexp_replace(F.trim(line, F.lit(BLANK)), "[ \\t\\x0B\\f\\r]+", " ")
    # searched for byte by byte: most lines are normal, and a pattern takes several times as long
    other = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | F.contains(line, F.lit("  "))
    for c in BLANK[1:]:
        other = other | F.contains(line, F.lit(c))
    return F.when(other, spaced).otherwise(line)


def tokens(line: Column) -> Column:
    """The tokens of a :func:`normal` line; those with a digit are one variable field."""
    return F.transform(F.split(line, " "), lambda x: F.when(x.rlike("[0-9]"), FIELD).otherwise(x))


def lines_of(df: DataFrame, key: str, text: str, depth: int = DEPTH) -> DataFrame:
    """(d, h, pos, line, leaf): the :func:`normal` lines with a token."""
    docs = df.select(F.col(key).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.split(F.col(text), "\n").alias("l"))
    each = docs.select("d", "h", F.posexplode("l").alias("pos", "line")).withColumn("line", normal(F.col("line")))

    def leaf(line: Column) -> Column:
        # counted and cut without taking the line apart
        size = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
        head = F.substring_index(line, " ", depth)
        masked = F.when(head.rlike("[0-9]"), F.regexp_replace(head, r"[^ ]*[0-9][^ ]*", FIELD)).otherwise(head)
        return F.when(line != "", F.xxhash64(size, masked))

    return each.withColumn("leaf", leaf(F.col("line"))).filter("leaf IS NOT NULL")


def recurring_leaves(lines: DataFrame, min_docs: int) -> DataFrame:
    """Leaves with lines of at least ``min_docs`` documents."""
    each = lines.groupBy("leaf", "d", "h").agg(F.lit(1).alias("one"))
    return each.groupBy("leaf").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs).select("leaf")


def templates(lines: DataFrame, depth: int = DEPTH, constant: float = CONSTANT) -> DataFrame:
    """(leaf, template): the constant token of each place behind the leading ones, or the variable field."""
    sizes = lines.groupBy("leaf").agg(F.count("*").alias("n"))
    places = lines.select("leaf", F.posexplode(F.expr(f"slice(tokens, {depth + 1}, size(tokens))")).alias("i", "token"))
    counts = places.groupBy("leaf", "i", "token").agg(F.count("*").alias("c"))
    top = counts.groupBy("leaf", "i").agg(F.max(F.struct("c", "token")).alias("top"))
    own = top.join(sizes, "leaf").withColumn(
        "token", F.when((F.col("top.c") >= constant * F.col("n")) & (F.col("top.token") != FIELD), F.col("top.token")).otherwise(FIELD)
    )
    # one entry per token of a line: no longer than the line
    return own.groupBy("leaf").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "token"))), lambda x: x["token"]).alias("template"))


def telling(template: Column, rest: Column, depth: int = DEPTH) -> Column:
    """Whether a line's constants tell it from ordinary lines.

    One and half of its tokens at least are constants, leading fields not
    counted; and if its variable places hold other words than fields, more
    places behind the leading ones are constant.
    """
    leading = F.size(F.filter(F.slice("tokens", 1, depth), lambda x: x != FIELD))
    constants = F.size(F.filter(template, lambda x: x != FIELD))
    words = F.size(F.filter(F.zip_with(rest, template, lambda a, t: (t == FIELD) & (a != FIELD)), lambda x: x))
    real = leading + constants
    return (real > 0) & (2 * real >= F.size("tokens")) & ((words == 0) | (constants > words))


def following(lines: DataFrame, found: DataFrame, depth: int = DEPTH, agree: float = AGREE) -> DataFrame:
    """The lines with the ``unit`` they follow: their leaf's template, or null.

    A line follows the template if it agrees with at least ``agree`` of its
    constants and these are :func:`telling`. A line no longer than the leading
    tokens is its own template.
    """
    rest = F.expr(f"slice(tokens, {depth + 1}, size(tokens))")
    joined = lines.withColumn("rest", rest).join(found, "leaf", "left")
    joined = joined.withColumn("template", F.coalesce("template", F.array().cast("array<string>")))
    constants = F.expr(f"size(filter(template, t -> t <> '{FIELD}'))")
    same = F.expr(f"size(filter(zip_with(rest, template, (a, t) -> a = t AND t <> '{FIELD}'), x -> x))")
    follows = (same >= agree * constants) & (F.size("tokens") > 1) & telling(F.col("template"), F.col("rest"), depth)
    return joined.withColumn("unit", F.when(follows, F.xxhash64("leaf"))).drop("rest", "template")


def minor_templates(lines: DataFrame, min_docs: int, depth: int = DEPTH) -> DataFrame:
    """(form, minor): the template of each distinct row of tokens, null where it is not :func:`telling`.

    A token is constant if ``min_docs`` lines of the leaf have it at its place.
    """
    forms = stored(lines.groupBy("leaf", "tokens").agg(F.count("*").alias("n")), "line-forms")
    forms = forms.withColumn("form", F.xxhash64("leaf", "tokens")).filter(F.size("tokens") > depth)
    rest = F.expr(f"slice(tokens, {depth + 1}, size(tokens))")
    places = forms.select("form", "leaf", "n", F.posexplode(rest).alias("i", "token"))
    frequent = places.filter(F.col("token") != FIELD).groupBy("leaf", "i", "token").agg(F.sum("n").alias("c")).filter(F.col("c") >= min_docs)
    # a row per frequent token of a line: no longer than the line
    held = places.join(frequent.select("leaf", "i", "token"), ["leaf", "i", "token"]).groupBy("form").agg(
        F.map_from_entries(F.collect_list(F.struct("i", "token"))).alias("held")
    )
    own = forms.join(held, "form").withColumn("rest", rest).withColumn(
        "template", F.expr(f"transform(rest, (x, i) -> coalesce(try_element_at(held, i), '{FIELD}'))")
    )
    return own.filter(telling(F.col("template"), F.col("rest"), depth)).select("form", F.xxhash64("leaf", "template").alias("minor"))


def units(lines: DataFrame, min_docs: int, depth: int = DEPTH) -> DataFrame:
    """The lines with ``unit``: their leaf's template, else one below the leaf, else the line itself."""
    judged = following(lines, templates(lines, depth), depth)
    judged = stored(judged.withColumn("tokens", F.when(F.col("unit").isNull(), F.col("tokens"))), "leaf-members")
    left = judged.filter("unit IS NULL")
    if left.isEmpty():
        return judged
    named = left.withColumn("form", F.xxhash64("leaf", "tokens")).join(minor_templates(left, min_docs, depth), "form", "left").withColumn(
        "unit", F.coalesce("minor", F.xxhash64("leaf", "own"))
    )
    return judged.filter("unit IS NOT NULL").unionByName(named.select(judged.columns))


def weight() -> tuple[Column, Column]:
    """Bytes and digest of a group's lines; half of each hash, so that no sum overflows."""
    return F.sum("bytes").alias("bytes"), F.sum(F.shiftrightunsigned("own", 32)).alias("digest")


def surroundings(lines: DataFrame, recurring: DataFrame, own_share: float = OWN_SHARE) -> DataFrame:
    """(od, oh, around): a digest of each document's lines outside recurring ones.

    Documents with less than ``own_share`` outside are as good as copies of
    each other and have none.
    """
    inside = recurring.groupBy(F.col("d").alias("od"), F.col("h").alias("oh")).agg(
        F.sum("bytes").alias("in_bytes"), F.sum("digest").alias("in_digest")
    )
    whole = lines.select("d", "h", *measures()).groupBy("d", "h").agg(*weight())
    both = whole.join(inside, (F.col("h") == F.col("oh")) & F.col("d").eqNullSafe(F.col("od")))
    return both.filter(F.col("bytes") - F.col("in_bytes") >= own_share * F.col("bytes")).select(
        "od", "oh", (F.col("digest") - F.col("in_digest")).alias("around")
    )


def measures() -> tuple[Column, Column]:
    return F.xxhash64("line").alias("own"), F.octet_length("line").cast("bigint").alias("bytes")


def dropped_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
    min_docs: int = MIN_DOCS, min_contexts: int = MIN_CONTEXTS, keep_first: bool = True,
) -> DataFrame:
    """(d, h, pos): lines of recurring templates, from 0."""
    lines = lines_of(df, key, text, depth)
    leaves = stored(recurring_leaves(lines, min_docs), "leaves")
    taken = stored(
        lines.join(leaves, "leaf").select("d", "h", "pos", "leaf", tokens(F.col("line")).alias("tokens"), *measures()), "leaf-lines"
    )
    members = stored(units(taken, min_docs, depth).select("d", "h", "pos", "unit", "own", "bytes"), "template-lines")
    by_doc = members.groupBy("unit", "d", "h").agg(F.min("pos").alias("pos"), *weight())
    spread = stored(by_doc.groupBy("unit").agg(
        F.count("*").alias("docs"), F.min(F.struct("d", "h", "pos")).alias("first")
    ).filter(F.col("docs") >= min_docs).select("unit", "first"), "recurring-units")
    recurring = stored(by_doc.join(spread.select("unit"), "unit").select("unit", "d", "h", "bytes", "digest"), "recurring-lines")
    around = surroundings(lines, recurring)
    each = recurring.select("unit", "d", "h").join(around, (F.col("h") == F.col("oh")) & F.col("d").eqNullSafe(F.col("od")))
    contexts = each.groupBy("unit", "around").agg(F.lit(1).alias("one")).groupBy("unit").agg(F.count("*").alias("contexts"))
    chosen = spread.join(contexts.filter(F.col("contexts") >= min_contexts), "unit").select("unit", "first")
    out = members.join(chosen, "unit")
    if keep_first:
        out = out.filter(~F.struct("d", "h", "pos").eqNullSafe(F.col("first")))
    return out.select("d", "h", "pos")


def drop_recurring_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
    min_docs: int = MIN_DOCS, min_contexts: int = MIN_CONTEXTS, keep_first: bool = True,
) -> DataFrame:
    """``df`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    Lines are cut at line feeds; lines without a token are never dropped. A
    template is dropped if its lines stand in ``min_docs`` documents or more, of
    which ``min_contexts`` or more differ in what they hold outside recurring
    lines (copies of one document do not); with ``keep_first`` the line with the smallest key,
    hash of its text and place stays. A null text has no lines and stays null;
    an empty one has one. Rows that repeat a key and text are one document and
    lose the same lines. Columns of the new names are replaced.
    """
    gone = dropped_lines(df, key, text, depth, min_docs, min_contexts, keep_first)
    # no more places than the document has lines
    per_doc = gone.groupBy(F.col("d").alias("gd"), F.col("h").alias("gh")).agg(F.collect_set("pos").alias("gone"))
    docs = df.select(
        F.struct(*df.columns).alias("row"), F.col(key).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h")
    )
    joined = docs.join(per_doc, (F.col("h") == F.col("gh")) & F.col("d").eqNullSafe(F.col("gd")), "left")
    own = F.col("row").getField(text)
    kept = F.array_join(F.filter(F.split(own, "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    new = ("kept_text", "n_lines", "n_dropped")
    return joined.select(
        *(F.col("row").getField(c).alias(c) for c in df.columns if c not in new),
        F.when(F.col("gone").isNull(), own).otherwise(kept).alias("kept_text"),
        F.when(own.isNull(), 0).otherwise(F.size(F.split(own, "\n"))).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
