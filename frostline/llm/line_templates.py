"""Line dedup with a log-template tree, in DataFrame operations only.

Lines are parsed to a fixed depth: a leaf of the tree is a token count and the leading tokens, with tokens that hold a
digit already made variable. Within a leaf, a token is a variable field too if only one document has it at its place, or
far fewer forms than have the tokens that must be constant; so fields are told alike in small and large corpora. The
rest is the line's template. Templates found in several documents are dropped from all but the first of them, the
one with the smallest id, so that nothing vanishes from the corpus and a document that was copied stays whole once.
Lines too short or with too few constant tokens for a template are told to recur by their own words and digits.

Leaves, line forms and tokens are told to recur by their smallest and largest document, which combine before any
shuffle, so a line that a third of all documents share is no burden. Token-wise work is done only in leaves that more
than one document and more than one line form reach, once for each form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import col, stored

#: Leading tokens that lead to a leaf, and the fewest tokens of a line that can stand for others.
LEADING, SHORTEST = 3, 3
#: Least share of constant tokens in a line that recurs but for its digits, and in a generalised template.
CONSTANT, CONSTANT_GENERAL = 0.5, 0.7
#: Forms that share a constant token, as a share of those that share the rarest of the tokens that must be constant.
SHARED = 0.5
#: Different lines that a generalised template must stand for.
FORMS = 3
FIELD = "<*>"
_VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def _normal(line: Column, masked: bool = True) -> Column:
    """The line's tokens with one space between, those that hold a digit as variable fields if ``masked``."""
    out = F.translate(line, "\t\x0b\x0c\r", "    ")
    if masked:
        out = F.when(out.rlike("[0-9]"), F.regexp_replace(out, _VARIABLE, FIELD)).otherwise(out)
    return F.trim(F.when(F.contains(out, F.lit("  ")), F.regexp_replace(out, " +", " ")).otherwise(out))


def _lines(docs: DataFrame) -> DataFrame:
    """doc, text_hash, pos, line (normal), n (tokens), fixed (those that are no field), leaf and form of all lines with a
    token.

    The form is a hash of the line. That of lines that are too short or have too few constant tokens for a template is a
    hash of the line with its digits.
    """
    lines = docs.select("doc", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = lines.select("doc", "text_hash", "pos", "raw", _normal(F.col("raw")).alias("line"))
    n = F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "))) + 1
    lines = lines.withColumns({"n": n, "leaf": F.xxhash64(n, F.substring_index("line", " ", LEADING)), "fixed": _fixed(F.col("line"), n)})
    form = F.when(_general(), F.xxhash64("line")).otherwise(F.xxhash64(_normal(F.col("raw"), masked=False), F.lit(1)))
    parsed = F.struct("line", "n", "fixed", "leaf", form.alias("form"))
    # Unpacked by inline, below which no filter is pushed: pushed, it would parse each line again for every column it names.
    return lines.select("doc", "text_hash", "pos", F.inline(F.array(parsed))).filter("line <> ''")


def _general() -> Column:
    """Whether a line may stand for others that differ in its fields."""
    return (F.col("n") >= SHORTEST) & (F.col("fixed") >= CONSTANT * F.col("n"))


def _recurs(low: str = "low", high: str = "high") -> Column:
    return F.col(low) < F.col(high)


def templates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positions of all lines, and form, template and first (document) of the forms that recur.

    ``docs`` has doc, text_hash and text. The template is text for generalised forms and null for others.
    """
    # Parsed once; the lines' text is read back for the leaves that need it, and other columns without it.
    places = stored(_lines(docs), "lines")
    spread = (F.min("doc").alias("low"), F.max("doc").alias("high"))
    mixed = (
        places.filter(_general())
        .groupBy("leaf")
        .agg(*spread, F.min("form").alias("one"), F.max("form").alias("other"))
        .filter(_recurs() & _recurs("one", "other"))
        .select(F.col("leaf").alias("mixed_leaf"))
    )
    open_lines = places.filter(_general()).join(mixed.hint("shuffle_hash"), F.col("leaf") == F.col("mixed_leaf"), "left_semi")
    forms = stored(open_lines.groupBy("leaf", "form").agg(F.first("line").alias("line"), *spread), "forms")
    known = places.groupBy("form").agg(*spread)
    known = stored(known.join(_shares(forms), "form", "left"), "known")
    shared = (
        known.filter("template is not null").groupBy("template").agg(F.min("low").alias("first"), F.max("high").alias("last"), F.count(F.lit(1)).alias("forms"))
    )
    shared = shared.filter((F.col("forms") >= FORMS) & _recurs("first", "last")).select(F.col("template").alias("shared"), F.col("first").alias("shared_first"))
    # Most forms have no general template; they stay out of the join, where they would all meet as nulls.
    joined = known.filter("template is not null").join(shared, F.col("template") == F.col("shared"), "left")
    joined = joined.unionByName(known.filter("template is null"), allowMissingColumns=True)
    first = F.coalesce("shared_first", F.when(_recurs(), F.col("low")))
    recurring = joined.withColumn("first", first).filter("first is not null").select("form", F.col("shared").alias("template"), "first")
    return places.drop("line"), recurring


def _words(forms: DataFrame) -> DataFrame:
    return forms.select("leaf", "form", "low", "high", F.posexplode(F.split("line", " ")).alias("pos", "token"))


def _shares(forms: DataFrame) -> DataFrame:
    """form and template of forms, where a token is constant by the number of forms that have it at its place.

    The tokens that a template must keep at least, a form's commonest, tell how many forms it may stand for. A token is
    constant if it has no less than a share of these, and several documents. However often the values of a field repeat,
    they stay a field as long as each is rare beside the line's words.
    """
    words = _words(forms)
    counts = words.groupBy("leaf", "pos", "token").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count(F.lit(1)).alias("count"))
    counts = counts.filter(_recurs()).select("leaf", "pos", "token", "count")
    marked = words.join(counts, ["leaf", "pos", "token"], "left").withColumn("count", F.coalesce("count", F.lit(0)))

    def template(own: Column) -> Column:
        ranked = F.sort_array(F.transform(F.filter(own, lambda w: w["token"] != FIELD), lambda w: w["count"]), asc=False)
        least = SHARED * F.get(ranked, F.ceil(F.size(own) * F.lit(CONSTANT_GENERAL)).cast("int") - 1)

        def kept(at_least: Column) -> Column:
            field = F.exists(own, lambda w: (w["token"] != FIELD) & (w["count"] < at_least))
            tokens = F.transform(own, lambda w: F.when(w["count"] < at_least, FIELD).otherwise(w["token"]))
            return F.when(field, F.array_join(tokens, " "))

        return F.get(F.transform(F.array(least), kept), F.lit(0))

    # A line's own tokens come together: as many as the line is long. They and their bound are bound once, as the only
    # elements of arrays, and not worked out again for every token.
    own = marked.groupBy("leaf", "form").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "count"))).alias("own"))
    return own.select("form", F.get(F.transform(F.array("own"), template), F.lit(0)).alias("template")).filter("template is not null")


def _fixed(line: Column, n: Column) -> Column:
    """Number of tokens that are no variable field."""
    return F.when(F.contains(line, F.lit(FIELD)), F.size(F.filter(F.split(line, " "), lambda t: t != FIELD))).otherwise(n)


def without_templates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``; with ``counts``, also n_lines and n_dropped.

    Lines end at line feeds and the kept ones stay exactly as they are. A null text stays null, a document all of whose
    lines recur gets an empty text. Lines without a token stay; a line of one or two tokens, or most of whose tokens hold
    digits, goes only where it recurs as it is. A document is told by its id, or without one by its text; rows with one
    id are one document, where lines do not recur. Lines may be of any length, and an empty table gives no rows. Columns
    named n_lines or n_dropped give way to the counts; others stay as they are, whatever their names.
    """
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = F.col(f"c{names.index(text)}")
    inner = inner.withColumn("text_hash", F.xxhash64(body)).withColumn("doc", F.coalesce(F.col(f"c{names.index(doc_id)}").cast("long"), "text_hash"))
    plain = docs.select(col(doc_id).cast("long").alias("doc"), col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    places, recurring = templates(plain.withColumn("doc", F.coalesce("doc", "text_hash")).filter("text is not null"))
    gone = places.join(recurring.select("form", "first"), "form").filter("doc <> first")
    dropped = gone.groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("gone"))
    joined = inner.join(dropped, ["doc", "text_hash"], "left")

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    # The split lines are bound once, as the only element of an array, and not split again for every line.
    shorter = F.when(F.col("gone").isNull(), body).otherwise(F.get(F.transform(F.array(F.split(body, "\n")), rest), F.lit(0)))
    columns = [shorter.alias(n) if n == text else F.col(f"c{i}").alias(n) for i, n in enumerate(names) if not (counts and n in ("n_lines", "n_dropped"))]
    if counts:
        n_lines = F.coalesce(F.size(F.split(body, "\n")), F.lit(0))
        columns += [F.when(body.isNull(), 0).otherwise(n_lines).alias("n_lines"), F.greatest(F.size("gone"), F.lit(0)).alias("n_dropped")]
    return joined.select(*columns)
