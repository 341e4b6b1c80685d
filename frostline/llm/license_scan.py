"""License scan, in DataFrame operations only.

Texts become sequences of five-word shingles. Overlapping windows of 16 shingles get a MinHash of 16 bands, one hash
each: a window's smallest shingle among those that fall into the band. Templates are signed at every offset, so a
window that lies inside a copied template meets an equal one, whatever its place. A window with a fifth of its shingles
broken keeps a Jaccard similarity of 0.67; with some ten bands in use it meets its template with probability
1 - 0.33**10, and each template is covered by several windows. Templates too short for a whole window inside them
(fewer than 23 shingles) are retrieved by windows of a single shingle, which miss nothing.

Retrieved templates are verified exactly: their shingles in the document, in runs without a gap longer than the
template, must be at least four fifths of the template's.

Before that, documents are read for a few anchor words, chosen so that more than a fifth of every template's shingles
hold one: a document without any anchor word cannot pass the verification.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import col, letters_lower, stored
from frostline.llm.license_texts import TEMPLATES

WORDS, PERCENT = 5, 80
WINDOW, STRIDE, BANDS = 16, 8, 16
#: All templates together, in words: what is broadcast is at most some twenty small rows for each.
MOST_WORDS = 100_000
_WORD = "[a-z0-9]+"


def template_words(text: str) -> list[str]:
    return re.findall(_WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def anchors(templates: dict[str, str]) -> list[str]:
    """Words, the longest first choice, that stand in more than a fifth of every template's shingles."""
    chosen: list[str] = []
    for text in templates.values():
        words = template_words(text)
        shingles = [words[i : i + WORDS] for i in range(len(words) - WORDS + 1)]
        order = sorted(set(words), key=lambda w: (-sum(w in s for s in shingles) * (len(w) > 6), -len(w), w))
        for word in [None, *order]:
            if word and word not in chosen:
                chosen.append(word)
            distinct = {tuple(s) for s in shingles}
            if 100 * sum(not any(a in w for a in chosen for w in s) for s in distinct) < PERCENT * len(distinct):
                break
    return chosen


def _shingles(text: Column) -> Column:
    """Hash of every shingle, in order. The words are bound once and not extracted for every shingle."""
    words = F.regexp_extract_all(letters_lower(text), F.lit(f"({_WORD})"), 1)

    def hashed(w: Column) -> Column:
        last = F.size(w) - WORDS
        at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WORDS)]))

    return F.get(F.transform(F.array(words), hashed), F.lit(0))


def _bands(rows: DataFrame, stride: int) -> DataFrame:
    """The rows' key columns with band and low of every window of their ``shingles``."""
    keys = [c for c in rows.columns if c != "shingles"]
    starts = F.sequence(F.lit(1), F.greatest(F.size("shingles") - WINDOW + 1, F.lit(1)), F.lit(stride))
    windows = rows.select(*keys, "shingles", F.explode(starts).alias("start")).select(*keys, F.slice("shingles", F.col("start"), WINDOW).alias("window"))
    lows = F.transform("window", lambda h: F.struct(F.pmod(h, F.lit(BANDS)).alias("band"), h.alias("low")))
    exploded = windows.select(
        *keys,
        F.explode(
            F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.lit(BANDS - 1)),
                    lambda b: F.struct(b.alias("band"), F.array_min(F.transform(F.filter(lows, lambda x: x["band"] == b), lambda x: x["low"])).alias("low")),
                ),
                lambda x: x["low"].isNotNull(),
            )
        ).alias("entry"),
    )
    return exploded.select(*keys, "entry.band", "entry.low")


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    if sum(len(template_words(t)) for t in templates.values()) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} words are not broadcast; scan in several runs")
    rows = [(name, text) for name, text in sorted(templates.items()) if len(template_words(text)) >= WORDS]
    return spark.createDataFrame(rows, "license string, text string").select("license", _shingles(F.col("text")).alias("shingles"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, license, first_word and last_word (places in the text, from 0) and share of every passage found.

    Words are runs of a-z and 0-9, A to Z lower-cased; share is the part of the template's different shingles that the
    passage has. Templates of fewer than five words are not looked for. Null, empty and short texts match nothing.
    A passage that repeats after more words than the template has is reported at each place; copies that are closer come
    as one row that spans them, as in the checking SQL. Rows with the same id and text are one document. An empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    wanted = _templates(spark, templates)
    parts = wanted.select("license", F.size("shingles").alias("length"), F.size(F.array_distinct("shingles")).alias("different"), "shingles")
    words = anchors(templates)
    holds = letters_lower(col(text)).rlike("|".join(words)) if words else F.lit(False)
    # Documents are read and tested once; few hold an anchor, and three joins below start from these.
    read = stored(
        docs.filter(holds).select(
            col(doc_id).cast("long").alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), _shingles(col(text)).alias("shingles")
        ),
        "anchored",
    )

    posted = parts.select("license", "length", "different", F.explode(F.array_distinct("shingles")).alias("shingle"))
    places = read.select("doc_id", "text_hash", F.posexplode("shingles").alias("at", "shingle"))
    single = places.join(F.broadcast(posted.filter(F.col("length") < WINDOW + STRIDE - 1).select("license", "shingle")), "shingle")
    signed = _bands(parts.filter(F.col("length") >= WINDOW + STRIDE - 1).select("license", "shingles"), 1).distinct()
    banded = _bands(read, STRIDE).join(F.broadcast(signed), ["band", "low"])
    retrieved = single.select("doc_id", "text_hash", "license").unionByName(banded.select("doc_id", "text_hash", "license")).distinct()

    hits = places.join(F.broadcast(posted), "shingle").distinct()
    same = hits["doc_id"].eqNullSafe(retrieved["doc_id"]) & (hits["text_hash"] == retrieved["text_hash"]) & (hits["license"] == retrieved["license"])
    hits = hits.join(retrieved, same, "left_semi")
    order = Window.partitionBy("doc_id", "text_hash", "license").orderBy("at")
    starts = F.coalesce((F.col("at") - F.lag("at").over(order) > F.col("length")).cast("int"), F.lit(1))
    runs = hits.withColumn("starts", starts).withColumn("run", F.sum("starts").over(order))
    found = runs.groupBy("doc_id", "text_hash", "license", "run").agg(
        F.min("at").alias("first_word"), (F.max("at") + WORDS - 1).alias("last_word"),
        F.size(F.collect_set("shingle")).alias("have"), F.first("different").alias("different"),
    )
    found = found.filter(100 * F.col("have") >= PERCENT * F.col("different"))
    return found.select("doc_id", "license", "first_word", "last_word", (F.col("have") / F.col("different")).alias("share"))
