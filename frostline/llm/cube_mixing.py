"""Mixing sources to target weights by balanced sampling with the cube method.

A source that is to give r times its words gives floor(r) whole copies; which documents give one copy more is a
balanced sample with inclusion probability r - floor(r). The flight phase moves the probabilities of a few documents at
a time through the null space of the constraints, so that expected words and documents stay as they are, until at most
two of a group are undecided. The undecided ones of all groups of a source fly on together, and only its last two land,
with ten decided ones open again, so that the source's words come near their target. A source lands as soon as it is
one group; a larger one carries ten decided documents of varied size along until then.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import WORD, blocks_of, col, stored, unused

#: Weights of the sources by code point, repeating, and the most that a source may give, in times its size.
WEIGHTS, MOST = (5, 2, 1), 3
#: Documents that fly together in one task's group.
GROUP = 4096
#: Decided documents of a source that the landing may decide anew.
REOPENED = 10
_EPS = 1e-9


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size and target of each source, from rows of source and size.

    Sources take the weights in turn, by code point, null last. They share the sum of all sizes by weight; what goes
    beyond ``most`` times a source's size is shared again among the others. The table of sources stays on the cluster:
    its places come from a range sort and the counts of its ranges, and each round of sharing is one sum.
    """
    sources = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ordered = sources.repartitionByRange(F.col("source").isNull(), F.col("source")).sortWithinPartitions(F.col("source").isNull(), "source")
    # One range after the other; the place in a range is the low part of the id.
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    counts = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, total = {}, 0
    for r in counts:
        before[r["part"]] = total
        total += r["count"]
    low = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    firsts = _lookup(part, before)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(firsts + low, F.lit(len(weights))) + 1).cast("int"))
    table = stored(ordered.select("source", "source_size", weight.alias("weight")), "weighted")

    share, capped = 0.0, -1
    full = F.col("source_size") * F.lit(float(most))
    everything = table.agg(F.sum("source_size")).first()[0] or 0
    while True:
        above = full < F.col("weight") * F.lit(share) if capped >= 0 else F.lit(False)
        r = table.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("n"), F.sum(F.when(above, full)).alias("given"), F.sum(F.when(~above, F.col("weight"))).alias("weight")
        ).first()
        if not r["n"] and capped >= 0 or r["n"] == capped or not r["weight"]:
            break
        capped = r["n"]
        share = (everything - (r["given"] or 0.0)) / r["weight"]
    target = F.least(full, F.col("weight") * F.lit(share))
    return table.select("source", "source_size", target.alias("target"))


def _lookup(key: Column, values: dict[int, int]) -> Column:
    """A long by a key out of a small map; 0 for an empty one."""
    if not values:
        return F.lit(0).cast("long")
    return F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, v)])[key].cast("long")


def fly(probabilities: list[float], sizes: list[float], draw: np.random.Generator) -> None:
    """Flight phase in place: keeps the sums of p and of p times size, and leaves at most two p between 0 and 1."""
    free: list[int] = []
    for i in range(len(probabilities)):
        if _EPS < probabilities[i] < 1 - _EPS:
            free.append(i)
            if len(free) == 3:
                _step(probabilities, sizes, free, draw)
        else:
            probabilities[i] = float(round(probabilities[i]))
    # Two of one size still have a direction that keeps both sums.
    if len(free) == 2 and sizes[free[0]] == sizes[free[1]]:
        _move(probabilities, free, (1.0, -1.0), draw)


def _step(p: list[float], sizes: list[float], free: list[int], draw: np.random.Generator) -> None:
    a, b, c = (sizes[i] for i in free)
    if a == b == c:
        direction = (1.0, -1.0, 0.0)
    else:
        scale = max(abs(c - b), abs(a - c), abs(b - a))
        direction = ((c - b) / scale, (a - c) / scale, (b - a) / scale)
    _move(p, free, direction, draw)


def _move(p: list[float], free: list[int], direction: tuple[float, ...], draw: np.random.Generator) -> None:
    """Go along the direction or against it until a probability is 0 or 1, so that the expectation stays."""
    ahead = back = math.inf
    for i, u in zip(free, direction):
        if u > 0:
            ahead, back = min(ahead, (1 - p[i]) / u), min(back, p[i] / u)
        elif u < 0:
            ahead, back = min(ahead, -p[i] / u), min(back, (p[i] - 1) / u)
    step = ahead if draw.random() * (ahead + back) < back else -back
    left = []
    for i, u in zip(free, direction):
        p[i] += step * u
        if _EPS < p[i] < 1 - _EPS:
            left.append(i)
        else:
            p[i] = float(round(p[i]))
    free[:] = left


def land(p: list[float], sizes: list[float], reopened: int = REOPENED) -> None:
    """Decide the last free ones, with a few decided ones open again: of all choices, the one whose words, then
    documents, come nearest to what is expected."""
    free = [i for i, x in enumerate(p) if _EPS < x < 1 - _EPS]
    if not free:
        return
    opened = free + [i for i in range(len(p) - 1, -1, -1) if i not in free][:reopened]
    chance, size = np.array([p[i] for i in opened]), np.array([sizes[i] for i in opened])
    choices = (np.arange(1 << len(opened))[:, None] >> np.arange(len(opened))) & 1
    off = np.abs(choices @ size - chance @ size) + 0.05 * size.mean() * np.abs(choices.sum(axis=1) - chance.sum())
    for i, x in zip(opened, choices[off.argmin()]):
        p[i] = float(x)


def _decider(keys: list[str], name: str, salt: str, parts: str, on: str, size: str, probability: str, turn: int):
    """Flight of a group, and landing if it is its stratum's only one (``parts``). ``on`` tells the units that go on: the
    undecided, and in a stratum's first group some decided ones from the smallest to the largest."""

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(keys, kind="stable")
        draw = np.random.default_rng(list(f"{rows[name].iat[0]}/{rows[salt].iat[0]}/{turn}".encode()))
        order = draw.permutation(len(rows))  # long and short documents meet by chance
        p, sizes = rows[probability].to_numpy()[order].tolist(), rows[size].to_numpy()[order].astype(float).tolist()
        fly(p, sizes, draw)
        if rows[parts].iat[0] == 1:
            land(p, sizes)
        back = np.empty(len(p))
        back[order] = p
        goes = (back > 0) & (back < 1)
        if rows[parts].iat[0] > 1 and rows[salt].iat[0] == 0:
            decided = np.flatnonzero(~goes)
            decided = decided[np.argsort(rows[size].to_numpy()[decided], kind="stable")]
            goes[decided[np.linspace(0, len(decided) - 1, min(REOPENED, len(decided))).astype(int)]] = True
        return rows.assign(**{probability: back, on: goes})

    return decide


def sampled(
    units: DataFrame, keys: list[str], stratum: str = "source", size: str = "size", probability: str = "probability", group: int = GROUP
) -> DataFrame:
    """``units`` with ``chosen`` (0 or 1), balanced within each stratum on the number of units and the sum of sizes.

    ``keys`` (without nulls) tell units apart, and order them, so that a rerun decides alike however the rows are dealt
    out. A large stratum flies in groups chosen by a hash of the keys; at most two units of each group go on to the next
    round, with REOPENED decided ones of the stratum, where so many groups become one that it is no larger than before.
    """
    salt, name, parts, on = unused(units, "salt", "stratum_key", "parts", "goes_on")
    kept = [*units.columns, salt, name, parts]
    going = units.withColumn(name, F.coalesce(F.concat(F.lit("="), col(stratum).cast("string")), F.lit("")))
    counts = stored(going.groupBy(name).agg(F.ceil(F.count(F.lit(1)) / group).alias(parts)), "strata")
    groups = counts.agg(F.max(parts)).first()[0] or 1
    going = going.join(counts, name).withColumn(salt, F.pmod(F.xxhash64(*map(col, keys), F.lit(0)), col(parts)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in going.select(*kept).schema) + f", `{on}` boolean"
    decided, turn = None, 0
    while True:
        decide = _decider(keys, name, salt, parts, on, size, probability, turn)
        flown = stored(going.select(*kept).groupBy(name, salt).applyInPandas(decide, schema), "flown")
        done = flown.filter(~col(on))
        decided = done if decided is None else decided.unionByName(done)
        if groups == 1:
            break
        fold = max(2, (group - REOPENED) // 2)
        groups, turn = blocks_of(groups, fold), turn + 1
        going = flown.filter(col(on)).withColumn(salt, F.floor(col(salt) / fold)).withColumn(parts, F.ceil(col(parts) / fold))
    return decided.select(*map(col, units.columns), col(probability).cast("int").alias("chosen"))


def decisions(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST,
) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, copies and taken (size times copies) of every row.

    Null texts have size 0. Rows of one source with the same id (or, without id, the same text) are one document and
    get the same number of copies. A null source is a source of its own, the last. A document's copies are at most
    ``most``, rounded up. An empty table gives no rows.
    """
    rows = docs.select(
        col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(col(text)).alias("text_hash"),
        col(source).cast("string").alias("source"),
        words(col(text)).alias("size"),
    )
    rows = stored(rows.withColumn("unit", F.coalesce("doc_id", "text_hash")).withColumn("unnamed", F.col("doc_id").isNull()), "sizes")
    wanted = stored(targets(rows.select("source", "size"), weights, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    whole = F.floor(ratio + _EPS)
    rated = wanted.select(
        F.col("source").alias("of"), "source_size", "target", whole.alias("whole"), F.greatest(ratio - whole, F.lit(0.0)).alias("probability")
    )
    units = rows.groupBy("source", "unit", "unnamed").agg(F.sum("size").alias("size"))
    units = units.join(rated.select("of", "probability"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    units = units.filter(F.col("probability") > _EPS)
    chosen = sampled(units, ["unnamed", "unit"]).filter("chosen = 1")
    chosen = chosen.select(F.col("source").alias("s"), F.col("unit").alias("u"), F.col("unnamed").alias("w"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("unit") == F.col("u")) & (F.col("unnamed") == F.col("w"))
    out = rows.join(chosen, same, "left").join(rated, F.col("source").eqNullSafe(F.col("of")))
    copies = (F.col("whole") + F.when(F.col("u").isNull(), 0).otherwise(1)).cast("long")
    return out.withColumn("copies", copies).select(
        "doc_id", "text_hash", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns as they were."""
    names = docs.columns
    taken = decisions(docs, doc_id, text, source, **how).filter("copies > 0")
    taken = taken.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("source").alias("s"), "copies").distinct()
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, body, src = (F.col(f"c{names.index(n)}") for n in (doc_id, text, source))
    same = key.cast("long").eqNullSafe(F.col("d")) & (F.xxhash64(body) == F.col("t")) & src.cast("string").eqNullSafe(F.col("s"))
    repeated = inner.join(taken, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*inner.columns).toDF(*names)
