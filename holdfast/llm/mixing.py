"""Mixing sources to target weights by balanced sampling with the cube method.

Each document is wanted ``target / source size`` times.  The whole part of that
is certain; the rest is an inclusion probability.  The flight phase moves the
probabilities of three documents at a time along the one direction that keeps
both the number of documents and the number of words (the null space of the two
balancing equations) until one of them is 0 or 1.  A block of any size ends with
two open documents at most, so blocks of thousands shrink level by level until a
source is a single block; there the landing phase gives up the words first, then
the number, and settles what is left.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.ordering import row_numbers, running_totals
from holdfast.llm.text import free_name, text_of
from holdfast.session import stage

#: Weights of the sources in order of code points, repeating; the share of all words that the mix holds; the most repeats.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents of a block, and the distance from 0 and 1 at which a probability is settled.
BLOCK, SETTLED = 4096, 1e-9


def size_in_words(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target``, the words wanted of each source, to ``number, words``.

    By weight, which goes by number; at most ``most`` times the words of the source, the excess shared again by weight.
    The words per weight rise round by round, from sums with a row for each weight, until no further source is full.
    """
    place = F.pmod(F.col("number"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    level, before = 0.0, None
    while level != before:
        full = F.lit(level) * weight > F.lit(float(most)) * F.col("words")
        sums = sources.where("words > 0").groupBy(place.alias("place")).agg(
            F.sum("words").alias("words"), F.sum(F.when(full, F.col("words"))).alias("full"), F.count_if(~full).alias("open")).collect()
        open_ = sum(weights[r["place"]] * r["open"] for r in sums)
        left = share * sum(r["words"] for r in sums) - most * sum(r["full"] or 0 for r in sums)
        level, before = (left / open_ if open_ else level), level
    wanted = F.least(F.lit(level) * weight, F.lit(float(most)) * F.col("words"))
    return sources.withColumn("target", F.when(F.col("words") > 0, wanted).otherwise(0.0))


def _direction(s: list[int]) -> tuple[float, ...]:
    """Keeps the sum of three (or two equal) probabilities, and that of sizes times probabilities."""
    if len(s) == 2 or s[0] == s[1] == s[2]:
        return (1.0, -1.0, 0.0)[:len(s)]
    u = (s[1] - s[2], s[2] - s[0], s[0] - s[1])
    most = max(map(abs, u))
    return tuple(x / most for x in u)


def _move(p: list[float], s: list[int], u: tuple[float, ...], rnd: random.Random) -> None:
    up = min(((1 - x) / d if d > 0 else -x / d) for x, d in zip(p, u) if d)
    down = min((x / d if d > 0 else (x - 1) / d) for x, d in zip(p, u) if d)
    step = up if rnd.random() * (up + down) < down else -down
    for k, d in enumerate(u):
        p[k] += step * d


def fly(units: Iterable[tuple[int, int, float]], rnd: random.Random, land: bool) -> dict[int, float]:
    """Probabilities of ``(unit, size, probability)`` after the flight, and after the landing if asked for."""
    done: dict[int, float] = {}
    ids: list[int] = []
    s: list[int] = []
    p: list[float] = []

    def settle() -> bool:
        for k in range(len(p) - 1, -1, -1):
            if p[k] < SETTLED or p[k] > 1 - SETTLED:
                done[ids.pop(k)] = float(round(p.pop(k)))
                s.pop(k)
                return True
        return False

    for unit, size, probability in units:
        ids.append(unit)
        s.append(size)
        p.append(probability)
        while settle():
            pass
        while len(p) == 3 or (len(p) == 2 and s[0] == s[1]):
            _move(p, s, _direction(s), rnd)
            while settle():
                pass
    if land:
        while len(p) > 1:
            _move(p, s, (1.0, -1.0), rnd)
            while settle():
                pass
        if p:
            p[0] = 1.0 if rnd.random() < p[0] else 0.0
    return done | dict(zip(ids, p))


def _flight(seed: int, level: int):
    """One block through the flight phase; a source that is down to one block lands."""

    def flight(key, rows):
        rnd = random.Random(f"{seed}/{level}/{key[0]}/{key[1]}")
        rows = rows.sort_values("unit", ignore_index=True)
        order = list(range(len(rows)))
        rnd.shuffle(order)
        size, p, land = rows["size"].tolist(), rows["p"].tolist(), bool(rows["land"].iloc[0])
        if land:
            # The smallest documents come last, so what has to land weighs little.
            order.sort(key=lambda i: -size[i])
        out = fly(((i, size[i], p[i]) for i in order), rnd, land)
        return rows.assign(p=[out[i] for i in range(len(rows))]).drop(columns="land")

    return flight


def sample(units: DataFrame, per_source: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """``unit, copies`` (0 or 1) from ``unit, source, size, p``; ``per_source`` has ``source, n``, at least its units."""
    open_, parts, level, table = units, [], 0, per_source
    most = per_source.agg(F.max("n")).first()[0] or 0
    while True:
        table = table.select("source", F.ceil(F.col("n") / block).alias("blocks"))
        salt = F.pmod(F.xxhash64("unit", F.lit(seed), F.lit(level)), F.col("blocks"))
        salted = open_.join(table, "source").select(*units.columns, salt.alias("salt"), (F.col("blocks") == 1).alias("land"))
        # Dealt by block, not by source alone, so the blocks of a hot source go to different tasks.
        flown = salted.repartition("source", "salt").groupBy("source", "salt").applyInPandas(
            _flight(seed, level), "unit string, source long, size long, p double, salt long").drop("salt")
        flown = stage(flown, "mix")
        settled = (F.col("p") < SETTLED) | (F.col("p") > 1 - SETTLED)
        parts.append(flown.where(settled))
        most = -(-most // block)
        if most <= 1:
            break
        # A block leaves two documents at most.
        table, most = table.where("blocks > 1").select("source", (2 * F.col("blocks")).alias("n")), 2 * most
        open_, level = flown.where(~settled), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("unit", F.round("p").cast("int").alias("copies"))


def mix(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 0,
        block: int = BLOCK) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` (words of the row's source) and ``copies`` of the row in the mix.

    A null text has size 0 and is never taken; a null source is a source of its
    own, the last.  Rows equal in id, source and text are twins: they are taken
    as often as their number asks, some once more than others.  Columns of the
    frame with the new names are replaced, others pass through; an empty table
    stays empty.  The driver sees a few sums.  Equal inputs give equal mixes.
    """
    df = df.drop("size", "source_size", "target", "copies")
    names = [free_name(df, n) for n in ("unit", "mix_source", "mix_times", "mix_extra", "mix_more")]
    unit, source_key, times, extra, more = names
    src, digest = F.col(f"`{source}`").cast("string"), F.xxhash64(text_of(text))
    key = [F.col(f"`{doc_id}`").alias("d"), src.alias("s"), digest.alias("h")]
    sized = df.withColumn("size", size_in_words(text)).withColumn(unit, F.to_json(F.struct(*key)))
    narrow = stage(df.select(*key, size_in_words(text).alias("n")), "sizes")
    sources = narrow.groupBy("s").agg(F.sum("n").alias("words"), F.count("*").alias("docs"))
    sources = row_numbers(sources, [F.col("s").isNull(), F.col("s")], "number").withColumn("number", F.col("number") - 1)
    rate = F.when(F.col("words") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("words"))).otherwise(0.0)
    plan = stage(targets(stage(sources, "sources"), weights, share, most).withColumn("times", rate), "plan")
    units = narrow.where("n > 0").groupBy("d", "s", "h", "n").agg(F.count("*").alias("twins"))
    wanted = (F.col("times") - F.floor(F.col("times") + SETTLED)) * F.col("twins")
    units = units.join(plan, units["s"].eqNullSafe(plan["s"])).select(
        F.to_json(F.struct("d", units["s"], "h")).alias("unit"), F.col("number").alias("source"), F.col("n").alias("size"),
        "twins", F.floor(wanted + SETTLED).alias("sure"), wanted.alias("wanted"))
    units = stage(units.withColumn("p", F.greatest(F.col("wanted") - F.col("sure"), F.lit(0.0))), "units")
    drawn = sample(units.where(F.col("p") > SETTLED).select("unit", "source", "size", "p"),
                   plan.where("words > 0").select(F.col("number").alias("source"), F.col("docs").alias("n")), seed, block)
    lookup = plan.select(F.col("s").alias(source_key), F.col("words").alias("source_size"), "target", F.col("times").alias(times))
    rows = sized.join(lookup, src.eqNullSafe(F.col(source_key))).drop(source_key)
    whole = F.floor(F.col(times) + SETTLED).cast("int")
    copies = F.when(F.col("size") > 0, whole + F.coalesce(F.col(extra).cast("int"), F.lit(0))).otherwise(0)
    # Twins are numbered, and the first of them are taken once more; there are none where ids are unique.
    twins = units.where("twins > 1").join(drawn, "unit", "left").select(
        F.col("unit").alias(unit), (F.col("sure") + F.coalesce("copies", F.lit(0))).alias(extra))
    twins = stage(twins, "twins")
    single = rows.join(twins.select(unit), unit, "left_anti").join(
        drawn.select(F.col("unit").alias(unit), F.col("copies").alias(extra)), unit, "left")
    some = rows.join(twins, unit).select(F.struct(*[F.col(f"`{c}`") for c in [*rows.columns, extra]]).alias("whole_row"))
    some = stage(some.withColumns({"row": F.monotonically_increasing_id(), "nth": F.lit(1).cast("long")}), "twin_rows")
    some = running_totals(some.withColumn("unit", F.col(f"whole_row.`{unit}`")), [F.col("row")], {"nth": "nth"}, by="unit")
    once_more = (F.col("nth") <= F.col(f"whole_row.`{extra}`")).cast("int")
    some = some.select("whole_row.*", once_more.alias(more)).drop(extra).withColumnRenamed(more, extra)
    return single.unionByName(some).withColumn("copies", copies).drop(unit, times, extra)
