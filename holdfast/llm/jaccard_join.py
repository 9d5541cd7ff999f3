"""Exact Jaccard join on word shingles by token-combination prefixes.

1. *Sketch.*  Shingles in the lowest third of the hash range are counted over all
   documents.  A text that is similar to another has most of its shingles in
   common with it; texts whose sketch cannot leave room for that drop out.  This
   loses nothing: the bound uses the exact numbers of each text.
2. *Prefixes.*  Among the rest, shingles are ordered by frequency, rare ones
   first.  A text that may miss ``m`` shingles of a similar one shares something
   with it in a prefix of ``m + 1``.  Rare shingles are indexed alone.  Frequent
   ones are dealt into classes and indexed as combinations of k; a class with c
   shingles in the prefix accounts for ``c - k + 1`` misses, so prefixes extend
   until the classes together account for ``m + 1``.
   Entries carry 256 parity bits of the set.  Each bit in which two sets differ is
   a shingle that only one of them has, so pairs with too many such bits go before
   any set travels; this loses nothing either.
3. *Verify.*  Each set is first tested against the one hub that it meets in most
   index entries.  Then only members of an entry that are in different components
   are tested, a bounded number of hubs a round, so a group of thousands of
   copies costs a few tests a member, not one a pair.

Equal sets are one node throughout.  Shingles and sets are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.components import components
from holdfast.llm.hashing import shingle_sets
from holdfast.llm.text import free_name, text_of
from holdfast.session import stage

#: Least similarity in percent, words of a shingle.
PERCENT, WORDS = 75, 5
#: Share of the hash range that the sketch looks at.
SKETCH = 1 / 3
#: Shingles in more texts than these are indexed as combinations of two, and of three.
FREQUENT = (20, 400)
#: Words per class of frequent shingles, and members of an index entry that meet all others in one round.
PER_CLASS, HUBS = 16, 512
#: Columns of parity bits, 64 each.
PARITY = ("p0", "p1", "p2", "p3")
#: Bits of the filter that spares shuffling texts which dropped out; a fixed 2 MiB.
FILTER_BITS = 1 << 24

NONE = np.zeros(0, np.uint64)


def least(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with a similar one."""
    return -(-PERCENT * n // 100)


def _node(s: np.ndarray) -> int | None:
    return None if not len(s) else xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _signed(s: np.ndarray) -> np.ndarray:
    return s.view(np.int64)


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(s) for s in sets)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(np.concatenate([NONE, *sets]))))


def _summaries(words: int):
    """Id and digest of each text as they came, its node, size and sketch, and how many shingles of the sketch have to be in other texts."""
    limit = np.uint64(int(SKETCH * (1 << 64)))

    def run(batches):
        for batch in batches:
            ids, step = batch.column(0), 512
            sets = shingle_sets(batch.column(1), words)
            # A few hundred texts at a time keep the lists small.
            for a in range(0, len(ids), step):
                part = [s for _, s in zip(range(step), sets)]
                low = [s[:np.searchsorted(s, limit)] for s in part]
                needed = [least(len(s)) - (len(s) - len(t)) for s, t in zip(part, low)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, step), batch.column(2).slice(a, step), pa.array([_node(s) for s in part], pa.int64()),
                     pa.array([len(s) for s in part], pa.int64()), pa.array(needed, pa.int64()), _lists(low)],
                    ["doc_id", "digest", "node", "n", "needed", "sketch"])

    return run


def _sets(words: int, bits: np.ndarray):
    """Node and set of the texts whose place in the filter is set."""

    def run(batches):
        for batch in batches:
            spot = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((bits[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1))
            step = 512
            for a in range(0, len(batch), step):
                part = batch.slice(a, step)
                sets = list(shingle_sets(part.column(1), words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_node(s) for s in sets], pa.int64()),
                     _lists(sets)], ["doc_id", "node", "tokens"])

    return run


def _place(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))


def _filter(ids: DataFrame) -> np.ndarray:
    """A bit for each hashed id; its size is fixed."""
    spot = _place(F.col("doc_id")) + 1
    rows = ids.groupBy(F.bitmap_bucket_number(spot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * 4096:(r["bucket"] - 1) * 4096 + len(part)] = part
    return out


def signatures(n: int, shared: list[tuple[int, int]]) -> set[int]:
    """Index entries of a set of ``n`` from its shared shingles, ``(frequency, shingle)`` in ascending order.

    The other ``n - len(shared)`` are in no other set and come first.
    """
    wanted, alone = n - least(n) + 1, n - len(shared)
    entries: set[int] = set()
    size = int(math.log(max(n, 1)) / math.log(100 / PERCENT) + 1e-9)
    # Similar sets are in the same or in neighbouring size steps, so each step's classes serve it and the next.
    for scheme in (size, size + 1):
        classes = max(1, int((100 / PERCENT) ** scheme) // PER_CLASS)
        counts: dict[tuple[int, int], list[int]] = {}
        reached = alone
        for frequency, token in shared:
            if reached >= wanted:
                break
            k = 1 + sum(frequency > f for f in FREQUENT) if n >= 8 and scheme > 8 else 1
            if k == 1:
                entries.add(token)
                reached += 1
                continue
            members = counts.setdefault((k, token % classes), [])
            for other in combinations(members, k - 1):
                key = ",".join(map(str, (scheme, *sorted((*other, token)))))
                entries.add(xxhash.xxh3_64_intdigest(key) - (1 << 63))
            members.append(token)
            reached += len(members) >= k
    return entries


def _parity(tokens: list[int]) -> np.ndarray:
    """Whether the number of shingles at each of 256 places is odd, as 64-bit integers."""
    spots = np.array(tokens, np.int64) & (64 * len(PARITY) - 1)
    return np.packbits(np.bincount(spots, minlength=64 * len(PARITY)) & 1).view(np.int64)


def _index(batches):
    for rows in batches:
        parity = np.array([_parity([r["token"] for r in shared]) for shared in rows["shared"]]).reshape(-1, len(PARITY))
        found = [signatures(n, [(r["df"], r["token"]) for r in shared]) for n, shared in zip(rows["n"], rows["shared"])]
        often = [len(s) for s in found]
        yield pd.DataFrame({"entry": np.array([e for s in found for e in s], np.int64),
                            "id": np.repeat(rows["id"].to_numpy(np.int64), often),
                            "n": np.repeat(rows["n"].to_numpy(np.int32), often),
                            "c": np.repeat(np.array([len(s) for s in rows["shared"]], np.int32), often),
                            **{p: np.repeat(parity[:, k], often) for k, p in enumerate(PARITY)}})


def _verified(pairs: DataFrame, sets: DataFrame, *also: str) -> DataFrame:
    """The pairs ``a, b`` that are similar, with further columns of theirs."""
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    # The set of the member travels to its hub; the hub's set joins it there.
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.select("a", "b", *also, common.alias("c"), (F.size("ta") + F.size("tb")).alias("s")).where(
        100 * F.col("c") >= PERCENT * (F.col("s") - F.col("c"))).select("a", "b", *also)


def _possible(other: str) -> Column:
    """Whether two sets of ``n`` shingles can be similar when ``c`` of them are in any other set at all."""
    both, c = F.col("n") + F.col(f"{other}.n"), F.col(f"{other}.c")
    apart = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{other}.{p}"))) for p in PARITY), F.lit(0))
    return ((100 + PERCENT) * F.least(F.col("c"), c) >= PERCENT * both) & (
        (100 + PERCENT) * (F.col("c") + c - apart) >= 2 * PERCENT * both)


def _grown(linked: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after adding links between nodes; a component so far is a star around its root."""
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if linked is not None:
        edges = edges.unionByName(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return components(edges)


def _apart(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of the entries that still hold several components, with root and size of their own one."""
    sized = linked.join(linked.groupBy("root").agg(F.count("*").alias("size")), "root").withColumnRenamed("node", "id")
    rows = rows.select("entry", "id", "n", "c", *PARITY).join(sized, "id", "left").withColumns(
        {"root": F.coalesce("root", "id"), "size": F.coalesce("size", F.lit(1))})
    live = rows.groupBy("entry").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("entry")
    return stage(rows.join(live, "entry"), "entries")


def _links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """Components ``node, root`` of the sets under all similar pairs that share an entry."""
    several = entries.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1").select("entry")
    met = stage(entries.join(several, "entry"), "entries")
    # One test a set first: against the member, itself in most entries, that it meets most often.
    rows = stage(met.join(met.groupBy("id").agg(F.count("*").alias("degree")), "id"), "entries")
    hubs = rows.groupBy("entry").agg(F.max_by(F.struct("id", "n", "c", *PARITY), F.struct("degree", "id")).alias("hub"))
    tried = rows.join(hubs, "entry").where((F.col("id") != F.col("hub.id")) & _possible("hub")).groupBy(
        "id", F.col("hub.id").alias("hub")).agg(F.count("*").alias("n"))
    best = tried.groupBy("id").agg(F.max_by("hub", F.struct("n", "hub")).alias("a"))
    linked = _grown(None, _verified(best.select("a", F.col("id").alias("b")), sets))
    while True:
        # An entry whose members are all linked already has nothing left to test.
        rows = _apart(rows, linked)
        if rows.isEmpty():
            return linked
        # Members of small components come first: once they are tested, what is left is mostly one component.
        first = Window.partitionBy("entry").orderBy("size", "id")
        hubs = stage(rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= HUBS), "hubs")
        hub = hubs.select("entry", F.struct("size", "id", "root", "n", "c", *PARITY).alias("hub"))
        pairs = rows.join(hub, "entry").where((F.col("root") != F.col("hub.root")) & _possible("hub") & (
            F.struct("hub.size", "hub.id") < F.struct("size", "id")))
        pairs = pairs.groupBy(F.col("hub.id").alias("a"), F.col("id").alias("b")).agg(
            F.first("hub.root").alias("ra"), F.first("root").alias("rb"))
        good = _verified(pairs, sets, "ra", "rb")
        linked = _grown(linked, good.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
        # All pairs with a hub are settled, so hubs leave.
        rows = rows.join(hubs.select("entry", "id"), ["entry", "id"], "left_anti")


def _grouped(df: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """``doc_id, digest, node, n, group, component_id`` of each row; ``group`` names the component, null without shingles."""
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    schema = "doc_id long, digest long, node long, n long, needed long, sketch array<long>"
    narrow = stage(docs.withColumn("digest", F.xxhash64("text")).mapInArrow(_summaries(words), schema), "summaries")
    tokens = narrow.select(F.explode("sketch").alias("token"), "doc_id")
    counted = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    found = stage(tokens.join(stage(counted, "shared"), "token").groupBy("doc_id").agg(F.count("*").alias("c")), "counts")
    left = narrow.alias("a").join(found.alias("b"), F.expr("a.doc_id <=> b.doc_id"), "left").where(
        "node IS NOT NULL AND coalesce(c, 0) >= needed").groupBy("node").agg(F.min("a.doc_id").alias("doc_id"))
    left = stage(left, "left")

    marked = docs.select("doc_id", "text", _place(F.col("doc_id")).alias("spot"))
    sets = marked.mapInArrow(_sets(words, _filter(left)), "doc_id long, node long, tokens array<long>")
    sets = sets.alias("s").join(left.alias("l"), F.expr("s.node = l.node AND s.doc_id <=> l.doc_id")).select(
        "s.node", "tokens").dropDuplicates(["node"])
    # Ids that are written once stay as they are.
    sets = stage(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    each = sets.select("id", F.explode("tokens").alias("token"))
    df_of = stage(each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    shared = each.join(df_of, "token").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    entries = shared.join(sets.select("id", F.size("tokens").alias("n")), "id").mapInPandas(_index, ", ".join(
        ["entry long, id long, n int, c int", *(f"{p} long" for p in PARITY)]))
    linked = _links(stage(entries, "index"), sets)

    smallest = narrow.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("smallest"))
    roots = sets.select("node", "id").join(linked.withColumnRenamed("node", "id"), "id").select("node", "root")
    of_root = roots.join(smallest, "node").groupBy("root").agg(F.min("smallest").alias("of_root"))
    names = smallest.join(roots, "node", "left").join(of_root, "root", "left").select(
        "node", F.coalesce(F.concat(F.lit("r"), "root"), F.concat(F.lit("n"), "node")).alias("group"),
        F.coalesce("of_root", "smallest").alias("component_id"))
    return narrow.select("doc_id", "digest", "node", "n").join(names, "node", "left")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row; the component is named by its smallest id.

    A null or empty text has no shingles and no links; a text of fewer words
    than a shingle is one shingle.  Repeated rows are equal texts, hence
    linked.  Rows without an id take part, and get the smallest id of their
    component, null if none of it has one.  Other columns are not read; an
    empty table gives no rows.
    """
    return _grouped(df, doc_id, text, words).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_per_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row of each component: the one with the least id (rows without an id last), and of equal ids one text.

    Rows with the same id and different texts are different documents, so no
    component goes with an id that another component uses too.  Rows without any
    shingle are alike in nothing and stay: one of each id and text, and all
    without an id.
    """
    own, mark = free_name(df, "kept_id"), free_name(df, "kept_digest")
    found = stage(_grouped(df, doc_id, text, words), "groups")
    best = found.where("group IS NOT NULL").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("best")).select("best.doc_id", "best.digest")
    single = found.where("group IS NULL AND doc_id IS NOT NULL").select("doc_id", "digest")
    kept = best.unionByName(single).distinct().select(F.col("doc_id").alias(own), F.col("digest").alias(mark))
    marked = df.withColumn(mark + "_", F.xxhash64(text_of(text)))
    bare = kept.where(F.col(own).isNull()).select(mark)
    named = marked.join(kept.where(F.col(own).isNotNull()), (F.col(f"`{doc_id}`").cast("long") == F.col(own)) & (
        F.col(mark + "_") == F.col(mark)), "left_semi").dropDuplicates([doc_id, mark + "_"])
    # A component of rows without an id is known by the text that was chosen.
    nameless = marked.where(F.col(f"`{doc_id}`").isNull())
    chosen = nameless.join(bare, F.col(mark + "_") == F.col(mark), "left_semi").dropDuplicates([mark + "_"])
    wordless = nameless.where(F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]")) == 0)
    return named.unionByName(chosen).unionByName(wordless).drop(mark + "_")
