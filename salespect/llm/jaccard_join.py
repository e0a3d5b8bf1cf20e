"""Self-join of texts on the Jaccard similarity of their word shingles, exact, by prefix filtering.

1. Every text becomes its sorted set of shingle hashes. Equal sets are one
   class, whose key is a hash of the set, so exact copies are compared once.
   A class carries the parity bitmap of its set; sets are never stored whole.
2. Shingles are put in one global order, rare ones first, by counts over the
   whole corpus in a table of fixed size (any order is right; this one keeps
   common passages out of the prefixes). Two sets that reach the similarity
   share a shingle within their prefixes.
3. Prefix shingles are shuffled as packed blocks by ranges of their hash.
   Shingles that one class alone has end there. Common ones are spread over
   many blocks by their owner.
4. For every shingle, each owner is paired with the smallest owner, under the
   length and positional filters. The suffix filter follows on the bitmaps;
   sets are built again from their texts for the pairs it leaves, and the
   filter on whole sets and the exact test see each pair once.
5. Where owners of one shingle are in different components, they are paired
   with a few other owners of it, picked by hash. What then still is apart is
   paired across components under all filters, the suffix filter taken from
   parity bitmaps of the sets, so that the join gives out only pairs about as
   similar as links. No link between components is lost, and no group
   is expanded into all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import release, staged
from salespect.llm.batches import STAGED_ROWS, tidy
from salespect.llm.components import connected_components
from salespect.llm.words import Alphabet, free_name, mix, shingle_set, text_slices, words

COUNT_BITS = 20  # the table of shingle counts: 2**20 cells, 4 MB whatever the corpus
_COUNT_BLOCKS = 64
_SEEN_LIMIT = 200_000
_FLUSH_ENTRIES = 1 << 18
_BINS = 64
_BITS = 1024  # of the parity bitmap of a set
_PARITY = [f"p{n}" for n in range(_BITS // 64)]
_PICKS = 3  # further owners that those of an open shingle are paired with
_SHARE = 4096  # entries of one cell of the count table that a block should hold


def needed_overlap(left, right, percent: int):
    """Least shared shingles of sets of these sizes that reach the similarity."""
    return -((-percent * (left + right)) // (100 + percent))


def prefix_length(size, percent: int):
    """How many of its first shingles a set must show to meet every similar one."""
    return size - -((-percent * size) // 100) + 1


def set_key(shingles: np.ndarray, seed: int) -> int:
    total = mix(shingles ^ np.uint64(seed)).sum(dtype=np.uint64) if seed else shingles.sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles) + 1)], np.uint64)).view(np.int64)[0])


def _sets(column: pa.Array, alphabet: Alphabet, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for part in words(column, alphabet):
        for k in range(part.rows.stop - part.rows.start):
            yield part.rows.start + k, shingle_set(part.hashes[part.first[k] : part.first[k + 1]], size)


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """_BITS bits, each the parity of how many shingles fall on it: two sets differ in at least as many shingles as bits."""
    at = (mix(shingles) % np.uint64(_BITS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=_BITS) & 1).astype(bool), bitorder="little").view("<i8")


SIGNATURE = ["kind", "id", "size", "key", "other", "counts", *_PARITY]


@tidy
def _signatures(batches, size: int):
    """Rows of kind 0: id, set size, two keys and the bitmap of the set. Rows of kind 1: blocks of the count table."""
    alphabet = Alphabet()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    pending, held = [], 0
    for batch in batches:
        count = batch.num_rows
        sizes, keys, others = np.zeros((3, count), np.int64)
        parity = np.zeros((count, len(_PARITY)), np.int64)
        for row, shingles in _sets(batch.column(1), alphabet, size):
            if len(shingles):
                sizes[row], keys[row], others[row] = len(shingles), set_key(shingles, 0), set_key(shingles, 1)
                parity[row] = parity_bitmap(shingles)
                pending.append(_cell(shingles))
                held += len(shingles)
            if held >= _FLUSH_ENTRIES:
                counts += np.bincount(np.concatenate(pending), minlength=len(counts))
                pending, held = [], 0
        columns = [pa.array(np.zeros(count, np.int32)), batch.column(0), *map(pa.array, (sizes, keys, others))]
        columns += [pa.nulls(count, pa.binary()), *map(pa.array, parity.T.copy())]
        yield pa.RecordBatch.from_arrays(columns, SIGNATURE)
    if pending:
        counts += np.bincount(np.concatenate(pending), minlength=len(counts))
    if counts.any():
        none = pa.nulls(_COUNT_BLOCKS, pa.int64())
        blocks = [x.astype(np.uint32).tobytes() for x in np.split(counts, _COUNT_BLOCKS)]
        columns = [pa.array(np.ones(_COUNT_BLOCKS, np.int32)), none, pa.array(np.arange(_COUNT_BLOCKS)), none, none]
        columns += [pa.array(blocks, pa.binary()), *[none] * len(_PARITY)]
        yield pa.RecordBatch.from_arrays(columns, SIGNATURE)


def _sum_blocks(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = sum(np.frombuffer(x, np.uint32).astype(np.uint64) for frame in frames for x in frame["counts"])
    yield pd.DataFrame({"block": [key[0]], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})


def _count_table(signatures: DataFrame) -> np.ndarray:
    """Shingle counts over the whole corpus: 2**COUNT_BITS cells, whatever its size."""
    blocks = (
        signatures.where("kind = 1")
        .select(F.col("size").alias("block"), "counts")
        .groupBy("block")
        .applyInPandas(_sum_blocks, "block long, counts binary")
        .collect()
    )
    out = np.zeros((_COUNT_BLOCKS, (1 << COUNT_BITS) // _COUNT_BLOCKS), np.uint32)
    for row in blocks:
        out[row["block"]] = np.frombuffer(row["counts"], np.uint32)
    return out.ravel()


def in_order(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The global order: rare shingles first, ties by hash."""
    return shingles[np.lexsort((shingles, counts[_cell(shingles)]))]


ENTRY = np.dtype([("shingle", "<i8"), ("key", "<i8"), ("size", "<i4"), ("place", "<i4"), ("heavy", "?")])


@tidy
def _prefixes(batches, counts, size: int, percent: int, blocks: int):
    """Packed blocks of prefix entries: shingle, key of the set, its size, place in the order."""
    alphabet, counts = Alphabet(), counts.value
    heavy = max(_SHARE, 8 * (int(counts.sum(dtype=np.uint64)) >> COUNT_BITS))
    seen: set[int] = set()  # copies within the task; others meet in their blocks
    pending: list[tuple[np.ndarray, ...]] = []
    held = 0

    def packed() -> pa.RecordBatch:
        shingle, key, length, place = (np.concatenate(x) for x in zip(*pending, strict=True))
        many = counts[_cell(shingle)].astype(np.uint64)
        spread = np.where(many >= heavy, key.astype(np.uint64) % np.maximum(many // np.uint64(_SHARE), 1), 0)
        block = (mix(shingle + mix(spread.astype(np.uint64))) % np.uint64(blocks)).astype(np.int32)
        order = np.lexsort((shingle, block))
        entries = np.empty(len(order), ENTRY)
        for name, values in zip(ENTRY.names, (shingle.view(np.int64), key, length, place, many >= heavy), strict=True):
            entries[name] = values[order]
        cuts = [0, *(np.flatnonzero(np.diff(block[order])) + 1), len(order)]
        parts = [entries[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(block[order][cuts[:-1]]), pa.array(parts, pa.binary())], ["block", "entries"])

    for batch in batches:
        for _, shingles in _sets(batch.column(0), alphabet, size):
            count = len(shingles)
            if not count or (key := set_key(shingles, 0)) in seen:
                continue
            if len(seen) < _SEEN_LIMIT:
                seen.add(key)
            first = in_order(shingles, counts)[: prefix_length(count, percent)]
            pending.append((first, np.full(len(first), key), np.full(len(first), count), np.arange(len(first))))
            held += len(first)
            if held >= _FLUSH_ENTRIES:
                yield packed()
                pending, held = [], 0
    if pending:
        yield packed()


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """Entries of shingles that more than one set has, and all of the spread ones; copies once."""
    entries = np.concatenate([np.frombuffer(x, ENTRY) for x in frame["entries"]])
    entries = entries[np.lexsort((entries["key"], entries["shingle"]))]
    same = entries["shingle"][1:] == entries["shingle"][:-1]
    entries = entries[np.concatenate(([True], ~(same & (entries["key"][1:] == entries["key"][:-1]))))]
    same = entries["shingle"][1:] == entries["shingle"][:-1]
    keep = entries["heavy"].copy()
    keep[1:] |= same
    keep[:-1] |= same
    return pd.DataFrame({name: entries[name][keep] for name in ENTRY.names if name != "heavy"})


@tidy
def _keyed_sets(batches, size: int):
    alphabet = Alphabet()
    for batch in batches:
        for part in words(batch.column(0), alphabet):
            sets = [shingle_set(part.hashes[x:y], size) for x, y in zip(part.first[:-1], part.first[1:], strict=True)]
            columns = [pa.array([set_key(x, 0) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "shingles"])


def _sets_of(texts: DataFrame, size: int) -> DataFrame:
    """Key and shingles of each text."""
    return texts.select("text").mapInArrow(partial(_keyed_sets, size=size), "key long, shingles binary")


def _candidates(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The sets of the wanted classes (id, key), once each; a class of null ids alone is found by its texts."""
    some = texts.where("text is not null")
    sets = staged(_sets_of(some.join(wanted.where("id is not null"), "id", "left_semi"), size), "candidate-sets", STAGED_ROWS)
    nameless = wanted.where("id is null").select("key")
    if nameless.limit(1).count():
        named, sets = sets, sets.unionByName(_sets_of(some.where("id is null"), size).join(nameless, "key", "left_semi"))
        sets = staged(sets, "candidate-sets", STAGED_ROWS)
        release(named)
    if sets.groupBy("key").count().where("count > 1").limit(1).count():  # repeated ids
        repeated, sets = sets, staged(sets.groupBy("key").agg(F.first("shingles").alias("shingles")), "candidate-sets")
        release(repeated)
    return sets


def _differing(x: np.ndarray, y: np.ndarray) -> int:
    """At least so many shingles are in one of the sorted sets only: their counts differ in ranges of the hash."""
    at = np.arange(1, _BINS, dtype=np.uint64) * np.uint64((1 << 64) // _BINS)
    inner = np.searchsorted(x, at) - np.searchsorted(y, at)
    return int(np.abs(np.diff(inner, prepend=0, append=len(x) - len(y))).sum())


@tidy
def _measured(batches, percent: int):
    """Suffix filter, then the exact overlap, of each pair of sets; union 0 where the filter ends it."""
    for batch in batches:
        shared, total = np.zeros((2, batch.num_rows), np.int64)
        for k, pair in enumerate(zip(batch.column("left_set"), batch.column("right_set"), strict=True)):
            x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in pair)
            size = len(x) + len(y)
            if _differing(x, y) <= size - 2 * needed_overlap(len(x), len(y), percent):
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared[k] = np.count_nonzero(both[1:] == both[:-1])
                total[k] = size - shared[k]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared), pa.array(total)], ["a", "b", "shared", "total"])


def _links(pairs: DataFrame, texts: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets, built from their texts for this, are as similar as links."""
    nodes = staged(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "nodes")
    wanted = staged(classes.select("id", "key").join(nodes, "key", "left_semi"), "wanted")
    sets = _candidates(texts, wanted, size)
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("right_set"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "left_set", "right_set")
    tested = full.mapInArrow(partial(_measured, percent=percent), "a long, b long, shared long, total long")
    links = staged(tested.where(f"total > 0 and 100 * shared >= {percent} * total").select("a", "b"), "links", STAGED_ROWS)
    release(sets, wanted, nodes)
    return links


def _filters(left_size, left_place, right_size, right_place, percent: int):
    """Length filter and, at a first common shingle, the positional filter."""
    small, large = F.least(left_size, right_size), F.greatest(left_size, right_size)
    rest = F.least(left_size - left_place, right_size - right_place)
    return (100 * small >= percent * large) & ((100 + percent) * rest >= percent * (left_size + right_size))


def _bits_allow(percent: int):
    """Suffix filter on the bitmaps of x and y: enough shingles can be in both."""
    apart = sum((F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in _PARITY[1:]), F.bit_count(F.expr(f"x.{_PARITY[0]} ^ y.{_PARITY[0]}")))
    both = F.col("x.size") + F.col("y.size")
    return (100 + percent) * (both - apart) >= 2 * percent * both


def _allowed(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the suffix filter on bitmaps leaves; bitmaps meet pairs, not entries."""
    x, y = bitmaps.alias("x"), bitmaps.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.key")).join(y, F.col("b") == F.col("y.key"))
    return both.where(_bits_allow(percent)).select("a", "b")


def _open(entries: DataFrame, component: DataFrame) -> DataFrame:
    """Entries, with their components, of the shingles whose owners are in several."""
    known = entries.join(component.withColumnRenamed("node", "key"), "key", "left").withColumn("c", F.coalesce("component", "key")).drop("component")
    split = known.groupBy("shingle").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most").select("shingle")
    return staged(known.join(split, "shingle"), "open")


def _with_picked(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of each owner of an open shingle and the one picked there by hash, of another component."""
    owner = F.struct("key", "size", "place", "c")
    picked = members.groupBy("shingle").agg(F.min_by(owner, F.xxhash64("key", "shingle", F.lit(turn))).alias("y")).select("shingle", "y.*")
    x, y = members.alias("x"), picked.alias("y")
    near = x.join(y, "shingle").where("x.c <> y.c").where(_filters(F.col("x.size"), F.col("x.place"), F.col("y.size"), F.col("y.place"), percent))
    return near.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """One row per row of docs: (id, n_shingles, component_id), component_id the smallest id reachable by links.

    Two texts link when 100 * shared shingles >= percent * shingles of either.
    Null and blank texts have no shingles and link with nothing; a text of
    fewer than size words is one shingle. A null id stays, with its own null
    component; equal ids are rows of one class only if their texts link. An
    empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signatures = staged(
        texts.mapInArrow(partial(_signatures, size=size), "kind int, id long, size long, key long, other long, counts binary, " + ", ".join(f"{p} long" for p in _PARITY)),
        "shingle-sets",
        STAGED_ROWS,
    )
    rows = signatures.where("kind = 0").drop("kind", "counts")
    facts = [F.first(x).alias(x) for x in ("size", *_PARITY)]
    classes = rows.where("size > 0").groupBy("key").agg(F.min("id").alias("id"), F.min("other").alias("o"), F.max("other").alias("p"), *facts)
    classes = staged(classes, "set-classes")
    if classes.where("o <> p").limit(1).count():
        raise ValueError("two different sets share a 64-bit key; change the words' seed")

    total = rows.agg(F.sum("size")).first()[0] or 0
    blocks = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // (8 << 20) + 1)
    counts = spark.sparkContext.broadcast(_count_table(signatures))
    entries = (
        texts.select("text")
        .mapInArrow(partial(_prefixes, counts=counts, size=size, percent=percent, blocks=blocks), "block int, entries binary")
        .groupBy("block")
        .applyInPandas(_shared, "shingle long, key long, size int, place int")
    )
    entries = staged(entries, "prefixes", STAGED_ROWS)
    counts.unpersist()

    first = entries.groupBy("shingle").agg(F.min("key").alias("pivot"), F.min(F.struct("key", "size", "place")).alias("p"), F.max("key").alias("q"))
    first = first.where("pivot <> q").select("shingle", "pivot", F.col("p.size").alias("pivot_size"), F.col("p.place").alias("pivot_place"))
    stars = (
        entries.join(first, "shingle")
        .where(F.col("key") != F.col("pivot"))
        .where(_filters(F.col("size"), F.col("place"), F.col("pivot_size"), F.col("pivot_place"), percent))
        .select(F.col("pivot").alias("a"), F.col("key").alias("b"))
        .distinct()
    )
    bitmaps = classes.select("key", "size", *_PARITY)
    stars = staged(_allowed(stars, bitmaps, percent), "pairs")
    links = _links(stars, texts, classes, size, percent)
    component = staged(connected_components(links), "components")

    members = _open(entries, component)
    release(entries)
    if members.limit(1).count():
        picked = reduce(DataFrame.unionByName, [_with_picked(members, turn, percent) for turn in range(_PICKS)])
        picked = staged(_allowed(picked.distinct().join(stars, ["a", "b"], "left_anti"), bitmaps, percent), "pairs")
        known = stars.unionByName(picked)
        links = staged(links.unionByName(_links(picked, texts, classes, size, percent)), "links")
        component = staged(connected_components(links), "components")
        wide, members = members, _open(members.drop("c"), component)
        bare, members = members, staged(members.join(bitmaps.drop("size"), "key"), "open")
        release(wide, bare)
        x, y = members.alias("x"), members.alias("y")
        across = (
            x.join(y, "shingle")
            .where("x.key < y.key and x.c <> y.c")
            .where(_filters(F.col("x.size"), F.col("x.place"), F.col("y.size"), F.col("y.place"), percent))
            .where(_bits_allow(percent))
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
            .distinct()
            .join(known, ["a", "b"], "left_anti")
        )
        across = staged(across, "pairs")
        more = _links(across, texts, classes, size, percent)
        if more.limit(1).count():
            component = staged(connected_components(staged(links.unionByName(more), "links")), "components")
        release(picked, across)
    release(members, stars)

    named = classes.join(component.withColumnRenamed("node", "key"), "key", "left").withColumn("c", F.coalesce("component", "key"))
    smallest = named.groupBy("c").agg(F.min("id").alias("component_id"))
    place = named.join(smallest, "c").select("key", "component_id")
    with_set = rows.where("size > 0").join(place, "key").select("id", "size", "component_id")
    without = rows.where("size = 0").select("id", "size", F.col("id").alias("component_id"))
    return with_set.unionByName(without).select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with its columns of whatever names: the row of smallest id.

    Null and repeated ids are rows of their own; a null id stays only where its
    group has no other. Texts without words stay. An empty table gives an empty result.
    """
    key = free_name(docs, "row")
    rows = staged(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = jaccard_components(rows, id_col=key, text_col=text_col).select(F.col(key).alias("row"), "component_id")
    named = found.join(rows.select(F.col(key).alias("row"), F.col(id_col).alias("id")), "row")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).getField("row")
    kept = named.groupBy("component_id").agg(first.alias(key)).select(key)
    return rows.join(kept, key, "left_semi").select(docs.columns)
