"""Spelling variants: words one edit apart, found by pivotal grams.

1. Words are counted in the scan. Bigrams are ordered by their number in
   different words, rare ones first.
2. A word's prefix is its three rarest bigrams. Among them dynamic programming
   picks the two that do not overlap and are rarest together: its pivots p < q.
   One edit destroys at most one of them, and for any two words one edit apart
   the surviving pivots of one are in the gram prefix of the other.
3. An edit lies before p, in p, between, in q or behind q. Everything on its
   other sides is unchanged, at the same distance from the start or from the
   end of the word. The word whose pivots are looked up gives one key for each
   of the five cases, from gram, place and unchanged sides; the other gives the
   keys under which its prefix grams can be met.
4. Keys are joined, pairs checked once by edit distance in the join, and told
   once. A word's form is its commonest neighbour if that is common enough; the
   root follows forms to their end by doubling.

Every word gives a number of keys bounded by a constant and the logarithm of
its length, so no gram, however frequent, makes a list in one task.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import staged

LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 7, 2, 10
ONE_IN = 31
_EDITS = 1
_GRAMS = 2 * _EDITS + 1  # bigrams an edit can touch, and one more
_NEW_GRAMS = 2  # copies of a bigram that an edit can put before another copy
_SHORT = 2  # characters of the shorter unchanged side that a key holds
_EXACT = 24  # longer unchanged sides are cut to lengths of 24, 48, 96 ...
_BATCH_BYTES = 4 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _run_pattern(least: int) -> str:
    return f"[A-Za-zÀ-ÿ]{{{least},}}"


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run, or one code point less where the checksum of id and run says so."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(check, F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % ONE_IN == 0, less).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words long and frequent enough. Shorter runs cannot become longer, so they are not taken out."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(_run_pattern(least_length)), F.lit(0))).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    words = runs.select("id", lower.alias("run")).select(misspelt(F.col("id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _gram_counts(batches):
    for batch in batches:
        counts: dict[str, int] = {}
        for word in batch.column("word").to_pylist():
            for at in range(len(word) - 1):
                gram = word[at : at + 2]
                counts[gram] = counts.get(gram, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])


def gram_order(words: DataFrame) -> dict[str, int]:
    """Place of each bigram by rarity; there are at most 90 x 90 bigrams of the letters that runs consist of."""
    counts = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row["gram"]: place for place, row in enumerate(counts.orderBy("n", "gram").collect())}


def prefix_grams(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(order, place) of the word's rarest bigrams, rarest first, and at equal order from the left.

    The first _GRAMS are the prefix proper. Copies of its last bigram follow, as
    many as an edit can have moved behind another one.
    """
    grams = sorted((order[word[at : at + 2]], at) for at in range(len(word) - 1))
    last = grams[min(_GRAMS, len(grams)) - 1][0]
    before = [g for g in grams[:_GRAMS] if g[0] < last]
    same = [g for g in grams[len(before) : len(before) + _GRAMS + _NEW_GRAMS] if g[0] == last]
    return before + same


def pivots(prefix: list[tuple[int, int]], wanted: int = _EDITS + 1) -> list[int]:
    """Places of `wanted` bigrams that do not overlap, of least summed order, by dynamic programming from the left."""
    grams = sorted((at, cost) for cost, at in prefix)
    # best[k]: (cost, places) of k bigrams among those so far
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * wanted]
    for index, (at, cost) in enumerate(grams):
        free = max((j + 1 for j in range(index) if grams[j][0] + 2 <= at), default=0)
        row = list(best[-1])
        for k in range(1, wanted + 1):
            if (rest := best[free][k - 1]) is not None:
                chosen = (rest[0] + cost, (*rest[1], at))
                row[k] = chosen if row[k] is None else min(row[k], chosen)
        best.append(row)
    return list(best[-1][wanted][1])


def _cut(length: int) -> int:
    """The length itself, or the greatest of 24, 48, 96 ... that it reaches."""
    return length if length < _EXACT else _EXACT << ((length // _EXACT).bit_length() - 1)


def _touched_key(word: str, at: int) -> tuple:
    """The key for an edit within the bigram at a place: the longer unchanged side, and a little of the shorter."""
    head, tail = at, len(word) - at - 2
    if head > tail:
        short, length = min(_SHORT, tail), _cut(head)
        return ("head", length, short, word[:length], word[len(word) - short :])
    short, length = min(_SHORT, head), _cut(tail)
    return ("tail", length, short, word[len(word) - length :], word[:short])


def pivot_keys(word: str, prefix: list[tuple[int, int]]) -> set[tuple]:
    p, q = pivots(prefix[:_GRAMS])
    end = len(word)
    return {
        ("before", end - p, 0, word[p:], ""),
        ("between", p, end - q, word[: p + 2], word[q:]),
        ("behind", q, 0, word[: q + 2], ""),
        _touched_key(word, p),
        _touched_key(word, q),
    }


def prefix_keys(word: str, prefix: list[tuple[int, int]]) -> set[tuple]:
    end, places = len(word), [at for _, at in prefix]
    keys = {("before", end - at, 0, word[at:], "") for at in places} | {("behind", at, 0, word[: at + 2], "") for at in places}
    keys |= {("between", p, end - q, word[: p + 2], word[q:]) for p in places for q in places if q >= p + 2}
    first, last = min(places), max(places)
    # The other word is at most one longer or shorter; its unchanged sides have `rest` characters together.
    for rest in (end - 3, end - 2, end - 1):
        exact = range((rest + 1) // 2, min(rest + 1, _EXACT))
        sides = [(length, rest - length, rest - length) for length in exact]
        # Of a side cut to 24, 48 ... the true length, and with it the other side's, is open.
        cuts = [_EXACT << k for k in range((rest // _EXACT).bit_length())]
        sides += [(length, short, end) for length in cuts for short in range(_SHORT + 1)]
        for length, short, reach in sides:
            short = min(short, _SHORT)
            if length + short > end:
                continue
            # The pivot that survives is a prefix gram of this word, on one of the unchanged sides.
            if last >= end - length or first + 2 <= reach:
                keys.add(("tail", length, short, word[end - length :], word[:short]))
            if first + 2 <= length or last >= end - reach:
                keys.add(("head", length, short, word[:length], word[end - short :]))
    return keys


def _keyed(batches, order: dict[str, int], pivotal: bool):
    """Rows (key, word, n, last): last is the order of the last prefix gram."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        held = 0
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
            prefix = prefix_grams(word, order)
            keys = (pivot_keys if pivotal else prefix_keys)(word, prefix)
            for kind, one, two, head, tail in keys:
                out[0].append(xxhash.xxh64_intdigest(f"{kind} {one} {two} {head} {tail}") - (1 << 63))
            for column, value in zip(out[1:], (word, n, prefix[:_GRAMS][-1][0]), strict=True):
                column.extend([value] * len(keys))
            held += len(keys) * (len(word) + 24)
            if held >= _BATCH_BYTES:
                yield _batch(out)
                out, held = ([], [], [], []), 0
        yield _batch(out)


def _batch(out) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(out, types, strict=True)], ["key", "word", "n", "last"])


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) with a < b: pairs of words that differ by one inserted, deleted or replaced code point, each once."""
    order = gram_order(words)
    schema = "key long, word string, n long, last int"
    looked = words.mapInArrow(partial(_keyed, order=order, pivotal=True), schema)
    index = words.mapInArrow(partial(_keyed, order=order, pivotal=False), schema)
    s, r = looked.alias("s"), index.alias("r")
    apart = F.abs(F.length("s.word") - F.length("r.word"))
    met = s.join(r, (F.col("s.key") == F.col("r.key")) & (F.col("s.last") <= F.col("r.last")) & (apart <= _EDITS) & (F.levenshtein("s.word", "r.word", _EDITS) == _EDITS))
    a, b = F.struct(F.col("s.word").alias("word"), F.col("s.n").alias("n")), F.struct(F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    pair = met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    return pair.select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to their end; a form is far commoner than its word, so chains are short."""
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = staged(moved, "roots")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = FORM_RATIO) -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n).

    Words are the maximal runs of Latin letters of whole texts in lower case,
    changed by `misspelt`, of at least seven code points and two occurrences.
    n_near counts the words one edit away. The form is the commonest of them
    (ties: the smallest in code-point order) if it occurs `ratio` times as often,
    else null, and then form_n is null too; the root is the last form that
    forms lead to, or the word itself. Null and empty texts have no words, a
    null id counts as an empty one in the checksum, repeated rows count again,
    other columns are ignored, and an empty table gives an empty result.
    """
    words = staged(count_words(docs, id_col, text_col), "words")
    pairs = staged(near_words(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("word")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.first("a_n").alias("n"), best.alias("best"))
    common = -F.col("best.less") >= ratio * F.col("n")
    near = staged(near.select("word", "n_near", F.when(common, F.col("best.word")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(near.where("form is not null"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
