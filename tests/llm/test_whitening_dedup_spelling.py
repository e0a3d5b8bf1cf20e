"""Whitening, exact duplicates and spelling variants against plain Python on small data."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from salespect.llm import exact_dedup, spelling, whitening

# --- whitening --------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, n long, x string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "x") for i, v in rows], VECTORS).repartition(3)


def expected_whitening(vectors, most):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    keep = [k for k in np.argsort(-e)[:most] if e[k] > 1e-20 * e.max()]
    deviation = [sum(int(c) ** 2 for c in row) for row in n * x - sums]
    return centred @ v[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum(), deviation


@pytest.mark.parametrize("width, count, most", [(5, 40, 32), (12, 300, 4), (1, 7, 32)])
def test_whitening_equals_the_eigenvectors(spark, width, count, most):
    made = np.random.default_rng(width).standard_normal((count, width)) * np.arange(1, width + 1)
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    found = whitening.whiten(vectors_of(spark, rows), most).toPandas()
    want, explained, deviation = expected_whitening(made, most)
    assert list(found.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(found) == count * min(width, most) and (found["n"] == count).all()
    got = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * sign, atol=1e-9)
    assert np.allclose(found[found["vec_id"] == 0].sort_values("component")["explained"], explained, rtol=1e-9)
    assert found.drop_duplicates("vec_id").sort_values("vec_id")["deviation"].tolist() == deviation
    assert found["identity_error"].nunique() == 1 and found["identity_error"][0] < 1e-9


def test_whitening_of_repeated_and_missing_variances(spark):
    """Two equal variances and a constant direction: any basis of the plane, none of the constant."""
    made = [(s * a, s * b, 3.0) for s in (1.0, -1.0) for a, b in ((1, 0), (0, 1))]
    found = whitening.whiten(vectors_of(spark, [(i, list(map(float, v))) for i, v in enumerate(made)])).toPandas()
    assert sorted(found["component"].unique()) == [1, 2]
    w = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(w.T @ w / 4, np.eye(2), atol=1e-9) and np.allclose(found["explained"], 0.5)


def test_whitening_leaves_out_unusable_vectors(spark):
    good = [(None, [1.0, 2.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 5.0])]
    bad = [(3, None), (4, []), (5, [1.0, None]), (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (8, [1.0]), (9, [3e38, 1.0])]
    found = whitening.whiten(vectors_of(spark, good + bad))
    assert found.select("vec_id", "n").distinct().count() == 3 and found.count() == 8
    assert {r["n"] for r in found.collect()} == {4}
    nothing = whitening.whiten(vectors_of(spark, [(1, [2.0, 2.0]), (2, [2.0, 2.0])]))
    assert nothing.count() == whitening.whiten(vectors_of(spark, bad[:5])).count() == 0
    assert nothing.columns == found.columns


def test_whitening_deviation_is_exact_or_null(spark):
    rows = [(0, [1e9, 1.0]), (1, [-1e9, 2.0]), (2, [0.0, 3.0])]
    found = {r["vec_id"]: r["deviation"] for r in whitening.whiten(vectors_of(spark, rows)).collect()}
    x = [[64 * 10**9 + 10**6, 10**6 + 64], [-64 * 10**9 + 10**6, 10**6 + 128], [10**6, 10**6 + 192]]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    assert found == {i: w if w < 1 << 63 else None for i, w in enumerate(want)}
    assert None in found.values() and found[2] == want[2]


# --- exact duplicates -------------------------------------------------------

DOCS = "doc_id long, text string, digest string, file string, row long, keep_id int"
TEXTS = [(1, "a"), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "a"), (None, "only"), (5, "A"), (6, "a "), (7, "ü" * 300_000), (8, "ü" * 300_000), (9, "hot")]
TEXTS += [(n, "hot") for n in range(100, 190)]


def folder_of(spark, path, rows, parts=3):
    spark.createDataFrame([(i, t, "d", "f", 0, 1) for i, t in rows], DOCS).repartition(parts).write.parquet(path)
    return path


def expected_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def check_groups(found, rows):
    found = found.collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found], key=repr) == expected_groups(rows)
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len({t or "" for _, t in rows}) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def weak(text):
    return (F.length(text) % 3).cast("string").cast("binary")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_duplicates(spark, tmp_path, monkeypatch, digest):
    """With a digest that nearly always collides too, the bytes decide; copies of one text go to several tasks."""
    monkeypatch.setattr(exact_dedup, "PIECE_BYTES", 16)
    path = folder_of(spark, f"{tmp_path}/documents.parquet", TEXTS)
    check_groups(exact_dedup.exact_duplicates(spark, path, digest=digest, batch_bytes=2000), TEXTS)


def test_exact_duplicates_remember_earlier_files(spark, tmp_path):
    path, state = f"{tmp_path}/documents.parquet", f"{tmp_path}/state"
    check_groups(exact_dedup.exact_duplicates(spark, folder_of(spark, path, TEXTS), state), TEXTS)
    more = [(50, "a"), (51, "new"), (0, "")]
    spark.createDataFrame([(i, t, "d", "f", 0, 1) for i, t in more], DOCS).write.mode("append").parquet(path)
    check_groups(exact_dedup.exact_duplicates(spark, path, state), TEXTS + more)


def test_exact_duplicates_of_no_rows_and_of_one_file(spark, tmp_path):
    empty = exact_dedup.exact_duplicates(spark, folder_of(spark, f"{tmp_path}/none.parquet", [], 1))
    assert empty.count() == 0 and empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    folder = folder_of(spark, f"{tmp_path}/one", TEXTS, 1)
    (single,) = Path(folder).glob("part-*.parquet")
    check_groups(exact_dedup.exact_duplicates(spark, str(single)), TEXTS)


def test_exact_duplicates_run_without_python_workers(spark, tmp_path):
    found = exact_dedup.exact_duplicates(spark, folder_of(spark, f"{tmp_path}/documents.parquet", TEXTS))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def open_stores(spark):
    stores = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.streaming.state.StateStore$")
    field = stores.getDeclaredField("loadedProviders")
    field.setAccessible(True)
    return set(field.get(stores.getField("MODULE$").get(None)).keys().mkString("\n").split("\n"))


def test_exact_duplicates_leave_no_state_store_open(spark, tmp_path):
    """A store per partition is closed with its task: many partitions take no memory together."""
    before, state = open_stores(spark), f"{tmp_path}/state"
    exact_dedup.remember(spark, folder_of(spark, f"{tmp_path}/documents.parquet", TEXTS), state)
    assert open_stores(spark) <= before
    assert len(list(Path(state).glob("state/0/[0-9]*"))) == int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- spelling variants ------------------------------------------------------

TEXT_ROWS = "doc_id long, text string, word string, n int, form string"


def expected_variants(rows, ratio=10):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + (len(a) >= len(b)) :] == b[at + (len(b) >= len(a)) :]


def check_variants(spark, rows):
    docs = spark.createDataFrame([(i, t, "w", 1, "f") for i, t in rows], TEXT_ROWS).repartition(3)
    found = [tuple(r) for r in spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = expected_variants(rows)
    assert len(found) == len(set(found)) and set(found) == want
    return want


def misspellings(seed, letters, bases, count):
    """Documents of random words and of words that lie one or two edits from them."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(7, 12))) for _ in range(bases)]
    rows = []
    for i in range(count):
        text = []
        for _ in range(40):
            word = words[min(int(rng.expovariate(0.15)), bases - 1)]
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
                at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
                word = word[:at] + (rng.choice(letters) if kind else "") + word[at + (kind < 2) :]
            text.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice((" ", "-", "_", "1")).join(text)))
    return rows


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abc"), (3, "abcdefgh"), (4, "aà÷Ößz"), (5, "a")])
def test_spelling_variants(spark, seed, letters):
    want = check_variants(spark, misspellings(seed, letters, 60, 60))
    assert seed == 5 or sum(n_near for *_, n_near, _ in want) > 100


def test_spelling_variants_of_odd_texts(spark):
    long = "ab" * 30 + "c" * 40
    odd = [None, "", " ", "short words on", "seven77letters", "abcdefg ABCDEFG", "word" * 2000, "x" * 50_000, "x" * 50_000, "x" * 49_999, "x" * 49_999]
    odd += [f"{long} {long[:k]}{long[k + 1:]} {long[:k]}z{long[k:]}" for k in (0, 23, 24, 25, 47, 60, 98)] * 2
    rows = [(i, t) for i, t in enumerate(odd)] + [(None, "without identifier"), (5, "abcdefg ABCDEFG"), (5, "abcdefg ABCDEFG"), (None, "without identifiers")] * 2
    check_variants(spark, rows)
    assert check_variants(spark, [(1, None)]) == set()
    assert spelling.spelling_variants(spark.createDataFrame([], TEXT_ROWS)).count() == 0


def test_roots_follow_forms_to_their_end(spark):
    rows = [(n, "leaders") for n in range(4000)] + [(n, "leaderz") for n in range(300)] + [(n, "laederz") for n in range(2)] + [(n, "leaderzz") for n in range(20)] + [(n, "leaderzzx") for n in range(2)]
    want = {w: (form, root) for w, form, root, *_ in check_variants(spark, rows)}
    assert want["leaderzzx"] == ("leaderzz", "leaders")


@pytest.mark.parametrize("seed, letters, most", [(1, "ab", 14), (2, "abcd", 11), (3, "a", 9), (4, "ab", 60), (5, "ab", 130)])
def test_every_near_pair_shares_a_key(seed, letters, most):
    rng = random.Random(seed)
    bases = ["".join(rng.choices(letters, k=rng.randint(7, most))) for _ in range(120)]
    words = {v for w in bases for k in range(len(w) + 1) for v in (w, w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]) if len(v) >= 7}
    counts = collections.Counter(w[k : k + 2] for w in words for k in range(len(w) - 1))
    order = {g: n for n, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    prefix = {w: spelling.prefix_grams(w, order) for w in words}
    index = collections.defaultdict(set)
    for w in words:
        for key in spelling.prefix_keys(w, prefix[w]):
            index[key].add(w)
    last = {w: prefix[w][:3][-1][0] for w in words}
    met = {frozenset((w, v)) for w in words for key in spelling.pivot_keys(w, prefix[w]) for v in index[key] if last[w] <= last[v]}
    assert {frozenset(p) for p in near_pairs(words)} <= met


def near_pairs(words):
    without = collections.defaultdict(set)
    for w in words:
        for k in range(len(w)):
            without[w[:k] + w[k + 1 :]].add(w)
    for v, found in without.items():
        for w in found | ({v} & words):
            yield from ((w, u) for u in found | ({v} & words) if u < w and one_edit(u, w))
