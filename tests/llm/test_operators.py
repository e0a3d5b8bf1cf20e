"""Each corpus operator against brute force on small data, and on nulls, empty and long texts, copies and no rows."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salespect.llm import decontaminate, html_text, jaccard_join, language, packing, quality, token_counts, toxicity, vectors, wavelet

BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score int, id string"


LIBRARY = Tokenizer.from_file(BPE)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def prose(seed, count):
    return " ".join(random.Random(seed).choices([f"w{n}a" for n in range(400)], k=count))


TEXTS = [
    None, "", " ", "\n\n", "one", "a  b\n\n  c ", "tab\there x", "nbsp  x y", "<|endoftext|> x<|endoftext|>", "it's 12 €5 ünï", "end  ", prose(1, 9000), prose(2, 60), prose(2, 60),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "en" if n % 2 else None, None, None, 1, "x") for n, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (None, "no id", None, None, None, None, None), rows[4]], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_token_counts(docs, nothing):
    rows = token_counts.token_counts(docs, BPE).collect()
    assert len(rows) == docs.count() and token_counts.token_counts(nothing, BPE).count() == 0
    for r in rows:
        if r["doc_id"] is not None:
            text = TEXTS[r["doc_id"]] or ""
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), len(ids_of(text)), len(ids_of(text)) > 1024)


def test_wavelet_files_give_the_ids_back(docs, nothing):
    found = wavelet.wavelet_round_trip(docs, BPE, end_id=2, shard_tokens=40).orderBy("start").collect()
    assert len({(r["part"], r["shard"]) for r in found}) > 2
    assert found[0]["doc_id"] is None and wavelet.wavelet_round_trip(nothing, BPE, end_id=2).count() == 0
    start = 0
    for r in found:
        text = "no id" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        ids = np.array([*ids_of(text), 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 3000])
def test_wavelet_matrix(size):
    ids = np.random.default_rng(size).integers(0, 37, size).astype(np.uint32)
    matrix, names, lengths = wavelet.load_shard(wavelet.dump_shard(ids, [7, None], [size, 0]))
    assert matrix.all().tolist() == ids.tolist() and lengths.tolist() == [size, 0] and names[0] == 7
    for value in (0, 5, 36, 63, 1000):
        where = np.flatnonzero(ids == value).tolist()
        assert matrix.count(value) == len(where)
        assert [matrix.select(value, n) for n in range(len(where))] == where
        assert matrix.select(value, len(where)) == -1
    assert [matrix.access(n) for n in range(0, size, 97)] == ids[::97].tolist()
    assert matrix.rank(5, size // 2) == (ids[: size // 2] == 5).sum()


def test_packing(docs, nothing):
    rows = packing.piece_digests(packing.pack(docs, BPE, end_id=1, window=64, digests=True)).collect()
    assert packing.pack(nothing, BPE, end_id=1).count() == 0
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] is not None:
            ids = np.array([*ids_of(TEXTS[r["doc_id"]]), 1], "<u4")
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r["length"] for r in rows) == sum(len(ids_of(t)) + 1 for t in [*TEXTS, "no id", TEXTS[4]])


def test_packing_places_every_piece_once():
    histogram = np.random.default_rng(4).integers(0, 30, 257)
    plan, chosen = packing.pack_histogram(histogram)
    made = np.zeros(257, np.int64)
    for lengths, repeats in chosen:
        assert sum(lengths) <= 256
        for length in lengths:
            made[length] += repeats
    assert made[1:].tolist() == histogram[1:].tolist()
    total = sum(repeats for _, repeats in chosen)
    assert (np.arange(257) * histogram).sum() / (256 * total) > 0.95


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_jaccard_components(spark, nothing):
    base = prose(3, 80).split()
    texts = [None, "", "one two", "One TWO", *([" ".join(base)] * 3)]
    for n in range(12):
        near = base.copy()
        for k in range(0, n % 5):
            near[(7 * n + 19 * k) % 80] = f"z{n}{k}"
        texts.append(" ".join(near))
    frame = spark.createDataFrame([(n, t, 1) for n, t in enumerate(texts)], "doc_id long, text string, id int")
    sets = [shingles(t) for t in texts]
    part = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    part[a] = part[b] = min(part[a], part[b])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame).collect()}
    assert found == {n: (len(s), part[n]) for n, s in enumerate(sets)}
    assert jaccard_join.jaccard_components(nothing).count() == 0


def test_jaccard_links_pass_through_a_set_without_ids(spark):
    base = prose(8, 100).split()
    middle = [*base[:90], *(f"e{n}" for n in range(10))]
    other = [*(f"s{n}" for n in range(10)), *middle[10:]]
    rows = [(0, " ".join(base)), (None, " ".join(middle)), (None, " ".join(middle)), (1, " ".join(other)), (1, prose(9, 50)), (1, " ".join(other))]
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in found) == [("0", 0), ("1", 0), ("1", 0), ("1", 1), ("None", 0), ("None", 0)]


def test_one_per_group_with_null_and_repeated_ids(spark):
    import corpus_pipeline

    a, b, c, d = (prose(n, 60) for n in range(50, 54))
    rows = [(None, a), (None, b), (None, b), (4, b), (3, b), (7, c), (7, c), (7, d), (None, None), (9, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.one_per_group(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted(map(repr, kept.collect())) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in [(None, a), (3, b), (7, c), (7, d), (None, None), (9, "")])


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 24))
    rows = [(base[n % 12] + rng.normal(size=24) * 0.22).tolist() for n in range(150)] + [base[0].tolist()] * 40
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None] * 12, [float("inf")] * 24, [1.0, 2.0]]
    frame = spark.createDataFrame([(n, v, n) for n, v in enumerate(rows + bad)], "vec_id long, embedding array<double>, key int")
    found = {r["vec_id"]: r for r in vectors.near_vectors(frame).collect()}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    want = linked.sum(axis=1) - 1
    got = np.array([found[n]["n_links"] for n in range(len(rows))])
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()
    assert len(found) == len(rows) + len(bad)
    assert all(found[len(rows) + n]["n_links"] == 0 and found[len(rows) + n]["kept"] for n in range(len(bad)))
    assert len({found[n]["component_id"] for n in range(150, 190)}) == 1
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def clouds(width, count, seed):
    """Half of the vectors in one group around a hub, the others scattered; some repeated."""
    rng = np.random.default_rng(seed)
    hub = rng.normal(size=width)
    rows = np.where((np.arange(count) % 2 == 0)[:, None], hub + rng.normal(size=(count, width)) * 0.22, rng.normal(size=(count, width)))
    return np.concatenate((rows, rows[:7]))


@pytest.mark.parametrize("width, exact", [(8, False), (16, False), (64, True)])
def test_near_vectors_lose_no_link(spark, width, exact):
    """Few dimensions, or exact visits: link counts and components equal brute force, ids null and repeated too."""
    rows = clouds(width, 700, width)
    ids = [None, 5, 5, *range(3, len(rows))]
    frame = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>, n_links string")
    found = vectors.near_vectors(frame, exact=exact).collect()
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    name = np.arange(len(rows))
    while True:
        low = np.where(linked, name[None, :], len(rows)).min(axis=1)
        if (low == name).all():
            break
        name = low
    least = {c: min(i for i, k in zip(ids, name, strict=True) if k == c and i is not None) for c in set(name.tolist()) if any(k == c and i is not None for i, k in zip(ids, name, strict=True))}
    want = sorted((str(i), int(linked[n].sum()) - 1, str(least.get(name[n]))) for n, i in enumerate(ids))
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in found) == want


@pytest.mark.parametrize("width", [64, 256])
def test_near_vectors_recall(spark, width):
    """Many dimensions, half of the vectors in one group: recall of links by the usual visits."""
    rows = clouds(width, 2000, 3)
    frame = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(rows)], "vec_id long, embedding array<double>")
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum() - len(rows)
    found = sum(r["n_links"] for r in vectors.near_vectors(frame).collect())
    assert 0.97 * want <= found <= want


def tiled(text, item, shortest):
    """Greedy string tiling by comparing words at every pair of places."""
    free_text, free_item, marked = [True] * len(text), [True] * len(item), 0
    while True:
        best = []
        for b in range(len(item)):
            for a in range(len(text)):
                n = 0
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and free_text[a + n] and free_item[b + n]:
                    n += 1
                if n >= shortest and n >= (best[0][0] if best else 1):
                    best = [*(best if best and best[0][0] == n else []), (n, a, b)]
        if not best:
            return marked
        for n, a, b in best:
            if all(free_text[a : a + n]) and all(free_item[b : b + n]):
                free_text[a : a + n] = free_item[b : b + n] = [False] * n
                marked += n


def test_tiling_equals_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        kinds = rng.choice((2, 4, 12))
        text, item = ([rng.randrange(kinds) for _ in range(rng.randint(0, 40))] for _ in "ab")
        shortest = rng.randint(1, 5)
        hashes = [np.array([zlib.crc32(bytes([x])) * 0x9E3779B97F4A7C15 % 2**64 for x in side], np.uint64) for side in (text, item)]
        assert decontaminate.tiling(*hashes, shortest) == tiled(text, item, shortest)


def test_leaks_and_near_copies_keep_clashing_columns(spark):
    import corpus_pipeline

    item = prose(9, 40)
    rows = [(1, item, 1, "a"), (1, item, 1, "a"), (None, "clean " + prose(10, 40), 2, "b"), (3, "", 3, "c"), (4, None, 4, None), (5, "x " * 200_000 + item, 5, "e"), (None, item, 6, "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int, row_key string").withColumnRenamed("row", "Row")
    benchmark = spark.createDataFrame([(None, item, "x"), (2, "", "x"), (2, None, "x")], "item_id long, text string, row_key string")
    clean = decontaminate.clean_documents(frame, benchmark)
    assert clean.columns == frame.columns and sorted(r["Row"] for r in clean.collect()) == [2, 3, 4]
    kept = corpus_pipeline.one_per_group(spark, frame, "")
    assert kept.columns == frame.columns and sorted(r["Row"] for r in kept.collect()) == [1, 2, 3, 4]  # the long text has 41 shingles, 36 of them the item's
    empty = frame.limit(0)
    assert decontaminate.clean_documents(empty, benchmark).count() == corpus_pipeline.one_per_group(spark, empty, "").count() == 0
    assert decontaminate.clean_documents(frame, benchmark.limit(0)).count() == len(rows)


def test_tiling_finds_reordered_passages(spark):
    item = [f"i{n}" for n in range(40)]
    other = [f"o{n}" for n in range(40)]
    texts = [" ".join(item), " ".join([*other, *item[20:], *other[:9], *item[:20]]), " ".join(item[:12] + other), " ".join(other), None, "", "I0, i1! I2 " + " ".join(item[3:])]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, " ".join(item)), (8, None), (7, ""), (6, "never here at all")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["marked"]) for r in decontaminate.benchmark_leaks(frame, benchmark, block_bytes=10).collect()}
    assert found == {(0, 9, 40), (1, 9, 40), (6, 9, 40)}
    assert {r["doc_id"] for r in decontaminate.clean_documents(frame, benchmark).collect()} == {2, 3, 4, 5}
    assert decontaminate.benchmark_leaks(frame, benchmark.limit(0)).count() == 0


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a href='/x'>menu</a></nav><div class='ad'>buy</div>"
        "<article><h1>A &amp;  B</h1><p><b>one\n two.<br><p>three<div class='comments'><p>me too</p></div><aside>side</aside></article><footer>&copy; x"
    )
    assert html_text.main_text(page) == "A & B\n\none two.\n\nthree"
    plain = "<body><ul><li><a href=x>a</a><li><a href=y>b</a></ul><div><p>" + "Words, and more words. " * 20 + "</p><p>" + "Other, longer words. " * 20 + "</p></div></body>"
    assert html_text.main_text(plain).count("\n\n") == 1 and html_text.main_text(plain).startswith("Words,")
    frame = spark.createDataFrame([(1, "u", page), (2, None, None), (None, None, "")], "page_id long, url string, html string")
    assert {(r["page_id"], r["n_chars"]) for r in html_text.extract_text(frame).collect()} == {(1, 22), (2, 0), (None, 0)}


def test_ratios_decide_also_beside_and_inside_an_article():
    long = ["Main words, and more of them here. " * 20, "Other main words, longer ones still. " * 18, "Third part, of the same kind. " * 25]
    teaser = "<body><article><p>Read this.</p></article><div>" + "".join(f"<p>{x}</p>" for x in long) + "</div></body>"
    assert all(x.strip() in html_text.main_text(teaser) for x in long)
    text = "<body><article><h2>Title</h2>" + "".join(f"<p>{x} see <a href=x>the source</a> for it.</p>" for x in long)
    links = "<ul>" + "".join(f"<li><a href=/{n}>other page {n}</a>" for n in range(8)) + "</ul>"
    items = "<ol>" + "".join(f"<li>plain item {n}" for n in range(8)) + "</ol>"
    found = html_text.main_text(text + links + items + "</article></body>")
    assert found.startswith("Title\n\nMain") and found.count("the source") == 3 and found.count("plain item") == 8 and "other page" not in found


def test_names_of_parts_do_not_empty_a_page():
    text = "Words, and more words of the page. " * 20
    for page in (
        f'<body class="no-sidebar"><article><p>{text}</p></article></body>',
        f'<body class="sidebar"><article><p>{text}</p></article></body>',
        f'<body><div id="page" class="has-sidebar"><article><p>{text}</p></article></div></body>',
        f'<body><article aria-label="Reply to a letter"><p>{text}</p></article></body>',
        f'<body><div class="notice"><p>{text}</p></div></body>',
    ):
        assert html_text.main_text(page) == text.strip(), page
    assert html_text.main_text(f'<body><article><p>{text}</p><div class="box ad"><p>Buy this, now.</p></div></article></body>') == text.strip()


def test_elements_without_end_tags_and_embedded_text_stay():
    text = "Words, and more words of the page. " * 20
    for start in ("<form><input list=q><datalist id=q><option value=x></datalist></form>", "<div><select><option>a<option>b</div>", "<iframe src=x>", "<template>", "<svg><path d=x>", "<div><object data=x></div>", "<canvas>"):
        assert text.strip() in html_text.main_text(f"<body>{start}<article><p>{text}</p></article></body>"), start
    inner = "<noscript>no script</noscript> <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></math> <object>an object</object> <canvas>drawn</canvas> <button>a button</button> <svg><path d=x /></svg>end"
    page = f"<body><article><p>{text}{inner}</p><script>no</script><textarea>nor</textarea><iframe>this</iframe><template><p>here</p></template></article></body>"
    assert html_text.main_text(page) == text + "no script x=2 an object drawn a button end"


def test_quality_separates_junk(spark, nothing):
    clean = [prose(n, 40 + n) + "." for n in range(80)]
    junk = ["".join(f"{w}$$$ " for w in prose(n, 50).split()) for n in range(12)] + ["again " * 60] * 3
    frame = spark.createDataFrame([(n, t) for n, t in enumerate([*clean, *junk, None, "", " "])], "doc_id long, text string")
    model = quality.train(frame)
    kept = {r["doc_id"] for r in quality.score_quality(frame, model).where("keep").collect()}
    assert kept == set(range(80))
    assert {r["doc_id"] for r in quality.keep_good(frame, model).collect()} == kept
    assert quality.score_quality(nothing, quality.train(nothing)).count() == 0


def test_toxicity_on_held_out_rows(spark, nothing):
    texts = [prose(n, 60) + (" rotten vermin you " if n % 4 == 0 else "") for n in range(300)]
    frame = spark.createDataFrame([*enumerate(texts), (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(n, None, int(n % 4 == 0)) for n in range(300)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.training_rows(frame, labels))
    rows = toxicity.score_toxicity(frame, model).collect()
    assert len(rows) == 302 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == int(r["doc_id"] < 300 and r["doc_id"] % 4 == 0) for r in rows)
    assert toxicity.drop_toxic(frame, model).count() == 302 - 75
    empty = toxicity.train(toxicity.training_rows(nothing, labels))
    assert toxicity.score_toxicity(nothing, empty).count() == 0


def test_language_fuses_evidence(spark, nothing):
    words = {"en": ["the", "with", "thing"], "de": ["und", "schlich", "zung"]}
    docs = spark.createDataFrame([(n, " ".join(words[k] * 9), k) for n in range(6) for k in words] + [(99, None, "fr"), (98, "x", None)], "doc_id long, text string, lang string")
    def page(text, lang):
        return f'<html lang="{lang}"><body><article><p>{text}</p></article></body></html>'

    pages = [(n, "https://a.example.de/x", page("und schlich zung " * 5, "de")) for n in range(9)] + [(n, "https://b.example.com", page("the with thing " * 5, "en")) for n in range(10, 19)]
    pages += [(20, "https://a.example.de/y", None), (21, None, None), (22, "https://b.example.com/z", page("und schlich zung " * 9, "en"))]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    model = language.train(docs)
    found = {r["page_id"]: r["lang"] for r in language.identify(frame, *model).collect()}
    assert len(found) == len(pages) and found[0] == "de" and found[10] == "en" and found[20] == "de" and found[22] == "de"
    assert language.identify(frame, *language.train(nothing)).where("lang is null").count() == len(pages)
    assert language.identify(frame.limit(0), *model).count() == 0


def test_pipeline_keeps_clean_documents_only(spark, tmp_path):
    import corpus_pipeline

    clean = [prose(n, 60) for n in range(120)]
    bench = prose(777, 40)
    rows = [*clean, clean[3] + " tail", prose(500, 30) + " " + bench, prose(501, 50) + " rotten vermin", "junk$$$ more### " * 30, None]
    toxic = [prose(n, 60) + " rotten vermin" for n in range(1000, 1060)]
    frame = spark.createDataFrame([(n, t, "en", "s", 0) for n, t in enumerate(rows + toxic)], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(n, 1, int(n > 120)) for n in [*range(120), *range(125, 185)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept == set(range(120))


def test_encoder_equals_the_library(monkeypatch):
    """Whole texts of every kind, and a store of pieces so small that it turns over all the time."""
    from salespect.llm import tokens

    rng = random.Random(5)
    signs = [*"ab Z9 \n\t'sdmtlvre.,-<|>éß²½×’…€Ł中", "<|endoftext|>", "'s", "  ", "　", "\x1f", "\x85", "​", "­", " ", "'ll", "12", "\U0001f600"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["x" * 500 + " y", "日本 " * 30_000, " ".join(f"wörter{n}" for n in range(30_000)) + "　z", "tab\t" + prose(3, 20_000)]
    for limit in (tokens.GENERATION_BYTES, 2000):
        monkeypatch.setattr(tokens, "GENERATION_BYTES", limit)
        encoder = tokens.Encoder(BPE)
        for at in range(0, len(texts), 300):
            for text, data in zip(texts[at : at + 300], encoder.encode(texts[at : at + 300]), strict=True):
                assert np.frombuffer(data, "<u4").tolist() == ids_of_cached(encoder, text)
        assert max(map(len, encoder.kept), default=0) <= tokens.LONGEST_KEPT and encoder.held < limit + (16 << 20)


def test_cuts_equal_the_tokenizers_pattern():
    """Cuts of many texts at once by classes of bytes, also where one text ends in what another would go on with."""
    import re

    from salespect.llm import tokens

    letter, number = tokens._LETTER, tokens._NUMBER
    pattern = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+")
    rng = random.Random(11)
    signs = [*"ab Z9 \n\t\r'''sdmtlvre.,-é½×’…€ ɏ­", "'s", "'re", "'ll", "  ", " '", "12"]
    for size in (3, 8, 40):
        texts = ["".join(rng.choices(signs, k=rng.randint(0, size))) for _ in range(4000)]
        blobs = [t.encode() for t in texts]
        ends = np.cumsum([len(b) for b in blobs])
        data = np.frombuffer(b"".join(blobs), np.uint8)
        first = np.append(0, ends[:-1])
        at = tokens.cuts(data, first[first < len(data)]).tolist()
        found = [data[x:y].tobytes().decode() for x, y in zip(at, [*at[1:], len(data)], strict=True)]
        assert found == [piece for text in texts for piece in pattern.findall(text)]


def test_whole_sequences_need_no_rank_directory():
    matrix, _, _ = wavelet.load_shard(wavelet.dump_shard(np.arange(70_000) % 66_000, [1], [70_000]))
    assert matrix.all().tolist() == [n % 66_000 for n in range(70_000)]
    assert "_before" not in vars(matrix) and matrix.access(65_999) == 65_999 and matrix.rank(3, 70_000) == 2


def test_prefix_entries_leave_a_task_in_small_blocks():
    """What a task holds of prefix entries (33 bytes each, and their sorting) is a quarter of a million, whatever its rows."""
    from types import SimpleNamespace

    import pyarrow as pa

    texts = pa.array([" ".join(f"{n}x{k}" for k in range(2000)) for n in range(1300)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    counts = SimpleNamespace(value=np.ones(1 << jaccard_join.COUNT_BITS, np.uint32))
    rounds = [sum(map(len, b.column(1).to_pylist())) // jaccard_join.ENTRY.itemsize for b in jaccard_join._prefixes([batch], counts, 5, 75, 8)]
    assert max(rounds) < 300_000 and sum(rounds) == 1300 * jaccard_join.prefix_length(1996, 75)


def ids_of_cached(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_of_another_tokenizer_takes_whole_texts():
    from salespect.llm.tokens import Encoder

    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Some  WORDS\tand 12 numbers", "", "<|endoftext|> x", prose(4, 5000)]
    assert [np.frombuffer(d, "<u4").tolist() for d in encoder.encode(texts)] == [ids_of_cached(encoder, t) for t in texts]


def test_quality_votes_do_not_depend_on_length():
    for unit in ("½² Ⅷ word ", "plain words here, and more. ", "x1 22 ³ "):
        short, long = (quality.votes(unit * n) for n in (1900 // len(unit), 2600 // len(unit)))
        assert short[0] == long[0]


def test_quality_shapes_do_not_depend_on_what_is_kept(monkeypatch):
    texts = [prose(n, 300) + " Wort½ ABC-12 " + "x" * 90 + "7" * n for n in range(12)]
    whole = [quality.Shapes().features(t) for t in texts]
    monkeypatch.setattr(quality, "GENERATION", 20)
    shapes = quality.Shapes()
    for text, (cells, shares) in zip(texts, whole, strict=True):
        found = dict(zip(*map(list, shapes.features(text)), strict=True))
        assert found == pytest.approx(dict(zip(cells.tolist(), shares.tolist(), strict=True)))
    assert len(shapes.young) <= 20 and len(shapes.old) <= 20


def test_quality_keeps_rows_whatever_their_ids_and_columns(spark):
    good, bad = ("The river runs to the sea, and people walk along it. " * 3 + prose(1, 0), "@@@@ #### $$$$ %%%% " * 30)
    rows = [(n, good + f"Line {n}.", "a", n) for n in range(40)] + [(50 + n, bad, "a", n) for n in range(10)]
    rows += [(None, good, "b", 1), (1, good, "b", 2), (1, good, "b", 2), (70, None, "b", 3), (71, " ", "b", 4), (72, good * 4000, "b", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string, keep int")
    model = quality.train(frame)
    kept = quality.keep_good(frame, model)
    scored = quality.score_quality(frame, model).collect()
    assert kept.columns == frame.columns and len(scored) == len(rows)
    assert sorted(str(r["doc_id"]) for r in scored if r["keep"]) == sorted(str(r["doc_id"]) for r in kept.collect())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([*map(str, range(40)), "None", "1", "1", "72"])
    assert quality.keep_good(frame.limit(0), quality.train(frame.limit(0))).count() == 0


ARTICLE = "<p>" + "This is the article text, with care. " * 9 + "</p>"
READERS = "".join(f"<div><p>Reader {n} says this is nice, really. I agree with all of it.</p></div>" for n in range(20))


@pytest.mark.parametrize("name", ["comments", "comments-area", "postComments", "cookie-banner", "site-footer", "related_posts", "x ad"])
@pytest.mark.parametrize("page", ["<article>{0}</article>{1}", "<article>{0}{1}</article>", "<div>{0}</div>{1}", "<div class=widget>{0}{1}</div>"])
def test_named_parts_go_however_long_they_are(name, page):
    """Comments of three times the article's length, beside it and in it, and in a part around both."""
    part = f'<div class="{name}">{READERS}</div>'
    assert html_text.main_text(page.format(ARTICLE, part)) == html_text.main_text(ARTICLE) != ""


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "ad-free", "without_comments", "shareholders", "header-adapter"])
def test_names_that_are_no_parts(name):
    assert html_text.main_text(f'<body class="{name}"><div class="{name}">{ARTICLE}</div><p>Outside, too.</p></body>').startswith("This is")


@pytest.mark.parametrize("page", ["<b>x" * 250_000, "<a " * 330_000, "<b>" * 150_000 + "</i>" * 150_000, "<template>" * 90_000 + "</template>", "</script " * 100_000, "<!--" * 250_000, "<p><b>x" * 100_000])
def test_a_page_of_a_megabyte_of_open_tags(page):
    begin = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - begin < 10


def test_pages_equal_a_walk_over_their_tree(spark):
    """Pages written from a tree of blocks, whose article text is known by construction."""
    rng = random.Random(8)
    rows, want = [], {}
    for number in range(60):
        texts, html = [], ["<!doctype html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"]
        html.append("<main><article>")
        for _ in range(rng.randint(1, 8)):
            words = [rng.choice(("river", "stone", "Äpfel", "late", "city")) for _ in range(rng.randint(8, 40))]
            texts.append(" ".join(words) + ", and so on.")
            html.append("<p>" + "  <em>".join(words[:2]) + "</em>\n" + " ".join(words[2:]) + ", and&nbsp;so on.</p>" if len(words) > 2 else f"<p>{texts[-1]}</p>")
            if rng.random() < 0.4:
                html.append(rng.choice(("<script>var a = '<p>no</p>';</script>", "<aside><p>Beside, it.</p></aside>", "<!-- <p>hidden.</p> -->", f'<div class="reader-comments">{READERS}</div>')))
        html.append("</article></main><footer><p>Imprint, contact.</p></footer></body></html>")
        rows.append((number, None, "".join(html), "x"))
        want[number] = "\n\n".join(texts)
    frame = spark.createDataFrame([*rows, rows[0], (None, None, None, None)], "page_id long, url string, html string, text string")
    for r in html_text.extract_text(frame).collect():
        assert r["text"] == want.get(r["page_id"], "") and r["n_chars"] == len(r["text"])
    assert html_text.extract_text(frame.limit(0)).count() == 0


def test_tasks_of_a_worker_share_an_encoder(monkeypatch, tmp_path):
    import pyarrow as pa
    import pyspark

    from salespect.llm import tokens

    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = classmethod(lambda cls: 0)

    class Counted(tokens.Encoder):
        made: list[str] = []

        def __init__(self, path: str, *options) -> None:
            self.made.append(path)
            super().__init__(path, *options)

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    for module in (tokens, wavelet):
        if hasattr(module, "Encoder"):
            monkeypatch.setattr(module, "Encoder", Counted)
    path = tmp_path / "tokenizer.json"
    with open(BPE, "rb") as file:
        said = file.read()
    path.write_bytes(said)

    def ids(*texts):
        rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
        (shard,) = wavelet._shards(iter([rows]), str(path), 2, wavelet.SHARD_TOKENS)
        return wavelet.load_shard(shard.column("data")[0].as_py())[0].all().tolist()

    assert ids("one two", "") == [*ids_of("one two"), 2, 2]
    assert ids("two three") == [*ids_of("two three"), 2] and ids("one two") == [*ids_of("one two"), 2]
    assert Counted.made == [str(path)]
    # Another file below the same name is read anew.
    path.write_bytes(said + b"\n")
    assert ids("one") == [*ids_of("one"), 2] and len(Counted.made) == 2


@pytest.mark.parametrize("top", [1, 2, 1 << 16, (1 << 16) + 1, 1 << 20])
def test_planes_are_stable_partitions(top):
    given = np.random.default_rng(top).integers(0, top, 700).astype(np.uint32)
    matrix, ids = wavelet.WaveletMatrix.build(given), given.tolist()
    for level in range(matrix.bits):
        bits = [n >> (matrix.bits - 1 - level) & 1 for n in ids]
        assert matrix.planes[level].tolist() == bits and matrix.zeros[level] == bits.count(0)
        ids = [n for n, bit in zip(ids, bits, strict=True) if not bit] + [n for n, bit in zip(ids, bits, strict=True) if bit]
    before = matrix.planes.copy()
    assert matrix.all().tolist() == given.tolist() and (matrix.planes == before).all()
