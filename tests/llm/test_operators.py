"""The operators against brute force on small tables with nulls, ties, repeats and odd columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from geotracks.llm import ann, bpe, embeddings, language, licenses, minhash, mixing, sharding, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, part int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
TEXTS = [
    None, "", "   \n", "word", "Word", "MIT License. mit-license; the MIT  license", LONG, LONG + " end", BASE, BASE, BASE + " more",
    "under the GNU General Public License, or CC BY 4.0 <|endoftext|> and\n\n  it's 42 été x", "apache software license", BASE.upper(),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["b", "a", None, "c"][i % 4], None, "h", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[8], (None, BASE, None, None, 1, "h", 1)], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_urls(spark):
    rows = [
        (1, "http://a.ORG/x"), (2, "https://x.example.org/es/1?q"), (3, "http://example.org/en/12#a"), (4, "http://notexample.org/es/"),
        (5, "http://a.com/de/1"), (6, "http://com/fr/"), (7, "http://a.com/en"), (8, None), (9, "no scheme"), (10, "http://org"), (1, "http://a.ORG/x"),
        (11, "http://a.org/" + "x" * 100_000), (12, "http://" + "a." * 300 + "com/de/x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as key", "'x' as rule", "2 as uid")
    rules = spark.createDataFrame(urls.RULES, "verdict string, host string, path string")
    got = sorted(map(tuple, urls.judge(pages, rules).collect()))
    want = []
    for page, url in rows:
        host, path = "", ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = lower(host)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        want.append((page, host, path, best[1], best[2]))
    assert got == sorted(want)
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(TEXTS) + 2
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(words(r.text))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        level = (total - sum(3 * size[s] for s in capped)) / max(1, sum(weight[s] for s in order if s not in capped))
        over = {s for s in order if s not in capped and level * weight[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    want = sorted(3.0 * size[s] if s in capped else level * weight[s] for s in order)
    assert np.allclose(sorted({round(r.target, 6) for r in got}), sorted(set(np.round(want, 6))))
    assert all(r.taken <= 3 * r.size for r in got)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_bpe(docs, spark):
    from tokenizers import Tokenizer

    path = bpe.default_tokenizer()
    library = Tokenizer.from_file(path)
    encoded = bpe.encode(docs, path)
    got = {r.doc_id: (r.ids, r.decoded) for r in encoded.collect()}
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False))
    back = {r.doc_id: r.decoded for r in bpe.decode(encoded.where("doc_id is not null").dropDuplicates(["doc_id"]), path).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    row = bpe.digests(encoded).where("doc_id = 3").first()
    assert row.decoded_sha256 == hashlib.sha256(b"word").hexdigest()
    assert bpe.encode(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("rows", [1, 3, 100])
def test_bpe_blocks_hold_no_texts(monkeypatch, rows):
    import pyarrow as pa

    draw = np.random.default_rng(5)
    texts = [[f"w{i}" for i in draw.integers(0, 30, n)] for n in [0, 4, 9, 1, 0, 7, 40, 2, 2, 11]]
    names = ["_id", "chars", "words", "part"]
    table = pa.table([range(10), [2 * len(t) for t in texts], pa.array(texts, pa.list_(pa.string())), [3] * 10], names)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 30)
    seen = []
    for number, ids, words, counts, places in bpe._cut(iter(table.to_batches(max_chunksize=rows))):
        assert number == (3 << 24) + len(seen) and len(set(words.to_pylist())) == len(words)
        assert list(np.bincount(places, minlength=len(words))) == sorted(np.bincount(places, minlength=len(words)))[::-1]
        flat = words.take(pa.array(places)).to_pylist()
        cuts = np.concatenate(([0], np.cumsum(counts)))
        seen.append([(i, flat[a:b]) for i, a, b in zip(ids, cuts, cuts[1:])])
    assert [x for block in seen for x in block] == list(enumerate(texts))
    assert len(seen) == 3

    # what a block keeps of a batch in Arrow's memory is not the batch
    def large():
        begin = pa.total_allocated_bytes()
        for part in range(20):
            flat = pa.array([f"word {i % 50}" for i in range(100_000)])
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([1]), pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), pa.array([3])], names)
            held = pa.total_allocated_bytes() - begin
            assert held < 4 * flat.nbytes

    (block,) = bpe._cut(large())
    assert len(block[2]) == 50 and len(block[4]) == 2_000_000


def test_ann(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [None] * 8), (404, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as part", "2 as size")
    got = ann.search(table, lambda c: c % 20 == 0, 20).collect()
    d = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(d, -np.inf)
    hits = sum(r.vec_id in np.argsort(-d[r.query_id], kind="stable")[:20] for r in got)
    assert {r.query_id for r in got} == set(range(0, 400, 20)) and hits / len(got) >= 0.9
    assert all(abs(r.score - d[r.query_id, r.vec_id]) < 1e-9 for r in got)
    assert ann.search(table.limit(0), lambda c: c % 20 == 0).count() == 0


def test_ann_takes_rows_that_share_an_id_apart(spark):
    """Ties go to smaller ids, equal rows find one another, and each row of an id is asked."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [1.0, 0.0]), (7, [0.0, 2.0]), (3, [1.0, 0.0]), (None, [9.0, 9.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(table, lambda c: c % 20 == 0, 2).collect())
    # the first row of id 0 meets 3 and 7 at 1.0, the second one meets 7 at 2.0, then 0, 3 and 7 at 0.0
    assert got == [(0, 1, 3, 1.0), (0, 1, 7, 2.0), (0, 2, 0, 0.0), (0, 2, 7, 1.0)]


def test_ann_routes_to_a_few_parts(spark, monkeypatch):
    """On clustered vectors most parts are left out, and nine neighbours of ten are found."""
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(60, 12)) * 3
    x = np.concatenate([c + draw.normal(size=(50, 12)) for c in centres])
    monkeypatch.setattr(ann, "PART_ROWS", 100)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    routers = []
    fit = ann.fit
    monkeypatch.setattr(ann, "fit", lambda *a: routers.append(fit(*a)) or routers[-1])
    got = ann.search(table, lambda c: c % 20 == 0, 20).collect()
    d = x @ x.T
    np.fill_diagonal(d, -np.inf)
    hits = sum(r.vec_id in np.argsort(-d[r.query_id], kind="stable")[:20] for r in got)
    assert len(got) == 20 * 150 and hits / len(got) >= 0.9
    parts = routers[0].second.shape[1]
    assert parts >= 16 and routers[0].probes < parts / 2


@pytest.mark.parametrize("common", [0.0, 0.8, 0.9])
def test_embeddings_with_a_common_direction(spark, common):
    """Pairs just above the threshold are found however much all vectors of a label agree."""
    draw = np.random.default_rng(6)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    axis = unit(draw.normal(size=48))
    around = draw.normal(size=(1400, 48))
    around = unit(around - (around @ axis)[:, None] * axis)
    x = common**0.5 * axis + (1 - common) ** 0.5 * around
    noise = draw.normal(size=(100, 48))
    noise = unit(noise - (noise * x[:100]).sum(axis=1, keepdims=True) * x[:100])
    x = np.concatenate([x, 0.935 * x[:100] + (1 - 0.935**2) ** 0.5 * noise])
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embeddings.link(table).collect()}
    linked = unit(x) @ unit(x).T >= 0.93
    want = linked.sum(axis=1) - 1
    assert want[:100].min() >= 1
    assert sum(min(got[i], n) for i, n in enumerate(want)) >= 0.99 * want.sum() and all(got[i] <= n for i, n in enumerate(want))


def test_embeddings(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(6, 16))
    x = [base[i % 6] + draw.normal(size=16) * (0.02 + 0.4 * (i % 5 == 0)) for i in range(240)]
    x += [x[0], x[0]]
    rows = [(i, [float(c) for c in v], [1, 2, None][i % 3 if i % 40 == 2 else i % 2]) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("inf")] * 16, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as pass", "2 as size")
    got = {r.vec_id: r for r in embeddings.link(table).collect()}
    ok = {i for i, v, label in rows if v and label is not None and np.isfinite(v).all() and np.any(v)}
    parent = {i: i for i, _, _ in rows}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    n = dict.fromkeys(parent, 0)
    for i, v, label in rows:
        for j, w, other in rows:
            if i < j and i in ok and j in ok and label == other and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                n[i] += 1
                n[j] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: r.n_links for i, r in got.items()} == n
    assert {i: r.component_id for i, r in got.items()} == {i: find(i) for i in parent}
    assert embeddings.link(table.limit(0)).count() == 0


def test_minhash(docs):
    def shingles(text):
        w = words(lower(text))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for t in TEXTS]
    parent = list(range(len(sets)))
    for j in range(len(sets)):
        for i in range(j):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 75 * len(sets[i] | sets[j]) and sets[j]:
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    got = minhash.group(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        i = 8 if r.doc_id is None else r.doc_id
        assert (r.n_shingles, r.component_id) == (len(sets[i]), parent[i])
    assert minhash.group(docs.limit(0)).count() == 0


def test_toxicity(spark, docs):
    rows = [(i, f"some plain words {i} {'vile' if i % 4 == 0 else 'kind'}{i % 3} and more", "en", int(i % 4 == 0)) for i in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit(table.drop("toxic"), table.select("doc_id", "toxic"))
    got = toxicity.score(table.withColumn("held", toxicity.held_out(table.doc_id)), model).collect()
    assert all((r._score >= 0.3) == (r.toxic == 1) for r in got if r.held)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    scores = [r._score for r in toxicity.score(docs, model).collect()]
    assert len(scores) == len(TEXTS) + 2 and all(0 <= s <= 1 for s in scores)
    # ids that many rows have, and a sample cut by its bytes
    hot = table.unionByName(table.where("doc_id < 3").crossJoin(spark.range(300)).drop("id"))
    assert np.array_equal(toxicity.fit(hot.drop("toxic"), table.select("doc_id", "toxic")).table, model.table)
    cut = toxicity.fit(table.drop("toxic"), table.select("doc_id", "toxic"), max_bytes=2000)
    assert not np.array_equal(cut.table, model.table)
    bare = toxicity.fit(docs, table.select("doc_id", "toxic").limit(0))
    assert {r._score for r in toxicity.score(docs, bare).collect()} == {0.0}


def test_language(spark, docs):
    said = {"en": "the cat and the dog were in the house with them", "de": "der Hund und die Katze sind nicht mehr auf dem Dach"}
    rows = [(i, said[lang], lang) for i, lang in enumerate(["en", "de"] * 40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(table)
    found = language.identify(table.withColumn("host", table.lang), model, "text", None, "host").collect()
    assert all(r._language == r.lang for r in found)
    got = language.identify(docs, model, "text", "lang", "source").collect()
    assert len(got) == len(TEXTS) + 2 and all(r._language is None for r in got if not words(r.text))
    assert language.identify(docs.limit(0), model, "text", "lang", "source").count() == 0


def test_language_rejects_what_no_profile_fits(spark):
    draw = np.random.default_rng(5)
    words_of = {"en": "the cat and dog were in house with them this that which would other from".split(), "de": "der hund und die katze sind nicht mehr auf dem dach eine schule zwischen".split()}
    # one language is rare and comes after the other
    langs = ["en"] * 400 + ["de"] * 30
    rows = [(i, " ".join(draw.choice(words_of[lang], 40)), lang, "h") for i, lang in enumerate(langs)]
    strange = [
        "sdkfj wqpoeiru zxcmnv lkjh qwpoe fjdkls zmxncb vbqwe rtuip", "Все счастливые семьи похожи друг на друга",
        "吾輩は猫である。名前はまだ無い。どこで生れたか", "Wszystkie szczęśliwe rodziny są do siebie podobne",
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.fit(table, max_rows=100)
    odd = spark.createDataFrame([(1000 + i, t, "en", "h") for i, t in enumerate(strange)], table.schema)
    got = {r.doc_id: r for r in language.identify(table.unionByName(odd), model, "text", "lang", "source").collect()}
    assert all(got[i]._language == lang for i, lang in enumerate(langs))
    assert all(got[1000 + i]._language is None and got[1000 + i]._text_language is None for i in range(len(strange)))


def test_sharding(docs, spark):
    got = sharding.shard_rows(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = (TEXTS[8 if r.doc_id is None else r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        assert r.grown_shard in (r.shard, 16)
    many = sharding.shard_rows(spark.range(5000).selectExpr("id as doc_id", "'x' as text")).collect()
    for shard in range(16):
        slots = sorted(r.slot for r in many if r.shard == shard)
        assert slots == list(range(len(slots))) and 200 < len(slots) < 430
    assert 0.03 < sum(r.grown_shard == 16 for r in many) / 5000 < 0.09
    assert sharding.shard_rows(docs.limit(0)).count() == 0


def test_licenses(docs):
    got = licenses.scan(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(TEXTS[8 if r.doc_id is None else r.doc_id]))
        places = [(i, label) for phrase, label in licenses.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licenses_with_words_put_in_and_left_out(spark):
    texts = [
        ("redistribution and use in source binary forms", "bsd", 5 / 7), ("permission is hereby granted of charge", "mit", 4 / 6),
        ("redistribution and use in any source and binary forms", "bsd", 6 / 7), ("permission is hereby now granted free of charge", "mit", 5 / 6),
        # one word put in and one left out after it; a stray pair in front of the last part
        ("redistribution and also use in source and forms", "bsd", 4 / 7), ("redistribution and use in and use source binary forms", "bsd", 4 / 7),
        ("x permission is hereby granted is hereby of charge", "mit", 4 / 6),
    ]
    table = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(table).collect()}
    for i, (_, label, score) in enumerate(texts):
        assert got[i][0] == (label if score >= licenses.SHARE else "") and abs(got[i][1] - score) < 1e-9
