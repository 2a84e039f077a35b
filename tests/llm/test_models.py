"""The trained operators against plain arithmetic."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from geotracks.llm import language, toxicity


def plain_pooled(model, words):
    """Each filter's largest value over a text, by loops; three zero words end the text."""
    vectors = [model.table[list(rows)].sum(axis=0) for rows in words] + [np.zeros(toxicity.SIZE)] * 3
    out = []
    for k, w in zip(toxicity.WIDTHS, model.filters):
        for f in range(toxicity.FILTERS):
            # no window starts behind the text's padding
            values = [sum(float(vectors[t + i] @ w[i][:, f]) for i in range(k) if t + i < len(vectors)) for t in range(len(vectors))]
            out.append(max(values))
    return np.maximum(np.array(out) + model.bias, 0)


def test_filters_and_pooling_equal_loops():
    draw = np.random.default_rng(2)
    model = toxicity.Model(
        draw.normal(size=(toxicity.PAD + 1, toxicity.SIZE)).astype(np.float32),
        [draw.normal(size=(k, toxicity.SIZE, toxicity.FILTERS)).astype(np.float32) for k in toxicity.WIDTHS],
        draw.normal(size=toxicity.FILTERS * 3).astype(np.float32), draw.normal(size=toxicity.FILTERS * 3 + 1), 0.5,
    )
    model.table[toxicity.PAD] = 0
    texts = ["one", "", "two words", "a text of some more words than that", "x " * 40, None]
    rows, first = toxicity.features(pa.array(texts))
    pooled = model.pooled(rows, first)
    scores = model.score(pa.array(texts))
    for i, (a, b) in enumerate(zip(first, first[1:])):
        want = plain_pooled(model, rows[a:b])
        assert np.allclose(pooled[i], want, atol=1e-4)
        assert abs(scores[i] - 1 / (1 + math.exp(-float(want @ model.out[:-1] + model.out[-1])))) < 1e-4


def test_training_lowers_the_loss():
    """The gradient steps do what they are for: more epochs, a lower loss; and each language gets the best threshold."""
    draw = random.Random(4)
    texts = [" ".join(draw.choices(["calm", "kind", "plain", "vile"] if i % 3 == 0 else ["calm", "kind", "plain"], k=9)) for i in range(300)]
    labels = np.array([float("vile" in t) for t in texts])
    rows, first = toxicity.features(pa.array(texts))
    sets = [rows[a:b] for a, b in zip(first, first[1:])]

    def loss(model):
        p = np.clip(model.score(pa.array(texts)), 1e-6, 1 - 1e-6)
        return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())

    losses = [loss(toxicity.train(sets, labels, epochs=n)) for n in (1, 4, 12)]
    assert losses[0] > losses[1] > losses[2]
    model = toxicity.train(sets, labels, epochs=8)
    lang = np.array(["en", "de", None, "de"] * 75, object)
    toxicity._calibrate(model, sets, labels.astype(int), lang, {0: int((labels == 0).sum()), 1: int((labels == 1).sum())})
    scores = model.score(pa.array(texts))
    for name in ("en", "de"):
        of = lang == name
        f1 = lambda t: toxicity._f1(scores[of] >= t, labels[of])
        assert f1(model.thresholds[name]) >= max(f1(t) for t in np.arange(0.1, 0.91, 0.05)) - 1e-9


def softmax(values):
    top = max(values)
    parts = [math.exp(v - top) for v in values]
    return [p / sum(parts) for p in parts]


def expected_posteriors(rows, model):
    """The posterior of each (text, declared, host) by loops over rows and dictionaries."""
    languages, profiles, limits = model
    k = len(languages) + 1
    lls, ns = [], []
    for text, _, _ in rows:
        buckets, _ = language.trigrams(pa.array([text], pa.string()))
        n = len(buckets)
        ll = [sum(p[b] for b in buckets) / max(n, 1) * min(n, language.WEIGHT) for p in profiles]
        lls.append([*ll, limits[int(np.argmax(ll))] * min(n, language.WEIGHT)])
        ns.append(n)
    soft = [softmax(ll) for ll in lls]

    def sums(key):
        out = defaultdict(lambda: [0.0] * k)
        for row, p, n in zip(rows, soft, ns):
            if n:
                out[key(row)] = [a + b for a, b in zip(out[key(row)], p)]
        return out

    tail = lambda host, parts: None if host is None else ".".join(host.split(".")[-parts:])
    by_host, everything = sums(lambda r: r[2]), sums(lambda r: 0)[0]
    by_domain, by_suffix = sums(lambda r: (tail(r[2], 1), tail(r[2], 2))), sums(lambda r: tail(r[2], 1))
    said = sums(lambda r: r[1])
    said.pop(None, None)
    base = [(c + 1) / (sum(everything) + k) for c in everything]
    smooth = lambda counts, above: [(c + language.SMOOTH * p) / (sum(counts) + language.SMOOTH) for c, p in zip(counts, above)]
    out = []
    for (text, declared, host), ll, n in zip(rows, lls, ns):
        total = list(ll)
        if declared in said:
            totals = [sum(c[i] for c in said.values()) for i in range(k)]
            total = [t + math.log((c + 1) / (s + len(said))) for t, c, s in zip(total, said[declared], totals)]
        if host in by_host:
            prior = smooth(by_host[host], smooth(by_domain[tail(host, 1), tail(host, 2)], smooth(by_suffix[tail(host, 1)], base)))
            total = [t + math.log(p) for t, p in zip(total, prior)]
        post = softmax(total)
        best = max(post[:-1])
        found = [*languages, None][int(np.argmax(post))] if n and best >= 0.5 else None
        out.append((found, best))
    return out


def test_posteriors_equal_plain_arithmetic(spark):
    draw = random.Random(7)
    stock = {"en": "the cat and dog were in this house with them".split(), "de": "der Hund und die Katze sind nicht mehr auf dem Dach".split(), "fr": "le chat est sur la table avec une pomme rouge".split()}
    labelled = [(i, " ".join(draw.choices(stock[lang], k=12)), lang) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    model = language.fit(spark.createDataFrame(labelled, "doc_id long, text string, lang string"))
    hosts = ["a.example.de", "b.example.de", "example.de", "site.co.uk", "localhost", None]
    rows = []
    for i in range(60):
        lang = draw.choice(list(stock))
        text = draw.choice([" ".join(draw.choices(stock[lang], k=draw.randrange(1, 9))), "", None, "zq xq qzx vvk", "12 34"]) if i % 4 == 0 else " ".join(draw.choices(stock[lang], k=3))
        rows.append((text, draw.choice([lang, "en", "xx", None]), draw.choice(hosts)))
    rows.append(("der Hund und die Katze " * 5000, "de", "a.example.de"))  # a very long text
    rows += [rows[5]] * 3
    table = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "id int, text string, declared string, host string, language string")
    got = {r.id: (r._language, r._probability) for r in language.identify(table, model, "text", "declared", "host").collect()}
    for i, (found, best) in enumerate(expected_posteriors(rows, model)):
        assert got[i][0] == found and abs(got[i][1] - best) < 1e-9
