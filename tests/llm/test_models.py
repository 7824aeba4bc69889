"""Toxicity and language: exact parts by brute force, held-out accuracy."""
import itertools

import numpy as np

from paperlane.llm import language, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_marginals_by_enumeration():
    r = np.random.default_rng(1)
    sizes = [1, 4, 3, 1, 5]
    odds = r.normal(size=sum(sizes))
    begins = np.zeros(len(odds), bool)
    begins[np.cumsum([0, *sizes[:-1]])] = True
    follow, start = r.normal(size=(2, 2)), np.array([0.0, 0.7])
    got, pairs = toxicity.marginals(odds, begins, follow, start)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in sizes:
        weights, e = {}, odds[at:at + n]
        for s in itertools.product((0, 1), repeat=n):
            x = start[s[0]] + sum(e[i] for i in range(n) if s[i])
            weights[s] = np.exp(x + sum(follow[s[i], s[i + 1]] for i in range(n - 1)))
        total = sum(weights.values())
        want += [sum(w for s, w in weights.items() if s[i]) / total for i in range(n)]
        for s, w in weights.items():
            for i in range(n - 1):
                want_pairs[s[i], s[i + 1]] += w / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_products_of_long_chains_stay_finite():
    odds = np.full(50_000, -12.0)
    odds[::997] = 25.0
    begins = np.zeros(50_000, bool)
    begins[0] = True
    p, _ = toxicity.marginals(odds, begins, np.array([[2.0, -2], [-2, 2]]), np.zeros(2))
    assert np.isfinite(p).all() and p[997] > 0.99 and p[500] < 0.01


def test_spans_are_code_points():
    from .util import prose

    toxic = [f"{prose(i, 40)} 漢字 awful{c} {prose(i + 100, 40)}" for i, c in enumerate("abcdefghijklmnopqrst" * 2)]
    clean = [prose(i, 80) for i in range(200, 260)]
    model = toxicity.fit(toxic + clean, [1] * len(toxic) + [0] * len(clean))
    text = f"\U0001f600 x awfulc {prose(901, 60)}"
    scores, spans = toxicity.scorer(model)([text, prose(900, 80), ""])
    assert scores[0] >= 0.5 > scores[1] and spans[1] == []
    assert [text[int(a):int(b)] for a, b in (s.split(":") for s in spans[0])] == ["awfulc"]
    assert toxicity.fit(["a b"], [1]) is None and toxicity.fit([], []) is None


def test_held_out_toxicity(spark):
    rows = queries.op1_toxicity(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    held = rows.filter("held_out").join(labels, "doc_id").filter("toxic is not null").collect()
    toxic = [r for r in held if r.toxic]
    assert toxic and sum(r.predicted for r in toxic) >= 0.8 * len(toxic)  # of 45 toxic documents learnt from
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)


def test_held_out_language(spark):
    rows = queries.op2_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = rows.filter("held_out").join(docs, "doc_id").collect()
    assert held and sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)


def slow_phrases(text: bytes, labelled: bytes) -> int:
    """Greedy cross-parsing with substring search."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in labelled:
            j += 1
        n, i = n + 1, max(i + 1, j - 1)
    return n


def test_phrase_counts_by_substring_search():
    r = np.random.default_rng(2)
    samples = {"x": ["".join(r.choice(list("abcde "), 400))], "y": ["".join(r.choice(list("cdefg "), 300))]}
    model = language.build(samples)
    texts = ["".join(r.choice(list("abcdefgq "), n)).strip() for n in (3, 50, 200, 7)]
    own = [language.normal(t) for t in texts]
    got = language.phrase_counts([model["symbol"][x] for x in own], model)
    for k, lang in enumerate(model["langs"]):
        labelled = language.normal(samples[lang][0]).tobytes()
        for j, x in enumerate(own):
            assert got[k, j] == slow_phrases(x.tobytes(), labelled)


def test_toxic_spans_are_places_of_the_text(spark):
    """Letters that become two in lower case shift nothing."""
    from paperlane.llm import toxicity

    model = toxicity.fit(["awful vile stuff here", "vile awful words", "so awful and vile", "an awful vile day", "calm nice day", "nice words here"] * 3,
                         [1, 1, 1, 1, 0, 0] * 3)
    text = "İstanbul İzmir awful end"
    for i, (a, b) in enumerate(toxicity.places_of(text)):
        assert text[a:b].lower() == toxicity.words_of(text)[i]
    assert toxicity.places_of(text)[2] == (15, 20) and text[15:20] == "awful"
    _, spans = toxicity.scorer(model)([text])
    assert all(text[int(x.split(":")[0]):int(x.split(":")[1])].split()[0] in ("İstanbul", "İzmir", "awful", "end") for x in spans[0])


def test_toxicity_learns_from_bounded_bytes(spark, monkeypatch):
    from paperlane.llm import toxicity

    from .util import docs

    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.append((sorted(map(len, texts)), sorted(labels))))
    rows = [(i, "x" * n) for i, n in enumerate((10, 5000, 30, 40, 50))]
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    toxicity.learn(docs(spark, rows), labels, most_bytes=60)
    assert seen == [([10, 30, 40], [0, 1, 1])] or seen == [([10, 30, 50], [0, 1, 1])]
