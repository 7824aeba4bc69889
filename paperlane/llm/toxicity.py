"""Toxicity by a linear-chain conditional random field.

Tokens have two states, harmless and toxic. A token's features (the word, its
first 3 to 6 and last 3 letters) are weighted into the log-odds of the toxic
state; four more weights say how states follow each other. Labels come by
document, so tokens are labelled first: in a toxic document those whose word
or beginning of a word stands in many places of toxic documents and hardly any
of others are toxic, all others are not. Forward-backward marginals of every token of a
whole text aggregate to the document's score (a logistic function of the
largest marginal's log-odds and of the expected number of toxic tokens); runs
of tokens with a marginal of at least one half are the offending offsets.

Learning: the model is fitted by the driver on at most :data:`SAMPLE` labelled
documents and :data:`SAMPLE_BYTES` bytes of each class (those with the smallest
hash of their id), with their whole texts. Scoring: no shuffle; a task works on runs of about two million
characters, and its chains of tokens by block-wise products of 2 x 2 matrices.
The model that is sent is bounded by the sample.

Defined cases: a null text is empty; a text without words scores the model's
lowest value; labels without a document, null labels and null ids are ignored
in learning; of repeated labels of an id any positive one counts; without
documents of both classes nothing is learnt and every score is 0; an empty
table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_texts

SAMPLE = 600
#: Bytes of texts of each class that are learned from; a document that does not
#: fit any more is passed over.
SAMPLE_BYTES = 8_000_000
#: Weights smaller than this are left out of the model that is sent.
LEAST_WEIGHT = 0.02
#: A feature marks tokens if it stands in at least MARK_LEAST toxic documents
#: and different surroundings (the words before and after) of them, where
#: chance would have put it into MARK_PLACES of the others, and its share of
#: the toxic ones is MARK_RATIO times that of the others. Copies of a document
#: are the same surroundings.
MARK_LEAST, MARK_PLACES, MARK_RATIO = 3, 15, 20
EPOCHS = 25


def words_of(text: str) -> list[str]:
    """The words of a text, each in lower case."""
    import re

    low = text.lower()
    if len(low) == len(text):
        return re.findall(r"\w+", low)
    return [w.lower() for w in re.findall(r"\w+", text)]  # a letter becomes two: the words are those of the text


def places_of(text: str) -> list[tuple[int, int]]:
    """Where the :func:`words_of` a text stand in it."""
    import re

    low = text.lower()
    return [m.span() for m in re.finditer(r"\w+", low if len(low) == len(text) else text)]


def features(word: str) -> list[str]:
    return [word, *(f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) >= n), f"{word[-3:]}$"]


def _products(m):
    """Row vectors v with v[t] = v[t-1] M[t] up to a factor, for matrices
    ``m`` of shape (n, 2, 2), by blocks: products within each of about sqrt(n)
    blocks side by side, then the blocks one after the other."""
    import numpy as np

    n = len(m)
    size = max(1, int(np.sqrt(n)))
    blocks = -(-n // size)
    pad = np.broadcast_to(np.eye(2), (blocks * size - n, 2, 2))
    m = np.concatenate([m, pad]).reshape(blocks, size, 2, 2)
    within = np.empty_like(m)
    p = np.broadcast_to(np.eye(2), (blocks, 2, 2))
    for j in range(size):
        x = m[:, j]
        p = p[:, :, :1] * x[:, None, 0, :] + p[:, :, 1:] * x[:, None, 1, :]
        p = p / p.sum(axis=(1, 2))[:, None, None]
        within[:, j] = p
    carry = np.empty((blocks, 2))
    v = np.array([0.5, 0.5])
    for k in range(blocks):
        carry[k] = v
        v = v @ within[k, -1]
        v = v / v.sum()
    out = (carry[:, None, :, None] * within).sum(axis=2).reshape(-1, 2)[:n]
    return out / out.sum(axis=1, keepdims=True)


def marginals(odds, begins, follow, start):
    """P(toxic) for each token and P(states of t-1, t) summed over the tokens
    that have a predecessor. ``odds``: log-odds of the tokens of all chains,
    one after the other; ``begins``: marks of first tokens; ``follow`` (2 x 2)
    and ``start`` (2): log weights."""
    import numpy as np

    e = np.stack([np.ones(len(odds)), np.exp(np.clip(odds, -30, 30))], axis=1)
    step, first = np.exp(follow), np.exp(start)
    m = np.where(begins[:, None, None], first[None, None, :], step[None]) * e[:, None, :]
    alpha = _products(m)
    # beta[t] = M[t+1] beta[t+1]: the same products from the right, transposed
    back = np.concatenate([m[1:], np.ones((1, 2, 2))])[::-1].transpose(0, 2, 1)
    beta = _products(back)[::-1]
    both = alpha * beta
    p = both[:, 1] / both.sum(axis=1)
    inner = ~begins
    inner[0] = False
    t = np.flatnonzero(inner)
    pair = alpha[t - 1][:, :, None] * m[t] * beta[t][:, None, :]
    pair = pair / pair.sum(axis=(1, 2))[:, None, None]
    return p, pair.sum(axis=0)


def _mark_tokens(texts: list[list[str]], labels: list[int]) -> set[str]:
    """Words that are toxic tokens where the document is toxic."""
    from collections import Counter

    places: tuple[set, set] = (set(), set())
    holders = (Counter(), Counter())
    for words, y in zip(texts, labels, strict=True):
        places[y].update(zip(["", *words], words, [*words[1:], ""], strict=False))
        holders[y].update({f for w in set(words) for f in features(w)[:-1]})
    found = []
    for y in (0, 1):
        by_word, by_feature = Counter(w for _, w, _ in places[y]), Counter()
        for w, n in by_word.items():
            for f in features(w)[:-1]:
                by_feature[f] += n
        found.append(by_feature)
    even, share = len(places[1]) / max(1, len(places[0])), labels.count(1) / max(1, labels.count(0))
    strong = {f for f, n in found[1].items()
              if n >= max(MARK_LEAST, MARK_PLACES * even, MARK_RATIO * even * found[0][f])
              and holders[1][f] >= max(MARK_LEAST, MARK_PLACES * share)}
    return {w for words, y in zip(texts, labels, strict=True) if y for w in set(words)
            if any(f in strong for f in features(w)[:-1])}


def document_signals(p, begins):
    """Per chain: log-odds of the largest marginal and log of one more than
    the expected number of toxic tokens (marginals under a fifth are noise)."""
    import numpy as np

    starts = np.flatnonzero(begins)
    most = np.clip(np.maximum.reduceat(p, starts), 1e-6, 1 - 1e-6)
    total = np.add.reduceat(np.where(p > 0.2, p, 0), starts)
    return np.stack([np.log(most / (1 - most)) / 5, np.log1p(total), np.ones(len(starts))], axis=1)


def without_copies(lists: list[list[str]], labels: list[int]) -> list[tuple[list[str], int]]:
    """The texts, as words, that share under half of their smallest 5-word
    shingle hashes with earlier ones: one document copied many times is no
    evidence for each of its words."""
    from zlib import crc32

    seen, out = set(), []
    for words, y in zip(lists, labels, strict=True):
        least = sorted({crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))})[:16]
        if words and 2 * sum((y, h) in seen for h in least) < len(least):
            out.append((words, y))
        seen.update((y, h) for h in least)
    return out


def fit(texts: list[str], labels: list[int]) -> dict | None:
    """The model of labelled texts; None unless both classes have words."""
    import numpy as np

    single = without_copies(list(map(words_of, texts)), labels)
    lists, labels = [w for w, _ in single], [y for _, y in single]
    if not {0, 1} <= set(labels):
        return None
    toxic = _mark_tokens(lists, labels)
    vocabulary = {w: i for i, w in enumerate(sorted({w for words in lists for w in words}))}
    ids = np.array([vocabulary[w] for words in lists for w in words])
    begins = np.zeros(len(ids), bool)
    begins[np.cumsum([0, *map(len, lists)])[:-1]] = True
    y = np.array([label and w in toxic for words, label in zip(lists, labels, strict=True) for w in words], float)
    places: dict[str, int] = {}
    table = [[places.setdefault(f, len(places)) for f in features(w)] for w in vocabulary]
    owner = np.repeat(np.arange(len(table)), [len(x) for x in table])
    flat = np.array([s for x in table for s in x])

    # counts that the model's expectations are to meet
    inner = np.flatnonzero(~begins)
    seen_pairs = np.bincount(2 * y[inner - 1].astype(int) + y[inner].astype(int), minlength=4).reshape(2, 2)
    weights, squares = np.zeros(len(places)), np.full(len(places), 1e-8)
    follow, start = np.zeros((2, 2)), np.zeros(2)
    f_squares, s_square, b_square = np.full((2, 2), 1e-8), 1e-8, 1e-8
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))  # a word never seen is as rarely toxic as any
    for _ in range(EPOCHS):
        odds = np.bincount(owner, weights[flat], len(table)) + bias
        p, pairs = marginals(odds[ids], begins, follow, start)
        gap = np.bincount(ids, y - p, len(table))
        g = np.bincount(flat, gap[owner], len(places)) - 0.05 * weights
        squares += g * g
        weights += 1.0 * g / np.sqrt(squares)
        b = float((y - p).sum())
        b_square += b * b
        bias += 0.1 * b / b_square ** 0.5
        g = seen_pairs - pairs - 0.05 * follow
        f_squares += g * g
        follow += 0.3 * g / np.sqrt(f_squares)
        s = float((y - p)[begins].sum()) - 0.05 * start[1]
        s_square += s * s
        start[1] += 0.3 * s / s_square ** 0.5
    odds = np.bincount(owner, weights[flat], len(table)) + bias
    x = document_signals(marginals(odds[ids], begins, follow, start)[0], begins)
    final, target = np.zeros(3), np.array(labels, float)
    for _ in range(60):  # logistic regression, Newton steps with a ridge; no signal may count against toxicity
        q = 1 / (1 + np.exp(-np.clip(x @ final, -30, 30)))
        grad = x.T @ (target - q) - 0.1 * final
        hess = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(3)
        free = [k for k in range(3) if k == 2 or final[k] > 0 or grad[k] > 0]
        step = np.linalg.solve(hess[np.ix_(free, free)], grad[free])
        final[free] += step / max(1.0, float(np.abs(step).max()))
        final[:2] = np.maximum(final[:2], 0)
    kept = {f: float(weights[i]) for f, i in places.items() if abs(weights[i]) >= LEAST_WEIGHT}
    return {"weights": kept, "bias": bias, "follow": follow, "start": start, "final": final}


def scorer(model: dict | None):
    """A function from a list of texts to (scores, spans of each text as
    ``start:end`` in code points)."""
    import numpy as np

    known: dict[str, float] = {}

    def score(texts: list[str]):
        if model is None:
            return [0.0] * len(texts), [[] for _ in texts]
        lists = [words_of(t) for t in texts]
        if len(known) > 300_000:
            known.clear()
        weights = model["weights"]
        for w in {w for words in lists for w in words}.difference(known):
            known[w] = sum(weights.get(f, 0.0) for f in features(w)) + model["bias"]
        sizes = np.array([len(w) for w in lists])
        none = float(1 / (1 + np.exp(-np.clip(model["final"] @ [np.log(1e-6) / 5, 0, 1], -30, 30))))
        scores, spans = [none] * len(texts), [[] for _ in texts]
        full = np.flatnonzero(sizes)
        if not len(full):
            return scores, spans
        odds = np.fromiter((known[w] for words in lists for w in words), float, int(sizes.sum()))
        ends = np.cumsum(sizes[full])
        begins = np.zeros(len(odds), bool)
        begins[np.concatenate([[0], ends[:-1]])] = True
        p, _ = marginals(odds, begins, model["follow"], model["start"])
        made = 1 / (1 + np.exp(-np.clip(document_signals(p, begins) @ model["final"], -30, 30)))
        toxic = p >= 0.5
        any_toxic = np.logical_or.reduceat(toxic, np.flatnonzero(begins))
        for k, i in enumerate(full.tolist()):
            scores[i] = float(made[k])
            if any_toxic[k]:
                at = places_of(texts[i])
                marks = toxic[ends[k] - sizes[i]:ends[k]]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], marks, [0]])))
                spans[i] = [f"{at[a][0]}:{at[b - 1][1]}" for a, b in edges.reshape(-1, 2).tolist()]
        return scores, spans

    return score


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> dict | None:
    """The model of at most ``sample`` labelled documents of each class, of at
    most ``most_bytes`` together. Rows
    that may not be learnt from are to be left out of ``labels``."""
    marked = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
              .join(docs.select(F.col(id_col).alias("doc_id")).distinct(), "doc_id", "left_semi"))
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    picked = marked.filter("y > 0").orderBy(rank, "doc_id").limit(sample).union(
        marked.filter("y <= 0").orderBy(rank, "doc_id").limit(sample))
    rows = [(r["doc_id"], int(r["y"] > 0)) for r in picked.collect()]  # 2 * sample rows at most, in order of their class' hashes
    if not rows:
        return None
    texts = (id_and_text(docs, id_col, text_col, binary=False).filter(F.col("doc_id").isin([i for i, _ in rows]))
             .groupBy("doc_id").agg(F.min("text").alias("text")))
    sizes = {r["doc_id"]: r["n"] for r in texts.select("doc_id", F.octet_length("text").alias("n")).collect()}
    chosen, room = {}, {0: most_bytes, 1: most_bytes}
    for i, y in rows:
        if sizes[i] <= room[y]:
            room[y] -= sizes[i]
            chosen[i] = y
    pairs = sorted((r["doc_id"], r["text"]) for r in texts.filter(F.col("doc_id").isin(list(chosen))).collect())
    return fit([t for _, t in pairs], [chosen[i] for i, _ in pairs])


def score_documents(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, score`` (0 to 1) and ``spans``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    fields = [("doc_id", id_type(docs, id_col)), ("score", "double"), ("spans", "array<string>")]
    return map_texts(id_and_text(docs, id_col, text_col, binary=False), lambda: scorer(shared.value), fields)
