"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is
parsed greedily against each: from where the last phrase ended, the longest
match in that language's text is the next phrase. The number of phrases,
weighted by what a pointer into the labelled text costs and divided by the
text's length, is the cross-parsing entropy; the language with the least wins
(of equals the first by name).

Texts are lower-cased UTF-8 bytes; runs of ASCII other than letters are one
space. Parsing runs in numpy over many texts and all languages at once: a long
text is parsed in stretches of :data:`STRETCH` bytes, all of them, which adds
one phrase a stretch for every language alike.

Learning: the labelled text of a language is at most :data:`SAMPLE_BYTES`
bytes of the whole documents, in order of their ids' hash, among its first
:data:`SAMPLE_DOCS`. The driver builds the automata (their size is fixed by
that bound and the number of languages) and sends them to the tasks. Scoring
has no shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0;
documents without a language or id are not learnt from; without any labelled
text every text is ``und``; repeated rows give repeated results; an empty
table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, map_texts

SAMPLE_DOCS = 60
SAMPLE_BYTES = 40_000
STRETCH = 2048
#: How steeply the score falls with another language's share of more phrases.
STEEP = 20.0


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``data``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return moves


def normal(text: str):
    """Lower-cased bytes with one space for each run of ASCII non-letters."""
    import numpy as np

    raw = np.frombuffer(text.lower().encode(), np.uint8)
    letter = (raw >= 97) & (raw <= 122) | (raw >= 128)
    raw = np.where(letter, raw, 32)
    keep = np.ones(len(raw), bool)
    keep[1:] = letter[1:] | letter[:-1]
    return raw[keep].astype(np.uint8)


def has_letter(text: str) -> bool:
    import re

    return bool(re.search("[A-Za-z]", text)) or not text.isascii() and any(map(str.isalpha, text))


def build(samples: dict[str, list[str]], most: int = SAMPLE_BYTES) -> dict | None:
    """The tables of all languages: for each state and symbol the next state,
    or, where there is none, the complement of the state after a new phrase's
    first symbol. After a symbol that the labelled text lacks, as before a
    text, the state is one from which every symbol begins a phrase."""
    import numpy as np

    texts = {}
    for lang in sorted(samples):
        joined = b" ".join(normal(t).tobytes() for t in samples[lang])[:most]
        if joined.strip():
            texts[lang] = joined
    if not texts:
        return None
    used = sorted(set(b"".join(texts.values())))
    symbol = np.zeros(256, np.int32)  # 0: in no labelled text
    symbol[used] = np.arange(1, len(used) + 1)
    width, tables, begins = len(used) + 1, [], []
    base = 0
    for data in texts.values():
        moves = suffix_automaton(symbol[np.frombuffer(data, np.uint8)].tolist())
        begin = len(moves)
        start = np.full(width, begin, np.int32)
        start[list(moves[0])] = list(moves[0].values())
        t = np.broadcast_to(~((start + base) * width), (begin + 1, width)).copy()
        for s, m in enumerate(moves):
            t[s, list(m)] = (np.fromiter(m.values(), np.int32, len(m)) + base) * width
        tables.append(t.astype(np.int32))
        begins.append((begin + base) * width)
        base += begin + 1
    cost = np.log2([max(2, len(d)) for d in texts.values()])
    return {"langs": list(texts), "symbol": symbol, "table": np.concatenate(tables).ravel(),
            "begins": np.array(begins, np.int32), "cost": cost}


def phrase_counts(lanes: list, model: dict):
    """Phrases of each lane (array of symbols) by each language."""
    import numpy as np

    order = np.argsort([-len(x) for x in lanes], kind="stable")
    sizes = np.array([len(lanes[i]) for i in order])
    longest, n, k = int(sizes[0]), len(lanes), len(model["langs"])
    grid = np.zeros((longest, n), np.int32)
    for j, i in enumerate(order):
        grid[:sizes[j], j] = lanes[i]
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # lanes longer than t
    table = model["table"]
    state = np.repeat(model["begins"][:, None], n, axis=1)
    count = np.zeros((k, n), np.int32)
    for t in range(longest):
        a = active[t]
        to = table[state[:, :a] + grid[t, :a]]
        new = to < 0
        count[:, :a] += new
        state[:, :a] = to ^ -new.astype(np.int32)
    out = np.empty((k, n), np.int32)
    out[:, order] = count
    return out


def predictor(model: dict | None):
    """A function from a list of texts to (languages, scores)."""
    import numpy as np

    def predict(texts: list[str]):
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        lanes, owner = [], []
        if model is not None:
            for i, text in enumerate(texts):
                if has_letter(text):
                    symbols = model["symbol"][normal(text)]
                    for s in range(0, len(symbols), STRETCH):
                        lanes.append(symbols[s:s + STRETCH])
                        owner.append(i)
        if lanes:
            owner = np.array(owner)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            counts = np.add.reduceat(phrase_counts(lanes, model), starts, axis=1) * model["cost"][:, None]
            best = counts.argmin(axis=0)
            share = np.exp(-STEEP * (counts / counts.min(axis=0) - 1))
            share = share.max(axis=0) / share.sum(axis=0)
            for j, i in enumerate(owner[starts].tolist()):
                langs[i], scores[i] = model["langs"][best[j]], float(share[j])
        return langs, scores

    return predict


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> dict | None:
    """The automata of the labelled documents. Rows that may not be learnt
    from are to be left out of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                       F.col(text_col).alias("text")).filter("doc_id is not null and lang is not null and text is not null")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    picked = None
    for lang in langs:  # the first few ids of each language by hash, each a bounded top-k
        some = (rows.filter(F.col("lang") == lang).select("doc_id")
                .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample_docs))
        picked = some if picked is None else picked.union(some)
    if picked is None:
        return None
    ids = sorted({r["doc_id"] for r in picked.collect()})
    found = rows.filter(F.col("doc_id").isin(ids)).dropDuplicates(["doc_id", "lang", "text"]).withColumn(
        "rank", F.xxhash64(F.col("doc_id").cast("string"))).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(found, key=lambda r: (r["rank"], r["doc_id"], r["text"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    return build(samples, sample_bytes)


def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, lang_pred, score`` (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    fields = [("doc_id", id_type(docs, id_col)), ("lang_pred", "string"), ("score", "double")]
    return map_texts(id_and_text(docs, id_col, text_col, binary=False), lambda: predictor(shared.value), fields)
