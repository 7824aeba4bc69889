"""Quality rules, licence scan, line dedup and decontamination against plain
Python restatements of their contracts."""
import random
import re

import pytest

from paperlane.llm import decontaminate, licenses, linededup, quality

from .util import docs, prose

WORDS = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def covered(words, n):
    seen = {}
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i:i + n]), []).append(i)
    return {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(n)}


def test_quality_counts(spark):
    line = prose(1, 12)
    texts = ["a b c", "one two three four five six seven eight nine ten", " ".join(["re"] * 30), None,
             f"{line}\n{line}\n \n \n{prose(2, 80)}", prose(3, 300) + " " + prose(3, 300), "é# ß$ 漢<>| x " * 9]
    got = {r.doc_id: r for r in quality.repetition_coverage(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        words, seen, dup = WORDS.findall(t or ""), set(), []
        for x in (t or "").split("\n"):
            if WORDS.search(x):
                dup += [x] if x in seen else []
                seen.add(x)
        r, repeat = got[i], len(covered(words, 5))
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(dup), repeat)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "")
        assert r.dup_line_chars == sum(len(w) for x in dup for w in WORDS.findall(x))
        for n in quality.NGRAM_LIMITS:
            assert r[f"dup_chars_{n}"] == sum(len(words[k]) for k in covered(words, n))
        assert r.base_failed == (len(words) < 10 or 100 * repeat > 20 * len(words))
        assert not (r.base_failed and r.kept)
    assert got[1].kept and not got[5].kept


@pytest.mark.parametrize("expression, want", [
    ("MIT", ["mit"]), ("MIT OR Apache-2.0 AND BSD-3-Clause", ["mit", "apache-2.0 and bsd-3-clause"]),
    ("(MIT OR ISC) AND Zlib", ["mit and zlib", "isc and zlib"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", ["gpl-2.0-only with classpath-exception-2.0", "mit"]),
    ("MIT and", None), ("(MIT", None), ("(MIT OR ISC) WITH x", None), ("MIT */ int main", ["mit"]), ("or MIT", None),
])
def test_licence_expressions(expression, want):
    sets = licenses.alternatives(licenses.expression_tokens(expression.lower()))
    assert (sets and [" and ".join(sorted(s)) for s in sets]) == (want and [
        " and ".join(sorted(w.split(" and "))) for w in want])


def test_licence_scan(spark):
    texts = ["Released under the MIT License.", "mit-license MIT\nLICENSE x apache license", "summit license mit licenses",
             "// SPDX-License-Identifier: MIT OR Apache-2.0\ncode", "SPDX-License-Identifier: (MIT", None, "ünder GNU general "
             "public license, general public license", "x " * 500 + "Apache License", prose(4, 100)]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, list(enumerate(texts)))).collect()}
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    for i, t in enumerate(texts):
        words = ALNUM.findall(lower(t))
        at = [(k, lab) for p, lab in phrases.items() for k in range(len(words)) if words[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({lab for _, lab in at}))
        assert {*r.base_labels.split(",")} - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
    assert got[3].labels == "spdx:apache-2.0,spdx:mit" and got[4].labels == "invalid-expression"


def slow_dedup(rows):
    def key(x):
        k = lower(x.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 10 else None

    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for x in (t or "").split("\n"):
            if key(x) is not None:
                first.setdefault(key(x), i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) is None or first[key(x)] == i]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup(spark):
    r = random.Random(5)
    pool = [prose(i, 4) for i in range(40)] + ["short", "", "  ", "漢字漢字漢字漢字漢字", "漢字漢字漢字漢字漢", " " * 11]
    rows = []
    for i in range(60):
        lines = [r.choice(["", " ", "\t"]) + (x.upper() if r.random() < 0.2 else x) + r.choice(["", "\r", " "])
                 for x in r.choices(pool, k=r.randrange(12))]
        rows.append((i * 7 % 61, "\n".join(lines)))
    want = slow_dedup(rows)
    for batches, fanout in ((4, 3), (1, 3), (7, 2)):
        made = linededup.dedup_lines(docs(spark, rows), batches=batches, fanout=fanout)
        assert {x.doc_id: (x.text, x.n_lines, x.n_dropped) for x in made.collect()} == want
        assert made.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_runs_are_merged_by_level(spark, tmp_path):
    runs = linededup.Runs(spark, str(tmp_path), fanout=2)
    for b in range(4):
        runs.add(spark.createDataFrame([(k, 0, 10 * b + k) for k in range(2 + b)], "h1 long, h2 long, doc_id long"))
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert sorted(map(tuple, runs.read().collect())) == [(0, 0, 0), (1, 0, 1), (2, 0, 12), (3, 0, 23), (4, 0, 34)]


def slow_hits(text, items):
    words, hit, ids = ALNUM.findall(lower(text)), set(), set()
    for item, t in items:
        own = ALNUM.findall(lower(t))
        n = min(10, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == own[k:k + n]:
                    hit |= set(range(i, i + n))
                    ids.add(item)
    return len(words), len(hit), sorted(ids)


def test_decontamination(spark):
    r = random.Random(8)
    long = [prose(500 + i, 30) for i in range(6)]
    items = [(f"i{k}", t) for k, t in enumerate(long)] + [("dup", long[0]), ("short", "tiny item of words"), ("one", "Zebra"),
             ("rep", "na " * 25), ("none", "?!"), ("null", None), ("nine", " ".join("abcdefghi")), ("ten", " ".join("klmnopqrst"))]
    texts = [prose(600, 50), None, "", "zebra", "a zebra-zebra B", "tiny item of words tiny item of", "na " * 40,
             " ".join("abcdefghijklmnopqrstuvwxyz"), long[1].upper().replace(" ", "--")]
    for i in range(30):
        words = prose(700 + i, 40).split()
        own = r.choice(long).split()
        at, n = r.randrange(20), r.randrange(7, 20)
        words[10:10] = own[at:at + n]
        if i % 3 == 0:
            words[30:30] = r.choice(long).split()[:11] + ["x"] + own[-10:]
        texts.append(" ".join(words))
    frame = spark.createDataFrame(items, "item_id string, text string")
    got = {x.doc_id: (x.n_words, x.n_hit, x["items"]) for x in
           decontaminate.find_contamination(docs(spark, list(enumerate(texts))), frame).collect()}
    assert got == {i: slow_hits(t, items) for i, t in enumerate(texts)}
    none = decontaminate.find_contamination(docs(spark, [(1, "a b")]), frame.limit(0)).first()
    assert (none.n_words, none.n_hit, none["items"]) == (2, 0, [])


def test_winnowing_guarantee():
    import numpy as np

    r = np.random.default_rng(3)
    for _ in range(50):
        shared = r.integers(0, 6, 10).astype(np.uint64)  # with ties
        a, b = (np.concatenate([r.integers(0, 6, r.integers(0, 9)).astype(np.uint64), shared,
                                r.integers(0, 6, 9).astype(np.uint64)]) for _ in range(2))
        from paperlane.llm.common import rolling
        pa, pb = (set(rolling(x, 5)[decontaminate.winnow(rolling(x, 5), 6)].tolist()) for x in (a, b))
        assert pa & pb


def test_expressions_of_many_alternatives_are_valid(spark):
    groups = [f"(a{i} OR b{i})" for i in range(7)]  # 128 alternatives
    text = "SPDX-License-Identifier: "
    rows = [(1, text + " AND ".join(groups)), (2, text + " AND ".join(groups[:6])),
            (3, text + " AND ".join(groups) + " AND"), (4, text + " AND ".join(groups) + " WITH c")]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    names = sorted(f"spdx:{x}{i}" for x in "ab" for i in range(7))
    assert got[1].labels == ",".join(names)
    assert got[1].expressions == [" and ".join(groups).lower()]
    assert len(got[2].expressions[0].split(" or ")) == 64
    assert [got[i].labels for i in (3, 4)] == ["invalid-expression"] * 2
    assert [got[i].expressions for i in (3, 4)] == [["invalid"]] * 2


def test_the_repetition_verdict_decides(spark):
    """Documents that the base rule keeps: a passage of 12 or 16 % that comes
    twice fails, short repeats and clean prose stay."""
    def twice(n_all: int, n: int, times: int = 2) -> str:
        words = prose(9, n_all - times * n).split()
        passage = prose(77, n).split()
        parts = [words[i * len(words) // times:(i + 1) * len(words) // times] + passage for i in range(times)]
        return " ".join(w for p in parts for w in p)

    texts = [twice(500, 40), twice(500, 30), twice(500, 10), prose(5, 500), twice(500, 4, 8), "a b c d e f g h i j k l"]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.repetition_coverage(docs(spark, list(enumerate(texts)))).collect()}
    assert got == {0: (False, False), 1: (False, False), 2: (False, True), 3: (False, True), 4: (False, True), 5: (False, True)}


@pytest.mark.parametrize("text, labels, sure", [
    ("License-Expression: see the file COPYING", "unknown-identifier", False), ("the spdx-license-identifier: tag is used", "unknown-identifier", False),
    ("SPDX-License-Identifier: MIT", "spdx:mit", True), ("SPDX-License-Identifier: GPL-2.0+", "spdx:gpl-2.0+", True),
    ("SPDX-License-Identifier: LicenseRef-Acme", "spdx:licenseref-acme", True), ("SPDX-License-Identifier: MIT OR Own-1", "spdx:mit,spdx:own-1", True),
    ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND", "as-is-text", True)])
def test_identifiers_are_known_or_reported(spark, text, labels, sure):
    r = licenses.scan_licenses(docs(spark, [(1, text)])).first()
    assert r.labels == labels and (r.score >= 0.5) == sure


def test_a_text_full_of_tags_takes_linear_time(spark):
    import time

    t0 = time.time()
    r = licenses.scan_licenses(docs(spark, [(1, "spdx-license-identifier: " * 200_000), (2, "spdx-license-identifier: mit " * 100_000)])).collect()
    assert time.time() - t0 < 60 and {x.doc_id: x.labels for x in r} == {1: "unknown-identifier", 2: "spdx:mit"}


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(x'6D6974FF206D6974206C6963656E7365' AS string) AS text")
    assert licenses.scan_licenses(df).first().n_words == 3


def test_line_dedup_of_string_and_missing_ids(spark):
    line, other = "a line of some length", "another line of length"
    df = spark.createDataFrame([("b", f"{line}\nx"), ("a", line), (None, f"{line}\n{other}"), (None, other), ("c", None)], "doc_id string, text string")
    got = sorted(((r.doc_id, r.text) for r in linededup.dedup_lines(df, batches=2).collect()), key=repr)
    assert got == sorted([("b", "x"), ("a", line), (None, other), (None, other), ("c", "")], key=repr)


def test_many_rows_without_an_id_are_no_one_group(spark):
    """What rows without an id lose is gathered text by text."""
    lines = [f"line number {i} of the table" for i in range(200)]
    rows = [(i, x) for i, x in enumerate(lines)] + [(None, f"{x}\nown {i}") for i, x in enumerate(lines)]
    out = linededup.dedup_lines(docs(spark, rows))
    assert sorted(r.text for r in out.filter("doc_id is null").collect()) == sorted(f"own {i}" for i in range(200))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__t" in plan.split("Aggregate [")[1][:200]


def test_a_store_of_lines_is_opened_again(spark, tmp_path):
    a, b, c = (f"{x} line of some length" for x in "abc")
    store = str(tmp_path)
    first = linededup.dedup_lines(docs(spark, [(1, f"{a}\n{b}"), (2, a)]), store=store)
    assert {r.doc_id: r.text for r in first.collect()} == {1: f"{a}\n{b}", 2: ""}
    (tmp_path / "commits" / "00000099.json").write_text('{"levels": [["run-')  # cut off
    later = linededup.dedup_lines(docs(spark, [(7, f"{b}\n{c}"), (8, c)]), store=store)
    assert {r.doc_id: r.text for r in later.collect()} == {7: c, 8: ""}
    assert linededup.Runs(spark, store).read().count() == 3


def test_bytes_that_are_no_text_in_lines(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 'a line of length'), (2L, cast(x'FF0A61206C696E65206F66206C656E677468' AS string)) AS t(doc_id, text)")
    assert {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()} == {1: "a line of length", 2: "�"}


def test_the_stage_keeps_the_columns_it_is_given(spark):
    from pyspark.sql import functions as F

    from paperlane.llm import stages

    line = "a line of some length"
    df = docs(spark, [(1, line), (2, f"{line}\nx")]).withColumn("n_lines", F.lit("mine")).drop("n_chars")
    out = stages.drop_repeated_lines(spark, df, "")
    assert out.columns == df.columns and {(r.doc_id, r.text, r.n_lines) for r in out.collect()} == {(1, line, "mine"), (2, "x", "mine")}
