"""Fingerprints and components against brute force."""
import random

import xxhash

from paperlane.llm import simhash
from paperlane.llm.components import connected_components
from paperlane.session import ensure_checkpoint_dir

from .util import docs, prose


def slow_fingerprint(text: str) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in lowered.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    runs = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints: dict) -> dict:
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_fingerprint():
    for t in ("", "One", "one TWO", "A b C d", prose(1, 400), "x y z\u0085w v", "É é ABC"):
        assert simhash.fingerprint((t or "").encode()) == slow_fingerprint(t)


def test_same_hash_as_sparks(spark):
    from pyspark.sql import functions as F

    text = "alpha beta gamma"
    h = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert h % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_masks_cover_every_pair_within_the_radius():
    r = random.Random(1)
    masks = simhash.masks(list(range(64)), 3)
    assert len(masks) == 15
    for _ in range(3000):
        x = r.getrandbits(64)
        y = x
        for p in r.sample(range(64), r.randrange(4)):
            y ^= 1 << p
        assert any(x & m == y & m for m in masks)


def _near_prints(n: int, seed: int) -> list[int]:
    r = random.Random(seed)
    out = [r.getrandbits(64)]
    while len(out) < n:
        x = r.choice(out[-20:]) if r.random() < 0.8 else r.getrandbits(64)
        for p in r.sample(range(64), r.randrange(1, 6)):
            x ^= 1 << p
        out.append(x)
    return out


def test_links_of_small_and_of_dealt_again_buckets(spark):
    ensure_checkpoint_dir(spark)
    prints = dict(enumerate(dict.fromkeys(_near_prints(300, 4))))
    want = slow_components(prints)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints.values()], "fp long").repartition(4)
    for most in (4096, 5):  # with 5, many buckets are dealt again
        found = connected_components(simhash.near_links(frame, 3, most))
        root = {r.node: r.root for r in found.collect()}
        got = {i: root.get(simhash._signed(p), simhash._signed(p)) for i, p in prints.items()}
        same = {}
        assert all(same.setdefault(got[i], want[i]) == want[i] for i in prints)
        assert len(set(got.values())) == len(set(want.values()))


def test_groups_of_documents(spark):
    base = prose(9, 300).split()
    rows = [(10, " ".join(base)), (3, " ".join(base).upper()), (7, " ".join([*base[:-1], "other"]))]
    rows += [(20 + i, prose(50 + i, 80)) for i in range(20)] + [(5, ""), (40, None)]
    prints = {i: slow_fingerprint(t or "") for i, t in rows}
    want = slow_components(prints)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.simhash_groups(docs(spark, rows)).collect()}
    assert got == {i: (prints[i], want[i]) for i in prints}


def test_components_of_long_chains_and_hubs(spark):
    ensure_checkpoint_dir(spark)
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(200, 260)] + [(7, 7), (900, 899)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(101)} == {0} and {found[i] for i in (500, *range(200, 260))} == {200}
    assert found[900] == found[899] == 899
