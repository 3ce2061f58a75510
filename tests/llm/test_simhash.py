"""SimHash classes against brute force."""
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash as S


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    bits = [sum(xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def plain_classes(fps, distance=2):
    """Smallest member of each value's class, over all pairs."""
    fps = sorted(set(fps))
    label = {f: f for f in fps}
    top = {f: f for f in fps}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {f: root(f) for f in label}


def test_fingerprint():
    rng = random.Random(3)
    alphabet = ["A", "b", "É", " ", "word", "日本", "\x1f", "x" * 70]
    for n in (0, 1, 2, 3, 4, 50):
        text = rng.choice([" ", "\t", "\n ", "\x0b"]).join(rng.choice(alphabet) for _ in range(n)) + " "
        assert S.fingerprint(text) == plain_fingerprint(text)
    assert S.fingerprint(None) == S.fingerprint("") == S.fingerprint(" \n") == 0
    long_text = " ".join(rng.choice(alphabet) + str(k % 999) for k in range(S.PIECE + 5))
    assert S.fingerprint(long_text) == plain_fingerprint(long_text)


def test_hash_is_sparks(spark):
    from pyspark.sql import functions as F
    texts = ["", "a", "one two three", "x" * 40, "é ü 日本"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [g[0] & (1 << 64) - 1 for g in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("distance, count, crowd", [(2, 300, 0), (2, 60, 250), (1, 200, 0), (3, 200, 0)])
def test_links_give_all_classes(spark, distance, count, crowd):
    """Random values with near ones, chains, and a crowd that overfills buckets."""
    rng = random.Random(distance * 1000 + crowd)
    fps = {0, (1 << 64) - 1}
    for _ in range(count):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            fps.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    centre = rng.getrandbits(64)
    while crowd and len(fps) < count + crowd:
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 4)):
            x ^= 1 << b
        fps.add(x)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    found = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance).collect()
    near = plain_classes(signed, distance)
    joined = {f: f for f in signed}

    def root(x):
        while joined[x] != x:
            x = joined[x]
        return x

    for a, b in found:
        x, y = sorted((root(a), root(b)))
        joined[y] = x
    assert {f: root(f) for f in signed} == near


def test_classes_of_rows(spark, docs_of):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(1, None), (2, ""), (3, " \n"), (None, "one two"), (None, "one two"), (9, "Three words here"), (8, "three  words\there")]
    for k in range(40):
        own = list(base)
        own[k] = f"v{k}"
        rows.append((100 + k, " ".join(own)))
    rows += [(200, rows[-1][1]), (200, rows[-1][1]), (500, "x " * 60_000)]
    rows += [(300 + k, " ".join(f"r{rng.randrange(10 ** 6)}" for _ in range(30))) for k in range(30)]
    got = S.simhash_classes(docs_of(rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    near = plain_classes(signed)
    least = {}
    for (i, _), f in zip(rows, signed):
        if i is not None:
            least[near[f]] = min(i, least.get(near[f], i))
    want = Counter((i, f, least.get(near[f])) for (i, _), f in zip(rows, signed))
    assert Counter(tuple(r) for r in got) == want
    assert least[near[signed[0]]] == 1 and len({near[f] for f in signed[7:47]}) < 40


def test_empty_table(spark, docs_of):
    assert S.simhash_classes(docs_of([])).count() == 0


def test_query_against_brute_force(spark):
    from tests.llm.conftest import SF
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    near = plain_classes(fps)
    least = {}
    for r, f in zip(rows, fps):
        least[near[f]] = min(r.doc_id, least.get(near[f], r.doc_id))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.q_simhash(spark, SF).collect()}
    assert got == {r.doc_id: (f"{f:016x}", least[near[f]]) for r, f in zip(rows, fps)}
    assert np.mean([c != d for d, (_, c) in got.items()]) > 0.01
