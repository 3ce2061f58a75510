import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import components, jaccard_join, registry, substring_dedup

from .conftest import SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_classes(rows):
    """[(n_shingles, smallest id linked)] for each (id, text)."""
    sets = []
    for _, t in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                top[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(same) if same else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def near(words, k):
    out = list(words)
    out[k] = f"x{k}"
    return " ".join(out)


def test_near_copies_are_not_compared_pair_by_pair(spark, docs_of, monkeypatch):
    rng, base, n = random.Random(5), [f"w{k}" for k in range(200)], 120
    rows = []
    for k in range(n):  # sets with 1 word changed link with all, those with 3 with hardly any other
        words = list(base)[:200 if k else 198]  # the first of each list is a set with 3
        for j in rng.sample(range(len(words)), 1 + k % 2 * 2 if k else 3):
            words[j] = f"x{k}_{j}"
        rows.append((k, " ".join(words)))
    made, verified = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *a: made.append(pairs.count()) or verified(pairs, *a))
    first = jaccard_join._first_answers
    monkeypatch.setattr(jaccard_join, "_first_answers", lambda *a: first(*a).where("false"))
    out = jaccard_join.jaccard_classes(docs_of(rows)).select("id", "n_shingles", "component_id").collect()
    assert order([tuple(r) for r in out]) == order(brute_classes(rows))
    assert sum(made) <= 4 * n, made


def test_classes_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in registry.QUERIES["op7_ngram_jaccard_join"](spark, SF).select("doc_id", "n_shingles", "component_id").collect()]
    assert order(got) == order(brute_classes(docs))


def test_classes_of_chains_passages_and_odd_rows(spark, docs_of):
    base = [f"w{k}" for k in range(60)]
    chain = [(100 + k, " ".join([*base[2 * k:], *(f"y{j}" for j in range(2 * k))])) for k in range(8)]  # neighbours link, ends don't
    copies = [(200 + k, near([f"c{j}" for j in range(80)], k)) for k in range(30)]
    passage = " ".join(f"p{k}" for k in range(30))
    shared = [(300 + k, passage + " " + " ".join(f"q{k}_{j}" for j in range(25 + k))) for k in range(12)]
    odd = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE  Two"), (5, "one two"), (None, "one two"), (None, "solo"), (7, "z " * 30_000), (8, "z " * 29_999)]
    rows = chain + copies + shared + odd
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(docs_of(rows)).collect()]
    assert order(got) == order(brute_classes(rows))
    kept = sorted((r["doc_id"] is not None, r["doc_id"]) for r in jaccard_join.one_of_each_class(docs_of(rows)).collect())
    first = {}
    for (i, n, c) in brute_classes(rows):
        first.setdefault((n > 0, c) if n else (0, i), i)
    assert [k for _, k in kept] == sorted(set(c if n else i for (i, n, c) in brute_classes(rows) if not (n and c is None)) | {None}, key=lambda x: (x is not None, x))
    assert jaccard_join.jaccard_classes(docs_of([])).count() == 0 and jaccard_join.one_of_each_class(docs_of([])).count() == 0


def test_small_blocks_give_the_same_classes(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "LEADERS", 1)
    monkeypatch.setattr(jaccard_join, "HOT", 2)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, passage + " " + " ".join(f"q{k // 2}_{j}" for j in range(20 + k % 2))) for k in range(20)]
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(docs_of(rows)).collect()]
    assert order(got) == order(brute_classes(rows))


def test_texts_of_nodes_take_one_python_process_for_each_task(spark, docs_of):
    rows = [(1, "a b c d e f"), (2, "A b  c d e f"), (None, "g h i j k l"), (4, "m n"), (4, "o p"), (5, None), (6, " "), (7, "q r")]
    own = docs_of(rows).selectExpr("doc_id as id", "text")
    nodes = jaccard_join.text_nodes(own).drop("text")
    key = {t: k for t, k in jaccard_join.text_nodes(own).select("text", "node").collect()}
    wanted = spark.createDataFrame([(key[t],) for t in ("a b c d e f", "g h i j k l", "m n", "o p")], "node long")
    found = jaccard_join._texts(own, nodes, wanted, 5)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, found.collect())) == sorted((key[t], t) for t in ("a b c d e f", "g h i j k l", "m n", "o p"))
    assert found.columns == ["node", "text"]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (100, 95), (7, 7)]
    got = {r["node"]: r["comp"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}


def brute_dedup(rows, size=20):
    first, docs = {}, {}
    for i, t in rows:
        docs[i] = WORDS.findall(t or "")
    for i in sorted(docs, key=lambda x: (x is not None, x)):
        for k in range(len(docs[i]) - size + 1):
            first.setdefault(tuple(docs[i][k:k + size]), (i, k))
    out = {}
    for i, w in docs.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] != (i, k):
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_dedup_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_dedup(docs)
    for r in registry.QUERIES["op6_substring_dedup"](spark, SF).collect():
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("hot,chunk", [(2000, 20_000), (0.001, 3)])
def test_dedup_odd_rows(spark, docs_of, monkeypatch, hot, chunk):
    """Also with minimisers that count as hot and buckets settled in small parts."""
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    passage = " ".join(f"p{k}" for k in range(25))
    rows = [(k, f"a{k} b{k} {passage} c{k}") for k in range(40)] + [(50 + k, passage) for k in range(20)]
    rows += [(90, "z " * 3000), (91, None), (92, ""), (93, passage.upper()), (None, passage + " tail é"), (94, "\n".join(passage.split()))]
    want = brute_dedup(rows)
    got = substring_dedup.drop_repeats(docs_of(rows)).collect()
    assert {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == want and len(got) == len(rows)
    assert substring_dedup.drop_repeats(docs_of([])).count() == 0
    twice = substring_dedup.drop_repeats(docs_of([(1, passage), (1, passage), (2, passage)])).collect()
    assert sorted((r["id"], r["n_removed"]) for r in twice) == [(1, 0), (1, 0), (2, 25)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab c\n", max_size=60), min_size=1, max_size=6), st.integers(1, 7))
def test_super_kmers_cover_each_window_once(texts, size):
    g = substring_dedup.G.text_grid([t.encode() for t in texts], substring_dedup.SEP)
    start, count, mini, doc = substring_dedup._super_kmers(g, size)
    windows = [(d, s + j) for s, n, d in zip(start, count, doc) for j in range(n)]
    assert windows == [(d, k) for d in range(g.n) for k in range(g.ptr[d], g.ptr[d + 1] - size + 1)]
    key = {}
    for s, n, m in zip(start, count, mini):
        for j in range(n):
            w = tuple(g.word(s + j + k) for k in range(size))
            assert key.setdefault(w, m) == m
