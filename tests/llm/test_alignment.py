"""Tokenizer alignment against brute force with the plain tokenizers."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import alignment as A
from tessera.llm.tokens import BYTE_CHARS


class Plain:
    """Each text encoded whole, links by comparing all byte ranges of a group."""

    def __init__(self):
        self.a = Tokenizer.from_file(A.SIDE_A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=A.SIDE_B)
        self.back = {c: b for b, c in BYTE_CHARS.items()}

    def tokens(self, text):
        if not text:
            return [], []
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        spelled_a = [bytes(self.back[c] for c in self.a.id_to_token(i)) for i in ids_a]
        spelled_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(spelled_a) != (" " + text).encode() or b"".join(spelled_b) != (" " + text).encode():
            return [], []

        def ranges(ids, spelled):
            out, at = [], 0
            for i, s in zip(ids, spelled):
                out.append((i, at, at + len(s)))
                at += len(s)
            return out

        return ranges(ids_a, spelled_a), ranges(ids_b, spelled_b)

    def rows(self, rows):
        links, facts, holding = [], [], defaultdict(set)
        for k, (_, text) in enumerate(rows):
            a, b = self.tokens(text)
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups, own, lo = [], [], 0
            for hi in cuts:
                x, y = [t for t in a if lo <= t[1] and t[2] <= hi], [t for t in b if lo <= t[1] and t[2] <= hi]
                groups.append(",".join(str(t[0]) for t in x) + "|" + ",".join(str(t[0]) for t in y))
                own += [(s[0], t[0]) for s in x for t in y if s[1] < t[2] and t[1] < s[2]]
                lo = hi
            links.append(own)
            facts.append((len(a), len(b), len(cuts), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
            for p in own:
                holding[p].add(k)
        count = {p: len(d) for p, d in holding.items()}
        top = defaultdict(int)
        for (a, _), n in count.items():
            top[a] = max(top[a], n)
        out = []
        for (i, _), own, f in zip(rows, links, facts):
            out.append((i, *f[:4], sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own), f[4]))
        return out, count


@pytest.fixture(scope="module")
def plain():
    return Plain()


def odd_texts():
    rng = random.Random(11)
    words = ["hello", "Straße", "naïve", "日本語", "don't", "x=1;", "<s>", "</s>", "<unk>", "<|endoftext|>", "a▁b", "▁", "é", "\U0001f600", "1234567",
             "\x00", "\x7f", "<0x41>", "ﬁ", "...", "\xa0", "　", "﻿", "'s", "WORD", "\r", " "]
    out = [None, "", " ", "  ", "\n", "\t", "a", " a", "a ", "a  b", "a \n b", "x" * 3000, "a  " * 400, "�", "don 't", "a 's b", "q▁ r"]
    out += [rng.choice([" ", "  ", "\n", " \t", ""]).join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(250)]
    return out + [" ".join(rng.choice(words[:10]) for _ in range(30)) for _ in range(60)]


def test_odd_texts_small_groups(spark, docs_of, plain):
    """Repeated rows, null ids and every group of runs split."""
    rows = list(enumerate(odd_texts())) + [(3, "hello a"), (3, "hello a"), (None, "hello"), (None, None)]
    want, _ = plain.rows(rows)
    got = A.align(docs_of(rows), group_records=50).collect()
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert sum(w[1] == 0 for w in want) >= 5 and any(w[4] > w[3] for w in want)


def test_blocks(plain):
    rows = list(enumerate(odd_texts()[5:]))
    ids = [i for i, _ in rows]
    digest, runs = {}, []
    for lo in range(0, len(rows), 7):
        parts = A.aligner(A.SIDE_A, A.SIDE_B).texts([t or "" for _, t in rows[lo:lo + 7]])
        for i, p in zip(ids[lo:], parts):
            digest[i] = sum(len(x[0]) // 8 for x in p)
        runs += [A._pairs_of(r) for _, _, r in A._runs([b"".join(x[0] for x in p) for p in parts])]
    want, count = plain.rows(rows)
    assert digest == {w[0]: w[4] for w in want}
    got = {}
    for pairs, n in A.merged(runs):
        assert not set(pairs.tolist()) & set(got)
        got.update(zip(pairs.tolist(), n.tolist()))
    assert got == {a << 32 | b: n for (a, b), n in count.items()}


def test_merge_over_many_steps(monkeypatch):
    monkeypatch.setattr(A, "STEP", 5)
    rng = np.random.default_rng(2)
    runs = [(np.unique(rng.integers(0, 400, n)), None) for n in (0, 1, 5, 200, 300, 300)]
    runs = [(p, rng.integers(1, 9, len(p))) for p, _ in runs]
    want = Counter()
    for p, c in runs:
        want.update(dict(zip(p.tolist(), c.tolist())))
    pieces = list(A.merged(runs))
    pairs = np.concatenate([p for p, _ in pieces])
    assert (np.diff(pairs) > 0).all() and dict(zip(pairs.tolist(), np.concatenate([n for _, n in pieces]).tolist())) == want
    assert list(A.merged([])) == []


def test_empty_table_and_no_tokens(spark, docs_of):
    assert A.align(docs_of([])).count() == 0
    got = A.align(docs_of([(1, None), (2, "")])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_against_brute_force(spark, plain):
    from tests.llm.conftest import SF
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want, count = plain.rows(rows)
    assert sorted(map(tuple, A.q_alignment(spark, SF).collect())) == sorted(want)
    pairs = A.pair_counts(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {(r.a, r.b): r.n for r in pairs} == count
