"""Operator 11 against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from nestloom.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def bag(text):
    return Counter(TERM.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))))


def ranked(docs, items, k):
    bags = [(i, bag(t)) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, df = sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * d + 1))) for t, d in df.items()}
    out = {}
    for item in {i for i, _ in items}:
        wanted = {t for i, text in items if i == item for t in bag(text)}
        found = []
        for i, b in bags:
            m = 100 - 50 + (50 * sum(b.values()) * len(bags)) // total
            score = sum(weight[t] * ((1000000000 * b[t]) // (1000 * b[t] + 20 * m)) for t in wanted if t in b)
            if score > 0:
                found.append((-score, math.inf if i is None else i))
        out[item] = [(r + 1, None if i is math.inf else i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


def collected(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["rank"])):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


@pytest.fixture()
def items(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id bigint, text string")


def test_terms_are_those_of_the_pattern():
    for text in ("Ab_c-d9 É1x  ", "x\x00y\x7fz w ÀB", "日本 a@b[c", "", None):
        assert [t.decode() for t in lexical.terms(text)] == list(TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)})))


@pytest.mark.parametrize("sizes", [(2048, 24), (7, 2)])
def test_search_equals_brute_force(docs, items, monkeypatch, sizes):
    monkeypatch.setattr(lexical, "SEGMENT", sizes[0])
    monkeypatch.setattr(lexical, "BLOCK", sizes[1])
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    given = [(i, " ".join(words[j] for j in rng.zipf(1.4, rng.integers(1, 40)) % 60)) for i in range(150)]
    given += [(400 + i, given[0][1]) for i in range(30)]  # a group of copies: ties
    given += [(None, None), (None, "w1 w5 w5"), (7, "w9"), (7, "w9 w10 W9"), (-3, ""), (-4, "?!"), (900, "w2 " * 60000)]
    asked = [(i, " ".join(words[j] for j in rng.integers(0, 60, 8))) for i in range(6)]
    asked += [(20, None), (21, "..."), (22, "absent"), (23, "w5 w5 W5"), (23, "w6"), (None, "w1 w2")]
    want = {i: r for i, r in ranked(given, asked, 9).items() if r}
    assert collected(lexical.search(docs(*given), items(*asked), k=9)) == want


def test_other_columns_may_have_any_name(docs, items):
    from pyspark.sql import functions as F

    given = docs((1, "a b"), (2, "b c")).withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("id", F.lit(None)).withColumn("terms", F.lit(3))
    assert collected(lexical.search(given, items((1, "a b c"), (1, "zz")).withColumn("doc_id", F.lit(5)))) == ranked([(1, "a b"), (2, "b c")], [(1, "a b c")], 50)


def test_empty_tables(docs, items):
    assert lexical.search(docs(), items((1, "a"))).collect() == []
    assert lexical.search(docs((1, "a")), items()).collect() == []
    assert lexical.search(docs((1, "a")), items()).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_are_skipped_by_exact_bounds():
    rng = np.random.default_rng(5)
    impact = np.zeros((900, 30), np.int32)
    for row in range(900):  # three kinds of documents, each with its own terms
        own = 10 * (row % 3) + rng.choice(10, 5, replace=False)
        impact[row, own] = rng.integers(1, 1000, 5)
    together = [np.arange(30)] * 30
    segment = lexical.Segment(impact, together, block=8)
    scored = 0
    for _ in range(20):
        wanted = np.sort(rng.choice(30, 6, replace=False))
        weights = rng.integers(1, 9000, 6).astype(float)
        best = lexical.Best(5)
        scored += segment.search(wanted, weights, np.arange(900), best)
        exact = (impact[:, wanted] @ weights).astype(np.int64)
        want = sorted(zip(-exact, range(900)))[:5]
        assert list(zip(-best.score, best.id)) == [w for w in want if w[0] < 0]
    assert scored < 0.7 * 20 * 900


def test_items_come_in_blocks(docs, items, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_BYTES", 4)
    monkeypatch.setattr(lexical, "COLUMNS", 2)
    given, asked = [(1, "a b c d"), (2, "c d e f"), (3, "f g")], [(1, "a c"), (2, "b d g"), (3, "f"), (4, "g a")]
    assert collected(lexical.search(docs(*given), items(*asked))) == ranked(given, asked, 50)
