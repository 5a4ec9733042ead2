"""Content sort, n-gram join, suffix deduplication, components."""

import random

import pytest
from helpers import repeats, shingle_classes
from nestloom.llm import content_sort, suffix_dedup
from nestloom.llm.components import components
from nestloom.llm.ngram_join import jaccard_classes


def ids(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


@pytest.mark.parametrize("keep, stays", [("smallest", 1), ("largest", 5)])
def test_content_sort_keeps_one_of_equal_texts(docs, keep, stays):
    df = docs((1, "A b"), (2, "a c"), (3, "a B"), (5, "A B"), (7, None), (8, ""), (9, "É"), (10, "é"))
    got = ids(content_sort.content_sort(df, keep=keep), "doc_id", "keep_id", "group_size", "kept")
    assert {i for i in (1, 3, 5) if got[i][2]} == {stays} and got[3][:2] == (stays, 3)
    assert got[7][0] == got[8][0] and got[7][1] == 2
    assert got[9][1] == got[10][1] == 1, "only A-Z is folded"


def test_content_sort_of_a_hot_text_repeated_rows_and_null_ids(docs):
    rows = [(i, "hot") for i in range(4000)] + [(4000, "cold"), (4000, "cold"), (None, "cold"), (None, "lone"), (None, "lone")]
    got = content_sort.content_sort(docs(*rows), carry=["source"]).collect()
    assert len(got) == len(rows)
    kept = [(r.doc_id, r.keep_id, r.group_size) for r in got if r.kept]
    assert sorted(kept, key=str) == sorted([(0, 0, 4000), (4000, 4000, 3), (None, None, 2)], key=str)
    assert content_sort.content_sort(docs()).count() == 0


def test_ngram_join_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    for width, percent, block in ((4, 85, 3000), (4, 60, 3)):
        got = ids(jaccard_classes(small, width, percent, block=block), "doc_id", "n_shingles", "component_id")
        assert got == shingle_classes(rows, width, percent)


def test_ngram_join_on_a_family_of_near_copies(docs):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    rows += [(200, "one two three"), (201, "ONE two three"), (202, None), (203, " \n"), (204, " ".join(base[:60]))]
    for block in (3000, 20):
        got = ids(jaccard_classes(docs(*rows), block=block), "doc_id", "n_shingles", "component_id")
        assert got == shingle_classes(rows, 4, 85)


def test_ngram_join_of_odd_tables(docs):
    assert jaccard_classes(docs()).count() == 0
    got = jaccard_classes(docs((1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "z"), (4, ""))).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 1), (1, 1), (1, 1), (4, 4)]


def test_components_of_a_long_path_and_a_star(rows):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in components(rows("a bigint, b bigint", *links)).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + k: 100 for k in range(1, 30)}


def test_suffix_dedup_equals_brute_force(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    want = repeats(rows, 100)
    for slice_size in (20_000, 2):
        got = ids(suffix_dedup.remove_repeats(small, slice_size=slice_size), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == want


def test_suffix_dedup_of_passages_periods_and_copies(docs):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    passages = [text(n) for n in (99, 100, 101, 180, 700)]
    rows = [(i, text(rng.randrange(150)) + rng.choice(passages)[rng.randrange(20) :] + text(rng.randrange(150)) + rng.choice(passages)) for i in range(60)]
    rows += [(100, "ab" * 300), (101, "ba" * 300), (102, "x" * 250), (103, None), (104, ""), (105, rows[3][1]), (106, rows[3][1])]
    want = repeats(rows, 100)
    for slice_size in (20_000, 3):
        got = ids(suffix_dedup.remove_repeats(docs(*rows), slice_size=slice_size), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == want


def test_suffix_dedup_of_odd_tables(docs):
    assert suffix_dedup.remove_repeats(docs()).count() == 0
    rng = random.Random(2)
    long_text = "".join(rng.choice("abcdefg") for _ in range(150))
    got = suffix_dedup.remove_repeats(docs((2, long_text), (2, long_text), (None, long_text), (1, "q"))).collect()
    assert sorted((r.doc_id or 9, r.n_removed) for r in got) == [(1, 0), (2, 0), (2, 0), (9, 150)]


def test_ngram_join_moves_every_hash_once_to_count_it(docs, monkeypatch):
    from nestloom.llm import ngram_join

    plans = {}

    def seen(df, label="cut"):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, label)

    materialize = ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", seen)
    text = " ".join(f"w{i}" for i in range(60))
    table = docs((1, text), (2, text + " more"), (3, "other words " * 9), (1, "quite another text here"))
    assert {(r.doc_id, r.component_id) for r in ngram_join.jaccard_classes(table).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert "tokens" not in plans
    for label in ("alive", "ordered"):
        assert plans[label].count("hashpartitioning(h#") == 1
    assert "hashpartitioning(node#" not in plans["ordered"].split("MapInArrow")[-1]  # hashes aren't sent to find their node
