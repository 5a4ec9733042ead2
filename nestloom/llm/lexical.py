"""Ranked lexical search by per-term geometric blocking (operator 11).

Documents and items are bags of terms; a document's score for an item is the sum of integer term impacts
(``SCALE`` and the constants below define them exactly). Steps:

1. The items are taken in blocks of bounded size; their terms are numbered. Every document is read as a
   sparse vector over these terms, with its length.
2. Documents are laid out by a signature of random hyperplanes, so that similar ones lie together, and are
   dealt by range of signature and hash of the id: thousands of equal documents are split too.
3. A task reads its documents in segments. In a segment each term's posting list is clustered by document
   similarity around centres taken from the list, and every cluster (block) is stored with the largest
   impact of each term over its documents. Only terms that some item holds together with the list's term
   are kept in its summaries: no item can ask for others.
4. An item visits the lists of its terms, the weightiest first. The product of item and summary bounds the
   score of all documents of a block; a block is skipped only if its bound is below the score that the
   item's last kept document has. All others are scored exactly, each document once.
5. An item's best of every task are merged. Scores that a hash sample of the documents reaches are lower
   bounds for all of them, so the tasks start from these.

Summaries live as long as the segment: they are larger than the texts, so they are not written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from nestloom.llm.common import materialize, partitions

SCALE = 1_000_000_000
QUERY_BYTES = 8 << 20  # texts of the items of one block
SEGMENT = 2048  # documents of a segment
BLOCK = 24  # documents of a posting list for each centre
COLUMNS = 4096  # distinct terms of the items that a segment is searched for at once
PLANES = 16
SAMPLE = 32  # one of so many documents gives the first bounds
NO_ID = 2**63 - 1

# every byte that is no part of a term becomes a space, A-Z becomes a-z; all bytes of other characters are kept
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[dict[int | None, set[bytes]]]:
    """Distinct terms per item, in blocks of bounded size. Texts under one id count together."""
    rows = items.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).orderBy("id")
    block: dict[int | None, set[bytes]] = {}
    size = 0
    for row in rows.toLocalIterator():
        if size >= QUERY_BYTES and row["id"] not in block:
            yield block
            block, size = {}, 0
        block.setdefault(row["id"], set()).update(terms(row["text"]))
        size += len(row["text"] or "")
    if block:
        yield block


def vectors(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` (terms with repeats), numbers of the wanted terms that occur and how often."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, lengths, found, counts = [], [0], [], []
                for text in part.column(1):
                    words = terms(text.as_py())
                    bag: dict[int, int] = {}
                    for w in words:
                        k = number.get(w)
                        if k is not None:
                            bag[k] = bag.get(k, 0) + 1
                    sizes.append(len(words))
                    found.extend(bag)
                    counts.extend(bag.values())
                    lengths.append(len(found))
                where = pa.array(lengths, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(where, pa.array(found, pa.int32())), pa.ListArray.from_arrays(where, pa.array(counts, pa.int32()))],
                    ["id", "n", "terms", "tf"],
                )

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(read, "id bigint, n bigint, terms array<int>, tf array<int>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of a term before its weight, in whole numbers."""
    m = 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)
    return (SCALE * tf) // (1000 * tf + 20 * m)


@dataclass
class Items:
    """Items of one block: ids, numbers of their terms with a weight above 0, and the weights of all terms."""

    ids: list[int | None]
    terms: list[np.ndarray]
    weights: np.ndarray
    n_docs: int
    n_terms: int

    def groups(self, columns: int = COLUMNS) -> Iterator[list[int]]:
        """Items in runs whose terms together are at most ``columns`` (or one item)."""
        run, seen = [], set()
        for i, t in enumerate(self.terms):
            more = seen | set(t.tolist())
            if run and len(more) > columns:
                yield run
                run, more = [], set(t.tolist())
            run, seen = [*run, i], more
        if run:
            yield run


class Best:
    """The ``k`` best documents of one item so far: highest score first, then smallest id."""

    def __init__(self, k: int, floor: int = 1):
        self.k, self.floor = k, max(1, floor)
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.floor
        if not keep.any():
            return
        score, ids = np.concatenate((self.score, score[keep])), np.concatenate((self.id, ids[keep]))
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))  # an equal score may still win by its id


class Segment:
    """Posting lists of some documents, clustered into blocks with summaries, for one group of items."""

    def __init__(self, impact: np.ndarray, together: list[np.ndarray], block: int = BLOCK):
        """``impact``: documents by terms, whole numbers; ``together[t]``: terms that items hold beside ``t``."""
        self.impact, self.together = impact, together
        scaled = impact.astype(np.float32)
        scaled /= np.maximum(np.sqrt(np.einsum("ij,ij->i", scaled, scaled)), 1)[:, None]
        likeness = scaled @ scaled.T
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for t in range(impact.shape[1]):
            docs = np.flatnonzero(impact[:, t])
            if not len(docs):
                self.blocks.append((docs, np.zeros(1, np.int64), np.zeros((0, len(together[t])), np.int32)))
                continue
            count = -(-len(docs) // block)
            centres = docs[(np.arange(count) * len(docs)) // count]
            nearest = likeness[np.ix_(docs, centres)].argmax(1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            starts = np.flatnonzero(np.concatenate(([True], nearest[1:] != nearest[:-1])))
            summary = np.maximum.reduceat(impact[np.ix_(docs, together[t])], starts, axis=0)
            self.blocks.append((docs, np.concatenate((starts, [len(docs)])), summary))

    def search(self, wanted: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: Best) -> int:
        """Add the documents that can be among the best; ``wanted``: columns of the item. Returns how many were scored."""
        fresh, scored = np.ones(len(self.impact), bool), 0
        for k in np.argsort(-weights, kind="stable"):
            docs, bounds, summary = self.blocks[wanted[k]]
            if not len(docs):
                continue
            place = np.searchsorted(self.together[wanted[k]], wanted)
            reach = summary[:, place].astype(np.float64) @ weights
            open_ = np.repeat(reach >= best.floor, np.diff(bounds))
            chosen = docs[open_ & fresh[docs]]
            if len(chosen):
                fresh[chosen] = False
                scored += len(chosen)
                best.add((self.impact[np.ix_(chosen, wanted)].astype(np.float64) @ weights).astype(np.int64), ids[chosen])
        return scored


def _signed(items: Items):
    """Signature of each document: on which side of random planes its weighted vector lies."""
    planes = np.random.default_rng(11).standard_normal((len(items.weights), PLANES)) * items.weights[:, None]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("terms")
            flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.value_lengths())
            total = np.zeros((batch.num_rows, PLANES))
            for p in range(PLANES):
                total[:, p] = np.bincount(np.repeat(np.arange(batch.num_rows), lengths), planes[flat, p], batch.num_rows) if len(flat) else 0
            sig = (total > 0) @ (1 << np.arange(PLANES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sig.astype(np.int32))], [*batch.schema.names, "sig"])

    return read


def _searched(items: Items, k: int, floors: np.ndarray):
    groups = list(items.groups())
    prepared = []
    for run in groups:
        columns = np.unique(np.concatenate([items.terms[i] for i in run])) if run else np.empty(0, np.int64)
        wanted = [np.searchsorted(columns, items.terms[i]) for i in run]
        beside: list[set[int]] = [set() for _ in columns]
        for w in wanted:
            for t in w.tolist():
                beside[t].update(w.tolist())
        prepared.append((columns, wanted, [np.array(sorted(b), np.int64) for b in beside]))

    def part(batch: pa.RecordBatch, best: list[Best]) -> None:
        ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        n = batch.column("n").to_numpy(zero_copy_only=False)
        lists = batch.column("terms")
        lengths = np.asarray(lists.value_lengths())
        row = np.repeat(np.arange(batch.num_rows), lengths)
        term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = batch.column("tf").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        value = impacts(tf, n[row], items.n_docs, items.n_terms)
        for run, (columns, wanted, beside) in zip(groups, prepared, strict=True):
            place = np.minimum(np.searchsorted(columns, term), max(len(columns) - 1, 0))
            held = columns[place] == term if len(columns) else np.zeros(len(term), bool)
            impact = np.zeros((batch.num_rows, len(columns)), np.int32)
            impact[row[held], place[held]] = value[held]
            segment = Segment(impact, beside)
            for i, w in zip(run, wanted, strict=True):
                segment.search(w, items.weights[columns[w]].astype(np.float64), ids, best[i])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, int(f)) for f in floors]
        for batch in batches:
            for at in range(0, batch.num_rows, SEGMENT):
                part(batch.slice(at, SEGMENT), best)
        item = np.repeat(np.arange(len(best)), [len(b.id) for b in best])
        ids = np.concatenate([b.id for b in best]) if best else np.empty(0, np.int64)
        score = np.concatenate([b.score for b in best]) if best else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids, mask=ids == NO_ID), pa.array(score)], ["item", "id", "score"])

    return read


_FOUND = "item int, id bigint, score bigint"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item with a score above 0.

    Null, empty and term-free texts of documents count nowhere and are never found; items without terms, or
    whose terms no document holds, find nothing. Texts are read whole. Every row is a document of its own: rows repeated with
    one id are ranked each. Equal scores go by ascending id, null ids last. Items repeated with one id count
    as one item with the terms of all their texts; an item with a null id is one too. Empty tables: no rows.
    """
    spark = docs.sparkSession
    results = []
    for block in item_blocks(items, item_col, item_text_col):
        number = {w: i for i, w in enumerate(sorted(set().union(*block.values())))}
        read = materialize(vectors(docs, number, id_col, text_col).where("n > 0"), "vectors")
        n_docs, n_terms = read.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(number), np.int64)
        # one row per term of the block, which is bounded
        for r in read.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[r["t"]] = term_weight(n_docs, r["count"])
        numbers = [np.array(sorted(number[w] for w in words if weights[number[w]] > 0), np.int64) for words in block.values()]
        stated = Items(list(block), numbers, weights, n_docs, n_terms)
        held = read.where("size(terms) > 0").mapInArrow(_signed(stated), "id bigint, n bigint, terms array<int>, tf array<int>, sig int")

        floors = np.zeros(len(block), np.int64)
        some = held.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(SAMPLE)) == 0).drop("sig")
        for r in _ranked(some.mapInArrow(_searched(stated, k, floors), _FOUND), k).where(F.col("rank") == k).collect():
            floors[r["item"]] = r["score"]
        laid = held.repartitionByRange(partitions(spark), "sig", F.xxhash64("id", "n")).sortWithinPartitions("sig").drop("sig")
        names = spark.createDataFrame(list(enumerate(stated.ids)), "item int, item_id bigint")
        found = _ranked(laid.mapInArrow(_searched(stated, k, floors), _FOUND), k)
        results.append(found.join(names, "item").select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    if not results:
        return spark.createDataFrame([], f"`{item_col}` bigint, rank int, `{id_col}` bigint, score bigint")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
