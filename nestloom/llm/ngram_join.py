"""N-gram Jaccard self-join by prefix trees (operator 1).

A document is the set of its word shingles. Two link when ``100 * |x & y| >= percent * |x | y|``; then each
misses at most ``n - ceil(percent * n / 100)`` shingles of the other. Steps, each of them exact:

1. Equal sets are collapsed to their smallest id (two 64-bit digests of the whole set).
2. Hash-order filter. Every set sends only its smallest hashes, a few more than it may miss, so that partners
   have a good number of them in common. Documents with fewer shared ones cannot link and are left out.
3. The others are ordered by rarity. Shingles found in one document only come first; a document with too many
   of them cannot link. What remains of the allowed misses is its prefix, and partners share a prefix token.
4. Documents with a common prefix token form a bucket. Tokens with the same documents give one bucket.
   In a task, the bucket's sets are stored in a trie, most frequent shingles on top; a walk for one set adds up
   the overlap on shared paths once and leaves a subtree when even the remaining lengths cannot suffice.
5. Large buckets are cut into blocks. First every document visits one block of its largest bucket, which links
   most of a family of near copies. Buckets whose documents are connected by then are done. In the others,
   documents of the bucket's largest component stay in one block each; those outside it visit every block and
   are compared among each other, so a family of copies and a few strangers cost rows in proportion.

All of this works on sets, not ids: a node is the digest of a set. Ids come back at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from nestloom.llm.common import materialize, released
from nestloom.llm.components import components
from nestloom.llm.shingles import ShingleHasher

BLOCK = 3000  # sets of a bucket that one task compares, at most; more are cut into blocks
BLOCK_TOKENS = 6_000_000  # tokens of the sets of a block, about; larger sets mean fewer of them


def _least(percent: int, n: str = "n") -> str:
    """SQL: shingles that a set of ``n`` shares with any partner at least."""
    return f"(({percent} * {n} + 99) div 100)"


def _extra(n):
    """Further hashes that partners have in common when both send so many more."""
    return 1 + n // 40


def shingle_sets(docs: DataFrame, width: int, id_col: str, text_col: str, percent: int | None) -> DataFrame:
    """``id``, ``n``, set digest ``sig``, its first half as ``node``, and ``hashes``: all, or the smallest for ``percent``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        for batch in batches:
            sizes, sigs, nodes, kept = [], [], [], []
            for hashes in hasher.sets(batch.column(1)):
                n = len(hashes)
                sizes.append(n)
                sigs.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                nodes.append(int.from_bytes(sigs[-1][:8], "little", signed=True))
                kept.append(hashes if percent is None else hashes[: n - -(-percent * n // 100) + _extra(n)])
            lengths = np.cumsum([0, *map(len, kept)])
            flat = np.concatenate(kept).view(np.int64) if kept else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))],
                ["id", "n", "sig", "node", "hashes"],
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(released(hashed), "id bigint, n bigint, sig binary, node bigint, hashes array<bigint>")


def _class_hashes(texts: DataFrame, width: int) -> DataFrame:
    """``node`` and all ``hashes`` of the rows ``(node, text)`` whose set is that node's; several texts may have one id."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher(width)
        for batch in batches:
            nodes, kept = [], []
            for node, hashes in zip(batch.column(0).to_pylist(), hasher.sets(batch.column(1)), strict=True):
                if int.from_bytes(xxhash.xxh3_128_digest(hashes.tobytes())[:8], "little", signed=True) == node:
                    nodes.append(node)
                    kept.append(hashes)
            lengths = np.cumsum([0, *map(len, kept)])
            flat = np.concatenate(kept).view(np.int64) if kept else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists], ["node", "hashes"])

    return texts.mapInArrow(released(hashed), "node bigint, hashes array<bigint>")


class Trie:
    """Prefix tree over token sequences in one global order, kept flat.

    The sequences are sorted; ``common[i]`` is the length of the path that leaf ``i`` shares with the leaf
    before it. The subtree below depth ``d`` at a leaf is the run of leaves with ``common >= d``.
    """

    def __init__(self, sequences: list[np.ndarray]):
        self.order = np.array(sorted(range(len(sequences)), key=lambda i: sequences[i].tolist()), np.int64)
        self.rows = [sequences[i] for i in self.order]
        self.common = np.zeros(len(self.rows), np.int64)
        for i in range(1, len(self.rows)):
            a, b = self.rows[i - 1], self.rows[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.common[i] = differ[0] if len(differ) else m

    def overlaps(self, mark: np.ndarray, size: int, leaves: np.ndarray, need: np.ndarray) -> Iterator[tuple[int, int]]:
        """(leaf, overlap) with the marked set of ``size`` tokens, for those of ``leaves`` that may reach ``need``.

        ``path[d]`` is the overlap of the first ``d`` tokens; the next leaf reuses it as far as both share a
        path. Where even all remaining tokens leave every wanted leaf short, the whole subtree is left.
        """
        if not len(leaves):
            return
        longest, fewest = max(len(self.rows[i]) for i in leaves), int(need.min())
        k, last, path = 0, -1, np.zeros(1, np.int64)
        while k < len(leaves):
            leaf = int(leaves[k])
            row = self.rows[leaf]
            shared = 0 if last < 0 else int(self.common[last + 1 : leaf + 1].min())
            path = np.concatenate((path[: shared + 1], path[shared] + np.cumsum(mark[row[shared:]])))
            k, last = k + 1, leaf
            if path[-1] >= need[k - 1]:
                yield leaf, int(path[-1])
                continue
            bound = path + np.minimum(size - path, longest - np.arange(len(path)))
            if bound[-1] < fewest:
                depth = int(np.argmax(bound < fewest))
                outside = np.flatnonzero(self.common[leaf + 1 :] < depth)
                k = int(np.searchsorted(leaves, leaf + 1 + outside[0])) if len(outside) else len(leaves)


def bucket_links(sets: list[np.ndarray], n: np.ndarray, percent: int, label: np.ndarray, allowed=None) -> list[tuple[int, int]]:
    """Links that connect what is not connected yet; ``sets`` hold the tokens that may be shared, rarest first.

    ``label`` tells the component of each set and is changed; ``allowed(i)`` masks the partners of ``i``.
    """
    size = np.array([len(s) for s in sets])
    _, dense = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate(([0], np.cumsum(size)))
    rows = [dense[a:b][::-1] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]  # most frequent on top
    mark = np.zeros(int(dense.max()) + 1 if len(dense) else 1, np.int64)
    links, trie = [], None
    for i in range(len(sets)):
        need = -(-percent * (n[i] + n) // (100 + percent))
        wanted = (label != label[i]) & (np.minimum(size, size[i]) >= need)
        wanted[: i + 1] = False
        if wanted.any() and allowed is not None:
            wanted &= allowed(i)
        if not wanted.any():
            continue
        trie = trie or Trie(rows)
        leaves = np.flatnonzero(wanted[trie.order])
        mark[rows[i]] = 1
        for leaf, _ in trie.overlaps(mark, int(size[i]), leaves, need[trie.order][leaves]):
            j = int(trie.order[leaf])
            if label[j] != label[i]:
                links.append((i, j))
                label[label == label[j]] = label[i]
        mark[rows[i]] = 0
    return links


def _first_bucket(percent: int):
    def visit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable").drop_duplicates("id")
        ids = group["id"].to_numpy()
        found = bucket_links(list(group["tokens"]), group["n"].to_numpy(), percent, np.arange(len(ids)))
        return pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return visit


class _Partners:
    """Which pairs of a bucket have to be compared there, judged without their tokens."""

    def __init__(self, group: pd.DataFrame, percent: int):
        self.percent = percent
        self.bucket, one, two = (int(group[c].iloc[0]) for c in ("bucket", "one", "two"))
        self.apart = group["block"].to_numpy() if one != two else None
        self.n, self.size, self.place = (group[c].to_numpy() for c in ("n", "size", "place"))
        self.keys = [np.asarray(k) for k in group["keys"]]
        self.flat, lengths = np.concatenate(self.keys), np.array([len(k) for k in self.keys])
        self.starts = np.cumsum(lengths) - lengths
        self.within = np.arange(len(self.flat)) - np.repeat(self.starts, lengths)
        self.own = np.array([int(np.flatnonzero(k == self.bucket)[0]) for k in self.keys])
        _, self.label = np.unique(group["component"].to_numpy(), return_inverse=True)

    def of(self, i: int) -> np.ndarray:
        """Partners of ``i`` in other components whose first common token is this bucket's.

        All common tokens then come from there on, which bounds the overlap.
        """
        left = self.size - self.place
        need = -(-self.percent * (self.n[i] + self.n) // (100 + self.percent))
        wanted = (self.label != self.label[i]) & (np.minimum(left, left[i]) >= need)
        if self.apart is not None:
            wanted &= self.apart != self.apart[i]
        if wanted.any():
            first = np.where(np.isin(self.flat, self.keys[i]), self.within, len(self.flat))
            wanted &= np.minimum.reduceat(first, self.starts) == self.own
        return wanted


def _strangers_first(group: pd.DataFrame) -> pd.DataFrame:
    """Rows outside the largest component (blocks from 0 on) first: every pair that counts starts at one of them."""
    group = group.drop_duplicates("id").assign(_within=lambda g: g["block"] < 0)
    return group.sort_values(["_within", "id"], kind="stable").drop(columns="_within").reset_index(drop=True)


def _needed(percent: int):
    """Rows of a bucket that have to be compared with some other one."""

    def visit(group: pd.DataFrame) -> pd.DataFrame:
        group = _strangers_first(group)
        partners, keep = _Partners(group, percent), np.zeros(len(group), bool)
        for i in np.flatnonzero(group["block"] >= 0):
            wanted = partners.of(i)
            keep[i] |= wanted.any()
            keep |= wanted
        return group[keep]

    return visit


def _other_buckets(percent: int):
    def visit(group: pd.DataFrame) -> pd.DataFrame:
        group = _strangers_first(group)
        ids, partners = group["id"].to_numpy(), _Partners(group, percent)
        found = bucket_links(list(group["tokens"]), partners.n, percent, partners.label.copy(), partners.of)
        return pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return visit


_ROW = "id bigint, bucket bigint, component bigint, block int, one int, two int, n bigint, size int, place int, keys array<bigint>"


def tasks(open_: DataFrame) -> DataFrame:
    """Rows of open buckets with the tasks they visit: ``one``, ``two`` and the ``block`` they are in.

    Blocks of a bucket's largest component (``_main``) count -1, -2, ..., those of the others 0, 1, ... A task is a
    pair of blocks, or one block of others; two blocks of the largest component never meet.
    """
    inside, h = F.col("component") == F.col("_main"), F.xxhash64("id")
    rows = open_.withColumn("block", F.when(inside, -1 - F.pmod(h, F.col("_inner"))).otherwise(F.pmod(h, F.col("_outer"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("_outer") - 1)
    met = F.when(inside, others).otherwise(F.concat(others, F.sequence(F.lit(-1), -F.col("_inner"), F.lit(-1))))
    rows = rows.withColumn("_other", F.explode(met))
    return rows.withColumn("one", F.least("block", "_other")).withColumn("two", F.greatest("block", "_other"))


def _links(sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links that connect all that similarity connects; ``sets``: id, n, tokens (rarest first), prefix."""
    entries = sets.select("id", F.posexplode("prefix").alias("place", "t")).select("id", "place", "t.docs", "t.h")
    lists = entries.groupBy("h").agg(
        F.count(F.lit(1)).alias("here"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("same"), F.max("docs").alias("docs")
    )
    # of tokens with the same documents the first in the global order stands for all
    chosen = lists.where("here > 1").groupBy("same", "here").agg(F.min(F.struct("docs", "h")).alias("t")).select(F.col("t.h").alias("h"), "here")
    buckets = entries.join(chosen, "h").withColumnRenamed("h", "bucket")
    full = sets.select("id", "tokens")
    weights = sets.select("id", F.size("tokens").cast("bigint").alias("_size"))
    buckets = materialize(buckets.join(weights, "id"), "buckets")
    heavy = buckets.groupBy("bucket").agg(F.sum("_size").alias("_tokens"), F.max("here").alias("_here"))

    def cut(count: Column, tokens: Column) -> Column:
        """Blocks for so many sets with so many tokens."""
        return F.greatest(F.lit(1), F.ceil(count / block), F.ceil(tokens / BLOCK_TOKENS)).cast("int")

    largest = buckets.groupBy("id").agg(F.max(F.struct("here", "bucket")).alias("m")).select("id", "m.bucket")
    visits = largest.join(heavy, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), cut(F.col("_here"), F.col("_tokens"))))
    visits = visits.select("id", "bucket", "block").join(sets.select("id", "n", "tokens"), "id")
    first = materialize(visits.groupBy("bucket", "block").applyInPandas(_first_bucket(percent), "a bigint, b bigint"), "links")

    known = components(first)
    labelled = buckets.join(known.withColumnRenamed("node", "id"), "id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "id"))
    parts = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("_size").alias("s"))
    most = F.max(F.struct("c", "component", "s"))
    mixed = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), most.alias("m"), F.sum("c").alias("c"), F.sum("s").alias("s")).where("parts > 1")
    mixed = mixed.select(
        "bucket", F.col("m.component").alias("_main"), cut(F.col("m.c"), F.col("m.s")).alias("_inner"), cut(F.col("c") - F.col("m.c"), F.col("s") - F.col("m.s")).alias("_outer")
    )
    open_ = materialize(labelled.join(mixed, "bucket"), "open")
    keys = open_.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("place", "bucket"))).alias("k")).select("id", F.col("k.bucket").alias("keys"))
    facts = keys.join(sets.select("id", "n", F.size("tokens").alias("size")), "id")
    rows = tasks(open_).join(facts, "id").select(*[c.split()[0] for c in _ROW.split(", ")])
    # whole sets travel only to where they have to be compared
    needed = materialize(rows.groupBy("bucket", "one", "two").applyInPandas(_needed(percent), _ROW), "needed")
    rest = needed.join(full, "id").groupBy("bucket", "one", "two").applyInPandas(_other_buckets(percent), "a bigint, b bigint")
    return materialize(first.union(rest), "links")


def jaccard_classes(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` (smallest id reachable by links) of every row.

    Null or empty text, or text without words: an empty set, linked with nothing. Equal sets link. Rows
    repeated with one id count as one document; an id given to several texts links them. A row with a null
    id gets the component of an equal set, or null, and links nothing else. Empty table: no rows.
    """
    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = materialize(shingle_sets(plain, width, "id", "text", percent), "sets")
    same = found.where("n > 0").groupBy("sig", "node").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
    same = materialize(same, "reps").where("rep IS NOT NULL")

    # hash-order filter over one document of every class of equal sets
    sent = found.join(same.select("sig", F.col("rep").alias("id")), ["sig", "id"], "left_semi").select("node", "n", F.explode("hashes").alias("h"))
    holders = F.count(F.lit(1)).over(Window.partitionBy("h"))  # counted where the rows lie: they move once
    shared = sent.withColumn("_docs", holders).where("_docs > 1")
    enough = shared.groupBy("node").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("c"))
    alive = enough.where(f"c >= 1 + {_least(percent)} div 40").select("node")
    alive = materialize(same.join(alive, "node", "left_semi").select("node", F.col("rep").alias("id")), "alive")

    # order by rarity
    # the ids grow with the input, so they are never broadcast: one plan for every size
    texts = plain.join(alive.hint("merge"), "id").select("node", "text")
    tokens = _class_hashes(texts, width).select("node", F.explode("hashes").alias("h"))
    often = tokens.withColumn("docs", holders).where("docs > 1")
    sets = often.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("docs", "h"))).alias("s"))
    sets = sets.join(same.select("node", "n"), "node").where(f"size(s) >= {_least(percent)}")
    sets = sets.select(F.col("node").alias("id"), "n", F.col("s.h").alias("tokens"), F.expr(f"slice(s, 1, int(size(s) - {_least(percent)} + 1))").alias("prefix"))
    links = _links(materialize(sets, "ordered"), percent, block)

    # texts under one id belong together
    held = found.where("n > 0 AND id IS NOT NULL").select("id", "node")
    several = held.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("_most")).where("a < _most").select("id", "a")
    linked = components(links.union(held.join(several, "id").where("node <> a").select("a", F.col("node").alias("b"))))
    members = linked.union(linked.select(F.col("component").alias("node"), "component").distinct())
    least = members.join(same.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("_c"))
    named = members.join(least, "component").select("node", "_c")

    classes = same.join(named, "node", "left").select("sig", F.coalesce("_c", "rep").alias("_c"))
    rows = found.select("id", "n", "sig")
    # sets without shingles are equal but no class
    out = rows.where("n > 0").join(classes, "sig", "left").unionByName(rows.where("n = 0").withColumn("_c", F.lit(None).cast("bigint")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("_c", "id").alias("component_id"))
