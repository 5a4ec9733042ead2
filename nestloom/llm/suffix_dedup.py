"""Substring deduplication with an enhanced suffix array and its common-prefix intervals (operator 9).

A byte goes if it lies in a string of ``span`` bytes that also starts earlier, in a smaller document or
before in the same one. Every such string chooses one of its ``GRAM``-byte grams, the one with the smallest
hash (the leftmost of equals), so equal strings meet at equal grams. Steps:

1. Anchors. A task hashes whole texts with numpy and emits one row for each run of strings with the same
   gram: its hash, a digest of the context (all bytes of these strings), and where it is. Rows, not texts,
   are shuffled by gram; grams that occur once end here. Of equal contexts, all but the earliest are covered.
2. Edges. Where contexts of a gram differ, the earliest of each distinct context is compared in full. A task
   sorts the suffixes that begin at the grams of its bucket, finds the lengths of common prefixes and scans
   them with a stack for the intervals: the groups of suffixes with a common prefix. In each group the bytes
   to the left are tested: while all agree, the repeat extends to the left as one group; where they differ, it
   splits into the intervals of the sorted left contexts. So every maximal repeat comes out with all of its
   occurrences, and each but the earliest is covered.
3. Covered stretches are gathered per document, merged and cut out.

Hot grams are dealt over slices. In step 1 the slices' earliest contexts meet by (gram, context). In step 2
a slice also emits each string that is the earliest in its slice, and equal strings meet by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from nestloom.llm.common import materialize, partitions

GRAM = 20  # bytes of a gram
SLICE = 20_000  # distinct contexts of a gram that one task compares
_BUCKET = 10_000  # contexts that a task should get
_BLOCK = 1 << 20  # string starts that are hashed together
_LAST = 2**63 - 1  # stands for a null id: after all others

_BYTES = np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64)  # any fixed table does
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Anchors:
    """Runs of strings that choose the same gram, for texts put one after another."""

    def __init__(self, span: int):
        self.span = span
        self._size(1 << 12)

    def _size(self, n: int) -> None:
        for name, base in (("_up", _BASE), ("_down", pow(_BASE, -1, 2**64))):
            factors = np.full(n, np.uint64(base))
            factors[0] = 1
            setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def of(self, data: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gram hash, context digest, gram place, first and last string start, for each run.

        ``text_of`` numbers the text of every byte; strings that reach into another text don't count.
        """
        n, span = len(data), self.span
        starts = n - span + 1
        if starts <= 0:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3
        if n > len(self._up):
            self._size(max(n, min(2 * n, _BLOCK + span)))
        total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTES[data] * self._up[:n], dtype=np.uint64)))
        grams = n - GRAM + 1
        gram = _mix((total[GRAM:] - total[:-GRAM]) * self._down[:grams])
        # 40 bits of the hash, then the place: the minimum is the smallest hash, and of equals the leftmost
        least = (gram & np.uint64(0xFFFFFFFFFF000000)) | np.arange(grams, dtype=np.uint64)
        width, reach = span - GRAM + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: starts], least[width - reach : width - reach + starts])
        place = (least[:starts] & np.uint64(0xFFFFFF)).astype(np.int64)
        valid = text_of[:starts] == text_of[span - 1 : span - 1 + starts]
        change = np.ones(starts, bool)
        change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1]) | (text_of[1:starts] != text_of[: starts - 1])
        first = np.flatnonzero(change)
        last = np.concatenate((first[1:] - 1, [starts - 1]))
        first, last = first[valid[first]], last[valid[first]]
        at = place[first]
        shape = ((at - first) * 256 + (at - last)).astype(np.uint64) + np.uint64(1)
        context = _mix((total[last + span] - total[first]) * self._down[first] + shape * np.uint64(_BASE))
        return gram[at], context, at, first, last


def _text_blocks(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of several texts, or of a part of a long one: bytes, text numbers, and the start of each text's part."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if len(text) > _BLOCK:
            for at in range(0, len(text) - span + 1, _BLOCK):
                part = np.frombuffer(text, np.uint8)[at : at + _BLOCK + span - 1]
                yield part, np.zeros(len(part), np.int32), np.array([i]), np.array([-at])
            continue
        if size + len(text) > _BLOCK and group:
            yield _joined(texts, group)
            group, size = [], 0
        if len(text) >= span:
            group.append(i)
            size += len(text)
    if group:
        yield _joined(texts, group)


def _joined(texts: list[bytes], group: list[int]):
    lengths = np.array([len(texts[i]) for i in group])
    data = np.frombuffer(b"".join([texts[i] for i in group]), np.uint8)
    return data, np.repeat(np.arange(len(group), dtype=np.int32), lengths), np.array(group), np.cumsum(lengths) - lengths


def anchor_rows(rows: DataFrame, span: int) -> DataFrame:
    """``h``, ``ctx``, ``id``, ``tie``, ``pack`` (gram place, and its distance from the first and last string)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(span)
        for batch in batches:
            ids, ties = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            for data, text_of, which, begin in _text_blocks(texts, span):
                gram, context, at, first, last = anchors.of(data, text_of)
                part = text_of[at]
                pack = ((at - begin[part]) << 16) | ((at - first) << 8) | (at - last)
                columns = (gram.view(np.int64), context.view(np.int64), ids[which[part]], ties[which[part]], pack)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "ctx", "id", "tie", "pack"])

    return rows.mapInArrow(find, "h bigint, ctx bigint, id bigint, tie bigint, pack bigint")


def _intervals(common: np.ndarray, floor: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, end, depth, depth of the enclosing interval), by a stack scan over common-prefix lengths.

    ``common[i]`` is shared by the sorted strings i - 1 and i; intervals not deeper than ``floor`` are left out.
    """
    stack: list[tuple[int, int]] = []  # depth, first
    for i, depth in enumerate([*common[1:].tolist(), -1], 1):
        first = i - 1
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            outer = max(depth, stack[-1][0] if stack else -1, floor)
            yield first, i, deep, outer
        if depth > floor and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def _sorted_prefixes(strings: np.ndarray, lengths: np.ndarray, major: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows (within equal ``major``) and what each shares with the row before it."""
    padded = np.zeros((len(strings), -(-strings.shape[1] // 8) * 8), np.uint8)
    padded[:, : strings.shape[1]] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], major))
    s, n, m = strings[order], lengths[order], major[order]
    common = np.zeros(len(s), np.int64)
    if len(s) > 1:
        differ = s[1:] != s[:-1]
        shared = np.where(differ.any(1), differ.argmax(1), s.shape[1])
        common[1:] = np.where(m[1:] == m[:-1], np.minimum(shared, np.minimum(n[1:], n[:-1])), -1)
    return order, common


class Bucket:
    """Contexts around grams: suffixes from the gram on, bytes before it, and how far strings start before it."""

    def __init__(self, group: pd.DataFrame, span: int):
        self.span = span
        self.gram = group["h"].to_numpy()
        self.far, self.near = group["far"].to_numpy(), group["near"].to_numpy()  # first and last string's distance
        self.rank = np.empty(len(group), np.int64)
        self.rank[np.lexsort((group["at"], group["tie"], group["id"]))] = np.arange(len(group))
        self.right = np.zeros((len(group), span), np.uint8)
        self.left = np.zeros((len(group), span - GRAM), np.uint8)  # nearest byte first
        for i, (context, far) in enumerate(zip(group["context"], self.far.tolist(), strict=True)):
            c = np.frombuffer(context, np.uint8)
            self.right[i, : len(c) - far] = c[far:]
            self.left[i, :far] = c[:far][::-1]
        self.covered: list[tuple[int, int, int]] = []  # context, nearest and farthest covered start

    def scan(self) -> None:
        order, common = _sorted_prefixes(self.right, self.span - self.near, self.gram)
        for first, end, depth, outer in _intervals(common, self.span - 1 - int(self.far.max(initial=0))):
            # strings that start a bytes before the gram need span - a common bytes from the gram on
            self._group(order[first:end], max(0, self.span - depth), self.span - 1 - max(outer, 0))

    def _group(self, members: np.ndarray, lo: int, hi: int) -> None:
        """Maximal repeats among suffixes with a common prefix, for starts ``lo`` to ``hi`` bytes before the gram."""
        lo, hi = max(lo, int(self.near[members].min())), min(hi, int(self.far[members].max()))
        if lo > hi:
            return
        left, far = self.left[members], self.far[members]
        if len(members) == 2:
            differ = np.flatnonzero(left[0] != left[1])
            same = min(int(differ[0]) if len(differ) else left.shape[1], int(far.min()))
            if same >= lo:
                self._repeat(members, lo, min(hi, same))
            return
        order, common = _sorted_prefixes(left, far, np.zeros(len(members), np.int64))
        members = members[order]
        if int(common[1:].min()) >= hi:  # no diversity to the left: one group as far as it goes
            self._repeat(members, lo, hi)
            return
        if lo == 0:
            self._repeat(members, 0, 0)
        for first, end, depth, outer in _intervals(common, max(lo - 1, 0)):
            self._repeat(members[first:end], max(lo, outer + 1), min(hi, depth))

    def _repeat(self, members: np.ndarray, lo: int, hi: int) -> None:
        """All but the earliest of ``members`` are covered, for starts that belong to them."""
        if lo > hi:
            return
        near, far = self.near[members], self.far[members]
        cuts = {lo, *(int(x) for x in near if lo < x <= hi), *(int(x) + 1 for x in far if lo <= x < hi)}
        cuts = sorted(cuts)
        for a, b in zip(cuts, [*[c - 1 for c in cuts[1:]], hi], strict=True):
            own = members[(near <= a) & (far >= b)]
            if len(own) > 1:
                first = own[self.rank[own].argmin()]
                self.covered += [(int(i), a, b) for i in own if i != first]


def _edges(span: int):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        # rows repeated with one id bring the same context again
        group = group.drop_duplicates(["h", "id", "tie", "at", "far", "near"], ignore_index=True)
        bucket = Bucket(group, span)
        bucket.scan()
        ids, ties, at = group["id"].to_numpy(), group["tie"].to_numpy(), group["at"].to_numpy()
        if bucket.covered:
            i, near, far = np.array(bucket.covered).T
        else:
            i = near = far = np.empty(0, np.int64)
        found = pd.DataFrame({"id": ids[i], "tie": ties[i], "start": at[i] - far, "stop": at[i] - near + span})
        found["string"] = None
        sliced = group["sliced"].to_numpy()
        if not sliced.any():
            return found
        open_ = {k: np.ones(bucket.far[k] + 1, bool) for k in np.flatnonzero(sliced).tolist()}
        for k, a, b in bucket.covered:
            if k in open_:
                open_[k][a : b + 1] = False
        rows = []
        for k, free in open_.items():
            context = group["context"].iloc[k]
            for a in np.flatnonzero(free[bucket.near[k] :]) + bucket.near[k]:
                begin = int(bucket.far[k] - a)
                rows.append((ids[k], ties[k], at[k] - a, at[k] - a + span, context[begin : begin + span]))
        return pd.concat([found, pd.DataFrame(rows, columns=found.columns)], ignore_index=True)

    return compare


_FOUND = "id bigint, tie bigint, start bigint, stop bigint, string binary"


def covered_stretches(rows: DataFrame, span: int, slice_size: int = SLICE) -> DataFrame:
    """``id``, ``tie``, ``start``, ``stop`` of covered stretches of ``rows(id, tie, text)``; they may overlap."""
    spark, parts = rows.sparkSession, partitions(rows.sparkSession)
    total = rows.count()
    sampled = min(total, 20 * parts)
    often = anchor_rows(rows.sample(min(1.0, sampled / max(total, 1)), 3), span).groupBy("h").count()
    unit = max(8, 10 * sampled // parts)  # sampled rows that fill about an eighth of a partition
    hot = materialize(often.where(F.col("count") > 2 * unit).select("h", F.ceil(F.col("count") / unit).cast("int").alias("slices")), "hot")

    anchors = anchor_rows(rows, span).join(F.broadcast(hot), "h", "left")
    anchors = anchors.withColumn("slice", F.coalesce(F.pmod(F.xxhash64("id", "tie"), F.col("slices")), F.lit(0)).cast("int"))
    gram, context = Window.partitionBy("h", "slice"), Window.partitionBy("h", "slice", "ctx").orderBy("id", "tie", "pack")
    whole = context.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = anchors.repartition("h", "slice").select(
        "*",
        F.row_number().over(context).alias("nth"),
        F.min(F.struct("id", "tie", "pack")).over(whole).alias("first"),
        F.min("ctx").over(gram).alias("lo"),
        F.max("ctx").over(gram).alias("hi"),
        F.count(F.lit(1)).over(gram).alias("n"),
    )
    here = F.struct("id", "tie", "pack")
    seen = seen.where("n > 1 OR slices IS NOT NULL").select(
        "h", "ctx", "id", "tie", "pack", (F.col("nth") == 1).alias("leads"), (here != F.col("first")).alias("later"),
        (F.col("slices").isNotNull()).alias("hot"), (F.col("slices").isNotNull() | (F.col("lo") != F.col("hi"))).alias("mixed"),
    )
    seen = materialize(seen, "anchors")

    # hot grams: the slices' earliest contexts meet
    met = seen.where("hot AND leads").withColumn("first", F.min(here).over(Window.partitionBy("h", "ctx")))
    later = met.where(here != F.col("first")).select("id", "tie", "pack")
    reps = seen.where("NOT hot AND leads AND mixed").select("h", "id", "tie", "pack")
    reps = materialize(reps.union(met.where(here == F.col("first")).select("h", "id", "tie", "pack")), "contexts")
    place, far, near = F.shiftright("pack", 16), F.shiftright("pack", 8).bitwiseAND(255), F.col("pack").bitwiseAND(255)
    equal = seen.where("later").select("id", "tie", "pack").union(later)
    equal = equal.select("id", "tie", (place - far).alias("start"), (place - near + span).alias("stop"))

    counts = reps.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = reps.join(counts, "h")
    slices = F.ceil(F.col("n") / slice_size).cast("int")
    edges = edges.select(
        "id", "tie", F.struct("h", place.cast("bigint").alias("at"), far.cast("int").alias("far"), near.cast("int").alias("near"),
                              (slices > 1).alias("sliced"), F.pmod(F.xxhash64("id", "tie"), slices).alias("slice")).alias("edge"),
    )
    per_text = edges.groupBy("id", "tie").agg(F.collect_list("edge").alias("edges"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "slice", "id", "tie", "at", "far", "near", "sliced", "context"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        for batch in batches:
            ids, ties, texts = (batch.column(k).to_pylist() for k in range(3))
            for doc, tie, text, found in zip(ids, ties, texts, batch.column(3), strict=True):
                out = [
                    (e["h"], e["slice"], doc, tie, e["at"], e["far"], e["near"], e["sliced"], text[e["at"] - e["far"] : e["at"] - e["near"] + span])
                    for e in found.as_py()
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    cut = rows.select("id", "tie", F.col("text").cast("binary").alias("text"))
    texts = cut.join(per_text, ["id", "tie"]).select("id", "tie", "text", "edges")
    found = texts.mapInArrow(contexts, "h bigint, slice bigint, id bigint, tie bigint, at bigint, far int, near int, sliced boolean, context binary")
    buckets = max(1, -(-counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // _BUCKET))
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("h", "slice"), F.lit(buckets)).cast("int"))
    compared = dealt.groupBy("bucket").applyInPandas(_edges(span), _FOUND)
    compared = materialize(compared, "edges")
    strings = compared.where("string IS NOT NULL").withColumn("first", F.min(F.struct("id", "tie", "start")).over(Window.partitionBy("string")))
    strings = strings.where(F.struct("id", "tie", "start") != F.col("first"))
    columns = ["id", "tie", "start", "stop"]
    return equal.union(compared.where("string IS NULL").select(columns)).union(strings.select(columns))


def remove_repeats(docs: DataFrame, span: int = 100, id_col: str = "doc_id", text_col: str = "text", slice_size: int = SLICE) -> DataFrame:
    """Id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (removed stretches) per row.

    Strings are judged on the input, and never cross documents. Null text counts as empty. Rows without id
    come after all others, ordered by a hash of the text; rows repeated with one id and text are one
    document and get equal results. Several different texts under one id are not told apart in the order.
    An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_doc"), text.alias("text"))
    # without an id, the text itself tells documents apart
    tie = F.when(F.col("_doc").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint"))
    rows = rows.select("_doc", F.coalesce("_doc", F.lit(_LAST)).alias("id"), tie.alias("tie"), "text")
    stretches = covered_stretches(rows.drop("_doc"), span, slice_size)
    per_text = stretches.groupBy("id", "tie").agg(F.collect_set(F.struct("start", "stop")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
        for batch in batches:
            out = []
            for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans: list[dict] = []
                for s in sorted(found or [], key=lambda f: f["start"]):
                    if spans and s["start"] <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(spans[-1]["stop"], s["stop"])
                    else:
                        spans.append(dict(s))
                kept, at = hashlib.sha256(), 0
                for s in spans:
                    kept.update(data[at : s["start"]])
                    at = s["stop"]
                kept.update(data[at:])
                out.append((len(data), sum(s["stop"] - s["start"] for s in spans), len(spans), kept.hexdigest(), spans))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            )

    joined = rows.join(per_text, ["id", "tie"], "left").select("_doc", F.col("text").cast("binary").alias("text"), "found")
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>"
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_col)
