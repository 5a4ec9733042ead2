"""Best-fit packing by hierarchical residual packing (operator 10).

Tokens: every text is tokenised whole in Arrow batches; only lengths and checksums leave the tasks.
Packing: a document longer than a sequence is cut into full pieces, which are sequences of their own, and
one shorter first piece. The short pieces go to partitions of bounded size, each packed best-fit by
decreasing length. Nearly full bins are final; underfull bins become the items of the next round, in fewer
partitions, until one partition is left or a round no longer saves bins. Only (id, length) pairs move.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nestloom.llm.common import materialize, released

_CACHE_WORDS = 300_000  # words whose ids a task remembers; a full cache is emptied, which costs time only
_NEARLY_FULL = 4  # a bin with so few free tokens is final
_END_TEXT, _END_TEXT_ID = "<|endoftext|>", 50256  # fixed values: the vocabulary's one special token


class WordTokenizer:
    """Ids of whole texts by a byte-level BPE vocabulary, remembering the ids of words.

    The vocabulary's pre-tokenizer never joins characters across a single space between two other
    characters that are no white space, except that the space leads its word. So a text without any other
    white space next to a space can be cut before its spaces; any other text is encoded in one piece. The
    special token's string stands for its id, as in the vocabulary's own tokenizer.
    """

    def __init__(self, ranks_path: str):
        import re

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._odd_space = re.compile(r"\s | \s|^ | $").search
        self._words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        return self._words.get(word) or self._learn(word)

    def _learn(self, word: str) -> bytes:
        if len(self._words) >= _CACHE_WORDS:
            self._words.clear()
        found = np.asarray(self._encode(word), dtype="<u4").tobytes()
        if len(word) < 64:
            self._words[word] = found
        return found

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if _END_TEXT in text:
            end = np.uint32(_END_TEXT_ID).astype("<u4").tobytes()
            return end.join(self.ids(part) for part in text.split(_END_TEXT))
        if not text:
            return b""
        if self._odd_space(text):
            return np.asarray(self._encode(text), dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        known = self._words.get
        learn = self._learn
        return b"".join([self._word(first), *[known(w) or learn(w) for w in [" " + w for w in rest]]])


def token_pieces(docs: DataFrame, ranks_path: str | None = None, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``size`` tokens: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its ids and then id 0. Only a longer document is cut; then its first piece takes what
    is left over by the full ones. A null text counts as empty and gives one piece of one token.
    """

    def pieces(batches):
        import public_tokenizers

        tokenizer = WordTokenizer(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                key, ids = key.as_py(), tokenizer.ids(text.as_py() or "") + b"\0\0\0\0"
                count = len(ids) // 4
                start, piece, length = 0, 0, count if count <= size else count % size or size
                while start < count:
                    out.append((key, piece, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
                    start, piece, length = start + length, piece + 1, size
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    found = rows.mapInArrow(released(pieces), "_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    return found.withColumnRenamed("_id", id_col)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit by decreasing size: bin and offset of every item, fill of every bin.

    Open bins are kept by their free room, and a bit set tells which rooms occur, so that the tightest
    bin for an item is found in constant time. Ties take the item that comes first.
    """
    bins, offsets, fills = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fitting = rooms >> s
        if fitting:
            room = s + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += s
        if room > s:
            by_room[room - s].append(b)
            rooms |= 1 << (room - s)
    return bins, offsets, np.asarray(fills, np.int64)


def _packed(items: DataFrame, capacity: int, parts: int, level: int) -> DataFrame:
    """Bin and offset for (key, size) items, packed in ``parts`` groups; bins are named by level and group."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "key"], ascending=[False, True], kind="stable")
        bins, offsets, fills = best_fit(group["size"].to_numpy(), capacity)
        name = (level << 58) | (int(group["part"].iloc[0]) << 32)
        return pd.DataFrame({"key": group["key"].to_numpy(), "bin": name + bins, "at": offsets, "fill": fills[bins]})

    dealt = items.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInPandas(pack, "key bigint, bin bigint, at bigint, fill bigint")


def pack(pieces: DataFrame, capacity: int = 2048, per_task: int = 250_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: gapless from 0, at most ``capacity`` tokens each.

    Needs a column ``length`` between 1 and ``capacity``; all other columns are kept. ``per_task`` bounds
    the items one task packs. Equal lengths are taken in input order; repeated rows are separate items.
    """
    pieces = materialize(pieces.withColumn("_key", F.monotonically_increasing_id()), "pieces")
    items = pieces.where(F.col("length") < capacity).select(F.col("_key").alias("key"), F.col("length").alias("size"))
    count, placed, level = items.count(), None, 1
    while count:
        parts = -(-count // per_task)
        step = materialize(_packed(items, capacity, parts, level), "bins")
        if placed is None:
            placed = step.select(F.col("key").alias("_key"), "bin", "at")
        else:
            up = step.select(F.col("key").alias("bin"), F.col("bin").alias("_up"), F.col("at").alias("_more"))
            placed = placed.join(up, "bin", "left").select(
                "_key", F.coalesce("_up", "bin").alias("bin"), (F.col("at") + F.coalesce("_more", F.lit(0))).alias("at")
            )
        underfull = step.where(F.col("fill") < capacity - _NEARLY_FULL).groupBy("bin").agg(F.max("fill").alias("size"))
        items, level = underfull.select(F.col("bin").alias("key"), "size"), level + 1
        left = items.count()
        # a lone partition has packed best already; rounds that save next to nothing end as well
        if parts == 1 or left > 0.98 * count:
            break
        count = left
    full = F.lit(1 << 62) + F.col("_key")
    if placed is None:
        return pieces.withColumn("sequence_id", full).withColumn("offset", F.lit(0).cast("bigint")).drop("_key")
    return (
        pieces.join(placed, "_key", "left")
        .withColumn("sequence_id", F.coalesce("bin", full))
        .withColumn("offset", F.coalesce("at", F.lit(0).cast("bigint")))
        .drop("_key", "bin", "at")
    )
