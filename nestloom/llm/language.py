"""Language identification by compression (operator 2).

Each language has a raw-content dictionary: training text of that language. A text is reduced to its
letters, lower-cased and cut into chunks, all of them are compressed with every dictionary, and the language
with the smallest total wins. The margin to the runner-up tells how sure that is; ``rejected`` marks texts
whose margin is too narrow.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nestloom.llm.common import materialize, released

_NO_LETTERS = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


def _letters(text: str) -> str:
    return _NO_LETTERS.sub(" ", text.lower()).strip()


def level(sizes: list[int], total: int) -> int:
    """The largest share such that no size gives more than it and all together give at most ``total``."""
    left = total
    for done, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - done)
        if size > share:
            return share
        left -= size
    return total


def spread(letters: str, budget: int, piece_bytes: int = 96) -> str:
    """At most ``budget`` bytes of a text: all of it, or pieces of whole words at even distances from its start to its end.

    A word longer than a piece is cut between code points.
    """
    data = letters.encode()
    if len(data) <= budget:
        return letters
    count = max(1, budget // piece_bytes)
    each, found = budget // count - 1, []
    for at in (i * len(data) // count for i in range(count)):
        piece = data[at : at + each].decode(errors="ignore")
        begin = piece.find(" ") + 1 if at and data[at - 1 : at] != b" " else 0
        end = piece.rfind(" ") if data[at + each : at + each + 1] != b" " else len(piece)
        found.append(piece[begin:end] if end > begin else piece)
    return " ".join(found)


def fit_dictionaries(
    train: DataFrame,
    dictionary_bytes: int = 32_000,
    texts: int = 200,
    languages: int = 256,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    text_col: str = "text",
) -> dict[str, bytes]:
    """Dictionary per language from about ``texts`` sampled texts of each of the ``languages`` most frequent ones.

    The sample is bounded by these parameters, not by the input. A hash of the id chooses its rows (of the text, where
    there is no id), so they do not depend on how the table is split. Dictionaries are filled from pieces spread over the
    whole texts; what a short text leaves of its share goes to the longer ones. Rows without language or text
    are left out; repeated rows count as often as they occur; without any row there is none. The most frequent
    language comes first.
    """
    rows = train.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, texts / n))])
    place = F.when(F.col("id").isNotNull(), F.xxhash64("id", F.lit(11))).otherwise(F.xxhash64("text", F.lit(11)))
    sampled = rows.where(F.pmod(place, F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = [_letters(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(letters, pa.string()), pa.array([len(x.encode()) for x in letters], pa.int64())], ["lang", "letters", "size"]
            )

    reduced = sampled.select("lang", "text").mapInArrow(reduce, "lang string, letters string, size bigint").where("size > 0")
    reduced = materialize(reduced, "training")
    sizes: dict[str, list[int]] = {}
    for row in reduced.select("lang", "size").collect():
        sizes.setdefault(row["lang"], []).append(row["size"] + 1)
    shares = {lang: level(given, dictionary_bytes) for lang, given in sizes.items()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            pieces = [spread(text.as_py(), max(1, shares[lang] - 1)) for lang, text in zip(langs, batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pieces, pa.string())], ["lang", "piece"])

    found: dict[str, list[str]] = {}
    for row in reduced.select("lang", "letters").mapInArrow(cut, "lang string, piece string").collect():
        found.setdefault(row["lang"], []).append(row["piece"])
    return {lang: "\n".join(sorted(found[lang])).encode() for lang in counts if lang in found}


def classify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    narrow: float = 0.01,
    chunk_bytes: int = 4096,
    strength: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, ``lang_pred``, ``score``, ``margin``, ``rejected`` for every row.

    ``margin`` is what the best dictionary saves against the second best, as a share; ``score`` maps it to
    0 to 1. ``und`` with score 0 if the text is null or has no letter, or nothing was learned. Equal sizes:
    the language that comes first in ``dictionaries``. Repeated rows get equal results; further columns of
    ``docs`` are left out, whatever they are called.
    """
    schema = "id bigint, lang_pred string, score double, margin double, rejected boolean"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        languages = list(dictionaries)
        compressors = []
        for lang in languages:
            learned = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            learned.precompute_compress(level=strength)
            compressors.append(zstandard.ZstdCompressor(level=strength, dict_data=learned, write_content_size=False, write_dict_id=False))
        for batch in batches:
            out = []
            for value in batch.column(1):
                text = value.as_py()
                letters = _letters(text) if text and compressors else ""
                if not letters:
                    out.append((UNKNOWN, 0.0, 0.0, True))
                    continue
                data = letters.encode()
                sizes = [sum(len(c.compress(data[i : i + chunk_bytes])) for i in range(0, len(data), chunk_bytes)) for c in compressors]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                others = [s for i, s in enumerate(sizes) if i != best]
                margin = 1 - sizes[best] / min(others) if others else 1.0
                out.append((languages[best], 1 / (1 + math.exp(-60 * (margin - narrow))), margin, margin < narrow))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["id", "lang_pred", "score", "margin", "rejected"]
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(released(predict), schema).withColumnRenamed("id", id_col)
