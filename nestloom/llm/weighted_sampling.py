"""Document fingerprints by consistent weighted sampling (operator 7). DataFrame functions only.

A term's weight is its number of occurrences. For every sample and term, one hash gives the uniform numbers
from which two gamma-distributed values and an offset are made; they depend on nothing but the term. The term
with the smallest value is drawn together with its quantised weight, and two texts draw the same pair with
a probability equal to their generalised Jaccard similarity (sum of smaller over sum of larger weights).

Texts are shuffled once by id, and once more cut to what the preceding document needs of them. All grouping by
term stays inside those partitions, because a text's terms are where its id is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nestloom.llm.common import materialize, partitions

SAMPLES = 64
_AT_ONCE = 4  # samples drawn in one pass over a term; more make code too large for the JVM to compile
_LAST = -(1 << 63)  # where rows without id stand in the order
_STEP = 10_000
_BITS = 28  # bits that tell a drawn (term, weight) pair from others


def terms(text: Column) -> Column:
    """Runs of characters other than space, tab, line feed and carriage return; may hold empty strings."""
    for sign in ("\n", "\t", "\r"):
        text = F.replace(text, F.lit(sign), F.lit(" "))
    return F.split(text, " ")


def signatures(texts: DataFrame, keys: list[str], columns: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and an array of ints ``signature_<column>`` for each text column; null for a text without terms.

    What a sample draws of a term, apart from its weight, is worked out once for all texts of a row, so terms that
    they share cost little more than terms of one. Rows without any terms are left out. Needs no shuffle if the
    rows are already dealt by one of the keys.
    """
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("text")) for i, c in enumerate(columns)])
    words = texts.select(*keys, F.explode(sides).alias("v")).select(*keys, "v.side", F.explode(terms(F.col("v.text"))).alias("word")).where("word <> ''")
    counts = [F.count_if(F.col("side") == i).alias(f"w{i}") for i in range(len(columns))]
    weights = words.groupBy(*keys, F.xxhash64("word").alias("term")).agg(*counts)
    # the logarithm of 0 is null, and so is all that comes of it: such a term is not drawn
    logs = [f"log{i}" for i in range(len(columns))]
    rows = weights.select(*keys, "term", *[F.log(f"w{i}").alias(c) for i, c in enumerate(logs)])
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(samples - 1), F.lit(_AT_ONCE))))
    at_once = range(_AT_ONCE)

    def uniform(k: int, skip: int, bits: int) -> Column:
        return (F.shiftrightunsigned(f"h{k}", skip).bitwiseAND(F.lit((1 << bits) - 1)) + 0.5) / float(1 << bits)

    rows = rows.select(*keys, "block", *logs, *[F.xxhash64("term", F.col("block") + k).alias(f"h{k}") for k in at_once])
    made = []
    for k in at_once:
        r = -F.log(uniform(k, 50, 14) * uniform(k, 37, 13))  # gamma(2, 1)
        c = -F.log(uniform(k, 23, 14) * uniform(k, 10, 13))  # gamma(2, 1)
        made += [F.col(f"h{k}"), r.alias(f"r{k}"), F.log(c).alias(f"c{k}"), uniform(k, 0, 10).alias(f"b{k}")]
    rows = rows.select(*keys, "block", *logs, *made)
    steps = [F.floor(F.col(c) / F.col(f"r{k}") + F.col(f"b{k}")).alias(f"t{k}_{i}") for k in at_once for i, c in enumerate(logs)]
    rows = rows.select(*keys, "block", *[f"{x}{k}" for k in at_once for x in "hrcb"], *steps)

    def draw(k: int, i: int) -> Column:
        """Rank of a term in one sample above, the drawn pair below: the least one is the draw."""
        t = F.col(f"t{k}_{i}")
        rank = F.col(f"c{k}") - F.col(f"r{k}") * (t - F.col(f"b{k}") + 1)
        pair = F.col(f"h{k}").bitwiseXOR(t).bitwiseAND(F.lit((1 << _BITS) - 1))
        return F.shiftleft(F.floor((rank + 128) * float(1 << 24)), _BITS).bitwiseOR(pair)

    drawn = rows.groupBy(*keys, "block").agg(*[F.min(draw(k, i)).alias(f"s{k}_{i}") for k in at_once for i in range(len(columns))])
    drop = F.lit((1 << _BITS) - 1)
    pairs = [F.array(*[F.col(f"s{k}_{i}").bitwiseAND(drop).cast("int") for k in at_once]).alias(f"p{i}") for i in range(len(columns))]
    whole = drawn.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block", *pairs))).alias("all"))
    found = []
    for i, c in enumerate(columns):
        signature = F.slice(F.flatten(F.col(f"all.p{i}")), 1, samples)
        found.append(F.when(signature[0].isNotNull(), signature).alias(f"signature_{c}"))
    return whole.select(*keys, *found)


def likeness(one: Column, other: Column) -> Column:
    """Share of equal draws: the estimate of the generalised Jaccard similarity."""
    equal = F.zip_with(one, other, lambda a, b: (a == b).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda s, e: s + e) / F.size(one)


def fingerprint(signature: Column) -> Column:
    """Signature as text, seven hexadecimal digits for each draw."""
    return F.array_join(F.transform(signature, lambda v: F.lower(F.lpad(F.hex(v), 7, "0"))), "")


def neighbours(ids: DataFrame, parts: int) -> DataFrame:
    """``id``, ``h``, ``copies``, ``next`` in descending order (the first follows the last), ``prev`` with its ``n``, for rows with ``n``.

    Rows are dealt by range of ``id`` and ``h``; within a part the neighbours are found by a window, and the parts'
    ends, one row for each part, are joined among themselves.
    """
    dealt = materialize(ids.repartitionByRange(parts, "id", "h").withColumn("part", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("part").orderBy(F.desc("id"), F.desc("h"))
    whole_row = F.struct("id", "h", "n")
    near = dealt.select(
        "id", "h", "copies", "part", F.lead(whole_row).over(inside).alias("next"), F.lag(whole_row).over(inside).alias("prev")
    )
    ends = dealt.groupBy("part").agg(F.max(whole_row).alias("top"), F.min(whole_row).alias("low"))
    across = Window.partitionBy().orderBy(F.desc("part"))  # one row for each part
    all_parts = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("top").over(across), F.first("top").over(all_parts)).alias("down"),
        F.coalesce(F.lag("low").over(across), F.last("low").over(all_parts)).alias("up"),
    )
    return near.join(F.broadcast(ends), "part").select("id", "h", "copies", F.coalesce("next", "down").alias("next"), F.coalesce("prev", "up").alias("prev"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next`` of every row.

    The edited text has its last half (rounded down) replaced by the beginning of the next document in
    descending order of ids, the first following the last; a lone document follows itself. Null text counts
    as empty. Texts without terms have a fingerprint of their own and are alike. Rows without id come last in the
    order, and where ids are the same or missing, a hash of id and text decides. Repeated rows are one
    document in the order and have one result each. An empty table gives no rows; further columns of ``docs`` are left
    out, whatever they are called.
    """
    parts = partitions(docs.sparkSession)
    node = ["id", "h"]  # tells documents apart, those with one id and those without any too
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("given"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.select(F.coalesce("given", F.lit(_LAST)).alias("id"), F.xxhash64("given", "text").alias("h"), F.col("given").isNull().alias("unnamed"), "text")
    counted = rows.groupBy(*node).agg(F.max(F.char_length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    order = materialize(neighbours(counted, parts), "order")

    one = Window.partitionBy(*node).orderBy("unnamed")
    # more partitions than usual: the terms of a partition's texts are counted in memory
    base = rows.repartition(4 * parts, *node).withColumn("_nth", F.row_number().over(one)).where("_nth = 1").select(*node, "unnamed", "text")
    given = base.join(order, node).select(F.col("prev.id").alias("id"), F.col("prev.h").alias("h"), F.expr("left(text, int(prev.n div 2))").alias("start"))
    n = F.char_length("text")
    both = base.join(given.repartition(4 * parts, *node), node).select(*node, "unnamed", "text", n.alias("n"), "start")
    both = both.select(*node, "unnamed", "text", "n", F.expr("concat(left(text, n - n div 2), left(start, n div 2))").alias("edited"))

    drawn = signatures(both.select(*node, "text", "edited"), node, ["text", "edited"], samples)
    none = F.array_repeat(F.lit(-1), samples)
    facts = both.select(*node, "unnamed", "n", F.sha2("edited", 256).alias("sha"))
    found = facts.join(drawn, node, "left").select(*node, "unnamed", "n", "sha", F.coalesce("signature_text", none).alias("own"), F.coalesce("signature_edited", none).alias("changed"))
    found = materialize(found, "signatures")

    after = order.select(F.col("next.id").alias("id"), F.col("next.h").alias("h"), F.struct("id", "h", "copies").alias("of")).join(found.select(*node, "own"), node)
    after = after.select("of.*", F.col("own").alias("next_own"))
    whole = found.join(after, node)
    # copies in steps, so that no row ever holds a list as long as their number
    whole = whole.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(_STEP).cast("bigint"))))
    whole = whole.withColumn("_copy", F.explode(F.sequence(F.col("_from"), F.least(F.col("copies"), F.col("_from") + (_STEP - 1)))))
    return whole.select(
        F.when(~F.col("unnamed"), F.col("id")).alias(id_col),
        F.col("n").cast("bigint").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
