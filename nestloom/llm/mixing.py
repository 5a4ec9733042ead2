"""Mixing sources to target weights by iterative proportional fitting (operator 8). DataFrame functions only.

Documents are counted into cells of source, language and topic, each with its tokens (bytes of UTF-8, the tokens
of a byte vocabulary, unless another count is given). Raking scales
the cells in turn so that the sums over each of the three match their targets; the cells are written once
a round, and each step is one pass over them. The targets share out a wanted number of tokens.
No cell gives more than it has: where it is asked for more it is kept whole, and the others make up for it, so
a rare value takes nothing from the rest. A document's probability is the part of its cell's tokens that is
wanted, and a hash of the document decides. What cannot be reached is returned with each row and warned of.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F

from nestloom.llm.common import materialize

MARGINS = ("source", "lang", "topic")
ROUNDS, CLOSE = 30, 1e-3
_NEAR = 1e-9  # what counts as equal, so that the last digits of sums decide nothing
KEEP = 0.65  # share of all tokens that is wanted if no number is given

# fixed values: what the texts of a topic look like
_ADDRESS, _NUMBER = r"[\w.+-]+@[\w-]+\.\w+", r"\+?\d[\d ()./-]{8,}\d"
_TOPICS = {
    "legal": r"(?i)\b(licen[sc]ed?|copyright|warrant(y|ies)|all rights reserved)\b",
    "contact": f"{_ADDRESS}|{_NUMBER}",
    "markup": r"</?[a-z]+[^<>]*>|[{};]\s*\n| \| ",
}


def topic(text: Column) -> Column:
    """Coarse topic of a whole text: the first of the patterns that occurs in it, else ``prose``."""
    found = F.lit("prose")
    for name, pattern in reversed(_TOPICS.items()):
        matches = text.rlike(pattern)
        if name == "contact":  # an address is looked for only where there is its sign, as that reads each word many times
            matches = (text.contains("@") & text.rlike(_ADDRESS)) | text.rlike(_NUMBER)
        found = F.when(matches, F.lit(name)).otherwise(found)
    return found


def cells(docs: DataFrame, topics: Column | None, text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """``_row`` (all columns of a document), ``_source``, ``_lang``, ``_topic`` (null: empty text) and ``_tokens``, at least 1."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = [F.coalesce(F.col(f"`{m}`").cast("string"), F.lit("")).alias(f"_{m}") for m in MARGINS[:2]]
    named.append(F.coalesce(topic(text) if topics is None else topics, F.lit("")).alias("_topic"))
    size = F.octet_length(text) if tokens is None else F.coalesce(tokens, F.lit(1))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(whole, *named, F.greatest(F.lit(1), size).cast("bigint").alias("_tokens"))


def tempered(counts: DataFrame, margin: str, power: float) -> DataFrame:
    """Targets of one margin: shares of its tokens to the given power, which evens out large and small ones."""
    sums = counts.groupBy(f"_{margin}").agg(F.sum("tokens").alias("t"))
    raised = sums.select(f"_{margin}", F.pow("t", F.lit(power)).alias("target"))
    whole = raised.agg(F.sum("target")).first()[0]
    return raised.select(f"_{margin}", (F.col("target") / whole).alias("target"))


def _keys() -> list[str]:
    return [f"_{m}" for m in MARGINS]


def attainable(asked: DataFrame) -> DataFrame:
    """``asked`` (``goal``, ``most``) with goals of at most ``most``; the other goals grow alike to the same sum."""
    grown = 1.0
    while True:
        full = F.col("goal") * grown >= F.col("most")
        sums = asked.agg(F.sum(F.when(full, F.col("most")).otherwise(F.lit(0.0))), F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("goal")))).first()
        # each pass can only add full values, so this ends
        more = (1.0 - sums[0]) / sums[1] if sums[1] else grown
        if more <= grown * (1 + 1e-9):
            return asked.withColumn("goal", F.least("most", F.col("goal") * grown))
        grown = more


def rake(
    counts: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, close: float | None = CLOSE, wanted_tokens: float | None = None
) -> DataFrame:
    """``counts(_source, _lang, _topic, tokens)`` with ``weight``: token shares that match the targets.

    ``targets`` maps a margin to a table of its values and their ``target`` shares; values without a target
    keep their own share, and shares are scaled to sum up to 1. With ``wanted_tokens``, weights are shares of
    that number and no cell gets more than its tokens: a value with too few is kept whole. ``gap_source``,
    ``gap_lang`` and ``gap_topic`` tell what the row's value of that margin got in relation to its target,
    less 1. Ends when no step of a round is off by more than ``close``, when rounds stop to bring the margins
    nearer, or after ``rounds``; without ``close`` after ``rounds`` alone, which any engine can repeat. If a margin
    then misses by more than ten times ``close`` what each of its values could get, a warning names it.
    """
    whole = counts.agg(F.sum("tokens")).first()[0]
    if not whole:
        return counts.withColumns({"weight": F.lit(0.0)} | {f"gap{m}": F.lit(0.0) for m in _keys()})
    wanted_tokens = None if wanted_tokens is None else min(float(wanted_tokens), float(whole))
    if wanted_tokens is not None and wanted_tokens <= 0:
        raise ValueError("wanted_tokens has to be positive")
    most = F.lit(float("inf")) if wanted_tokens is None else F.col("tokens") / wanted_tokens
    state = counts.select(*_keys(), "tokens", (F.col("tokens") / whole).alias("free"), most.alias("most"))
    for m in MARGINS:
        own = counts.groupBy(f"_{m}").agg(F.sum("tokens").alias("tokens"))
        joined = own.join(targets[m], f"_{m}", "left").select(f"_{m}", F.coalesce("target", F.col("tokens") / whole).alias("goal"), most.alias("most"))
        joined = materialize(joined, "goals")
        total = joined.agg(F.sum("goal")).first()[0]
        asked = joined.select(f"_{m}", (F.col("goal") / total).alias("asked"), (F.col("goal") / total).alias("goal"), "most")
        goals = asked if wanted_tokens is None else attainable(asked)
        state = state.join(goals.select(f"_{m}", F.col("asked").alias(f"asked_{m}"), F.col("goal").alias(f"goal_{m}")), f"_{m}")
    state = materialize(state, "cells")

    weight = F.least("free", "most")
    before, stuck = float("inf"), 0
    for _ in range(rounds):
        # a round is one plan: each step adds up a margin, and its factors go back to the cells
        moved, off = state, []
        for m in MARGINS:
            full = F.sum(F.when(F.col("free") >= F.col("most") * (1 - _NEAR), F.col("most")).otherwise(F.lit(0.0)))
            now = moved.groupBy(f"_{m}").agg(F.sum(weight).alias("w"), full.alias("full"), F.first(f"goal_{m}").alias("goal"))
            rest, missing, near = F.col("w") - F.col("full"), F.col("goal") - F.col("full"), _NEAR * F.col("goal")
            # whole cells stay as they are and the others share the rest, unless the whole ones alone are too much
            step = F.when(F.col("w") <= 0, F.lit(1.0)).when((rest > _NEAR * F.col("w")) & (missing > near), missing / rest)
            step = step.when((rest <= _NEAR * F.col("w")) & (missing >= -near), F.lit(1.0)).otherwise(F.col("goal") / F.col("w"))
            miss = F.when(F.col("w") > 0, F.abs(F.col("goal") - F.col("w")) / F.greatest("w", "goal")).otherwise(F.lit(0.0))
            moved = moved.join(now.select(f"_{m}", step.alias("step"), miss.alias(f"off_{m}")), f"_{m}")
            moved = moved.withColumn("free", F.col("free") * F.col("step")).drop("step")
            off.append(f"off_{m}")
        moved = materialize(moved, "cells")
        state = moved.drop(*off)
        if close is None:
            continue
        worst = moved.agg(F.max(F.greatest(*off))).first()[0] or 0.0
        stuck = stuck + 1 if worst > 0.99 * before else 0
        before = worst
        if worst <= close or stuck == 3:
            break

    found = state = state.withColumn("weight", weight)
    for m in MARGINS:
        got = state.groupBy(f"_{m}").agg(F.sum("weight").alias("w"), F.first(f"asked_{m}").alias("asked"), F.first(f"goal_{m}").alias("goal"))
        gap = F.when(F.col("asked") > 0, F.col("w") / F.col("asked") - 1).otherwise(F.lit(0.0))
        off = F.when(F.col("goal") > 0, F.abs(F.col("w") / F.col("goal") - 1)).otherwise(F.lit(0.0))
        found = found.join(got.select(f"_{m}", gap.alias(f"gap_{m}"), off.alias(f"off_{m}")), f"_{m}")
    found = materialize(found, "weights")
    worst = found.agg(*[F.max(f"off_{m}").alias(m) for m in MARGINS]).first()
    if any(worst[m] > 10 * (close or CLOSE) for m in MARGINS):
        warnings.warn("targets contradict or are not reached; largest miss: " + ", ".join(f"{m} {worst[m]:.1%}" for m in MARGINS), stacklevel=2)
    return found.select(*_keys(), "tokens", "weight", *[f"gap_{m}" for m in MARGINS])


def draw(identifier: Column, text: Column, seed: int) -> Column:
    """A number from 0 to 1 (not included) by a digest of seed, id and text, which any engine can repeat."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, 10), 16, 10).cast("bigint") / F.lit(float(1 << 40))


def mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    power: float = 0.9,
    topics: Column | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    wanted_tokens: float | None = None,
    tokens: Column | None = None,
    keep: float = KEEP,
    rounds: int = ROUNDS,
    close: float | None = CLOSE,
) -> DataFrame:
    """Every row with its columns and ``mix_topic``, ``mix_tokens``, ``mix_probability``, ``mix_gap_*`` and ``mix_kept``.

    Without ``targets`` (or for a margin they leave out) the margin's own token shares to ``power`` are the
    targets, and without ``wanted_tokens`` a share of ``keep`` of all tokens is wanted. ``topics`` and
    ``tokens`` take the place of the patterns and of the bytes of a text. The probability of a cell is the
    part of its tokens that its raked weight takes, 1 at most; ``mix_gap_source``, ``mix_gap_lang`` and
    ``mix_gap_topic`` are those of ``rake`` for the row's values. ``draw`` decides, so equal rows are decided
    alike. Null source, language, topic or text counts as empty; an empty text counts as one token. An empty
    table gives no rows. All other columns stay, whatever they are called; one that is called as an added one
    gives way to it.
    """
    counted = cells(docs, topics, text_col, tokens)
    keys = _keys()
    counts = materialize(counted.groupBy(*keys).agg(F.sum("_tokens").alias("tokens")), "counts")
    goals = {m: (targets or {}).get(m) for m in MARGINS}
    goals = {m: tempered(counts, m, power) if t is None else t for m, t in goals.items()}
    whole = counts.agg(F.sum("tokens")).first()[0] or 0
    wanted = keep * whole if wanted_tokens is None else min(wanted_tokens, whole) if whole else wanted_tokens
    raked = rake(counts, goals, rounds, close, wanted_tokens=wanted)
    chances = raked.select(
        *keys,
        F.least(F.lit(1.0), F.col("weight") * F.lit(float(wanted)) / F.col("tokens")).alias("_chance"),
        *[F.col(f"gap_{m}").alias(f"_gap_{m}") for m in MARGINS],
    )
    chosen = draw(F.col(f"_row.`{id_col}`"), F.col(f"_row.`{text_col}`"), seed) < F.col("_chance")
    added = {
        "mix_topic": F.col("_topic"),
        "mix_tokens": F.col("_tokens"),
        "mix_probability": F.col("_chance"),
        **{f"mix_gap_{m}": F.col(f"_gap_{m}") for m in MARGINS},
        "mix_kept": chosen,
    }
    own = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in added]
    return counted.join(chances, keys).select(*own, *[c.alias(n) for n, c in added.items()])
