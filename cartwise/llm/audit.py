"""Interaction audit of row filters by min-plus removal ranks (operator 13).

Each filter either passes a row or fails it, so a row is a mask of failing filters, and how a chain of filters acts
depends only on how many rows have which mask. With F filters there are 2^F masks and F! orders. Let ``A[m, f]`` be 0
where mask m fails filter f and infinite elsewhere, and ``P[o, f]`` the position of filter f in order o (the inverse
permutation). The min-plus product ``R[m, o] = min over f of A[m, f] + P[o, f]`` is the step at which rows of mask m leave
under order o (infinite: they stay). All counts follow from R by adding each mask's rows to its step.

Spark counts masks per part of the table (2^F numbers each, counted before any shuffle); the product and the scatter
run once per part on those numbers.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import cut_lineage

STAYS = np.inf
MOST_FILTERS = 7  # 5,040 orders
_WEIGHTS = ("n", "good", "toxic")


def mask_matrix(filters: int) -> np.ndarray:
    """``A[mask, filter]``: 0 where the mask's bit says that the filter fails, infinite elsewhere."""
    bits = (np.arange(1 << filters)[:, None] >> np.arange(filters)[None]) & 1
    return np.where(bits == 1, 0.0, STAYS)


def position_matrix(orders: list[tuple[int, ...]]) -> np.ndarray:
    """``P[order, filter]``: the filter's place (from 1) in the order: its inverse permutation."""
    return np.argsort(np.array(orders), axis=1).astype(float) + 1


def removal_steps(filters: int, orders: list[tuple[int, ...]]) -> np.ndarray:
    """``R[mask, order]``: the min-plus product of the masks and the positions, one filter at a time."""
    a, p = mask_matrix(filters), position_matrix(orders)
    out = np.full((len(a), len(p)), STAYS)
    for f in range(filters):
        np.minimum(out, a[:, f, None] + p[None, :, f], out=out)
    return out


def tally(weights: np.ndarray, letters: str, orders: list[tuple[int, ...]], steps: np.ndarray) -> dict[str, np.ndarray]:
    """The audit of one part, flat by (order, step). ``weights[mask]`` has the columns rows, good, toxic."""
    n, k = len(letters), len(orders)
    left = np.isfinite(steps)
    at = np.where(left, steps, 0).astype(np.int64) - 1 + n * np.arange(k)[None]  # the cell (order, step)

    def scatter(w: np.ndarray) -> np.ndarray:
        return np.bincount(at[left], weights=np.broadcast_to(w[:, None], steps.shape)[left], minlength=n * k).astype(np.int64)

    rows = weights[:, 0]
    removed = scatter(rows)
    orders_ = np.array(orders)
    fails = mask_matrix(n) == 0
    failing = (rows[:, None] * fails).sum(axis=0)  # rows that fail a filter, whoever removes them
    only = np.array([rows[1 << f] for f in range(n)])
    which = orders_.ravel()  # the filter of each cell
    shapley = np.bincount(which, weights=removed, minlength=n).astype(np.int64)
    kept = rows.sum() - removed.reshape(k, n).cumsum(axis=1).ravel()
    return {
        "filter_order": np.repeat(["".join(letters[f] for f in o) for o in orders], n),
        "step": np.tile(np.arange(1, n + 1), k),
        "kept": kept,
        "removed": removed,
        "redundant": failing[which] - removed,
        "unique_fails": only[which],
        "good_lost": scatter(weights[:, 1]),
        "toxic_lost": scatter(weights[:, 2]),
        "shapley": shapley[which],
    }


def measured(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with what the prose filters look at: ``__words``, ``__distinct``, ``__capitals``, ``__points``, ``__marked``.

    A null text counts as empty. Words are maximal runs without space, tab, line feed, vertical tab, form feed and
    carriage return; they are told apart by case.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    rows = rows.withColumns({"__text": text, "__list": words})
    return rows.withColumns(
        {
            "__words": F.size("__list"),
            "__distinct": F.size(F.array_distinct("__list")),
            "__capitals": F.regexp_count("__text", F.lit("[A-Z]")),
            "__points": F.length("__text"),
            "__marked": F.col("__text").rlike("[#$%&*|]"),
        }
    ).drop("__text", "__list")


def prose_filters() -> dict[str, Column]:
    """Failure conditions over ``measured`` rows: few words, repeated words, many capitals, marks of markup or tables."""
    return {
        "A": F.col("__words") < 100,
        "B": F.col("__distinct") * 100 < F.col("__words") * 80,
        "C": F.col("__capitals") * 100 > F.col("__points") * 10,
        "D": F.col("__marked"),
    }


def _sums(rows: DataFrame, *by: str | Column) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(c).cast("bigint").alias(c) for c in _WEIGHTS])


def _masks(read: DataFrame, labels: DataFrame | None, bit: int) -> DataFrame:
    """``(part, mask, n, good, toxic)`` of the rows ``(id, part, flags, same)``; ``bit`` marks copies (0: not looked for)."""
    # rows without an id have no label and no copies; they stay out of the joins, where they would be one hot key
    without = read.where("id is null").groupBy("part", F.col("flags").alias("mask")).agg(F.count(F.lit(1)).alias("n")).select("part", "mask", "n", F.lit(0).cast("bigint").alias("good"), F.lit(0).cast("bigint").alias("toxic"))
    rows = read.where("id is not null").groupBy("id", "part", "flags", "same").agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        rows = rows.withColumns({"good": F.lit(0).cast("bigint"), "toxic": F.lit(0).cast("bigint")})
    else:
        rows = rows.join(labels, "id", "left").withColumns({c: F.when(F.col(c) == 1, F.col("n")).otherwise(F.lit(0)).cast("bigint") for c in ("good", "toxic")})
    if not bit:
        return without.unionByName(_sums(rows, "part", F.col("flags").alias("mask")))
    # per text and part: all rows, and those of the smallest id there
    per = rows.groupBy("same", "part", "flags").agg(
        F.min("id").alias("low"),
        *[F.min_by(c, "id").alias(f"{c}_low") for c in _WEIGHTS],
        *[F.sum(c).cast("bigint").alias(c) for c in _WEIGHTS],
    )
    first = F.col("low") == F.min("low").over(Window.partitionBy("same"))  # a row per part and text
    original = {c: F.when(F.col("first"), F.col(f"{c}_low")).otherwise(F.lit(0)) for c in _WEIGHTS}
    both = F.array(
        F.struct(F.col("flags").alias("mask"), *[v.alias(c) for c, v in original.items()]),
        F.struct(F.col("flags").bitwiseOR(F.lit(bit)).alias("mask"), *[(F.col(c) - v).alias(c) for c, v in original.items()]),
    )
    return without.unionByName(_sums(per.withColumn("first", first).select("part", F.inline(both)), "part", "mask"))


def audit(rows: DataFrame, failures: dict[str, Column], part_col: str, labels: DataFrame | None = None, duplicate: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``: every order of
    the filters over every part, zeros included.

    ``failures``: a letter and the condition under which a row fails (null: it passes). ``duplicate`` names the letter of one
    more filter: the text equals that of a row with a smaller id anywhere in the table (null text: empty; a row without
    an id neither has nor makes such a copy; rows of one id are not copies of each other). ``labels(id, quality, toxic)`` marks
    good (quality = 1) and toxic (toxic = 1) rows; an id labelled several times is good or toxic if one of its labels says so.

    A step's filter is the order's letter there; ``redundant`` counts rows that fail it but left before, ``unique_fails``
    those that fail no other, ``shapley`` what it removes, summed over all orders. A null part is the empty
    string. An empty table gives no rows; a row counts as often as it occurs; long texts are read whole. Columns of other
    names are not read, so they cannot clash.

    Texts are read once; a copy is told by its sha256. Rows are counted per (text, part, flags) before they
    are exchanged, so a text that a third of the rows share is a few rows per task.
    """
    letters = "".join(sorted([*failures, *([duplicate] if duplicate else [])]))
    if len(set(letters)) != len(letters) or not 0 < len(letters) <= MOST_FILTERS:
        raise ValueError(f"filters need one different letter each, at most {MOST_FILTERS}")
    flags = sum((F.when(c, F.lit(1 << letters.index(x))).otherwise(F.lit(0)) for x, c in failures.items()), F.lit(0))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    read = cut_lineage(rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), part.alias("part"), flags.alias("flags"), F.unhex(F.sha2(text, 256)).alias("same")))
    if labels is not None:
        labels = labels.groupBy(F.col(f"`{id_col}`").cast("bigint").alias("id")).agg(*[F.max((F.col(c) == 1).cast("int")).alias(k) for c, k in (("quality", "good"), ("toxic", "toxic"))])
        labels = labels.where("id is not null and (good = 1 or toxic = 1)")
    masks = _sums(_masks(read, labels, 1 << letters.index(duplicate) if duplicate else 0), "part", "mask")
    return _tallied(masks, letters)


def _tallied(masks: DataFrame, letters: str) -> DataFrame:
    """The audit of every part from its counts per mask: at most 2^F numbers of three kinds each."""
    n = len(letters)
    per_part = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *_WEIGHTS)).alias("counts"))

    def run(batches):
        orders = list(permutations(range(n)))
        steps = removal_steps(n, orders)
        for b in batches:
            for part, counts in zip(b["part"], b["counts"]):
                weights = np.zeros((1 << n, len(_WEIGHTS)), dtype=np.int64)
                for c in counts:
                    weights[c["mask"]] = [c[w] for w in _WEIGHTS]
                yield pd.DataFrame({"part": part, **tally(weights, letters, orders, steps)})

    longs = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return per_part.mapInPandas(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in longs))
