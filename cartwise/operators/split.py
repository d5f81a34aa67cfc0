"""Exact stratified train/test split (T7): every label gives its own share of test rows, to the row.

A row's place is a hash of its key, so the split is the same on every run. The test part of a label is its ``k`` smallest
hashes. The k-th is found without a sort: rows are counted by the leading bits of their hash, the bucket in which the k-th
falls is counted by the next bits, and so on until a bucket boundary lies exactly behind k rows. A round is one
aggregation to a bounded number of counts; rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.functions.checks import require_columns
from cartwise.session import cut_lineage, discard

HASH_BITS = 60
MOST_STRATA = 1000
MOST_COUNTS = 1 << 18  # counts that one round brings to the driver, all strata together


def key_hash(key_cols: Sequence[str], seed: int = 42) -> Column:
    """The first 60 bits of ``md5(seed|k1|k2...)``; a null key enters as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def test_sizes(counts: dict, fraction: float) -> dict:
    """Test rows per label: ``ceil(fraction * all rows)`` dealt in proportion, the rest to the largest remainders (then by label)."""
    n = sum(counts.values())
    draws = ceil(Fraction(str(fraction)) * n)
    sizes = {k: draws * c // n for k, c in counts.items()} if n else {}
    rest = sorted(counts, key=lambda k: (-(draws * counts[k] % n), k is not None, k)) if n else []
    for k in rest[: draws - sum(sizes.values())]:
        sizes[k] += 1
    return sizes


def hash_thresholds(hashed: DataFrame, sizes: dict, counts: dict) -> dict:
    """For each label the bound ``t`` with exactly ``sizes[label]`` rows of ``hashed(label, h)`` at ``h < t``.

    Rows of one hash (equal keys) stay together, so a label whose k-th and next row share a key gets that key's rows too.
    """
    done = {k: 0 if m == 0 else 1 << HASH_BITS for k, m in sizes.items() if m in (0, counts[k])}
    state = {k: (0, 0, 0) for k in sizes if k not in done}  # leading bits, how many, rows below them
    while state:
        step = max(1, min(12, (MOST_COUNTS // len(state)).bit_length() - 1))
        depth = next(iter(state.values()))[1]
        step = min(step, HASH_BITS - depth)
        inside, lead = F.lit(False), F.shiftright("h", HASH_BITS - depth)
        for k, (prefix, _, _) in state.items():
            inside = inside | (F.col("label").eqNullSafe(F.lit(k)) & (lead == prefix))
        bucket = F.shiftright("h", HASH_BITS - depth - step).bitwiseAND(F.lit((1 << step) - 1))
        found: dict = {k: {} for k in state}
        for r in hashed.where(inside).groupBy("label", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            found[r["label"]][r["b"]] = r["n"]
        after = {}
        for k, (prefix, _, below) in state.items():
            for b in sorted(found[k]):
                if below + found[k][b] >= sizes[k]:
                    break
                below += found[k][b]
            prefix = prefix << step | b
            if below + found[k][b] == sizes[k] or depth + step == HASH_BITS:
                done[k] = (prefix + 1) << (HASH_BITS - depth - step)
            else:
                after[k] = (prefix, depth + step, below)
        state = after
    return done


def stratified_split(df: DataFrame, label_col: str, key_cols: Sequence[str], test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` plus ``is_test``: ``ceil(test_fraction * rows)`` test rows, each label's within one row of its proportional part.

    Rows of equal keys fall on one side together (with distinct keys nothing else moves the share). A null label is a label
    of its own. At most ``MOST_STRATA`` labels. ``df`` is read once here, for its keys; pass a written table.
    """
    require_columns(df, [label_col, *key_cols])
    h = key_hash(key_cols, seed)
    hashed = cut_lineage(df.select(F.col(label_col).alias("label"), h.alias("h")))
    rows = hashed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MOST_STRATA + 1).collect()
    if len(rows) > MOST_STRATA:
        raise ValueError(f"more than {MOST_STRATA} values of {label_col}")
    counts = {r["label"]: r["n"] for r in rows}
    flag = F.lit(None).cast("boolean")
    for k, t in hash_thresholds(hashed, test_sizes(counts, test_fraction), counts).items():
        flag = F.when(F.col(label_col).eqNullSafe(F.lit(k)), h < F.lit(t)).otherwise(flag)
    discard(hashed)
    return df.withColumn("is_test", flag)
