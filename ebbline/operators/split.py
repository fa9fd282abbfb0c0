"""Deterministic train/test split and folds from key hashes, the same on every run."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ebbline.functions.cells import hash_bucket
from ebbline.options import SplitOptions
from ebbline.schemas import IDENTIFIERS, TARGET

DEFAULTS = SplitOptions()

# Digits of the key hash: in all, and looked at in one step.
HASH_DIGITS = 32
PREFIX = 3
# A part of at most so many rows is counted hash by hash.
COUNTED_HASHES = 4_096
MAX_LABELS = 100


def assign_split(df: DataFrame, options: SplitOptions = DEFAULTS) -> DataFrame:
    """Add split: 'test' for ``test_percent`` of the keys, 'train' for the rest; no shuffle, no pass.

    The hash does not depend on the label, so each label keeps its share up to sampling error.
    """
    bucket = hash_bucket(100, F.lit(str(options.seed)), *IDENTIFIERS)
    return df.withColumn("split", F.when(bucket < options.test_percent, "test").otherwise("train"))


def train_quota(counts: Mapping[object, int], test_percent: int) -> dict[object, int]:
    """Train rows per label so that all labels together leave ceil(test share) rows for the test.

    Shares are rounded down and the missing rows go to the largest remainders.
    """
    total = sum(counts.values())
    wanted = total - -(-total * test_percent // 100)
    quota = {label: n * wanted // total for label, n in counts.items()}
    by_remainder = sorted(counts, key=lambda label: (-(counts[label] * wanted % total), str(label)))
    for label in by_remainder[: wanted - sum(quota.values())]:
        quota[label] += 1
    return quota


def fold_quota(counts: Mapping[object, int], folds: int) -> dict[object, list[int]]:
    """Rows per label in the first fold, the first two, ..., all but the last.

    Rows laid end to end label by label go to the folds in turn, so that each label's folds differ by at
    most one row, and so do whole folds.
    """
    quota, start = {}, 0
    for label in sorted(counts, key=lambda label: (label is not None, str(label))):
        end = start + counts[label]
        of_fold = [(end - fold + folds - 1) // folds - (start - fold + folds - 1) // folds for fold in range(folds)]
        quota[label], start = list(accumulate(of_fold))[:-1], end
    return quota


def assign_stratified_split(df: DataFrame, label: str = TARGET, options: SplitOptions = DEFAULTS) -> DataFrame:
    """Add split with exact shares: every label gives its quota, the rows of the smallest key hashes
    being the test.

    Rows of equal keys are never parted, so that no key is in both; where keys repeat, a label's share
    is met to within the rows of one key (the test then has the few more).

    Rows are neither ranked nor moved: each compares its hash with its label's last test hash, a constant
    by then. ``df`` is read a few times (see ``quota_digests``), so stage it.
    """
    digest = _digest(str(options.seed))

    def of_test(counts):
        kept = train_quota(counts, options.test_percent)
        return {value: [rows - kept[value]] for value, rows in counts.items()}

    last = quota_digests(df.select(F.col(label).alias("Label"), digest.alias("Digest")), of_test)
    is_test = F.lit(False)
    for value, [limit] in last.items():
        is_test = is_test | (F.col(label).eqNullSafe(F.lit(value)) & (digest <= limit))
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def assign_stratified_fold(
    df: DataFrame, label: str = TARGET, options: SplitOptions = DEFAULTS, rows: str = "true"
) -> DataFrame:
    """Add fold, 0 to folds - 1, with equal shares of every label, for the rows that meet ``rows``; null for others.

    A label's folds differ by at most one row, in the order of key hashes of their own. Rows of equal keys
    are never parted; where keys repeat, folds are met to within the rows of one key. Like the split, a fold
    is a comparison of the row's hash with constants.
    """
    digest = _digest(f"{options.seed}-fold")
    hashed = df.where(rows).select(F.col(label).alias("Label"), digest.alias("Digest"))
    limits = quota_digests(hashed, lambda counts: fold_quota(counts, options.folds))
    fold = F.lit(None).cast("int")
    for value, ends in limits.items():
        passed = sum((F.when(digest > end, 1).otherwise(0) for end in ends), F.lit(0))
        fold = F.when(F.col(label).eqNullSafe(F.lit(value)), passed).otherwise(fold)
    return df.withColumn("fold", F.when(F.expr(rows), fold).cast("int"))


def _digest(seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *IDENTIFIERS))


def _counts(hashed: DataFrame, digits: int) -> dict[object, list[tuple[str, int]]]:
    """Per label the rows by leading digits of the hash, in order; at most 4,096 parts of each part looked at."""
    part = F.substring("Digest", 1, digits).alias("Part")
    found = hashed.groupBy("Label", part).agg(F.count(F.lit(1)).alias("Rows"))
    by_label: dict[object, list] = {}
    for row in found.collect():
        by_label.setdefault(row["Label"], []).append((row["Part"], row["Rows"]))
    return {label: sorted(parts) for label, parts in by_label.items()}


@dataclass
class _Wanted:
    """A quota of a label: the hash of its last row is looked for among those that start with ``part``."""

    label: object
    place: int
    left: int
    part: str = ""


def quota_digests(hashed: DataFrame, quotas: Callable[[dict], dict]) -> dict[object, list[str]]:
    """Per label the largest hash among the first rows, for each of the numbers of rows that ``quotas`` names.

    ``hashed`` has the columns Label and Digest; ``quotas`` is given the rows per label. The digest of no rows
    is empty, below all others.

    Hashes are counted by their first digits, which places every quota in one of 4,096 parts of its label;
    these parts are counted by further digits until they are small, and then hash by hash. ``hashed`` is read
    twice, and once more for every 4,096-fold of ``COUNTED_HASHES``, however many quotas there are.
    """
    labels = hashed.select("Label").distinct().limit(MAX_LABELS + 1).count()
    if labels > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    counts = _counts(hashed, PREFIX)
    asked = quotas({label: sum(n for _, n in parts) for label, parts in counts.items()})
    found = {label: [""] * len(places) for label, places in asked.items()}
    wanted = [_Wanted(label, i, n) for label, places in asked.items() for i, n in enumerate(places) if n > 0]
    digits = PREFIX
    while wanted:
        most = 0
        for want in wanted:
            for part, n in counts[want.label]:
                if not part.startswith(want.part):
                    continue
                if want.left <= n:
                    want.part, most = part, max(most, n)
                    break
                want.left -= n
        if digits == HASH_DIGITS:
            for want in wanted:
                found[want.label][want.place] = want.part
            break
        inside = F.lit(False)
        for label, part in dict.fromkeys((want.label, want.part) for want in wanted):
            inside = inside | (F.col("Label").eqNullSafe(F.lit(label)) & F.startswith("Digest", F.lit(part)))
        # Few rows have few hashes; many are looked at in 4,096 parts again.
        digits = HASH_DIGITS if most <= COUNTED_HASHES else min(digits + PREFIX, HASH_DIGITS)
        counts = _counts(hashed.where(inside), digits)
    return found


def assign_fold(df: DataFrame, options: SplitOptions = DEFAULTS) -> DataFrame:
    """Add fold: 0 to folds - 1, hashed independently of the split; no shuffle, no pass.

    Labels keep their shares up to sampling error.
    """
    return df.withColumn("fold", hash_bucket(options.folds, F.lit(f"{options.seed}-fold"), *IDENTIFIERS))


def split_counts(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows per split and label."""
    return df.groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"))
