"""Parameters of the series, the split, the model and the output rules."""

from __future__ import annotations

from dataclasses import dataclass

# Hot customers, each with the ordered product codes that cut it into blocks; see operators.blocks.
Cuts = tuple[tuple[str, tuple[str, ...]], ...]

# The one override rule in use, as (CustomerID, Struggle, StruggleWeek, FundingAmount).
DEFAULT_OVERRIDES = [("9813", 1, 3, 152)]


@dataclass(frozen=True)
class SeriesOptions:
    """How transactions become a balance series."""

    credit_type: str = "C"
    debit_type: str = "D"
    # A customer is kept when some product has exactly this many months without a negative balance.
    positive_months: int = 8
    # The balance is compared with the mean of this many preceding rows.
    mean_rows: int = 3
    # A balance below (1 - drop_ratio) of that mean is a struggle.
    drop_ratio: float = 0.3
    # The label of a series' last row is unknown; it counts as 0 unless these rows are dropped.
    drop_unknown: bool = False
    # Hot customers to be spread over tasks; None: looked for in a sample of the rows. The result is the same.
    cuts: Cuts | None = None


@dataclass(frozen=True)
class SplitOptions:
    """Deterministic hold-out split and folds."""

    seed: int = 42
    test_percent: int = 20
    # True: every label gives exactly its share to the test. False: hash alone, no extra pass.
    exact: bool = True
    folds: int = 5


@dataclass(frozen=True)
class ModelOptions:
    """Boosted trees and the grid searched over."""

    max_depths: tuple[int, ...] = (4, 5)
    max_iter: int = 100
    step_size: float = 0.3
    subsampling_rate: float = 0.8
    feature_fraction: float = 0.8
    min_info_gain: float = 0.0
    max_bins: int = 256
    seed: int = 27
    parallelism: int = 2
    # True: columns are drawn once per tree and leaves get second-order values. False: trees as MLlib's booster grows
    # them, with columns drawn at every node. Both in plans.boosting.
    columns_per_tree: bool = False
    # Added to the curvature of a leaf, with columns_per_tree.
    leaf_penalty: float = 1.0
    # True: fit the scaler on all rows, train on raw values and score scaled ones.
    reference_compat: bool = False
