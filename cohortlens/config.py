"""Frozen parameter objects: column names and tunables of each stage."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TxConfig:
    """Transaction table column names and cleaning policy."""

    invoice: str = "Invoice"
    stock: str = "StockCode"
    description: str = "Description"
    quantity: str = "Quantity"
    date: str = "InvoiceDate"
    price: str = "Price"
    customer: str = "Customer ID"
    country: str = "Country"
    revenue: str = "Revenue"
    # Date text format; None reads ISO text (``try_cast`` to timestamp_ntz), and
    # "auto" lets the batch run find the one format that reads all dates.
    date_format: str | None = None
    # Invoices whose text starts with this prefix are cancellations.
    cancel_prefix: str = "C"
    # Decimal places of money sums, which run in decimal(38, money_scale) so that
    # their order does not matter; far below any price, so nothing is cut.
    money_scale: int = 8


@dataclass(frozen=True)
class RFMConfig:
    """Recency / frequency / monetary parameters."""

    id_out: str = "CustomerID"
    # Buckets of the batch run's customer tables, which are joined by customer:
    # about one for each 256 MB of the largest.
    buckets: int = 16
    # Snapshot = midnight of the latest transaction + this many days.
    snapshot_add_days: int = 1
    top_n: int = 10


@dataclass(frozen=True)
class ClusterConfig:
    """KMeans parameters (defaults are the reference's and the library's)."""

    features: tuple[str, ...] = ("R_scaled", "F_scaled", "M_scaled")
    k_min: int = 2
    k_max: int = 8  # inclusive
    final_k: int = 3
    seed: int = 42
    n_init: int = 20
    max_iter: int = 300
    tol: float = 1e-4
    cluster_col: str = "Cluster"


@dataclass(frozen=True)
class TemporalConfig:
    """Calendar binning used by the activity summaries."""

    # Right-closed month-period bins (0,10], (10,20], (20,31].
    bins: tuple[int, ...] = (0, 10, 20, 31)
    labels: tuple[str, ...] = ("Early", "Mid", "Late")
    cluster_col: str = "Cluster"
    id_col: str = "CustomerID"
