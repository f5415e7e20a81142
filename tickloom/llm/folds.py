"""Folds by the CRC-32 of the document id, and bounded samples by hash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def in_fold(doc_id: Column | str, folds: int, fold: int) -> Column:
    """True if crc32(doc_id as text) mod folds is fold; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sampled(doc_id: Column | str, bound: int, total: int, seed: int = 0) -> Column:
    """True for about bound of total rows, the same rows at every run."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    if total <= bound:
        return F.lit(True)
    buckets = 1 << 40
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(buckets)) < int(buckets * bound / total)
