"""Intermediate results and batch sizes of the training-data operators."""

from __future__ import annotations

from lodestrata.session import short_batches
from lodestrata.storage import give_back, stored, work_dir

__all__ = ["give_back", "short_batches", "stored", "work_dir"]
