"""Tunables and their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # fixed values
    vector_len: int = 320
    cluster_eps: float = 0.4
    cluster_limit: int = 500
    classification_limit: int = 2
    max_document_len: int = 4096
    consolidation_eps: float = 0.5
    consolidation_related_days: int = 30
    consolidation_max_size: int = 64
    consolidation_min_size: int = 4
    processing_window_days: int = 0
    processing_limit: int = 0  # rows of a queue that a run takes; 0 takes the whole queue
    words_for_storing: int = 160
    max_tags: int = 50


DEFAULTS = Settings()
