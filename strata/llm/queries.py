"""All registered corpus queries (importing the operator modules registers them)."""

from __future__ import annotations

from . import (  # noqa: F401
    align,
    byte_bpe,
    exact_dedup,
    fim,
    line_dedup,
    lm,
    minhash,
    mixing,
    packing,
    quality,
    suffix_dedup,
    topk,
    warc,
)
from .common import QUERIES

__all__ = ["QUERIES"]
