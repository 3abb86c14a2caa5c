"""Fixed-length token arrays: truncation, padding, attention mask, label mask."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_truncate(ids, max_len: int, pad_id: int) -> Column:
    """Cut to ``max_len`` and right-pad with ``pad_id`` to exactly ``max_len``."""
    cut = F.slice(_c(ids), 1, max_len)
    return F.concat(cut, F.array_repeat(F.lit(pad_id), F.lit(max_len) - F.size(cut)))


def attention_mask(ids, max_len: int) -> Column:
    """1 for real tokens, 0 for padding (right padding)."""
    n = F.least(F.size(_c(ids)), F.lit(max_len))
    return F.transform(F.sequence(F.lit(0), F.lit(max_len - 1)),
                       lambda i: F.when(i < n, 1).otherwise(0))


def mask_prefix(padded_ids, prefix_len, max_len: int, mask_padding: bool = False,
                real_len=None, ignore: int = -100) -> Column:
    """Labels: the ids with the first min(prefix_len, max_len) set to ``ignore``.

    Padding keeps its id unless ``mask_padding`` is set (then positions at or
    after ``real_len`` are also ``ignore``).
    """
    cut = F.least(_c(prefix_len), F.lit(max_len))
    if mask_padding:
        rl = _c(real_len)
        return F.transform(_c(padded_ids), lambda x, i: F.when((i < cut) | (i >= rl), ignore).otherwise(x))
    return F.transform(_c(padded_ids), lambda x, i: F.when(i < cut, ignore).otherwise(x))


def token_budget(prompt_len, ctx: int, lo: int = 256, hi: int = 1200, margin: int = 8) -> Column:
    """New-token budget: max(lo, min(hi, ctx - prompt_len - margin))."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.lit(ctx) - _c(prompt_len) - F.lit(margin)))
