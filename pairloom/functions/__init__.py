from pairloom.functions.columns import (
    band_start,
    cosine_distance,
    dot,
    epoch_day,
    high,
    low,
    pmi_score,
    positive,
    required,
)

__all__ = [
    "band_start",
    "cosine_distance",
    "dot",
    "epoch_day",
    "high",
    "low",
    "pmi_score",
    "positive",
    "required",
]
