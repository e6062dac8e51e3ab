"""Sentiment scores as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions.numeric import round_half_up

# Ties go to the first of these: no evidence either way reads as neutral.
LABELS = ["neutral", "negative", "positive"]


def pair(sentence: Column, aspect: Column) -> Column:
    return F.concat_ws(" [SEP] ", sentence, aspect)


def lexicon_hits(tokens: Column, lexicon: dict[str, int], polarity: int) -> Column:
    listed = sorted(token for token, sign in lexicon.items() if sign == polarity)
    return F.size(F.filter(tokens, lambda w: w.isin(*listed)))


def lexicon_probabilities(n_pos: Column, n_neg: Column) -> dict[str, Column]:
    """Softmax over one plus the number of positive and of negative tokens; neutral stays at one.

    The largest exponent is taken off first, so a text with any number of hits stays within range.
    """
    most = F.greatest(n_pos, n_neg, F.lit(0))
    e = {
        "positive": F.exp((n_pos - most).cast("double")),
        "neutral": F.exp((-most).cast("double")),
        "negative": F.exp((n_neg - most).cast("double")),
    }
    total = e["positive"] + e["neutral"] + e["negative"]
    return {k: v / total for k, v in e.items()}


def top_label(probabilities: dict[str, Column]) -> Column:
    best = F.greatest(*[probabilities[k] for k in LABELS])
    c = F.when(probabilities[LABELS[0]] == best, F.lit(LABELS[0]))
    for k in LABELS[1:]:
        c = c.when(probabilities[k] == best, F.lit(k))
    return c


def rating(probabilities: dict[str, Column]) -> Column:
    """Weighted 1-5 score, three decimals."""
    w = cfg.RATING_WEIGHTS
    return round_half_up(
        probabilities["positive"] * w["positive"]
        + probabilities["neutral"] * w["neutral"]
        + probabilities["negative"] * w["negative"],
        3,
    )
