"""Token-array column functions: truncate, pad, masks, EOS position, role splice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special token ids of the model vocabulary.
PAD_ID = 0
EOS_ID = 1
BOS_ID = 2
UNK_ID = 3
QUERY_MARK_ID = 6  # <unused0>
DOC_MARK_ID = 7  # <unused1>
SPECIAL_IDS = (PAD_ID, EOS_ID, BOS_ID)
QUERY_PREFIX = (BOS_ID, QUERY_MARK_ID)
DOC_PREFIX = (BOS_ID, DOC_MARK_ID)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def truncate(tokens, max_length: int) -> Column:
    """First ``max_length`` ids (may cut the EOS off)."""
    return F.slice(_c(tokens), 1, max_length)


def pad_to(tokens, length, pad: int = PAD_ID) -> Column:
    """Right-pad with ``pad`` to ``length`` (no-op when already that long)."""
    t = _c(tokens)
    n = _c(length) if not isinstance(length, int) else F.lit(length)
    return F.concat(t, F.array_repeat(F.lit(pad), F.greatest(n - F.size(t), F.lit(0))))


def mask_special(tokens, ids=SPECIAL_IDS) -> Column:
    """1 for ordinary tokens, 0 for PAD/EOS/BOS (the training-loader mask)."""
    ids_lit = [F.lit(i) for i in ids]
    return F.transform(_c(tokens), lambda t: F.when(t.isin(*ids_lit), 0).otherwise(1))


def last_eos(tokens, eos: int = EOS_ID) -> Column:
    """0-based position of the last EOS, or null when there is none."""
    t = _c(tokens)
    return F.when(
        F.array_contains(t, F.lit(eos)),
        (F.size(t) - F.array_position(F.reverse(t), F.lit(eos))).cast("int"),
    )


def mask_to_eos(tokens, eos: int = EOS_ID) -> Column:
    """1 up to and including the last EOS, 0 after it (the encoder mask).

    Without any EOS every position is masked out.
    """
    t = _c(tokens)
    e = F.coalesce(last_eos(t, eos), F.lit(-1))
    # The EOS position is a row value: evaluate it once, not once per element.
    return F.transform(F.array_repeat(e, F.size(t)), lambda ee, i: F.when(i <= ee, 1).otherwise(0))


def parse_ids(line) -> Column:
    """Whitespace-separated integers of a token line; blank line gives []."""
    from lodestar.functions.text import split_words

    return F.transform(split_words(line), lambda x: x.cast("int"))
