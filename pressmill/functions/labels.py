"""Class mappings as CASE expressions.

Two encodings are in use: reliable = 1 / fake = 0, and the reverse. ``fake``
names the code of the fake side, so nothing depends on a hidden convention.
Unmapped classes give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _binary(key: Column, fake_side: tuple[str, ...], reliable_side: tuple[str, ...],
            fake: int) -> Column:
    return F.when(key.isin(*fake_side), F.lit(fake)).when(
        key.isin(*reliable_side), F.lit(1 - fake)
    )


def normalized(label: Column | str) -> Column:
    return F.lower(F.regexp_replace(
        _col(label), C.EDGE_SPACES_PATTERN, ""
    ))


def map_label_strict(label: Column | str, fake: int = 0) -> Column:
    """Exact match; ``' Fake '`` is unmapped."""
    return _binary(_col(label), C.FAKE_TYPES, C.RELIABLE_TYPES, fake)


def map_label_normalized(label: Column | str, fake: int = 1) -> Column:
    """Trim and lower-case first; ``' Fake '`` is fake."""
    return _binary(normalized(label), C.FAKE_TYPES, C.RELIABLE_TYPES, fake)


def map_claim_5way(label: Column | str, fake: int = 0) -> Column:
    """Borderline statements are unmapped; match after trim and lower-case."""
    return _binary(normalized(label), C.CLAIM_FAKE, C.CLAIM_RELIABLE, fake)


def map_claim_6way(label: Column | str, fake: int = 0) -> Column:
    """Borderline statements count as reliable; exact match."""
    return _binary(_col(label), C.CLAIM_FAKE, C.CLAIM_RELIABLE + C.CLAIM_BORDERLINE, fake)


def is_ambiguous(label: Column | str, normalize: bool = False) -> Column:
    key = normalized(label) if normalize else _col(label)
    return key.isin(*C.AMBIGUOUS_TYPES)
