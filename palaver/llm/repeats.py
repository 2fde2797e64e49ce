"""Who has a piece of text first: the exchange that both substring operators share.

Mappers give (key, document) members and drop repeats inside a batch of texts, so a key that a
third of all documents share reaches its task once for each batch, not once for each document.
"""

from __future__ import annotations

import numpy as np


def first_in_batch(keys: list[np.ndarray], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(kept, shadowed): per distinct key one row of its smallest owner; rows of larger owners.

    ``owner`` orders documents. Repeats of a key by its smallest owner are in neither.
    """
    order = np.lexsort((owner, *reversed(keys)))
    same = np.ones(max(len(order) - 1, 0), bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    start = np.r_[True, ~same] if len(order) else np.zeros(0, bool)
    group = np.cumsum(start) - 1
    least = owner[order][start][group] if len(order) else owner[:0]
    later = owner[order] > least
    return order[start], order[later]
