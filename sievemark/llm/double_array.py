"""A double-array trie over bytes: the child of node s by byte c is
``base[s] + c + 1`` if ``check`` there names s."""

from __future__ import annotations

import numpy as np


def build(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): ``value`` is the index of the key that ends at a node, or -1."""
    root: dict = {}
    for i, key in enumerate(keys):
        node = root
        for c in key:
            node = node.setdefault(c, {})
        node[-1] = i
    size = 1 << 10
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    lowest = 1
    queue = [(0, root)]
    while queue:
        level = []
        for s, node in sorted(queue, key=lambda x: -len(x[1])):
            value[s] = node.get(-1, -1)
            codes = sorted(c + 1 for c in node if c >= 0)
            if not codes:
                continue
            while check[lowest] >= 0:
                lowest += 1
                if lowest + 600 > len(check):
                    base, check, value = base + [0] * size, check + [-1] * size, value + [-1] * size
                    size *= 2
            b, tries = max(0, lowest - codes[0]), 0
            while any(check[b + c] >= 0 for c in codes):
                b += 1
                tries += 1
                if b + 600 > len(check):
                    base, check, value = base + [0] * size, check + [-1] * size, value + [-1] * size
                    size *= 2
            if tries > 200 and len(codes) > 1:
                lowest += tries // 4  # a crowded region: leave its few holes
            base[s] = b
            for c in codes:
                check[b + c] = s
                level.append((b + c, node[c - 1]))
        queue = level
    pad = [-1] * 258
    return np.array(base + [0] * 258, np.int32), np.array(check + pad, np.int32), np.array(value + pad, np.int32)
