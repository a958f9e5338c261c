"""Greedy tiling is carried on until no run of enough unmarked words is left."""

import random

from tidegrid.llm import decontamination


def greedy(item, doc, least):
    """Tiles by the definition: always the longest unmarked common run, the first of equal ones."""
    in_item, in_doc, found = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not in_item[i + n] and not in_doc[j + n]:
                    n += 1
                best = max(best, (n, i, j), key=lambda b: b[0])
        n, i, j = best
        if n < least:
            return sorted(found)
        in_item[i : i + n], in_doc[j : j + n] = [True] * n, [True] * n
        found.append((i, j, n))


def test_beginning_of_an_overlapped_match_is_tiled():
    random.seed(3)
    for _ in range(300):
        item = [random.randint(0, 3) for _ in range(random.randint(1, 24))]
        doc = [random.randint(0, 3) for _ in range(random.randint(0, 24))]
        assert decontamination.tiles(item, doc, 2) == greedy(item, doc, 2)
    # the run 4..9 goes first; of the run 0..4 its first four words are left
    assert decontamination.tiles(list(range(32)), [*range(4, 10), 99, *range(5)], 4) == [(0, 7, 4), (4, 0, 6)]
