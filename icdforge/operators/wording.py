"""Word-level alignment of two descriptions, as one native expression.

Aligning costs, per pair of words, their edit distance; a word left without
partner costs its length.  A pair of words is a spelling variant if its distance
is at most a quarter of the longer word (so words below four characters must be
equal) and neither holds a digit.  The cheapest alignment is found by dynamic
programming over the words; among equally cheap ones the one with the fewest
pairs that are no spelling variants counts.  Both are kept in one number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: weight of an edit against a pair that is no spelling variant; above any number of words
EDIT = 10_000


def alignment_cost(a: Column, b: Column) -> Column:
    """Edits * ``EDIT`` + pairs that are no spelling variants, of the cheapest
    alignment of the blank-separated words of ``a`` and ``b``."""
    left, right = F.split(a, " "), F.split(b, " ")

    def step(row: Column, x: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            y = F.element_at(right, j)
            near = (F.translate(F.concat(x, y), "0123456789", "") == F.concat(x, y)) & (F.levenshtein(x, y) * 4 <= F.greatest(F.length(x), F.length(y)))
            pair = F.when(x == y, F.lit(0)).when(near, F.levenshtein(x, y) * EDIT).otherwise(F.levenshtein(x, y) * EDIT + 1)
            return F.array_append(done, F.least(
                F.element_at(row, j) + pair, F.element_at(row, j + 1) + F.length(x) * EDIT + 1, F.element_at(done, -1) + F.length(y) * EDIT + 1))

        first = F.array(F.element_at(row, 1) + F.length(x) * EDIT + 1)
        return F.aggregate(F.sequence(F.lit(1), F.size(right)), first, cell)

    start = F.aggregate(right, F.array(F.lit(0)), lambda done, y: F.array_append(done, F.element_at(done, -1) + F.length(y) * EDIT + 1))
    return F.element_at(F.aggregate(left, start, step), -1)


def is_spelling(a: Column, b: Column) -> Column:
    """Whether ``a`` and ``b`` differ in spelling variants of words only.

    Such an alignment pairs every word, so texts with different numbers of words
    are not aligned; equal words at both ends pair with each other in a cheapest
    alignment, so only what lies between the first and the last difference is."""
    left, right = F.split(a, " "), F.split(b, " ")
    differ = F.filter(F.sequence(F.lit(1), F.size(left)), lambda i: F.element_at(left, i) != F.element_at(right, i))
    first, last = F.try_element_at(differ, F.lit(1)), F.try_element_at(differ, F.lit(-1))
    inner = [F.array_join(F.slice(words, first, last - first + 1), " ") for words in (left, right)]
    return F.when(F.size(left) == F.size(right), F.when(F.size(differ) > 0, alignment_cost(*inner) % EDIT == 0).otherwise(True)).otherwise(False)
