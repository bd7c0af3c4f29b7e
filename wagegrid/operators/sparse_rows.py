"""Vectors of an Arrow batch as index and value arrays, for numpy code inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that are multiplied with a matrix at a time.
_PART = 1 << 14


@dataclass
class Rows:
    """Row i holds ``values[ends[i]:ends[i + 1]]`` at the places ``places[...]``."""

    places: np.ndarray
    values: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    @property
    def of(self) -> np.ndarray:
        """The row of every value."""
        return np.repeat(np.arange(len(self)), np.diff(self.ends))

    def summed(self, values: np.ndarray) -> np.ndarray:
        """Sums of ``values`` (one for each place held) by row."""
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return sums[self.ends[1:]] - sums[self.ends[:-1]]

    def _parts(self) -> Iterator[tuple[int, int]]:
        first = 0
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(self.ends, self.ends[first] + _PART, side="right")) - 1)
            yield first, last
            first = last

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """Product with a (places x m) matrix, some rows at a time."""
        out = np.zeros((len(self), matrix.shape[1]))
        for first, last in self._parts():
            held = slice(self.ends[first], self.ends[last])
            full = np.flatnonzero(np.diff(self.ends[first : last + 1]))
            if len(full):
                parts = matrix[self.places[held]] * self.values[held, None]
                out[first + full] = np.add.reduceat(parts, self.ends[first + full] - self.ends[first], axis=0)
        return out

    def transposed_times(self, matrix: np.ndarray, places: int) -> np.ndarray:
        """Product of the transpose with a (rows x m) matrix: (places x m)."""
        out = np.zeros((places, matrix.shape[1]))
        of = self.of
        for at in range(0, len(self.places), _PART):
            part = slice(at, at + _PART)
            order = np.argsort(self.places[part], kind="stable")
            sorted_places = self.places[part][order]
            firsts = np.flatnonzero(np.diff(sorted_places, prepend=-1))
            products = matrix[of[part][order]] * self.values[part][order, None]
            out[sorted_places[firsts]] += np.add.reduceat(products, firsts, axis=0)
        return out


def held(vector: str) -> Column:
    """A vector column as a struct that Arrow can carry; read with ``rows_of``."""
    return F.unwrap_udt(vector)


def rows_of(vectors: pa.StructArray) -> Rows:
    """Sparse and dense vectors of a batch."""
    values, indices = vectors.field("values"), vectors.field("indices")
    counts = pc.fill_null(pc.list_value_length(values), 0).to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    places = np.arange(ends[-1]) - np.repeat(ends[:-1], counts)
    sparse = np.repeat(indices.is_valid().to_numpy(zero_copy_only=False), counts)
    places[sparse] = pc.list_flatten(indices).to_numpy()
    return Rows(places, pc.list_flatten(values).to_numpy(), ends)
