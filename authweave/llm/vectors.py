"""Vector tables: which rows take part, and blocks of them as matrices."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def blocks(rows: DataFrame, block: str, ids: str, vector: str, extra: list[str], dtype: str) -> DataFrame:
    """One row per value of `block`: n, width, and the columns as bytes.

    `extra` are long columns. Shorter vectors are filled up with zeros to the block's width.
    The caller bounds the rows of a block.
    """

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(ids, ignore_index=True)
        width = max(map(len, frame[vector]), default=0)
        matrix = np.zeros((len(frame), width), dtype)
        for k, values in enumerate(frame[vector]):
            matrix[k, :len(values)] = values
        out = {"block": [key[0]], "n": [len(frame)], "width": [width], "matrix": [matrix.tobytes()]}
        for name in [ids, *extra]:
            out[name] = [frame[name].to_numpy(np.int64).tobytes()]
        return pd.DataFrame(out)

    schema = "block long, n long, width long, matrix binary, " + ", ".join(
        f"{name} binary" for name in [ids, *extra]
    )
    kept = rows.select(F.col(block).cast("long").alias("block"), ids, vector, *extra)
    return kept.groupBy("block").applyInPandas(pack, schema)


def matrix(row, dtype: str, width: int) -> np.ndarray:
    """The matrix of a block, filled up with zeros to `width` columns."""
    found = np.frombuffer(row.matrix, dtype).reshape(row.n, row.width)
    if row.width < width:
        found = np.pad(found, ((0, 0), (0, width - row.width)))
    return found
