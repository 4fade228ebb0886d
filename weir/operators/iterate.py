"""Feedback loop: every record goes round until it may leave."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: New values by column name, and who goes round again, for the records still looping.
Step = Callable[[pd.DataFrame], dict[str, pd.Series]]
Again = Callable[[pd.DataFrame], pd.Series]


def iterate_until(rows: DataFrame, step: Step, again: Again) -> DataFrame:
    """Apply ``step`` to each record until ``again`` is false for it.

    Every record takes at least one step, and leaves with the values of the step
    after which ``again`` was false (or NULL). Records loop inside their Arrow batch,
    all of the batch at once, without shuffle, disk or driver, and without a limit on
    rounds. Both functions see the columns as Arrow-typed pandas series, so integers
    with NULLs stay integers; they must keep to each record's own values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            looping = batch.to_pandas(types_mapper=pd.ArrowDtype)
            left = []
            while len(looping):
                looping = looping.assign(**step(looping))
                back = again(looping).fillna(False).to_numpy(dtype=bool)
                if not back.all():
                    left.append(looping[~back])
                    looping = looping[back]
            if left:
                order = np.argsort(np.concatenate([part.index.to_numpy() for part in left]))
                done = pd.concat(left).iloc[order]
                yield pa.RecordBatch.from_pandas(done, schema=batch.schema, preserve_index=False)

    return rows.mapInArrow(run, rows.schema)
