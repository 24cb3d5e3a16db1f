"""Word counts of a corpus, and its most frequent words within a bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.arrow_text import lower_ascii, pieces, texts_of, words_of

# Count classes a factor of 2 ** (1 / 16) apart: some hundred rows, whatever the corpus.
CLASSES_PER_DOUBLING = 16


def word_counts(texts: DataFrame, lower: bool = False) -> DataFrame:
    """(word as bytes, n) over a frame whose only column is a text.

    Each task counts its words first, so a frequent word is shuffled a few times for each task,
    not once for each time it occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, batch_column):
            found = texts_of(batch.column(0))
            if lower:
                found.data = lower_ascii(found.data)
            words = words_of(found)
            coded = words.array().dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [pc.cast(coded.dictionary, pa.binary()), pa.array(n.astype(np.int64))],
                ["word", "n"],
            )

    batch_column = texts.columns[0]
    partial = texts.mapInArrow(run, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows with the highest counts `n`, never more than `limit`, without a global sort.

    The counts are put into classes; the classes kept are those that fit into the limit together.
    """
    grade = F.floor(F.log2(F.col("n").cast("double")) * CLASSES_PER_DOUBLING)
    classes = counts.groupBy(grade.alias("grade")).count().collect()
    kept, lowest = 0, None
    for row in sorted(classes, key=lambda r: -r["grade"]):
        kept += row["count"]
        if kept > limit:
            break
        lowest = row["grade"]
    return counts.filter(F.lit(False)) if lowest is None else counts.filter(grade >= lowest)
