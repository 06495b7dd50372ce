"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

Documents are handled in pieces of some megabytes.  Each piece sends its
distinct n-grams with their counts to the buckets of their hashes; a bucket adds
them up to its part of the count table and answers every piece with the totals
of what it asked for.  A frequent n-gram is one record per piece, not one per
occurrence, so no bucket is hot.  The answers then meet the piece's texts again,
where the scores of its n-grams are summed per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import (
    bucket_of, pack, partitions, planes, saved, small_batches, tidy, tidy_group, unpack, unplanes,
)
from starloom.llm.text import CHUNK, NOT_SPACE, mixed, text_bytes, weights, word_hashes

ORDER = 2
BACKOFF = 0.4
# An n-gram of two words or more counts as seen if it occurs this often; once means here alone.
LEAST_COUNT = 2
# Bytes of text in a piece.
PIECE = 2 * CHUNK


def _grams(hashes: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order the hash of the n-gram that ends at each word; meaningless in a text's first words."""
    grams = [mixed(hashes)]
    for size in range(2, order + 1):
        weight = weights(size, 11)
        total = np.full(len(hashes), size, np.uint64)
        for back in range(size):
            total[back:] += hashes[:len(hashes) - back] * weight[back]
        grams.append(mixed(total))
    return grams


def _places(counts: np.ndarray) -> np.ndarray:
    """The number of each word within its text."""
    return np.arange(counts[-1]) - np.repeat(counts[:-1], np.diff(counts))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Pieces of a partition with their numbers, which depend on the texts before them and on nothing else."""
    task, before, last, held = TaskContext.get().partitionId(), 0, None, []
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        number = (before + np.cumsum(size) - size) // PIECE
        before += int(size.sum())
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
        for low, high in zip(cuts, cuts[1:]):
            if held and number[low] != last:
                yield task << 32 | last, pa.Table.from_batches(held)
                held = []
            if high > low:
                last = int(number[low])
                held.append(batch.slice(low, high - low))
    if held:
        yield task << 32 | last, pa.Table.from_batches(held)


def gram_totals(texts: DataFrame, order: int, buckets: int) -> DataFrame:
    """The count table's answers: ``piece, gram, bucket, blob``, the totals of a piece's distinct n-grams in key order.

    Rows with ``piece`` null hold the number of words of a bucket in ``bucket``.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, batch in _labelled(batches):
            hashes, counts = word_hashes(*text_bytes(batch.column("text")), NOT_SPACE)
            place = _places(counts)
            for size, gram in enumerate(_grams(hashes, counts, order), 1):
                keys, times = np.unique(gram[place >= size - 1], return_counts=True)
                number = bucket_of(keys, buckets)
                cuts = np.searchsorted(number, np.arange(buckets + 1))
                spans = [(i, a, b) for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]
                yield pa.record_batch({
                    "part": pa.array([i for i, _, _ in spans], pa.int32()),
                    "gram": pa.array([size] * len(spans), pa.int32()),
                    "piece": pa.array([piece] * len(spans), pa.int64()),
                    "blob": pa.array([pack([keys[a:b], times[a:b].astype(np.uint32)]) for _, a, b in spans], pa.binary()),
                })

    def answer(table: pa.Table) -> pa.Table:
        rows = [unpack(blob, ["u8", "u4"]) for blob in table.column("blob").to_pylist()]
        keys, inverse = np.unique(np.concatenate([row[0] for row in rows]), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate([row[1] for row in rows]), len(keys)).astype(np.uint64)
        ends = np.cumsum([len(row[0]) for row in rows])
        blobs = [planes(totals[inverse[end - len(row[0]):end]]) for row, end in zip(rows, ends)]
        pieces, gram = table.column("piece").to_pylist(), table.column("gram")[0].as_py()
        part = table.column("part")[0].as_py()
        if gram == 1:
            pieces, blobs = [*pieces, None], [*blobs, None]
        words = int(totals.sum())
        return pa.table({
            "piece": pa.array(pieces, pa.int64()), "gram": pa.array([gram] * len(pieces), pa.int32()),
            "bucket": pa.array([words if piece is None else part for piece in pieces], pa.int64()),
            "blob": pa.array(blobs, pa.binary()),
        })

    asked = texts.select("text").mapInArrow(tidy(ask), "part int, gram int, piece long, blob binary")
    return asked.groupBy("part", "gram").applyInArrow(tidy_group(answer), "piece long, gram int, bucket long, blob binary")


def score(
    documents: DataFrame, order: int = ORDER, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` for every row.

    Words are what stands between ASCII white space, A-Z lower-cased.  A word
    scores count(n-gram) / count(its context) for the longest n-gram, up to
    ``order`` words, that occurs ``LEAST_COUNT`` times, and ``BACKOFF`` for each
    word the context had to lose; a single word scores count / all words.
    ``log_score`` is the sum of natural logarithms.  A null text is empty; a
    text without words has a sum of 0 and a null mean.  Repeated rows count and
    are scored like any others; an empty table gives no rows.  The documents are
    read twice and have to be split alike both times: read files in a session of
    ``plans.sizing.steady``, where that does not follow the number of executors.
    """
    spark = documents.sparkSession
    texts = small_batches(documents).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    totals = saved(gram_totals(texts, order, 4 * partitions(spark)))
    words = totals.filter("piece IS NULL").agg(F.coalesce(F.sum("bucket"), F.lit(0))).first()[0]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, batch in _labelled(batches):
            yield from batch.add_column(0, "piece", pa.array([piece] * batch.num_rows, pa.int64())).to_batches()

    def summed(texts: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, counts = word_hashes(*text_bytes(texts.column("text")), NOT_SPACE)
        place, own = _places(counts), {}
        answers = answers.sort_by([("gram", "ascending"), ("bucket", "ascending")])
        for gram, blob in zip(answers.column("gram").to_pylist(), answers.column("blob").to_pylist()):
            own.setdefault(gram, []).append(unplanes(blob, "u8"))
        shorter, result = None, np.zeros(len(hashes))
        for size, gram in enumerate(_grams(hashes, counts, order), 1):
            at = np.flatnonzero(place >= size - 1)
            if not len(at):
                break
            keys, inverse = np.unique(gram[at], return_inverse=True)
            found = np.concatenate(own[size])
            if len(found) != len(keys):
                raise RuntimeError("the documents changed between two passes over them")
            total = np.zeros(len(hashes))
            total[at] = found[inverse]
            if size == 1:
                result = np.log(total / words)
            else:
                seen = total[at] >= LEAST_COUNT
                result[at] += np.log(BACKOFF)
                result[at[seen]] = np.log(total[at[seen]] / shorter[at[seen] - 1])
            shorter = total
        n_words = np.diff(counts)
        # Each text is summed on its own, so that its score doesn't depend on its neighbours.
        score = np.array([result[a:b].sum() for a, b in zip(counts.tolist(), counts[1:].tolist())])
        return pa.table({
            "doc_id": texts.column("doc_id"), "n_words": pa.array(n_words), "log_score": pa.array(score, pa.float64()),
        })

    scored = texts.mapInArrow(tidy(label), "piece long, doc_id long, text string").groupBy("piece").cogroup(
        totals.filter("piece IS NOT NULL").groupBy("piece")
    ).applyInArrow(tidy_group(summed), "doc_id long, n_words long, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
