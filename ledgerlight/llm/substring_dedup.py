"""Passages that stand more than once in a corpus, found from difference-cover anchors.

A window is a run of W words. Residues D modulo a period v form a difference cover: for any two positions
i and j some shift s < v takes both to sampled positions, (i + s) mod v and (j + s) mod v in D. So two equal
windows share an aligned anchor of W - v + 1 words, and it is enough to hash anchors at sampled positions
(5 of 21).

1. Anchors that stand at two places or more are found by their hashes.
2. They extend to candidates: the windows that hold such an anchor. Only these are
   hashed in full, and those that stand at two places or more are the repeats.
3. The words they cover are removed.

A place is a text and a word number. Texts that are copies of each other are one
text until the end, where they go as a whole. Within a block of texts a hash that stands many times
is sent twice and its other places are marked on the spot, so a passage in a third of all
documents stays a small group. Equality of windows is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import SPACE, blocks, owner, prefix_sums, span_hashes

# Perfect difference sets, by period.
COVERS = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (1, 5, 11, 24, 25, 27)}

PLACES = "hash long, text long, position int"


def period_for(window: int) -> int:
    """The largest period that leaves anchors of at least two fifths of a window."""
    return max((v for v in COVERS if window - v + 1 >= 0.4 * window), default=1)


def _place_batch(texts: np.ndarray, hashes: np.ndarray, positions: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
    """Rows of hash and place; of a hash's places in the block two carry it, the others are known repeats."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    turn = np.arange(len(ranked)) - np.repeat(heads, np.diff(np.append(heads, len(ranked))))
    known = np.zeros(len(hashes), dtype=bool)
    known[order] = turn >= 2
    return pa.RecordBatch.from_arrays(
        [pa.array(hashes.view(np.int64), pa.int64(), mask=known), pa.array(texts[text]), pa.array(positions.astype(np.int32))],
        names=["hash", "text", "position"],
    )


def _anchors(window: int, period: int):
    cover = np.isin(np.arange(period), COVERS.get(period, (0,)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                texts = names[block.first : block.first + len(block)]
                first_copy = np.zeros(len(block), dtype=bool)
                first_copy[np.unique(texts, return_index=True)[1]] = True
                starts, ends, first = block.spans(SPACE)
                words = block.hashes(starts, ends)
                text = owner(first)
                position = np.arange(len(words)) - first[text]
                length = (first[1:] - first[:-1])[text]
                at = np.flatnonzero((position + window - period + 1 <= length) & (length >= window) & first_copy[text] & cover[position % period])
                hashes = span_hashes(prefix_sums(words), at, at + window - period + 1)
                yield _place_batch(texts, hashes, position[at], text[at])

    return find


def _candidates(window: int, period: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, anchors = batch.column(0).to_numpy(), batch.column(2)
            for block in blocks(batch.column(1)):
                starts, ends, first = block.spans(SPACE)
                words = block.hashes(starts, ends)
                own = anchors.slice(block.first, len(block))
                counts = own.value_lengths().to_numpy()
                at = own.flatten().to_numpy() + np.repeat(first[:-1], counts)
                # An anchor lies in the windows that begin up to period - 1 words before it.
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, np.maximum(at - period + 1, np.repeat(first[:-1], counts)), 1)
                np.add.at(change, at + 1, -1)
                text = owner(first)
                begins = np.flatnonzero((np.cumsum(change[:-1]) > 0) & (np.arange(len(words)) + window <= first[1:][text]))
                hashes = span_hashes(prefix_sums(words), begins, begins + window)
                yield _place_batch(names[block.first : block.first + len(block)], hashes, begins - first[text[begins]], text[begins])

    return find


def _remover(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks, whole = batch.column(1), batch.column(2), batch.column(3)
            counts, removed, kept = [], [], []
            for text, mark, copied in zip(texts, marks, whole, strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n = len(words)
                if copied.as_py() and n >= window:
                    gone = np.ones(n, dtype=bool)
                elif mark.is_valid:
                    change = np.zeros(n + 1, dtype=np.int64)
                    at = mark.values.to_numpy()
                    np.add.at(change, at, 1)
                    np.add.at(change, at + window, -1)
                    gone = np.cumsum(change[:-1]) > 0
                else:
                    gone = np.zeros(n, dtype=bool)
                counts.append(n)
                removed.append(int(gone.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()] if gone.any() else words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "text"],
            )

    return remove


def repeated_places(places: DataFrame, partitions: int) -> DataFrame:
    """``(text, position)`` of the hashes that stand at two different places or more, and of the known repeats."""
    dealt = places.where("hash IS NOT NULL").repartition(partitions, "hash")
    place = F.xxhash64("text", "position")
    often = dealt.groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high")
    found = dealt.join(often.select("hash").hint("shuffle_hash"), "hash").select("text", "position")
    return found.unionByName(places.where("hash IS NULL").select("text", "position"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed`` and the kept words joined by blanks (``text``).

    A word goes if it lies in a run of ``window`` words that also begins anywhere else, in this text or another.
    Null, empty and shorter texts lose nothing; rows that share an id are texts of their own, repeated rows are
    copies of each other; a null id is an id. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    work, period = Workspace(spark, "repeats"), period_for(window)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("name"), F.col(text_col).alias("text"))
    # Texts with the same two hashes and length are copies.
    rows = work.write(own.where("text IS NOT NULL").select("id", "name", F.hash("text").alias("second"), F.length("text").alias("length")), "rows")
    classes = rows.groupBy("name", "second", "length").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = work.write(classes, "classes")

    anchors = map_batches(own.select("name", "text"), _anchors(window, period), PLACES)
    repeated = repeated_places(anchors, partitions).groupBy("text").agg(F.collect_set("position").alias("anchors"))
    repeated = work.write(repeated.withColumnRenamed("text", "name"), "anchors")
    one_each = classes.select("name", "id").join(repeated, "name").withColumnRenamed("id", "first_id")
    chosen = own.join(one_each.withColumnRenamed("name", "first_name"), (F.col("name") == F.col("first_name")) & F.col("id").eqNullSafe(F.col("first_id")))
    windows = map_batches(chosen.select("name", "text", "anchors"), _candidates(window, period), PLACES)
    marks = repeated_places(windows, partitions).groupBy("text").agg(F.collect_set("position").alias("marks"))
    marks = work.write(marks.withColumnRenamed("text", "name"), "windows")

    whole = rows.join(classes.where("copies > 1").drop("id"), ["name", "second", "length"]).select(
        "id", "name", F.lit(None).cast("array<int>").alias("marks"), F.lit(True).alias("whole")
    )
    part = classes.where("copies = 1").select("id", "name").join(marks, "name").select("id", "name", "marks", F.lit(False).alias("whole"))
    decided = whole.distinct().unionByName(part).withColumnsRenamed({"id": "own_id", "name": "own_name"})
    decided = work.write(decided, "decided")
    judged = own.join(decided, (F.col("name") == F.col("own_name")) & F.col("id").eqNullSafe(F.col("own_id")), "left")
    judged = judged.select("id", "text", "marks", F.coalesce("whole", F.lit(False)).alias("whole"))
    result = map_batches(judged, _remover(window), "id long, n_words long, n_removed long, text string")
    return result.withColumnsRenamed({"id": id_col})
