"""Ranked lexical search by dense blocked matrix multiplication.

Scores are whole numbers: a term's weight times a document's impact for it,
summed over the terms of an item. One scan of the texts keeps, per document, its length and how often it
holds each term of the items. From these come the counts over all documents,
and with them weights and impacts.

The sums are matrix products: items by vocabulary times vocabulary by documents, in tiles.
A document tile holds some hundreds of documents; an item tile some hundreds of items and the
vocabulary that both sides have, cut into pieces. Products run in float64 (BLAS). A piece is narrow
enough that no partial sum reaches 2**53, so each is an exact integer; the pieces of a tile
are added in 64-bit integers.

Each tile's best documents are chosen by a cutoff that keeps everything equal to the last
place, then by score and id, so ties end as in a sort of all documents. A task carries the best of its tiles along; the
tasks' lists are merged by salted windows, so no item gathers its rows in one task at once.

Items are the query set. A pass takes items with up to a fixed number of terms, which bounds vocabulary, weights
and lists in driver and workers; more items mean more passes, each of which has that much matrix work per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import PUNCTUATION, blocks, owner

# Terms of items (an item's terms once each), and items, that one pass takes.
PASS_TERMS = 1_000_000
PASS_ITEMS = 50_000

ITEM_TILE, DOCUMENT_TILE, VOCABULARY_TILE = 256, 512, 4096
EXACT = 1 << 53
# Impacts are below this: (SCALE * tf) div (1000 * tf + 8 * m).
SCALE, LARGEST_IMPACT = 1_000_000_000, 1_000_000
SALTS = 32

TERMS = "item long, term long"
POSTINGS = "id long, n long, terms binary, counts binary"
FOUND = "item long, score long, id long, no_id boolean"


def term_hashes(block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a block's texts, and each text's first one (one more at the end)."""
    lowered = block.lowered()
    starts, ends, first = lowered.spans(PUNCTUATION)
    return lowered.hashes(starts, ends).view(np.int64), first


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            terms, first = term_hashes(block)
            items = batch.column(0).take(pa.array(owner(first) + block.first))
            yield pa.RecordBatch.from_arrays([items, pa.array(terms)], names=["item", "term"])


def _postings(vocabulary: np.ndarray):
    """vocabulary: the hashes of the terms in ascending order; a term's number is its place there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary)
        for batch in batches:
            for block in blocks(batch.column(1)):
                terms, first = term_hashes(block)
                number = np.searchsorted(vocabulary, terms)
                known = np.flatnonzero(vocabulary[np.minimum(number, size - 1)] == terms)
                places, counts = np.unique(owner(first)[known] * size + number[known], return_counts=True)
                numbers, counts = (places % size).astype("<u4"), counts.astype("<u4")
                edges = np.searchsorted(places, np.arange(len(block) + 1) * size).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([numbers[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                        pa.array([counts[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                    ],
                    names=["id", "n", "terms", "counts"],
                )

    return rows


def _joined(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, counts = np.unique(_joined(batch.column(0)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(counts, pa.int64())], names=["number", "df"])


class Queries:
    """The items of a pass: which terms each has (numbers, ascending by item), and the terms' weights."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> None:
        self.ids, self.first, self.numbers, self.weights = ids, first, numbers, weights
        # So wide a piece of the vocabulary keeps any partial sum below 2**53.
        largest = int(weights.max(initial=1)) * LARGEST_IMPACT
        self.width = max(1, min(VOCABULARY_TILE, (EXACT - 1) // max(largest, 1)))

    def tiles(self) -> Iterator[tuple[int, int]]:
        for a in range(0, len(self.ids), ITEM_TILE):
            yield a, min(a + ITEM_TILE, len(self.ids))

    def scores(self, a: int, b: int, held: np.ndarray, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
        """Items a to b by documents. ``held``: the terms the documents have; ``rows``: place in it, ``columns``: document, of each impact."""
        numbers = self.numbers[self.first[a] : self.first[b]]
        item = np.repeat(np.arange(b - a), np.diff(self.first[a : b + 1]))
        # The compact vocabulary: terms that items and documents of these tiles share.
        shared = np.intersect1d(numbers, held)
        total = np.zeros((b - a, n_docs), dtype=np.int64)
        if not len(shared):
            return total
        of_item = np.searchsorted(shared, numbers)
        fits = shared[np.minimum(of_item, len(shared) - 1)] == numbers
        item, of_item, weight = item[fits], of_item[fits], self.weights[numbers[fits]]
        place = np.searchsorted(shared, held)
        place = np.where(shared[np.minimum(place, len(shared) - 1)] == held, place, -1)[rows]
        for low in range(0, len(shared), self.width):
            high = min(low + self.width, len(shared))
            left = np.zeros((b - a, high - low))
            chosen = (of_item >= low) & (of_item < high)
            left[item[chosen], of_item[chosen] - low] = weight[chosen]
            right = np.zeros((high - low, n_docs))
            chosen = (place >= low) & (place < high)
            right[place[chosen] - low, columns[chosen]] = impacts[chosen]
            total += (left @ right).astype(np.int64)
        return total


class Best:
    """The k best documents of each item so far."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.cutoff = np.ones(n_items, dtype=np.int64)
        self.item = np.zeros(0, dtype=np.int64)
        self.score, self.id, self.no_id = self.item, self.item, np.zeros(0, dtype=bool)

    def add(self, a: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: items from a on, by documents."""
        cutoff = self.cutoff[a : a + len(scores)]
        if scores.shape[1] > self.k:
            cutoff = np.maximum(cutoff, np.partition(scores, -self.k, axis=1)[:, -self.k])
        # All that reach the last place stay, so a tie is not decided by the order of tiles.
        item, column = np.nonzero(scores >= cutoff[:, None])
        if not len(item):
            return
        found = (item + a, scores[item, column], ids[column], no_id[column])
        item, score, id, no_id = (np.concatenate(x) for x in zip((self.item, self.score, self.id, self.no_id), found))
        order = np.lexsort((id, no_id, -score, item))
        item, score, id, no_id = item[order], score[order], id[order], no_id[order]
        heads = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        rank = np.arange(len(item)) - np.repeat(heads, np.diff(np.append(heads, len(item))))
        stays = rank < self.k
        last = rank == self.k - 1
        self.cutoff[item[last]] = score[last]
        self.item, self.score, self.id, self.no_id = item[stays], score[stays], id[stays], no_id[stays]


def impacts_of(tf: np.ndarray, n: np.ndarray, documents: int, length: int, b: int) -> np.ndarray:
    """Impact of each (document, term): ``n`` is the document's terms; 64-bit integers, rounded down."""
    if int(n.max(initial=0)) * b * documents < 1 << 63:
        m = 100 - b + (b * n * documents) // length
    else:
        m = np.array([100 - b + b * int(x) * documents // length for x in n], dtype=np.int64)
    return (SCALE * tf) // (1000 * tf + 8 * m)


def _searcher(queries: Queries, documents: int, length: int, k: int, b: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(queries.ids), k)
        for batch in batches:
            for a in range(0, len(batch), DOCUMENT_TILE):
                part = batch.slice(a, DOCUMENT_TILE)
                sizes = np.array([len(x) // 4 for x in part.column("terms").to_pylist()], dtype=np.int64)
                terms, tf = _joined(part.column("terms")), _joined(part.column("counts"))
                column = np.repeat(np.arange(len(part)), sizes)
                impact = impacts_of(tf, part.column("n").to_numpy()[column], documents, length, b)
                held, row = np.unique(terms, return_inverse=True)
                no_id = part.column("id").is_null().to_numpy(zero_copy_only=False)
                ids = part.column("id").fill_null(0).to_numpy()
                for low, high in queries.tiles():
                    scores = queries.scores(low, high, held, row, column, impact, len(part))
                    best.add(low, scores, ids, no_id)
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries.ids[best.item]), pa.array(best.score), pa.array(best.id), pa.array(best.no_id)],
            names=["item", "score", "id", "no_id"],
        )

    return search


def _numbers(table: DataFrame, *columns: str) -> list[np.ndarray]:
    """Columns of a table whose size is bounded, as arrays."""
    held = table.select(*columns).toArrow()
    return [held.column(c).to_numpy() for c in columns]


def _pass(spark, docs: DataFrame, items: DataFrame, work: Workspace, name: str, k: int, b: int) -> DataFrame:
    """The lists of one pass, merged over tasks as far as salted windows go."""
    item, term = _numbers(items, "item", "term")
    vocabulary, number = np.unique(term, return_inverse=True)
    order = np.lexsort((number, item))
    item, number = item[order], number[order]
    ids, first = np.unique(item, return_index=True)
    postings = work.write(map_batches(docs, _postings(vocabulary), POSTINGS), f"{name}-postings")
    held = postings.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    documents, length = held["documents"], max(held["length"], 1)
    frequencies = map_batches(postings.select("terms").where("length(terms) > 0"), _frequencies, "number long, df long")
    frequencies = frequencies.groupBy("number").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2) / (F.lit(2.0) * F.col("df") + 1)))
    at, weights = _numbers(frequencies.select("number", weight.cast("long").alias("weight")), "number", "weight")
    all_weights = np.zeros(len(vocabulary), dtype=np.int64)
    all_weights[at] = weights
    queries = Queries(ids, np.append(first, len(item)), number, all_weights)
    search = _searcher(queries, documents, length, k, b)
    found = map_batches(postings.where("length(terms) > 0"), search, FOUND)
    places = [F.col("score").desc(), F.col("no_id"), F.col("id")]
    salted = Window.partitionBy("item", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy(*places)
    return work.write(found.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k), f"{name}-found")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    b: int = 90,
    pass_terms: int = PASS_TERMS,
    pass_items: int = PASS_ITEMS,
) -> DataFrame:
    """Per item its ``k`` best documents: item id, ``rank`` from 1, document id and ``score``.

    Terms are runs of letters, digits and characters beyond ASCII, A to Z lowered. With N documents that hold a term,
    L terms in them, a document's n terms and a term's df documents and tf occurrences: weight w = floor(1000 ln((2N + 2) / (2df + 1))),
    m = 100 - b + (b n N) div L, score = sum of w ((10**9 tf) div (1000 tf + 8m)) over the item's distinct terms.

    Equal scores go by ascending id; a null id comes after all others. Null and wordless texts
    count nowhere and are never found. Rows that share a document id are documents of their own; rows that share an item id are
    one item with the terms of all; items without an id or a term give no rows, nor do empty tables. Texts
    count whole, whatever their length. Other columns are ignored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lexical-search")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    terms = work.write(map_batches(asked, _item_terms, TERMS).distinct(), "item-terms")
    size = terms.agg(F.count("*").alias("terms"), F.count_distinct("item").alias("items")).first()
    passes = max(1, -(-size["terms"] // pass_terms), -(-size["items"] // pass_items))
    found = []
    for turn in range(passes):
        part = terms.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == turn)
        if not part.isEmpty():
            found.append(_pass(spark, own, part, work, f"pass-{turn}", k, b))
    if not found:
        return terms.limit(0).select(
            F.col("item").alias(item_col), F.lit(0).alias("rank"), F.col("term").alias(id_col), F.col("term").alias("score")
        )
    lists = reduce(DataFrame.unionByName, found)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("no_id"), F.col("id"))
    ranked = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(
        F.col("item").alias(item_col),
        "rank",
        F.when(~F.col("no_id"), F.col("id")).alias(id_col),
        "score",
    )
