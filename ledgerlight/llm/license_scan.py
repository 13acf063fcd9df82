"""Licence statements in documents, by diagonal voting.

Templates are wordings of licences. Every window of three words of a text is hashed
and joined to the places where a template holds the same words. Text position minus template
position is the diagonal; a statement's windows vote for one diagonal, or for
neighbouring ones where words were put in or left out, so neighbours are merged.
Spans with enough votes are verified against the template's words in order; of overlapping ones the best stays.

A test against the templates' hashes keeps windows that join nothing from becoming rows; the second
scan, which verifies, meets each text with its spans by id and text hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.llm.decontaminate import normalised
from ledgerlight.llm.license_texts import PHRASES, TEMPLATES
from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import PUNCTUATION, blocks, grams, owner

BROADCAST_WORDS = 100_000  # template positions that every executor may hold

HITS = "id long, name long, gram long, position int"
FOUND = (
    "id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "spans array<struct<label:string,first:int,last:int,score:double>>"
)
_SPAN = pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])


def template_grams(templates: list[tuple[str, str]], k: int) -> list[tuple[int, int, int]]:
    """(hash, template, position) of every window; a template of fewer words has none."""
    rows = []
    for block in blocks(pa.array([text for _, text in templates])):
        block = block.lowered()
        starts, ends, first = block.spans(PUNCTUATION)
        at, hashes = grams(block.hashes(starts, ends), first, k)
        text = owner(first)[at]
        rows += zip(hashes.view(np.int64).tolist(), (text + block.first).tolist(), (at - first[text]).tolist(), strict=True)
    return rows


def _hit_finder(known: np.ndarray, k: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                block = block.lowered()
                starts, ends, first = block.spans(PUNCTUATION)
                at, hashes = grams(block.hashes(starts, ends), first, k)
                hashes = hashes.view(np.int64)
                place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                hit = known[place] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
                text = owner(first)[at[hit]]
                rows = pa.array(text + block.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(hashes[hit]), pa.array((at[hit] - first[text]).astype(np.int32))],
                    names=["id", "name", "gram", "position"],
                )

    return find


def base_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> tuple[list[int], set[str]]:
    places, labels = [], set()
    present = set(words)
    for phrase, label in phrases:
        if present.issuperset(phrase):
            at = [i for i, w in enumerate(words) if w == phrase[0] and words[i : i + len(phrase)] == phrase]
            if at:
                places += at
                labels.add(label)
    return places, labels


def verified(words: list[bytes], template: list[bytes], low: int, high: int) -> tuple[int, int, float]:
    """First and last matching word of the span on diagonals low to high, and the score.

    That is the number of words matched in order, over those of the template or the span, whichever has more.
    """
    begin, end = max(low, 0), min(high + len(template), len(words))
    found = [m for m in SequenceMatcher(None, words[begin:end], template, autojunk=False).get_matching_blocks() if m.size]
    if not found:
        return begin, begin, 0.0
    first, last = found[0].a, found[-1].a + found[-1].size - 1
    return begin + first, begin + last, sum(m.size for m in found) / max(len(template), last - first + 1)


def best_apart(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of spans that overlap only the one with the highest score; at equal scores the longer, then the earlier."""
    chosen: list[tuple[str, int, int, float]] = []
    for span in sorted(set(spans), key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        if all(span[2] < other[1] or other[2] < span[1] for other in chosen):
            chosen.append(span)
    return sorted(chosen, key=lambda s: s[1])


def _verifier(templates: list[tuple[str, str]], phrases: list[tuple[str, str]], least_score: float):
    wordings = [(label, normalised(text)) for label, text in templates]
    named = [(normalised(phrase), label) for phrase, label in phrases]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "spans")}
            for text, candidates in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = normalised(text.as_buffer().to_pybytes()) if text.is_valid else []
                places, labels = base_places(words, named)
                spans = []
                for c in candidates or ():
                    label, template = wordings[c["template"]]
                    first, last, score = verified(words, template, c["low"], c["high"])
                    if score >= least_score:
                        spans.append((label, first, last, score))
                columns["n_words"].append(len(words))
                columns["n_base"].append(len(places))
                columns["first_word"].append(min(places, default=None))
                columns["last_word"].append(max(places, default=None))
                columns["base_labels"].append(sorted(labels))
                columns["spans"].append([dict(zip(("label", "first", "last", "score"), s, strict=True)) for s in best_apart(spans)])
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.list_(_SPAN)]
            arrays = [pa.array(v, kind) for v, kind in zip(columns.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *columns])

    return verify


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: list[tuple[str, str]] = PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 3,
    gap: int = 2,
    least_votes: float = 0.4,
    least_score: float = 0.75,
) -> DataFrame:
    """Per row: word count, places of the phrases, their labels, and the verified spans with label and score.

    Diagonals up to ``gap`` apart are merged; a span needs votes from ``least_votes`` of its template's windows
    and a score of ``least_score``. Words are lower case (A to Z). A null or empty text has no words, places or spans;
    rows that share an id are scanned each on its own, repeated rows alike; an empty table gives no
    rows; other columns are ignored.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "licenses")
    places = template_grams(templates, k)
    known = np.unique(np.array([g for g, _, _ in places], dtype=np.int64))
    windows = spark.createDataFrame(places, "gram long, template int, at int")
    sizes = {t: sum(1 for _, u, _ in places if u == t) for t in range(len(templates))}
    needed = F.element_at(F.create_map(*[F.lit(x) for t, n in sizes.items() for x in (t, max(1.0, least_votes * n))]), F.col("template"))
    if len(places) <= BROADCAST_WORDS:
        windows = F.broadcast(windows)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("name"), F.col(text_col).alias("text"))
    hits = map_batches(own, _hit_finder(known, k), HITS).distinct()
    votes = hits.join(windows, "gram").groupBy("id", "name", "template", (F.col("position") - F.col("at")).alias("diagonal")).agg(F.count("*").alias("votes"))
    along = Window.partitionBy("id", "name", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > gap, F.lit(True))
    merged = votes.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(along))
    spans = merged.groupBy("id", "name", "template", "span").agg(
        F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high")
    )
    spans = spans.where(F.col("votes") >= needed)
    candidates = spans.groupBy("id", "name").agg(F.collect_list(F.struct("template", "low", "high")).alias("candidates"))
    candidates = work.write(candidates.withColumnsRenamed({"id": "own_id", "name": "own_name"}), "candidates")
    joined = own.join(candidates, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("name") == F.col("own_name")), "left")
    found = map_batches(joined.select("id", "text", "candidates"), _verifier(templates, phrases, least_score), FOUND)
    return found.withColumnsRenamed({"id": id_col})
