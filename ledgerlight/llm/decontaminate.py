"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Texts are normalised to lower-case words joined by blanks. The automaton holds
every window of a benchmark item (13 words, or the item if shorter) as such a
string; one scan of a document gives all windows inside it, and word numbers
lead back to code points of the original text.

The automaton has to fit a worker, so it takes items up to a fixed number of
window characters; a larger benchmark is split into blocks of items, each scanned with an
automaton of its own, and the findings of a document are put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import LOWER, PUNCTUATION, blocks

# Benchmark characters (in windows) that one automaton takes: some tens of bytes each in memory.
AUTOMATON_CHARACTERS = 2_000_000

_TABLE = bytes(32 if PUNCTUATION[LOWER[b]] else int(LOWER[b]) for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

FOUND = (
    "id long, part long, n_words long, spans array<struct<first:int,last:int,begin:int,end:int>>, items array<long>"
)
_SPAN = pa.struct([(n, pa.int32()) for n in ("first", "last", "begin", "end")])


def normalised(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(_TABLE).split()


def windows(words: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def code_points(raw: bytes, runs: list[dict]) -> list[tuple[int, int]]:
    """Runs of words as spans of code points of the original text, ends excluded."""
    words = [m.span() for m in _WORD.finditer(raw.translate(bytes(LOWER)))]
    points = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    return [(int(points[words[r["first"]][0]]) - 1, int(points[words[r["last"]][1] - 1])) for r in runs]


def _scanner(patterns: dict[bytes, list[int]]):
    """patterns: the items of each window. One row per document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for window, items in patterns.items():
            automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
        automaton.make_automaton()
        for batch in batches:
            counts, spans, found = [], [], []
            for block in blocks(batch.column(2)):
                raw = block.data.tobytes()
                for a, b in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), strict=True):
                    words = raw[a:b].translate(_TABLE).split()
                    text = f" {b' '.join(words).decode('latin-1')} "
                    hits = list(automaton.iter(text)) if words and patterns else []
                    runs, items = [], set()
                    if hits:
                        # The blank that ends word k is the (k + 2)th of the text.
                        blanks = np.flatnonzero(np.frombuffer(text.encode("latin-1"), dtype=np.uint8) == 32)
                        last = np.searchsorted(blanks, [end for end, _ in hits]) - 1
                        first = last - [n for _, (n, _) in hits] + 1
                        for k in np.argsort(first, kind="stable").tolist():
                            if runs and first[k] <= runs[-1]["last"] + 1:
                                runs[-1]["last"] = max(runs[-1]["last"], int(last[k]))
                            else:
                                runs.append({"first": int(first[k]), "last": int(last[k])})
                        for _, (_, own) in hits:
                            items.update(own)
                        for run, (begin, end) in zip(runs, code_points(raw[a:b], runs), strict=True):
                            run |= {"begin": begin, "end": end}
                    counts.append(len(words))
                    spans.append(runs)
                    found.append(sorted(items))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(spans, pa.list_(_SPAN)),
                 pa.array(found, pa.list_(pa.int64()))],
                names=["id", "part", "n_words", "spans", "items"],
            )

    return scan


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int, characters: int) -> Iterator[dict[bytes, list[int]]]:
    """Windows and their items, in blocks whose size is bounded; an item longer than that is a block of its own."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    patterns, held = {}, 0
    for row in items.orderBy("item").toLocalIterator():
        own = set(windows(normalised(row["text"]), size))
        weight = sum(map(len, own))
        if patterns and held + weight > characters:
            yield patterns
            patterns, held = {}, 0
        for window in own:
            patterns.setdefault(window, []).append(row["item"])
        held += weight
    yield patterns


# Overlapping and touching spans of a document as one each.
JOINED_SPANS = """
aggregate(array_sort(spans), cast(array() as array<struct<first:int,last:int,begin:int,end:int>>), (done, s) ->
  CASE WHEN size(done) > 0 AND s.first <= element_at(done, -1).last + 1
       THEN concat(slice(done, 1, size(done) - 1), array(named_struct(
         'first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, s.last),
         'begin', element_at(done, -1).begin, 'end', greatest(element_at(done, -1).end, s.end))))
       ELSE concat(done, array(s)) END)
"""


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    one_in: int = 20,
    automaton_characters: int = AUTOMATON_CHARACTERS,
) -> DataFrame:
    """Per document: ``n_words``, hit words, the items found and the spans of hit words.

    ``spans`` count words from 0 (``first`` to ``last``) and give code points of the original text
    (``begin`` to before ``end``). ``contaminated``: at least one word in ``one_in`` is hit. Null or wordless
    texts and items hold no window; items without an id are ignored; rows that share an id are judged
    each on its own; an empty benchmark hits nothing. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.lit(0).cast("long").alias("part"), F.col(text_col).alias("text"))
    parts = benchmark_blocks(benchmark, item_col, item_text_col, window, automaton_characters)
    patterns, following = next(parts), next(parts, None)
    if following is None:
        found = map_batches(rows, _scanner(patterns), FOUND)
    else:
        # Rows of one document meet by id and text hash; a repeated row is counted off.
        rows = rows.withColumn("part", F.xxhash64("text"))
        work, scanned = Workspace(docs.sparkSession, "contamination"), []
        for k, patterns in enumerate(chain((patterns, following), parts)):
            scan = map_batches(rows, _scanner(patterns), FOUND).withColumn("block", F.lit(k))
            scanned.append(work.write(scan, f"block-{k}"))
        merged = reduce(DataFrame.unionByName, scanned).groupBy("id", "part").agg(
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.count_if(F.col("block") == 0).alias("copies"),
        )
        found = merged.withColumn("spans", F.expr(JOINED_SPANS)).withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        length.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        ((length > 0) & (one_in * length >= F.col("n_words"))).alias("contaminated"),
    )
