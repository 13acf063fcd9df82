"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

A document is the set of its distinct five-word shingles (64-bit hashes).

1. One scan gives each document's sketch: the hash's first bits pick one of 128 registers, which keeps
   the smallest remaining hash as its count of leading zeros and ten mantissa bits.
   Empty registers of short texts borrow from full ones along fixed random orders.
2. Documents with equal sets become one class, so copies cost nothing below.
3. Registers are banded, 25 bands of five: two sets of similarity 0.85 share no bucket with a chance of 4e-7.
4. Buckets are worked off from hubs (``hubs.py``): a group of n near copies costs about n comparisons, and no link
   between components is missed.
5. A pair is first estimated from the registers, corrected for accidental agreement and
   with five standard deviations to spare, then confirmed on the full sets.
6. Components over the links give each document its group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm.hubs import alike, hub_members, link_members, partner_bounds, shared_buckets
from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import SPACE, Block, blocks, lists, mix, owner, prefix_sums, span_hashes

REGISTERS = 128
MANTISSA = 10
BANDS, ROWS = 25, 5
_BITS = np.uint64(57)  # what is left of a hash when 7 bits pick the register

SIGNED = "id long, n long, k1 long, k2 long, registers binary"
SETS = "id long, k1 long, k2 long, shingles array<long>"


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in ascending order, and each text's first one (one more at the end)."""
    data = block.lowered()
    starts, ends, first = data.spans(SPACE)
    words = data.hashes(starts, ends)
    text = owner(first)
    position = np.arange(len(words))
    length = np.minimum(first[text + 1] - first[text], size)
    begins = np.flatnonzero(position + length <= first[text + 1])
    hashes = span_hashes(prefix_sums(words), begins, begins + length[begins])
    texts = text[begins]
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    return hashes[fresh], np.searchsorted(texts[fresh], np.arange(len(block) + 1))


@lru_cache(maxsize=1)
def _orders() -> np.ndarray:
    """For each register, all registers in a fixed random order."""
    return np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(77)).reshape(REGISTERS, -1), axis=1)


def sketches(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of each set (0 only where the set is empty)."""
    n = len(first) - 1
    registers = np.zeros((n, REGISTERS), dtype=np.uint16)
    if not len(hashes):
        return registers
    # Sets are in ascending order, so a register's hashes stand together.
    place = owner(first) * REGISTERS + (hashes >> _BITS).astype(np.int64)
    heads = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    smallest = np.minimum.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), heads) >> np.uint64(11)
    zeros = 53 - np.frexp(smallest.astype(np.float64))[1]
    mantissa = ((smallest << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    registers.reshape(-1)[place[heads]] = (zeros.astype(np.uint16) << MANTISSA) + mantissa.astype(np.uint16) + 1
    row, column = np.nonzero((registers == 0) & (registers.any(axis=1)[:, None]))
    full, orders = registers.copy(), _orders()
    for step in range(REGISTERS):
        if not len(row):
            break
        found = full[row, orders[column, step]]
        registers[row, column] = found
        row, column = row[found == 0], column[found == 0]
    return registers


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                hashes, first = shingle_sets(block, size)
                counts = np.diff(first)
                registers = sketches(hashes, first)
                padded = np.append(prefix_sums_plain(mix(hashes)), np.uint64(0))
                k1 = padded[first[1:]] - padded[first[:-1]]
                padded = np.append(prefix_sums_plain(mix(hashes + np.uint64(0xA0761D6478BD642F))), np.uint64(0))
                k2 = padded[first[1:]] - padded[first[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        pa.array(counts, pa.int64()),
                        pa.array(k1.view(np.int64)),
                        pa.array(k2.view(np.int64)),
                        pa.array([r.tobytes() if c else None for r, c in zip(registers, counts.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["id", "n", "k1", "k2", "registers"],
                )

    return sign


def prefix_sums_plain(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums


def _set_maker(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                hashes, first = shingle_sets(block, size)
                one, two = prefix_sums_plain(mix(hashes)), prefix_sums_plain(mix(hashes + np.uint64(0xA0761D6478BD642F)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, len(block)),
                        pa.array((one[first[1:]] - one[first[:-1]]).view(np.int64)),
                        pa.array((two[first[1:]] - two[first[:-1]]).view(np.int64)),
                        lists(hashes.view(np.int64), np.diff(first), pa.int64()),
                    ],
                    names=["id", "k1", "k2", "shingles"],
                )

    return make


def estimated(percent: int, ra: str, rb: str, na: str, nb: str) -> Column:
    """Whether registers leave room for the similarity: agreement without chance hits, with five deviations to spare."""
    places = F.sequence(F.lit(0), F.lit(REGISTERS - 1))
    agreeing = F.size(F.filter(places, lambda i: F.substring(ra, i * 2 + 1, F.lit(2)) == F.substring(rb, i * 2 + 1, F.lit(2))))
    # Expected share of chance hits of unequal registers for sets of such sizes.
    total = F.col(na) + F.col(nb)
    chance = 0.169919487 / (1 << MANTISSA) * 4 * F.col(na) * F.col(nb) / (total * total)
    estimate = (agreeing / float(REGISTERS) - chance) / (1 - chance)
    p = percent / 100
    return estimate >= p - 5 * (p * (1 - p) / REGISTERS) ** 0.5


def first_band(ra: str, rb: str, band: str) -> Column:
    """Whether registers agree in no band before ``band``."""
    width = 2 * ROWS
    before = F.sequence(F.lit(0), F.col(band) - 1)
    agrees = F.exists(before, lambda b: F.substring(ra, b * width + 1, F.lit(width)) == F.substring(rb, b * width + 1, F.lit(width)))
    return (F.col(band) == 0) | ~agrees


class _Pairs:
    """Estimates and confirms candidate pairs of classes."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> None:
        self.classes, self.sets, self.percent, self.work = classes, sets, percent, work

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of ``pairs(a, b)`` that are similar enough."""
        sides = {
            s: self.classes.select(F.col("rep").alias(s), F.col("n").alias(f"n{s}"), F.col("registers").alias(f"r{s}")) for s in "ab"
        }
        sized = pairs.join(sides["a"], "a").join(sides["b"], "b")
        sized = sized.where(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb")).where(
            estimated(self.percent, "ra", "rb", "na", "nb")
        )
        likely = self.work.write(sized.select("a", "b").distinct(), f"{name}-likely")
        return self.confirmed(likely, name)

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        return self.work.write(alike(self.sets, pairs, self.percent), f"{name}-links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id of its group) and ``kept`` (that one).

    Two documents are linked if their shingle sets share at least ``percent`` of their union. A text with fewer words than
    ``size`` is one shingle; null, empty and wordless texts have none and are linked with nothing. Rows
    that share an id are one document. A row without an id is on its own: its component is null and it is kept. An empty table gives no rows;
    other columns are ignored.
    """
    work = Workspace(docs.sparkSession, "near-duplicates")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = work.write(map_batches(own, _signer(size), SIGNED), "signed")
    held = signed.where("n > 0 AND id IS NOT NULL")
    smallest = held.groupBy("k1", "k2").agg(F.min("id").alias("id"))
    classes = work.write(
        held.join(smallest, ["k1", "k2", "id"], "left_semi").distinct().select(F.col("id").alias("rep"), "k1", "k2", "n", "registers"), "classes"
    )
    keys = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(registers, b * {2 * ROWS} + 1, {2 * ROWS})))")
    bands = classes.select(F.col("rep").alias("item"), F.posexplode(keys).alias("band", "key")).select("key", "item", "band")
    shared = work.write(shared_buckets(bands).distinct(), "shared")
    involved = shared.select(F.col("item").alias("id")).distinct()
    sets = map_batches(own.join(involved, "id", "left_semi"), _set_maker(size), SETS)
    wanted = classes.select(F.col("rep").alias("id"), "k1", "k2")
    sets = sets.join(wanted, ["id", "k1", "k2"], "left_semi").distinct()
    sets = work.write(sets.select(F.col("id").alias("item"), F.col("shingles").alias("members")), "sets")
    bounds = work.write(partner_bounds(sets, percent), "bounds")
    members = work.write(hub_members(shared, bounds).distinct(), "members")
    registers = classes.select(F.col("rep").alias("item"), F.col("registers").alias("sketch")).join(involved.withColumnRenamed("id", "item"), "item", "left_semi")
    registers = work.write(registers.dropDuplicates(["item"]), "registers")
    check = _Pairs(classes, sets, percent, work)
    labels = link_members(members, check.links, work, registers, partial(estimated, percent), first_band, check.confirmed)
    groups = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component_id")
    )
    groups = groups.groupBy("k1", "k2").agg(F.min("component_id").alias("component_id"))
    judged = signed.select("id", "n", "k1", "k2").join(groups, ["k1", "k2"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return judged.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
