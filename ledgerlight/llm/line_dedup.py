"""Fuzzy line deduplication: one line stays of each group of similar lines.

A line is compared in lower case (A to Z), trimmed, as the set of its character
shingles. One scan of the texts gives each line a 64-bit hash of its content, which stands for the
line from then on, and band keys of a 128-register MinHash: 22 bands of five, so lines of similarity 0.8 share
no bucket with a chance of 2e-4, of 0.9 with 3e-9. Equal lines have equal hashes and cost nothing below.
In small buckets all pairs are candidates, read off the rows in order of their keys; in larger ones they come by way of hubs (``hubs.py``). Only lines of at least 0.8 of each other's number of shingles meet (or whatever the similarity is).
They are first compared by 64 bytes: a line's parity sketch has a bit for each of 512 classes of shingles, set if the line holds an odd number of that class, so
two lines differ in at least as many shingles as bits, and no similar pair is lost. Two lines of 800 shingles or more are compared by a byte of each
of 64 registers, with five standard deviations to spare. What is left is confirmed on the full shingle
sets, which are made anew from the texts of the lines in such pairs. Components over the links are the groups. A changed character inside a line changes as many
shingles as one is long, so with nine characters a line needs 89 to stay similar, with five 49; shorter
shingles are so common in a language that unrelated lines fill the buckets, at no loss but of time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm.hubs import hub_members, link_members
from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import LOWER, NEWLINE, SPACE, Block, blocks, byte_values, lists, mix, prefix_sums, span_hashes

REGISTERS = 128
BANDS, ROWS = 22, 5
BLOCK_BYTES = 1 << 17
SKETCH_BYTES = 64
# Pairs of lines of so many different shingles each are estimated by registers: of longer ones unrelated parities differ no more than they may.
LONG = 800
# Buckets of so many lines are compared all with all.
SMALL = 8
# The bands are shuffled in so many steps, one after the other.
BAND_STEPS = 4
# Rows of one bucket that wait for its end; a longer bucket goes on as it comes.
OPEN_ROWS = 1 << 14
# Lines that are described at a time.
CHUNK = 4096
_NONE = np.uint64((1 << 64) - 1)
_UPPER = np.uint64(((1 << 40) - 1) << 24)

LEAST = -(1 << 63)  # stands for a missing id, which comes first

LINES = "id long, part long, line int, node long, n int, parities array<long>, registers array<long>, " + ", ".join(
    f"keys_{step} array<long>" for step in range(BAND_STEPS)
)
BUCKETS = "key long, a long, b long"

# Lower case, and every white space as a blank.
_PLAIN = LOWER.copy()
_PLAIN[SPACE] = 0x20


class Lines:
    """The lines of a block that hold a word and are long enough."""

    def __init__(self, block: Block, shingle: int, least_chars: int) -> None:
        data, self.shingle = _PLAIN[block.data], shingle
        feeds = np.flatnonzero(block.data == 0x0A)
        # A line begins with each text and behind each line feed.
        begins = np.unique(np.concatenate([block.bounds[:-1], feeds + 1]))
        over = block.bounds[np.searchsorted(block.bounds, begins, side="right").clip(max=len(block))]
        ends = np.minimum(np.append(feeds, len(data))[np.searchsorted(feeds, begins)], over)
        starts, ends = _trimmed(data, begins, ends)
        # Byte at which each character begins, and the characters of each line.
        self.characters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        plain = len(self.characters) == len(data) + 1
        begin, end = (starts, ends) if plain else (np.searchsorted(self.characters, starts), np.searchsorted(self.characters, ends))
        long = end - begin >= max(least_chars, 1)
        self.starts, self.ends, self.begin, self.end = starts[long], ends[long], begin[long], end[long]
        self.text = np.searchsorted(block.bounds, self.starts, side="right") - 1
        self.number = np.searchsorted(feeds, self.starts) - np.searchsorted(feeds, block.bounds[self.text])
        self.sums = prefix_sums(byte_values()[data])
        self.nodes = span_hashes(self.sums, self.starts, self.ends).view(np.int64)

    @cached_property
    def every(self) -> np.ndarray:
        """The hash of the shingle that begins with each character, over line feeds too."""
        return span_hashes(self.sums, self.characters[: -self.shingle], self.characters[self.shingle :])

    def shingles(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of the chosen lines, one line after the other, and how many each has."""
        begin, end = self.begin[chosen], self.end[chosen]
        size = np.minimum(self.shingle, end - begin)
        counts = end - begin - size + 1
        every = self.every
        shift = np.cumsum(counts) - counts
        at = np.repeat(begin - shift, counts)
        at += np.arange(len(at))
        short = np.flatnonzero(size < self.shingle)
        if not len(short):
            return every[at], counts
        at[shift[short]] = 0
        hashes = every[at] if len(every) else np.zeros(len(at), dtype=np.uint64)
        hashes[shift[short]] = span_hashes(self.sums, self.starts[chosen][short], self.ends[chosen][short])
        return hashes, counts


def _trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines without blanks around them, and without those of nothing but blanks."""
    held = starts < ends
    starts, ends = starts[held], ends[held]
    blank = np.flatnonzero((data[starts] == 0x20) | (data[ends - 1] == 0x20))
    if len(blank):
        words = np.flatnonzero(data != 0x20)
        first, last = np.searchsorted(words, starts[blank]), np.searchsorted(words, ends[blank])
        worded = first < last
        kept = np.ones(len(starts), dtype=bool)
        kept[blank[~worded]] = False
        blank, first, last = blank[worded], first[worded], last[worded]
        starts[blank], ends[blank] = words[first], words[last - 1] + 1
        starts, ends = starts[kept], ends[kept]
    return starts, ends


@lru_cache(maxsize=1)
def _orders() -> np.ndarray:
    """For each register, all registers in a fixed random order."""
    return np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(5)).reshape(REGISTERS, -1), axis=1)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Keys of each line's bands, one row per line."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(registers), 1))
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + registers[:, k : BANDS * ROWS : ROWS])
    return keys.view(np.int64)


def _lists_at(rows: np.ndarray, places: np.ndarray, n: int) -> pa.ListArray:
    """``n`` lists of longs: the rows at their places, elsewhere none."""
    counts = np.zeros(n, dtype=np.int64)
    counts[places] = rows.shape[1]
    return lists(np.ascontiguousarray(rows).reshape(-1), counts, pa.int64())


def _line_rows(shingle: int, least_chars: int, percent: int):
    """All lines; the first of equal ones in a block with its shingles' number, sketches and band keys."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()] + [pa.list_(pa.int64())] * (2 + BAND_STEPS)
    names = ["id", "part", "line", "node", "n", "parities", "registers"] + [f"keys_{step}" for step in range(BAND_STEPS)]
    held = pa.schema(list(zip(names, kinds, strict=True)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0), batch.column(1)
            for block in blocks(batch.column(2), BLOCK_BYTES):
                lines = Lines(block, shingle, least_chars)
                _, sample = np.unique(lines.nodes, return_index=True)
                sample.sort()
                n, parity, lowest, keys = described(lines, sample)
                sizes, total = np.zeros(len(lines.nodes), dtype=np.int32), len(lines.nodes)
                sizes[sample] = n
                short, long = 100 * LONG > percent * n, n >= LONG
                texts = pa.array(lines.text + block.first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(texts), parts.take(texts), pa.array(lines.number, pa.int32()), pa.array(lines.nodes), pa.array(sizes),
                     _lists_at(parity.view(np.int64)[short], sample[short], total), _lists_at(lowest.view(np.int64)[long], sample[long], total),
                     *[_lists_at(band, sample, total) for band in np.array_split(keys, BAND_STEPS, axis=1)]],
                    schema=held,
                )

    return rows


def registers_of(hashes: np.ndarray, counts: np.ndarray, sets: tuple[np.ndarray, np.uint64] | None = None) -> np.ndarray:
    """Smallest hash per register, one row per line; empty registers borrow from others in a fixed random order. ``sets`` are the lines' packed sets, if known."""
    n = len(counts)
    packed, bits = sets or packed_sets(np.repeat(np.arange(n), counts), hashes, n)
    registers = np.full((n, REGISTERS), _NONE)
    # Sets are in ascending order, so a register's hashes stand together. The same upper bits count in every block.
    place = packed >> (np.uint64(57) - bits)
    heads = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
    if len(heads):
        smallest = np.minimum.reduceat(mix(((packed << bits) & _UPPER) ^ np.uint64(0x2545F4914F6CDD1D)), heads)
        registers.reshape(-1)[place[heads].astype(np.int64)] = smallest
    empty = np.flatnonzero(registers.reshape(-1) == _NONE)
    full, orders = registers.reshape(-1).copy(), _orders()
    for step in range(REGISTERS):
        if not len(empty):
            break
        column = empty % REGISTERS
        found = full.take(empty - column + orders[:, step].take(column))
        registers.reshape(-1)[empty] = found
        empty = empty[found == _NONE]
    return registers


def packed_sets(numbers: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.uint64]:
    """Different hashes of each of ``n`` numbered sets, sorted, as the number above the hash's upper bits, and how many bits the number takes."""
    bits = np.uint64(max(1, n.bit_length()))
    packed = (numbers.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits)
    packed.sort()
    return packed[np.append(True, packed[1:] != packed[:-1])[: len(packed)]], bits


def sketches(
    hashes: np.ndarray, counts: np.ndarray, registers: np.ndarray, sets: tuple[np.ndarray, np.uint64] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of different shingles of each line, its parities, and its registers' lowest bytes."""
    lines, classes = len(counts), 8 * SKETCH_BYTES
    packed, bits = sets or packed_sets(np.repeat(np.arange(lines), counts), hashes, lines)
    # A class is the top nine bits of a hash, so its members stand together.
    place = (packed >> (np.uint64(55) - bits)).astype(np.int64)
    heads = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
    many = np.diff(np.append(heads, len(place)))
    n = np.bincount(place[heads] // classes, weights=many, minlength=lines).astype(np.int64)
    odd = place[heads[many % 2 == 1]]
    reach = np.searchsorted(odd, np.arange(0, (lines + CHUNK) * classes, CHUNK * classes))
    parity = np.zeros((lines, SKETCH_BYTES), dtype=np.uint8)
    for k, first in enumerate(range(0, lines, CHUNK)):
        last = min(first + CHUNK, lines)
        bit = np.zeros((last - first) * classes, dtype=bool)
        bit[odd[reach[k] : reach[k + 1]] - first * classes] = True
        parity[first:last] = np.packbits(bit.reshape(last - first, -1), axis=1)
    # The lowest byte; the top bits of small hashes are alike.
    return n, parity, (registers[:, :SKETCH_BYTES] & np.uint64(255)).astype(np.uint8)


def described(lines: Lines, chosen: np.ndarray) -> list[np.ndarray]:
    """Number of different shingles of each chosen line, its parities, its registers' lowest bytes and its band keys, some lines at a time."""
    parts = []
    for first in range(0, max(len(chosen), 1), CHUNK):
        hashes, counts = lines.shingles(chosen[first : first + CHUNK])
        sets = packed_sets(np.repeat(np.arange(len(counts)), counts), hashes, len(counts))
        registers = registers_of(hashes, counts, sets)
        parts.append((*sketches(hashes, counts, registers, sets), band_keys(registers)))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def room_by_parities(left: np.ndarray, right: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Of pairs of parities (one a row) of sets with ``total`` members together, those that may be similar enough."""
    # As many members as bits at least are in one set only: the sets share (total - bits) / 2 at most, their union is (total + bits) / 2 at least.
    bits = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    return (100 + percent) * bits <= (100 - percent) * total


def _estimating(percent: int):
    """Pairs that may be similar enough by their sketches and are near enough in size."""
    p = percent / 100
    agreeing = SKETCH_BYTES * (p - 5 * (p * (1 - p) / SKETCH_BYTES) ** 0.5)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(f"n_{s}").to_numpy().astype(np.int64) for s in "ab")
            long = np.minimum(n_a, n_b) >= LONG
            # A line without parities is too long for any shorter than LONG.
            kept = long | (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))
            for name, which in (("registers", long), ("parities", kept & ~long)):
                left, right = (
                    batch.column(f"{name}_{s}").filter(pa.array(which)).flatten().to_numpy().view(np.uint8).reshape(-1, SKETCH_BYTES) for s in "ab"
                )
                if name == "registers":
                    kept[which] = (left == right).sum(axis=1) >= agreeing
                else:
                    kept[which] = room_by_parities(left, right, (n_a + n_b)[which], percent)
            yield pa.RecordBatch.from_arrays([batch.column(s).filter(pa.array(kept)) for s in "ab"], names=["a", "b"])

    return rows


def _verifying(shingle: int, percent: int):
    """Pairs of lines whose full shingle sets are similar enough."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.concat_arrays([batch.column("content_a").cast(pa.large_string()), batch.column("content_b").cast(pa.large_string())])
            n = len(batch)
            similar = np.zeros(n, dtype=bool)
            # So many pairs at a time as their texts fill a block or two.
            width = np.asarray(pa.compute.binary_length(texts), dtype=np.int64)
            group = np.cumsum(width[:n] + width[n:]) // BLOCK_BYTES
            for g in np.unique(group):
                pairs = np.flatnonzero(group == g)
                sets = [packed_sets(*_shingles_of(texts.take(pa.array(pairs + shift)), shingle), len(pairs)) for shift in (0, n)]
                both = np.sort(np.concatenate([packed for packed, _ in sets]))
                pair = (both >> (np.uint64(64) - sets[0][1])).astype(np.int64)
                common = np.bincount(pair[1:][both[1:] == both[:-1]], minlength=len(pairs))
                total = np.bincount(pair, minlength=len(pairs))
                similar[pairs] = 100 * common >= percent * (total - common)
            kept = pa.array(similar)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    return rows


def _shingles_of(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each shingle of texts of one line each, and the shingles."""
    places, hashes = [], []
    for block in blocks(texts, BLOCK_BYTES):
        lines = Lines(block, shingle, 1)
        found, counts = lines.shingles(np.arange(len(lines.nodes)))
        hashes.append(found)
        places.append(np.repeat(lines.text + block.first, counts))
    return np.concatenate(places), np.concatenate(hashes)


class _Pairs:
    """Confirms candidate pairs of lines."""

    def __init__(self, own: DataFrame, lines: DataFrame, forms: DataFrame, shingle: int, percent: int, work: Workspace) -> None:
        self.own, self.lines, self.forms, self.shingle, self.percent, self.work = own, lines, forms, shingle, percent, work

    @staticmethod
    def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side in "ab":
            held = table.select(F.col("item").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            pairs = pairs.join(held, side)
        return pairs

    def _texts(self, pairs: DataFrame, name: str) -> DataFrame:
        """``(item, content)`` of all lines in pairs, from one place each."""
        items = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        places = self.lines.select(F.coalesce("id", F.lit(LEAST)).alias("k"), "part", "line", "node").join(items, "node", "left_semi")
        places = places.groupBy("node").agg(F.min(F.struct("k", "part", "line")).alias("place"))
        wanted = places.groupBy("place.k", "place.part").agg(F.collect_list(F.struct("place.line", "node")).alias("wanted"))
        wanted = self.work.write(wanted, f"{name}-wanted")
        found = self.own.withColumn("k", F.coalesce("id", F.lit(LEAST))).join(wanted, ["k", "part"])
        found = found.select(F.split("text", "\n").alias("split"), "wanted").select("split", F.explode("wanted").alias("w"))
        content = found.select(F.col("w.node").alias("item"), F.get("split", F.col("w.line")).alias("content"))
        return self.work.write(content.groupBy("item").agg(F.min("content").alias("content")), f"{name}-texts")

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of ``pairs(a, b)`` that are similar enough."""
        sized = self._sides(pairs, self.forms, "n", "parities", "registers")
        likely = self.work.write(map_batches(sized, _estimating(self.percent), "a long, b long"), f"{name}-likely")
        if likely.isEmpty():
            return likely
        full = self._sides(likely, self._texts(likely, name), "content").select("a", "b", "content_a", "content_b")
        links = self.work.write(map_batches(full, _verifying(self.shingle, self.percent), "a long, b long"), f"{name}-links")
        self.work.drop(f"{name}-wanted", f"{name}-texts")
        return links


def plausible(percent: int, left: str, right: str, n_left: str, n_right: str) -> Column:
    """The test of ``room_by_parities`` on columns; a line without parities may be similar to any."""
    bits = reduce(Column.__add__, [F.bit_count(F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))) for i in range(SKETCH_BYTES // 8)])
    return F.coalesce((100 + percent) * bits <= (100 - percent) * (F.col(n_left) + F.col(n_right)), F.lit(True))


def _shared(dealt: DataFrame, percent: int) -> DataFrame:
    """Of ``dealt(key, item, n)`` the rows in buckets of different lines, without those of two rows of unlike numbers of shingles."""
    numbers = [F.min("item").alias("low"), F.max("item").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("c")]
    wanted = dealt.groupBy("key").agg(*numbers).where(f"low < high AND (c > 2 OR 100L * least >= {percent} * most)")
    return dealt.join(wanted.select("key").hint("shuffle_hash"), "key")


def _bucket_rows(percent: int):
    """Rows in order of their key to the pairs of like numbers of shingles in small buckets, and the members of larger ones."""

    def settled(key: np.ndarray, item: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets."""
        if not len(key):
            return
        same = key[1:] == key[:-1]
        kept = np.append(same, False) | np.append(False, same)
        key, item, n = key[kept], item[kept], n[kept]
        order = np.lexsort((item, key))
        key, item, n = key[order], item[order], n[order]
        new = np.append(True, (key[1:] != key[:-1]) | (item[1:] != item[:-1]))[: len(key)]
        key, item, n = key[new], item[new], n[new]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        count = np.diff(np.append(heads, len(key)))
        large = np.repeat(count > SMALL, count)
        yield from members(key[large], item[large])
        left = np.repeat(np.where(count > SMALL, 0, heads + count), count) - np.arange(len(key))
        for step in range(1, SMALL):
            a = np.flatnonzero(left > step)
            b = a + step
            a, b = (x[(100 * n[a] >= percent * n[b]) & (100 * n[b] >= percent * n[a])] for x in (a, b))
            if len(a):
                yield made(key[a], item[a], item[b])

    def members(key: np.ndarray, item: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key):
            yield made(key, item, None)

    def made(key: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(a), other], names=["key", "a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, going = [np.zeros(0, dtype=np.int64)] * 3, None
        for batch in batches:
            if not len(batch):
                continue
            key, item, n = (np.concatenate([w, batch.column(c).to_numpy().astype(np.int64)]) for w, c in zip(waiting, ("key", "item", "n"), strict=True))
            # The last bucket may go on in the next batch; a very long one is large whatever comes.
            first = 0 if going is None else int(np.searchsorted(key, going, side="right"))
            last = int(np.searchsorted(key, key[-1]))
            yield from members(key[:first], item[:first])
            if first < len(key):
                going = None
                yield from settled(key[first:last], item[first:last], n[first:last])
                if len(key) - last > OPEN_ROWS:
                    going = key[-1]
                    yield from members(key[last:], item[last:])
                    last = len(key)
            waiting = [x[last if going is None else len(key) :] for x in (key, item, n)]
        yield from settled(*waiting)

    return rows


def first_places(places: DataFrame) -> DataFrame:
    """The first place of each group of ``places(group, k, part, line)``, and the number of places."""
    per_text = places.groupBy("group", "k", "part").agg(F.min("line").alias("line"), F.count("*").alias("c"))
    per_id = per_text.groupBy("group", "k").agg(F.min("part").alias("part"), F.min_by("line", "part").alias("line"), F.sum("c").alias("c"))
    return per_id.groupBy("group").agg(
        F.min("k").alias("k"), F.min_by("part", "k").alias("part"), F.min_by("line", "k").alias("line"), F.sum("c").alias("c")
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    shingle: int = 9,
    least_chars: int = 20,
) -> DataFrame:
    """All rows and columns, with similar lines removed from the text, and two columns more.

    Lines (between line feeds) are similar if their shingle sets share at least ``percent`` of their
    union; of a group the line that stands first stays, by id, then by the text's hash, then by place. A line
    shorter than a shingle is one shingle, so only its copies are similar. Lines without a word stay, and
    those shorter than ``least_chars`` characters; with 1 every line with a word takes part. ``_lines`` counts a text's lines and ``_removed`` those
    taken out. A null text stays null and has no lines. Rows that share id and text keep the same lines; a null
    id comes first. An empty table gives no rows; any other columns pass through, but for older ones of the two names.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lines")
    part = F.xxhash64(F.col(text_col))
    own = docs.select(F.col(id_col).cast("long").alias("id"), part.alias("part"), F.col(text_col).alias("text"))
    scanned = work.write(map_batches(own, _line_rows(shingle, least_chars, percent), LINES), "scanned")
    lines = work.write(scanned.select("id", "part", "line", "node"), "lines")
    first = scanned.where("n > 0")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = []
    for step in range(BAND_STEPS):
        keyed = first.select(F.explode(f"keys_{step}").alias("key"), F.col("node").alias("item"), "n")
        ordered = _shared(keyed.repartition(partitions, "key"), percent).sortWithinPartitions("key")
        steps.append(work.write(map_batches(ordered, _bucket_rows(percent), BUCKETS), f"buckets-{step}"))
    buckets = reduce(DataFrame.unionByName, steps)
    pairs = buckets.where("b IS NOT NULL").select("a", "b")
    shared = buckets.where("b IS NULL").select("key", F.col("a").alias("item")).distinct()
    # One row of each candidate line; equal lines have equal numbers and sketches.
    involved = buckets.select(F.explode(F.array("a", "b")).alias("item")).where("item IS NOT NULL").distinct()
    forms = first.select(F.col("node").alias("item"), F.col("n").cast("long").alias("n"), "parities", "registers").join(involved, "item", "left_semi")
    forms = work.write(forms.groupBy("item").agg(*[F.min(c).alias(c) for c in ("n", "parities", "registers")]), "forms")
    work.drop("scanned")
    # A partner has at most this many shingles; own members are not counted, as short shingles are seldom a line's own.
    top = F.floor(F.col("n") * 100 / percent)
    bounds = forms.select("item", "n", top.alias("top"), F.lit(0).cast("long").alias("own"))
    members = work.write(hub_members(shared, bounds), "members")
    check = _Pairs(own, lines, forms, shingle, percent, work)
    sketched = forms.select("item", F.col("parities").alias("sketch"))
    labels = link_members(members, check.links, work, sketched, partial(plausible, percent), also=pairs)

    placed = lines.select("id", "part", "line", "node").join(labels, "node", "left")
    placed = placed.select("id", "part", "line", F.coalesce("component", "node").alias("group"))
    placed = placed.withColumn("k", F.coalesce("id", F.lit(LEAST)))
    stays = first_places(placed).withColumnsRenamed({"k": "stays_k", "part": "stays_part", "line": "stays_line"})
    stays = work.write(stays.where("c > 1"), "stays")
    gone = placed.join(stays, "group")
    gone = gone.where("NOT (k = stays_k AND part = stays_part AND line = stays_line)")
    removed = gone.select("k", "part", "line").distinct().groupBy("k", "part").agg(F.collect_list("line").alias("gone"))
    removed = work.write(removed, "removed")
    work.keep("removed")

    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("k"),
        part.alias("part"),
    )
    # Split behind the join, so that a text travels once.
    joined = own.join(removed, ["k", "part"], "left").withColumn("split", F.split(F.col("row")[text_col], "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size("split") - 1), "gone")
    cut = F.array_join(F.transform(places, lambda i: F.get("split", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("row")[text_col]).otherwise(cut)
    kept = [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in ("_lines", "_removed")]
    return joined.select(
        *kept,
        F.coalesce(F.size("split"), F.lit(0)).cast("long").alias("_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_removed"),
    )
