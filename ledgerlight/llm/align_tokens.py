"""Alignment of two tokenizers over the same texts, by divide and conquer at shared cuts.

A text's tokens by both tokenizers cover the same bytes. An offset at which a token
of each ends is a shared cut. An interval of a text is divided at the shared cut nearest to its
middle: the first tokenizer's end next to the middle byte is found by bisect, and if the other has
no end there, its neighbours to the left and right follow in turn; a bisect gives the place among the other's ends. Both halves are treated alike; an interval without a shared cut inside is a group. All intervals
of a block of texts go down level by level together, as numpy arrays.

Two tokens are linked if their bytes overlap. How often two ids are linked is counted over all
texts: each block of texts lists its distinct id pairs with counts, Spark adds these up, marks the most frequent partner(s)
of each second id, and the sums return to the blocks by a join on the id pair, so neither
driver nor worker holds more than one block's pairs.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.text_arrays import Block, blocks
from ledgerlight.llm.tokens import vocabulary

# A block and what is made of it are held several times over by each of an executor's workers.
BLOCK_BYTES = 512 << 10
# New words are encoded in texts of about so many bytes.
JOINED_BYTES = 16 << 10

# Kinds of bytes: 1 printable ASCII; 2 the first of a Latin character of two bytes, none of which is white space or a
# joining mark; 4 blank or line feed.
_KINDS = np.zeros(256, dtype=np.uint8)
_KINDS[0x21:0x7F] = 1
_KINDS[[0xC3, 0xC4, 0xC5]] = 2
_KINDS[[0x20, 0x0A]] = 4

BLOCKS = (
    "block long, ids array<long>, n_a array<int>, n_b array<int>, a binary, b binary, pairs array<long>, counts array<long>"
)
ALIGNED = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"

_LETTERS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _bytes_of_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones themselves, the rest from U+0100 on."""
    letters = {chr(b): b for b in _LETTERS}
    others = [b for b in range(256) if b not in _LETTERS]
    return letters | {chr(0x100 + k): b for k, b in enumerate(others)}


class TokenBytes:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.widths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.widths) - self.widths
        self.pool = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        shift = self.starts[ids] - (ends - widths)
        return self.pool[np.repeat(shift, widths) + np.arange(ends[-1] if len(ends) else 0)]


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library; special tokens in a text are plain text."""

    def __init__(self, name: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary(name))
        self.library.encode_special_tokens = True
        letters = _bytes_of_letters()
        tokens = [b""] * self.library.get_vocab_size()
        for token, number in self.library.get_vocab().items():
            tokens[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes = TokenBytes(tokens)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model.

    Where no piece of the model holds a blank behind another character or a line feed, no piece crosses from a word to the
    blank or line feed after it, and texts may be cut there (``separable``).
    """

    def __init__(self, name: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.model = SentencePieceProcessor(model_file=vocabulary(name))
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        surfaces = [p.piece for p in proto.pieces]
        inside = any("▁" in s.lstrip("▁") or "\n" in s for s in surfaces)
        rules = proto.normalizer_spec
        as_is = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.add_dummy_prefix
        self.separable = as_is and not inside
        self.blank = self.model.piece_to_id("▁")
        self.bytes = TokenBytes([
            bytes([int(s[3:5], 16)]) if self.model.is_byte(k) else s.replace("▁", " ").encode() for k, s in enumerate(surfaces)
        ])

    def ids(self, texts: list[str]) -> list[list[int]]:
        """The model puts a blank before each text: it stands for the text's own, or goes again."""
        found = self.model.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        for k, text in enumerate(texts):
            if text == " ":
                found[k] = [self.blank]
            elif text[:1] != " ":
                if found[k][:1] != [self.blank]:
                    raise ValueError("a line feed is not on its own in this model")
                found[k] = found[k][1:]
        return found


class Words:
    """Words as bytes, one after the other."""

    def __init__(self, data: np.ndarray, ends: np.ndarray) -> None:
        self.data, self.ends = data, ends
        self.starts = np.append(0, ends[:-1]) if len(ends) else ends

    def chosen(self, which: np.ndarray) -> Words:
        return gathered_words(self.data, self.starts[which], self.ends[which])

    def texts(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.starts.tolist(), self.ends.tolist())]

    def encoded(self, side: ByteLevel | Pieces) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each word has.

        Words that may stand behind one another in a text are encoded as such texts, and told apart by where their tokens end.
        """
        if not len(self.ends):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        kind = _KINDS[self.data]
        last, second = self.ends - 1, np.minimum(self.starts + 1, len(self.data) - 1)
        opens = (kind[self.starts] & 4 != 0) & (kind[second] & 3 != 0) & (self.ends - self.starts > 1)
        closes = (kind[last] & 1 != 0) | (kind[np.maximum(last - 1, 0)] & 2 != 0)
        joinable = opens & closes
        if not joinable.all():
            parts = [(np.flatnonzero(x), x) for x in (joinable, ~joinable)]
            pairs = [self.chosen(parts[0][0]).encoded(side), _flat(side.ids(self.chosen(parts[1][0]).texts()))]
            counts = np.zeros(len(self.ends), dtype=np.int64)
            for (at, _), (_, n) in zip(parts, pairs, strict=True):
                counts[at] = n
            ids = np.zeros(counts.sum(), dtype=np.uint32)
            of = np.repeat(joinable, counts)
            ids[of], ids[~of] = pairs[0][0], pairs[1][0]
            return ids, counts
        heads = np.flatnonzero(np.append(True, np.diff(self.starts // JOINED_BYTES) > 0))
        bounds = np.append(self.starts[heads], len(self.data)).tolist()
        raw = self.data.tobytes()
        ids, _ = _flat(side.ids([raw[a:b].decode() for a, b in zip(bounds, bounds[1:])]))
        token_ends = np.cumsum(side.bytes.widths[ids])
        at = np.searchsorted(token_ends, self.ends)
        if at[-1] + 1 == len(ids) and (token_ends[at] == self.ends).all():
            return ids, np.diff(np.append(-1, at))
        return _flat(side.ids(self.texts()))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(counts.sum())), counts


def gathered_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Words:
    places, bounds = _stretches(starts, ends - starts)
    return Words(data[places], bounds)


def _stretches(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of stretches, one stretch after the other, and where each ends in that order."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0), ends


class Pair:
    """Encodes texts by both tokenizers, word by word, and remembers the ids of words.

    A text is cut before a blank or line feed between two printable or Latin characters. Both tokenizers part the text there by
    their own rules, so joining the ids of the words gives the ids of the text. Words are known by their 64-bit hashes. The memory
    is emptied when it holds ``remembered`` words or sixteen times as many ids.
    """

    def __init__(self, first: str, second: str, remembered: int = 1_000_000) -> None:
        self.sides = [ByteLevel(first), Pieces(second)]
        self.kinds = [np.dtype("<u2" if len(s.bytes.widths) <= 1 << 16 else "<u4") for s in self.sides]
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)  # ascending
        self.pools = [np.zeros(0, dtype=k) for k in self.kinds]
        self.begins = [np.zeros(0, dtype=np.int64) for _ in self.sides]
        self.lengths = [np.zeros(0, dtype=np.int64) for _ in self.sides]

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        cut = np.zeros(n, dtype=bool)
        if self.sides[1].separable:
            kind = _KINDS[data]
            # Printable, or the second byte of a Latin character, on the left; printable or the first byte on the right.
            left = kind & 1 != 0
            left[1:] |= kind[:-1] & 2 != 0
            cut[1:-1] = (kind[1:-1] & 4 != 0) & left[:-2] & (kind[2:] & 3 != 0)
        edges = bounds[:-1]
        cut[edges[edges < n]] = True
        starts = np.flatnonzero(cut)
        return starts, np.append(starts[1:], n)

    def _learn(self, hashes: np.ndarray, words: Words) -> None:
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        for k, side in enumerate(self.sides):
            ids, counts = words.encoded(side)
            begins = len(self.pools[k]) + np.cumsum(counts) - counts
            self.pools[k] = np.append(self.pools[k], ids.astype(self.kinds[k]))
            self.begins[k] = np.insert(self.begins[k], at, begins)
            self.lengths[k] = np.insert(self.lengths[k], at, counts)

    def encode(self, block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
        """By each tokenizer the ids of the block's texts one after the other, and how many each text has."""
        starts, ends = self._cuts(block.data, block.bounds)
        hashes, sample, which = np.unique(block.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.remembered or max(map(len, self.pools)) > 16 * self.remembered:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), dtype=bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes
        if new.any():
            self._learn(hashes[new], gathered_words(block.data, starts[sample[new]], ends[sample[new]]))
            at = np.searchsorted(self.hashes, hashes)
        first, found = np.searchsorted(starts, block.bounds), []
        for k in range(len(self.sides)):
            word = at[which]
            places, reach = _stretches(self.begins[k][word], self.lengths[k][word])
            found.append((self.pools[k][places], np.diff(np.append(0, reach)[first])))
        return found


@lru_cache(maxsize=2)
def _pair(first: str, second: str) -> Pair:
    """One per worker process, so the memory lasts over the tasks it runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pair(first, second)


def spaced(block: Block) -> Block:
    """The block's texts with a blank before each."""
    n = len(block)
    return Block(block.first, np.insert(block.data, block.bounds[:-1], 0x20), block.bounds + np.arange(n + 1))


def _faithful(tokens: TokenBytes, ids: np.ndarray, counts: np.ndarray, block: Block) -> np.ndarray:
    """Per text, whether the bytes of its ids are those of the text."""
    reach = np.append(0, np.cumsum(tokens.widths[ids]))[np.append(0, np.cumsum(counts))]
    joined = tokens.joined(ids)
    if len(joined) == len(block.data) and (reach == block.bounds).all():
        differs = np.flatnonzero(joined != block.data)
        same = np.ones(len(block), dtype=bool)
        same[np.searchsorted(block.bounds, differs, side="right") - 1] = False
        return same
    parts = zip(reach, reach[1:], block.bounds, block.bounds[1:])
    return np.array([np.array_equal(joined[a:b], block.data[c:d]) for a, b, c, d in parts], dtype=bool)


def _woven(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left[0], right[0], left[1], right[1] ..."""
    return np.stack([left, right], axis=1).ravel()


def groups(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token of each group by both tokenizers, in order.

    ``ends_a``, ``ends_b``: where tokens end, over texts that follow each other; ``first_a``, ``first_b``: first token of each text (one more at the end).
    """
    some = first_a[1:] > first_a[:-1]
    a0, a1, b0, b1 = (x.astype(np.int32)[some] for x in (first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]))
    ends_a, ends_b = ends_a.astype(np.int32), ends_b.astype(np.int32)
    is_end = np.zeros(int(ends_b[-1]) + 1 if len(ends_b) else 1, dtype=bool)
    is_end[ends_b] = True
    done_a, done_b = [], []
    # Intervals stay in the order of the texts, so neighbours in an array are neighbours in memory.
    while len(a0):
        last = a1 - 2  # the last end inside
        begin = np.where(a0 > 0, ends_a[a0 - 1], 0)
        middle = (begin + ends_a[a1 - 1]) >> 1
        near = np.clip(np.searchsorted(ends_a, middle).astype(np.int32), a0, np.maximum(last, a0))
        shared = (near <= last) & is_end[ends_a[near]]
        cut = np.where(shared, near, -1)
        # Where the end next to the middle is none of the other's: 1 to the left, 1 to the right, 2 to the left ...
        waiting = np.flatnonzero(~shared & (last >= a0) & (b1 - b0 > 1))
        step = 1
        while len(waiting):
            for way in (-step, step):
                at = near[waiting] + way
                inside = (at >= a0[waiting]) & (at <= last[waiting])
                found = inside & is_end[ends_a[np.where(inside, at, 0)]]
                cut[waiting[found]] = at[found]
                waiting = waiting[~found]
            step += 1
            waiting = waiting[(near[waiting] - step >= a0[waiting]) | (near[waiting] + step <= last[waiting])]
        leaf = cut < 0
        done_a.append(a0[leaf])
        done_b.append(b0[leaf])
        parted = ~leaf
        a0, a1, b0, b1, cut = (x[parted] for x in (a0, a1, b0, b1, cut))
        other = np.searchsorted(ends_b, ends_a[cut]).astype(np.int32)
        a0, a1 = _woven(a0, cut + 1), _woven(cut + 1, a1)
        b0, b1 = _woven(b0, other + 1), _woven(other + 1, b1)
    starts_a = np.concatenate(done_a or [np.zeros(0, dtype=np.int32)])
    starts_b = np.concatenate(done_b or [np.zeros(0, dtype=np.int32)])
    order = np.argsort(starts_a, kind="stable")
    return starts_a[order].astype(np.int64), starts_b[order].astype(np.int64)


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the two tokens of each link, one link per stretch between neighbouring ends of either."""
    n = int(ends_a[-1]) + 1 if len(ends_a) else 1
    is_a, is_b = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    is_a[ends_a] = is_b[ends_b] = True
    ends = np.flatnonzero(is_a | is_b)
    # A stretch belongs to the token that ends with it or next after it.
    return tuple(np.cumsum(is_x, dtype=np.int32)[ends] - is_x[ends] for is_x in (is_a, is_b))


@lru_cache(maxsize=4)
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0, 1, 2 ... as bytes of one integer each, lowest byte first, and how many there are."""
    if size > 10**7:
        raise ValueError("ids of more than seven digits")
    texts = np.array([str(k) for k in range(size)], dtype="S8")
    return texts.view("<u8"), np.char.str_len(texts).astype(np.uint64)


def group_texts(a: np.ndarray, b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, size: int) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    n_a, n_b = len(a), len(b)
    digits, lengths = _digits(size)
    sizes = np.diff(np.append(starts_a, n_a)), np.diff(np.append(starts_b, n_b))
    # A group's ids by the first tokenizer come before those by the second; each is followed by a mark.
    ids = np.empty(n_a + n_b, dtype=np.int32)
    ids[np.arange(n_a) + np.repeat(starts_b, sizes[0])] = a
    ids[np.arange(n_b) + np.repeat(starts_a + sizes[0], sizes[1])] = b
    marks = np.full(n_a + n_b, ord(","), dtype="<u8")
    ends = starts_a + starts_b + sizes[0]
    marks[ends - 1] = ord("|")
    marks[ends + sizes[1] - 1] = ord(";")
    length = lengths[ids]
    shown = (digits[ids] | (marks << (length * np.uint64(8)))).view(np.uint8)
    text = shown[shown != 0].tobytes().decode("ascii")
    reach = np.append(0, np.cumsum(length.astype(np.int64) + 1))[first_a + first_b].tolist()
    return [text[p : max(p, q - 1)] for p, q in zip(reach, reach[1:])]


def _tokenizer(first: str, second: str):
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(first, second)
        one, two = pair.sides
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK_BYTES):
                n = len(block)
                empty = np.diff(block.bounds) == 0
                block = spaced(block)
                (a, n_a), (b, n_b) = pair.encode(block)
                good = _faithful(one.bytes, a, n_a, block) & _faithful(two.bytes, b, n_b, block) & ~empty
                a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
                n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
                of_a, of_b = links(np.cumsum(one.bytes.widths[a]), np.cumsum(two.bytes.widths[b]))
                pairs, counts = np.unique(a[of_a].astype(np.int64) * len(two.bytes.widths) + b[of_b], return_counts=True)
                lists = [n_a, n_b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0).slice(block.first, n)),
                        *(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(x, pa.int32())) for x in lists),
                        pa.array([a.tobytes()], pa.binary()),
                        pa.array([b.tobytes()], pa.binary()),
                        *(pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(x, pa.int64())) for x in (pairs, counts)),
                    ],
                    names=["block", "ids", "n_a", "n_b", "a", "b", "pairs", "counts"],
                )
                number += 1

    return tokens


def _aligner(first: str, second: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(first, second)
        one, two = pair.sides
        size = max(len(one.bytes.widths), len(two.bytes.widths))
        for batch in batches:
            for row in range(len(batch)):
                held = {name: batch.column(name)[row] for name in batch.schema.names}
                a = np.frombuffer(held["a"].as_py(), dtype=pair.kinds[0])
                b = np.frombuffer(held["b"].as_py(), dtype=pair.kinds[1])
                n_a, n_b = (held[name].values.to_numpy().astype(np.int64) for name in ("n_a", "n_b"))
                first_a, first_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
                ends_a, ends_b = np.cumsum(one.bytes.widths[a]), np.cumsum(two.bytes.widths[b])
                starts_a, starts_b = groups(ends_a, ends_b, first_a, first_b)
                of_a, of_b = links(ends_a, ends_b)
                pairs = a[of_a].astype(np.int64) * len(two.bytes.widths) + b[of_b]
                known = held["totals"].values
                order = np.argsort(known.field("pair").to_numpy()) if known is not None else np.zeros(0, dtype=np.int64)
                if len(order):
                    which = np.searchsorted(known.field("pair").to_numpy()[order], pairs)
                    total = known.field("total").to_numpy()[order][which]
                    best = known.field("best").to_numpy(zero_copy_only=False)[order][which]
                else:
                    total, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
                edges = np.searchsorted(of_a, first_a)
                sums = [np.append(0, np.cumsum(x))[edges] for x in (total, best)]
                texts = group_texts(a, b, starts_a, starts_b, first_a, first_b, size)
                columns = [n_a, n_b, np.diff(np.searchsorted(starts_a, first_a)), np.diff(edges), np.diff(sums[1]), np.diff(sums[0])]
                yield pa.RecordBatch.from_arrays(
                    [held["ids"].values, *(pa.array(c, pa.int64()) for c in columns), pa.array(texts, pa.string())],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
                )

    return align


def align_tokens(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, tokens by both tokenizers, groups, links, links to the best partner, sum of the links' counts, and the groups' ids.

    ``first`` is a byte-level vocabulary of the tokenizers library and reads a blank and the text, ``second`` a
    sentencepiece model that adds the blank itself. Special tokens in a text are plain text. ``groups`` lists the ids as
    ``a1,a2|b1;a3|b2,b3``. A link's count is how many links of all rows hold its two ids; a link is best if no id of the first
    tokenizer is linked more often with its second id (ties included).

    Null and empty texts, and those whose tokens do not give back their bytes, have no tokens: zeros and no groups. A row
    counts by itself, also if rows share an id or text or the id is null. Texts are taken whole; a block holds at least one. An empty
    table gives no rows; other columns are ignored.
    """
    work = Workspace(docs.sparkSession, "token-alignment")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    held = work.write(map_batches(own, _tokenizer(first, second), BLOCKS), "blocks")
    listed = held.select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("block", "x.pairs", "x.counts")
    totals = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("total"))
    totals = work.write(totals, "totals")
    second_id = F.pmod("pair", F.lit(_second_size(second)))
    highest = totals.groupBy(second_id.alias("second")).agg(F.max("total").alias("highest"))
    marked = totals.withColumn("second", second_id).join(highest, "second")
    marked = marked.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    known = listed.select("block", F.col("pairs").alias("pair")).join(marked, "pair")
    known = known.groupBy("block").agg(F.collect_list(F.struct("pair", "total", "best")).alias("totals"))
    joined = held.drop("pairs", "counts").join(work.write(known, "known"), "block", "left")
    aligned = map_batches(joined.drop("block"), _aligner(first, second), ALIGNED)
    return aligned.withColumnRenamed("id", id_col)


@lru_cache(maxsize=8)
def _second_size(name: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=vocabulary(name)).get_piece_size()
