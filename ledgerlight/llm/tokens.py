"""Token ids of whole texts, through the tokenizers library."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers

from ledgerlight.llm.text_arrays import LOWER, Block

# Kinds of bytes: printable ASCII; ASCII letters; ASCII marks except the apostrophe;
# bytes that begin a Latin character of two bytes, none of which is white space or a joining mark.
_PRINTABLE = np.zeros(256, dtype=bool)
_PRINTABLE[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = _PRINTABLE & ~_LETTER
_MARK[[*range(0x30, 0x3A), ord("'")]] = False
_LATIN = np.zeros(256, dtype=bool)
_LATIN[[0xC3, 0xC4, 0xC5]] = True

# Pieces that the library may read many at a time, as the ends of their tokens tell them apart: no white space
# inside, and only characters that stay as they are, or in lower case as long as they are.
_JOINABLE = re.compile(rb" ?(?:[!-~]|\xC3[\x80-\xBF])+")
_JOINED = 200


def vocabulary(name: str) -> str:
    """A file name of the public tokenizers, or a path, as a path."""
    return name if os.path.sep in name else public_tokenizers.path(name)


class Encoder:
    """Encodes texts piece by piece and remembers the ids of frequent pieces.

    Texts are cut before a blank, around a line feed and between a letter and
    a mark, where the characters on both sides leave no doubt. The library's
    own rules part the text there too, so joining the ids of the pieces gives
    the ids of the text. A text that holds an added token, such as <|endoftext|>, goes through the
    library whole, as pieces are cut inside of these. The memory holds at most ``remembered`` pieces; those
    not used for long are forgotten.
    """

    def __init__(self, name: str, remembered: int = 300_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary(name))
        added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        # Also in other cases of letters, as a token may be matched in lower case.
        self.added = re.compile(b"|".join(map(re.escape, added)), re.I) if added else None
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.half = remembered // 2
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # Bytes that each token stands for.
        self.widths = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
        for token, number in self.library.get_vocab().items():
            self.widths[number] = len(token.removesuffix("</w>"))
        # A vocabulary in lower case without blanks sees no difference between pieces that differ in these only.
        self.plain = self._ids("A b") == self._ids("a") + self._ids("b")

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces."""
        n = len(data)
        printable, latin = _PRINTABLE[data], _LATIN[data]
        ends_latin = np.zeros(n, dtype=bool)
        ends_latin[1:] = latin[:-1]
        # Letters from À to ÿ, without × and ÷; beyond them, one may turn into a letter and a mark in lower case.
        ends_letter = np.zeros(n, dtype=bool)
        ends_letter[1:] = data[:-1] == 0xC3
        ends_letter &= (data != 0x97) & (data != 0xB7)
        left, right = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        left[1:] = (printable | ends_latin)[:-1]
        right[:-1] = (printable | latin)[1:]
        gap = ((data == 0x20) | (data == 0x0A)) & left & right
        letter = np.zeros(n, dtype=bool)
        letter[1:] = (_LETTER[data] | ends_letter)[:-1]
        cut = gap | (letter & _MARK[data])
        after_feed = np.flatnonzero(gap if self.plain else gap & (data == 0x0A)) + 1
        cut[after_feed] = True
        edges = bounds[:-1]
        cut[edges[edges < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        if self.plain:  # a lone blank is no piece
            kept = ~gap[starts]
            starts, ends = starts[kept], ends[kept]
        return starts, ends

    def _learn(self, pieces: list[bytes]) -> None:
        """Adds the ids of new pieces; joined pieces stand behind a blank or line feed each."""
        joinable = [p for p in pieces if _JOINABLE.fullmatch(p)]
        alone = [p for p in pieces if not _JOINABLE.fullmatch(p)]
        groups = [joinable[k : k + _JOINED] for k in range(0, len(joinable), _JOINED)]
        texts = [b"".join(p if p[:1] == b" " else b"\n" + p for p in group).decode() for group in groups]
        for group, found in zip(groups, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, dtype=self.dtype)
            token_ends = np.cumsum(self.widths[ids])
            fed = [0 if self.plain or p[:1] == b" " else 1 for p in group]
            ends = np.cumsum([len(p) - (self.plain and p[:1] == b" ") + f for p, f in zip(group, fed, strict=True)])
            at = np.searchsorted(token_ends, ends)
            if at[-1] + 1 != len(ids) or (token_ends[at] != ends).any():
                alone += group
                continue
            begin = 0
            for piece, f, end in zip(group, fed, (at + 1).tolist(), strict=True):
                self.young[piece] = ids[begin + f : end].tobytes()
                begin = end
        texts = [p.decode() for p in alone]
        for piece, found in zip(alone, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            self.young[piece] = np.array(found.ids, dtype=self.dtype).tobytes()

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the block's texts one after the other, and how many each text has."""
        if self.added is None:
            return self._encode(block)
        raw, bounds = block.data.tobytes(), block.bounds
        places = np.array([m.start() for m in self.added.finditer(raw)], dtype=np.int64)
        # A match over the edge of two texts sends the first through the library, which does no harm.
        held = np.unique(np.searchsorted(bounds, places, side="right") - 1).tolist()
        if not held:
            return self._encode(block)
        ids, counts, at = [], [], 0
        for k in [*held, len(block)]:
            if k > at:
                part = Block(block.first + at, block.data[bounds[at] : bounds[k]], bounds[at : k + 1] - bounds[at])
                found, many = self._encode(part)
                ids.append(found)
                counts.append(many)
            if k < len(block):
                found = np.array(self._ids(raw[bounds[k] : bounds[k + 1]].decode()), dtype=self.dtype)
                ids.append(found)
                counts.append(np.array([len(found)], dtype=np.int64))
            at = k + 1
        return np.concatenate(ids), np.concatenate(counts)

    def _encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        data = LOWER[block.data] if self.plain else block.data
        starts, ends = self._cuts(data, block.bounds)
        # Equal pieces of a block are known by their 64-bit hashes and looked up once.
        hashes = Block(0, data, block.bounds).hashes(starts, ends)
        _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)]
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        missing = []
        for piece in pieces:
            if piece not in self.young:
                if piece in self.old:
                    self.young[piece] = self.old[piece]
                else:
                    missing.append(piece)
        if missing:
            self._learn(list(dict.fromkeys(missing)))
        ids = [self.young[p] for p in pieces]
        pool = np.frombuffer(b"".join(ids), dtype=self.dtype)
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.dtype.itemsize
        counts = lengths[which]
        sums = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(counts, out=sums[1:])
        shift = (np.cumsum(lengths) - lengths)[which] - sums[:-1]
        first = np.searchsorted(starts, block.bounds)
        return pool[np.repeat(shift, counts) + np.arange(sums[-1])], np.diff(sums[first])


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One per worker process, so the memory lasts over the tasks it runs."""
    return Encoder(name)
