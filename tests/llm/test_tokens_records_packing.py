from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerlight.llm import binary_records, packing
from ledgerlight.llm.text_arrays import SPACE, blocks, grams
from ledgerlight.llm.tokens import Encoder, encoder
from texts import edge_documents, edge_rows, empty_documents, sentence, spaced

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@cache
def library(name: str) -> Tokenizer:
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.encode_special_tokens = True
    return found


def ids_of(name: str, text: str | None) -> list[int]:
    return library(name).encode(text or "", add_special_tokens=False).ids


def encoded(code: Encoder, texts: list[str | None]) -> list[list[int]]:
    out = []
    for block in blocks(pa.array(texts, pa.string()), 5000):
        ids, counts = code.encode(block)
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


@pytest.mark.parametrize("name", VOCABULARIES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("abAB é×ßİſ'.,!12 \n\t\r ́　日Σ<|>")), max_size=40), min_size=1, max_size=5))
def test_pieces_give_the_ids_of_the_text(name, texts):
    assert encoded(encoder(name), texts) == [ids_of(name, t) for t in texts]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_added_tokens_are_read_as_the_library_reads_them(name):
    unchanged = Tokenizer.from_file(public_tokenizers.path(name))
    added = [t.content for t in unchanged.get_added_tokens_decoder().values()]
    assert added
    rng = random.Random(14)
    texts = ["", None, "plain text", "<|endof", "text|>", "<|ENDOFTEXT|>", "a<|endoftext|>b", *(f"é {t}{t} B{t}" for t in added)]
    for _ in range(60):
        texts.append(" ".join(rng.choice([*added, "a", "é日", "<|", "Word's 12!"]) + rng.choice(["", "b", "\n"]) for _ in range(rng.randrange(8))))
    expected = [unchanged.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoded(encoder(name), texts) == expected
    for size in (1, 30):
        found = [code for block in blocks(pa.array(texts, pa.string()), size) for code in np.split(*(lambda ids, n: (ids, np.cumsum(n)[:-1]))(*encoder(name).encode(block)))]
        assert [x.tolist() for x in found] == expected


@pytest.mark.parametrize("name", VOCABULARIES)
def test_memory_may_be_emptied_between_blocks(name):
    code = Encoder(name, remembered=20)
    texts = [t for _, t, *_ in edge_rows() if len(t or "") < 2000]
    assert encoded(code, texts) == [ids_of(name, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab é \n\t\x0b")), max_size=30)), min_size=1, max_size=8), size=st.integers(1, 40))
def test_words_and_windows_of_blocks(texts, size):
    seen = {}
    for block in blocks(pa.array(texts, pa.string()), size):
        starts, ends, first = block.spans(SPACE)
        words = block.hashes(starts, ends)
        at, hashes = grams(words, first, 2)
        for i in range(len(block)):
            expected = spaced(texts[block.first + i])
            own = range(first[i], first[i + 1])
            assert [bytes(block.data[starts[k] : ends[k]]).decode() for k in own] == expected
            pairs = [tuple(expected[k : k + 2]) for k in range(len(expected) - 1)]
            mine = [int(h) for a, h in zip(at, hashes) if first[i] <= a < first[i + 1]]
            for pair, h in zip(pairs, mine, strict=True):
                assert seen.setdefault(pair, h) == h
    assert len(set(seen.values())) == len(seen)


def test_records_come_back_as_written(spark):
    docs = edge_documents(spark)
    manifest = binary_records.write_records(docs, VOCABULARIES[0], end_id=0)
    rows = sorted(binary_records.read_records(manifest).collect(), key=lambda r: r["position"])
    at = 0
    for row in rows:
        assert row["position"] == at
        at += len(row["ids"]) // 4
    ids = [r["id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    expected = sorted((i is not None, i or 0, np.array([*ids_of(VOCABULARIES[0], t), 0], "<u4").tobytes()) for i, t, *_ in edge_rows())
    assert sorted((r["id"] is not None, r["id"] or 0, bytes(r["ids"])) for r in rows) == expected
    shuffled = binary_records.read_records(manifest, seed=3).collect()
    assert sorted(map(tuple, shuffled)) == sorted(map(tuple, rows)) if None not in ids else len(shuffled) == len(rows)


def test_no_documents_no_shards(spark):
    manifest = binary_records.write_records(empty_documents(spark), VOCABULARIES[0])
    assert manifest.count() == 0
    assert binary_records.read_records(manifest).count() == 0
    assert packing.pack(empty_documents(spark), VOCABULARIES[1]).count() == 0


def test_damage_is_noticed():
    data = bytearray(binary_records.frame(b"payload"))
    assert binary_records.unframe(bytes(data)) == b"payload"
    for place in range(len(data)):
        broken = bytearray(data)
        broken[place] ^= 4
        with pytest.raises(ValueError):
            binary_records.unframe(bytes(broken))


def test_pieces_make_up_documents_and_sequences(spark):
    docs = edge_documents(spark)
    rows = packing.pieces(packing.pack(docs, VOCABULARIES[1], end_id=2)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    lengths = defaultdict(int)
    for i, text, *_ in edge_rows():
        lengths[i] += len(ids_of(VOCABULARIES[1], text)) + 1
    assert {i: sum(r["length"] for r in found) for i, found in by_doc.items()} == lengths
    ids = np.array([*ids_of(VOCABULARIES[1], edge_rows()[9][1]), 2], "<u4")
    for r in by_doc[9]:
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 4096 or at & (at - 1) == 0


@pytest.mark.parametrize("seed", range(6))
def test_every_limit_holds_and_every_id_is_placed_once(seed):
    rng = random.Random(seed)
    limits = packing.Limits(tokens=64, segments=rng.choice([3, 100]), loss=rng.choice([20, 64]), block=10)
    packer, out, sizes = packing.Packer(limits), [], {}
    for i in range(120):
        n = rng.choice([1, 2, 5, 30, 63, 64, 65, 200])
        sizes[i] = n
        out += packer.add(packing.Piece(i, 0, np.arange(n), rng.randrange(n + 1), n))
    out += packer.finish()
    seen = defaultdict(list)
    for pieces in out:
        assert sum(len(p.ids) for p in pieces) <= limits.tokens
        assert len(pieces) <= limits.segments
        assert sum(p.loss for p in pieces) <= limits.loss
        for p in pieces:
            seen[p.id] += p.ids.tolist()
    assert {i: sorted(v) for i, v in seen.items()} == {i: list(range(n)) for i, n in sizes.items()}


def test_large_products_go_first():
    limits = packing.Limits(tokens=10, segments=2, loss=10, block=4)
    packer = packing.Packer(limits)
    out = [p for n in (7, 1, 3, 9) for p in packer.add(packing.Piece(n, 0, np.arange(n), 0, n))]
    assert [[p.id for p in s] for s in out] == [[9, 1], [7, 3]]


def test_silent_ids_count_for_no_loss(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(1, sentence(rng, 30), 5), (2, sentence(rng, 30), None)], "doc_id long, text string, prompt int")
    rows = packing.pack(docs, VOCABULARIES[1], silent_col="prompt").collect()
    tokens = sum(r["n_tokens"] for r in rows)
    assert sum(r["n_loss"] for r in rows) == tokens - 5
