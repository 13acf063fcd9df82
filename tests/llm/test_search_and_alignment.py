"""Lexical search, multi-index and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from ledgerlight.llm import align_tokens, lexical_search, multi_index, queries
from texts import LOWERED, SCHEMA, edge_documents, edge_rows, empty_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(LOWERED) for t in TERM.findall(text or "")]


def ranked(docs, items, k=10, b=90):
    """docs, items: (id, text) pairs. Rows (item, rank, id, score)."""
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c in held:
            m = 100 - b + (b * sum(c.values()) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=str)


def test_ranks_as_the_definition_with_edges_ties_and_passes(spark):
    docs = [(r[0], r[1]) for r in edge_rows()]
    docs += [(100 + k, "tie alpha1 beta2") for k in range(40)]
    items = [(1, "alpha1 BETA2 tick MIT"), (2, None), (3, ""), (4, "nothing-of-this-kind"), (5, docs[0][1]), (6, "日本語 ü"), (6, "One"), (None, "alpha1"), (7, "tie")]
    table = edge_documents(spark).select("doc_id", "text").union(spark.createDataFrame(docs[-40:], "doc_id long, text string")).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = ranked(docs, items)
    assert len({w[0] for w in want}) >= 4
    assert rows(lexical_search.rank_documents(table, asked)) == want
    assert rows(lexical_search.rank_documents(table, asked, pass_terms=3)) == want
    assert rows(lexical_search.rank_documents(table, asked, k=1)) == ranked(docs, items, k=1)


def test_tiles_of_any_width_give_the_same_scores(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for k in range(200)]
    items = [(k, " ".join(rng.sample(words, 12))) for k in range(20)]
    for name, size in (("ITEM_TILE", 3), ("DOCUMENT_TILE", 7), ("VOCABULARY_TILE", 5)):
        monkeypatch.setattr(lexical_search, name, size)
    # In this process, as workers have modules of their own.
    vocabulary = {w: k for k, w in enumerate(words)}
    held = [(i, Counter(vocabulary[t] for t in terms(d))) for i, d in docs]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in range(60)], dtype=np.int64)
    numbers = [sorted(vocabulary[t] for t in set(terms(x))) for _, x in items]
    asked = lexical_search.Queries(np.arange(20), np.append(0, np.cumsum([len(x) for x in numbers])), np.concatenate(numbers), weights)
    assert asked.width == 5
    best = lexical_search.Best(20, 10)
    for a in range(0, len(held), 7):
        part = held[a : a + 7]
        t = np.concatenate([sorted(c) for _, c in part])
        tf = np.concatenate([[c[x] for x in sorted(c)] for _, c in part])
        column = np.repeat(np.arange(len(part)), [len(c) for _, c in part])
        impact = lexical_search.impacts_of(tf, np.array([sum(c.values()) for _, c in part])[column], n, length, 90)
        present, row = np.unique(t, return_inverse=True)
        for low, high in asked.tiles():
            scores = asked.scores(low, high, present, row, column, impact, len(part))
            best.add(low, scores, np.array([i for i, _ in part]), np.zeros(len(part), dtype=bool))
    found = [(int(i), int(d), int(s)) for i, d, s in zip(best.item, best.id, best.score)]
    assert sorted(found) == sorted((i, d, s) for i, _, d, s in ranked(docs, items))


def test_empty_tables_rank_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert rows(lexical_search.rank_documents(empty_documents(spark), some)) == []
    assert rows(lexical_search.rank_documents(edge_documents(spark), none)) == []
    assert lexical_search.rank_documents(edge_documents(spark), none).columns == ["item_id", "rank", "doc_id", "score"]


def exact_neighbours(vectors, asked, k=10):
    """vectors: id -> list of floats. Rows (query, rank, id, score)."""
    out = []
    for q in asked:
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(vectors[q], v))), i) for i, v in vectors.items() if i != q)
        out += [(q, r, i) for r, (_, i) in enumerate(near[:k], 1)]
    return sorted(out)


def test_small_table_is_searched_exactly_with_copies_and_unfit_vectors(spark):
    rng = random.Random(3)
    vectors = {k: [float(np.float32(rng.gauss(0, 1))) for _ in range(7)] for k in range(300)}
    for k in range(20, 60):
        vectors[k] = list(vectors[20])
    unfit = [(1000, None), (1100, []), (1200, [0.0] * 7), (1300, [1.0, None] + [0.0] * 5), (1400, [float("nan")] + [1.0] * 6),
             (1500, [float("inf")] + [1.0] * 6), (1600, [1.0] * 6), (None, [1.0] * 7)]
    own = [(i, v) for i, v in vectors.items()] + [(200, vectors[200])]
    table = spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in own + unfit], "vec_id long, embedding array<float>, h1 string, c1 int, vector double")
    found = multi_index.nearest_neighbours(table, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    got = found.collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == exact_neighbours(vectors, range(0, 300, 20))
    for r in got:
        assert r.score == math.sqrt(reduce(lambda total, pair: total + (pair[0] - pair[1]) ** 2, zip(vectors[r.query_id], vectors[r.vec_id]), 0.0))


@pytest.mark.parametrize("given", [[], [(5, [1.0])], [(0, [1.0, 2.0]), (20, [1.0, 3.0])]])
def test_tiny_tables(spark, given):
    table = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in multi_index.nearest_neighbours(table, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == ([(0, 1, 20, 1.0), (20, 1, 0, 1.0)] if len(given) == 2 else [])


def test_heap_gives_cells_by_summed_distance():
    rng = np.random.default_rng(1)
    for _ in range(20):
        first, second = rng.random(6), rng.random(9)
        counts = rng.integers(0, 5, (6, 9))
        wanted = int(rng.integers(1, 80))
        seen = multi_index.visited_cells(first, second, counts, wanted)
        order = np.argsort((first[:, None] + second).ravel(), kind="stable")
        enough = np.searchsorted(np.cumsum(counts.ravel()[order]), wanted) + 1
        expected = np.zeros(54, dtype=bool)
        expected[order[:enough]] = True
        assert (seen == (expected.reshape(6, 9) & (counts > 0))).all()


def test_recall_against_brute_force(spark):
    """On vectors without structure, where an index has the least to work with, and a depth below the whole table."""
    rng = np.random.default_rng(2)
    data = rng.normal(size=(4000, 16)).astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id long, embedding array<float>")
    found = multi_index.nearest_neighbours(table, F.col("vec_id") % 100 == 0, sample_rows=2000, least_candidates=100).collect()
    asked = np.arange(0, 4000, 100)
    exact = ((data[asked, None].astype(float) - data[None]) ** 2).sum(-1)
    exact[np.arange(len(asked)), asked] = np.inf
    true = {(int(q), int(i)) for q, row in zip(asked, np.argsort(exact, axis=1)[:, :10]) for i in row}
    got = {(r.query_id, r.vec_id) for r in found}
    assert len(got) == len(true) and len(got & true) >= 0.9 * len(true)


def test_queries_reach_the_rows_in_passes_and_through_no_join(spark, monkeypatch):
    """What the driver holds of the queries is bounded; a join may send them, times their cells, to the driver."""
    rng = np.random.default_rng(4)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rng.normal(size=(900, 6)).astype(np.float32))], "vec_id long, embedding array<float>")
    search = lambda: sorted(map(tuple, multi_index.nearest_neighbours(table, F.col("vec_id") % 3 == 0, least_candidates=300).collect()))
    plans, sent = [], []
    write, ranker = multi_index.Workspace.write, multi_index._ranker

    def seen_write(self, rows, name):
        if name.startswith("found"):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, name)

    def seen_ranker(probes, *rest):
        sent.append(sum(map(len, probes.values())))
        return ranker(probes, *rest)

    monkeypatch.setattr(multi_index.Workspace, "write", seen_write)
    whole = search()
    assert plans and not any("Join" in plan for plan in plans)
    monkeypatch.setattr(multi_index, "_ranker", seen_ranker)
    monkeypatch.setattr(multi_index, "PASS_BYTES", 6000)
    monkeypatch.setattr(multi_index, "BLOCK_COMPONENTS", 600)
    assert search() == whole
    assert len(sent) > 2 and sum(sent) > 6000 and max(sent) < sum(sent)


@pytest.mark.parametrize(("shift", "scale"), [(0, 1), (1e7, 1e-3), (0, 1e170)])
def test_rows_of_a_block_are_not_lost_to_rounding(shift, scale):
    rng = np.random.default_rng(5)
    rows, queries = (shift + scale * rng.normal(size=(n, 12)) for n in (500, 8))
    rows[250:] = rows[:250]
    nearest, ids = multi_index._Nearest(11), np.arange(500)[::-1].copy()
    ends, places = np.full((8, 1), 2, dtype=np.uint16), np.zeros((8, 2), dtype=np.uint16)
    places[:, 1] = 5  # cells that no query sees
    c1, c2 = np.zeros(500, dtype=np.int32), (np.arange(500) % 10 == 0).astype(np.int32)
    for part in (slice(0, 200), slice(200, 500)):
        multi_index._rank_block(nearest, [[q, 0] for q in range(8)], queries, ends, places, ids[part], c1[part], c2[part], np.ascontiguousarray(rows[part].T))
    with np.errstate(over="ignore"):
        for q in range(8):
            scores = multi_index.distances(rows[c2 == 0].T, queries[q])
            expected = np.lexsort((ids[c2 == 0], scores))[:11]
            got = np.lexsort((nearest.best[q, 0][1], nearest.best[q, 0][0]))
            assert nearest.best[q, 0][1][got].tolist() == ids[c2 == 0][expected].tolist()


# --- token alignment ----------------------------------------------------------

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"


def aligned_plainly(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(path(FIRST)), SentencePieceProcessor(model_file=path(SECOND))
    one.encode_special_tokens = True
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = dict(zip(map(chr, printable), printable)) | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    held, counts = [], Counter()
    for text in texts:
        held.append(None)
        if not text:
            continue
        a, b = one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)
        bytes_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for cut in cuts:
            parts = []
            for s, ids in enumerate((a, b)):
                begin = at[s]
                while at[s] < len(ids) and ends[s][at[s]] <= cut:
                    at[s] += 1
                parts.append(ids[begin : at[s]])
            groups.append(parts)
        i = j = 0
        links = []
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            low = min(ends[0][i], ends[1][j])
            i, j = i + (ends[0][i] == low), j + (ends[1][j] == low)
        counts.update(links)
        held[-1] = (len(a), len(b), groups, links)
    best = {}
    for (_, b), c in counts.items():
        best[b] = max(best.get(b, 0), c)
    out = []
    for row in held:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), shown))
    return out


HOSTILE = [
    "▁", "a▁b", "a b", " ", "  ", "\n", "\n\n x", " a  b   c \n d\n", "<0x41> <s> </s> <unk> <|endoftext|>", " x​y", "é ́", "x" * 3000,
    "日本語のテキスト 한국어 العربية", "\U0001F600\U0001F468‍\U0001F469", "\t\ttab\r\nline", "1234567 3.14 it's we'll", "\x00 \x01\x7f", "ﬁ ½ Å",
]


def test_alignment_equals_the_plain_version(spark):
    given = [(r[0], r[1]) for r in edge_rows()] + [(200 + k, t) for k, t in enumerate(HOSTILE)]
    table = spark.createDataFrame([(i, t, "a", 1) for i, t in given], "doc_id long, text string, ids string, block int").repartition(3)
    found = align_tokens.align_tokens(table, FIRST, SECOND)
    want = sorted(((i, *row) for (i, _), row in zip(given, aligned_plainly([t for _, t in given]))), key=str)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    got = sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)
    assert got == want
    assert any(row[1] == 0 and t for (_, t), row in zip(given, aligned_plainly([t for _, t in given])))


def test_blocks_of_tokens_stay_small(monkeypatch):
    """However large a batch of texts, a worker holds the tokens of half a megabyte of text at a time, or of one text."""
    monkeypatch.setattr(align_tokens, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    text = " ".join(f"word{k}" for k in range(1500))
    batch = pa.RecordBatch.from_arrays([pa.array(range(150), pa.int64()), pa.array([text] * 150)], names=["id", "text"])
    found = list(align_tokens._tokenizer(FIRST, SECOND)(iter([batch])))
    held = [len(block.column(1)[0]) for block in found]
    assert sum(held) == 150
    assert max(held) * len(text) <= 1 << 19


def test_cuts_by_bisect_on_random_ends():
    rng = np.random.default_rng(4)
    for share in (0.02, 0.3, 0.9):
        lengths = [int(n) for n in rng.integers(0, 400, 30)]
        ends, first = [[], []], [[0], [0]]
        begin = 0
        for n in lengths:
            for s in range(2):
                inside = np.flatnonzero(rng.random(max(n - 1, 0)) < share) + 1
                ends[s] += (begin + np.append(inside, n)).tolist() if n else []
                first[s].append(len(ends[s]))
            begin += n
        a, b = (np.array(e, dtype=np.int64) for e in ends)
        starts_a, starts_b = align_tokens.groups(a, b, *(np.array(f) for f in first))
        cuts = np.intersect1d(a, b)
        assert (starts_a == np.searchsorted(a, np.append(0, cuts[:-1]), side="right")).all()
        assert (starts_b == np.searchsorted(b, np.append(0, cuts[:-1]), side="right")).all()


def test_alignment_of_an_empty_table_and_the_query(spark, sf_dir):
    assert align_tokens.align_tokens(spark.createDataFrame([], SCHEMA), FIRST, SECOND).collect() == []
    found = {r.doc_id: r for r in queries.op13_token_alignment(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    for doc, row in zip(docs, aligned_plainly([d.text for d in docs])):
        got = found[doc.doc_id]
        digest = hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else ""
        assert (got.n_a, got.n_b, got.n_groups, got.n_links, got.n_best, got.count_sum, got.groups_sha256) == (*row[:-1], digest)
