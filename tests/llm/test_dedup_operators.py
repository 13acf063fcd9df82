"""Near duplicates, lines, passages and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlight.llm import line_dedup, near_dedup, substring_dedup
from ledgerlight.llm.queries import oracle_sql, queries
from ledgerlight.llm.text_arrays import blocks
from texts import LOWERED, Groups, edge_documents, edge_rows, empty_documents, sentence, shingle_set, spaced


def near_groups(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    groups = Groups()
    for a, (i, s) in enumerate(sets):
        if i is not None:
            groups.find(i)
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and (i == j or 100 * len(s & t) >= percent * len(s | t)):
                groups.join(i, j)
    return groups, sets


def family(seed):
    """Documents at all distances from each other: chains of edits, copies, one large group."""
    rng = random.Random(seed)
    rows, number = [], 0
    for _ in range(12):
        words = sentence(rng, rng.choice([3, 7, 20, 60, 200])).split()
        for _ in range(rng.choice([1, 2, 5, 25])):
            rows.append((number, " ".join(words)))
            number += 1
            words = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    hub = sentence(rng, 150).split()
    for _ in range(60):
        own = list(hub)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(150)] = sentence(rng, 1)
        rows.append((number, " ".join(own).upper() if rng.random() < 0.2 else " ".join(own)))
        number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    rows = family(percent)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    groups, sets = near_groups(rows, percent)
    sizes = {i: len(s) for i, s in sets}
    expected = {(i, sizes[i], groups.find(i), groups.find(i) == i) for i, _ in rows}
    assert {tuple(r) for r in found} == expected
    assert len(found) == len(rows)


def test_near_duplicates_of_edge_rows(spark):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    found = near_dedup.near_duplicates(edge_documents(spark)).collect()
    groups, sets = near_groups(rows, 80)
    expected = Counter((i, len(s), groups.find(i) if i is not None else None, i is None or groups.find(i) == i) for i, s in sets)
    assert Counter(map(tuple, found)) == expected
    assert near_dedup.near_duplicates(empty_documents(spark)).count() == 0


def test_sketches_estimate_similarity():
    rng = random.Random(0)
    words = sentence(rng, 400).split()
    texts = [" ".join(words)]
    for changed in (2, 10, 30):
        own = list(words)
        for k in rng.sample(range(400), changed):
            own[k] = "x" + str(k)
        texts.append(" ".join(own))
    (block,) = blocks(pa.array(texts))
    registers = near_dedup.sketches(*near_dedup.shingle_sets(block, 5))
    for k in range(1, 4):
        a, b = shingle_set(texts[0]), shingle_set(texts[k])
        assert abs((registers[0] == registers[k]).mean() - len(a & b) / len(a | b)) < 0.15
    assert (registers > 0).all()


def plain_lines(rows, percent, shingle, least):
    """(row, line) of the lines that go."""
    lines = []
    for k, (i, text, *_) in enumerate(rows):
        for at, line in enumerate((text or "").split("\n")):
            content = "".join(" " if c in "\t\x0b\x0c\r" else c for c in line.translate(LOWERED)).strip(" ")
            if len(content) >= least and content:
                lines.append((k, at, content, frozenset(content[j : j + shingle] for j in range(max(1, len(content) - shingle + 1)))))
    groups, distinct = Groups(), list({c: s for _, _, c, s in lines}.items())
    for a, (c, s) in enumerate(distinct):
        groups.find(c)
        for d, t in distinct[:a]:
            if 100 * len(s & t) >= percent * len(s | t):
                groups.join(c, d)
    return [(k, at, groups.find(c)) for k, at, c, _ in lines]


def test_lines(spark):
    rng = random.Random(6)
    stock = [sentence(rng, rng.choice([1, 3, 8, 30])) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(stock) if rng.random() < 0.6 else sentence(rng, 9)
            if rng.random() < 0.3:
                k = rng.randrange(len(line))
                line = line[:k] + "é" + line[k + 1 :]
            lines.append(("\t" + line.upper() + " ") if rng.random() < 0.2 else line)
        rows.append((i, "\n".join(lines), "x", 1, "y"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, _lines string, gone int, split string")
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs.repartition(3)).collect()}
    grouped = plain_lines(rows, 80, 9, 20)
    stays = {}
    for k, at, group in grouped:
        stays.setdefault(group, (k, at))
    gone = defaultdict(set)
    for k, at, group in grouped:
        if stays[group] != (k, at):
            gone[k].add(at)
    for i, text, *_ in rows:
        lines = text.split("\n")
        assert found[i]["text"] == "\n".join(x for at, x in enumerate(lines) if at not in gone[i])
        assert (found[i]["_lines"], found[i]["_removed"]) == (len(lines), len(gone[i]))
        assert (found[i]["gone"], found[i]["split"]) == (1, "y")


def test_lines_of_edge_rows(spark):
    found = line_dedup.dedup_lines(edge_documents(spark)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, *_ in edge_rows())
    texts = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert texts[1]["text"] == ""  # the row without an id stands first and keeps the line
    assert {r["text"] for r in found if r["doc_id"] is None} == {edge_rows()[0][1], None}
    assert texts[4]["text"] is None and texts[4]["_lines"] == 0
    assert texts[7]["text"] == "One"
    assert texts[13]["text"] == "x" * 100_000
    assert line_dedup.dedup_lines(empty_documents(spark)).count() == 0


def op7_and_stage(spark, rows, folder):
    """(lines, removed) by id of the query, and texts by id of the pipeline's stage."""
    docs = [(i, t, "en", "s", len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    found = queries()["op7_line_dedup"](spark, str(folder)).collect()
    stage = corpus_pipeline.drop_similar_lines(spark, spark.read.parquet(f"{folder}/documents.parquet"), str(folder)).collect()
    return {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in found}, {r["doc_id"]: r["text"] for r in stage}


def test_lines_that_differ_in_one_digit(spark, tmp_path):
    """Anywhere in a line of 49 to 80 characters, at its end from 40 on."""
    rng = random.Random(11)
    rows = []
    for n in range(40, 81):
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        at = rng.randrange(n) if n >= 49 else n - 1
        rows += [(2 * n, f"{line[:at]}1{line[at + 1 :]}"), (2 * n + 1, f"{line[:at]}2{line[at + 1 :]}")]
    found, kept = op7_and_stage(spark, rows, tmp_path)
    assert found == {i: (1, i % 2) for i, _ in rows}
    assert kept == {i: t for i, t in rows if i % 2 == 0}


def test_short_lines_have_copies_too(spark, tmp_path):
    """Of copies of a line one stays, down to one character; edge rows as in the plain version."""
    rng = random.Random(12)
    stock = ["Home", "Read more", "Read mode", "今日は晴れです。", "x", "é", " \t", "", "Chapter 10, part 1", "Chapter 10, part 2", "read MORE\t"]
    rows = [(i, "\n".join(rng.choice(stock) if rng.random() < 0.8 else sentence(rng, 1) for _ in range(5))) for i in range(30)]
    found, kept = op7_and_stage(spark, rows, tmp_path)
    gone, stays = defaultdict(set), {}
    for k, at, group in plain_lines(rows, 80, 5, 1):
        if stays.setdefault(group, (k, at)) != (k, at):
            gone[k].add(at)
    assert found == {i: (5, len(gone[i])) for i, _ in rows}
    expected = {i: "\n".join(x for at, x in enumerate(t.split("\n")) if at not in gone[i]) for i, t in rows}
    assert kept == {i: t for i, t in expected.items() if not gone[i] or spaced(t)}


def test_line_sketches_lose_no_similar_pair():
    """Parities leave every similar pair, whatever block a line stands in, and few others."""
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz "
    lines = []
    for n in (4, 9, 50, 120, 300, 700):
        line = "".join(rng.choice(letters) for _ in range(n - 1)) + "."
        for changes in (0, 1, 2, 5, 20, n):
            own = list(line)
            for _ in range(changes):
                own[rng.randrange(n - 1)] = rng.choice(letters)
            lines.append("x" + "".join(own))

    def sketched(texts):
        found = []
        for block in blocks(pa.array(texts)):
            held = line_dedup.Lines(block, 5, 1)
            hashes, counts = held.shingles(np.arange(len(held.nodes)))
            found.append(line_dedup.sketches(hashes, counts, line_dedup.registers_of(hashes, counts))[:2])
        return [np.concatenate(x) for x in zip(*found)]

    n, together = sketched(lines)
    alone = np.concatenate([sketched([line])[1] for line in lines])
    assert (together == alone).all()
    sets = [{line.strip()[k : k + 5] for k in range(max(1, len(line.strip()) - 4))} for line in lines]
    assert n.tolist() == [len(s) for s in sets]
    a, b = np.triu_indices(len(lines), 1)
    kept = line_dedup.room_by_parities(together[a], alone[b], n[a] + n[b], 80)
    similar = np.array([100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for i, j in zip(a, b)])
    assert similar.any() and kept[similar].all()
    assert kept.sum() < similar.sum() + 10


def test_line_dedup_leaves_no_tables_it_does_not_need(spark, monkeypatch):
    """The disk holds only what the result is read from, and texts are fetched for pairs that sketches leave."""
    works, made = [], []

    class Watched(line_dedup.Workspace):
        def __init__(self, *given):
            super().__init__(*given)
            works.append(self)

        def write(self, table, name):
            out = super().write(table, name)
            if name.endswith("texts"):
                made.append(out.count())
            return out

    monkeypatch.setattr(line_dedup, "Workspace", Watched)
    rng = random.Random(14)
    base = ["".join(rng.choice("ab cd") for _ in range(300)) for _ in range(60)]
    rows = [(i, f"{line}\n{line[:-1]}x" if i < 5 else line) for i, line in enumerate(base)]
    kept = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5, least_chars=1).collect()
    assert {r["doc_id"]: r["_removed"] for r in kept} == {i: int(i < 5) for i in range(60)}
    assert made and max(made) < 60
    (work,) = works
    assert os.listdir(work.folder) == ["removed"]


def plain_repeats(rows, window):
    starts = Counter()
    for _, text in rows:
        words = spaced(text)
        starts.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for i, text in rows:
        words, gone = spaced(text), set()
        for k in range(len(words) - window + 1):
            if starts[tuple(words[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("window", [1, 8, 20, 35])
def test_repeats(spark, window):
    rng = random.Random(window)
    passages = [sentence(rng, n) for n in (window, window + 1, window + 30, max(1, window - 1), 120)]
    rows = []
    for i in range(70):
        parts = [rng.choice(passages) if rng.random() < 0.4 else sentence(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(5))]
        rows.append((i, ("\n" if i % 2 else " ").join(parts)))
    rows += [(200, "tick " * 100), (201, rows[0][1]), (202, rows[3][1]), (203, "Alpha " + passages[2].upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substring_dedup.remove_repeats(docs, window=window).collect()
    assert Counter(map(tuple, found)) == plain_repeats(rows, window)


def test_repeats_of_edge_rows(spark):
    found = substring_dedup.remove_repeats(edge_documents(spark)).collect()
    assert Counter(map(tuple, found)) == plain_repeats([(i, t) for i, t, *_ in edge_rows()], 35)
    assert substring_dedup.remove_repeats(empty_documents(spark)).count() == 0


def test_covers_have_every_difference():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_registered_queries_give_their_columns(spark, sf_dir):
    columns = {
        "op1_binary_records": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op3_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op4_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        "op5_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
        "op6_url_filters": ["page_id", "host", "path", "rule", "verdict"],
        "op7_line_dedup": ["doc_id", "n_lines", "n_removed", "kept_sha256"],
        "op8_html_extraction": ["page_id", "url", "text", "n_chars"],
        "op9_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op11_lexical_search": ["item_id", "rank", "doc_id", "score"],
        "op12_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
        "op13_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    }
    assert list(queries()) == list(columns)
    assert set(oracle_sql()) < set(columns)
    for name in ("op4_license_scan", "op8_html_extraction", "op9_substring_dedup", "op11_lexical_search", "op12_nearest_neighbours", "op13_token_alignment"):
        assert queries()[name](spark, sf_dir).columns == columns[name]


def test_pipeline(spark, sf_dir, tmp_path):
    """Every stage keeps the columns and what it should, on the smallest tables with edge rows beside them."""
    read = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [((10_100 if i is None else 10_000) + (i or k), t, lang, s, n) for k, (i, t, lang, s, n, *_) in enumerate(edge_rows())]
    docs = read.unionByName(spark.createDataFrame(extra, read.schema)).withColumn("id", F.lit("clash")).withColumn("_removed", F.lit(5))
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{number}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        rows, kept = before.collect(), docs.collect()
        if number < 4:
            assert docs.columns == before.columns
        ids = {r["doc_id"] for r in kept}
        if name == "quality_rules":
            for r in rows:
                words = spaced(r["text"])
                if len(words) < 20:
                    assert r["doc_id"] not in ids
        if name == "near_dedup":
            groups, _ = near_groups([(r["doc_id"], r["text"]) for r in rows], 80)
            assert ids == {r["doc_id"] for r in rows if groups.find(r["doc_id"]) == r["doc_id"]}
        if name == "decontamination":
            from test_search_operators import hits, plain

            for r in rows:
                words = plain(r["text"])
                covered, _ = hits(words, benchmark)
                assert (r["doc_id"] in ids) != (bool(covered) and 20 * len(covered) >= len(words))
        if name == "line_dedup":
            seen = Counter(line.strip().translate(LOWERED) for r in kept for line in (r["text"] or "").split("\n"))
            assert not [line for line, n in seen.items() if n > 1 and len(line) >= 20]
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in rows}
    assert sum(r["length"] for r in kept) == sum({r["doc_id"]: r["doc_tokens"] for r in kept}.values())


def test_empty_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_line_buckets_however_their_rows_are_cut():
    """Pairs of small buckets, members of larger ones, over any batches; a bucket too long to wait for goes on as members."""
    rng = np.random.default_rng(16)
    sizes = [1, 2, 3, line_dedup.SMALL, line_dedup.SMALL + 1, 40, 1, line_dedup.OPEN_ROWS + 5000, 2, 1]
    key = np.repeat(np.arange(len(sizes)) * 10 - 30, sizes)
    item = np.concatenate([np.arange(n) for n in sizes]) + key * 100_000
    item[key == -10] = item[key == -10][0]  # copies of one line
    number = rng.choice([100, 110, 200], len(key))
    number[(key == 0) & (item % 2 == 0)] = 0
    expected = set()
    for k in np.unique(key):
        held = dict(zip(item[key == k].tolist(), number[key == k].tolist(), strict=True))
        if len(held) > line_dedup.SMALL:
            expected |= {(int(k), a, None) for a in held}
        else:
            expected |= {(int(k), a, b) for a in held for b in held if a < b and 100 * min(held[a], held[b]) >= 80 * max(held[a], held[b])}
    for cut in (7, 1000, len(key)):
        given = pa.RecordBatch.from_arrays([pa.array(key), pa.array(item), pa.array(number.astype(np.int32))], names=["key", "item", "n"])
        made = line_dedup._bucket_rows(80)(given.slice(k, cut) for k in range(0, len(key), cut))
        assert {tuple(row.values()) for batch in made for row in batch.to_pylist()} == expected
    assert not list(line_dedup._bucket_rows(80)(iter([])))


def test_unrelated_lines_share_few_buckets():
    """Bands of five rows: of lines that share a fifth of their shingles few meet, of those that share 0.8 hardly one is missed."""
    rng = np.random.default_rng(17)

    def meeting(common, pairs=2000, n=200):
        hashes = rng.integers(0, 1 << 63, (pairs, 2 * n - common), dtype=np.uint64) * np.uint64(2)
        keys = [
            line_dedup.band_keys(line_dedup.registers_of(np.ascontiguousarray(h).reshape(-1), np.full(pairs, n)))
            for h in (hashes[:, :n], hashes[:, n - common :])
        ]
        return (keys[0] == keys[1]).any(axis=1).mean()

    assert meeting(178) >= 0.998
    assert meeting(67) <= 0.02
