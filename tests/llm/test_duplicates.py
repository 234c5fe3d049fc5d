"""Near duplicates, repeated passages and the pipeline against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from autoledger.llm import graph, near_duplicates, packing, queries, substrings
from autoledger.llm.common import CHARS_A_FILE, ROWS_A_FILE, files_for

from .conftest import SMALL, awkward_rows


class Classes:
    def __init__(self, items):
        self.up = {item: item for item in items}

    def root(self, item):
        while self.up[item] != item:
            item = self.up[item]
        return item

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def brute_classes(texts: dict[int, str]) -> dict[int, int]:
    bags = {i: Counter(near_duplicates.shingles_of(text).tolist()) for i, text in texts.items()}
    holders = defaultdict(list)
    for i, bag in bags.items():
        for shingle in bag:
            holders[shingle].append(i)
    classes = Classes(sorted(texts))
    for a, b in {pair for held in holders.values() for pair in combinations(sorted(held), 2)}:
        common = sum((bags[a] & bags[b]).values())
        if common >= 0.8 * (bags[a].total() + bags[b].total() - common):
            classes.join(a, b)
    wordless = [i for i, bag in bags.items() if not bag]
    for a, b in zip(wordless, wordless[1:]):
        if texts[a] == texts[b]:
            classes.join(a, b)
    return {i: classes.root(i) for i in texts}


def words(draw: random.Random, n: int) -> list[str]:
    return ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(n)]


def test_signatures_estimate_weighted_jaccard():
    draw = random.Random(5)
    for share in (0.02, 0.05, 0.1):
        one = words(draw, 200)
        one[50:100] = ["x"] * 50
        other = [word if draw.random() > share else words(draw, 1)[0] for word in one]
        a, b = " ".join(one), " ".join(other)
        signed = near_duplicates.signatures([a, b, a], 4000)
        assert abs((signed[0] == signed[1]).mean() - near_duplicates.weighted_jaccard(a, b)) < 0.04
        assert (signed[0] == signed[2]).all()


def test_signature_does_not_depend_on_the_batch():
    draw = random.Random(6)
    alone = near_duplicates.signatures(["one"], 120)
    among = near_duplicates.signatures([" ".join(words(draw, 3000)), "one", ""], 120)
    assert (alone[0] == among[1]).all() and not among[2].any()
    assert np.isfinite(among[:2].view(np.float64)).all()


def test_classes_equal_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = queries.op9_minhash_near_dedup(spark, SMALL).collect()
    assert {row.doc_id: row.class_id for row in rows} == brute_classes({r.doc_id: r.text or "" for r in docs})


def test_large_group_of_edited_copies(spark):
    """Copies of one text, each with its own edits: most are linked to the text and to no other copy."""
    draw = random.Random(7)
    base = words(draw, 120)
    texts = {0: " ".join(base)}
    for i in range(1, 120):
        copy = list(base)
        for _ in range(draw.choice([1, 2, 3, 4, 6])):
            copy[draw.randrange(len(copy))] = words(draw, 1)[0]
        texts[i] = " ".join(copy)
    texts.update({i: " ".join(words(draw, 80)) for i in range(120, 160)})
    rows = near_duplicates.classes(
        spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    ).collect()
    assert {row.doc_id: row.class_id for row in rows} == brute_classes(texts)


def test_large_group_of_copies_of_copies_of_many_lengths(spark):
    """Cut and edited copies, of the text and of one another: links run between texts that no pivot is similar to."""
    draw = random.Random(12)
    texts = {0: words(draw, 150)}
    for i in range(1, 140):
        copy = list(texts[draw.randrange(i) if draw.random() < 0.5 else 0])
        for _ in range(draw.choice([0, 1, 2, 4])):
            copy[draw.randrange(len(copy))] = words(draw, 1)[0]
        texts[i] = copy[draw.randrange(8) : len(copy) - draw.randrange(8)]
    texts = {i: " ".join(text) for i, text in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_duplicates.classes(docs).collect()
    assert {row.doc_id: row.class_id for row in rows} == brute_classes(texts)


def test_prefixes_are_as_short_as_the_sizes_under_a_pivot_allow(spark):
    """For texts of 100 shingles 89 are to be shared, not 80; texts out of reach of all others apart have no prefix."""
    held = {"p": range(100), "near": range(90), "far": range(15, 100), "short": range(70)}
    held.update({f"copy{i}": [*range(i), *range(i + 5, 100)] for i in range(20)})
    size = {"short": 70}
    of_class = ["p", *(name for name in held if name.startswith("copy")), "short"]
    fields = "bucket long, node string, root string, n long, m long"
    members = [(1, k, "p" if k in of_class else k, size.get(k, 100), len(v)) for k, v in held.items()]
    found = near_duplicates.prefixes(
        spark.createDataFrame(members, fields),
        spark.createDataFrame([(1, "p")], "bucket long, pivot string"),
        spark.createDataFrame([(name, "p") for name in of_class], "node string, root string"),
        spark.createDataFrame([(k, list(v)) for k, v in held.items()], "node string, shared array<long>"),
        0.8,
    )
    got = {row.node: (len(row.prefix), row.apart) for row in found.collect()}
    copies = {f"copy{i}": (95 - 89 + 1, False) for i in range(20)}
    assert got == {"p": (100 - 89 + 1, False), "near": (90 - 89 + 1, True), **copies}


def test_classes_of_awkward_rows(spark, awkward_wide, empty):
    rows = near_duplicates.classes(awkward_wide).collect()
    got = Counter((row.doc_id, row.class_id) for row in rows)
    assert got == Counter(
        {
            (1, 1): 1,
            (2, 1): 1,
            (None, 1): 1,
            (3, 3): 1,
            (4, 4): 2,
            (5, 4): 1,
            (None, None): 1,
            (6, 6): 1,
            (7, 7): 1,
        }
    )
    kept = near_duplicates.first_of_each(awkward_wide)
    assert kept.columns == awkward_wide.columns
    assert sorted((row.doc_id or 0) for row in kept.collect()) == [0, 1, 3, 4, 6, 7]
    assert near_duplicates.classes(empty).count() == 0
    assert near_duplicates.first_of_each(empty).count() == 0


def test_one_id_in_two_classes_keeps_a_row_of_each(spark):
    draw = random.Random(11)
    one, two, three = (" ".join(words(draw, 60)) for _ in range(3))
    rows = [(1, one), (1, two), (1, two), (2, one), (3, two), (4, three), (None, three), (None, one + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(row.doc_id, row.text) for row in near_duplicates.first_of_each(docs).collect()]
    assert Counter(kept) == Counter([(1, one), (1, two), (4, three)])
    roots = {(row.doc_id, row.node): row.root for row in near_duplicates.classes(docs).collect()}
    assert len(set(roots.values())) == 3


def test_components_of_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(30)] + [(40, 41), (41, 42), (42, 40), (50, 50)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {row.node: row.root for row in found}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 42: 40}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def planted(seed: int) -> tuple[dict[int, list[str]], dict[int, set[int]]]:
    """Texts, and for each that holds a passage which an earlier one holds, the earlier ones."""
    draw = random.Random(seed)
    texts = {i: words(draw, draw.randint(60, 300)) for i in range(120)}
    later = {}
    free = list(range(90))
    draw.shuffle(free)
    for _ in range(30):
        ids = sorted(free.pop() for _ in range(3))
        passage = words(draw, draw.randint(51, 60))
        for i in ids:
            at = draw.randint(0, len(texts[i]))
            texts[i][at:at] = passage
        later.update({i: {ids[0]} for i in ids[1:]})
    return texts, later


def test_planted_passages_are_found_and_nothing_else(spark):
    for seed in (1, 2):
        texts, later = planted(seed)
        docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
        found = defaultdict(set)
        for row in substrings.repeated_spans(docs).collect():
            found[row.doc_id] |= set(row.first_docs)
            text = " ".join(texts[row.doc_id])
            span = text[row.start : row.end]
            assert len(span.split()) == row.words
            assert span in " ".join(texts[row.first_docs[0]])
        assert found.keys() == later.keys()
        # Where the ends of two texts are alike as well, a chunk there may be new to the second of three.
        assert all(later[i] <= found[i] for i in later)


def test_repeats_are_cut_and_the_rest_is_kept(spark):
    draw = random.Random(8)
    passage, head, tail = words(draw, 80), words(draw, 30), words(draw, 30)
    docs = spark.createDataFrame(
        [(1, " ".join(passage), "x", 1), (2, " ".join(head + passage + tail), "x", 1), (3, None, "x", None)],
        "doc_id long, text string, digest string, n_chars int",
    )
    rows = {row.doc_id: row for row in substrings.without_repeats(docs).collect()}
    assert rows[1].text == " ".join(passage) and rows[1].n_chars == 1 and rows[3].text is None
    left = rows[2].text.split()
    assert left[:30] == head and left[-30:] == tail and len(left) <= 60 + 30
    assert rows[2].n_chars == len(rows[2].text)


def test_repeats_of_awkward_rows(spark, awkward_wide, empty):
    whole = " ".join(f"w{i}" for i in range(70))
    extra = spark.createDataFrame([(None, whole), (8, whole), (8, whole), (9, whole)], "doc_id long, text string")
    found = substrings.repeated_spans(extra).collect()
    assert sorted((row.doc_id, row.words, row.first_docs) for row in found)[-1][0] == 9
    assert substrings.repeated_spans(awkward_wide).count() == 0
    assert substrings.repeated_spans(empty).count() == 0
    cut = substrings.without_repeats(awkward_wide)
    assert cut.columns == awkward_wide.columns and cut.count() == len(awkward_rows())


def test_spans_of_repeated_rows_are_whole(spark):
    """A row that is there twice, and two texts under one id, have the spans that each has alone."""
    draw = random.Random(10)
    first, other = words(draw, 200), words(draw, 60)
    one = words(draw, 20) + first + words(draw, 20)
    two = words(draw, 70) + other + words(draw, 10)
    firsts = [(1, " ".join(first)), (2, " ".join(other))]

    def spans(rows):
        docs = spark.createDataFrame(firsts + rows, "doc_id long, text string")
        found = [(r.doc_id, r.start, r.end, r.words, r.first_docs) for r in substrings.repeated_spans(docs).collect()]
        left = Counter((r.doc_id, r.text) for r in substrings.without_repeats(docs).collect())
        return sorted(found), left - Counter(firsts)

    one, two = (8, " ".join(one)), (8, " ".join(two))
    (of_one, left_of_one), (of_two, left_of_two) = spans([one]), spans([two])
    assert [len(of_one), len(of_two)] == [1, 1] and of_one[0][3] > 180 and of_two[0][3] > 40
    assert spans([one, one, one]) == (of_one, left_of_one + left_of_one + left_of_one)
    both, left = spans([one, two, two])
    assert both == sorted(of_one + of_two)
    assert left == left_of_one + left_of_two + left_of_two


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, stage(spark, rows, SMALL)
        assert rows.columns == docs.columns, name
        rows = spark.createDataFrame(rows.collect(), docs.schema)
        ids = [row.doc_id for row in rows.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {row.doc_id for row in before.collect()}
        if name == "near_dedup":
            classes = brute_classes({row.doc_id: row.text for row in before.collect()})
            assert set(ids) == set(classes.values())
        if name == "substring_dedup":
            assert len(ids) == before.count()
            assert substrings.repeated_spans(before).count() > 0
    last = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()}
    import public_tokenizers

    packed = packing.packed(rows, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert last == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed}


def test_files_of_working_tables_go_by_the_documents(spark, settings):
    """With many more shuffle partitions than the documents need, tables are not written in one file for each."""
    settings(
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("autoledger-*/*"))
    kept = {name: stage(spark, docs, SMALL) for name, stage in corpus_pipeline.STAGES[1:]}
    most = files_for(docs)
    assert most == spark.sparkContext.defaultParallelism
    assert {name: rows.rdd.getNumPartitions() for name, rows in kept.items()} == dict.fromkeys(kept, most)
    written = {folder: len(list(folder.glob("part-*"))) for folder in set(shared.glob("autoledger-*/*")) - before}
    assert {"nodes", "links", "edges", "shared", "windows", "prefixes"} <= {folder.name for folder in written}
    assert {str(folder): files for folder, files in written.items() if files > most} == {}
    classes = brute_classes({row.doc_id: row.text for row in docs.collect()})
    assert {row.doc_id for row in kept["near_dedup"].collect()} == set(classes.values())


def test_files_follow_rows_and_characters(spark, settings):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(cores * ROWS_A_FILE + 1).select("id", F.lit("x").alias("text"))
    long = spark.range(cores + 1).select(F.repeat(F.lit("x"), CHARS_A_FILE).alias("text"))
    assert files_for(many) is None
    settings(spark__sql__shuffle__partitions="40", spark__sql__adaptive__coalescePartitions__enabled="false")
    assert [files_for(many.limit(n)) for n in (0, 1)] == [cores, cores]
    assert [files_for(many), files_for(long)] == [cores + 1, cores + 1]
    settings(spark__sql__shuffle__partitions=str(2 * cores))
    assert files_for(many) is None


def test_hot_passages_give_the_same_spans(spark, settings):
    """With many partitions a passage that most documents share is hot, with few it is not."""
    draw = random.Random(31)
    passage = " ".join(words(draw, 40))
    rows = [(i, " ".join([*words(draw, 5), passage, *words(draw, 5)])) for i in range(80)]
    rows += [(None, passage), (90, passage), (90, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for partitions in ("4", "200"):
        settings(spark__sql__shuffle__partitions=partitions)
        cut = substrings.chunks(docs)
        assert bool(substrings.hot_key_lanes(cut, [substrings.F.col("digest")], int(partitions))) == (partitions == "200")
        found.append(sorted(map(repr, substrings.repeated_spans(docs).collect())))
    assert found[0] == found[1] and len(found[0]) == 81
