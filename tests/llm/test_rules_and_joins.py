"""Quality rules, decontamination, revisits and backoff against SQL; licenses; awkward rows for all of them."""

from __future__ import annotations

import math
import random
import textwrap
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from autoledger.llm import backoff, decontamination, licenses, quality_rules, queries, revisits

from .conftest import SMALL, awkward_rows

WITH_SQL = sorted(queries.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, sql_rows, name):
    rows = queries.queries()[name](spark, SMALL)
    got = sorted(repr(tuple(row)) for row in rows.collect())
    assert got == sql_rows(queries.oracle_sql()[name], rows.columns)


def test_lines_that_fail_are_removed(spark):
    prose = " ".join(f"word{i}" for i in range(80)) + "."
    text = "\n".join(
        [
            prose,
            "Home | About | Contact | More",
            "All rights reserved.",
            "BUY!! NOW!! CHEAP!!",
            "### $$$ %%% words &&&",
            "a line of more than ten words that just stops without any",
            "A short heading",
            "",
            "The last line may be cut off by the end of the text and so",
        ]
    )
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = quality_rules.quality_rules(docs).first()
    assert row.kept and row.cleaned.split("\n") == [
        prose,
        "A short heading",
        "",
        "The last line may be cut off by the end of the text and so",
    ]


def test_documents_that_lose_too_much_are_rejected(spark):
    bad = "Home | About | Contact | More | " * 20
    good = "Plain words end with a stop. " * 3
    different = " ".join(f"word{i}" for i in range(60)) + "."
    docs = spark.createDataFrame(
        [(1, f"{good}\n{bad}"), (2, different), (3, "same same same " * 30 + "."), (4, "few words.")],
        "doc_id long, text string",
    )
    rows = {row.doc_id: row for row in quality_rules.quality_rules(docs).collect()}
    assert [(i, rows[i].base_failed, rows[i].kept) for i in sorted(rows)] == [
        (1, True, False),
        (2, False, True),
        (3, True, False),
        (4, True, False),
    ]
    assert quality_rules.kept_documents(docs).select("doc_id").collect() == [(2,)]


def test_clean_lines_of_other_kinds_stay(spark):
    words = [f"word{i}" for i in range(120)]
    wrapped = textwrap.fill(" ".join([*words[:60], "Name", "Other", *words[60:]]) + ".", 72)
    other_scripts = [" ".join(words[i : i + 12]) + end for i, end in ((0, "।"), (12, "؟"), (24, "۔"), (36, "。"))]
    texts = [
        " ".join(words) + " as the privacy policy says.",
        "\n".join([*other_scripts, " ".join(words[48:60]) + "."]),
        wrapped,
        " ".join(words) + ".\n" + " ".join(words[:12]) + "\nOther words follow here.",
        " ".join(words) + ".\nRead our privacy policy and terms of use.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(quality_rules.quality_rules(docs).collect())
    assert [row.cleaned == text for row, text in zip(rows, texts)] == [True, True, True, False, False]
    assert rows[3].cleaned == texts[3].split("\n")[0] + "\nOther words follow here."
    assert rows[4].cleaned == texts[4].split("\n")[0]
    assert all(row.kept for row in rows)


def test_quality_rules_and_their_sql_agree_on_random_lines(spark):
    draw = random.Random(10)
    ends = ["", ".", "!", "।", "؟\u00bb", "\u061d", "\u037e", "。」", ",", ";", "…"]
    starts = ["", "Title ", "\u201cquoted ", "(aside ", "Über ", "über ", "ßharp ", "\t", "  ", "|", "» » » "]
    phrases = ["", "", "privacy policy", "Terms of USE and click here", "#$%", "!!! !!!"]

    def line() -> str:
        stems = draw.choices(["word", "Name", "other", "über", "ΑΒΓ", "数"], k=draw.choice([0, 2, 9, 10, 14, 22]))
        words = " ".join(stem + str(draw.randrange(40)) for stem in stems)
        rest = [draw.choice(part) for part in (["", " "], phrases, ends, ["", "", " ", "\r", "\u3000"])]
        return draw.choice(starts) + words + "".join(rest)

    texts = [None, "", "\n", " \n\n "] + ["\n".join(line() for _ in range(draw.randrange(1, 14))) for _ in range(400)]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = quality_rules.quality_rules(docs).drop("cleaned", "lost_chars").toPandas()
    with duckdb.connect() as connection:
        connection.register("documents", documents)
        expected = connection.sql(quality_rules.SQL).df()
    in_order = [frame.sort_values("doc_id").reset_index(drop=True)[list(expected.columns)] for frame in (found, expected)]
    pd.testing.assert_frame_equal(*in_order, check_dtype=False)
    assert 20 < in_order[0]["kept"].sum() < len(texts) - 20


def test_repeated_words_count_each_word_once(spark):
    cases = {"a b c a b c": 6, "a a a a": 4, "a b c d": 0, "a b c x a b c": 6, "x a b c a b c y": 6, "a b": 0}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    rows = quality_rules.quality_rules(docs).select("doc_id", "n_repeat_words").collect()
    assert [n for _, n in sorted(map(tuple, rows))] == list(cases.values())


def test_contamination_by_hand(spark):
    item = "one two three four five six seven eight nine ten eleven"
    items = [
        ("long", item),
        ("short", "Alpha, beta"),
        ("none", "..."),
        (None, "null id words here"),
        ("null", None),
    ]
    docs = [
        (1, f"before {item.upper()} after"),
        (2, "two three four five six seven eight nine ten"),
        (3, "alpha BETA gamma alpha-beta"),
        (4, None),
        (5, "null id words here"),
        (3, "alpha BETA gamma alpha-beta"),
        (None, "alpha beta"),
    ]
    found = decontamination.decontamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id string, text string"),
    )
    rows = sorted((row.doc_id or 0, row.n_words, row.n_hit, tuple(row["items"])) for row in found.collect())
    assert rows == [
        (0, 2, 2, ("short",)),
        (1, 13, 11, ("long",)),
        (2, 9, 0, ()),
        (3, 5, 4, ("short",)),
        (3, 5, 4, ("short",)),
        (4, 0, 0, ()),
        (5, 4, 4, ()),
    ]


def test_decontamination_of_awkward_rows(spark, awkward, awkward_wide, empty):
    items = spark.createDataFrame([("a", "one"), ("b", "no id at")], "item_id string, text string")
    found = decontamination.decontamination(awkward_wide, items)
    hits = sorted((row.doc_id or 0, row.n_hit) for row in found.collect() if row.contaminated)
    assert hits == [(0, 3), (4, 1), (4, 1), (5, 1)]
    assert decontamination.decontamination(empty, items).count() == 0
    none = items.limit(0)
    assert decontamination.decontamination(awkward, none).filter("contaminated").count() == 0
    clean = decontamination.clean_documents(awkward_wide, items)
    assert clean.columns == awkward_wide.columns and clean.count() == 6


def test_quality_of_awkward_rows(spark, awkward_wide, empty):
    rows = quality_rules.quality_rules(awkward_wide)
    assert rows.count() == len(awkward_rows())
    assert rows.filter("n_words = 0").count() == 4
    assert quality_rules.quality_rules(empty).count() == 0
    kept = quality_rules.kept_documents(awkward_wide)
    assert kept.columns == awkward_wide.columns


def captures(spark, rows):
    return spark.createDataFrame(
        rows,
        "record_id long, url string, time long, kind string, etag string, last_modified string,"
        " digest string, headers map<string,string>, node string",
    )


def test_revisits_by_hand(spark):
    url = "https://www.Example.com:443/a/?b=2&utm_source=x&a=1#top"
    same = "http://example.com/a?a=1&b=2"
    response = {"Content-Type": "text/html", "Date": "1", "ETag": "old"}
    update = {"date": "2", "content-type": "x", "Connection": "close"}
    rows = [
        (1, url, 10, "response", "e1", None, None, response, "x"),
        (2, same, 20, "response", "e2", "m", None, None, "x"),
        (3, same, 15, "revisit", "e1", None, None, update, "x"),
        (4, same, 20, "revisit", "e1", None, None, update, "x"),
        (5, same, 21, "revisit", "e1", None, None, update, "x"),
        (6, same, 30, "revisit", None, "m", None, update, "x"),
        (7, same, 5, "revisit", "e1", None, None, None, "x"),
        (8, None, 30, "revisit", "e1", None, None, None, "x"),
        (9, same, None, "revisit", "e1", None, None, None, "x"),
        (10, same, 31, "revisit", None, None, "d", None, "x"),
        (10, same, 31, "revisit", None, None, "d", None, "x"),
    ]
    for lanes in (1, 3, 50):
        found = revisits.resolved_revisits(captures(spark, rows), lanes=lanes).collect()
        got = sorted((r.record_id, r.status, r.response_id) for r in found)
        assert got == [
            (3, "resolved", 1),
            (4, "resolved", 1),
            (5, "mismatch", None),
            (6, "resolved", 2),
            (7, "orphan", None),
            (8, "orphan", None),
            (9, "orphan", None),
            (10, "unchecked", 2),
            (10, "unchecked", 2),
        ]
        headers = next(r.headers for r in found if r.record_id == 3)
        assert [tuple(entry) for entry in headers] == [
            ("content-type", "text/html"),
            ("date", "2"),
            ("etag", "old"),
        ]
    assert revisits.resolved_revisits(captures(spark, [])).count() == 0


def test_parameters_that_name_content_are_kept(spark):
    """``ref`` and ``sid`` select a page unless the caller says otherwise; the parameters of a visit never do."""
    main, dev = "http://code/f?ref=main&utm_source=x&PHPSESSID=1", "http://code/f?jsessionid=2&ref=dev"
    rows = [
        (1, main, 1, "response", "e1", None, None, None, "x"),
        (2, dev, 2, "response", "e2", None, None, None, "x"),
        (3, "http://code/f?ref=main", 3, "revisit", "e1", None, None, None, "x"),
        (4, "http://code/f?sid=17&sessionid=3&utm=1", 4, "revisit", None, None, None, None, "x"),
    ]
    found = sorted(revisits.resolved_revisits(captures(spark, rows)).collect())
    assert [(r.record_id, r.url_key, r.status, r.response_id) for r in found] == [
        (3, "code/f?ref=main", "resolved", 1),
        (4, "code/f?sid=17&utm=1", "orphan", None),
    ]
    dropped = revisits.resolved_revisits(captures(spark, rows), visit_parameters=rf"{revisits.VISIT_PARAMETERS}|ref|sid")
    assert [(r.url_key, r.status) for r in sorted(dropped.collect())] == [
        ("code/f", "mismatch"),
        ("code/f?utm=1", "orphan"),
    ]


def test_query_drops_the_parameters_that_its_sql_names(spark, tmp_path):
    """Captures of one page under links with ``ref`` and ``sid`` are of one page, in the query as in its SQL."""
    urls = ["http://a/p?page=2", "http://a/p?page=2&ref=x", "https://www.a/p?sid=9&page=2", None]
    pages = pd.DataFrame({"page_id": [4, 7, 11, 12], "url": urls, "html": ["same", "same", "same", None]})
    pages.to_parquet(tmp_path / "pages.parquet")
    rows = queries.op3_warc_revisits(spark, str(tmp_path))
    got = rows.collect()
    found = {row.record_id: (row.url_key, row.status, row.response_id) for row in got}
    assert found[15] == ("a/p?page=2", "resolved", 8) and found[23] == ("a/p?page=2", "resolved", 14)
    assert {url for url, _, _ in found.values()} == {"a/p?page=2", None}
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    expected = connection.sql(f"SELECT {', '.join(rows.columns)} FROM ({queries.oracle_sql()['op3_warc_revisits']})")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected.fetchall()))


def test_connection_headers_are_not_merged(spark):
    rows = [
        (1, "http://a/", 1, "response", None, None, None, {"A": "1"}, "x"),
        (2, "http://a/", 2, "revisit", None, None, None, {"Connection": "close", "a": "3"}, "x"),
    ]
    (row,) = revisits.resolved_revisits(captures(spark, rows)).collect()
    assert [tuple(entry) for entry in row.headers] == [("a", "3")]


def test_one_hot_url_is_dealt_over_lanes(spark):
    rows = [(i, "http://hot/", i, "response" if i % 10 == 0 else "revisit") for i in range(3000)]
    table = spark.createDataFrame(rows, "record_id long, url string, time long, kind string").select(
        "*",
        *[F.lit(None).cast("string").alias(name) for name in ("etag", "last_modified", "digest")],
        F.lit(None).cast("map<string,string>").alias("headers"),
    )
    found = revisits.resolved_revisits(table, lanes=20).select("record_id", "response_id").collect()
    assert all(row.response_id == row.record_id // 10 * 10 for row in found) and len(found) == 2700


def test_bodies_of_revisits(spark):
    rows = [
        (1, "http://a/", 1, "response", None, None, None, None, "x"),
        (2, "http://a/", 2, "revisit", None, None, None, None, "x"),
    ]
    found = revisits.resolved_revisits(captures(spark, rows))
    bodies = spark.createDataFrame([(1, "body")], "record_id long, html string")
    assert revisits.with_bodies(found, bodies).select("record_id", "html").collect() == [(2, "body")]


def test_backoff_of_awkward_rows(spark, awkward_wide, empty):
    rows = backoff.scores(awkward_wide).collect()
    assert len(rows) == len(awkward_rows())
    assert sorted(row.n_tokens for row in rows)[:5] == [0, 0, 0, 0, 1]
    assert all((row.mean_log_score is None) == (row.n_tokens == 0) for row in rows)
    assert backoff.scores(empty).count() == 0


def scores_by_hand(texts: list[str], order: int, min_count: int) -> list[tuple]:
    split = [text.lower().split() for text in texts]
    total = sum(map(len, split))
    counts = Counter(
        tuple(w[i : i + n]) for w in split for n in range(1, order + 1) for i in range(len(w) - n + 1)
    )

    def score(gram: tuple) -> float:
        if len(gram) == 1:
            return counts[gram] / total
        if counts[gram] >= min_count:
            return counts[gram] / counts[gram[:-1]]
        return backoff.BACKOFF * score(gram[1:])

    result = []
    for w in split:
        longest = [tuple(w[max(0, i - order + 1) : i + 1]) for i in range(len(w))]
        backed = sum(len(gram) > 1 and counts[gram] < min_count for gram in longest)
        mean = sum(math.log(score(gram)) for gram in longest) / len(w) if w else None
        result.append((len(w), backed, mean))
    return result


@pytest.mark.parametrize(("order", "min_count"), [(1, 2), (2, 2), (3, 2), (3, 1), (4, 2), (5, 3)])
def test_backoff_of_any_order(spark, order, min_count):
    draw = random.Random(order)
    texts = [" ".join(draw.choices("abcdefgh", k=draw.choice([0, 1, 2, 3, 40]))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = sorted(backoff.scores(docs, order=order, min_count=min_count).collect())
    got = [(row.n_tokens, row.n_backed_off, row.mean_log_score) for row in rows]
    for one, other in zip(got, scores_by_hand(texts, order, min_count), strict=True):
        assert one[:2] == other[:2] and one[2] == (other[2] and pytest.approx(other[2], abs=1e-9))


def test_sql_of_any_order_agrees_with_the_pairs(sql_rows):
    names = ["doc_id", "n_tokens", "n_backed_off", "mean_log_score"]
    assert sql_rows(backoff.sql(2), names) == sql_rows(backoff.SQL, names)


def test_licenses_and_inheritance(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/one.py", "plain text"),
        ("a/b/two.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
        ("a/b/c/COPYING.txt", "GNU General Public License Version 3, 29 June 2007"),
        ("a/b/c/d/three.py", None),
        ("a/b/c/d/three.py", None),
        ("x/four.py", "nothing here"),
        (None, "Released under the MIT License."),
        (None, "nothing"),
        ("five.py", ""),
    ]
    table = spark.createDataFrame(files, "path string, text string").withColumn("directory", F.lit("z"))
    found = licenses.licenses(table).collect()
    got = sorted((row.path or "", row.license or "", row.origin, row.licensed_by or "") for row in found)
    assert got == [
        ("", "", "none", ""),
        ("", "MIT", "own", ""),
        ("a/LICENSE", "MIT", "own", ""),
        ("a/b/c/COPYING.txt", "GPL-3.0", "own", ""),
        ("a/b/c/d/three.py", "GPL-3.0", "inherited", "a/b/c/COPYING.txt"),
        ("a/b/c/d/three.py", "GPL-3.0", "inherited", "a/b/c/COPYING.txt"),
        ("a/b/one.py", "MIT", "inherited", "a/LICENSE"),
        ("a/b/two.py", "Apache-2.0", "own", ""),
        ("five.py", "", "none", ""),
        ("x/four.py", "", "none", ""),
    ]
    assert licenses.licenses(table.limit(0)).count() == 0


GPL_HEADER = """\
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
"""
BSD_FILE = """\
Copyright (c) 2020, Some Body
All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation.
"""
MIT_FILE = """\
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
"""


def test_wrapped_notices(spark):
    code = "\n".join(f"value{i} = compute(value{i + 1}, other{i})" for i in range(200))
    by_hyphen = "# This work is licensed under a Creative Commons Attribution-\n# ShareAlike 4.0\n# International License."
    rem = "".join(f"REM {line[3:]}\n" for line in GPL_HEADER.splitlines())
    files = [
        ("a.c", f"/* a.c - the first file\n *\n{GPL_HEADER} */\n{code}", "GPL-3.0"),
        ("a.bat", f"@echo off\n{rem}{code}", "GPL-3.0"),
        ("below.c", f"{code}\n{GPL_HEADER}{code}", "GPL-3.0"),
        ("blank.c", GPL_HEADER.replace("\n", "\r\n *\r\n") + code, "GPL-3.0"),
        ("bsd/LICENSE", BSD_FILE, "BSD-3-Clause"),
        ("bsd/plain.py", code, "BSD-3-Clause"),
        ("mit.py", MIT_FILE + code, "MIT"),
        ("sa.py", f"{by_hyphen}\n{code}", "CC-BY-SA-4.0"),
        ("none.py", f"{code}\n# This program is free to modify the terms\n# and the version of its option\n{code}", None),
    ]
    table = spark.createDataFrame([one[:2] for one in files], "path string, text string")
    got = {row.path: (row.license, row.licensed_by) for row in licenses.licenses(table).collect()}
    by = {"bsd/plain.py": "bsd/LICENSE"}
    assert got == {path: (name, by.get(path)) for path, _, name in files}


def test_runs_of_lines_equal_all_runs():
    """What the bound leaves out is never the best run."""
    draw = random.Random(9)
    known = licenses.Templates(licenses.TEMPLATES)
    texts = [text for group in licenses.TEMPLATES.values() for text in group]
    for _ in range(150):
        spelled = " ".join(
            [f"other{draw.random()}", "the terms of use", *draw.sample(texts, 2), f"code{draw.random()}"]
        ).split()
        for _ in range(draw.randrange(12)):
            spelled[draw.randrange(len(spelled))] = "else"
        width = draw.randint(2, 12)
        lines = [" ".join(spelled[at : at + width]) for at in range(0, len(spelled), width)]
        expected = (0.0, None)
        for start in range(len(lines)):
            for end in range(start + 1, len(lines) + 1):
                vector = Counter(licenses.TERM.findall(" ".join(lines[start:end]).lower()))
                expected = max(expected, known.best(known.cosines(vector)), key=lambda one: one[0])
        found = known.license_of("\n".join(lines))
        if expected[0] >= licenses.THRESHOLD:
            assert abs(found[0] - expected[0]) < 1e-12
        else:
            assert found[0] < licenses.THRESHOLD


def test_op2_against_nearest_folder_by_hand(spark):
    rows = queries.op2_license_scan(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    own = {row.path: (row.license, -row.cosine) for row in rows if row.origin == "own"}
    for row in rows:
        if row.origin == "own":
            continue
        folder, expected = row.path.rpartition("/")[0], None
        while expected is None and folder:
            held = [
                (order, path, name)
                for path, (name, order) in own.items()
                if path.rpartition("/")[0] == folder and path.rpartition("/")[2].startswith("LICENSE")
            ]
            expected = min(held)[2] if held else None
            folder = folder.rpartition("/")[0]
        assert row.license == expected


def test_op2_files_go_by_the_documents(spark, settings, tmp_path):
    """With many more shuffle partitions than the files need, neither working table nor result has one for each."""
    notice = "Licensed under the MIT License."
    texts = [notice if n % 9 == 0 else text for n, text in enumerate(["x", "", None] * 40)]
    rows = [(n, text, "en", f"s{n % 30}") for n, text in enumerate(texts)] + [(None, "x", None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.repartition(30).write.parquet(f"{tmp_path}/documents.parquet")
    merged = sorted(map(repr, queries.op2_license_scan(spark, str(tmp_path)).collect()))
    assert len(merged) == len(rows)
    settings(
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__files__maxPartitionBytes="65536",
    )
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("autoledger-*/scanned"))
    found = queries.op2_license_scan(spark, str(tmp_path))
    [scanned] = set(shared.glob("autoledger-*/scanned")) - before
    cores = spark.sparkContext.defaultParallelism
    assert len(list(scanned.glob("part-*"))) <= cores
    found.write.parquet(f"{tmp_path}/found")
    assert len(list((tmp_path / "found").glob("part-*"))) <= cores
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/found").collect())) == merged
