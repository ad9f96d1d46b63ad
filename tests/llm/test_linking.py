"""Benchmark matches and quotation threads."""

import random

from pyspark.sql import functions as F

from skyweave.llm import contamination, quotation_threads, sql

from .conftest import prose


def slow_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_edit_matches_are_those_of_the_full_table():
    r = random.Random(1)
    for _ in range(200):
        item = "".join(r.choice("abc ") for _ in range(r.randint(9, 90))).strip(" ") or "abcabcabc"
        k = contamination.budget(len(item))
        other = list(item)
        for _ in range(r.randint(0, k + 2)):
            j = r.randrange(len(other))
            other[j : j + r.randint(0, 1)] = r.choice(["z", "", "yy"])
        text = "".join(r.choice("abc ") for _ in range(40)) + "".join(other) + "".join(r.choice("abc ") for _ in range(40))
        best = slow_distance(item, text)
        got = contamination.Items([(7, item)]).matches(text)
        assert [(i, e) for i, e, _ in got] == ([(7, best)] if best <= k else [])


def test_matches_and_clean(odd, none, items):
    got = contamination.matches(odd, items).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got) == [(1, 1, 0), (2, 1, 0), (2, 1, 0)]
    in_blocks = contamination.matches(odd, items, block_chars=10).collect()
    assert sorted(map(tuple, in_blocks)) == sorted(map(tuple, got))
    kept = contamination.clean(odd, items, block_chars=10)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert contamination.matches(none, items).count() == 0 and contamination.clean(odd, items.where("false")).count() == odd.count()


def test_an_edited_passage_is_found(spark, items):
    passage = prose(1, 80)[20:150]
    docs = spark.createDataFrame([(1, prose(9, 30) + "\n" + passage[:50].upper() + "  q" + passage[52:] + " end")], "doc_id long, text string")
    assert [(r.item_id, r.edits > 0) for r in contamination.matches(docs, items).collect()] == [(1, True)]


def test_a_leak_in_capitals_is_found(spark):
    item = "Doesbo dora el ñ es, queasarjarr mente, ciónmiírr asesrr ños ueíos ueie, osesgaiedo. Esci llar osñ que. De lldo de, osue do el ueciónez no ññci."
    docs = spark.createDataFrame([(1699, "ANHA!! OF!! THE!! " + item.upper() + "!! IN!! HEND!!"), (1, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(130, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.edits) for r in contamination.matches(docs, items).collect()] == [(1699, 130, 0)]
    assert [r.doc_id for r in contamination.clean(docs, items).collect()] == [1]


def test_a_tenth_of_an_item_may_be_edited(spark):
    item = prose(1, 80)[20:115].strip()
    word = item.split()[4]
    other = item.replace(word, "q" * len(word), 1).replace("l", "1", 2)
    assert 5 <= slow_distance(item, other) <= len(item) // 10
    got = contamination.Items([(1, item)]).matches("some words " + other + " and more")
    assert [(i, e) for i, e, _ in got] == [(1, slow_distance(item, other))]


def test_threads(spark):
    rows = [
        (1, 0, "user", "Hello there\nhow are You?"),
        (1, 1, "assistant", "other   things"),
        (1, 2, "user", "> hello THERE\n> how are you?\nfine"),
        (1, 3, "a", "Bob wrote:\n>> hello there\n> fine\ngreat"),
        (1, 4, "b", ">other things\nyes"),
        (1, 5, "b", "> > deep\n> great\n\nlast"),
        (2, 0, "x", "> nothing"),
        (2, 0, "x", "> nothing"),
        (None, 3, None, None),
        (3, None, "u", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit(1))
    got = quotation_threads.threads(df).collect()
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [(r.turn, r.reply_to, r.depth, r.content) for r in one] == [
        (0, None, 0, "Hello there\nhow are You?"), (2, 0, 1, "fine"), (3, 2, 2, "great"), (5, 3, 3, "last"), (1, None, 0, "other   things"), (4, 1, 1, "yes"),
    ]
    assert [r.quote_levels for r in one] == [0, 1, 2, 2, 0, 1]
    assert sorted(r.position for r in got if r.conv_id == 2) == [0, 1]
    assert len(got) == len(rows) and {r.role for r in got if r.conv_id is None} == {"unknown"}
    assert quotation_threads.threads(df.where("false")).count() == 0
    import duckdb

    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    twin = con.execute(sql.QUOTATION_THREADS)
    at = {c[0]: i for i, c in enumerate(twin.description)}
    assert sorted(str(tuple(r[at[c]] for c in got[0].__fields__)) for r in twin.fetchall()) == sorted(str(tuple(r)) for r in got)


def test_long_threads_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(quotation_threads, "BUCKET", 3)
    chain = [(1, i, "u", (f"> word{i - 1} x\n" if i else "") + f"word{i} x") for i in range(20)]
    fan = [(2, 0, "u", "root line")] + [(2, i, "u", f"> root line\nanswer {i}" if i % 2 else f"alone {i}") for i in range(1, 30)]
    got = quotation_threads.threads(spark.createDataFrame(chain + fan, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.turn, r.depth) for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == [(i, i) for i in range(20)]
    two = [r.turn for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position)]
    assert two == [0, *range(1, 30, 2), *range(2, 30, 2)]
