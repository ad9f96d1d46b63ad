"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import duckdb
import pytest

from skyweave.llm import prefix_trie, sql

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        made[c] = base[:h] + turns[h:]
    return own, made


def plain(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, worth = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            worth[node[:d]] += (len(of) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(of), len(node), parent, len(of), len(children[node]), leaves[node], worth[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def talk(seed=3):
    r = random.Random(seed)
    rows = []
    for c in [*range(60), *range(100, 130), 205, 207, 300, -7, -100, 4000]:
        n = r.choice([1, 2, 3, 5, 8]) if c != 107 else 300
        rows += [(c, t, r.choice("ua"), r.choice(["", "x", "yy", "zé😀"])) for t in range(n)]
    rows += [(9000 + c, t, "u", "x" if t < 290 else str(c)) for c in range(3) for t in range(300)]
    rows += [(300, None, None, None), (5, None, "u", None), (None, 1, "u", "lost"), (None, None, None, None)]
    rows += [(9, 1, role, text) for role in "uab" for text in ("tie", "tied", "tie")]
    return rows


SHAPE = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("height,partitions", [(16, 3), (2, 11)])
def test_nodes(spark, height, partitions, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACK", 8)
    rows = talk()
    own, made = plain_rebuilt(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        turns = prefix_trie.turn_rows(spark.createDataFrame(rows, SHAPE).repartition(3))
        assert rows_of(prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns), height)) == plain(made)
        if height == 16:
            assert rows_of(prefix_trie.prefix_trie(*prefix_trie.whole(turns), height)) == plain(own)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_odd_tables(spark):
    wide = spark.createDataFrame([(1, 0, "u", "a", 9, 9, 9), (1, 0, "u", "a", 9, 9, 9)], SHAPE + ", pos long, h long, k1 long")
    trie = lambda df: rows_of(prefix_trie.prefix_trie(*prefix_trie.whole(prefix_trie.turn_rows(df))))
    assert trie(wide) == plain({1: [("u", "a")] * 2})
    assert trie(wide.where("false")) == []
    assert trie(wide.withColumn("conv_id", prefix_trie.F.lit(None).cast("long"))) == []


def test_twin_and_plain_version(spark, tmp_path):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(plain_rebuilt(rows)[1])
    assert rows_of(prefix_trie.op13_prefix_trie(spark, data)) == want
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{data}/conversations.parquet'")
        assert sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({sql.PREFIX_TRIE})").fetchall(), key=str) == want
        con.sql("DROP VIEW conversations")
        odd = [r for r in talk(5) if (r[0] or 0) < 9000 and r[0] != 107]
        con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", odd)
        assert sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({sql.PREFIX_TRIE})").fetchall(), key=str) == plain(plain_rebuilt(odd)[1])
