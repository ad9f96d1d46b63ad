"""Source divergence against plain dictionaries and exact sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import duckdb
import pyarrow as pa
import pytest

from skyweave.llm import divergence, sql

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(rows):
    """``rows``: (lang, source, text)."""
    count, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        sources[lang].add(source)
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in sources:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        shares = {}
        total = Counter()
        for s in sources[lang]:
            total.update(count[lang, s])
        for s, c in [*((s, count[lang, s]) for s in sources[lang]), (None, total)]:
            n = sum(c[t] for t in kept)
            shares[s] = {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        cost = lambda p, q: (p - q) ** 2 // q
        for s in sources[lang]:
            pairs = [(-sum(cost(shares[s][t], shares[o][t]) for t in kept), o.encode()) for o in sources[lang] if o != s]
            terms = [(-cost(shares[s][t], shares[None][t]), t.encode()) for t in kept if count[lang, s][t] and shares[s][t] > shares[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:200])):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def texts(seed=4, n=150):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéßΣ日") for _ in range(r.randint(1, 3))) for _ in range(300)] + ["THE", "The", "the", "ſ", "K"]
    made = []
    for i in range(n):
        words = [vocabulary[int(r.random() ** 3 * len(vocabulary))] for _ in range(r.choice([0, 3, 40]))]
        made.append((r.choice(["en", "en", "de", None]), r.choice(["a", "b", "b", "c", None, ""]), r.choice([" ", "\n", "1", "_", "\x7f"]).join(words)))
    return made + [("xx", "alone", "one two"), ("xx", "other", None), ("en", "silent", " 123 "), ("en", "big", "the " * 5000)] + made[:9]


@pytest.mark.parametrize("leaves,memo,block", [(1024, 2_000_000, 1 << 23), (8, 50, 40)])
def test_divergence(spark, monkeypatch, leaves, memo, block):
    for name, v in (("LEAVES", leaves), ("MEMO", memo), ("BLOCK", block)):
        monkeypatch.setattr(divergence, name, v)
    rows = texts()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    if leaves == 1024:
        assert rows_of(divergence.source_divergence(df)) == plain(rows)
    else:  # workers read the module anew: run the steps here
        batch = pa.RecordBatch.from_pylist([{"lang": a or "", "source": b or "", "text": c or ""} for a, b, c in rows])
        assert sum(b.num_rows for b in divergence.blocks(batch)) == len(rows)
        got = Counter()
        for part in divergence.blocks(batch):
            for r in divergence.block_counts(part).to_pylist():
                got[r["lang"], r["source"], r["term"]] += r["n"]
        want = Counter()
        for a, b, c in rows:
            for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(x.lower() if x.isascii() else x for x in c or "")):
                want[a or "", b or "", t] += 1
        assert got == want


def test_trees_price_pairs_once():
    r = np.random.default_rng(5)
    counts = r.poisson(0.3, (4, 64)) * r.integers(1, 9, (4, 64))
    counts[:, 50:] = -1
    forest, weights = divergence.Forest(), [100, 90, 10**12, 7]
    roots = forest.roots(counts)
    p = [[1 + divergence.SCALE * (int(c) + 1) // w for c in row[:50]] for row, w in zip(counts, weights)]
    for a in range(4):
        for b in range(a + 1, 4):
            got = forest.price((a, b), (weights[a], weights[b]), roots[a], roots[b])
            assert got == (sum((x - y) ** 2 // y for x, y in zip(p[a], p[b])), sum((x - y) ** 2 // x for x, y in zip(p[a], p[b])))
    visited = forest.size
    assert visited < 6 * 127 and len(forest.kids) < 4 * 127
    forest.price((0, 1), (weights[0], weights[1]), roots[0], roots[1])
    assert forest.size == visited
    assert forest.roots(np.zeros((2, 64), int)) == forest.roots(np.zeros((1, 64), int)) * 2


def test_odd_tables(spark, odd, none):
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert rows_of(divergence.source_divergence(odd)) == plain(rows)
    assert divergence.source_divergence(none).count() == 0


def test_twin_and_plain_version(spark):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("lang", "source", "text").collect()]
    want = plain(rows)
    assert rows_of(divergence.op11_source_divergence(spark, data)) == want
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
        assert sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({sql.SOURCE_DIVERGENCE})").fetchall()) == want


def test_counts_travel_in_parts():
    """A block is one row for each language and part, and parts from any blocks make the terms of three documents or more."""
    rows = [(a or "", b or "", c or "") for a, b, c in texts(6, 400)]
    made = []
    for at in range(0, len(rows), 60):
        batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r)) for r in rows[at : at + 60]])
        made.append(divergence.packed(divergence.block_counts(batch), 7))
        assert made[-1].num_rows <= 7 * len({r[0] for r in rows})
    table = pa.Table.from_batches(made).sort_by([("lang", "ascending"), ("part", "ascending")])
    got = {}
    for batch in divergence.put_together(iter(table.to_batches(max_chunksize=5))):
        for r in batch.to_pylist():
            assert (r["lang"], r["term"]) not in got and r["n_lang"] == sum(x["n"] for x in r["of"])
            got[r["lang"], r["term"]] = {x["source"]: x["n"] for x in r["of"]}
    docs, want = Counter(), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(x.lower() if x.isascii() else x for x in text))
        docs.update((lang, t) for t in set(terms))
        for t in terms:
            want[lang, t][source] += 1
    assert got == {k: dict(v) for k, v in want.items() if docs[k] >= 3} and len(got) > 100
