import hashlib
import random
import re
import zlib

import pytest
from millrace.llm import prefix_trie as trie
from millrace.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuild=True):
    convs = {}
    for r in rows:
        if r["conv_id"] is not None:
            convs.setdefault(r["conv_id"], []).append(r)
    own = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, trie_said(r)))
        own[c] = [(r["role"] or "", r["text"] or "") for r in turns]
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)

    def total(path):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves, saved = int(path not in kids), (len(nodes[path]) - 1) * words
        for k in kids.get(path, []):
            a, b = total(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(kids.get(path, [])), *total(path), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_said(r):
    who, what = r["role"] or "", r["text"] or ""
    return hashlib.sha256(f"{len(who)}:{who}{what}".encode()).digest()[:16]


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(n, rng, depth):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, depth)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d e f", "", None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert got(QUERIES["op11_prefix_trie"](spark, sf_dir)) == brute(rows)


@pytest.mark.parametrize("chunk", [1024, 2])
def test_shared_beginnings(spark, monkeypatch, chunk):
    """Also with keys carried from chunk to chunk."""
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rows = made(150, random.Random(1), 9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for rebuild in (None, (20, 4)):
        assert got(trie.prefix_trie(df, rebuild)) == brute([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows], rebuild)


def test_long_and_hot_conversations(spark):
    """One conversation holds a third of the turns, many are equal."""
    rows = [(7, t, "user", f"x {t % 5}") for t in range(700)]
    rows += [(c, t, "user", "same words") for c in range(100, 400) for t in range(2)]
    rows += made(100, random.Random(2), 4)
    rows = [(c + 1000 * (i >= 1300), t, r, x) for i, (c, t, r, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(trie.prefix_trie(df)) == brute([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows], False)


def test_odd_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, 1, "user", "second"), (0, 1, "user", "second"), (0, 2, None, None),
        (3, 5, "user", ""), (3, 5, None, "x"), (21, 0, "user", "w " * 200_000), (None, 0, "user", "lost"), (45, 0, "a", "b"), (-7, 0, "a", "b"),
        (60, 0, "a", "q"), (61, 0, "a", "q"), (63, 9, "", "a\x0bb c"),
    ]
    wide = [(*r, 1, 2, "y", "z") for r in rows]
    df = spark.createDataFrame(wide, SCHEMA + ", depth int, n1 long, said string, size string")
    want = [dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows]
    # Ids below zero: the remainder has the sign of the id.
    plain = [r for r in want if (r["conv_id"] or 0) >= 0]
    assert got(trie.prefix_trie(df.where("conv_id is null or conv_id >= 0"), (20, 4))) == brute(plain)
    assert got(trie.prefix_trie(df)) == brute(want, False)


def test_turnless(spark):
    """A conversation whose own turns are all replaced by those of one that isn't there belongs to the root alone."""
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    (r,) = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), (20, 4)).collect()
    assert tuple(r)[:7] == (c, 0, None, 1, 0, 1, 0) and r.ends_sha256 == hashlib.sha256(str(c).encode()).hexdigest()


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(none).isEmpty() and trie.prefix_trie(none, (20, 4)).isEmpty()
