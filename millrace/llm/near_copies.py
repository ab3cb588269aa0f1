"""Texts whose sets of word shingles have a Jaccard similarity of 0.8 or more, by an exact prefix filter.

In any one order of all shingles, two such sets share one among the first fifth (and one) of each. Rare shingles come
first: how often each is met is counted over all texts in a table of hashed cells, so that stock phrases come last and
seldom make candidates. Each text is first held against one text of each group that shares a shingle, the one that meets
most others; what that links is one component, and only pairs of different components are then taken from a group. So a
group of copies costs about its texts, not its pairs, and no link between components is lost. Shingles are taken for equal where their 64-bit hashes are.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import components, cut, small, text_of, worker_state

#: The similarity as a fraction.
OVER, UNDER = 4, 5
#: Cells of the counting table: as many as a quarter of the words, within these powers of two; so many are a page.
LEAST_BITS, MOST_BITS, PAGE_BITS = 16, 24, 12
#: Rows of a frame that goes back to the JVM.
ROWS = 100_000
#: Groups of more texts than FEW are dealt to tasks by blocks, together BLOCK texts at most; COLUMNS shingles at a time.
FEW, BLOCK, COLUMNS = 32, 2_000, 4_096


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; of all its words where there are fewer."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.int64)
    joined, size = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    n = max(1, len(parts) - words + 1)
    ends = np.cumsum(size + 1) - 1
    first, past = (ends - size)[:n].tolist(), ends[len(parts) - n :].tolist()
    hash_of = xxhash.xxh64_intdigest
    return np.unique(np.array([hash_of(joined[a:b], 42) for a, b in zip(first, past)], np.uint64).view(np.int64))


def prefix_length(n: int) -> int:
    return n - -(-OVER * n // UNDER) + 1 if n else 0


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _partial_counts(words: int, bits: int):
    def run(frames):
        """Of a task, how many of its texts have a shingle of each cell."""
        worker_state("near copies")
        counts = np.zeros(1 << bits, np.uint16)
        for frame in frames:
            for text in frame["text"]:
                at = _cells(shingles(text, words), bits)
                counts[at] = np.minimum(counts[at], 65_534) + 1
        for page, part in enumerate(counts.reshape(-1, 1 << PAGE_BITS)):
            if part.any():
                yield pd.DataFrame({"page": [page], "body": [zlib.compress(part.tobytes(), 1)]})

    return run


def _page_levels(frames):
    """The tasks' counts of each page added up, as half powers of two."""
    total: dict[int, np.ndarray] = {}
    for frame in frames:
        for page, body in zip(frame["page"], frame["body"]):
            part = np.frombuffer(zlib.decompress(body), np.uint16).astype(np.int64)
            total[page] = total[page] + part if page in total else part
    for page, n in total.items():
        yield pd.DataFrame({"page": [page], "body": [np.round(2 * np.log2(n + 1)).astype(np.uint8).tobytes()]})


def frequencies(rows: DataFrame, words: int = 5) -> np.ndarray:
    """A level for each cell of shingle hashes: the more texts have a shingle of the cell, the higher.

    At most 2**MOST_BITS bytes, whatever the number of texts; it orders shingles and decides nothing else.
    """
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(chars / 24 + 1))))
    out = np.zeros((1 << bits - PAGE_BITS, 1 << PAGE_BITS), np.uint8)
    partial = rows.select("text").mapInPandas(_partial_counts(words, bits), "page int, body binary")
    for r in partial.repartition("page").mapInPandas(_page_levels, "page int, body binary").toLocalIterator():
        out[r["page"]] = np.frombuffer(r["body"], np.uint8)
    return out.ravel()


def _prefixes(words: int, shared):
    def run(frames):
        worker_state("near copies")
        levels, out, size = shared.value, [], 0
        bits = len(levels).bit_length() - 1
        for frame in frames:
            for node, text in zip(frame["node"], frame["text"]):
                own = shingles(text, words)
                first = own[np.argsort(levels[_cells(own, bits)], kind="stable")][: prefix_length(len(own))]
                out.append((np.full(len(first), node), first, np.full(len(first), len(own))))
                size += len(first)
                if size >= ROWS:
                    yield _framed(out)
                    out, size = [], 0
        if size:
            yield _framed(out)

    return run


def _framed(parts) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(("node", "h", "n"))})


def _sets(words: int):
    def run(frames):
        for frame in frames:
            for i in range(0, len(frame), 500):
                part = frame.iloc[i : i + 500]
                yield pd.DataFrame({"node": part["node"], "shingles": [shingles(t, words) for t in part["text"]]})

    return run


def _sizes_fit(n: Column, m: Column) -> Column:
    return (UNDER * n >= OVER * m) & (UNDER * m >= OVER * n)


def _close(counted: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of n and m shingles that can be similar, c of their first ones being shared.

    What isn't shared among these lies past the end of the ones that end first, so the rest of that set bounds it.
    """
    rest = f"greatest(({OVER} * n + {UNDER - 1}) div {UNDER}, ({OVER} * m + {UNDER - 1}) div {UNDER}) - 1"
    return cut(counted.where(f"{OVER + UNDER} * (c + {rest}) >= {OVER} * (n + m)").select("a", "b"))


def _counted(pairs: DataFrame, members: DataFrame) -> DataFrame:
    one = members.select("h", F.col("node").alias("a"), "n")
    two = members.select("h", F.col("node").alias("b"), F.col("n").alias("m"))
    return pairs.join(one, "a").join(two, ["b", "h"]).groupBy("a", "b", "n", "m").agg(F.count("*").alias("c"))


def _similar(rows: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Those pairs (a, b) of nodes whose whole sets are similar."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = cut(rows.join(small(nodes), "node", "left_semi").mapInPandas(_sets(words), "node long, shingles array<long>").dropDuplicates(["node"]))
    one, two = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("a", "b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
    return both.where((OVER + UNDER) * F.col("shared") >= OVER * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of groups with their component and the group's size; groups within one component are left out."""
    named = members.join(labels, "node", "left").select("h", "node", "n", "pop", F.coalesce("root", "node").alias("label"))
    group = Window.partitionBy("h")
    sized = named.withColumns({"_low": F.min("label").over(group), "_high": F.max("label").over(group), "m": F.count("*").over(group)})
    return sized.where("_low < _high").drop("_low", "_high")


def _block_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Of two blocks of a large group, the pairs of different components that can be similar, by what their prefixes share.

    Only texts outside the largest component are held against all; shingles are taken a bounded number at a time.
    """
    frame = frame.drop_duplicates("node")
    node, n, label, own = (frame[c].to_numpy(np.int64) for c in ("node", "n", "label", "own"))
    names, sizes = np.unique(label, return_counts=True)
    few = np.nonzero(label != names[sizes.argmax()])[0]
    if not len(few):
        return pd.DataFrame({"a": node[:0], "b": node[:0]})
    size = frame["hs"].map(len).to_numpy(np.int64)
    _, column = np.unique(np.concatenate(frame["hs"].to_numpy()), return_inverse=True)
    row = np.repeat(np.arange(len(node)), size)
    shared = np.zeros((len(few), len(node)), np.float32)
    for first in range(0, int(column.max()) + 1, COLUMNS):
        here = (column >= first) & (column < first + COLUMNS)
        has = np.zeros((len(node), COLUMNS), np.float32)
        has[row[here], column[here] - first] = 1
        shared += has[few] @ has.T
    x, y = n[few][:, None], n[None, :]
    rest = np.maximum(-(-OVER * x // UNDER), -(-OVER * y // UNDER)) - 1
    good = (shared > 0) & (label[few][:, None] != label[None, :]) & (UNDER * x >= OVER * y) & (UNDER * y >= OVER * x)
    good &= (OVER + UNDER) * (shared.astype(np.int64) + rest) >= OVER * (x + y)
    i, j = np.nonzero(good)
    i = few[i]
    return pd.DataFrame({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])}).drop_duplicates()


def _left_pairs(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a group and can be similar.

    Groups of up to FEW are joined with themselves; larger ones go to tasks by pairs of blocks, with their prefixes.
    """
    x, y = left.where(F.col("m") <= FEW).alias("x"), left.where(F.col("m") <= FEW).alias("y")
    pairs = x.join(y, "h").where((F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & _sizes_fit(F.col("x.n"), F.col("y.n")))
    light = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    prefixes = left.groupBy("node").agg(F.collect_list("h").alias("hs"))  # of one text: no longer than its prefix
    blocks = F.ceil(2 * F.col("m") / BLOCK).cast("int")
    own, other = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    large = left.where(F.col("m") > FEW).join(prefixes, "node").select("h", "node", "n", "label", "hs", own.alias("own"), other.alias("other"))
    dealt = large.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")}).drop("other")
    heavy = dealt.groupBy("h", "one", "two").applyInPandas(_block_pairs, "a long, b long")
    return light.union(heavy).distinct()


def similar_components(rows: DataFrame, known: DataFrame, words: int = 5) -> DataFrame:
    """From rows (node long, text) and links (a, b) of nodes that are known: the components (node, root) of the known
    links and of all pairs of texts that are 0.8 similar; nodes without links are left out.

    Rows of one node have one text; repeated ones do no harm. Texts without words are similar to none.
    """
    rows = rows.select("node", text_of().alias("text"))
    shared = rows.sparkSession.sparkContext.broadcast(frequencies(rows, words))
    found = rows.mapInPandas(_prefixes(words, shared), "node long, h long, n long")
    group = Window.partitionBy("h")
    met = {"_low": F.min("node").over(group), "_high": F.max("node").over(group), "_m": F.count("*").over(group)}
    members = cut(found.distinct().withColumns(met).where("_low < _high").select("h", "node", "n", "_m"))
    shared.destroy()
    # A text that meets many others is in the middle of its copies.
    popular = members.groupBy("node").agg(F.sum("_m").alias("pop"))
    members = cut(members.join(popular, "node").select("h", "node", "n", "pop"))
    links = cut(known.select("a", "b"))
    labels = cut(components(links))
    left = cut(_labelled(members, labels))
    hub = F.max(F.struct("pop", "node", "n", "label")).over(group)
    tried = left.withColumn("hub", hub).where((F.col("label") != F.col("hub.label")) & _sizes_fit(F.col("n"), F.col("hub.n")))
    pairs = tried.select(F.least("hub.node", "node").alias("a"), F.greatest("hub.node", "node").alias("b")).distinct()
    more = cut(_similar(rows, _close(_counted(pairs, members)), words))
    if not more.isEmpty():
        links = links.union(more)
        labels = cut(components(links))
        left = cut(_labelled(members, labels))
    more = cut(_similar(rows, _close(_counted(_left_pairs(left), members)), words))
    return labels if more.isEmpty() else components(links.union(more))
