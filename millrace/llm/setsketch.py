"""Near copies by SetSketch: exponentially spaced, truncated minima of a set's hashes as registers of a byte.

Each register is floor(1 - log_b x), x being the least of the exponential variables that the set's elements have there. So
two sketches merge by their greater registers, and registers of similar sets are mostly equal. Bands of registers make
candidates; of a pair, how many registers are less, equal and greater, with the sizes of both sets, gives the likelihood
of each similarity, and pairs for which the wanted ones are hopeless are left out. What stays is confirmed on the
whole sets.

Equal sets are one class, with one sketch. Buckets make no pairs of all their members: first each is held against one,
and what that links is one component. What is left of a bucket, members of different components, goes to a task with its
sketches and sets, where each pair is looked at in the first band it shares; only a spanning forest of the links comes back.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, row_key, small, text_of, worker_state
from .near_copies import shingles

BASE, RATE, TOP = 1.2, 20.0, 255
#: 32 bands of 6 registers: at a similarity of 0.85 a register is equal with 0.86, and all bands differ in 5 of 10**8 pairs.
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: A pair is left out if the wanted similarities are less likely than others by this factor's logarithm.
HOPELESS = 18.0
#: Groups whose sets together have more shingles than LIGHT are dealt to tasks by blocks, together some BLOCK shingles.
LIGHT, BLOCK = 65_536, 2_000_000
#: Times that each member of a bucket is held against one of another component, before all pairs of components are.
HUBS = 3

_rng = np.random.default_rng(2021)
_TIMES = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, REGISTERS, np.uint64)


def least_hashes(hashes: np.ndarray, part: int = 256) -> np.ndarray:
    """Of each register the least hash of the elements, a bounded number of elements at a time."""
    h = hashes.view(np.uint64)
    out = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), part):
        np.minimum(out, (h[i : i + part, None] * _TIMES + _PLUS).min(axis=0), out=out)
    return out


def registers(least: np.ndarray) -> np.ndarray:
    """Registers of least hashes, of one set or a row each."""
    with np.errstate(divide="ignore"):
        x = -np.log1p(-least.astype(np.float64) / 2.0**64 * (1 - 1e-16)) / RATE
        level = np.floor(1 - np.log(x) / math.log(BASE))
    return np.clip(level, 0, TOP).astype(np.uint8)


def sketch(hashes: np.ndarray) -> np.ndarray:
    return registers(least_hashes(hashes))


def merge(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(one, two)


def _log_share(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set is the greater one, x being what of the union only that set has, halved by sizes."""
    return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)


def likelihood(greater: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Log-likelihoods (pairs x similarities) of sets of n and m elements, by the registers in which the first is greater, less."""
    u = (n / (n + m))[:, None]
    v = 1 - u
    j = np.minimum(similarity[None, :], np.minimum(u / v, v / u))
    p, q = (np.maximum(_log_share(np.maximum(x, 0)), 1e-12) for x in (u - v * j, v - u * j))
    g, s = greater[:, None], less[:, None]
    return g * np.log(p) + s * np.log(q) + (REGISTERS - g - s) * np.log(np.maximum(1 - p - q, 1e-12))


def hopeful(greater, less, n, m, over: int, under: int) -> np.ndarray:
    """Whether a similarity of over / under or more is not hopeless for the pairs."""
    least = over / under
    wanted = likelihood(greater, less, n, m, np.linspace(least, 1, 7)).max(axis=1)
    other = likelihood(greater, less, n, m, np.linspace(0, least, 18)).max(axis=1)
    return wanted >= other - HOPELESS


def estimate(one: np.ndarray, two: np.ndarray, n: int, m: int) -> float:
    """The most likely similarity of two sets by their sketches and sizes, to a thousandth."""
    at = np.linspace(0, min(n, m) / max(n, m), 1001)
    count = lambda x: np.array([x.sum()])
    return float(at[likelihood(count(one > two), count(one < two), np.array([n]), np.array([m]), at)[0].argmax()])


def _sketched(words: int):
    def run(frames):
        import xxhash

        worker_state("setsketch")
        for whole in frames:
            for i in range(0, len(whole), 1_000):
                frame = whole.iloc[i : i + 1_000]
                sets = [shingles(t, words) for t in frame["text"]]
                names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                halves = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                made = registers(np.stack([least_hashes(s) for s in sets]))
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].astype("Int64"), "_k": frame["_k"], "_sig": frame["_sig"], "n": [len(s) for s in sets],
                        "d1": halves[:, 0], "d2": halves[:, 1], "sketch": [r.tobytes() for r in made],
                    }
                )

    return run


def _sets(words: int):
    def run(frames):
        for frame in frames:
            for i in range(0, len(frame), 500):
                part = frame.iloc[i : i + 500]
                yield pd.DataFrame({"node": part["node"], "shingles": [shingles(t, words) for t in part["text"]]})

    return run


def _registers_of(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, REGISTERS)


def _hopeful_pairs(over: int, under: int):
    def run(frames):
        for frame in frames:
            if len(frame):
                one, two = _registers_of(frame["of_a"]), _registers_of(frame["of_b"])
                sizes = (frame[c].to_numpy(np.float64) for c in ("n", "m"))
                yield frame[["a", "b"]][hopeful((one > two).sum(axis=1), (one < two).sum(axis=1), *sizes, over, under)]

    return run


def _sizes_fit(n, m, over: int, under: int):
    return (under * n >= over * m) & (under * m >= over * n)


def _forest(band: int, node: np.ndarray, label: np.ndarray, made: np.ndarray, size: np.ndarray, flat: np.ndarray, over: int, under: int) -> np.ndarray:
    """Links (a, b) that join the components ``label`` as all links of the classes given do.

    A pair is looked at only if ``band`` is the first that it shares, or with -1 if it shares any. Classes outside the largest component are taken
    one at a time: bounds by sizes and sketches first, then what their sets share with all that is left, at once.
    """
    node, at = np.unique(node, return_index=True)
    label, made, ends = label[at].copy(), made[at], np.cumsum(size)
    parts = [flat[ends[i] - size[i] : ends[i]] for i in at]
    n = size[at]
    _, ids = np.unique(np.concatenate(parts), return_inverse=True)
    first = np.cumsum(n) - n
    bands = made.reshape(len(node), BANDS, ROWS)
    names, counts = np.unique(label, return_counts=True)
    has, out = np.zeros(len(ids), bool), []
    for i in np.nonzero(label != names[counts.argmax()])[0]:
        some = np.nonzero((label != label[i]) & _sizes_fit(n, n[i], over, under))[0]
        if len(some):
            same = (bands[some] == bands[i]).all(axis=2)
            some = some[same.any(axis=1) if band < 0 else same[:, band] & ~same[:, :band].any(axis=1)]
        if len(some):
            sizes = np.full(len(some), n[i], float), n[some].astype(float)
            some = some[hopeful((made[i] > made[some]).sum(axis=1), (made[i] < made[some]).sum(axis=1), *sizes, over, under)]
        if not len(some):
            continue
        own = ids[first[i] : first[i] + n[i]]
        has[own] = True
        shared = np.array([np.count_nonzero(has[ids[first[j] : first[j] + n[j]]]) for j in some])
        has[own] = False
        near = some[(over + under) * shared >= over * (n[i] + n[some])]
        for joined in np.unique(label[near]):
            out.append((node[i], node[near[label[near] == joined][0]]))
        label[np.isin(label, label[near])] = label[i]
    return np.array(out, np.int64).reshape(-1, 2)


def _light_links(over: int, under: int):
    def run(frames):
        for frame in frames:
            for band, node, label, made, size, flat in frame.itertuples(index=False):
                found = _forest(band, node, label, _registers_of(made), size, flat, over, under)
                if len(found):
                    yield pd.DataFrame(np.sort(found, axis=1), columns=["a", "b"])

    return run


def _block_links(over: int, under: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        size = frame["shingles"].map(len).to_numpy(np.int64)
        node, label = (frame[c].to_numpy(np.int64) for c in ("node", "label"))
        found = _forest(int(frame["band"].iloc[0]), node, label, _registers_of(frame["sketch"]), size, np.concatenate(frame["shingles"].to_list()), over, under)
        return pd.DataFrame(np.sort(found, axis=1), columns=["a", "b"])

    return run


class _Search:
    """Links between classes (node, n, sketch, _k, _sig) whose sets have a similarity of over / under or more."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, over: int, under: int):
        self.docs, self.classes, self.words, self.over, self.under = docs, classes, words, over, under

    def members(self) -> DataFrame:
        """(h, band, node, n) of the buckets that several classes are in."""
        bands = F.array(*(F.xxhash64(F.lit(i), F.substring("sketch", i * ROWS + 1, ROWS)) for i in range(BANDS)))
        dealt = self.classes.select(F.posexplode(bands).alias("band", "h"), "node", "n")
        met = dealt.groupBy("h").agg(F.count("*").alias("_m")).where("_m > 1")
        return cut(dealt.join(met, "h").select("h", "band", "node", "n"))

    def fit(self, n: Column, m: Column) -> Column:
        return _sizes_fit(n, m, self.over, self.under)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b, n, m) that are hopeful by their sketches, then similar by their whole sets."""
        one, two = (self.classes.select(F.col("node").alias(c), F.col("sketch").alias(f"of_{c}")) for c in ("a", "b"))
        return self.similar(cut(pairs.join(one, "a").join(two, "b").mapInPandas(_hopeful_pairs(self.over, self.under), "a long, b long")))

    def sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes."""
        wanted = self.classes.join(nodes, "node", "left_semi").select("_k", "_sig", "node")
        texts = self.docs.select(*row_key(), text_of().alias("text")).join(small(wanted), ["_k", "_sig"]).select("node", "text")
        return cut(texts.mapInPandas(_sets(self.words), "node long, shingles array<long>").dropDuplicates(["node"]))

    def similar(self, pairs: DataFrame) -> DataFrame:
        sets = self.sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        one, two = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("a", "b"))
        both = pairs.join(one, "a").join(two, "b").withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
        return cut(both.where((self.over + self.under) * F.col("shared") >= self.over * (F.size("of_a") + F.size("of_b"))).select("a", "b"))

    def left(self, members: DataFrame, links: DataFrame | None) -> DataFrame:
        """Members of buckets with their component, those of buckets within one component left out."""
        if links is None:
            named = members.withColumn("label", F.col("node"))
        else:
            named = members.join(components(links), "node", "left").select("h", "band", "node", "n", F.coalesce("root", "node").alias("label"))
        named = cut(named)
        mixed = named.groupBy("h").agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.count("*").alias("m"), F.sum("n").alias("w")).where("_low < _high")
        return cut(named.join(mixed.select("h", "m", "w"), "h"))

    def hub_pairs(self, left: DataFrame, turn: int) -> DataFrame:
        """Each member with one of its bucket: at first the one that is in most company, then others."""
        company = left.groupBy("node").agg(F.sum("m").alias("_pop"))
        order = F.col("_pop") if turn == 0 else F.xxhash64("node", F.lit(turn))
        ranked = left.join(company, "node").withColumn("_o", order)
        hubs = ranked.groupBy("h").agg(F.max(F.struct("_o", "node", "n", "label")).alias("hub"))
        tried = left.join(hubs, "h").where((F.col("label") != F.col("hub.label")) & self.fit(F.col("n"), F.col("hub.n")))
        return tried.select(F.least("hub.node", "node").alias("a"), F.greatest("hub.node", "node").alias("b"), *self.sizes("hub.node", "node", F.col("hub.n"), F.col("n"))).distinct()

    @staticmethod
    def sizes(x: str, y: str, n: Column, m: Column) -> list[Column]:
        first = F.col(x) < F.col(y)
        return [F.when(first, n).otherwise(m).alias("n"), F.when(first, m).otherwise(n).alias("m")]

    def groups(self, left: DataFrame) -> DataFrame:
        """(g, band, w, node, label): what has to be compared, with the shingles in each group.

        Buckets that overlap are one group, in which any shared band counts (band -1), if half a block holds it; so its
        members are sent once and not with each bucket. Of more, each bucket is a group.
        """
        hubs = left.groupBy("h").agg(F.min("node").alias("b"))
        joined = components(left.join(hubs, "h").select(F.col("node").alias("a"), "b")).select("node", F.col("root").alias("g"))
        nodes = cut(left.select("node", "n", "label").distinct().join(joined, "node"))
        sizes = cut(nodes.groupBy("g").agg(F.sum("n").alias("w")))
        few = nodes.join(sizes.where(F.col("w") <= BLOCK // 2), "g").select("g", F.lit(-1).alias("band"), "w", "node", "label")
        many = nodes.join(sizes.where(F.col("w") > BLOCK // 2).select("g"), "g").select("node")
        return few.union(left.join(many, "node").select(F.col("h").alias("g"), "band", "w", "node", "label"))

    def crossing(self, left: DataFrame) -> DataFrame:
        """Links between different components of what is left: a spanning forest of each group, or of each two of its blocks."""
        sets = self.sets(left.select("node").distinct()).join(self.classes.select("node", "sketch"), "node")
        whole = self.groups(left).join(sets, "node")
        rows = F.collect_list(F.struct("node", "label", "sketch", F.size("shingles").cast("long").alias("size"), "shingles"))
        part = lambda c: F.transform("rows", lambda r: r[c]).alias(c)
        gathered = whole.where(F.col("w") <= LIGHT).groupBy("g", "band").agg(rows.alias("rows"))
        light = gathered.select("band", part("node"), part("label"), part("sketch"), part("size"), F.flatten(F.transform("rows", lambda r: r["shingles"])).alias("flat"))
        blocks = F.ceil(2 * F.col("w") / BLOCK).cast("int")
        own, other = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
        large = whole.where(F.col("w") > LIGHT).select("g", "band", "node", "label", "sketch", "shingles", own.alias("own"), other.alias("other"))
        dealt = large.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")}).drop("own", "other")
        heavy = dealt.groupBy("g", "band", "one", "two").applyInPandas(_block_links(self.over, self.under), "a long, b long")
        return cut(light.mapInPandas(_light_links(self.over, self.under), "a long, b long").union(heavy).distinct())

    def links(self) -> DataFrame | None:
        """Links that join the same classes as all links do; None if there are none."""
        members, links = self.members(), None
        left = self.left(members, None)
        for turn in range(HUBS + 1):
            if left.isEmpty():
                break
            more = self.confirmed(self.hub_pairs(left, turn)) if turn < HUBS else self.crossing(left)
            if not more.isEmpty():
                links = more if links is None else links.union(more)
                left = self.left(members, links) if turn < HUBS else left
        return links


def similar_documents(docs: DataFrame, words: int = 5, over: int = 4, under: int = 5) -> DataFrame:
    """Documents with the smallest id that they are linked to, step by step; a link is a similarity of over / under or more.

    A document's set are its distinct shingles of ``words`` words, lower-cased in A-Z; all its words as one where there
    are fewer. Null and empty texts and those of white space have an empty set and are linked with nothing. Repeated rows
    stay, each with its result. Null ids count as larger than all; a document linked to null ids only has a null
    component_id. Other columns are not read; no rows in, none out. Shingles are taken for equal where their 64-bit hashes
    are, sets where 128-bit hashes are.

    Columns: doc_id, n_shingles, component_id, kept (whether doc_id is component_id).
    """
    rows = docs.select("doc_id", *row_key(), text_of().alias("text"))
    made = cut(rows.mapInPandas(_sketched(words), "doc_id long, _k long, _sig long, n long, d1 long, d2 long, sketch binary"))
    grouped = made.where("n > 0").groupBy("d1", "d2").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("least"), F.min(F.struct("_k", "_sig")).alias("row"))
    classes = cut(grouped.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "n", "sketch", "least", F.col("row._k").alias("_k"), F.col("row._sig").alias("_sig")))
    links = _Search(docs, classes, words, over, under).links()
    named = classes.select("node", "d1", "d2", "least").withColumn("root", F.col("node"))
    if links is not None:
        roots = components(links).select("node", F.col("root").alias("_root"))
        named = named.join(roots, "node", "left").withColumn("root", F.coalesce("_root", "node")).drop("_root")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "root").select("d1", "d2", "component_id", F.lit(True).alias("_found"))
    component = F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("doc_id"))
    # Empty sets are one class by their hash, but in no class here.
    return (
        made.select("doc_id", "n", "d1", "d2")
        .join(found, ["d1", "d2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    )
