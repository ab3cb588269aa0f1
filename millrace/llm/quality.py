"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is of characters, five in a row. Its counts are a table of n-grams sharded by n-gram; lower orders count in
how many contexts an n-gram goes on. Discounts D1, D2, D3+ of each order come from its counts of counts. Documents meet
the model by joins: all distinct n-grams are joined with the sharded tables, order by order; documents are taken in
chunks of some millions of characters, each chunk's distinct n-grams go packed to the shards of the outcome, and their
log-probabilities, in the same order, go back to the chunk, which sums them by document.
A document is kept if its perplexity isn't over a quantile of the trusted documents' in its language.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, row_key, small, store, text_of

ORDER = 5
#: The largest symbol is a code point and one. An n-gram's key is two numbers: the low BITS bits of its symbols in a row
#: (code) and the other HIGH bits of each (high), which are all 0 in most scripts with an alphabet.
SYMBOLS = 0x110000 + 1
BITS, HIGH = 12, 9
CHUNK = 8_000_000
SLICE = 500_000
#: Characters of all texts for each shard of the probabilities.
SHARD = 16_000_000
KEY = ["code", "high"]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, code point + 1, with ORDER - 1 zeros before each text, and where each text starts."""
    pad = "\0" * (ORDER - 1)
    sym = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(size + ORDER - 1) - size
    for k in range(1, ORDER):
        sym[start - k] = 0
    return sym, start


def keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, high) of the n-grams that end at each character of the texts, and how many each text has."""
    sym, start = symbols(texts)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())

    def fold(part: np.ndarray, bits: int) -> np.ndarray:
        out = np.zeros(len(part), np.int64)
        for k in range(ORDER - 1, -1, -1):
            out[ORDER - 1 :] = out[ORDER - 1 :] << bits | part[ORDER - 1 - k : len(part) - k]
        return out[at]

    over = sym >> BITS
    return fold(sym & (1 << BITS) - 1, BITS), fold(over, HIGH) if over.any() else np.zeros(len(at), np.int64), size


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``keys``, in one array: the codes, or records of both numbers where some symbol has high bits."""
    code, high, size = keys(texts)
    return (np.rec.fromarrays([high, code]) if high.any() else code), size


def _unique(code: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, and the place of each key among them."""
    if not high.any():
        code, place = np.unique(code, return_inverse=True)
        return code, np.zeros(len(code), np.int64), place
    order = np.lexsort((code, high))
    code, high = code[order], high[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (high[1:] != high[:-1])
    place = np.empty(len(code), np.int64)
    place[order] = np.cumsum(new) - 1
    return code[new], high[new], place


def _chunks(frames):
    """(chunk id, rows) of a partition: consecutive rows of up to CHUNK characters, or one row."""
    part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
    for frame in frames:
        at = 0
        for i, n in enumerate(frame["text"].map(len)):
            if size and size + n > CHUNK:
                held.append(frame.iloc[at:i])
                yield part << 32 | seq, pd.concat(held)
                seq, held, size, at = seq + 1, [], 0, i
            size += n
        held.append(frame.iloc[at:])
    if held and sum(map(len, held)):
        yield part << 32 | seq, pd.concat(held)


def _slices(texts: list[str]):
    """(first, past) of stretches of up to SLICE characters, or one text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > SLICE:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


def _tally(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """Distinct keys of some texts and their counts; and by slice (sizes, place of each n-gram among the distinct)."""
    parts = []
    for a, b in _slices(texts):
        code, high, size = keys(texts[a:b])
        parts.append((*_unique(code, high), size))
    code, high, place = _unique(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    n, places, at = np.zeros(len(code), np.int64), [], 0
    for own, _, where, size in parts:
        to = place[at : at + len(own)]
        n[to] += np.bincount(where, minlength=len(own))
        places.append((size, to[where].astype(np.int32)))
        at += len(own)
    return code, high, n, places


def _counts(frames):
    for _, rows in _chunks(frames):
        code, high, n, _ = _tally(rows["text"].tolist())
        yield pd.DataFrame({"code": code, "high": high, "n": n})


def _codes(frames):
    for _, rows in _chunks(frames):
        code, high, _, _ = _tally(rows["text"].tolist())
        yield pd.DataFrame({"code": code, "high": high})


def _shard(shards: int):
    """A key's shard, by its symbols but the last two."""
    return F.expr(f"cast((shiftright(code, {2 * BITS}) + shiftright(high, {2 * HIGH})) % 1000003 % {shards} as int)")


def _by_shard(code: np.ndarray, high: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of the keys by shard, and (shard, first, past) of each shard in it."""
    shard = ((code >> 2 * BITS) + (high >> 2 * HIGH)) % 1_000_003 % shards
    order = np.argsort(shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]


def _packed_keys(code: np.ndarray, high: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of their places, compressed."""
    both = [code, high] if high.any() else [code]
    return zlib.compress(b"".join(np.diff(x, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in both), 1)


def _unpacked_keys(body: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(-1, 8, n)
    both = [np.cumsum(np.ascontiguousarray(x.T).view("<i8").ravel()) for x in raw]
    return both[0], both[1] if len(both) > 1 else np.zeros(n, np.int64)


def _check(code: np.ndarray, high: np.ndarray) -> int:
    return zlib.crc32(high.tobytes(), zlib.crc32(code.tobytes()))


NEEDED = "chunk long, shard int, n int, crc long, body binary"
FOUND = "chunk long, shard int, crc long, log_p binary"


def _needed(shards: int):
    def run(frames):
        """Of each chunk and shard the distinct keys."""
        for chunk, rows in _chunks(frames):
            code, high, _, _ = _tally(rows["text"].tolist())
            order, spans = _by_shard(code, high, shards)
            code, high = code[order], high[order]
            out = [(chunk, k, b - a, _check(code[a:b], high[a:b]), _packed_keys(code[a:b], high[a:b])) for k, a, b in spans]
            yield pd.DataFrame(out, columns=["chunk", "shard", "n", "crc", "body"])

    return run


def _look_up(needed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Log-probabilities of a shard's keys for each chunk that needs some, in the order of its keys."""
    known = known.sort_values(["high", "code"])
    table, above, log_p = (known[c].to_numpy(t) for c, t in (("code", np.int64), ("high", np.int64), ("log_p", np.float32)))
    out = []
    for row in needed.itertuples():
        code, high = _unpacked_keys(row.body, row.n)
        if above.any():
            _, _, place = _unique(np.concatenate((table, code)), np.concatenate((above, high)))
            values = np.full(place.max() + 1, np.nan, np.float32)
            values[place[: len(table)]] = log_p
            found = values[place[len(table) :]]
        else:
            place = np.minimum(np.searchsorted(table, code), max(0, len(table) - 1))
            found = np.where((table[place] == code) & (high == 0), log_p[place], np.float32("nan")) if len(table) else np.full(row.n, np.nan, np.float32)
        if np.isnan(found).any():
            raise RuntimeError(OTHERWISE)
        out.append((row.chunk, row.shard, row.crc, found.astype("<f4").tobytes()))
    return pd.DataFrame(out, columns=["chunk", "shard", "crc", "log_p"])


OTHERWISE = "the documents were dealt otherwise on a second reading: pass a stored table"
PACKED = "chunk long, ids array<long>, k array<long>, sig array<long>, langs array<string>, sizes array<int>, body binary"


def _packed(frames):
    """A chunk's rows in one, its texts compressed."""
    for chunk, rows in _chunks(frames):
        raw = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
        ids = [None if pd.isna(i) else int(i) for i in rows["doc_id"]]
        langs = [None if pd.isna(x) else x for x in rows["lang"]]
        yield pd.DataFrame(
            {"chunk": [chunk], "ids": [ids], "k": [rows["_k"].tolist()], "sig": [rows["_sig"].tolist()], "langs": [langs], "sizes": [list(map(len, raw))], "body": [zlib.compress(b"".join(raw), 3)]}
        )


def _summed(shards: int):
    def run(packed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """Log-probability of each row of a chunk, from its n-grams' log-probabilities."""
        out = {c: [] for c in ("doc_id", "_k", "_sig", "lang", "n_chars", "log_p")}
        by = {r.shard: (r.crc, r.log_p) for r in known.itertuples()}
        for row in packed.itertuples():
            raw, texts, at = zlib.decompress(row.body), [], 0
            for n in row.sizes:
                texts.append(raw[at : at + n].decode("utf-8", "surrogatepass"))
                at += n
            code, high, _, places = _tally(texts)
            order, spans = _by_shard(code, high, shards)
            code, high = code[order], high[order]
            if set(by) != {k for k, _, _ in spans} or any(by[k][0] != _check(code[a:b], high[a:b]) for k, a, b in spans):
                raise RuntimeError(OTHERWISE)
            log_p = np.empty(len(code))
            log_p[order] = np.frombuffer(b"".join(by[k][1] for k, _, _ in spans), "<f4")
            sums = [np.bincount(np.repeat(np.arange(len(size)), size), log_p[place], len(size)) for size, place in places]
            for c, values in zip(out, (row.ids, row.k, row.sig, row.langs, map(len, texts), np.concatenate(sums).tolist())):
                out[c] += list(values)
        return pd.DataFrame(out)

    return run


def _suffix(n: int) -> dict:
    """Of a key, its last n symbols."""
    return {c: F.col(c).bitwiseAND(F.lit((1 << bits * n) - 1)) for c, bits in (("code", BITS), ("high", HIGH))}


def _context() -> dict:
    return {"context": F.shiftright("code", BITS), "above": F.shiftright("high", HIGH)}


def _lower(p: DataFrame) -> DataFrame:
    return p.select(F.col("code").alias("suffix"), F.col("high").alias("over"), F.col("p").alias("lower"))


def _with_suffix(df: DataFrame, n: int) -> DataFrame:
    return df.withColumns(dict(zip(("suffix", "over"), _suffix(n).values())))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2 and D3+ of one order; customary values where the counts of counts have gaps."""
    n1, n2, n3, n4 = (x or 0 for x in counts.agg(*[F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)]).first())
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(k, max(0.05, d)) for k, d in zip((1.0, 2.0, 3.0), found))


def model(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """From counts (code, high, n) of ORDER symbols: for each order from 1, (code, high, p) and, for its contexts,
    (context, above, gamma)."""
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = cut(tables[n + 1].select(*[v.alias(c) for c, v in _suffix(n).items()]).groupBy(*KEY).agg(F.count("*").alias("n")))
    out: list[tuple[DataFrame, DataFrame]] = []
    for n in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(tables[n])
        t = tables[n].withColumns(_context())
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = t.groupBy("context", "above").agg(F.sum("n").alias("total"), F.sum(off).alias("off"))
        gammas = cut(contexts.select("context", "above", "total", (F.col("off") / F.col("total")).alias("gamma")))
        own = _with_suffix(t.join(gammas, ["context", "above"]), n - 1).withColumn("own", (F.col("n") - off) / F.col("total"))
        if out:
            p = own.join(_lower(out[-1][0]), ["suffix", "over"]).select(*KEY, (F.col("own") + F.col("gamma") * F.col("lower")).alias("p"))
        else:
            p = own.select(*KEY, (F.col("own") + F.col("gamma") / SYMBOLS).alias("p"))
        out.append((cut(p), gammas.select("context", "above", "gamma")))
    return out


def probabilities(codes: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(code, high, p) for distinct keys of ORDER symbols, seen or not, by joins with each order's shards."""
    wanted = {ORDER: codes}
    for n in range(ORDER - 1, 0, -1):
        wanted[n] = wanted[n + 1].select(*[v.alias(c) for c, v in _suffix(n).items()]).distinct()
    lower = None
    for n in range(1, ORDER + 1):
        p, gammas = tables[n - 1]
        found = wanted[n].withColumns(_context()).join(p, KEY, "left").join(gammas, ["context", "above"], "left")
        if lower is None:
            rest = F.lit(1.0 / SYMBOLS)
        else:
            found = _with_suffix(found, n - 1).join(_lower(lower), ["suffix", "over"])
            rest = F.col("lower")
        lower = found.select(*KEY, F.coalesce("p", F.coalesce("gamma", F.lit(1.0)) * rest).alias("p"))
    return lower


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that some label calls good and none bad."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    return one.select("doc_id")


def _train():
    """Four fifths of the trusted ids make the model; the rest, which it hasn't seen, the thresholds."""
    return F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) != 0


def quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = 0.98
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_chars, perplexity (a character), threshold, keep.

    threshold: the (approximate) ``quantile`` of the perplexities, in the language, of the fifth of the trusted documents that the
    model is not made of; of all of that fifth where the language (null is one) has none in it. Null and empty texts have no perplexity and aren't kept. Without trusted text
    nothing is known: no perplexity, no threshold, and all documents with text are kept. Repeated rows and null ids
    stay. Other columns are not read. No rows in, no rows out. ``docs`` that aren't read from files are stored first,
    since they are read twice and must be dealt the same both times.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), *row_key(id_col, text_col))
    stored = None
    if not docs.inputFiles() or "Exchange" in base._jdf.queryExecution().executedPlan().toString():
        base, stored = store(base)
    trusted = small(cut(trusted_ids(labels)))
    known_texts = base.join(trusted, "doc_id")
    counts = cut(known_texts.where(_train()).select("text").mapInPandas(_counts, "code long, high long, n long").groupBy(*KEY).agg(F.sum("n").alias("n")))
    if counts.isEmpty():
        none = F.lit(None).cast("double")
        n = F.length("text").cast("long")
        return base.select("doc_id", "lang", n.alias("n_chars"), none.alias("perplexity"), none.alias("threshold"), (n > 0).alias("keep"))
    codes = cut(base.select("text").mapInPandas(_codes, "code long, high long").distinct())
    p = cut(probabilities(codes, model(counts)))
    shards = max(1, min(4096, (base.agg(F.sum(F.length("text"))).first()[0] or 0) // SHARD))
    known = p.select(_shard(shards).alias("shard"), *KEY, F.log("p").cast("float").alias("log_p"))
    needed = base.select("text").mapInPandas(_needed(shards), NEEDED)
    found = needed.groupBy("shard").cogroup(known.groupBy("shard")).applyInPandas(_look_up, FOUND)
    packed = base.mapInPandas(_packed, PACKED)
    sums = packed.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInPandas(_summed(shards), "doc_id long, _k long, _sig long, lang string, n_chars long, log_p double")
    scored = cut(sums.select("doc_id", "lang", "n_chars", F.when(F.col("n_chars") > 0, F.exp(-F.col("log_p") / F.col("n_chars"))).alias("perplexity")))
    if stored:
        discard(docs.sparkSession, stored)
    mark = F.percentile_approx("perplexity", quantile, 10_000)
    sure = scored.join(trusted, "doc_id")
    held = sure.where(~_train())
    sure = sure if held.where("perplexity is not null").isEmpty() else held
    overall = sure.agg(mark.alias("m")).first()["m"]
    by_lang = sure.groupBy("lang").agg(mark.alias("mark")).select(F.coalesce("lang", F.lit("")).alias("_l"), F.col("lang").isNull().alias("_n"), "mark")
    joined = scored.withColumns({"_l": F.coalesce("lang", F.lit("")), "_n": F.col("lang").isNull()}).join(by_lang, ["_l", "_n"], "left")
    limit = F.coalesce("mark", F.lit(overall).cast("double"))
    return joined.select("doc_id", "lang", "n_chars", "perplexity", limit.alias("threshold"), F.coalesce(F.col("perplexity") <= limit, (F.col("n_chars") > 0) & limit.isNull()).alias("keep"))
