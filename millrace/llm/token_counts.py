"""Token counts by a two-tier map-side lookup.

Tier one is a broadcast table: pre-token -> number of tokens, for the strings of the tokenizer's own vocabulary (its
size, which doesn't grow with the corpus, bounds the table). Tier two is a cache in each worker: a pre-token that the
table lacks is encoded by the library once and remembered. No pre-token leaves its task.
"""

from __future__ import annotations

import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of, worker_state

#: The pattern by which the byte-level pre-tokenizer splits text. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The same for text without UNSETTLED characters, the classes spelled out: there all Unicode versions agree. Fixed value.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ˁˆ-ˑˠ-ˤˬˮ"
NUMBER = "0-9²³¹¼-¾"
BLANK = r"\t-\r \x85\xa0"
SETTLED = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"

#: Texts with any of these are split by the library's own pre-tokenizer, which has its Unicode tables.
UNSETTLED = "[\x1c-\x1fͰ-\U0010ffff]"

PART = 1_000_000

def _byte_chars() -> dict[str, int]:
    """Of the byte-level alphabet: printable stand-in -> byte (printable Latin-1 stands for itself, the rest from U+0100 on)."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def frequent_lengths(path: str, max_entries: int = 200_000) -> dict[str, int]:
    """Token counts of those vocabulary strings that are one pre-token: at most ``max_entries``, in order of their rank."""
    import regex
    from tokenizers import Tokenizer

    tok, back, split = Tokenizer.from_file(path), _byte_chars(), regex.compile(PATTERN)
    strings = []
    for piece, _ in sorted(tok.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1]):
        try:
            s = bytes(back[c] for c in piece).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if split.findall(s) == [s]:
            strings.append(s)
        if len(strings) == max_entries:
            break
    return dict(zip(strings, (len(e.ids) for e in tok.encode_batch_fast(strings, add_special_tokens=False))))


def _counter(path: str, most: int, table: dict[str, int]):
    """The worker's counting function for lists of texts, made once in each Python worker."""
    state = worker_state(f"tokens {path} {most} {id(table)}")
    if state:
        return state["count"]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    if tok.normalizer is not None:
        raise ValueError("a tokenizer that normalizes its text: not supported")
    settled, beyond, cache = re.compile(SETTLED).findall, re.compile(UNSETTLED).search, {}

    def split(text: str) -> list[str]:
        if beyond(text):
            return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
        return settled(text)

    def part(texts: list[str]) -> list[int]:
        whole = [any(a in t for a in added) for t in texts]
        tokens = [[t] if w else split(t) for t, w in zip(texts, whole)]
        found = set().union(*(x for x, w in zip(tokens, whole) if not w))
        missing = [t for t in found if t not in table and t not in cache]
        if len(cache) + len(missing) > most:
            cache.clear()
            missing = [t for t in found if t not in table]
        cache.update(zip(missing, (len(e.ids) for e in tok.encode_batch_fast(missing, add_special_tokens=False))))
        here = {t: table[t] if t in table else cache[t] for t in found}.__getitem__
        return [len(tok.encode(x[0], add_special_tokens=False).ids) if w else sum(map(here, x)) for x, w in zip(tokens, whole)]

    def count(texts: list[str]) -> list[int]:
        out, at, size = [], 0, 0
        for i, t in enumerate(texts):  # about PART characters at a time
            if i > at and size + len(t) > PART:
                out += part(texts[at:i])
                at, size = i, 0
            size += len(t)
        return out + part(texts[at:])

    state["count"] = count
    return count


def token_counts(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, frequent: dict[str, int] | None = None, cache: int = 400_000
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer``: path of a byte-level BPE file of the tokenizers library that every worker can read. Special strings
    in a text count as that library takes them by default. Null and empty texts have 0 tokens. Rows are kept as they
    come: repeated rows and null ids stay. Other columns are not read. ``cache``: most entries of a worker's own cache.
    """
    spark: SparkSession = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(tokenizer) if frequent is None else frequent)
    @F.pandas_udf(T.LongType())
    def count(texts):
        return pd.Series(_counter(tokenizer, cache, table.value)(texts.tolist()), dtype="int64")

    text = text_of(text_col)
    counted = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
