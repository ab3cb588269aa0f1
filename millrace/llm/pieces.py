"""SentencePiece encoding and decoding of BPE models by suffix-array matching.

The distinct words of a batch are joined to one text and its suffixes sorted (by prefix doubling, as far as the longest
piece). Every piece is binary-searched for its range of suffixes; the occurrences are edges from their first to past
their last character. Sorted by where they end, edges are relaxed: the last piece of the encoding up to a position is
the one edge that ends there whose piece goes with the last piece of the encoding up to its start, two pieces going
together if merging their joined text gives just these two. What no piece covers becomes byte pieces.

Words, here, are runs of spaces with what follows up to the next space; no piece reaches over such a boundary.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, worker_state

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Ends words in the joined text. It is in no piece.
END = "﷐"

#: Characters of distinct words that are indexed at once.
PART = 200_000
WIDE = 64
#: Characters, of so many bits, that make the first sorting key.
HEAD, RANK_BITS = 4, 15


class Pieces:
    """A SentencePiece BPE model with byte fallback, read from its file by the library; encoding is done here."""

    def __init__(self, path: str, max_pairs: int = 500_000):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.rank = {p: lib.get_score(i) for i, p in enumerate(self.pieces) if not special[i]}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown, self.size = n, n
        self.bytes = [bytes([self.byte_ids.index(i)]) if lib.is_byte(i) else b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.prefix = lib.encode("a", out_type=str)[0].startswith(SPACE)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or lib.encode("a  b") != lib.encode("a" + 2 * SPACE + "b"):
            raise ValueError("a piece reaches over spaces, or the model drops them: not supported")
        self.dtype = np.uint16 if n < 2**16 - 2 else np.uint32
        self.max_pairs, self.pairs = max_pairs, {}
        whole = sorted(p for p in self.ids if len(p) == 1 or self.merge(p) == [p])
        chars = sorted({c for p in whole for c in p})
        self.char_rank = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.char_rank[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.longest = max(map(len, whole))
        self.length = np.array([len(p) for p in whole], np.int64)
        self.matrix = np.zeros((len(whole), max(HEAD, self.longest)), np.int32)
        for i, p in enumerate(whole):
            self.matrix[i, : len(p)] = self.char_rank[[ord(c) for c in p]]
        if len(chars) >= 2**RANK_BITS - 1:
            raise ValueError("more characters than a head can hold: not supported")
        self.head_from = np.zeros(len(whole), np.int64)
        for k in range(HEAD):
            self.head_from = self.head_from << RANK_BITS | self.matrix[:, k]
        self.head_to = self.head_from + (1 << RANK_BITS * (HEAD - np.minimum(self.length, HEAD)))
        self.whole_ids = np.array([self.ids[p] for p in whole], np.int64)

    def merge(self, text: str) -> list[str]:
        """Plain BPE: merge the best-scored neighbours, the leftmost of equals, until none are a piece."""
        parts, get = list(text), self.rank.get
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def together(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a in an encoding."""
        if a >= self.unknown or b >= self.unknown:
            return True
        left, right = self.pieces[a], self.pieces[b]
        return self.merge(left + right) == [left, right]

    def _pair(self, a: int, b: int) -> bool:
        """The same, remembered."""
        key = a * (self.size + 2) + b
        good = self.pairs.get(key)
        if good is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            good = self.pairs[key] = self.together(a, b)
        return good

    def _go_together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys, where = np.unique(a * (self.size + 2) + b, return_inverse=True)
        keys = keys.tolist()
        good = list(map(self.pairs.get, keys))
        for i, x in enumerate(good):
            if x is None:
                good[i] = self._pair(*divmod(keys[i], self.size + 2))
        return np.array(good, bool)[where]

    def _heads(self, text: np.ndarray) -> np.ndarray:
        """The HEAD characters from each position as one number."""
        head = np.zeros(len(text), np.int64)
        for k in range(HEAD):
            head <<= RANK_BITS
            head[: len(text) - k] |= text[k:]
        return head

    def suffixes(self, heads: np.ndarray) -> np.ndarray:
        """Positions in the order of the ``longest`` characters that start there: by heads first, then doubling."""
        key, step = heads, HEAD
        while True:
            order = np.argsort(key)
            if step >= self.longest:
                return order
            sorted_ = key[order]
            rank = np.empty_like(key)
            rank[order] = np.concatenate(([0], np.cumsum(sorted_[1:] != sorted_[:-1])))
            after = np.zeros_like(rank)
            if step < len(rank):
                after[:-step] = rank[step:] + 1
            key = rank * (int(after.max(initial=0)) + 1) + after
            step *= 2

    def _ranges(self, text: np.ndarray, order: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the range of suffixes that start with it: by its head, then, if it is longer, by the rest."""
        first, past = np.searchsorted(heads, self.head_from), np.searchsorted(heads, self.head_to)
        long = np.nonzero((first < past) & (self.length > HEAD))[0]
        length, matrix = self.length[long], self.matrix[long]
        for after, bound in ((False, first), (True, past)):
            lo, hi = first[long].copy(), past[long].copy()
            if after:
                lo = found
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                start = order[np.minimum(mid, len(order) - 1)]
                state = np.zeros(len(lo), np.int8)  # of the suffix against the piece
                for k in range(HEAD, self.longest):
                    live = (state == 0) & (k < length)
                    if not live.any():
                        break
                    c, p = text[start + k], matrix[:, k]
                    state[live & (c < p)] = -1
                    state[live & (c > p)] = 1
                up = open_ & ((state < 0) | (after & (state == 0)))
                lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
            found = lo
            bound[long] = lo
        return first, past

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece id) of every occurrence of a piece in a text of character ranks."""
        padded = np.concatenate((text, np.zeros(self.longest, text.dtype)))
        heads = self._heads(text)
        order = self.suffixes(heads)
        first, past = self._ranges(padded, order, heads[order])
        n = past - first
        at = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        start, size, piece = order[at], np.repeat(self.length, n), np.repeat(self.whole_ids, n)
        return start, start + size, piece

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as the bytes of an array, indexed PART characters at a time; longer words in stretches."""
        out, at, size = [], 0, 0
        for i, w in enumerate(words):
            if i > at and size + len(w) >= PART:
                out += self._encode_part(words[at:i])
                at, size = i, 0
            size += len(w) + 1
            if len(w) >= PART:
                out.append(self._encode_long(w))
                at, size = i + 1, 0
        return out + (self._encode_part(words[at:]) if at < len(words) else [])

    def _encode_long(self, word: str) -> bytes:
        """The same for one word of any length: PART characters, and what a piece reaches over them, are indexed at once.

        Edges that end at a position start before it, so all of them are known when the position is used.
        """
        n = len(word)
        last, back = np.full(n + 1, -1, np.int32), np.zeros(n + 1, np.int32)
        last[0] = self.unknown + 1
        for a in range(0, n, PART):
            code = np.frombuffer(word[a : a + PART + self.longest].encode("utf-32-le", "surrogatepass"), np.uint32)
            text = self.char_rank[code]
            start, end, piece = self.edges(text)
            lone = np.nonzero(text == 0)[0]
            start, end, piece = np.concatenate((start, lone)), np.concatenate((end, lone + 1)), np.concatenate((piece, np.full(len(lone), self.unknown)))
            order = np.argsort(end, kind="stable")
            order = order[start[order] < PART]
            here, whence = last[a : a + len(code) + 1].tolist(), back[a : a + len(code) + 1].tolist()
            for s, e, t in zip(start[order].tolist(), end[order].tolist(), piece[order].tolist()):
                if here[s] >= 0 and here[e] < 0 and self._pair(here[s], t):
                    here[e], whence[e] = t, a + s
            last[a : a + len(code) + 1], back[a : a + len(code) + 1] = here, whence
        ids, at = [], n
        while at > 0:
            ids.append(int(last[at]))
            at = int(back[at])
        ids.reverse()
        return self._with_bytes(word, ids) if self.unknown in ids else np.array(ids, self.dtype).tobytes()

    def _encode_part(self, words: list[str]) -> list[bytes]:
        joined = END.join(words) + END
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        text = self.char_rank[code]
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
        start, end, piece = self.edges(text)
        lone = np.nonzero((text == 0) & (code != ord(END)))[0]
        start, end, piece = np.concatenate((start, lone)), np.concatenate((end, lone + 1)), np.concatenate((piece, np.full(len(lone), self.unknown)))
        # By position in the word: all words at once while that is many edges, then those of long words one by one.
        at = np.minimum(end - np.repeat(begin, size + 1)[start], WIDE + 1).astype(np.uint16)
        order = np.argsort(at, kind="stable")
        bounds = np.searchsorted(at[order], np.arange(1, WIDE + 3))
        last, back = np.full(len(text) + 1, -1, np.int64), np.zeros(len(text) + 1, np.int64)
        last[begin] = self.unknown + 1
        for i, j in itertools.pairwise(bounds[:-1]):
            some = order[i:j]
            some = some[last[start[some]] >= 0]
            if len(some):
                some = some[self._go_together(last[start[some]], piece[some])]
                last[end[some]], back[end[some]] = piece[some], start[some]
        rest = order[bounds[-2] :]
        last, back = last.tolist(), back.tolist()
        for i in rest[np.argsort(end[rest], kind="stable")].tolist():
            s, e, t = int(start[i]), int(end[i]), int(piece[i])
            if last[s] >= 0 and last[e] < 0 and self._pair(last[s], t):
                last[e], back[e] = t, s
        # Back from the ends of all words at once.
        last, back = np.array(last), np.array(back)
        word, at, steps = np.arange(len(words)), begin + size, []
        n, odd = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        while len(word := word[(open_ := at > begin[word])]):
            at = at[open_]
            steps.append((word, last[at]))
            n[word] += 1
            at = back[at]
        past = np.cumsum(n)
        ids = np.zeros(int(past[-1]), self.dtype)
        for k, (some, piece) in enumerate(steps):
            ids[past[some] - 1 - k] = piece
            odd[some[piece == self.unknown]] = True
        raw, width = ids.tobytes(), ids.itemsize
        out = [raw[a * width : b * width] for a, b in zip((past - n).tolist(), past.tolist())]
        for i in np.nonzero(odd)[0].tolist():
            out[i] = self._with_bytes(words[i], ids[past[i] - n[i] : past[i]].tolist())
        return out

    def _with_bytes(self, word: str, ids: list[int]) -> bytes:
        """Ids of a word with byte pieces for the characters that no piece has."""
        out, at = [], 0
        for i in ids:
            if i == self.unknown:
                out += [self.byte_ids[x] for x in word[at].encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
            at += 1 if i == self.unknown else len(self.pieces[i])
        return np.array(out, self.dtype).tobytes()

    def encode(self, texts: list[str], cache: dict[str, bytes] | None = None, max_cache: int = 500_000) -> list[np.ndarray]:
        """Ids of each text; ``cache`` keeps words from call to call."""
        cache = {} if cache is None else cache
        split = [WORD.findall((SPACE if self.prefix else "") + t.replace(" ", SPACE)) if t else [] for t in texts]
        found = set().union(*split)
        missing = [w for w in found if w not in cache]
        if missing and len(cache) + len(missing) > max_cache:
            cache.clear()
            missing = list(found)
        cache.update(zip(missing, self.encode_words(missing)))
        get = cache.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), self.dtype) for words in split]

    def decode(self, ids) -> str:
        """The text of some ids; bytes that aren't UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64).tolist()
        whole = b"".join(map(self.bytes.__getitem__, ids))
        if self.prefix and whole[:1] == b" " and ids and self.pieces[ids[0]].startswith(SPACE):
            whole = whole[1:]
        return whole.decode("utf-8", "replace")


def _pieces(path: str, cache: int = 500_000) -> tuple[Pieces, dict]:
    """The worker's model and its cache of words."""
    state = worker_state(f"pieces {path} {cache}")
    if not state:
        state.update(pieces=Pieces(path, cache), cache={})
    return state["pieces"], state["cache"]


def _parts(texts: list[str], most: int = 1_000_000):
    """Stretches of a batch of at most ``most`` characters, or one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if texts:
        yield at, len(texts)


def encode_pieces(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", cache: int = 500_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ids, ids (as the library gives them, no begin or end), round_trip.

    ``model``: path of a SentencePiece BPE file that every worker can read. round_trip: decoding the ids gives the text
    again (null counts as empty and has no ids; U+2581 in a text decodes to a space). Repeated rows and null ids stay;
    other columns are not read; no rows in, no rows out. ``cache``: most words, and most pairs of pieces, that a worker
    keeps; it decides time and memory only. No shuffle: words are encoded within their batch, and workers
    keep a bounded cache of them.
    """

    def run(frames):
        p, known = _pieces(model, cache)
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in _parts(texts):
                ids = p.encode(texts[a:b], known, cache)
                same = [p.decode(i) == t for i, t in zip(ids, texts[a:b])]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].array, "n_ids": [len(i) for i in ids], "ids": [i.astype(np.int32) for i in ids], "round_trip": same})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInPandas(run, "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode_pieces(rows: DataFrame, model: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in ``out_col``; null ids give null."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        p, _ = _pieces(model)
        return ids.map(lambda x: None if x is None else p.decode(x))

    return rows.withColumn(out_col, run(F.col(ids_col)))
