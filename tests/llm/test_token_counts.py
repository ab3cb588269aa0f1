import public_tokenizers
from millrace.llm.token_counts import frequent_lengths, token_counts
from tokenizers import Tokenizer

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, **kw):
    tok = Tokenizer.from_file(PATH)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    rows = token_counts(docs, PATH, **kw).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_odd_rows(spark):
    check(cases.odd(spark))


def test_documents(spark, sf):
    check(cases.documents(spark, sf))


def test_small_cache_and_table(spark, sf):
    check(cases.documents(spark, sf).limit(50), frequent={" the": 1}, cache=20)


def test_table_is_bounded():
    table = frequent_lengths(PATH)
    assert 30_000 < len(table) <= 50_257 and table[" the"] == 1 and len(frequent_lengths(PATH, 100)) == 100


def test_empty(spark):
    assert token_counts(cases.empty(spark), PATH).count() == 0


def test_all_scripts(spark):
    """Letters, digits, marks and blanks of any script, among them those that Unicode versions class differently."""
    import random

    rng = random.Random(3)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x370, 0x600), (0x900, 0xE00), (0x1C80, 0x1CFF), (0x2000, 0x2070), (0x3040, 0x3100), (0x4E00, 0x9FFF), (0xAC00, 0xD7A0), (0x10D40, 0x10D90), (0x1F300, 0x1FAFF), (0x1C, 0x20)]
    texts = []
    for _ in range(400):
        text = ""
        for _ in range(rng.randrange(1, 12)):
            low, high = rng.choice(ranges)
            text += "".join(chr(rng.randrange(low, high)) for _ in range(rng.randrange(1, 5))) + rng.choice(["", " ", "  ", "\n", "’s ", "—"])
        texts.append(text)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), cache=50)
