import re

import corpus_pipeline
import public_tokenizers
import sentencepiece
from millrace.llm.common import table

from . import cases
from .test_simhash import brute as components


def test_stages_on_documents(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    text = {r.doc_id: r.text for r in docs.collect()}

    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and len(kept) > 0.8 * len(text)

    one = corpus_pipeline.drop_copies(spark, docs, sf)
    least = {}
    for i, t in text.items():
        body = re.sub(r"[\x20\x09-\x0D]", "", t)
        least[body] = min(least.get(body, (1, 0)), (-len(t), i))
    assert one.columns == columns and {r.doc_id for r in one.collect()} == {i for _, i in least.values()}

    near = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert near.columns == columns and {str(r.doc_id) for r in near.collect()} == {c for _, _, c in components(text.items())}

    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == columns and mixed.exceptAll(docs).isEmpty() and mixed.count() == docs.count()

    rows = corpus_pipeline.run(spark, sf).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert rows and all(r.ids == lib.encode(text[r.doc_id]) for r in rows) and len({r.doc_id for r in rows}) == len(rows)


def test_repeated_rows_and_nulls(spark):
    odd = cases.odd(spark)
    one = corpus_pipeline.drop_copies(spark, odd, "")
    assert one.columns == odd.columns
    left = {(r.doc_id, r.text) for r in one.collect()}
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in left]
    assert len(bodies) == len(set(bodies)) == one.count() == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in cases.ODD})
    near = corpus_pipeline.drop_near_copies(spark, odd, "")
    assert near.count() == len({c for _, _, c in components([(r[0], r[1]) for r in cases.ODD])})
    assert corpus_pipeline.drop_near_copies(spark, cases.empty(spark), "").isEmpty()
    assert corpus_pipeline.mix_sources(spark, cases.empty(spark), "").isEmpty()


def test_odd_rows_in_the_outer_stages(spark, sf):
    """Nothing of the odd rows is toxic, so all stay, whatever their columns are called; each has its ids."""
    odd = cases.odd(spark)
    left = corpus_pipeline.drop_toxic(spark, odd, sf)
    assert left.columns == odd.columns and left.exceptAll(odd).isEmpty() and left.count() == len(cases.ODD)
    assert corpus_pipeline.drop_toxic(spark, cases.empty(spark), sf).isEmpty()
    rows = corpus_pipeline.encode(spark, odd, sf).collect()
    assert len(rows) == len(cases.ODD) and sum(r.n_ids == 0 for r in rows) == sum(not r[1] for r in cases.ODD)
    assert corpus_pipeline.encode(spark, cases.empty(spark), sf).isEmpty()


def test_odd_rows_in_the_mixing_stage(spark):
    """Every row stays as it was, repeated ones too, with columns named like those of the mix."""
    odd = cases.odd(spark).selectExpr("*", "1 AS slot", "'p' AS slot_pos", "2 AS block", "doc_id AS _k", "lang AS row")
    mixed = corpus_pipeline.mix_sources(spark, odd, "")
    assert mixed.columns == odd.columns and mixed.count() == len(cases.ODD) and mixed.exceptAll(odd).isEmpty()
