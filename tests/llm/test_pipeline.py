"""Every stage of the pipeline against brute force on the smallest tables, and the whole run."""

import numpy as np
import public_tokenizers

import corpus_pipeline
from skein.llm import quality_rules
from tests.llm import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((r["doc_id"], r["text"], r["n_chars"]) for r in df.collect())


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]

    want = []
    for i, text, _ in rows_of(docs):
        lines = text.split("\n")
        stay = [x for x in lines if not quality_rules.line_fails(x.encode())]
        size = lambda part: sum(len("".join(x.split()).encode()) for x in part)
        w = brute.words(text, lower=False)
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        twice = {k + j for k, g in enumerate(grams) if seen[g] > 1 for j in range(8)}
        if len(w) >= 20 and 100 * len(twice) <= 30 * len(w) and size(lines) - size(stay) <= size(lines) / 2:
            want.append((i, "\n".join(stay), len("\n".join(stay))))
    got = stages["quality_rules"](spark, docs, SF)
    assert rows_of(got) == want and got.columns == COLUMNS and len(want) < docs.count()

    docs, before = got, want
    got = stages["line_dedup"](spark, docs, SF)
    want = [(i, t, len(t)) for i, t, _, _ in brute.line_dedup([r[:2] for r in before], 10)]
    assert rows_of(got) == want and got.columns == COLUMNS and want != before

    docs, before = got, want
    got = stages["simhash_near_dedup"](spark, docs, SF)
    group = brute.groups([brute.simhash(t) for _, t, _ in before], 2)
    want = [r for k, r in enumerate(before) if group[k] == k]
    assert rows_of(got) == want and got.columns == COLUMNS and len(want) < len(before)

    docs, before = got, want
    got = stages["benchmark_decontamination"](spark, docs, SF)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {i for i, n, hit, _ in brute.decontaminate([r[:2] for r in before], items, 13) if hit and 20 * hit >= n}
    want = [r for r in before if r[0] not in bad]
    assert rows_of(got) == want and got.columns == COLUMNS

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, SF).collect()
    by = {}
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        assert len(by.setdefault(r["doc_id"], [])) == r["start"]
        by[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert by == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t, _ in want}


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "some plain words that make a sentence of more than twenty words so that the rules do not reject it at once ok fine."
    rows = [(None, None, None, None, None), (1, text, None, None, 1), (1, text, None, None, 1), (2, "", "en", "s", 0),
            (None, text + " tail of it.", "en", "s", None)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
            assert docs.columns == COLUMNS, name
        assert docs.count() == (2 if data else 0)
