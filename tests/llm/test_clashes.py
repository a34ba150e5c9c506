"""Columns of the input named like helpers of the operators; texts that are odd to a tokenizer; low similarities."""

import random

import numpy as np
import pytest

from cmdeval.llm import line_dedup, repair_binary, sentencepiece_scan, toxicity
from cmdeval.llm.bpe_count import tokenizer_path
from cmdeval.llm.common import apart

HELPERS = ["_j", "_t", "_m", "_id", "_key", "_lines", "_removed", "_whole", "_doc", "_ids", "_k", "_decoded", "_ID2"]
TEXT = "same old line here\nanother line of words\nsame old line here"


def clashing(spark):
    schema = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in HELPERS)
    return spark.createDataFrame([(i, f"{TEXT}\nown {i} thing", *[f"{c}{i}" for c in HELPERS]) for i in range(3)], schema)


def kept(df):
    return sorted((r.doc_id, *[r[c] for c in HELPERS]) for r in df.collect())


def test_helper_columns_of_the_input_stay(spark):
    df = clashing(spark)
    want = kept(df)
    assert kept(line_dedup.dedup_lines(df)) == want
    assert kept(sentencepiece_scan.encode(df)) == want
    assert kept(sentencepiece_scan.encode(df, chunk_chars=50)) == want
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id bigint, toxic int")
    assert kept(toxicity.score(df, labels)) == want


def test_apart_names_are_free(spark):
    df, back = apart(spark.createDataFrame([(1, 2, 3)], "_K int, _k__0 int, x int"), "_k")
    assert df.columns[1:] == ["_k__0", "x"] and df.columns[0] not in ("_K", "_k__0") and df.withColumnsRenamed(back).columns == ["_K", "_k__0", "x"]


def test_sentencepiece_replaces_its_own_columns(spark):
    df = spark.createDataFrame([("old", 1, "one two " * 20, "old")], "ids string, doc_id bigint, text string, N_Tokens string")
    for chars in (50, 1000):
        row = sentencepiece_scan.encode(df, chunk_chars=chars).collect()[0]
        assert row.__fields__ == ["ids", "doc_id", "text", "N_Tokens", "round_trip"]
        assert row.round_trip and row.ids and row["N_Tokens"] == len(row.ids) and sentencepiece_scan.encode(df.where("doc_id = 2")).count() == 0
    with pytest.raises(ValueError):
        sentencepiece_scan.encode(df, chunk_chars=2)


@pytest.mark.parametrize("similarity", [30, 50, 80])
def test_exactly_the_similar_lines_go(spark, similarity):
    rng = random.Random(similarity)
    lines = [" ".join(rng.choice("abcdefg") for _ in range(rng.choice([1, 2, 3, 5]))) for _ in range(60)] + ["b", "a b"]
    sets, gone = [set(x.split()) for x in lines], []
    for i, s in enumerate(sets):
        first = [t for t in sets[:i] if t == s or 100 * len(s & t) >= similarity * len(s | t)]
        gone.append(bool(first))
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id bigint, text string")
    assert line_dedup.dedup_lines(df, similarity).collect()[0].text.split("\n") == [x for x, g in zip(lines, gone) if not g]


def test_repair_ids_of_odd_texts_are_the_librarys():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own = repair_binary.WordEncoder(tokenizer_path("word_bpe_49k.json"), 1)
    rng = random.Random(1)
    parts = [*map(chr, range(0, 0x30)), "a", "b", "Zé", "_", "\x85", "\xa0", "́", " ", "…", "．", "<|endoftext|>", "’s", "'s", "1", "½", "ß", "İ", "ǅ"]
    texts = ["a\x1c.b", ".\x1f", "\x1d,", "a.\x1e.b"] + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(6000)]
    ids, sizes = own.encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert got.tolist() == [*lib.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_pipeline_stages_keep_clashing_columns(spark):
    import corpus_pipeline
    names = ["_t", "_m", "_i", "_k", "_copy", "_doc_id"]
    schema = "doc_id bigint, source string, text string, " + ", ".join(f"{c} string" for c in names)
    rows = [(i, "ab"[i % 2], f"words of document {i} that differ from all the {i} others", *[f"{c}{i}" for c in names]) for i in range(6)]
    df = spark.createDataFrame(rows, schema)
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.mix_sources):
        got = stage(spark, df, "").collect()
        assert got and all(tuple(r) in rows for r in got) and got[0].__fields__ == df.columns
