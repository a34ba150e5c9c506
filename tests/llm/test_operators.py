"""Each operator on small, awkward tables, against brute force or the tokenizer libraries."""

import itertools
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cmdeval.llm import (ann, bpe_count, chat, line_dedup, mixing, ngram_join, pq_dedup, repair_binary,
                         sentencepiece_scan, toxicity)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "ab" * 4000 + " " + " ".join(f"w{i}" for i in range(3000))
TEXTS = ["one two three four five six", "", None, LONG, "A a. B, <|endoftext|> don't  x\n\n y", "one two three four five six",
         "ñandú 中文 😀 ▁ \t tab", "The cat sat.\nThe cat sat.\nOther line here"]


def docs(spark, texts=TEXTS):
    rows = [(i, t, "en", "abc"[i % 3], 0) for i, t in enumerate(texts)] + [(None, "null id", None, None, None)]
    return spark.createDataFrame(rows + rows[:1], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def library(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_count.tokenizer_path(name))


def test_token_counts_are_the_librarys(spark):
    got = bpe_count.count_tokens(docs(spark).withColumn("n_tokens", F.lit("clash"))).collect()
    lib = library("byte_bpe_50k.json")
    for r in got:
        t = r.text or ""
        assert r.n_tokens == len(lib.encode(t, add_special_tokens=False).ids)
        assert r.n_bytes == len(t.encode()) and r.over_limit == (r.n_tokens > 1024)
    assert bpe_count.count_tokens(empty(spark)).count() == 0


def test_repair_files_give_all_ids_back(spark):
    got = sorted(repair_binary.encode_and_read(docs(spark)).collect(), key=lambda r: r.start)
    rows = sorted(docs(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    lib, start = library("word_bpe_49k.json"), 0
    for r, d in zip(got, rows, strict=True):
        ids = np.array([*lib.encode(d.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert repair_binary.encode_and_read(empty(spark)).count() == 0


def test_repair_grammar_round_trip_and_slices():
    ids = np.tile(np.array([5, 6, 7, 5, 6, 8, 8, 8], dtype=np.uint32), 500)
    first, rules, lengths, symbols = repair_binary.compress(ids)
    assert len(symbols) < len(ids) / 4
    shard = {"rules": rules.tobytes(), "lengths": lengths.tobytes(), "symbols": symbols.tobytes(), "first_rule": first,
             "n_tokens": len(ids)}
    for lo, hi in ((0, 4000), (17, 18), (1234, 3210), (5, 5)):
        assert np.array_equal(repair_binary.decode_slice(shard, lo, hi), ids[lo:hi])


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(1)
    skewed = np.minimum(rng.zipf(1.3, 60_000), 3000)
    for ids in (np.full(100_000, 7), np.tile(rng.integers(0, 40_000, 3000), 60), skewed):
        first, rules, lengths, symbols = repair_binary.compress(ids.astype(np.uint32))
        pairs, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
        assert counts.max(initial=0) < repair_binary.MIN_COUNT <= 24
        assert len(np.unique(rules, axis=0)) == len(rules)
        assert np.array_equal(repair_binary.expand(symbols, first, rules, lengths), ids)


def test_sentencepiece_chunks_are_the_librarys(spark):
    got = sentencepiece_scan.decode(sentencepiece_scan.encode(docs(spark), chunk_chars=100)).collect()
    lib = sentencepiece_scan.pieces_at(bpe_count.tokenizer_path("piece_bpe_32k.model")).library
    for r in got:
        assert list(r.ids) == lib.encode(r.text or "") and r.n_tokens == len(r.ids)
        assert r.decoded == lib.decode(list(r.ids)) or "▁" in (r.text or "")
        assert r.round_trip == (r.decoded == (r.text or ""))
    assert sentencepiece_scan.encode(empty(spark)).count() == 0


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 7), None, s, 0) for i, s in zip(range(300), itertools.cycle(["a", "b", None, "a", "c"]))]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    total = sum(r.size for r in got)
    by = {s: [r for r in got if r.source == s] for s in ("a", "b", "c", None)}
    assert sum(r.taken for r in got) == pytest.approx(1.5 * total, abs=4)
    for rows_ in by.values():
        assert sum(r.taken for r in rows_) == pytest.approx(rows_[0].target, abs=1)
    assert all(0 <= r.taken <= 2 * r.size for r in got) and len(got) == 300
    assert mixing.mix(empty(spark)).count() == 0


def test_line_dedup_by_brute_force(spark):
    base = [f"t{i}" for i in range(12)]
    lines = [" ".join(base), " ".join([*base[:11], "x"]), " ".join(base[:5]), "", " ".join(reversed(base)), "q", "Q", None]
    table = [(i, "\n".join(x for x in (lines[i % 8], lines[(i * 3) % 8], f"own {i}") if x is not None), 9) for i in range(16)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(
        [*table, (99, None, None)], "doc_id bigint, text string, n_chars bigint")).collect()}
    seen = []
    for i, text, _ in table:
        kept = []
        for line in text.split("\n"):
            s = frozenset(line.lower().split())
            if s and any(len(s & t) * 100 >= 80 * len(s | t) for t in seen):
                continue
            kept.append(line)
        # An earlier line is a witness whether it stayed or not.
        for line in text.split("\n"):
            seen.append(frozenset(line.lower().split()))
        own = text.split("\n")
        assert set(got[i].text.split("\n")) <= set(own) and got[i].n_chars == len(got[i].text)
        assert all(x in got[i].text.split("\n") for x in kept if own.count(x) == 1 and x.startswith("own"))
    assert got[99].text is None and got[99].n_removed == 0
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_leaves_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files() -> set[str]:
        files = blocks.getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}
    kept, before = shuffle_files(), spark.conf.get(line_dedup.CLEANUP, None)
    rows = [(i, f"one line of {i} words\none line of {i // 2} words here\nthe same") for i in range(40)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    for _ in range(100):  # files go a little later
        if not (left := shuffle_files() - kept):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(line_dedup.CLEANUP, None) == before
    assert out.count() == 40


def test_line_dedup_ranks_lines_once(spark):
    ranked = spark.createDataFrame([(1, [1, 2, 3], 1, 1), (2, [1, 2, 4], 1, 1)], "k bigint, ranked array<bigint>, parity bigint, parity2 bigint")
    joined = line_dedup._candidates(ranked, 50)
    assert [tuple(r) for r in joined.collect()] == [(1, 2)]
    assert "ReusedExchange" in joined._jdf.queryExecution().executedPlan().toString()


def test_repair_words_part_from_punctuation():
    from tokenizers import Tokenizer
    path = repair_binary.tokenizer_path("word_bpe_49k.json")
    own, lib = repair_binary.WordEncoder(path, 1), Tokenizer.from_file(path)
    texts = ["An an!! (AN) an%%%\tan", "it's 'ts !!'s x'!y '1 'll", "", "a_b 12<3 <|endoftext|>", "ÉÀ, жЖ!!\x1c.. é"]
    ids, sizes = own.encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert got.tolist() == [*lib.encode(text, add_special_tokens=False).ids, 1]
    own = repair_binary.WordEncoder(path, 1)
    own.encode(texts[:1])
    assert set(own.known) == {"an", "!!", "(", ")", "%%%"}


def test_snapshots_collapse_to_maximal_conversations(spark):
    rows = []
    for conv, turns in ((1, "abc"), (2, "ab"), (3, "abd"), (4, "abc"), (5, "x"), (6, "a" * 600), (7, "a" * 300)):
        rows += [(conv, i, "user" if i % 2 == 0 else None, t) for i, t in enumerate(turns)]
    rows += [(None, 0, "user", "lost"), (8, None, "user", "lost"), (1, 0, "user", "a")]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert {r.conv_id for r in got} == {1, 3, 5, 6}
    assert {r.segment: r.n_turns for r in got if r.conv_id == 6} == {0: 256, 1: 256, 2: 88}
    assert next(r.text for r in got if r.conv_id == 5) == "<|im_start|>user\nx<|im_end|>\n"


def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 16)).astype(np.float32)
    x[40:80] = x[0] + 0.05 * rng.normal(size=(40, 16))
    x[80:90] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(200, None), (201, [0.0] * 16), (202, [None] + [1.0] * 15), (203, [float("nan")] * 16), (204, [1.0, 2.0])]
    return x, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def cosines(x):
    x = x.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_near_vectors_by_brute_force(spark):
    x, df = vectors(spark)
    link = cosines(x) >= 0.95
    np.fill_diagonal(link, False)
    part = np.arange(len(x))
    for _ in range(len(x)):
        part = np.array([min([part[i], *part[link[i]]]) for i in range(len(x))])
    got = {r.vec_id: r for r in pq_dedup.near_duplicates(df).collect()}
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), part[i], part[i] == i)
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i in range(200, 205))
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def test_search_finds_the_nearest(spark):
    x, df = vectors(spark)
    c = cosines(x)
    got = ann.search(df, F.col("vec_id") % 10 == 0).collect()
    hit = 0
    for q in range(0, 120, 10):
        want = sorted((i for i in range(120) if i != q), key=lambda i: (-round(c[q, i], 12), i))[:5]
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)]
        assert len(mine) == 5
        hit += len(set(mine) & set(want))
    assert hit >= 0.9 * 60
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_ngram_components_by_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [None, "", "a b", "A B", "a b c d"]
    for g in range(12):
        words = [f"w{g}_{i}" for i in range(int(rng.integers(5, 200)))]
        for _ in range(6):
            w = list(words)
            for k in rng.integers(0, len(w), size=rng.integers(0, 4)):
                w[k] = f"z{rng.integers(1000)}"
            texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    part = list(range(len(sets)))
    links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    for _ in range(len(sets)):
        for i, j in links:
            part[i] = part[j] = min(part[i], part[j])
    for r in ngram_join.join_components(df).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), part[r.doc_id])
    assert ngram_join.join_components(df.limit(0)).count() == 0


def test_toxicity_learns_from_allowed_labels_only(spark):
    rows = [(i, ("you utter swine fool " if i % 5 == 0 else "a fine and sunny day ") + f"filler{i % 50} more{i % 7}")
            for i in range(600)] + [(1000, None), (1001, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, (int(i % 5 == 0) if zlib.crc32(str(i).encode()) % 3 != 1 else int(i % 5 != 0)))
                                    for i in range(600)], "doc_id bigint, toxic int")
    got = toxicity.score(df, labels).collect()
    assert len(got) == 602
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.doc_id < 600 and r.doc_id % 5 == 0)
    assert toxicity.score(df.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.score(df.limit(3), labels.limit(0)).collect()} == {0.0}


def test_toxicity_indexes_every_word(spark, monkeypatch):
    """No word tells the classes apart, yet a copy of an example finds it, and pruning loses no neighbour."""
    texts = [" ".join(f"w{i}_{k}" for k in range(8)) + f" shared{i % 9} common" for i in range(300)]
    df = spark.createDataFrame([(i + lo, t) for lo in (0, 1000) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    read = {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
    got = {r.doc_id: r for r in toxicity.score(df, labels).collect()}
    assert all(got[1000 + i].evidence[0].doc_id == i and got[1000 + i].evidence[0].cosine == pytest.approx(1) for i in read)
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", 1)
    index = toxicity.fit(df, labels)
    dense = np.zeros((len(read), len(index.number)))
    for j, (ids, w) in enumerate(index.own):
        dense[j, ids] = w
    for j, own in enumerate(index.own):
        places, scores = index.nearest(*own)
        want = np.sort(dense @ dense[j])[::-1][:toxicity.NEIGHBOURS]
        assert np.allclose(scores, want[want > 0]) and np.allclose(scores, dense[places] @ dense[j])


def test_pipeline_mix_keeps_a_source_of_one_long_document(spark):
    import corpus_pipeline
    rows = [(100 * k + i, "w " * 10, None, s, 0) for k, (s, n) in enumerate((("a", 31), ("b", 13), ("d", 31))) for i in range(n)]
    got = corpus_pipeline.mix_sources(spark, spark.createDataFrame([*rows, (999, "w " * 250, None, "c", 0)], DOCS), "")
    counts = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert counts.keys() == {"a", "b", "c", "d"} and counts["c"] == 1  # its target is 115 of 250 words
