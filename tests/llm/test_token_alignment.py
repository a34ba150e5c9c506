"""Links between tokens of two tokenizers, against the libraries and a byte-by-byte overlap."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cmdeval.llm import token_alignment as ta
from cmdeval.llm.bpe_count import tokenizer_path

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path(ta.A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(ta.B_FILE))


def tokens(libraries, text):
    a, b = libraries
    level = ta.byte_level()
    whole = (" " + (text or "")).encode()
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_a = [bytes(level[c] for c in a.id_to_token(i)) for i in ids[0]]
    of_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids[1])]
    if b"".join(of_a) != whole or b"".join(of_b) != whole:
        return None
    return ids, [np.cumsum([len(x) for x in side]).tolist() for side in (of_a, of_b)]


def brute(libraries, rows):
    made, count = [], Counter()
    for doc, text in rows:
        t = tokens(libraries, text)
        if t is None:
            made.append((doc, None))
            continue
        (a, b), (ea, eb) = t
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = ea[i], eb[j]
            i, j = i + (x <= y), j + (y <= x)
        count.update(links)
        both, parts, lo = sorted(set(ea) & set(eb)), [], 0
        for cut in both:
            sides = [[x for x, e in zip(ids, ends) if lo < e <= cut] for ids, ends in ((a, ea), (b, eb))]
            parts.append("|".join(",".join(map(str, s)) for s in sides))
            lo = cut
        made.append((doc, (len(a), len(b), len(both), links, ";".join(parts))))
    high = Counter()
    for (_, b), n in count.items():
        high[b] = max(high[b], n)
    out = []
    for doc, m in made:
        if m is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((doc, *m[:3], len(m[3]), sum(count[x] == high[x[1]] for x in m[3]), sum(count[x] for x in m[3]),
                        hashlib.sha256(m[4].encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


def texts():
    rng = random.Random(7)
    parts = ["the", "Étion", "  ", "\n", "\t", " ", "don't", "中文字", "😀", "x1y2", "...", "<|endoftext|>", "<s>", "á", " ", "　", "\x00",
             " ", "naïve", "0123456789", "Zürich", "__init__", "\r\n", "<0x41>", "​"]
    out = ["", None, "one two three", "one two three", "with ▁ mark", "▁", " lead", "trail ", " ", "a  b", "\x1c a"]
    out += ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(1, 40))) for _ in range(250)]
    return out + ["ab" * 800 + " " + " ".join(f"word{i}" for i in range(800)), "aaaa" * 500, "▁x ab"]


def test_equals_libraries_and_byte_overlaps(spark, libraries):
    rows = [*enumerate(texts()), (None, "null id"), (3, "one two three")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(ta.align(df)) == brute(libraries, rows)


def test_token_links_and_pair_counts(spark, libraries):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, SCHEMA)
    count = Counter()
    for r in ta.token_links(df).collect():
        t = tokens(libraries, rows[r.doc_id][1])
        if t is None:
            assert not (r.a_ids or r.b_ids or r.links or r.groups)
            continue
        (a, b), (ea, eb) = t
        assert (r.a_ids, r.b_ids) == (list(a), list(b))
        shared = lambda i, j: min(ea[i], eb[j]) - max(ea[i - 1] if i else 0, eb[j - 1] if j else 0)
        assert all(x.bytes == shared(x.a, x.b) > 0 for x in r.links) and len({(x.a, x.b) for x in r.links}) == len(r.links)
        assert sum(x.bytes for x in r.links) == ea[-1]
        assert [ea[g.a_end - 1] for g in r.groups] == [eb[g.b_end - 1] for g in r.groups] == sorted(set(ea) & set(eb))
        count.update((a[x.a], b[x.b]) for x in r.links)
    got = ta.pair_counts(df).collect()
    assert {(r.a_id, r.b_id): r.n_links for r in got} == dict(count)
    high = Counter()
    for (_, b), n in count.items():
        high[b] = max(high[b], n)
    assert all(r.best == (r.n_links == high[r.b_id]) for r in got)


def test_row_products_are_matrix_products():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, y = rng.integers(0, 2, (7, 5)), rng.integers(0, 2, (5, 6))
        csr = lambda m: (np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1])
        ptr, idx, val = ta.row_products(*csr(x), *csr(y), 6)
        got = np.zeros((7, 6), dtype=int)
        got[np.repeat(np.arange(7), np.diff(ptr)), idx] = val
        assert (got == x @ y).all()
        t_ptr, t_idx = ta.transposed(*csr(x), 5)
        assert (t_ptr == csr(x.T)[0]).all() and (t_idx == csr(x.T)[1]).all()


def test_shared_groups_and_cache_reset(libraries, monkeypatch):
    al = ta.Aligner(tokenizer_path(ta.A_FILE), tokenizer_path(ta.B_FILE))
    monkeypatch.setattr(ta, "CACHE_IDS", 10)
    for text in [t for t in texts() if t][:60]:
        t, n = tokens(libraries, text), ta._met(al, [text])[0]
        assert (t is None) == (n is None)
        if t:
            (_, _), (ea, eb) = t
            cuts = sorted(set(ea) & set(eb))
            group = lambda e: next(i for i, c in enumerate(cuts) if e <= c)
            ga, gb = Counter(map(group, ea)), Counter(map(group, eb))
            assert al.shared.of(n).sum() == sum(ga[g] * gb[g] for g in ga)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two", 5, "x")], SCHEMA + ", block int, pairs string")
    assert ta.align(df).count() == 1 and ta.align(df.where("doc_id = 2")).count() == 0
    assert ta.align(spark.createDataFrame([(1, None), (2, "")], SCHEMA)).count() == 2
