"""Alignment of two tokenizers against its definition, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chartspark.llm import alignment as module
from chartspark.llm.alignment import alignment
from chartspark.llm.workload import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  two  spaces ", "Hello, world.", "it's\n\ttabs", "日本語 テキスト。", "🙂 ok 🙃", "<|endoftext|> and <s></s> <unk> <0x41>", "a▁b", "▁",
    "naïve café é", "x" * 500, "word " * 300, "12345 6,789.00", "\x00\x01", "é" * 40, "ﬁne ½", " nbsp", "Ａ", " lead", "trail ",
]


def byte_of():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(texts, tokenizers):
    """(rows, counts): ends of tokens compared one by one."""
    a_model, b_model = tokenizers
    byte, docs = byte_of(), []
    for text in texts:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(byte[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_model.id_to_piece(i)]]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        a_ends, b_ends = (np.cumsum([len(x) for x in xs]).tolist() for xs in (a_bytes, b_bytes))
        links = [(i, j) for i, x in enumerate(a_ends) for j, y in enumerate(b_ends) if x == y]
        groups, at = [], (0, 0)
        for i, j in links:
            groups.append((a[at[0] : i + 1], b[at[1] : j + 1]))
            at = (i + 1, j + 1)
        docs.append((a, b, groups, [(a[i], b[j]) for i, j in links]))
    count = Counter(x for *_, links in docs for x in links)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    rows = []
    for a, b, groups, links in docs:
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append(
            (len(a), len(b), len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(written.encode()).hexdigest() if a else "", written)
        )
    return rows, count


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


def stored(spark, tmp_path, texts):
    path = str(tmp_path / "docs")
    rows = [(i if i % 7 else None, t, 1, "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_a int, row string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def some_texts():
    pick = random.Random(3)
    words = ["tion", "Unbelievable", "the", "éclair", "x1", "ß", "zebra", ".", ",", "\n", "  "]
    return TEXTS + ["".join(pick.choice(words) + pick.choice(["", " "]) for _ in range(pick.randrange(60))) for _ in range(120)] + TEXTS[3:8]


@pytest.mark.parametrize("frequent", [0, 5, 60, 1 << 18])
def test_every_link_is_counted(spark, tmp_path, tokenizers, monkeypatch, frequent):
    texts = some_texts()
    got, pairs = alignment(stored(spark, tmp_path, texts), A, B, groups=True, frequent=frequent)
    rows, count = plain(texts, tokenizers)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == sorted(rows)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)


def test_counts_given_away_in_between(spark, tmp_path, tokenizers, monkeypatch):
    held = module._Counts()
    pick = np.random.default_rng(1)
    keys = pick.integers(0, 50, 1000)
    for part in np.split(keys, 10):
        held.add(part)
    found, n = held.merged()
    assert dict(zip(found.tolist(), n.tolist(), strict=True)) == Counter(keys.tolist())


def test_identity_is_by_bytes():
    both = module.aligner(A, B)
    for i in random.Random(2).sample(range(len(both.a_entries)), 2000):
        j = both.same[i]
        assert j < 0 or both.a_entries[i] == both.b_entries[j]
    assert (both.same >= 0).sum() > 5000


def test_long_text(monkeypatch, tokenizers):
    pieces = module.Pieces(B)
    text = " ".join(random.Random(4).choice(["alpha", "be  ta", "gamma\n", "日本", "é", ""]) for _ in range(3000))
    monkeypatch.setattr(module, "STRETCH", 64)
    assert pieces.cuts and pieces.encode(text) == tokenizers[1].encode(text)


def test_no_documents(spark, tmp_path):
    got, pairs = alignment(stored(spark, tmp_path, []), A, B)
    assert got.collect() == [] and pairs.collect() == []
