"""Token ids against the tokenizer, and packed sequences against their definition."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from chartspark.llm import packing, tokens
from chartspark.llm.workload import tokenizer_path

TEXTS = [
    "", " ", "\n\n", "Hello, world.", "it's  don't\n\tWe'LL 've", "a  b c \x1c d\x85e", "trailing \n ", "  leading",
    "ciónueue íar\n\nosrrall", "1234567 89,000.5!!! ### $$$", "e.g., i.e.; x.,", "日本語 テキスト。", "🙂🙃 ok", "<|endoftext|> x",
    "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "\n<|endoftext|>\n", "<|endoftext| >", "x" * 70 + " <|endoftext|> " + "y " * 70,
    "word " * 50, "a.b,c. d, e.\nf", "é.,É.", "²., ½, x², y.", "​ z ﻿",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_gives_the_ids_of_the_tokenizer(tokenizer, monkeypatch):
    encoder = tokens.Encoder(tokenizer_path())
    pick = random.Random(5)
    mixed = ["".join(pick.choices(["a", "B", " ", "\n", ".", ",", "'s", "é", "7", "\t", "!", "　"], k=40)) for _ in range(300)]
    for text in TEXTS + mixed + TEXTS:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(tokenizer, text)
    monkeypatch.setattr(tokens, "STRETCH", 16)
    for text in TEXTS + mixed:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(tokenizer, text)
    encoder.fast = None
    for text in TEXTS:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(tokenizer, text)


def test_strings_of_special_tokens(tokenizer):
    whole, plain = tokens.encoder(tokenizer_path()), tokens.encoder(tokenizer_path(), plain=True)
    assert np.frombuffer(whole.encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    assert 50256 not in np.frombuffer(plain.encode("a <|endoftext|> b"), "<u4").tolist()


@pytest.mark.parametrize("text", [" " * 300_000, "x" * 100_000, "\n" * 200_000 + "y", "🙂" * 20_000, "ab " * 100_000])
def test_encoder_on_long_runs(tokenizer, text):
    assert np.frombuffer(tokens.encoder(tokenizer_path()).encode(text), "<u4").tolist() == ids(tokenizer, text)


def check(rows, texts, tokenizer, capacity):
    """``rows`` hold every document of ``texts`` whole, in gapless sequences that are not too long."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.row].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(texts)
    seen = []
    for parts in pieces.values():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert all(r.length == capacity for r in parts[1:]) and 0 < parts[0].length <= capacity
        assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        seen.append((parts[0].key, tuple(r.ids_crc32 for r in parts)))
    expected = []
    for key, text in texts:
        whole = np.array(ids(tokenizer, text or "") + [0], "<u4")
        first = (len(whole) - 1) % capacity + 1
        cuts = np.split(whole, range(first, len(whole), capacity))
        expected.append((key, tuple(zlib.crc32(c.tobytes()) for c in cuts)))
    assert sorted(seen, key=repr) == sorted(expected, key=repr)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        assert sum(r.length for r in parts) <= capacity
    return len(sequences), sum(r.length for r in rows)


def docs(spark, tmp_path, texts):
    path = str(tmp_path / "docs")
    frame = spark.createDataFrame([(k, t, 9, 9) for k, t in texts], "doc_id long, text string, row int, shard int")
    frame.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_documents_are_packed_whole(spark, tmp_path, tokenizer):
    pick = random.Random(6)
    texts = [(pick.choice([None, i, i // 2]), pick.choice(TEXTS) * pick.choice([1, 1, 40]) if i % 9 else None) for i in range(300)]
    texts += [(i, " ".join(f"word{pick.randrange(99)}" for _ in range(pick.randrange(60)))) for i in range(900)]
    found = packing.best_fit_packing(docs(spark, tmp_path, texts), tokenizer_path(), capacity=64, shard=150).collect()
    sequences, total = check(found, texts, tokenizer, 64)
    assert sequences <= -(-total // 64) * 1.02 + 2


def test_no_documents(spark, tmp_path):
    assert packing.best_fit_packing(docs(spark, tmp_path, []), tokenizer_path()).count() == 0


def plain(lengths, capacity):
    """The rule, step by step: every choice is tried and the squares are added up."""
    rooms, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        best = None
        for b, room in sorted(enumerate(rooms), key=lambda x: x[1]):
            if room < lengths[i]:
                continue
            after = rooms[:b] + [room - lengths[i]] + rooms[b + 1 :]
            squares = sum(after.count(g) ** 2 for g in set(after) if g)
            if best is None or squares < best[0]:
                best = (squares, b)
        if best is None:
            rooms.append(capacity - lengths[i])
        else:
            rooms[best[1]] -= lengths[i]
        out.append(sorted(rooms))
    return out[-1] if out else []


@pytest.mark.parametrize("seed", range(8))
def test_sum_of_squares_follows_the_rule(seed):
    pick = random.Random(seed)
    lengths = np.array([pick.randrange(1, 21) for _ in range(60)])
    bins, offsets = packing.sum_of_squares(lengths, 20)
    rooms = sorted(20 - lengths[bins == b].sum() for b in set(bins.tolist()))
    assert rooms == plain(lengths.tolist(), 20)
    for b in set(bins.tolist()):
        at = np.argsort(offsets[bins == b])
        assert offsets[bins == b][at].tolist() == np.cumsum(np.r_[0, lengths[bins == b][at]])[:-1].tolist()
