"""Fingerprints bit by bit, and groups against all pairs."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from chartspark.llm import components, simhash


def plain_fingerprint(text, words=4):
    tokens = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(prints, max_bits):
    """The smallest place linked to each place."""
    root = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j in range(i):
                if bin(a ^ prints[j]).count("1") <= max_bits:
                    root[i] = root[j] = min(root[i], root[j])
    return root


@pytest.mark.parametrize("text", ["", " \n", "One", "One two three", "a b c d", "A É ß x y z x y z x y z", "w " * 999])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text_is_taken_in_parts(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4, 5, 7])
def test_fingerprints_within_reach_meet_at_an_anchor(max_bits):
    pick = random.Random(max_bits)
    codes = simhash.covering(max_bits)
    for _ in range(150):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), max_bits):
            b ^= 1 << bit
        both = np.array([a, b], np.uint64)
        met = False
        for code in codes:
            near, homes = {0: set(), 1: set()}, {}
            for at, anchor, home in code.anchors(both):
                for i, x, h in zip(at.tolist(), anchor.tolist(), home.tolist()):
                    near[i].add(x)
                    if h:
                        homes[i] = x
            met |= homes[0] in near[1]
        assert met


def test_every_value_has_one_home_within_the_radius():
    code = simhash.Code(0, 16)
    values = np.arange(1 << 16, dtype=np.uint64)
    homes = np.zeros(1 << 16, int)
    for at, anchor, home in code.anchors(values):
        distance = np.bitwise_count(anchor ^ values[at].astype(np.int64))
        assert (distance <= 2).all() and (distance[home] <= code.RADIUS).all()
        assert (code.syndromes[anchor & 0x7FFF] == 0).all()
        homes[at[home]] += 1
    assert (homes == 1).all()


def test_any_four_bits_leave_a_triple_of_blocks_with_one_at_most():
    assert sorted(b for shift, n in simhash.BLOCKS for b in range(shift, shift + n)) == list(range(64))
    for fallen in itertools.combinations_with_replacement(range(6), 4):
        assert any(sum(f in triple for f in fallen) <= 1 for triple in simhash.TRIPLES)


@pytest.mark.parametrize("max_bits", [3, 4])
@pytest.mark.parametrize("spread", [11, 33, 64])
def test_long_codes_meet_too(max_bits, spread):
    pick = random.Random(spread)
    codes = simhash.covering(max_bits, simhash.WIDE_FROM)
    assert len(codes) == len(simhash.TRIPLES) and all(c.length == 31 for c in codes)
    a = np.array([pick.getrandbits(64) for _ in range(400)], np.uint64)
    flips = [sum(1 << bit for bit in pick.sample(range(spread), max_bits)) for _ in a]
    b = a ^ np.array(flips, np.uint64)
    met = np.zeros(len(a), bool)
    for code in codes:
        homes = {(i, x) for at, near, home in code.anchors(a) for i, x in zip(at[home].tolist(), near[home].tolist())}
        for at, near, _ in code.anchors(b):
            for i, x in zip(at.tolist(), near.tolist()):
                met[i] |= (i, x) in homes
    assert met.all()


def test_every_value_has_one_home_by_a_long_code():
    code = simhash.Code(44, 10, (54, 10), (0, 13))
    prints = np.array([random.Random(3).getrandbits(64) for _ in range(3000)], np.uint64)
    values = simhash._joined(prints, code.pieces)
    homes = np.zeros(len(prints), int)
    for at, anchor, home in code.anchors(prints):
        distance = np.bitwise_count(anchor ^ values[at])
        assert (distance <= 2).all() and (distance[home] <= code.RADIUS).all() and (code.syndrome(anchor) == 0).all()
        homes[at[home]] += 1
    assert (homes == 1).all()


def test_long_codes_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "WIDE_FROM", 1)
    prints = sorted(set(near_prints(random.Random(9), 300)))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "print long")
    roots = {r.node: r.root for r in components.components(simhash.links(frame)).collect()}
    found, expected = [roots.get(x, x) for x in signed], groups(prints, 4)
    assert len(set(zip(found, expected))) == len(set(found)) == len(set(expected))


def near_prints(pick, n):
    centres = [pick.getrandbits(64) for _ in range(n // 8 + 1)]
    out = []
    for _ in range(n):
        x = pick.choice(centres)
        for bit in pick.sample(range(64), pick.randrange(6)):
            x ^= 1 << bit
        out.append(x)
    return out


@pytest.mark.parametrize("tile", [4, 8192])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE_ROWS", tile)
    monkeypatch.setattr(simhash, "BUCKETS", 64)
    prints = sorted(set(near_prints(random.Random(tile), 220)))
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "print long")
    roots = {r.node: r.root for r in components.components(simhash.links(frame)).collect()}
    found = [roots.get(x, x) for x in signed]
    expected = groups(prints, 4)
    assert len(set(zip(found, expected))) == len(set(found)) == len(set(expected))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(1000, 1400)]
    frame = spark.createDataFrame([*chain, *star, (7, 7), (1399, 99_999)], "a long, b long")
    roots = {r.node: r.root for r in components.components(frame).collect()}
    assert roots == {**{i: 100 for i in range(101, 161)}, **{i: 5 for i in range(1000, 1400)}, 99_999: 5}
    assert components.components(frame.limit(0)).count() == 0


def docs(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, print int, root string")
    frame.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_groups_of_documents(spark, tmp_path):
    pick = random.Random(4)
    rows = []
    for i in range(40):
        words = [f"w{pick.randrange(500)}" for _ in range(pick.randrange(300))]
        for _ in range(pick.randrange(1, 4)):
            changed = list(words)
            if changed and pick.random() < 0.7:
                changed[pick.randrange(len(changed))] = "other"
            rows.append((pick.choice([None, len(rows)]), " ".join(changed)))
    rows += [(1000, None), (1001, ""), (1001, ""), (None, " ")]
    found = simhash.simhash_groups(docs(spark, tmp_path, rows)).orderBy("row").collect()
    prints = [plain_fingerprint(t or "") for _, t in rows]
    assert [r.fingerprint for r in found] == [f"{p:016x}" for p in prints]
    root = groups(prints, 4)
    least = {g: min((k for (k, _), x in zip(rows, root) if x == g and k is not None), default=None) for g in set(root)}
    assert [r.component for r in found] == [least[g] for g in root]
    assert sum(r.kept for r in found) == len(set(root))
    assert all(r.key == r.component for r in found if r.kept)


def test_a_hot_text_and_no_documents(spark, tmp_path):
    rows = [(i, "the same few words here" if i % 3 else f"text {i} about {i * 7} things {i * 13}") for i in range(600)]
    found = simhash.simhash_groups(docs(spark, tmp_path, rows)).collect()
    assert len(found) == 600 and sum(r.kept for r in found) == len({r.component for r in found})
    assert simhash.simhash_groups(docs(spark, tmp_path / "none", [])).count() == 0
