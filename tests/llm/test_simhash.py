"""Fingerprints, anchors and groups against brute force."""

import random

import numpy as np
import xxhash

from pennyflow.llm import simhash


def brute_print(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    own = [w for w in low.split(" ") if w]
    shingles = [" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(prints, threshold):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    nodes = sorted(prints)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if bin(a ^ b).count("1") <= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in nodes}


def test_fingerprint():
    rnd = random.Random(1)
    for _ in range(200):
        text = "".join(rnd.choice(["Ab", "c", "É", " ", "\n", "\xa0", "\x1c"]) for _ in range(rnd.randrange(30)))
        assert simhash.fingerprint(text) == [brute_print(text)], text
    assert simhash.fingerprint(None) == simhash.fingerprint(" ") == [0]


def test_anchors_are_all_within_reach():
    rnd = np.random.default_rng(0)
    block = rnd.integers(0, 1 << 32, 200)
    home, syndrome = simhash.nearest_anchor(block)
    assert not simhash.nearest_anchor(home)[1].any()
    for extra, most in ((0, 1), (1, 17)):
        rows, found = simhash.anchors(block, extra)
        assert not simhash.nearest_anchor(found)[1].any() and len(set(zip(rows, found))) == len(rows)
        assert np.bincount(rows).max() <= most
    for near, far in ((0, 1), (1, 1), (0, 2)):
        for flips in range(near + far + 1):
            for x in block[:40].tolist():
                y = x
                for place in rnd.choice(32, flips, replace=False):
                    y ^= 1 << int(place)
                at_x = set(simhash.anchors(np.array([x]), near)[1].tolist())
                at_y = set(simhash.anchors(np.array([y]), far)[1].tolist())
                assert at_x & at_y, (near, far, flips)


def test_links_and_groups_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    prints = set()
    for _ in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(12):
            near = centre
            for _ in range(rnd.randrange(5)):
                near ^= 1 << rnd.randrange(64)
            prints.add(near)
    signed = {p: int(np.uint64(p).astype(np.int64)) for p in prints}
    df = spark.createDataFrame([([s],) for s in signed.values()], "print array<bigint>")
    found = {tuple(sorted((r["a"][0], r["b"][0]))) for r in simhash.links(df).collect()}
    want = {tuple(sorted((signed[a], signed[b]))) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= 3}
    assert found == want
    groups = brute_groups(prints, 3)
    edges = spark.createDataFrame([([a], [b]) for a, b in want], "a array<bigint>, b array<bigint>")
    roots = {r["b"][0]: r["a"][0] for r in simhash.contracted(edges, simhash.shared_folder(spark, "t")).collect()}
    mine = {p: roots.get(signed[p], signed[p]) for p in groups}
    assert len(set(zip(groups.values(), mine.values()))) == len(set(groups.values())) == len(set(mine.values()))


def test_longer_fingerprints_link_by_blocks(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(64) for _ in range(2)]
    close = [base[0] ^ 0b11, base[1] ^ 0xFF00]  # two differing bits in one block, eight in another
    rows = [([int(np.uint64(w).astype(np.int64)) for w in p],) for p in (base, close, [rnd.getrandbits(64), 5])]
    df = spark.createDataFrame(rows, "print array<bigint>")
    assert simhash.links(df, 128, 10, 2).count() == 1 and simhash.links(df, 128, 9, 2).count() == 0


def test_groups_of_texts_with_odd_rows(spark, odd, nothing):
    rows = simhash.near_duplicates(odd, words=3).collect()
    assert len(rows) == odd.count()
    by_id = {(r["doc_id"], r["print"][0]): r["component_id"] for r in rows}
    assert by_id[(0, 0)] == by_id[(1, 0)] == by_id[(2, 0)] == by_id[(None, 0)] == 0
    prints = {p: min(i for i, q in by_id if q == p and i is not None) for _, p in by_id if any(q == p and i is not None for i, q in by_id)}
    assert all(by_id[k] <= prints[k[1]] for k in by_id if k[1] in prints)
    assert simhash.near_duplicates(nothing).count() == 0


def test_chain_is_one_group(spark):
    """Links may form a long path; the smallest id names all of it."""
    path, now = [], 0
    for i in range(64):
        path.append(now)
        now |= 1 << i
    edges = spark.createDataFrame([([a], [b]) for a, b in zip(path[:-1], path[1:])], "a array<bigint>, b array<bigint>")
    roots = simhash.contracted(edges, simhash.shared_folder(spark, "t")).collect()
    assert len(roots) == 63 and len({tuple(r["a"]) for r in roots}) == 1
