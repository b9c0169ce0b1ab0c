"""Exact dedup, SimHash near-dedup and fingerprints against brute force, with the odd inputs they must take."""

import hashlib
import re

import pytest
import xxhash

from trailmark.llm import exact_dedup, fingerprints, simhash_dedup

DOCS = "doc_id bigint, text string, source string, norm string, id int, name string, fp string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "clash", 1, "clash", "clash") for i, t in rows], DOCS)


LONG = "wörd alpha " * 3000
ROWS = [
    (5, "a  b\tc"), (3, "a b c"), (9, "a b c "), (1, None), (2, ""), (4, " "), (7, LONG), (8, LONG + "x"), (6, LONG),
    (10, "a b c"), (None, "a b c"), (11, "x" * 9000), (12, "x" * 9000), (13, "x" * 4096), (14, "x" * 8192),
]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("block,bits", [(4096, 64), (16, 64), (16, 2)])
def test_exact_dedup_is_brute_force(spark, block, bits):
    """bits=2 makes the keys of blocks collide, so that several attempts are needed."""
    got = exact_dedup.exact_dedup(frame(spark, ROWS), block, bits).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(norm(t), []).append(i)
    by_id = {r.doc_id: r for r in got}
    for i, t in ROWS:
        ids = groups[norm(t)]
        r = by_id[i]
        assert r.keep_id == min(x for x in ids if x is not None)
        assert r.group_size == len(ids)
        assert r.kept == (i == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(norm(t).encode()).hexdigest()


def test_exact_dedup_repeated_rows_and_empty(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "b")]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert len(got) == 4
    assert sum(r.kept for r in got) == 2
    kept = exact_dedup.keep_first(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "a"), (1, "b")]
    assert exact_dedup.exact_dedup(frame(spark, rows).limit(0)).collect() == []


def test_rows_that_differ_elsewhere(spark):
    """Of rows with one id and text, whatever their other columns, one stays, the same in any order."""
    rows = [(1, "a b", "s"), (1, "a b", "t"), (1, "a  b", "s"), (1, "a b", None), (2, "a b", "s"), (None, "c", "s"), (None, "c", "t")]
    for keep in (exact_dedup.keep_first, simhash_dedup.keep_one):
        got = [keep(spark.createDataFrame(r, "doc_id bigint, text string, source string")).collect() for r in (rows, rows[::-1])]
        assert sorted(map(repr, got[0])) == sorted(map(repr, got[1]))
        assert sorted(str(r.doc_id) for r in got[0]) == ["1", "None"]


def test_keep_one_goes_by_component(spark):
    """Unrelated documents that share an id all stay; near copies without ids are one component."""
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, "alpha beta gamma delta", "s"), (1, "one two three four", "s"), (2, "five six seven", "s")]
    rows += [(None, base + f" tail{k}", "s") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    expected = len({r.fingerprint for r in simhash_dedup.near_components(docs.where("doc_id IS NOT NULL")).collect()}) + 1
    assert len(simhash_dedup.keep_one(docs).collect()) == expected == 4


def fingerprint(text):
    t = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius=4):
    """Least id reachable, by search over all pairs."""
    ids = list(fps)
    out, seen = {}, set()
    for start in ids:
        if start in seen:
            continue
        group, front = {start}, [start]
        while front:
            a = front.pop()
            for b in ids:
                if b not in group and bin(fps[a] ^ fps[b]).count("1") <= radius:
                    group.add(b)
                    front.append(b)
        seen |= group
        out |= dict.fromkeys(group, min(group))
    return out


def test_masks_cover_every_small_difference():
    import random

    masks = [m & (2**64 - 1) for m in simhash_dedup.masks()]
    assert len(masks) == 31
    rnd = random.Random(1)
    for _ in range(2000):
        diff = sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))
        assert any(m & diff == 0 for m in masks)


def test_near_components_is_brute_force(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, " "), (3, "One"), (4, "oNE"), (5, "a b c d e"), (20, LONG)]
    rows += [(30 + k, base + f" tail{k}") for k in range(25)]
    rows += [(60 + k, base.replace(f"w{k}", "z")) for k in range(10)]
    rows += [(100 + k, " ".join(f"q{k}_{i}" for i in range(50))) for k in range(20)]
    got = simhash_dedup.near_components(frame(spark, rows)).collect()
    fps = {i: fingerprint(t) for i, t in rows}
    expected = components(fps)
    assert len(got) == len(rows)
    for r in got:
        assert int(r.fingerprint, 16) == fps[r.doc_id]
        assert r.component_id == expected[r.doc_id]
    kept = simhash_dedup.keep_one(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected.values()))


def test_near_components_on_the_small_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    fps = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash_dedup.query(spark, small).collect()}
    expected = components(fps)
    assert got == {i: (fps[i], expected[i]) for i in fps}


def test_near_components_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "zz yy xx")]
    got = simhash_dedup.near_components(frame(spark, rows)).collect()
    assert len(got) == 4
    assert {r.component_id for r in got if r.fingerprint == votes_hex("a")} == {1}
    assert simhash_dedup.near_components(frame(spark, rows).limit(0)).collect() == []


def votes_hex(text):
    return f"{fingerprint(text):016x}"


def test_links_of_a_crowded_bucket_are_a_spanning_tree():
    import numpy as np

    rnd = np.random.default_rng(3)
    fps = np.unique(np.uint64(0) ^ np.array([sum(1 << int(b) for b in rnd.choice(64, 2, False)) for _ in range(300)], dtype=np.uint64))
    u, v = simhash_dedup._tree(fps, 4)
    assert len(u) == len(fps) - 1
    assert all(bin(int(a) ^ int(b)).count("1") <= 4 for a, b in zip(u, v, strict=True))


def test_edit_report_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    rows = [(i * 7, t) for i, t in enumerate(["é" * 5, None, "", "a b c d", "a b c d", LONG, "x y", "1"])]
    got = {r.doc_id: r for r in fingerprints.edit_report(frame(spark, rows)).collect()}
    line = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(line):
        nxt, half = line[(k + 1) % len(line)], len(t) // 2
        edited = t[: len(t) - half] + nxt[1][:half]
        r = got[i]
        assert (r.n_chars, r.next_id) == (len(t), nxt[0])
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == got[nxt[0]].fingerprint) <= (r.near_next == 1)
    assert got[21].fingerprint == got[28].fingerprint
    assert got[14].fingerprint == "0" * 32


def test_edit_report_odd_rows(spark):
    one = fingerprints.edit_report(frame(spark, [(3, "ab cd")])).collect()
    assert one[0].next_id == 3
    repeated = fingerprints.edit_report(frame(spark, [(3, "ab"), (3, "ab"), (3, "ab"), (None, "x")])).collect()
    assert len(repeated) == 4
    assert fingerprints.edit_report(frame(spark, [(3, "ab")]).limit(0)).collect() == []


def simhash128(text):
    """Brute force, term by term; the hash function is Spark's, computed outside of it by the same library."""
    t = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    hash_of = lambda x, seed: xxhash.xxh64_intdigest(x, seed % 2**64)
    votes = [0] * 128
    total = 0
    for k in range(max(1, len(w) - 1)):
        pair = w[k : k + 2]
        h = 42
        for x in pair:
            h = hash_of(x.encode(), h)
        g = hash_of(signed(h).to_bytes(8, "little", signed=True), 42)
        weight = min(16, max(1, sum(map(len, pair)) - 4))
        total += weight
        for b in range(64):
            votes[64 + b] += weight * (h >> b & 1)
            votes[b] += weight * (g >> b & 1)
    return sum(1 << b for b in range(128) if 2 * votes[b] > total)


def test_fingerprint_bits_and_likeness_are_brute_force(spark):
    import math

    rows = [(i * 5, t) for i, t in enumerate(["One two, three", "", "é ê ë " * 40, "solo", LONG, "a b c d e f g", "A b C d e f h"])]
    got = {r.doc_id: r for r in fingerprints.edit_report(frame(spark, rows)).collect()}
    line = sorted(rows, reverse=True)
    like = lambda a, b: max(0.0, math.cos(min(64, bin(a ^ b).count("1")) * math.pi / 128)) if bin(a ^ b).count("1") < 64 else 0.0
    for k, (i, t) in enumerate(line):
        nxt, half = line[(k + 1) % len(line)][1], len(t) // 2
        own, edited = simhash128(t), simhash128(t[: len(t) - half] + nxt[:half])
        assert (int(got[i].fingerprint, 16), int(got[i].edited_fingerprint, 16)) == (own, edited)
        assert abs(got[i].near_edited - like(own, edited)) < 1e-9
        assert abs(got[i].near_next - like(own, simhash128(nxt))) < 1e-9


def test_query_counts_neighbours(spark, small):
    got = fingerprints.query(spark, small).collect()
    fps = {r.doc_id: int(r.fingerprint, 16) for r in got}
    for r in got:
        expected = sum(bin(fps[r.doc_id] ^ f).count("1") <= 3 for f in fps.values()) - 1 if r.doc_id % 20 == 0 else None
        assert r.neighbours == expected


def test_within_radius_is_brute_force(spark):
    import random

    rnd = random.Random(5)
    words = [rnd.getrandbits(128) for _ in range(40)]
    words += [w ^ sum(1 << b for b in rnd.sample(range(128), rnd.randint(0, 5))) for w in words for _ in range(2)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(k, signed(w >> 64), signed(w & (2**64 - 1))) for k, w in enumerate(words)], "id int, fp_a bigint, fp_b bigint")
    got = {(r.query_id, r.row_id): r.bits for r in fingerprints.within_radius(rows.where("id % 20 = 0"), rows).collect()}
    expected = {}
    for a in range(0, len(words), 20):
        for b in range(len(words)):
            d = bin(words[a] ^ words[b]).count("1")
            if a != b and d <= 3:
                expected[a, b] = d
    assert got == expected
