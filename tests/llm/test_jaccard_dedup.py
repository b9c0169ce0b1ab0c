"""The pipeline's near-dedup against all pairs by exact Jaccard similarity."""

import random
import re

import corpus_pipeline
from trailmark.llm import jaccard_dedup, simhash_dedup

DOCS = "doc_id bigint, text string, source string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept(rows):
    """Least id of each component, by search over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    near = lambda a, b: a == b or (a and b and 5 * len(a & b) >= 4 * len(a | b))
    left, out = sorted(sets), []
    while left:
        front, left = [left[0]], left[1:]
        out.append(front[0])
        while front:
            at = front.pop()
            found = [k for k in left if near(sets[at], sets[k])]
            front += found
            left = [k for k in left if k not in found]
    return out


def test_stage_is_brute_force_at_its_similarity(spark):
    rnd = random.Random(4)
    rows = [(1, None), (2, " \t"), (3, "One two"), (4, "oNE  TWO"), (5, "a b c d e"), (6, "a b c d")]
    for family in range(12):
        base = [f"f{family}_{k}" for k in range(200)]
        for copy in range(5):
            text = list(base)
            for at in rnd.sample(range(200), rnd.randint(0, 12)):
                text[at] = f"x{copy}_{at}"
            rows.append((100 + 10 * family + copy, " ".join(text)))
    rows += [(1000 + k, " ".join(f"chain{j}" for j in range(10 * k, 10 * k + 100))) for k in range(8)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS)
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == kept(rows)
    assert {(r.doc_id, r.text) for r in got} <= set(rows)


def test_keep_one_odd_rows(spark):
    near = " ".join(f"w{k}" for k in range(100))
    rows = [(None, near), (None, near + " end"), (None, "other"), (7, "same"), (7, "same"), (8, "q r s t u v")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS)
    got = jaccard_dedup.keep_one(docs).collect()
    assert len(got) == 4
    assert sum(r.text.startswith("w0 ") for r in got) == 1
    assert jaccard_dedup.keep_one(docs.limit(0)).collect() == []


def test_stage_takes_candidates_from_simhash(spark, monkeypatch):
    """Near copies that no band holds are found through their fingerprints; texts with one fingerprint but few common
    shingles stay apart."""
    base = " ".join(f"w{k}" for k in range(400))
    cycle = " ".join("a b c d e f g".split() * 200)
    rows = [(1, base), (2, base + " end"), (3, "other " + base), (4, "q r s t u v w")]
    rows += [(k, cycle + " " + " ".join(f"x{k}_{j}" for j in range(9))) for k in (5, 6)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], DOCS)
    unmet = {"bands": 1, "depth": 8000}
    assert len(jaccard_dedup.keep_one(docs.where("doc_id <= 2"), **unmet).collect()) == 2
    got = jaccard_dedup.keep_one(docs, **unmet, near=simhash_dedup.text_roots(docs)).collect()
    assert sorted(r.doc_id for r in got) == [1, 4, 5, 6]
    asked = []
    find = simhash_dedup.text_roots
    monkeypatch.setattr(simhash_dedup, "text_roots", lambda d: asked.append(1) or find(d))
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 4, 5, 6]
    assert asked
