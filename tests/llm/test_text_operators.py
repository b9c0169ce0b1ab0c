"""Mixing, substrings, BPE, HTML extraction: brute force, round trips and odd inputs."""

import hashlib
import random

import numpy as np
import pytest

from trailmark.llm import byte_bpe, html_extract, mixing, substrings

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, size int, start int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, 1) for i, t, s in rows], SCHEMA)


def test_mixing_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "a", "a", "b", "c", None])) for i in range(200)]
    rows += [(300, None, "a"), (301, "", "d"), (None, "q r", "b"), (5, "q r s", "b"), (5, "q r s", "b"), (302, "z " * 40_000, "e")]
    total = sum(len((t or "").split()) for _, t, _ in rows)

    def digest(rows):
        placed, n, budget = mixing.placed(frame(spark, rows))
        return placed.collect(), mixing.cut(mixing.packets(placed), n, budget).collect(), budget

    placed, sent, budget = digest(rows)
    assert len(placed) == len(rows) and budget == 3 * total // 2
    targets = {r.source: r.target for r in placed}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    # the order and the cut by brute force
    line = sorted(sent, key=lambda r: (r.finish, r.source is None, r.source or "", r.turn, r.packet, r.bucket, r.seq))
    ahead, per_turn = 0, {}
    for r in line:
        assert r.taken == max(0, min(r.n_words, budget - ahead))
        ahead += r.n_words
        key = (r.source, r.bucket, r.seq, r.turn)
        per_turn[key] = per_turn.get(key, 0) + r.taken
        assert per_turn[key] <= r.size
    assert sum(r.taken for r in sent) == budget
    for source, target in targets.items():
        assert abs(sum(r.taken for r in sent if r.source == source) - target) < len(targets)
    key = lambda r: (str(r.doc_id), str(r.source), r.turn, r.packet, r.taken)
    assert sorted(map(key, digest(rows[::-1])[1])) == sorted(map(key, sent))


def test_mix_gives_the_scheduled_words(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(1 + i % 9)), "abc"[i % 3]) for i in range(60)] + [(7, "again", "a")] * 2
    out = mixing.mix(frame(spark, rows)).collect()
    plan = mixing.schedule(frame(spark, rows)).collect()
    assert len(out) == len(plan)
    assert sum(len(r.text.split()) for r in out) == sum(r.n_words for r in plan)
    assert mixing.mix(frame(spark, rows).limit(0)).collect() == []


def test_mix_keeps_the_columns_of_every_row(spark):
    rows = [(1, "a b c", "en", "s", 5, "x", 1, 1), (1, "a b c", "de", "s", 5, "x", 1, 1), (1, "a b c", None, "s", 5, "x", 1, 1)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.lang for r in out} == {"en", "de", None}


def test_mix_takes_documents_whole(spark):
    rnd = random.Random(6)
    rows = [(i, "  ".join(f"w{i}_{k}" for k in range(rnd.randint(1, 90))), f"s{i % 7}") for i in range(60)]
    rows += [(100 + k, f"one\t{k} " * (50 + 400 * k), f"lone{k}") for k in range(4)]
    out = mixing.mix(frame(spark, rows)).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in out} <= {(i, t, len(t)) for i, t, _ in rows}
    targets = {r.source: r.target for r in mixing.placed(frame(spark, rows))[0].collect()}
    for source, target in targets.items():
        taken = sum(len(r.text.split()) for r in out if r.source == source)
        assert target - 1 < taken < target + max(len(t.split()) for _, t, s in rows if s == source)


def removed(rows, window):
    """Kept words per row, by brute force."""
    first = {}
    split = {k: (t or "").split() for k, (_, t, _) in enumerate(rows)}
    for k, (i, _, _) in enumerate(rows):
        for s in range(len(split[k]) - window + 1):
            w = tuple(split[k][s : s + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for k, (i, _, _) in enumerate(rows):
        gone = set()
        for s in range(len(split[k]) - window + 1):
            if first[tuple(split[k][s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = [w for n, w in enumerate(split[k]) if n not in gone]
        out.append((i, len(split[k]), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot,batches", [(2_000, 1), (2_000, 4), (1, 3)])
def test_substrings_are_brute_force(spark, hot, batches):
    rnd = random.Random(hot + batches)
    passage = [f"p{k}" for k in range(70)]
    rows = []
    for i in range(40):
        own = [f"d{rnd.randint(0, 400)}" for _ in range(rnd.randint(0, 150))]
        if i % 3 == 0:
            at = rnd.randint(0, len(own))
            own[at:at] = passage[rnd.randint(0, 15) :]
        if i % 10 == 9:
            own += ["same"] * 130
        rows.append((i * 3, " ".join(own), "s"))
    rows += [(200, rows[9][1], "s"), (1, rows[9][1].replace(" ", "\n"), "s"), (300, None, "s"), (301, "", "s"), (302, "é " * 60, "s"), (303, "é " * 61, "s")]
    got = substrings.without_repeats(frame(spark, rows), batches, hot).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == removed(rows, 50)


def test_substrings_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(80))
    got = substrings.without_repeats(frame(spark, [(4, text, "s"), (4, text, "s"), (None, text, "s"), (9, "x " + text, "s")])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("4", 0), ("4", 0), ("9", 80), ("None", 80)]
    assert substrings.without_repeats(frame(spark, [(1, "a", "s")]).limit(0)).collect() == []


def test_windows_agree_with_their_words():
    words = [f"w{k % 37}".encode() for k in range(200)]
    anchor, whole = substrings.windows(words)
    assert len(anchor) == 151
    seen = {}
    for s in range(151):
        assert seen.setdefault(tuple(words[s : s + 50]), (anchor[s], whole[s])) == (anchor[s], whole[s])
    assert len(set(whole.tolist())) == 37


def test_words_that_collide_in_one_hash_are_told_apart(monkeypatch):
    """With the anchors' hash useless, all windows have one anchor and the other hash still tells them apart; long
    words and a full table give the hashes that short words and an empty one give."""
    words = [(f"w{k}" * (1 + 60 * (k % 2))).encode() for k in range(120)]
    plain = substrings.windows(words)
    monkeypatch.setattr(substrings, "_CACHE", 40)
    fresh = substrings._Hashes()
    monkeypatch.setattr(substrings, "_hashes", lambda: fresh)
    assert all((a == b).all() for a, b in zip(substrings.windows(words), plain, strict=True))

    class Blind(substrings._Hashes):
        def of(self, words):
            out = super().of(words)
            out[:, 0] = 7
            return out

    monkeypatch.setattr(substrings, "_CACHE", 1000)
    blind = Blind()
    monkeypatch.setattr(substrings, "_hashes", lambda: blind)
    anchor, whole = substrings.windows(words)
    assert len(set(anchor.tolist())) == 1 and len(set(whole.tolist())) == 71


def test_bpe_is_tiktoken():
    import public_tokenizers as P
    import tiktoken

    code = byte_bpe.encoder(*byte_bpe.default_vocabulary())
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=code.ranks, special_tokens={})
    rnd = random.Random(4)
    parts = ["a", "b", "é", "ñ", " ", "  ", "\n", "1", "²", "你", "😀", "th", "ing", "́", "'s", "\x0b", "aaaa", "<|endoftext|>"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 50))) for _ in range(500)] + ["ab" * 20_000, "a" * 5_000]
    for text in texts:
        ids = np.frombuffer(code.encode(text), "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert code.decode(ids) == text.encode()


def test_bpe_rows(spark):
    raw, pattern = byte_bpe.default_vocabulary()
    rows = [(1, "Hello, wörld", "s"), (2, None, "s"), (3, "", "s"), (None, "x" * 3000, "s"), (1, "Hello, wörld", "s")]
    got = byte_bpe.round_trip(frame(spark, rows), raw, pattern).collect()
    assert len(got) == 5
    for r in got:
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_tokens == 0) == (text == "")
    assert byte_bpe.round_trip(frame(spark, rows).limit(0), raw, pattern).collect() == []


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="nav-open">
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">Cookies!</div>
<article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>three<br>four
<p>Five&nbsp;six &lt;tag&gt; <script>var x = "</p>";</script>seven<div class="ad">Buy</div>
<ul><li>x<li>y</ul><form><label>L</label></form><section id="comments"><p>hi</p></section></article>
<aside>Side</aside><footer>Foot</footer></body></html>"""


def test_html_main_text():
    blocks, _ = html_extract.parse(PAGE)
    assert html_extract.main_text(blocks) == "Title & more\nOne twothree four\nFive six <tag> seven\nx\ny"


@pytest.mark.parametrize("html,text", [(None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<div>a<", "a<"), ("<script>x", ""), ("<!-- c --><p>a</p></div>b", "a\nb"), ("<p>&am", "&am")])
def test_html_odd_pages(html, text):
    assert html_extract.main_text(html_extract.parse(html)[0]) == text


def test_names_inside_an_article():
    page = """<article><div class="related-work"><p>Earlier work</p></div><div id="share"><p>Share prices fell</p></div>
<p class="social security">Pensions</p><menu><li>Soup</menu><h2 id="notice-1">On notice</h2><section class="social-policy">Policy</section>
<math>x+1</math><div class="ad">Buy</div><div class="comments"><p>First!</p></div></article>"""
    expected = "Earlier work\nShare prices fell\nPensions\nSoup\nOn notice\nPolicy\nx+1"
    assert html_extract.main_text(html_extract.parse(page)[0]) == expected


def test_a_teaser_card_is_not_the_page():
    page = "<article><p>See also</p></article><div class=story><p>" + "A long story. " * 20 + "</p></div>"
    assert html_extract.main_text(html_extract.parse(page)[0]) == "See also\n" + ("A long story. " * 20).strip()


def test_style_tree_is_brute_force(spark):
    """Importance by its definition, page by page, on small hosts; what three pages repeat goes, stories stay."""
    import math
    from collections import Counter, defaultdict

    rnd = random.Random(9)
    rows = []
    for h in range(3):
        for k in range(3 + 4 * h):
            extra = "<ul><li>x</ul>" if rnd.random() < 0.4 else ""
            share = '<div class="share"><p>Tell your friends</p></div>'
            rows.append((len(rows), f"http://h{h}/{k}", f"<div class=top>Menu of h{h}</div>{extra}<article><p>Story {h} {k}</p>{share}</article>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {(r.host, r.path): (r.pages, r.importance) for r in html_extract.style_tree(pages).collect()}
    shown, styles, parents = defaultdict(Counter), defaultdict(Counter), {}
    on = defaultdict(set)
    for k, url, html in rows:
        blocks, arrangements = html_extract.parse(html)
        name = url.split("/")[2]
        for path, parent, text in {(b.path, b.parent, b.text) for b in blocks}:
            shown[name, path][text] += 1
            on[name, path].add(k)
            parents[name, path] = parent
        for path, style in set(arrangements):
            styles[name, path][style] += 1
    assert set(got) == set(shown)
    for key, texts in shown.items():
        m = len(on[key])
        content = 1 - sum(math.log(c) for c in texts.values()) / len(texts) / math.log(m) if m > 1 else 1.0
        found = styles[key[0], parents[key]]
        total = sum(found.values())
        entropy = 0.0
        if found:
            entropy = -sum(c / total * math.log(c / total) for c in found.values()) / math.log(total) if total > 1 else 1.0
        weight = 0.9 ** len(found)
        assert got[key][0] == m
        assert abs(got[key][1] - ((1 - weight) * entropy + weight * content)) < 1e-9
    texts = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    for k, url, _ in rows:
        assert texts[k] == f"Story {url[8]} {url[10:]}"


def test_site_style_tree_removes_what_a_host_repeats(spark):
    rows = [(k, f"https://h.example/{k}", f"<div class=top>Welcome to us</div><div class=body>Story {k} of many</div>") for k in range(20)]
    rows += [(100 + k, "https://other.example/", "<div class=top>Welcome to us</div>") for k in range(20)] + [(200, None, None), (200, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "1 AS removed", "'t' AS text")
    got = html_extract.extract(pages).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[3] == "Story 3 of many"
    # copies of one page say nothing about a template
    assert by_id[103] == "Welcome to us"
    assert by_id[200] == ""
    assert html_extract.extract(pages.limit(0)).collect() == []


def test_index_is_reopened_with_its_runs(spark):
    """Batches added in two sessions give the anchors that one index gives; runs outside of the manifest are ignored,
    and a batch meets the runs without a shuffle of them."""
    schema = "anchor bigint, place bigint, row_key bigint"
    batches = [[(k, k * 10 + b, 0) for k in range(b, 40, b + 2)] + [(100 + b, 7 + b, 0), (100 + b, 8 + b, 0)] for b in range(5)]
    frames = [spark.createDataFrame(rows, schema) for rows in batches]
    one = substrings.Index(spark, buckets=3)
    want = [sorted(r.anchor for r in one.add(f).collect()) for f in frames]
    path = one.path + "-again"
    got = []
    for f in frames:
        index = substrings.Index(spark, path, buckets=3 if not got else 9)
        got.append(sorted(r.anchor for r in index.add(f).collect()))
        index._write(f.groupBy("anchor").count().withColumnRenamed("count", "n"))
        index.close()
    assert got == want
    last = substrings.Index(spark, path)
    assert last.buckets == 3 and last.version == 5 and len(last.runs) <= substrings.FAN
    seen, expected = set(), []
    for rows in batches:
        anchors = [a for a, _, _ in rows]
        expected.append(sorted({a for a in anchors if a in seen or anchors.count(a) > 1}))
        seen |= set(anchors)
    assert want == expected
    wanted = spark.createDataFrame([(a,) for a in (0, 2, 101)], "anchor bigint")
    assert last.entries(wanted).count() == sum(a in (0, 2, 101) for rows in batches for a, _, _ in rows)
    joined = last.run(last.runs[0]).select("anchor").hint("merge").join(one.run(one.runs[0]).select("anchor"), "anchor", "left_semi")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
