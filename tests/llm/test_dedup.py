"""Operators 3, 4 and 8 against brute force."""

import random
import re
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ebbflow.llm import decontaminate, fuzzy_dedup, substrings

draw = random.Random(3)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n):
    return " ".join(draw.choice(VOCABULARY) for _ in range(n))


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def brute_components(prints):
    label = {k: k for k in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**23 - 1), st.integers(0, 22), st.integers(0, 22))
def test_words_within_two_bits_share_a_key(word, a, b):
    other = word ^ (1 << a) ^ (1 << b)
    keys = fuzzy_dedup.fuzzy_keys(np.array([word, other]))
    assert set(keys[0][keys[0] >= 0]) & set(keys[1][keys[1] >= 0])
    assert (keys >= 0).sum(axis=1).max() <= 6


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.integers(0, 63), st.integers(0, 63))
def test_prints_within_two_bits_meet(value, a, b):
    rows, keys = fuzzy_dedup.join_keys(np.array([value, value ^ (1 << a) ^ (1 << b)], dtype=np.uint64))
    assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_links_in_small_and_crowded_buckets(spark):
    base = draw.getrandbits(64)
    prints = {base}
    for _ in range(60):  # a family whose members share whole segments
        value = draw.choice(sorted(prints))
        prints.add(value ^ (1 << draw.randrange(43, 64)) ^ (1 << draw.randrange(43, 64)))
    prints |= {draw.getrandbits(64) for _ in range(50)}
    ordered = sorted(prints)
    signed = [v - (1 << 64) if v >> 63 else v for v in ordered]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    edges = fuzzy_dedup.links(df).collect()
    assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 2 for r in edges)
    got = {r.node: r.component for r in fuzzy_dedup.components(fuzzy_dedup.links(df)).collect()}
    want = brute_components({v: v & (2**64 - 1) for v in signed})
    assert {k: got.get(k, k) for k in signed} == want


def test_chains_are_followed_to_the_end(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in fuzzy_dedup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}
    assert fuzzy_dedup.components(edges.limit(0)).count() == 0


def test_near_duplicates_on_odd_rows(spark, docs, none):
    rows = fuzzy_dedup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.fingerprint & (2**64 - 1) == brute_print(t) for r, t in ((r, None) for r in rows if r.doc_id in (3, 4, 5)))
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[2] == 1 and by_id[4] == by_id[5] == by_id[3] == 3 and by_id[None] is None
    kept = fuzzy_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [-3, 1, 3, 6, 7, 8, 9, None]
    assert fuzzy_dedup.near_duplicates(none).count() == 0 and fuzzy_dedup.one_of_each(none).count() == 0


def brute_leaks(docs, items):
    def words(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    found = {}
    for item, text in items:
        w = words(text)
        k = min(5, len(w))
        if not k:
            continue
        mine = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        n = sum(mine.values())
        for doc, body in docs:
            d = words(body)
            grams = [tuple(d[i : i + k]) for i in range(len(d) - k + 1)]
            for s in range(len(grams) - n + 1):
                both = sum((Counter(grams[s : s + n]) & mine).values())
                score = both / (2 * n - both)
                if score >= 0.8 and score > found.get((doc, item), (0, 0))[0]:
                    found[doc, item] = (score, s)
    return found


def test_leaks_equal_brute_force(spark, docs, none):
    items = [(i, prose(n)) for i, n in enumerate((40, 40, 70, 12, 9, 5))]
    items += [(6, "ha ha ha ha ha ha ha ha ha ha"), (7, "two words"), (8, ""), (9, None), (10, items[0][1])]
    bodies = [(0, prose(300)), (1, ""), (2, None)]
    for i, text in items[:8]:
        w = text.split()
        changed = " ".join([*w[:-1], "edited"])
        bodies.append((10 + i, prose(50) + " " + text.upper() + ". " + prose(30)))
        bodies.append((20 + i, prose(20) + "\n" + changed + " " + prose(400)))
        bodies.append((30 + i, text))
    bodies.append((50, " ".join(items[2][1].split()[:30]) + " " + prose(5) + " " + " ".join(items[2][1].split()[30:])))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(0))
    d = spark.createDataFrame(bodies, "doc_id long, text string").withColumn("value", F.lit("x"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontaminate.leaks(d, b).collect()}
    want = brute_leaks(bodies, items)
    assert want and set(got) == set(want)
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)
    kept = decontaminate.without_leaks(d, b)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in bodies} - {k for k, _ in want}
    assert kept.columns == d.columns
    assert decontaminate.leaks(none, b).count() == 0 and decontaminate.leaks(docs, b.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, b).count() == docs.count()


def test_chunks_join_to_the_text_and_survive_insertions():
    text = prose(2000) + " " + "x" * 500 + " éè " * 20
    start, size, words, parts = substrings.chunks(text)
    assert b"".join(parts).decode() == text and list(start[1:]) == list((start + size)[:-1])
    assert words.sum() >= 2000
    moved = substrings.chunks("some inserted words " + text)[3]
    assert len(set(parts) & set(moved)) >= 0.95 * len(set(parts))
    for odd in ("", " ", "a", "é" * 300, "\n\n"):
        assert b"".join(substrings.chunks(odd)[3]).decode() == odd


def test_long_passages_are_found_and_short_lines_left(spark, docs, none):
    passage, line = prose(70), prose(12)
    bodies = [(i, prose(80) + "\n" + line + "\n" + prose(60)) for i in range(20)]
    bodies += [(100 + i, prose(40) + "\n" + passage + "\n" + prose(40)) for i in range(12)]
    bodies += [(200, bodies[0][1]), (201, None), (202, ""), (None, passage)]
    df = spark.createDataFrame(bodies, "doc_id long, text string").withColumn("words", F.lit(1))
    spans = substrings.repeats(df).collect()
    assert {r.doc_id for r in spans} == {101 + i for i in range(11)} | {200}
    texts = dict(bodies)
    for r in spans:
        assert r.kept_doc_id < r.doc_id
        assert texts[r.doc_id][r.start : r.stop].strip() in texts[r.kept_doc_id]
    left = {r.doc_id: r.text for r in substrings.without_repeats(df, substrings.repeats(df)).collect()}
    assert left[5] == texts[5] and len(left[101]) < len(texts[101]) - 150 and left[202] == "" and left[201] is None
    assert substrings.repeats(none).count() == 0
    assert substrings.repeats(docs).filter("doc_id = 1").count() == 0
