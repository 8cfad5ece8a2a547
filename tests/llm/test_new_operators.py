"""Operators 11 to 13 against plain versions of what they compute."""

import re
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from cases import ROWS
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ebbflow.llm import alignment, fill_middle, online_packing, queries
from ebbflow.session import settled

SMALL = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ROWS + [
    (20, "a<P>b"),
    (21, " leading and trailing "),
    (22, "▁ stands for a space"),
    (23, "<|endoftext|> is <s> plain </s> text"),
    (24, "é ́x \U0001f600‍\U0001f600 中文 \x00\x01"),
]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("ids", F.lit("taken"))


# operator 11


class Plain:
    """Sum of squares by trying every level."""

    def __init__(self, capacity):
        self.capacity, self.counts = capacity, {}

    def place(self, size):
        best = None
        for level in [0, *sorted(h for h, n in self.counts.items() if n and h + size <= self.capacity)]:
            after = dict(self.counts)
            if level:
                after[level] -= 1
            if level + size < self.capacity:
                after[level + size] = after.get(level + size, 0) + 1
            cost = sum(n * n for n in after.values())
            if best is None or cost < best[0] or cost == best[0]:
                best = (cost, level, after) if best is None or (cost, -level) < (best[0], -best[1]) else best
        self.counts = best[2]
        return best[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=60))
def test_levels_are_those_of_least_squares(sizes):
    plain, packer = Plain(32), online_packing.Packer(32)
    for i, size in enumerate(sizes):
        assert packer.choose(size) == plain.place(size)
        list(packer.add(online_packing.Piece(i, 0, bytes(4 * size), size)))
        assert {h: n for h, n in plain.counts.items() if n} == {
            int(h): int(packer.levels[h]) for h in np.flatnonzero(packer.levels)
        }


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 8))
def test_every_id_lies_in_one_piece_and_nothing_is_padded(sizes, most_open):
    packer, done = online_packing.Packer(32, most_open), []
    for i, size in enumerate(sizes):
        ids = np.arange(size, dtype="<u4") + 1000 * i
        done += packer.add(online_packing.Piece(i, 0, ids.tobytes(), size))
        assert packer.n_open <= most_open
    done += packer.finish()
    lengths = [sum(p.length for p in s) for s in done]
    assert all(0 < n <= 32 and n & (n - 1) == 0 for n in lengths)
    assert sum(n < 32 for n in lengths) <= 5
    found = sorted((p.doc_id, p.start, p.ids) for s in done for p in s)
    for i, size in enumerate(sizes):
        whole = b"".join(ids for key, _, ids in found if key == i)
        assert np.frombuffer(whole, dtype="<u4").tolist() == list(range(1000 * i, 1000 * i + size))


def test_online_packing(spark):
    coder = online_packing.memo(WORD).tokenizer
    rows = online_packing.pack_online(odd(spark), WORD, 64).collect()
    want = sorted(
        zlib.crc32(np.array(coder.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes())
        for k, t in ODD if k != 2
    )
    whole = {}
    for r in sorted(rows, key=lambda r: r.start):
        assert r.length == len(r.ids) // 4 > 0
        whole.setdefault(r.doc_id, []).append(r)
    for key, pieces in whole.items():
        if key != 2:
            assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
            assert sum(p.length for p in pieces) == pieces[0].doc_tokens
    assert sorted(zlib.crc32(b"".join(p.ids for p in v)) for k, v in whole.items() if k != 2) == want
    assert sum(p.length for p in whole[2]) == 2 * whole[2][0].doc_tokens
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        assert [o for o, _ in sorted(spans)] == np.cumsum([0] + [n for _, n in sorted(spans)])[:-1].tolist()
        total = sum(n for _, n in spans)
        assert total <= 64 and total & (total - 1) == 0
    assert online_packing.pack_online(odd(spark).limit(0), WORD).count() == 0
    with pytest.raises(ValueError):
        online_packing.pack_online(odd(spark), WORD, 0)


# operator 12

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def middle(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \t\n\x0bé中\U0001f600 <>PSM", max_size=80), st.integers(1, 9))
def test_cuts_by_the_tree(text, block):
    blocks = fill_middle.Blocks(text.encode(), block)
    units = UNIT.findall(text)
    assert int(blocks.ends.sum()) == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert blocks.cut(k) == (len(head.encode()), len(head))


@given(st.lists(st.integers(0, 9), max_size=70))
def test_fenwick_nodes(counts):
    tree = fill_middle.fenwick(np.array(counts, dtype=np.int64))
    for i in range(1, len(counts) + 1):
        assert tree[i] == sum(counts[i - (i & -i) : i])


def test_fill_in_middle(spark):
    more = ODD + [(100 + i, t) for i, (_, t) in enumerate(ODD * 6)]
    docs = spark.createDataFrame(more, "doc_id long, text string").withColumn("form", F.lit("taken"))
    made = fill_middle.fill_in_middle(docs)
    rows = made.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(r)
    assert sorted([tuple(r[:6]) for r in rows], key=key) == sorted([(k, *middle(k, t)) for k, t in more], key=key)
    assert sorted(r.again for r in rows) == sorted(t or "" for _, t in more)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


# operator 13


def brute_alignment(texts):
    """Ids, groups and links of each text by the tokenizers themselves."""
    memo = alignment.pair_memo(A, B)
    out = []
    for text in texts:
        a = memo.a.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = memo.b.encode(text) if text else []
        want = (" " + text).encode() if text else b""
        pieces = [memo.b.id_to_piece(i) for i in b]
        joined = b"".join(
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces
        )
        if not text or memo.a.tokenizer.decode(a, skip_special_tokens=False).encode() != want or joined != want:
            out.append(([], [], [], []))
            continue
        ends_a = np.cumsum([len(memo.a_bytes[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(memo.b_bytes[i]) for i in b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        place_a, place_b = ({e: i for i, e in enumerate(ends)} for ends in (ends_a, ends_b))
        links = [(a[place_a[e]], b[place_b[e]]) for e in both]
        groups, i, j = [], 0, 0
        for e in both:
            one, other = a[i : place_a[e] + 1], b[j : place_b[e] + 1]
            groups.append(f"{','.join(map(str, one))}|{','.join(map(str, other))}")
            i, j = place_a[e] + 1, place_b[e] + 1
        out.append((a, b, groups, links))
    return out


def test_new_words_are_checked_many_at_a_time(monkeypatch):
    words = [f"{a}{b}{c}" for a in "abcdé" for b in "stuvw" for c in ("ened", "ly.", "***")]
    memo, single = alignment.PairMemo(A, B), []
    same = memo._same
    monkeypatch.setattr(memo, "_same", lambda ids, text: single.append(text) or same(ids, text))
    expected = memo.whole(words)
    single.clear()
    memo._learn(set(words))
    assert not single and [memo.known[w] for w in words] == expected
    memo._learn({"plain", "e\u0301a", "½", "▁x", "ﬁn"})  # some that B does not give back
    for w in ("plain", "e\u0301a", "½", "▁x", "ﬁn"):
        assert (memo.known[w] or (b"", b"")) == memo.whole([w])[0]


def brute_scores(found):
    counts, most = {}, {}
    for *_, links in found:
        for pair in links:
            counts[pair] = counts.get(pair, 0) + 1
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (
            len(a), len(b), len(groups), len(links),
            sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
            sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for a, b, groups, links in found
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 40, 0])
def test_alignment(spark, frequent):
    small = [t for _, t in ODD if t is None or len(t) < 200] + ["the cat and the dog " * 3, "the cat"] * 4
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(small)], "doc_id long, text string")
    aligned = settled(alignment.align(docs.withColumn("row", F.lit("taken")).repartition(3), A, B, digest=True))
    scored = alignment.scored(aligned, settled(alignment.pair_counts(aligned)), frequent)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in scored.collect()}
    assert got == dict(enumerate(brute_scores(brute_alignment([t or "" for t in small]))))
    nothing = settled(alignment.align(docs.limit(0), A, B))
    assert alignment.scored(nothing, settled(alignment.pair_counts(nothing)), frequent).count() == 0


def test_alignment_query_and_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    want = dict(zip(texts, brute_scores(brute_alignment(texts.values()))))
    got = queries.QUERIES["op13_token_alignment"](spark, SMALL).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    shown = alignment.align(odd(spark), A, B).collect()
    found = dict(zip([k for k, _ in ODD], brute_alignment([t or "" for _, t in ODD])))
    assert len(shown) == len(ODD)
    for r in shown:
        assert r.groups == ";".join(found[r.doc_id][2])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=40), max_size=6), st.integers(1, 9))
def test_lockstep(docs, lane):
    """A document is a list of bytes, each with whether a token of A and of B ends there."""
    docs = [d[:-1] + [(True, True)] for d in docs if d]
    flat = [x for d in docs for x in d]
    a_ends = np.array([i + 1 for i, x in enumerate(flat) if x[0]], dtype=np.int64)
    b_ends = np.array([i + 1 for i, x in enumerate(flat) if x[1]], dtype=np.int64)
    first = np.cumsum([0] + [sum(x[0] for x in d) for d in docs])
    first_a = alignment.lanes(a_ends, b_ends, first, lane)
    begins = np.concatenate([[0], a_ends])[first_a]
    link_a, link_b = alignment.lockstep(a_ends, b_ends, first_a, np.searchsorted(b_ends, begins, side="right"))
    assert a_ends[link_a].tolist() == b_ends[link_b].tolist() == [i + 1 for i, x in enumerate(flat) if all(x)]
