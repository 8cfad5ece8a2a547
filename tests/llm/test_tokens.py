"""Operators 1 and 6: coding round trips, files, packing."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from cases import ROWS
from hypothesis import given, settings, strategies as st

from ebbflow.llm import packing, token_ids
from ebbflow.llm.tokens import WordMemo, default_tokenizer, slices
from ebbflow.session import shared_dir

MEMO = WordMemo(default_tokenizer(), limit=50)


def plain(text):
    return MEMO.tokenizer.encode(text or "", add_special_tokens=False).ids


def as_ids(data):
    return np.frombuffer(data, dtype="<u4").tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.\n\té's1 \u0085-<|endoftext|>", max_size=40), max_size=5))
def test_memo_gives_the_tokenizers_ids(texts):
    assert [as_ids(x) for x in MEMO.ids(texts)] == [plain(t) for t in texts]


WORD_ENDS = WordMemo(public_tokenizers.path("word_bpe_49k.json"), limit=50)
SPECIALS = WordMemo(default_tokenizer(), limit=50, plain_specials=True)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.\n\n\r\t\x1cÉİſ́가Σ's1 \u0085-", max_size=40), max_size=5), st.booleans())
def test_memo_of_other_tokenizers(texts, marked):
    texts = [t + " <|endoftext|> a<|endoftext|>b" if marked else t for t in texts]
    for memo in (WORD_ENDS, SPECIALS):
        assert memo.by_words
        assert [as_ids(x) for x in memo.ids(texts)] == [
            memo.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
        ]


def test_new_words_are_coded_together():
    words = [f"{a}{b}ened" for a in "abcdefgh" for b in "stuvwxyz"]
    for memo in (MEMO, WORD_ENDS, SPECIALS):
        got = memo._together(words)
        assert got == memo.encode([" " + w if memo.spaced else w for w in words])
        assert memo._together(["a b"]) is None
    lines = ["\n" + w for w in words]
    assert MEMO._apart("".join(lines), lines, MEMO.feeds) == MEMO.encode(lines)


def test_words_of_latin_letters_are_coded_without_the_pattern():
    words = [f"{a}{b}ened" for a in "abcdéfgñ" for b in "stuvwßyZ"]
    assert MEMO._spelled(words) == MEMO.encode([" " + w for w in words])
    for other in ("don't", "a1", "словами", "x.", "ŋa"):
        assert MEMO._spelled(["plain", other]) is None
        assert MEMO.coded_words(["plain", other]) == MEMO.encode([" plain", " " + other])


def test_slices_cover_a_batch():
    texts = ["a" * n for n in (5, 0, 30, 1, 1, 9)] + [None, "bb"]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(slices(batch, limit=10))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert len(parts) > 2 and all(p.num_rows for p in parts) and not list(slices(batch.slice(0, 0)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(ids):
    values = np.array(ids, dtype=np.uint64)
    words, starts, escapes = token_ids.encode(values)
    assert (token_ids.decode(words, starts, escapes, len(ids)) == values).all()


def test_zeros_are_short():
    words, _, escapes = token_ids.encode(np.zeros(2560, dtype=np.uint64))
    assert len(words) == 30 and not len(escapes)


def test_files_hold_every_document_in_order(spark, docs, none):
    path = shared_dir(spark)
    token_ids.write_token_ids(docs, path, end_id=0)
    got = sorted(token_ids.read_token_ids(spark, path).collect(), key=lambda r: r.start)
    want = sorted(((k is not None, k or 0), plain(t) + [0]) for k, t in ROWS)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [k for k, _ in want]
    assert sorted(map(lambda r: (r.doc_id is not None, r.doc_id or 0, as_ids(r.ids)), got)) == sorted((*k, i) for k, i in want)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    path = shared_dir(spark)
    token_ids.write_token_ids(none, path)
    assert token_ids.read_token_ids(spark, path).count() == 0


def test_pieces_are_whole_and_sequences_gapless(spark, docs, none):
    rows = packing.pack(docs, capacity=64).collect()
    want = sorted(zlib.crc32(np.array(plain(t) + [2], dtype="<u4").tobytes()) for _, t in ROWS)
    parts = {}
    for r in rows:
        assert 1 <= r.length <= 64 and (r.piece == 0 or r.length == 64)
        parts.setdefault((r.doc_id, r.piece == 0 and r.start or 0), []).append(r)
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.piece):
        by_doc.setdefault(r.doc_id, []).append(r)
    single = [zlib.crc32(b"".join(r.ids for r in v)) for k, v in by_doc.items() if k != 2]
    twice = [zlib.crc32(r.ids) for r in by_doc[2]]
    assert sorted(single + twice) == want
    taken = {}
    for r in rows:
        taken.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in taken.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    whole = {r.sequence_id: r for r in packing.sequences(packing.pack(docs, capacity=64)).collect()}
    assert sum(r.n_tokens for r in whole.values()) == sum(r.length for r in rows)
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole.values())
    assert packing.pack(none).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 40)))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.plan(histogram, 32)
    used = {}
    for pattern, count in plan:
        assert count > 0 and sum(pattern) <= 32
        for length in pattern:
            used[length] = used.get(length, 0) + count
    assert used == {k: v for k, v in histogram.items() if v}


def test_exact_complements_fill_every_gap():
    plan = packing.plan({20: 9, 12: 4, 6: 8, 5: 1, 4: 1, 3: 1}, 32)  # a single, a pair, a triple
    assert sum(n for _, n in plan) == 9 and all(sum(p) == 32 for p, _ in plan)
