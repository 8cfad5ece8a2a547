"""Cross-tokenizer alignment (operator 13): which tokens of A and B stand for the same bytes.

Both tokenizers cut the same bytes, a space and the text. Where a token of A and one of B end at
the same byte, the two are linked, and such places cut both sequences into groups.

The merge runs in lockstep: one NumPy vector of pointers into A and one into B, an element for
each document of a batch. In a step every document compares the two ends it points at and
advances the nearer one, or both when they agree, which gives a link and a cut. Documents that
are finished leave the vectors. A long document enters as several lanes, each beginning after an
end that both tokenizers have, so that the steps are few and the vectors wide.

Links are counted over the corpus in a second pass over the stored links. The third pass looks
the counts up: those of frequent pairs from a table of bounded size that every task holds, those
of the others, if there are any, by a join.
"""

from __future__ import annotations

from array import array
from hashlib import sha256
from unicodedata import combining

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbflow.llm.tokens import GROUP, WordMemo, byte_alphabet, chunks, slices
from ebbflow.session import settled

WORDS = 300_000  # words kept per Python worker, about 90 MB
LANE = 256  # tokens of A in a lane, or a few more
FREQUENT = 1_000_000  # pairs of ids whose counts every task holds, 17 MB
HELD = 1 << 20  # links that a task counts at a time
TEXT_BYTES = 1 << 20  # text that is aligned at a time: its tokens take about 60 MB
LINK_BYTES = 2 << 20  # links of A that are counted or looked up at a time
SPACE = "▁"
ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, links_a binary, links_b binary, groups string"
)

_memos: dict[tuple[str, str], "PairMemo"] = {}


def pair_memo(byte_path: str, piece_path: str) -> "PairMemo":
    """The worker's memo of these two tokenizer files."""
    if (byte_path, piece_path) not in _memos:
        _memos[byte_path, piece_path] = PairMemo(byte_path, piece_path)
    return _memos[byte_path, piece_path]


class PairMemo:
    """Ids of both tokenizers, with a bounded memory of the words they were met in.

    Neither tokenizer has a token that reaches over a single space between visible characters, so
    words are coded one by one; a text with other spacing is coded whole.
    """

    def __init__(self, byte_path: str, piece_path: str, limit: int = WORDS):
        import sentencepiece

        self.a = WordMemo(byte_path, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        size = self.a.tokenizer.get_vocab_size()
        alphabet = byte_alphabet()
        names = [self.a.tokenizer.id_to_token(i) or "" for i in range(size)]
        special = set(map(str, self.a.tokenizer.get_added_tokens_decoder().values()))
        self.a_bytes = [
            n.encode() if n in special else bytes(alphabet[c] for c in n if c in alphabet) for n in names
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.by_words = self.a.spaced and all(SPACE not in p.lstrip(SPACE) for p in pieces)
        self.limit = limit
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _same(self, ids: tuple[bytes, bytes], text: str) -> bool:
        want = (" " + text).encode("utf-8", "surrogatepass")
        return all(
            b"".join([table[i] for i in np.frombuffer(x, dtype="<u4").tolist()]) == want
            for x, table in zip(ids, (self.a_bytes, self.b_bytes))
        )

    def _all_same(self, coded: list[list[bytes]], words: list[str]) -> bool:
        """Do both tokenizers give back every word, a space before each?

        Told for all words at once: the bytes of all are those of the text they make, which has
        a space for each word, and each word's bytes begin with a space.
        """
        want = (" " + " ".join(words)).encode("utf-8", "surrogatepass")
        for parts, table in zip(coded, (self.a_bytes, self.b_bytes)):
            ids = np.frombuffer(b"".join(parts), dtype="<u4").tolist()
            if b"".join([table[i] for i in ids]) != want:
                return False
            if not all(x and table[int.from_bytes(x[:4], "little")][:1] == b" " for x in parts):
                return False
        return True

    def whole(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of whole texts; none where the bytes of either are not those of the text."""
        a = self.a.encode([" " + t for t in texts])
        b = self._pieces(texts)
        return [ids if self._same(ids, t) else (b"", b"") for ids, t in zip(zip(a, b), texts)]

    def _pieces(self, texts: list[str]) -> list[bytes]:
        return [array("I", x).tobytes() for x in self.b.encode(texts, num_threads=1)]

    def _learn(self, words: set[str]) -> None:
        """Ids of new words; None where the spaces beside the word are no safe cuts."""
        letters, marked, others = [], [], []
        for w in words:
            if w.isascii() and w.isalpha():
                letters.append(w)
            elif w and not w[0].isspace() and not w[-1].isspace() and not combining(w[0]):
                (marked if w.isascii() else others).append(w)
            else:
                self.known[w] = None
        for safe in letters, marked, others:
            for some in chunks(safe):
                a, b = self.a.coded_words(some), self._pieces(some)
                if self._all_same([a, b], some):
                    self.known.update(zip(some, zip(a, b)))
                    continue
                for w, ids in zip(some, zip(a, b)):
                    self.known[w] = ids if self._same(ids, w) else None

    def ids(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """A's and B's ids of each text as little-endian unsigned 32-bit integers; none for a
        null or an empty text and where the bytes differ."""
        out: list[tuple[bytes, bytes]] = []
        for at in range(0, len(texts), GROUP):
            out += self._group([t or "" for t in texts[at : at + GROUP]])
        return out

    def _group(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        out: list[tuple[bytes, bytes]] = [(b"", b"")] * len(texts)
        if len(self.known) > self.limit:
            self.known.clear()
        parts = [t.split(" ") if t and self.by_words else [] for t in texts]
        get = self.known.get
        new = set().union(*parts).difference(self.known)
        if new:
            self._learn(new)
        left = []
        for i, p in enumerate(parts):
            found = list(map(get, p))
            if found and None not in found:
                a, b = zip(*found)
                out[i] = b"".join(a), b"".join(b)
            elif texts[i]:
                left.append(i)
        for i, ids in zip(left, self.whole([texts[i] for i in left]) if left else ()):
            out[i] = ids
        return out


def lanes(a_ends: np.ndarray, b_ends: np.ndarray, docs: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Numbers of A's tokens that begin a lane, ascending, and the number of all.

    Ends ascend over the batch. docs: the first token of each document, and the number of all.
    A lane begins a document, or follows the first common end at `lane` tokens or more from the
    beginning of its document, twice as many, and so on.
    """
    sizes = np.diff(docs)
    extra = np.maximum(sizes - 1, 0) // lane
    owner = np.repeat(np.arange(len(sizes)), extra)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    at = docs[:-1][owner] + nth * lane - 1
    open_ = np.arange(len(at))
    while len(open_):  # a document's last end is common, so this stops
        ends = a_ends[at[open_]]
        common = b_ends[np.searchsorted(b_ends, ends)] == ends
        open_ = open_[~common]
        at[open_] += 1
    return np.unique(np.concatenate([docs, at + 1]))


def lockstep(
    a_ends: np.ndarray, b_ends: np.ndarray, first_a: np.ndarray, first_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of A and of B that end together, in order.

    first_a, first_b: the first token of each lane, and the number of all tokens. A lane's last
    two tokens end together.
    """
    linked_a, linked_b = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    used = first_a[1:] > first_a[:-1]
    a, b, stop = first_a[:-1][used].copy(), first_b[:-1][used].copy(), first_a[1:][used]
    while len(a):
        ends_a, ends_b = a_ends[a], b_ends[b]
        same = ends_a == ends_b
        linked_a[a[same]] = True
        linked_b[b[same]] = True
        a += ends_a <= ends_b
        b += ends_b <= ends_a
        alive = a < stop
        if not alive.all():
            a, b, stop = a[alive], b[alive], stop[alive]
    return np.flatnonzero(linked_a), np.flatnonzero(linked_b)


def numerals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to size - 1 as bytes with room for a mark, and which are used."""
    width = len(str(max(size - 1, 0)))
    text = np.array([str(i) for i in range(size)], dtype=f"S{width}")
    digits = np.zeros((size, width + 1), dtype=np.uint8)
    digits[:, :width] = text.view(np.uint8).reshape(size, width)
    kept = digits > 0
    kept[:, width] = True
    return digits, kept


def rendered(
    a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, shapes
) -> tuple[np.ndarray, np.ndarray]:
    """The groups of a batch as bytes, `a1,a2|b1;a3|b2,b3;`, and the byte at which the first
    token of each group begins, with the number of all."""
    sizes_a, sizes_b = np.diff(link_a, prepend=-1), np.diff(link_b, prepend=-1)
    groups = np.arange(len(link_a))
    # a token's place among all: after the other tokenizer's tokens that stand before it
    at_a = np.arange(len(a)) + np.repeat((np.cumsum(sizes_b) - sizes_b)[groups], sizes_a)
    at_b = np.arange(len(b)) + np.repeat(np.cumsum(sizes_a)[groups], sizes_b)
    digits, kept = shapes
    n, width = len(a) + len(b), digits.shape[1]
    ids = np.empty(n, dtype=np.int64)
    ids[at_a], ids[at_b] = a, b
    chars = digits[ids]
    chars[:, width - 1] = ord(",")
    chars[at_a[link_a], width - 1] = ord("|")
    chars[at_b[link_b], width - 1] = ord(";")
    used = kept[ids]
    begins = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    firsts = np.concatenate([at_a[link_a - sizes_a + 1], [n]]).astype(np.int64)
    return chars[used], begins[firsts]


class Aligner:
    """Alignment of batches of texts by two tokenizers."""

    def __init__(self, byte_path: str, piece_path: str, lane: int = LANE):
        self.memo = pair_memo(byte_path, piece_path)
        self.lane = lane
        self.size_a = np.array([len(x) for x in self.memo.a_bytes], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.memo.b_bytes], dtype=np.int64)
        self.shapes = numerals(max(len(self.size_a), len(self.size_b)))

    def align(self, texts: list[str | None], digest: bool):
        """Columns of ALIGNED after doc_id, as lists."""
        coded = self.memo.ids(texts)
        n_a = np.array([len(x) // 4 for x, _ in coded], dtype=np.int64)
        n_b = np.array([len(x) // 4 for _, x in coded], dtype=np.int64)
        a = np.frombuffer(b"".join([x for x, _ in coded]), dtype="<u4")
        b = np.frombuffer(b"".join([x for _, x in coded]), dtype="<u4")
        a_ends, b_ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        doc_a = np.concatenate([[0], np.cumsum(n_a)])
        first_a = lanes(a_ends, b_ends, doc_a, self.lane)
        # the common end before a lane says where B's part of it begins
        begins = np.concatenate([[0], a_ends])[first_a]
        first_b = np.searchsorted(b_ends, begins, side="right")
        link_a, link_b = lockstep(a_ends, b_ends, first_a, first_b)
        text, at = rendered(a, b, link_a, link_b, self.shapes)
        text = text.tobytes()
        cuts = np.searchsorted(link_a, doc_a).tolist()  # the first group of each document
        ids_a, ids_b = a[link_a].astype("<u4").tobytes(), b[link_b].astype("<u4").tobytes()
        links_a, links_b, groups = [], [], []
        for first, last in zip(cuts, cuts[1:]):
            links_a.append(ids_a[4 * first : 4 * last])
            links_b.append(ids_b[4 * first : 4 * last])
            one = text[at[first] : at[last] - 1] if last > first else b""
            groups.append(sha256(one).hexdigest() if digest and one else one.decode())
        return n_a.tolist(), n_b.tolist(), np.diff(cuts).tolist(), links_a, links_b, groups


def align(docs: DataFrame, byte_path: str, piece_path: str, digest: bool = False) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, links_a, links_b, groups: one row for each row of `docs`.

    row is the row's own number; links_a and links_b are the ids of the linked tokens of A and of
    B in order (little-endian u32 bytes); groups reads `a1,a2|b1;a3|b2,b3`, or is its SHA-256 in
    hexadecimal digits. A text that is null or empty, or that one of the tokenizers does not give
    back byte by byte, has no tokens: zeros and empty columns. Names of special tokens are plain
    text. Only doc_id and text are read; repeated rows are aligned each; an empty table gives no
    rows. One pass over whole texts, about a megabyte at a time, no shuffle.
    """

    def work(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        aligner = Aligner(byte_path, piece_path)
        kinds = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.string()]
        names = [f.split()[0] for f in ALIGNED.split(", ")]
        for batch in (part for whole in batches for part in slices(whole, limit=TEXT_BYTES)):
            columns = aligner.align(batch.column(1).to_pylist(), digest)
            row = pa.array(np.arange(number, number + batch.num_rows))
            number += batch.num_rows
            rest = [pa.array(c, type=k) for c, k in zip(columns, kinds)]
            yield pa.record_batch([row, batch.column(0), *rest], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, ALIGNED)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a column of u32 bytes, as they lie, and how many each row has."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
    size = (ends[-1] - ends[0]) // 4
    return np.frombuffer(data, dtype="<u4", count=size, offset=ends[0]), np.diff(ends) // 4


def _keys(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    a, sizes = _flat(batch.column(first))
    return (a.astype(np.int64) << 32) | _flat(batch.column(first + 1))[0], sizes


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, links (over the corpus) and best (no A id has more links with this b) of each pair
    of ids that is linked somewhere. Tasks count before they shuffle."""

    def work(batches):
        held, size = [], 0

        def summed():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch(
                [pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts.astype(np.int64))],
                names=["a", "b", "links"],
            )

        for batch in (part for whole in batches for part in slices(whole, 0, LINK_BYTES)):
            keys, _ = _keys(batch, 0)
            held.append(keys)
            size += len(keys)
            if size >= HELD:
                yield summed()
                held, size = [], 0
        if size:
            yield summed()

    partial = aligned.select("links_a", "links_b").mapInArrow(work, "a long, b long, links long")
    counts = settled(partial.groupBy("a", "b").agg(F.sum("links").alias("links")))
    most = counts.groupBy("b").agg(F.max("links").alias("most"))  # a row for each id of B
    return counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def scored(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """`aligned` with n_links, n_best (links whose pair is its B id's best) and count_sum (the
    pairs' counts over the links). Both tables must be stored ones.

    The counts of the most frequent pairs, at most `frequent`, go to every task. The other pairs
    are rare, so their join by pair has no busy key; each row's rare pairs are combined first.
    """
    octave = F.floor(F.log2("links")).cast("int")
    sizes = {r.octave: r.n for r in counts.groupBy(octave.alias("octave")).agg(F.count("*").alias("n")).collect()}
    least, total = 64, 0  # at most 64 octaves; take whole ones from the top
    for o in sorted(sizes, reverse=True):
        if total + sizes[o] > frequent:
            break
        least, total = o, total + sizes[o]
    held = counts.where(octave >= least).select("a", "b", "links", "best").toArrow()
    keys = (held["a"].to_numpy() << 32) | held["b"].to_numpy()
    order = np.argsort(keys)
    table = aligned.sparkSession.sparkContext.broadcast(
        (keys[order], held["links"].to_numpy()[order], held["best"].to_numpy()[order])
    )
    complete = total == sum(sizes.values())

    def looked_up(batch):
        known, links, best = table.value
        pairs, n = _keys(batch, 1)
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        return pairs, n, at, found

    def sums(batches):
        _, links, best = table.value
        for batch in (part for whole in batches for part in slices(whole, limit=LINK_BYTES)):
            pairs, n, at, found = looked_up(batch)
            owner = np.repeat(np.arange(len(n)), n)
            counted = np.zeros(len(pairs), np.int64)
            counted[found] = links[at[found]]
            ends = np.cumsum(n)
            running = np.concatenate([[0], np.cumsum(counted)])
            total_best = np.bincount(owner[found], weights=best[at[found]], minlength=len(n))
            columns = [n, total_best.astype(np.int64), running[ends] - running[ends - n]]
            yield pa.record_batch(
                [batch.column(0), *map(pa.array, columns), *[batch.column(i) for i in range(3, 8)]],
                names=["row", "n_links", "n_best", "count_sum", "doc_id", "n_a", "n_b", "n_groups", "groups"],
            )

    columns = aligned.select("row", "links_a", "links_b", "doc_id", "n_a", "n_b", "n_groups", "groups")
    first = columns.mapInArrow(
        sums,
        "row long, n_links long, n_best long, count_sum long, doc_id long, n_a long, n_b long, "
        "n_groups long, groups string",
    )
    if complete:
        return first

    def others(batches):
        for batch in (part for whole in batches for part in slices(whole, limit=LINK_BYTES)):
            pairs, n, _, found = looked_up(batch)
            owner = np.repeat(np.arange(len(n)), n)[~found]
            both, times = np.unique(np.stack([owner, pairs[~found]], axis=1), axis=0, return_counts=True)
            row = batch.column(0).to_numpy()[both[:, 0]]
            yield pa.record_batch(
                [pa.array(x) for x in (row, both[:, 1] >> 32, both[:, 1] & 0xFFFFFFFF, times.astype(np.int64))],
                names=["row", "a", "b", "times"],
            )

    rare = columns.select("row", "links_a", "links_b").mapInArrow(others, "row long, a long, b long, times long")
    more = (
        rare.join(counts.where(octave < least), ["a", "b"])
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("links")).alias("more_sum"),
        )
    )
    return first.join(more, "row", "left").select(
        "row",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "doc_id", "n_a", "n_b", "n_groups", "groups",
    )
