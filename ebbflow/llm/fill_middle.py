"""Fill-in-the-middle transformation (operator 12).

A text is cut twice between units and its parts are put in another order behind marks, so that a
model learns to write the middle from what stands around it. A unit is a run of visible
characters with the white space before it; white space at the end of a text is a unit of its own.

Each text is laid out in blocks of fixed size. Two Fenwick trees over the blocks hold how many
units end in each and how many code points begin in each. A cut after so many units is found by
descending the tree in powers of two: that gives the block and the code points before it, and
only this block is searched for the place itself.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ebbflow.llm.tokens import slices

BLOCK = 1024  # bytes
SEED = 42
RATE = 50  # of a hundred texts that are transformed
SUFFIX_FIRST = 80  # of a hundred of these
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(data: np.ndarray) -> np.ndarray:
    """True at the last byte of each unit of a text's bytes."""
    blank = BLANK[data]
    ends = ~blank
    ends[:-1] &= blank[1:]
    ends[-1:] = True
    return ends


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree of these counts; node i, from 1, sums the last (i & -i) counts up to it."""
    tree = np.concatenate([[0], counts]).astype(np.int64)
    step = 1
    while step < len(tree):
        nodes = np.arange(step, len(tree) - step, 2 * step)
        tree[nodes + step] += tree[nodes]
        step *= 2
    return tree


class Blocks:
    """The units and code points of a text, counted by block."""

    def __init__(self, text: bytes, block: int = BLOCK):
        data = np.frombuffer(text, dtype=np.uint8)
        self.block = block
        self.ends = unit_ends(data)
        self.begins = (data & 0xC0) != 0x80
        firsts = np.arange(0, len(data), block)
        self.units = fenwick(_sums(self.ends, firsts))
        self.chars = fenwick(_sums(self.begins, firsts))

    def descend(self, units: int) -> tuple[int, int, int]:
        """The block in which unit number `units` (from 1) ends, its number among the units that
        end there, and the code points before the block."""
        at, left, chars = 0, units, 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            to = at + step
            if to < len(self.units) and self.units[to] < left:
                at, left, chars = to, left - int(self.units[to]), chars + int(self.chars[to])
            step >>= 1
        return at, left, chars

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first `units` units."""
        if not units:
            return 0, 0
        block, left, chars = self.descend(units)
        first = block * self.block
        stop = first + int(np.flatnonzero(self.ends[first : first + self.block])[left - 1]) + 1
        return stop, chars + int(self.begins[first:stop].sum())


def _sums(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(flags, firsts, dtype=np.int64) if len(firsts) else np.zeros(0, np.int64)


def draws(key: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits that the key decides; a null key counts as an empty text."""
    digest = sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def transform(key: int | None, text: bytes, seed: int, rate: int, suffix_first: int):
    """Units, form, code points of prefix and middle (None if plain), and the output."""
    one, two, three, four = draws(key, seed)
    if not text or three % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return int(unit_ends(np.frombuffer(text, dtype=np.uint8)).sum()), "plain", None, None, text
    blocks = Blocks(text)
    n = int(blocks.ends.sum())
    low, high = sorted((one % (n + 1), two % (n + 1)))
    (first, before), (last, upto) = blocks.cut(low), blocks.cut(high)
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if four % 100 < suffix_first:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return n, form, before, upto - before, output


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output, one row for each row.

    doc_id and `seed` alone decide whether and where a text is cut, so a repeated task gives the
    same rows, and repeated rows the same output. form is spm (suffix, prefix, middle), psm
    (prefix, suffix, middle) or plain: the text as it is, with null counts. A null text counts
    as empty; an empty text and one that holds a mark stay plain; a null doc_id draws as an empty
    text would. Other columns are ignored; an empty table gives no rows. One pass, no shuffle.
    """

    def work(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            made = [
                transform(k, t or b"", seed, rate, suffix_first)
                for k, t in zip(batch.column(0).to_pylist(), texts)
            ]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(list(c), type=k) for c, k in zip(zip(*made), kinds)]
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.record_batch(
                [batch.column(0), *columns],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output and its form were made of. No part holds a mark, so the first of
    each mark is the one that was put in."""
    place = {m: F.instr(output, m.decode()) for m in (PREFIX, SUFFIX, MIDDLE)}

    def between(first: bytes, last: bytes) -> Column:
        begin = place[first] + len(first)
        return F.substring(output, begin, place[last] - begin)

    middle = F.substring(output, place[MIDDLE] + len(MIDDLE), F.char_length(output))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
