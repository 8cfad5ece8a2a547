"""Token ids of whole texts by public tokenizers, with a bounded memory of words.

A text is cut into parts that are coded one by one, so a part met before need not be coded
again. That gives the tokenizer's own ids where no token reaches over a cut: at white space for a
tokenizer that drops it, and for a byte-level one without normaliser before each single space or
line feed between two visible characters. Texts with other spacing beside those (runs of spaces,
a space at a line end, one at the end) are then coded whole.

New parts are coded many at a time as one text; where each ends is told by the ids themselves,
by the space or line feed that begins a byte-level part or by the mark that ends a word. If the
count is not that of the parts, they are coded one by one. Byte-level words of Latin letters alone
go to the tokenizer's model in its own alphabet and cut at their spaces, without its pattern, which
would leave them whole.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "Ġ"  # a space in the alphabet of byte-level vocabularies
WORDS = 1_000_000  # parts kept per Python worker, about 200 MB
GROUP = 256  # texts whose new words are coded in one call
LEARN = 2_000  # new words coded as one text
SLICE_BYTES = 4 << 20  # text that is turned into ids at a time
SEPARATORS = frozenset("\x1c\x1d\x1e\x1f")  # white space to str.split, not to tokenizers

_memos: dict[tuple[str, bool, int], "WordMemo"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def memo(path: str, plain_specials: bool = False, limit: int = WORDS) -> "WordMemo":
    """The worker's memo of this tokenizer file."""
    key = path, plain_specials, limit
    if key not in _memos:
        _memos[key] = WordMemo(path, limit, plain_specials)
    return _memos[key]


def slices(batch: pa.RecordBatch, column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about `limit` bytes, at least one row each."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


class WordMemo:
    """Ids of texts as little-endian unsigned 32-bit integers.

    `plain_specials`: the names of special tokens inside a text are plain text. Otherwise they
    become the special ids, as the tokenizers library has it.
    """

    def __init__(self, path: str, limit: int = WORDS, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.spaced = self.tokenizer.normalizer is None and isinstance(
            self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel
        )
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        # parts without a space can be coded alone
        self.by_words = self.spaced or bool(suffix) and self._drops_spaces()
        if self.spaced:
            self.bounds = np.array([n.startswith(SPACE) for n in names])
            self.feeds = np.array([n.startswith("Ċ") for n in names])
        else:
            self.bounds = np.array([bool(suffix) and n.endswith(suffix) for n in names])
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.letters = None  # codes words of letters, spelled in the vocabulary's alphabet
        if (
            self.spaced
            and isinstance(self.tokenizer.model, models.BPE)
            and not self.tokenizer.pre_tokenizer.add_prefix_space
            and not any(a.content.isalpha() for a in added)
        ):
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = pre_tokenizers.Metaspace(SPACE, "never", True)
        alphabet = {b: c for c, b in byte_alphabet().items()}
        self.spelling = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(256)}
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.unsafe: set[str] = set()  # parts beside which a space is no safe cut
        self.marks = dict(zip(".,", self.encode([".", ","])))

    def _drops_spaces(self) -> bool:
        ids = [self.encode([t])[0] for t in ("a b", " a  b ", "a")]
        return ids[0] == ids[1] and ids[0].startswith(ids[2]) and not self.encode([" "])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The tokenizer's own ids, without the memory of words."""
        return self._coded(self.tokenizer, texts)

    @staticmethod
    def _coded(tokenizer, texts: list[str]) -> list[bytes]:
        coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in coded]

    def _plain(self, word: str) -> bool:
        """Is the word one run of letters to the tokenizer?"""
        if not word.isalpha():
            return False
        return self.spaced or word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha()

    def _learn(self, words: set[str]) -> None:
        """Ids of new words, unless a space before the word is no safe cut."""
        known, marks, stems, alone, odd, lines = self.known, self.marks, set(), [], [], []
        ended = []  # a last full stop or comma after letters is a part of its own
        for word in words:
            if self.spaced and word.isalpha():
                stems.add(word)
            elif word and word[-1] in marks and self._plain(word[:-1]):
                ended.append(word)
                stems.add(word[:-1])
            elif not self.spaced:
                if self._plain(word):
                    stems.add(word)
                else:
                    odd.append(word)
            elif word and not word[0].isspace() and not word[-1].isspace():
                alone.append(word)
            elif word[:1] == "\n" and word[1:] and not word[1].isspace() and not word[-1].isspace():
                lines.append(word)
            else:
                self.unsafe.add(word)
        stems = stems.difference(known)
        ascii = [s for s in stems if s.isascii()]
        for some in ascii, list(stems.difference(ascii)), alone:
            for new in chunks(some):
                known.update(zip(new, self.coded_words(new)))
        for word in ended:
            known[word] = known[word[:-1]] + marks[word[-1]]
        known.update(zip(odd, self.encode(odd)))
        for new in chunks(lines):
            known.update(zip(new, self._apart("".join(new), new, self.feeds) or self.encode(new)))

    def coded_words(self, words: list[str]) -> list[bytes]:
        """Ids of words, a space before each; quickest for words of Latin letters alone."""
        space = " " if self.spaced else ""
        return self._spelled(words) or self._together(words) or self.encode([space + w for w in words])

    def _spelled(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of Latin letters, which the tokenizer's pattern leaves whole."""
        if self.letters is None or not "".join(words).isalpha():
            return None
        text = " " + " ".join(words)
        if text.isascii():
            text = text.replace(" ", SPACE)
        else:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return None
            text = text.translate(self.spelling)
        return self._parted(self._coded(self.letters, [text])[0], words, self.bounds)

    def _together(self, words: list[str]) -> list[bytes] | None:
        """Ids of the words, a space before each, from one text of them all."""
        return self._apart(" " + " ".join(words), words, self.bounds)

    def _apart(self, text: str, words: list[str], bounds: np.ndarray) -> list[bytes] | None:
        """Ids of the words of a text, if each of them can be told from the next."""
        return self._parted(self.encode([text])[0], words, bounds)

    def _parted(self, data: bytes, words: list[str], bounds: np.ndarray) -> list[bytes] | None:
        at = np.flatnonzero(bounds[np.frombuffer(data, dtype="<u4")])
        if len(at) != len(words):
            return None
        ends = [*at[1:].tolist(), len(data) // 4] if self.spaced else (at + 1).tolist()
        out, begin = [], 0
        for end in ends:
            out.append(data[4 * begin : 4 * end])
            begin = end
        return out

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; none for a null."""
        out: list[bytes] = []
        for at in range(0, len(texts), GROUP):
            out += self._group([t or "" for t in texts[at : at + GROUP]])
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return self.encode(texts)
        if len(self.known) + len(self.unsafe) > self.limit:
            self.known.clear()
            self.unsafe.clear()
        if self.spaced:
            parts = [t.replace("\n", " \n").split(" ") for t in texts]
        else:
            parts = [t.split() if SEPARATORS.isdisjoint(t) else t.split(" ") for t in texts]
        heads = [p.pop(0) for p in parts] if self.spaced else []  # no space stands before these
        first = self.encode(heads)
        words = set().union(*parts)
        new = words.difference(self.known) - self.unsafe
        if new:
            self._learn(new)
        unsafe, coded = words & self.unsafe, self.known.__getitem__
        whole, out = {}, []
        for i, p in enumerate(parts):
            if not self.spaced:
                out.append(b"".join(map(coded, p)))
            elif p and heads[i] and heads[i][-1].isspace() or unsafe and not unsafe.isdisjoint(p):
                whole[i] = texts[i]
                out.append(b"")
            else:
                out.append(first[i] + b"".join(map(coded, p)))
        for i, ids in zip(whole, self.encode(list(whole.values()))):
            out[i] = ids
        return out


def chunks(words: list[str], size: int = LEARN) -> Iterator[list[str]]:
    return (words[at : at + size] for at in range(0, len(words), size))


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand
    for themselves, the others in order for the characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
