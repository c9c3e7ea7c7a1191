"""Token ids of whole texts by a public tokenizer file, each distinct chunk encoded once.

The tokenizers used here never join characters across a blank that follows a character other than white space, nor across
a single line end between two such characters, nor a run of letters with stops behind it (unless the run's lower case ends in
a mark). A text is cut there, the library encodes each piece that is new to the worker, and the ids of a
text are those of its pieces. Words of letters go straight to the library's model.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a Python worker keeps in each of two generations; when one is full, the older one goes. That changes nothing but time.
CACHED_CHUNKS = 600_000
#: Length up to which a chunk is kept; longer ones are encoded each time.
CACHED_CHARS = 64
#: Signs that may follow a word of letters; an apostrophe may join it and angle brackets may be of a special token.
STOPS = ".,;:!?#$%&*()-\""
#: Letters from here on are left to the library's own rules on what a letter is.
PLAIN_LETTERS = "\u0530"
#: Bytes of texts whose chunks are told apart at once.
HELD_BYTES = 20 << 20
#: White space, as Python has it, before a blank: such texts are cut one by one.
_WIDE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_IDS = np.dtype("<u4")
_loaded: dict[str, ChunkEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """How byte-level models write bytes: printable ones as they are, the others in order from code point 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(printable)]
    return {x: chr(x) for x in printable} | {x: chr(256 + k) for k, x in enumerate(others)}


def _lowered(word: str) -> str:
    """A word in the library's normal form: composed, each letter in lower case by itself."""
    return "".join(map(str.lower, unicodedata.normalize("NFC", word)))


class ChunkEncoder(dict):
    """Ids of chunks as little-endian unsigned 32-bit integers; a chunk that is asked for first is encoded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.kept = CACHED_CHUNKS
        #: Whether chunks that are made of others are kept as well: not worth their room where equal chunks are looked up together.
        self.keeps_composed = True
        self.tokenizer = Tokenizer.from_file(path)
        one = self._whole("a")
        self.blanks_count = self._whole("a a") != one + one
        self.lowers = self._whole("A") == one
        self.letters = _byte_letters()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, _IDS).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of one run of letters with or without a blank before it."""
        if self.lowers:
            word = word.lower() if word.isascii() else _lowered(word)
        if not word.isascii():
            spelled = word.encode().decode("latin-1").translate(self.letters)
        else:
            spelled = self.letters[32] + word[1:] if word[0] == " " else word
        return array("I", [x.id for x in self.tokenizer.model.tokenize(spelled)]).tobytes()

    def _letters_only(self, word: str) -> bool:
        """Whether the library takes ``word`` as one run of letters, whatever stops follow it."""
        if word.isascii():
            return word.isalpha()
        # a letter whose lower case has a mark of its own: the mark goes with what follows
        return word.isalpha() and max(word) < PLAIN_LETTERS and not (self.lowers and not _lowered(word).isalpha())

    def __missing__(self, chunk: str) -> bytes:
        if ids := self.older.get(chunk):
            self[chunk] = ids
            return ids
        core, composed = chunk.rstrip(STOPS), True
        line = chunk.find("\n")
        if 0 < line < len(chunk) - 1 and not chunk[line - 1].isspace() and not chunk[line + 1].isspace():
            ids = self[chunk[:line]] + self["\n"] + self[chunk[line + 1 :]]
        elif not self._letters_only(core[1:] if core[:1] == " " else core):
            ids, composed = self._whole(chunk), False
        elif len(core) < len(chunk):
            ids = self[core] + self[chunk[len(core) :]]
        else:
            ids, composed = self._word(chunk), False
        if len(chunk) <= CACHED_CHARS and (self.keeps_composed or not composed):
            if len(self) >= self.kept:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def chunks(self, text: str) -> list[str]:
        if not self.blanks_count:
            return text.split(" ")
        if re.search(r"\s ", text):
            return re.split(r"(?<=\S)(?= )", text)
        head, *rest = text.split(" ")
        return [head, *[" " + x for x in rest]]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.chunks(text)))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """What ``encode`` gives for each text; a chunk that occurs several times in them is looked up once."""
        wide = pc.match_substring_regex(texts, _WIDE) if self.blanks_count else None
        if wide is None or not pc.any(wide).as_py():
            return self._cut_at_blanks(texts)
        others = iter(self._cut_at_blanks(texts.filter(pc.invert(wide))))
        return [self.encode(text.as_py()) if own else next(others) for text, own in zip(texts, wide.to_pylist(), strict=True)]

    def _cut_at_blanks(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        parts = pc.split_pattern(texts, " ")
        chunks, firsts = parts.values.dictionary_encode(), parts.offsets.to_numpy()
        place = chunks.indices.to_numpy().copy()
        del parts
        heads: list[bytes] = []
        asked = np.ones(len(chunks.dictionary), bool)
        if self.blanks_count:  # all but the first chunk of a text have their blank before them
            at = firsts[:-1]
            heads = [self[x] for x in chunks.dictionary.take(pa.array(place[at])).to_pylist()]
            follows = np.ones(len(place), bool)
            follows[at] = False
            asked[:] = False
            asked[place[follows]] = True
            place = (np.cumsum(asked, dtype=np.int32) - 1)[place]
            place[at] = asked.sum() + np.arange(len(at))
        listed = self._listed(chunks.dictionary.filter(pa.array(asked)))
        del chunks
        ids = [*map(self.__getitem__, listed), *heads]
        del listed
        found = pa.array(ids, pa.large_binary()).take(pa.array(place))
        bounds = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)[firsts].tolist()
        data = memoryview(found.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def _listed(self, chunks: pa.Array):
        """Chunks, none of which has a blank, as Python strings with the blank that they are looked up with."""
        if not len(chunks):
            return []
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), " ")[0].as_py()
        return map(" ".__add__, whole.split(" ")) if self.blanks_count else whole.split(" ")


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder of that file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]


def forget() -> None:
    """Free the worker's chunks, for an operator that needs the memory."""
    for own in _loaded.values():
        own.forget()


def encoded(texts, path: str, end_id: int, kept: int = CACHED_CHUNKS):
    """Yield the ids of each text with ``end_id`` at its end, as bytes. Null texts have the end id only.

    ``texts`` are a list or an Arrow array, which takes less time. ``kept`` bounds the chunks of a generation, for operators that
    need memory of their own.
    """
    end = np.array([end_id], _IDS).tobytes()
    own = encoder(path)
    own.kept = kept
    own.keeps_composed = not isinstance(texts, pa.Array)
    if own.keeps_composed:
        for text in texts:
            yield own.encode(text or "") + end
        return
    behind = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(behind[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(behind, before + HELD_BYTES, "right")))
        for ids in own.encode_all(pc.fill_null(texts[at:to], "")):
            yield ids + end
        pa.default_memory_pool().release_unused()
        at = to
