"""Token ids of many texts, with each distinct word encoded once per task."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from incidentia.llm.words import split_words

DEFAULT_TOKENIZER = "word_bpe_49k.json"
# Bytes of text that a task works on at a time, and when it encodes them.
SLICE_BYTES = 8_000_000
ENCODE_BYTES = 4_000_000
# Words a task remembers.
REMEMBERED = 400_000

# A word of letters up to U+00FF and after it ASCII marks other than the
# apostrophe: the tokenizer cuts between the two, and its normalisation of the
# letters is plain lower case.
_PLAIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>[!-&(-/:-@\[-`{-~]*)$"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return letters


def largest_id(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values(), default=0)


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space, word by word.

    White space always ends a token of such a tokenizer, so the ids of a text
    are those of its words in a row. The ids of a word are kept as the bytes of
    32-bit numbers, which take a third of what a list of them would.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.cores: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}

    def _core(self, core: str) -> bytes:
        ids = self.cores.get(core)
        if ids is None:
            lower = core.lower()
            if not lower.isascii():
                lower = "".join(map(self.letters.__getitem__, lower.encode()))
            if len(self.cores) > REMEMBERED:
                self.cores.clear()
            found = [t.id for t in self.tokenizer.model.tokenize(lower)]
            ids = self.cores[core] = array("I", found).tobytes()
        return ids

    def _other(self, words: list[str]) -> None:
        """Encode words that are not plain with all steps of the tokenizer."""
        if len(self.others) > REMEMBERED:
            self.others.clear()
        new = list(dict.fromkeys(w for w in words if w not in self.others))
        made = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.others.update(zip(new, (array("I", e.ids).tobytes() for e in made)))

    def _distinct(self, words: pa.Array) -> list[bytes]:
        parts = pc.extract_regex(words, _PLAIN)
        cores, rests = (f.to_numpy(zero_copy_only=False).tolist() for f in parts.flatten())
        whole = words.filter(pc.is_null(parts)).to_pylist()
        self._other([*whole, *{r for r in rests if r}])
        whole_words, out = iter(whole), []
        for core, rest in zip(cores, rests):
            if core is None:
                out.append(self.others[next(whole_words)])
            else:
                out.append(self._core(core) + self.others[rest] if rest else self._core(core))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, place of each text's first id, plus the end)."""
        words, edges = split_words(texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        ids = self._distinct(coded.dictionary)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        codes = coded.indices.to_numpy()
        many = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(many)))
        shift = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], many)
        return flat[shift + np.arange(len(shift))], ends[edges]


def slices(
    batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy()
    part = np.cumsum(sizes) // most
    starts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(int(a), int(b - a))
